"""Keyed tables that grow by pages of changes, and report files.

A page of changes rewrites only the rows of the keys it touches. Tables are Parquet, partitioned by
version and by a bucket of the key:

    <root>/<table>/base/__bucket=<b>/__v=<n>    all rows of a bucket as of version n
    <root>/<table>/pages/__v=<n>/__bucket=<b>   all rows, after page n, of the keys it touched
    <root>/_keys/pages/__v=<n>/__bucket=<b>     those keys; one without rows is gone
    <root>/_published, <root>/_bases            the versions that readers see

The newest page that touched a key has all its rows. A page is staged first and published last, by one
row, so a refused or broken one is not seen and its retry overwrites it. ``compact`` folds published pages
into the bases of the buckets they touched, and drops what no reader needs then.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave import schemas
from docweave.functions import ids
from docweave.session import cut_lineage

BUCKETS = 64
_V, _BUCKET, _KEY = "__v", "__bucket", "__key"
_KEYS = T.StructType([T.StructField("table", T.StringType()), T.StructField(_KEY, T.StringType())])
# Tables of files, and those that jobs keep beside them.
FILE_TABLES = {
    "state": schemas.STATE, "retry_queue": schemas.RETRY_QUEUE, "split_queue": schemas.SPLIT_QUEUE, "objects": schemas.OBJECT,
    "staff_index": schemas.INDEX, "student_index": schemas.INDEX,
}
JOB_TABLES = FILE_TABLES | {"control": schemas.CONTROL}
OWNERS: dict[str, Callable[[], Column]] = {"objects": lambda: ids.object_owner(F.col("name"))}


class TableStore:
    """Tables under one folder whose rows belong to keys; ``tables`` names their schemas.

    A row's key is its ``file_id``, or what ``owners`` states for its table.
    """

    def __init__(
        self, spark: SparkSession, root: str, tables: dict[str, T.StructType],
        owners: dict[str, Callable[[], Column]] | None = None, buckets: int = BUCKETS,
    ):
        self.spark, self.root, self.tables, self.buckets = spark, root.rstrip("/"), tables, buckets
        self.owners = OWNERS if owners is None else owners
        self._known: dict[int, dict[int, int]] = {}  # bases by version, until the next compaction

    # --- files

    def _path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def _files(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), hadoop

    def _exists(self, path: str) -> bool:
        fs, hadoop = self._files(path)
        return fs.exists(hadoop)

    def _drop(self, path: str) -> None:
        fs, hadoop = self._files(path)
        fs.delete(hadoop, True)

    def _load(self, path: str, schema: T.StructType) -> DataFrame:
        """Rows of a partitioned folder; none where it does not exist yet."""
        whole = T.StructType([*schema.fields, T.StructField(_V, T.LongType()), T.StructField(_BUCKET, T.IntegerType())])
        if not self._exists(path):
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(path).select(*whole.names)

    def _marks(self, name: str, schema: str) -> list:
        path = self._path(name)
        return self.spark.read.schema(schema).parquet(path).distinct().collect() if self._exists(path) else []

    # --- versions

    def version(self) -> int | None:
        """Newest published version; one small row per version since the last compaction is read."""
        return max((r.version for r in self._marks("_published", "version long")), default=None)

    def _bases(self, version: int) -> dict[int, int]:
        """The version of each bucket's base that readers of ``version`` see."""
        if version not in self._known:
            found: dict[int, int] = {}
            for r in self._marks("_bases", "version long, bucket int"):
                if r.version <= version:
                    found[r.bucket] = max(r.version, found.get(r.bucket, r.version))
            self._known[version] = found
        return self._known[version]

    def _key(self, table: str) -> Column:
        return self.owners[table]() if table in self.owners else F.col("file_id")

    def _bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    # --- reading

    def _wanted(self, table: str, keys: DataFrame) -> DataFrame:
        own = ids.object_owner(F.col("file_id")) if table in self.owners else F.col("file_id")
        return keys.select(own.alias(_KEY)).distinct()

    def _buckets(self, table: str, keys: DataFrame) -> list[int]:
        return [r[0] for r in self._wanted(table, keys).select(self._bucket_of(F.col(_KEY))).distinct().collect()]

    def read_all(self, names: Iterable[str], keys: DataFrame, version: int | None = None) -> dict[str, DataFrame]:
        """The rows of ``keys`` in several tables, written once."""
        version = self.version() if version is None else version
        keys = cut_lineage(keys.select("file_id").distinct())
        places: dict[bool, list[int]] = {}
        found = {}
        for name in names:
            owned = name in self.owners
            if owned not in places:
                places[owned] = self._buckets(name, keys)
            found[name] = cut_lineage(self._read(name, version, keys, places[owned]))
        return found

    def read(self, table: str, keys: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """A table at a version, the newest published one by default; only rows of ``keys`` where given."""
        version = self.version() if version is None else version
        return self._read(table, version, keys, None if keys is None else self._buckets(table, keys))

    def _read(self, table: str, version: int, keys: DataFrame | None, buckets: list[int] | None) -> DataFrame:
        """The buckets of the keys, a bounded set of numbers, prune the files that are read."""
        schema, number, v = self.tables[table], F.col(_BUCKET), F.col(_V)
        groups: dict[int, list[int]] = {}
        for bucket, at in self._bases(version).items():
            groups.setdefault(at, []).append(bucket)
        from_base, in_pages = F.lit(False), ~number.isin([b for some in groups.values() for b in some])
        for at, some in groups.items():
            from_base = from_base | ((v == at) & number.isin(some))
            in_pages = in_pages | ((v > at) & number.isin(some))
        in_pages = (v <= version) & in_pages
        base = self._load(self._path(table, "base"), schema).filter(from_base)
        pages = self._load(self._path(table, "pages"), schema).filter(in_pages)
        touched = self._load(self._path("_keys", "pages"), _KEYS).filter(in_pages & (F.col("table") == table))
        if keys is not None:
            base, pages, touched = (df.filter(number.isin(buckets)) for df in (base, pages, touched))
            wanted = self._wanted(table, keys)
            base = base.withColumn(_KEY, self._key(table)).join(wanted, _KEY, "left_semi")
            touched = touched.join(wanted, _KEY, "left_semi")
        newest = touched.groupBy(_KEY).agg(F.max(_V).alias("__newest"))
        base = base.withColumn(_KEY, self._key(table)).join(newest, _KEY, "left_anti")
        pages = pages.withColumn(_KEY, self._key(table)).join(newest, _KEY).filter(v == F.col("__newest"))
        return base.select(*schema.names).unionByName(pages.select(*schema.names))

    # --- writing

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_V, _BUCKET).parquet(path)

    def load(self, tables: dict[str, DataFrame]) -> None:
        """Version 0: whole tables as bases."""
        for name, rows in tables.items():
            placed = rows.select(*self.tables[name].names).withColumn(_BUCKET, self._bucket_of(self._key(name))).withColumn(_V, F.lit(0))
            placed.repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET, _V).parquet(self._path(name, "base"))
        self._mark_bases(0, range(self.buckets))
        self._mark(0)

    def stage(self, version: int, tables: dict[str, DataFrame], touched: DataFrame, **others: DataFrame) -> None:
        """Write the rows that the touched keys (file_id) have after a page; readers do not see them yet.

        Tables that are not named keep theirs; ``others`` gives the keys of single tables.
        """
        common = cut_lineage(touched.select("file_id").distinct())
        self._drop(self._path("_keys", "pages", f"{_V}={version}"))
        keys = None
        for name, rows in tables.items():
            kept = others[name].select("file_id").distinct() if name in others else common
            own = F.col("file_id") if name not in self.owners else ids.object_owner(F.col("file_id"))
            named = kept.select(F.lit(name).alias("table"), own.alias(_KEY)).distinct()
            keys = named if keys is None else keys.unionByName(named)
            self._drop(self._path(name, "pages", f"{_V}={version}"))
            placed = rows.select(*self.tables[name].names).withColumn(_BUCKET, self._bucket_of(self._key(name)))
            self._write(placed.withColumn(_V, F.lit(version)), self._path(name, "pages"))
        self._write(keys.withColumn(_BUCKET, self._bucket_of(F.col(_KEY))).withColumn(_V, F.lit(version)), self._path("_keys", "pages"))

    def staged(self, version: int, table: str) -> DataFrame:
        """What a staged page holds of a table."""
        return self._load(self._path(table, "pages"), self.tables[table]).filter(F.col(_V) == version).select(*self.tables[table].names)

    def publish(self, version: int) -> None:
        """Make a staged version visible. A repeat changes nothing."""
        current = self.version()
        if current is None or current < version:
            self._mark(version)

    def _mark(self, version: int) -> None:
        self.spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1).write.mode("append").parquet(
            self._path("_published"))

    def _mark_bases(self, version: int, buckets) -> None:
        rows = self.spark.createDataFrame([(version, int(b)) for b in buckets], "version long, bucket int")
        rows.coalesce(1).write.mode("append").parquet(self._path("_bases"))

    # --- compaction

    def compact(self) -> list[int]:
        """Fold published pages into new bases of the buckets they touched, and drop the folded files.

        The bases become visible by one append; until then readers see the pages, so it may stop anywhere.
        """
        version = self.version()
        bases = self._bases(version)
        keys = self._load(self._path("_keys", "pages"), T.StructType([T.StructField("table", T.StringType())]))
        rows = keys.filter(F.col(_V) <= version).select(_V, _BUCKET).distinct().collect()
        open_pages = [r for r in rows if r[_V] > bases.get(r[_BUCKET], -1)]
        buckets = sorted({r[_BUCKET] for r in open_pages})
        if not buckets:
            return []
        for name in self.tables:
            whole = self.read(name, version=version).withColumn(_BUCKET, self._bucket_of(self._key(name)))
            placed = whole.filter(F.col(_BUCKET).isin(buckets)).withColumn(_V, F.lit(version))
            placed.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                _BUCKET, _V).parquet(self._path(name, "base"))
        self._mark_bases(version, buckets)
        self._known.clear()
        for name in (*self.tables, "_keys"):
            for v in {r[_V] for r in rows}:
                self._drop(self._path(name, "pages", f"{_V}={v}"))
            if name in self.tables:
                for bucket in buckets:
                    if bases.get(bucket, version) != version:
                        self._drop(self._path(name, "base", f"{_BUCKET}={bucket}", f"{_V}={bases[bucket]}"))
        return buckets


def write_documents(texts: DataFrame, root: str, version: int) -> None:
    """Indexed texts (file_id, kind, markdown) of one step, a partition for each version and kind."""
    stamped = texts.withColumn("version", F.lit(version))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "kind").parquet(root)


def write_csv(rows: DataFrame, path: str) -> None:
    """Evidence rows as CSV; array columns are joined by a bar."""
    flat = [
        F.array_join(f.name, "|").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
        for f in rows.schema.fields
    ]
    rows.select(*flat).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def markdown_report(title: str, metrics: DataFrame, label: str, order: str) -> DataFrame:
    """A Markdown table of metric rows, one text line per row: (line_no, line).

    ``metrics`` is a report, a row for each criterion or type.
    """
    names = metrics.columns
    cells = F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in names])
    body = cut_lineage(metrics.select(F.col(order).cast("string").alias("key"), F.concat(F.lit("| "), cells, F.lit(" |")).alias("line")))
    head = [f"# {title}", "", "| " + " | ".join([label, *names[1:]]) + " |", "| " + " | ".join("---" for _ in names) + " |"]
    lead = body.sparkSession.createDataFrame([(f"0{i}", line) for i, line in enumerate(head)], "key string, line string")
    return lead.withColumn("part", F.lit(0)).unionByName(body.withColumn("part", F.lit(1))).orderBy("part", "key").select("line")


def write_text(lines: DataFrame, path: str) -> None:
    lines.select("line").coalesce(1).write.mode("overwrite").text(path)
