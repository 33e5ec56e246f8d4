"""From raw documents to a mixed, encoded corpus, stage by stage.

Every stage takes all rows of the one before. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import exact_dedup, mixing, ngram_join, pieces, quality
from docweave.llm.shared import parked, unparked

# The contract of the stages on word shingles: five words, a similarity of 0.8.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules keep. A row is judged by its own text, met by its digest."""
    judged = quality.judged(docs.select(F.sha2("text", 256).alias("mark"), "text", "lang"))
    rejected = judged.filter("NOT kept").select(F.col("mark").alias("__mark"), F.col("lang").alias("__lang")).distinct()
    same = F.sha2("text", 256).eqNullSafe(F.col("__mark")) & F.col("lang").eqNullSafe(F.col("__lang"))
    return docs.join(rejected, same, "left_anti")


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.first_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by shingles, the one with the smallest ``doc_id``.

    A row is known by a digest of its ``doc_id`` and text, so texts that share a ``doc_id``, or lack one,
    are told apart. Of rows without ``doc_id`` the least digest stays. Only rows that go are met again.
    """
    mark = F.xxhash64("doc_id", "text")
    groups = ngram_join.join(docs.select(mark.alias("doc_id"), "text"), NEAR_WIDTH, NEAR_PERCENT)
    linked = groups.select(F.col("doc_id").alias("mark"), F.col("component_id").alias("component")).distinct()
    named = docs.select(mark.alias("mark"), F.col("doc_id").alias("named")).distinct()
    placed = parked(linked.join(named, "mark"), "near-groups")
    first = placed.groupBy("component").agg(F.min(F.struct(F.col("named").isNull(), "named", "mark")).alias("first"))
    dropped = placed.join(first, "component").filter("mark <> first.mark").select(F.col("mark").alias("__dropped")).distinct()
    return docs.join(dropped, mark == F.col("__dropped"), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mix = mixing.mix(docs).groupBy("doc_id", "mark", "source").agg(F.max("copies").alias("copies"))
    key = F.xxhash64("text")
    chosen = mix.filter("copies > 0").select(
        F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark"), F.col("source").alias("__source"),
        F.col("copies").cast("int").alias("__copies"),
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("__doc")) & (key == F.col("__mark"))
        & F.col("source").eqNullSafe(F.col("__source"))
    )
    taken = docs.join(chosen, same)
    return taken.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), F.col("__copies"))).alias("__copy")).drop("__copy")


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mixed documents with their piece ids."""
    return pieces.encode(docs, pieces.default_model())


STAGES = [
    ("quality rules", good_quality),
    ("exact dedup", exact),
    ("n-gram join", near),
    ("mixing", mixed),
    ("SentencePiece", encoded),
]

# A stage fits histograms and another encodes by a vocabulary file, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs = parked(stage(spark, docs, folder), name.replace(" ", "-"))
        unparked(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, folder)
