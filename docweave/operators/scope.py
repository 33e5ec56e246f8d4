"""Folder scope, audience and paths over a folder graph.

Folders are an edge table (folder_id, parent_id, name): a row for each parent, the parent NULL at a
root, ``parent_no`` the place of a parent in its list. What a file needs to know of the graph is in its
closure, one row for each folder and ancestor. It is built by doubling the paths, in as many joins as the
logarithm of the depth, may be stored, and is changed only below the folders that moved; scope, audience
and paths of a page of files are then one join each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import paths
from docweave.functions.text import blank_to_null
from docweave.session import cut_lineage

CLOSURE = ("folder_id", "ancestor_id", "distance", "first_distance", "known")


def _edges(folders: DataFrame) -> DataFrame:
    """Each folder's parents once; ``first`` marks the one listed first, else the least."""
    named = folders.withColumn("parent_id", blank_to_null(F.col("parent_id"))).filter("parent_id IS NOT NULL")
    place = F.col("parent_no") if "parent_no" in folders.columns else F.lit(0)
    placed = named.groupBy("folder_id", "parent_id").agg(F.min(place).alias("place"))
    first = placed.groupBy("folder_id").agg(F.min(F.struct("place", "parent_id"))["parent_id"].alias("first_parent"))
    return placed.join(first, "folder_id").select(
        "folder_id", F.col("parent_id").alias("ancestor_id"), F.lit(1).alias("distance"),
        F.when(F.col("parent_id") == F.col("first_parent"), 1).alias("first_distance"),
    )


def _extended(lower: DataFrame, upper: DataFrame) -> DataFrame:
    """Paths that go on where others begin."""
    after = upper.select(
        F.col("folder_id").alias("ancestor_id"), F.col("ancestor_id").alias("top"), F.col("distance").alias("more"),
        F.col("first_distance").alias("first_more"),
    )
    return lower.join(after, "ancestor_id").filter("folder_id <> top").select(
        "folder_id", F.col("top").alias("ancestor_id"), (F.col("distance") + F.col("more")).alias("distance"),
        (F.col("first_distance") + F.col("first_more")).alias("first_distance"),
    )


def _shortest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("folder_id", "ancestor_id").agg(
        F.min("distance").alias("distance"), F.min("first_distance").alias("first_distance")
    )


def _doubled(edges: DataFrame) -> DataFrame:
    """All ancestors along ``edges``. Round ``i`` finds the paths of up to ``2 ** i`` steps; cycles end there."""
    pairs, found = cut_lineage(edges.filter("folder_id <> ancestor_id")), None
    while True:
        counts = pairs.agg(F.count(F.lit(1)), F.count("first_distance")).first()
        if counts == found:
            return pairs
        found = counts
        pairs = cut_lineage(_shortest(pairs.unionByName(_extended(pairs, pairs))))


def _with_known(pairs: DataFrame, folders: DataFrame) -> DataFrame:
    ids = folders.select(F.col("folder_id").alias("ancestor_id"), F.lit(True).alias("known")).distinct()
    return pairs.join(ids, "ancestor_id", "left").withColumn("known", F.coalesce("known", F.lit(False))).select(*CLOSURE)


def _themselves(folders: DataFrame) -> DataFrame:
    return folders.select("folder_id").distinct().select(
        "folder_id", F.col("folder_id").alias("ancestor_id"), F.lit(0).alias("distance"), F.lit(0).alias("first_distance"),
        F.lit(True).alias("known"),
    )


def folder_closure(folders: DataFrame) -> DataFrame:
    """(folder_id, ancestor_id, distance, first_distance, known), each folder its own ancestor at 0.

    ``first_distance`` counts the steps along first parents, NULL off that chain; ``known`` is false
    for an ancestor that the folder table lacks.
    """
    return cut_lineage(_with_known(_doubled(_edges(folders)), folders).unionByName(_themselves(folders)))


def moved_closure(closure: DataFrame, folders: DataFrame, moved: DataFrame) -> DataFrame:
    """The closure after the folders in ``moved`` (folder_id) were added, removed or given other parents.

    Only folders at or below a moved one are worked on: paths among them, and from where they leave
    them the stored ancestors. ``folders`` is the table after the moves.
    """
    ids = moved.select("folder_id").distinct()
    below = closure.join(ids.withColumnRenamed("folder_id", "ancestor_id"), "ancestor_id", "left_semi").select("folder_id")
    touched = cut_lineage(below.unionByName(ids).distinct())
    kept = closure.join(touched, "folder_id", "left_anti")
    there = folders.join(touched, "folder_id", "left_semi")
    inside = _doubled(_edges(there))
    outward = _extended(inside, kept.filter("distance > 0"))
    renewed = _with_known(_shortest(inside.unionByName(outward)), folders).unionByName(_themselves(there))
    return cut_lineage(kept.unionByName(renewed))


def _among(column: Column, ids: tuple[str, ...]) -> Column:
    named = [i for i in ids if i]
    return F.coalesce(column.isin(*named), F.lit(False)) if named else F.lit(False)


def resolve_scope(
    files: DataFrame, folders: DataFrame, sync_roots: tuple[str, ...],
    student_roots: tuple[str, ...] = (), closure: DataFrame | None = None,
) -> DataFrame:
    """One row per file: ``scope`` (IN, OUT or UNKNOWN) and ``audience``.

    ``files`` has file_id and parent_id, with a row for each parent. No sync roots means that
    all files are in scope. A file outside the roots with a parent that could not be looked up
    is UNKNOWN, which must stop a commit; for the audience the same doubt means STAFF.
    """
    closure = folder_closure(folders) if closure is None else closure
    parent, ancestor = F.col("parent_id"), F.col("ancestor_id")
    flags = closure.groupBy(F.col("folder_id").alias("parent_id")).agg(
        F.max(_among(ancestor, sync_roots)).alias("sync"), F.max(_among(ancestor, student_roots)).alias("student"),
        F.max(~F.col("known") & ~_among(ancestor, sync_roots)).alias("unknown"),
    )
    lost = blank_to_null(parent).isNotNull() & ~_among(parent, sync_roots)
    per_file = files.select("file_id", "parent_id").join(flags, "parent_id", "left").groupBy("file_id").agg(
        F.max(F.coalesce("sync", _among(parent, sync_roots))).alias("sync"),
        F.max(F.coalesce("student", _among(parent, student_roots))).alias("student"),
        F.max(F.coalesce("unknown", lost)).alias("unknown"),
    )
    in_scope = F.col("sync") | _among(F.col("file_id"), sync_roots) if sync_roots else F.lit(True)
    return per_file.select(
        "file_id",
        F.when(in_scope, "IN").when(F.col("unknown"), "UNKNOWN").otherwise("OUT").alias("scope"),
        F.when(F.col("student") | _among(F.col("file_id"), student_roots), "STUDENT").otherwise("STAFF").alias("audience"),
    )


def files_under(
    files: DataFrame, folders: DataFrame, roots: tuple[str, ...], closure: DataFrame | None = None
) -> DataFrame:
    """Files whose parent lies at or below a root, each once."""
    closure = folder_closure(folders) if closure is None else closure
    inside = closure.filter(_among(F.col("ancestor_id"), roots)).select(F.col("folder_id").alias("parent_id")).distinct()
    named = inside.withColumn("inside", F.lit(True))
    held = F.coalesce("inside", _among(F.col("parent_id"), roots))
    return files.join(named, "parent_id", "left").filter(held).drop("inside").dropDuplicates(["file_id"])


def folder_chains(folders: DataFrame, wanted: DataFrame | None = None, closure: DataFrame | None = None) -> DataFrame:
    """(folder_id, names): names from the folder up along first parents, to the top.

    Only of the folders in ``wanted`` where given. A folder without a name shows its id; of several
    names the least counts. A chain ends at a folder that the table lacks, or that it holds already.
    """
    closure = folder_closure(folders) if closure is None else closure
    chain = closure.filter("known AND first_distance IS NOT NULL").select("folder_id", "ancestor_id", "first_distance")
    if wanted is not None:
        chain = chain.join(wanted.select("folder_id").distinct(), "folder_id", "left_semi")
    names = folders.groupBy(F.col("folder_id").alias("ancestor_id")).agg(F.min(blank_to_null(F.col("name"))).alias("name"))
    shown = chain.join(names, "ancestor_id").withColumn("name", F.coalesce("name", "ancestor_id"))
    ordered = F.sort_array(F.collect_list(F.struct("first_distance", "name")))
    return shown.groupBy("folder_id").agg(F.transform(ordered, lambda c: c["name"]).alias("names"))


def file_paths(files: DataFrame, folders: DataFrame, closure: DataFrame | None = None) -> DataFrame:
    """Add path and bundle to files with (file_id, name, parent_id), the first parent's row.

    A file without a known parent keeps its name as path and has no bundle.
    """
    wanted = files.select(F.col("parent_id").alias("folder_id"))
    chains = folder_chains(folders, wanted, closure).withColumnRenamed("folder_id", "parent_id")
    down = F.reverse(F.coalesce("names", F.array().cast("array<string>")))
    context = paths.path_context(down, F.coalesce(blank_to_null(F.col("name")), F.col("file_id")))
    return (
        files.join(chains, "parent_id", "left")
        .withColumn("__context", context)
        .withColumn("path", F.col("__context")["path"])
        .withColumn("bundle", F.col("__context")["bundle"])
        .drop("__context", "names")
    )
