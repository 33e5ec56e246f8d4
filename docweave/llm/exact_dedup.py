"""Exact duplicates by a split of frequent digests from the rest, on built-in functions only.

A Misra-Gries summary (``freqItems``, which keeps at most ``1 / support`` counters in each task
and merges them) names every digest that more than ``support`` of the rows can have. An exact
count verifies them. The winners, at most ``1 / support`` rows, are broadcast, and their groups
are resolved in the map tasks; only rows with other digests are shuffled, so no shuffled group is
larger than ``support`` of the table.

Defined results: a null text is an empty one, and all empty or blank texts form one group. Of
rows that tie in length, the smallest ``doc_id`` stays, nulls last; of rows that repeat both,
one stays. An empty table gives an empty result. Columns of any other name are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.shared import parked

SUPPORT = 1e-3
_BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _BLANKS, "")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def frequent_digests(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Digests that more than ``support`` of the rows have: ``__digest``, ``__size``, ``__best``.

    ``rows`` has ``__digest`` and ``__order``, a struct whose least value marks the row that stays.
    """
    named = rows.stat.freqItems(["__digest"], support)
    candidates = named.select(F.explode("__digest_freqItems").alias("__digest")).distinct()
    counted = (
        rows.join(F.broadcast(candidates), "__digest")  # at most 1 / support rows
        .groupBy("__digest")
        .agg(F.count(F.lit(1)).alias("__size"), F.min("__order").alias("__best"))
    )
    total = rows.agg(F.count(F.lit(1)).alias("__total"))
    return counted.join(
        F.broadcast(total), F.col("__size") > F.greatest(F.lit(1.0), F.col("__total") * support)
    ).drop("__total")


def split(rows: DataFrame, support: float = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Rows with frequent digests, with ``__size`` and ``__best``, and all others."""
    winners = parked(frequent_digests(rows, support), "digests")
    others = rows.join(F.broadcast(winners.select("__digest")), "__digest", "left_anti")
    return rows.join(F.broadcast(winners), "__digest"), others


def groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = parked(
        docs.select(
            "doc_id",
            digest(F.col("text")).alias("__digest"),
            F.struct(
                (-F.length(F.coalesce("text", F.lit("")))).alias("shorter"),
                F.col("doc_id").isNull().alias("unnamed"),
                F.col("doc_id").alias("doc_id"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("__order"),
        ),
        "digests",
    )
    frequent, others = split(rows, support)
    same = Window.partitionBy("__digest")
    resolved = others.select(
        "doc_id", "__digest", "__order",
        F.count(F.lit(1)).over(same).alias("__size"), F.min("__order").over(same).alias("__best"),
    )
    return frequent.select(*resolved.columns).unionByName(resolved).select(
        "doc_id",
        F.col("__best.doc_id").alias("keep_id"),
        F.col("__size").alias("group_size"),
        (F.col("__order") == F.col("__best")).alias("kept"),
        F.col("__digest").alias("text_sha256"),
    )


def first_of_each(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    The digests are planned on narrow rows; rows with a frequent digest are removed where they are
    read, and at most one per map task of each goes on.
    """
    order = F.struct(
        (-F.length(F.coalesce("text", F.lit("")))).alias("shorter"),
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"),
    )
    marked = docs.select(F.struct("*").alias("__row"), digest(F.col("text")).alias("__digest"), order.alias("__order"))
    narrow = parked(marked.select("__digest", "__order"), "digests")
    winners = parked(frequent_digests(narrow, support), "digests")
    best = Window.partitionBy("__digest").orderBy("__order")
    others = (
        marked.join(F.broadcast(winners.select("__digest")), "__digest", "left_anti")
        .withColumn("__place", F.row_number().over(best))
        .filter("__place = 1")
    )
    frequent = (
        marked.join(F.broadcast(winners.drop("__size")), "__digest")
        .filter(F.col("__order") == F.col("__best"))
        .groupBy("__digest")
        .agg(F.first("__row").alias("__row"))
    )
    return others.select("__row.*").unionByName(frequent.select("__row.*"))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
