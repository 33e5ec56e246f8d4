"""Ordered computations whose groups may be too large for one task.

A plain window sorts a whole group in one task. Here a group is cut into blocks of its order
column: the window runs inside each block, a second window runs over one row per block, and
the two are added. One group that holds a third of all rows is so spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.session import cut_lineage

BLOCK_ROWS = 65_536
_BLOCK = "__block"


def row_block(number: str) -> Column:
    """Block of a row number."""
    return F.floor(F.col(number) / BLOCK_ROWS)


def blocked(df: DataFrame, keys: Sequence[str], block: Column) -> DataFrame:
    """``df`` with ``__block``, written once: the blocks' summaries and their rows are read from it."""
    return cut_lineage(df.withColumn(_BLOCK, block))


def _carried(rows: DataFrame, keys: Sequence[str], per_block: DataFrame, carry: Column) -> DataFrame:
    """Add ``__carry``: what other blocks of the group hand over.

    Groups of one block, as most are, get none, so the joined side is short or empty.
    """
    named = [*keys, _BLOCK]
    handed = per_block.select(*[F.col(c).alias(f"__of_{c}") for c in named], carry.alias("__carry")).filter("__carry IS NOT NULL")
    same = [rows[c].eqNullSafe(handed[f"__of_{c}"]) for c in named]
    return rows.join(handed, same, "left").drop(*[f"__of_{c}" for c in named])


def in_one_block(rows: DataFrame, keys: Sequence[str], block: Column) -> bool:
    """Whether every group lies in one block: then no block hands anything over."""
    several = rows.groupBy(*keys).agg((F.min(block) != F.max(block)).alias("several"))
    return not several.agg(F.bool_or("several")).first()[0]


def _with_carry(
    df: DataFrame, keys: Sequence[str], block: Column, summary: Column, over_blocks: Column, written: bool = False,
) -> DataFrame:
    """Rows in blocks, with what the earlier blocks of the group hand over."""
    rows = df.withColumn(_BLOCK, block) if written else blocked(df, keys, block)
    per_block = rows.groupBy(*keys, _BLOCK).agg(summary.alias("__summary"))
    before = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = over_blocks.over(before)
    if in_one_block(rows, keys, F.col(_BLOCK)):
        kind = per_block.select(carry.alias("__carry")).schema["__carry"].dataType
        return rows.withColumn("__carry", F.lit(None).cast(kind))
    return _carried(rows, keys, per_block, carry)


def _inside(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, _BLOCK).orderBy(*order)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, block: Column, name: str,
    written: bool = False,
) -> DataFrame:
    """Sum of ``value`` up to and including each row of its group. ``written``: ``df`` has its lineage cut already."""
    valued = df.withColumn("__value", value)
    out = _with_carry(valued, keys, block, F.sum("__value"), F.sum("__summary"), written)
    inside = F.sum("__value").over(_inside(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn(name, inside + F.coalesce("__carry", F.lit(0))).drop(
        "__value", "__carry", _BLOCK
    )


def last_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, block: Column, name: str
) -> DataFrame:
    """Latest non-null ``value`` at or above each row of its group."""
    valued = df.withColumn("__value", value)
    newest = F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(*order)))
    out = _with_carry(valued, keys, block, newest, F.last("__summary", ignorenulls=True))
    inside = F.last("__value", ignorenulls=True).over(
        _inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return out.withColumn(name, F.coalesce(inside, "__carry")).drop("__value", "__carry", _BLOCK)


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, block: Column, name: str
) -> DataFrame:
    """``value`` of the row before, NULL on the first row of a group."""
    valued = df.withColumn("__value", value)
    out = _with_carry(valued, keys, block, F.max_by("__value", F.struct(*order)), F.last("__summary"))
    inside = _inside(keys, order)
    lagged = F.when(F.row_number().over(inside) == 1, F.col("__carry")).otherwise(
        F.lag("__value").over(inside)
    )
    return out.withColumn(name, lagged).drop("__value", "__carry", _BLOCK)


def next_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, block: Column, name: str
) -> DataFrame:
    """``value`` of the row after, NULL on the last row of a group."""
    rows = blocked(df.withColumn("__value", value), keys, block)
    per_block = rows.groupBy(*keys, _BLOCK).agg(F.min_by("__value", F.struct(*order)).alias("__summary"))
    over = Window.partitionBy(*keys).orderBy(_BLOCK)
    out = _carried(rows, keys, per_block, F.lead("__summary").over(over))
    inside = _inside(keys, order)
    led = F.when(F.lead(F.lit(1)).over(inside).isNull(), F.col("__carry")).otherwise(F.lead("__value").over(inside))
    return out.withColumn(name, led).drop("__value", "__carry", _BLOCK)


def in_even_blocks(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, Column]:
    """Rows numbered in a total order, and blocks of at most ``BLOCK_ROWS`` of them, whatever the keys are.

    The order begins with the keys. Its range partitions follow a sample, so rows of one key and one
    moment, however many, are spread over tasks, and the blocks are cut at row numbers.
    """
    return numbered(df, order, "__row"), row_block("__row")


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Number all rows from 0 in a total order without a one-task window.

    The rows are range-partitioned and sorted, written to the checkpoint folder with their
    place inside the partition, and shifted by the sizes of the partitions before. ``df``
    should be narrow, and its order unique: then the numbers depend on the data alone.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__id", 33))
        .withColumn("__place", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__id")
    )
    kept = cut_lineage(placed)
    sizes = kept.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__shift")
    )
    return (
        kept.join(F.broadcast(shifts), "__part")  # one row per shuffle partition
        .withColumn(name, F.col("__shift") + F.col("__place"))
        .drop("__part", "__place", "__shift")
    )


def fixed_batches(df: DataFrame, size: int, position: str = "position", name: str = "batch_no") -> DataFrame:
    """Batches of ``size`` consecutive positions, numbered from 0."""
    return df.withColumn(name, F.floor(F.col(position) / size))
