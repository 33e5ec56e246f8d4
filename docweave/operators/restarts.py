"""Ordered folds that restart when a measured distance passes a threshold.

Three jobs share this shape: pages packed into parts below a size, documents gathered into
batches of at least so many objects, repeats of a query silenced for a while after an answer.
Each row has two monotone readings on one axis. After a restart at row b, the next restart is
the first later row whose ``test`` reading lies beyond ``base(b)`` by the threshold.

A group is cut into blocks of positions. What a block does to the fold is a map from the base with which
it is entered to the base with which it is left, constant between the readings at which it can restart
first. Such maps compose, and composition is associative: runs of ``FAN`` blocks become one map, runs of
these one again, up to one per group; on the way down each run learns the entries of its parts. No task
holds more than ``FAN`` maps of a group, and each block marks its rows with the known entry.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.session import cut_lineage

BLOCK_ROWS = 65_536
FAN = 64


def _first_beyond(test: np.ndarray, start: int, base: float, limit: float, inclusive: bool) -> int:
    """First row from ``start`` on whose reading lies beyond ``base`` by ``limit``."""
    side = "left" if inclusive else "right"
    return start + int(np.searchsorted(test[start:], base + limit, side=side))


def _walk(base: np.ndarray, test: np.ndarray, first: int, limit: float, inclusive: bool) -> list[int]:
    """Rows that restart, from the row ``first`` on, found by jumps from one to the next."""
    marks = []
    row = first
    while row < len(test):
        marks.append(row)
        row = _first_beyond(test, row + 1, base[row], limit, inclusive)
    return marks


def _changes(frame: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Rows at which a group begins, in a frame that is ordered by group."""
    new = np.zeros(len(frame), dtype=bool)
    new[:1] = True
    for c in columns:
        values, before = frame[c].iloc[1:], frame[c].shift().iloc[1:]
        new[1:] |= ((values != before) & ~(values.isna() & before.isna())).to_numpy()
    return np.flatnonzero(new)


def block_map(base: np.ndarray, test: np.ndarray, limit: float, inclusive: bool) -> tuple[np.ndarray, np.ndarray]:
    """The map of a block: where it can restart first (readings), and the base it then ends with.

    An entry base is at most the first base of the block, so a first restart lies no later than
    the first row beyond that one. Chains of restarts are followed for all rows at once, by jumps
    that double.
    """
    n, side = len(test), "left" if inclusive else "right"
    rows = np.arange(n)
    follows = np.maximum(np.searchsorted(test, base + limit, side=side), rows + 1)
    last = np.where(follows < n, follows, rows)
    while True:
        farther = last[last]
        if (farther == last).all():
            break
        last = farther
    reach = min(_first_beyond(test, 0, base[0], limit, inclusive), n - 1) + 1
    return shortened(test[:reach], base[last[:reach]])


def shortened(tests: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces that end alike as one, known by its last reading."""
    keep = np.append(ends[1:] != ends[:-1], True)[: len(ends)]
    return tests[keep], ends[keep]


def mapped(tests: np.ndarray, ends: np.ndarray, entry: np.ndarray, limit: float, inclusive: bool) -> np.ndarray:
    """Bases with which blocks are left that were entered with ``entry``; no restart keeps the base."""
    at = np.searchsorted(tests, entry + limit, side="left" if inclusive else "right")
    return np.where(at < len(tests), ends[np.minimum(at, len(ends) - 1)], entry)


def composed(first: tuple, second: tuple, limit: float, inclusive: bool) -> tuple[np.ndarray, np.ndarray]:
    """The map of two successive blocks. Readings do not fall, so the pieces of the second come after."""
    (tests, ends), (later, last) = first, second
    beyond = later > tests[-1]
    return shortened(
        np.concatenate([tests, later[beyond]]),
        np.concatenate([mapped(later, last, ends, limit, inclusive), last[beyond]]),
    )


def _named(key: tuple) -> list:
    """Values of a group's key; NULLs of number columns come as NaN."""
    return [None if v is None or v != v else v for v in key]


def mark_restarts(
    df: DataFrame, keys: Sequence[str], position: str, base: str, test: str, limit: float,
    inclusive: bool = False, block_rows: int = BLOCK_ROWS, name: str = "restarts",
) -> DataFrame:
    """Add a boolean column that is true on the rows that restart their group's fold.

    ``position`` counts from 0 inside a group; ``base`` and ``test`` are bigint columns that do
    not fall along it. The first row of a group always restarts.
    """
    keys = list(keys)
    kept = cut_lineage(df.withColumn("__block", F.floor(F.col(position) / block_rows).cast("bigint")))
    entries = _entries(kept.select(*dict.fromkeys([*keys, "__block", position, base, test])), keys, position, base, test,
                       limit, inclusive)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, anchor = None, None
        for pdf in batches:
            if not len(pdf):
                continue
            bases, tests = pdf[base].to_numpy(), pdf[test].to_numpy()
            entries_of = pdf["__entry"].to_numpy(dtype=float, na_value=np.nan)
            flags = np.zeros(len(pdf), dtype=bool)
            starts = _changes(pdf, [*keys, "__block"])
            heads = pdf[[*keys, "__block"]].iloc[starts].astype(object)
            codes = heads.where(heads.notna(), None).values.tolist()
            for code, a, b in zip(codes, starts.tolist(), [*starts[1:].tolist(), len(pdf)]):
                if code != group:
                    group, anchor = code, None if np.isnan(entries_of[a]) else int(entries_of[a])
                first = 0 if anchor is None else _first_beyond(tests[a:b], 0, anchor, limit, inclusive)
                marks = _walk(bases[a:b], tests[a:b], first, limit, inclusive)
                flags[a + np.array(marks, dtype=int)] = True
                if marks:
                    anchor = bases[a + marks[-1]]
            yield pdf.drop(columns=["__entry", "__block"]).assign(**{name: flags})

    if entries is None:
        joined = kept.withColumn("__entry", F.lit(None).cast("bigint"))
    else:
        same = [kept[c].eqNullSafe(entries[f"__of_{c}"]) for c in (*keys, "__block")]
        joined = kept.join(entries, same, "left").drop(*[f"__of_{c}" for c in (*keys, "__block")])
    ordered = joined.repartition(*keys, "__block").sortWithinPartitions(*keys, "__block", position)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.BooleanType())])
    columns = [*df.columns, "__block", "__entry"]
    return ordered.select(*columns).mapInPandas(mark, schema)


def _entries(
    narrow: DataFrame, keys: list[str], position: str, base: str, test: str, limit: float, inclusive: bool
) -> DataFrame | None:
    """The base with which each block of a long group is entered; None where all groups are one block."""
    top = narrow.agg(F.max("__block")).first()[0]
    if not top:
        return None
    key_fields = [f for f in narrow.schema.fields if f.name in keys]
    kinds = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("__tests", "__ends")]
    map_schema = T.StructType([*key_fields, T.StructField("__block", T.LongType()), *kinds])
    entry_schema = T.StructType([*key_fields, T.StructField("__block", T.LongType()), T.StructField("__entry", T.LongType())])

    def report(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(position)
        tests, ends = block_map(pdf[base].to_numpy(), pdf[test].to_numpy(), limit, inclusive)
        return pd.DataFrame([[*_named(key), tests.tolist(), ends.tolist()]])

    def maps(pdf: pd.DataFrame) -> list[tuple[int, tuple]]:
        ordered = pdf.sort_values("__block")
        return [
            (block, (np.asarray(tests, dtype=np.int64), np.asarray(ends, dtype=np.int64)))
            for block, tests, ends in zip(ordered["__block"], ordered["__tests"], ordered["__ends"], strict=True)
        ]

    def compose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for _, part in maps(pdf):
            whole = part if whole is None else composed(whole, part, limit, inclusive)
        return pd.DataFrame([[*_named(key), whole[0].tolist(), whole[1].tolist()]])

    def descend(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows, entry = [], None if pdf["__entry"].isna().iloc[0] else int(pdf["__entry"].iloc[0])
        for block, (tests, ends) in maps(pdf):
            rows.append([*_named(key)[:-1], block, entry])
            # The very first row of a group restarts it: any base before it gives that piece.
            entry = int(ends[0]) if entry is None else int(mapped(tests, ends, np.array([entry]), limit, inclusive)[0])
        out = pd.DataFrame(rows, columns=[*keys, "__block", "__entry"])
        out["__entry"] = out["__entry"].astype("Int64")
        return out

    long_keys = narrow.filter(F.col("__block") > 0).select(*[F.col(c).alias(f"__of_{c}") for c in keys]).distinct()
    same = [narrow[c].eqNullSafe(long_keys[f"__of_{c}"]) for c in keys]
    levels = [cut_lineage(narrow.join(long_keys, same, "left_semi").groupBy(*keys, "__block").applyInPandas(report, map_schema))]
    while top >= FAN:
        runs = levels[-1].withColumn("__run", F.floor(F.col("__block") / FAN).cast("bigint"))
        composed_runs = runs.groupBy(*keys, "__run").applyInPandas(
            compose, T.StructType([*key_fields, T.StructField("__run", T.LongType()), *kinds])
        )
        levels.append(cut_lineage(composed_runs.withColumnRenamed("__run", "__block")))
        top //= FAN
    entries = levels[-1].select(*keys, F.lit(0).cast("bigint").alias("__block")).distinct().withColumn(
        "__entry", F.lit(None).cast("bigint")
    )
    for level in reversed(levels):
        above = entries.select(*[F.col(c).alias(f"__of_{c}") for c in keys], F.col("__block").alias("__run"), "__entry")
        parts = level.withColumn("__above", F.floor(F.col("__block") / FAN).cast("bigint"))
        same = [parts[c].eqNullSafe(above[f"__of_{c}"]) for c in keys]
        met = parts.join(above, [*same, parts["__above"] == above["__run"]]).select(*keys, "__run", "__block", "__tests", "__ends", "__entry")
        entries = met.groupBy(*keys, "__run").applyInPandas(descend, entry_schema)
    return entries.select(*[F.col(c).alias(f"__of_{c}") for c in (*keys, "__block")], "__entry")
