"""Alerts, bursts and repeat suppression on streams of log rows.

State of single keys lives in Spark's state store, with timers and times to live; it needs the RocksDB
provider, which ``build_session`` sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docweave.functions import values


class _Silence(StatefulProcessor):
    """Per service: its newest success, and a timer at the moment from which it has been silent too long."""

    def __init__(self, limit_ms: int, patience_ms: int):
        self.limit_ms, self.patience_ms = limit_ms, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "ms long")
        self.due = handle.getValueState("due", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.newest.get()[0] if self.newest.exists() else None
        # A silence that was alerted already has no timer; only its end is news.
        alerted = before is not None and not self.due.exists()
        seen = np.concatenate([pdf["ms"].to_numpy() for pdf in rows])
        seen = np.unique(seen if before is None else np.append(seen[seen > before], before))
        gaps = np.flatnonzero(np.diff(seen) > self.limit_ms)
        gaps = gaps[gaps > 0] if alerted else gaps
        newest = int(seen[-1])
        if newest != before:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            due = max(newest + self.limit_ms, timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)
            self.handle.registerTimer(due)
            self.newest.update((newest,))
            self.due.update((due,))
        yield _alerts(key, seen[gaps], seen[gaps] + self.limit_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        newest = self.newest.get()[0]
        self.due.clear()
        yield _alerts(key, np.array([newest]), np.array([newest + self.limit_ms]))

    def close(self) -> None:
        pass


def _alerts(key: tuple, since: np.ndarray, alert_at: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({
        "service": pd.Series([key[0]] * len(since), dtype=object), "since": pd.to_datetime(since, unit="ms"), "alert_at": pd.to_datetime(alert_at, unit="ms"),
    })


def silence_alerts(successes: DataFrame, limit_seconds: int = 86_400, patience_seconds: int = 600) -> DataFrame:
    """(service, since, alert_at): a row once no success followed for the limit.

    A processing-time timer of each service fires also when all input has stopped, so the alert does
    not wait for a watermark. A silence that ended before its rows were read is reported with them.
    After rows that come late, the timer waits ``patience_seconds`` for more. One alert for a silence.
    Rows without a service are those of one; rows without a time are left out.
    """
    timed = successes.filter(F.col("ts").isNotNull()).select("service", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return timed.groupBy("service").transformWithStateInPandas(
        _Silence(limit_seconds * 1000, patience_seconds * 1000), "service string, since timestamp, alert_at timestamp",
        "Append", "ProcessingTime",
    )


def hourly_alerts(logs: DataFrame, pattern: str, level: str = "ERROR", lateness: str = "1 hour") -> DataFrame:
    """At most one alert an hour and service, for a severity reached or a text matched.

    All rows are grouped and the hits counted inside: a filter would sink below the watermark,
    which must also move on rows that match nothing.
    """
    at_least = values.SEVERITIES[values.SEVERITIES.index(level):]
    hit = F.coalesce(F.col("severity").isin(*at_least) | F.col("message").rlike(pattern), F.lit(False))
    hours = logs.withWatermark("ts", lateness).groupBy("service", F.window("ts", "1 hour").alias("hour")).agg(
        F.min(F.when(hit, F.col("ts"))).alias("first_ts"), F.count_if(hit).alias("matches")
    )
    return hours.filter("matches > 0").select("service", F.col("hour.start").alias("hour"), "first_ts", "matches")


def query_bursts(calls: DataFrame, gap: str = "60 seconds", lateness: str = "10 minutes") -> DataFrame:
    """Runs of one query with no gap as long as ``gap`` between calls."""
    sessions = calls.withWatermark("ts", lateness).groupBy("query_text", F.session_window("ts", gap).alias("burst"))
    return sessions.agg(F.count(F.lit(1)).alias("calls")).select(
        "query_text", F.col("burst.start").alias("started"), F.col("burst.end").alias("ended"), "calls"
    )


class _Answers(StatefulProcessor):
    """Per key: when it was answered last. The state store forgets it after ``keep_ms``."""

    def __init__(self, columns: list[str], ttl_micros: int, keep_ms: int):
        self.columns, self.ttl_micros, self.keep_ms = columns, ttl_micros, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "micros long", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        calls = pd.concat(list(rows)).sort_values(["micros", "event_id"], kind="stable")
        micros = calls["micros"].to_numpy()
        row, answered = 0, []
        if self.last.exists():
            row = int(np.searchsorted(micros, self.last.get()[0] + self.ttl_micros, side="right"))
        while row < len(micros):  # from one answer to the next
            answered.append(row)
            row = int(np.searchsorted(micros, micros[row] + self.ttl_micros, side="right"))
        if answered:
            self.last.update((int(micros[answered[-1]]),))
        chosen = calls.iloc[answered][self.columns]
        texts = [c for c in chosen if pd.api.types.is_string_dtype(chosen[c])]
        # Texts go back as plain objects; Spark's writer takes no chunked arrays.
        yield chosen.astype(dict.fromkeys(texts, object)).reset_index(drop=True)

    def close(self) -> None:
        pass


def suppress_repeats(calls: DataFrame, keys: list[str], ttl_seconds: int = 60, keep_seconds: int = 3600) -> DataFrame:
    """Answered calls of a stream: those that the batch form marks, for rows that come in time order.

    The last answer of a key is a value in the state store. It expires ``keep_seconds`` after it was
    written, by the clock: as long as the feed may lag behind, and never less than the time to live.
    A task holds the times and ids of one key of one micro-batch.
    """
    columns = [*keys, "ts", "event_id"]
    timed = calls.select(*columns, F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    schema = T.StructType([timed.schema[c] for c in columns])
    processor = _Answers(columns, ttl_seconds * 1_000_000, max(keep_seconds, ttl_seconds) * 1000)
    return timed.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "ProcessingTime")
