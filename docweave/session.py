"""Session set-up and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "docweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings win where given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Streams with timers or a time to live keep their state in it.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for tables that cut lineage.

    It is the one the session names in ``spark.checkpoint.dir``. Where none is named, a local
    master gets a temporary one; on a cluster, whose machines share no such folder, it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="docweave-checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back.

    The lineage ends there, so a lost executor repeats no work before it.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
