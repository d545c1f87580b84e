"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the project's defaults; keyword arguments override them.

    Shuffle partition count is left to the cluster: adaptive execution coalesces
    small partitions, so a generous starting number is safe.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # streaming state outgrows the heap at scale
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Timestamp parsing, formatting and hour() all depend on the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the cluster's shared checkpoint folder.

    Falls back to a local temporary folder only where the session names none and everything
    runs on one machine. On a cluster that would leave each executor's part on its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master!r})")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the scratch folder and go on from there: what reads it more than once does not
    recompute it, and if an executor is lost its tasks reread the table."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
