"""File scans, file sinks and incremental file discovery."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.schemas import RAW
from ledgerlens.sources.manifest import file_system


def read_raw(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header-less CSV with '#' comment lines; a path, a glob, or a list of them.

    A field that does not fit its type is NULL, as is one missing from a short row.
    """
    reader = spark.read.schema(RAW).option("header", False).option("comment", "#")
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def write_raw(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """The raw layout: every file starts with a '#' line of column names.

    The writer puts quotes around a line start that looks like a comment, so it is told
    that comments look different.
    """
    first, *rest = RAW.fieldNames()
    columns = [F.col(first).alias(f"# {first}"), *rest, *partition_by]
    writer = df.select(*columns).write.mode("overwrite").partitionBy(*partition_by)
    writer.option("header", True).option("comment", "!").csv(path)


def write_clean(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by transaction date, so that reads prune.

    The rebalance groups a date's rows into few files and splits a date that is too big
    for one task.
    """
    dated = df.withColumn("tx_date", F.to_date("tx_datetime"))
    dated.hint("rebalance", "tx_date").write.mode(mode).partitionBy("tx_date").parquet(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def replace_dates(df: DataFrame, path: str, dates: Sequence[str]) -> None:
    """Write cleaned rows in place of those of the given dates and of their own dates; other dates stay as they are.

    ``df`` must not read ``path``. The new files of all dates are complete before the first old one goes.
    """
    spark = df.sparkSession
    dated = df.withColumn("tx_date", F.to_date("tx_datetime"))
    writer = dated.hint("rebalance", "tx_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("tx_date").parquet(path)
    left = {str(r["tx_date"]) for r in dated.select("tx_date").distinct().collect()}  # one row per date
    for date in set(dates) - left:
        fs, at = file_system(spark, os.path.join(path, f"tx_date={date}"))
        fs.delete(at, True)


# ------------------------------------------------------------ incremental files


def list_files(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(file) names of a folder. Only the listing is used; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"))


def new_files(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that the manifest does not hold."""
    return listing.select("file").distinct().join(manifest.select("file"), "file", "left_anti")


# ------------------------------------------------------------ run log


def run_log_rows(facts: DataFrame, run_id: str, kind: str) -> DataFrame:
    """(run_id, kind, key, value) rows from a one-row frame of parameters or metrics."""
    text = facts.select(*[F.col(c).cast("string").alias(c) for c in facts.columns])
    rows = text.unpivot([], text.columns, "key", "value")
    return rows.select(F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"), "key", "value")


def append_run_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_error_text(errors: DataFrame, path: str) -> None:
    """Append one-column error lines as text."""
    errors.write.mode("append").text(path)
