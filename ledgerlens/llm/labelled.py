"""Folds, bounded samples and exact ranks of labelled rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.store import stored
from ledgerlens.operators.scan import running_sums


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def sample(labels: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those whose key hashes least: the same ones however the table is laid out."""
    return labels.orderBy(F.xxhash64(key), key).limit(most)


def at_ranks(values: DataFrame, wanted: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks (from 1, least first) of each group of (group, value) rows, exactly; ranks beyond a group are left out.

    Values are counted and sorted by Spark; only those asked for come to the driver.
    """
    counts = stored(values.toDF("of", "value").groupBy("of", "value").agg(F.count("*").alias("n")), "value-counts")
    asked = values.sparkSession.createDataFrame([(of, k) for of, ks in wanted.items() for k in sorted({*ks})], "asked string, rank long")
    ranked = running_sums(counts, ["of"], ["value"], {"n": "upto"})
    held = (F.col("of") == F.col("asked")) & (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))
    return {(r["of"], r["rank"]): r["value"] for r in ranked.join(F.broadcast(asked), held).select("of", "rank", "value").collect()}
