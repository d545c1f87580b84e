"""Keeping hot keys from landing in one task.

A key is *hot* when it holds more rows than one task should take:
``max(min_rows, total / MAX_HOT)``. Fewer than ``MAX_HOT`` keys can hold more than
``total / MAX_HOT`` rows each, so anything kept per hot key is small whatever the
table's size. That bound is what makes collecting or broadcasting it safe.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.operators.scan import running_max

MAX_HOT = 4096
MIN_ROWS = 1_000_000


class _Heavy(NamedTuple):
    rows: DataFrame  # rows of key-hash buckets that hold more than one task's share
    n: int  # how many those are
    limit: int  # one task's share


def _heavy_rows(df: DataFrame, keys: Sequence[str], min_rows: int) -> _Heavy | None:
    """The rows among which any hot key must be, or None.

    The probe groups on a few thousand hash buckets, so its shuffle is small even for
    billions of keys; in the usual case it is the only extra job.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(4 * MAX_HOT))
    sizes = df.groupBy(bucket.alias("bucket")).count()
    top = sizes.agg(F.sum("count").alias("total"), F.max("count").alias("largest")).first()
    limit = max(min_rows, (top["total"] or 0) // MAX_HOT)
    if (top["largest"] or 0) <= limit:
        return None
    heavy = sizes.filter(F.col("count") > limit).collect()  # fewer than MAX_HOT rows
    rows = df.filter(bucket.isin([r["bucket"] for r in heavy]))
    return _Heavy(rows, sum(r["count"] for r in heavy), limit)


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = MIN_ROWS) -> DataFrame | None:
    """The hot keys with their row counts (fewer than MAX_HOT rows), or None."""
    heavy = _heavy_rows(df.select(*keys), keys, min_rows)
    if heavy is None:
        return None
    counts = heavy.rows.groupBy(*keys).agg(F.count("*").alias("rows"))
    counts = counts.filter(F.col("rows") > heavy.limit)
    rows = counts.collect()
    return df.sparkSession.createDataFrame(rows, counts.schema) if rows else None


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    """Equality of the key columns between two frames with distinct lineage."""
    cond = F.lit(True)
    for k in keys:
        pair = left[k].eqNullSafe(right[f"__{k}"]) if null_safe else left[k] == right[f"__{k}"]
        cond = cond & pair
    return cond


def _with_prefixed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__{k}" for k in keys})


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Join ``left`` to ``right``, which holds at most one row per key.

    Rows of hot keys skip the shuffle: their few right-hand rows are broadcast.
    All other rows take the ordinary join, whose strategy Spark picks from sizes.
    """
    right = _with_prefixed_keys(right, keys)
    drop = [f"__{k}" for k in keys]
    hot = hot_keys(left, keys, min_rows)

    def join(l: DataFrame, r: DataFrame) -> DataFrame:
        return l.join(r, same_keys(l, r, keys, null_safe), how).drop(*drop)

    if hot is None:
        return join(left, right)
    hot = F.broadcast(hot.select(*[F.col(k).alias(f"__{k}") for k in keys]))
    is_hot = same_keys(left, hot, keys, null_safe=True)
    of_hot = F.lit(True)
    for k in keys:
        of_hot = of_hot & right[f"__{k}"].eqNullSafe(hot[f"__{k}"])
    hot_right = F.broadcast(right.join(hot, of_hot, "left_semi"))  # one row per hot key
    hot_rows = join(left.join(hot, is_hot, "left_semi"), hot_right)
    return hot_rows.unionByName(join(left.join(hot, is_hot, "left_anti"), right))


def has_hot_key(df: DataFrame, keys: Sequence[str], min_rows: int = MIN_ROWS) -> bool:
    """Whether some key holds more rows than one task should take."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(4 * MAX_HOT))
    sizes = df.groupBy(bucket.alias("bucket")).count()
    if (sizes.agg(F.max("count")).first()[0] or 0) <= min_rows:
        return False
    return not df.groupBy(*keys).count().filter(F.col("count") > min_rows).isEmpty()


def latest_so_far(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str | Column, out: str, hot: bool, inclusive: bool = True, min_rows: int = MIN_ROWS
) -> DataFrame:
    """``max(value)`` over rows with the same keys up to this one in ``order``, or before it.

    ``value`` is usually a struct that starts with the time, making this "the latest row so far". Without a hot key
    this is one window over one shuffle, with one it is a scan over slices of the sorted rows, whatever their keys.
    """
    if hot:
        return running_max(df, keys, order, value, out, min_rows, inclusive)
    end = Window.currentRow if inclusive else -1
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    return df.withColumn(out, F.max(value).over(w))
