"""What a customer or terminal did in the days before: counts and means over a trailing range of time.

Transactions of one key and second are summed first, so a key's table grows with time and not with traffic. Time is cut into
slices of fixed width, and a slice gets the rows of the range before it as a *halo* that is read but not returned. So a
window holds the seconds of one slice and its halo at most, however many rows a key has.

A slice is cut into blocks as long as the range. The range of a row is the end of the block before and the start of its own, so two
running sums that restart with each block give it: the work is one step per second, not per pair of seconds, and nothing is subtracted.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.operators.skew import MIN_ROWS, lookup_join

WEEK = timedelta(days=7)
SLICE = timedelta(days=28)


def trailing(
    rows: DataFrame, keys: Sequence[str], ts: str, value: str, length: timedelta = WEEK, width: timedelta = SLICE
) -> DataFrame:
    """(keys..., ts, n, mean): per key and instant, how many rows the key has in the ``length`` up to and including the instant, and
    the mean of their values. The row ``length`` before it counts. Instants are whole seconds; rows without a
    key or time are left out, a missing value counts as a row but not in the mean.

    ``width`` only balances the work and should be no less than ``length``: then a row is in two slices at most.
    """
    span, size = int(length.total_seconds()), int(width.total_seconds())
    if size < span:
        raise ValueError("a slice must be as long as the range at least")
    usable = rows
    for c in (*keys, ts):
        usable = usable.filter(F.col(c).isNotNull())
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    instants = usable.groupBy(*keys, at.alias("__at")).agg(
        F.count("*").alias("__n"), F.count(value).alias("__known"), F.sum(value).alias("__sum")
    )
    own = F.floor(F.col("__at") / size)
    reaches = F.floor((F.col("__at") + span) / size)  # the last slice that looks back to this row
    copies = instants.withColumn("__own", own).withColumn("__slice", F.explode(F.sequence(own, reaches)))
    # a row counts in its own block and, moved on by the range, in the next one: rows up to that time still see it;
    # the shuffle by slice serves both windows
    moved = F.explode(F.array(F.lit(False), F.lit(True)))
    shared = copies.repartition(*keys, "__slice").withColumn("__moved", moved)
    placed = shared.withColumn("__at", F.when(F.col("__moved"), F.col("__at") + span).otherwise(F.col("__at")))
    placed = placed.withColumn("__block", F.floor(F.col("__at") / span))
    block = Window.partitionBy(*keys, "__slice", "__block")
    upto = block.orderBy("__at").rangeBetween(Window.unboundedPreceding, 0)
    since = block.orderBy(F.desc("__at")).rangeBetween(Window.unboundedPreceding, 0)
    sums = ("__n", "__known", "__sum")
    parts = {f"{c}_own": F.sum(F.when(~F.col("__moved"), F.col(c))).over(upto) for c in sums}
    parts |= {f"{c}_before": F.sum(F.when(F.col("__moved"), F.col(c))).over(since) for c in sums}
    both = placed.withColumns(parts).filter("not __moved and __own = __slice")

    def total(c: str) -> Column:
        return F.coalesce(F.col(f"{c}_own") + F.col(f"{c}_before"), f"{c}_own", f"{c}_before").alias(c)

    mine = both.select(*keys, "__at", *[total(c) for c in sums])
    mean: Column = F.try_divide("__sum", "__known")
    return mine.select(*keys, F.timestamp_seconds("__at").alias(ts), F.col("__n").alias("n"), mean.alias("mean"))


def with_trailing(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    prefix: str,
    length: timedelta = WEEK,
    width: timedelta = SLICE,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """The rows with ``<prefix>_n`` and ``<prefix>_mean``, null where a key or the time is missing."""
    second = F.date_trunc("second", F.col(ts).cast("timestamp"))
    found = trailing(rows, keys, ts, value, length, width).withColumnsRenamed({ts: "__second", "n": f"{prefix}_n", "mean": f"{prefix}_mean"})
    return lookup_join(rows.withColumn("__second", second), found, [*keys, "__second"], "left", min_rows=min_rows).drop("__second")


def quantile_time(rows: DataFrame, ts: str, share: float):
    """The earliest time by which at least that share of the rows has happened, exactly, as microseconds since 1970; None without rows.

    Nothing is sorted: counts per day find the day, counts per second the second, counts per microsecond the time.
    """
    at = rows.filter(F.col(ts).isNotNull()).select(F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
    wanted, low = None, 0
    for unit in (86_400_000_000, 1_000_000, 1):
        # at most 86,400 or a million groups, but for the days, of which there is one per day covered
        counts = at.groupBy(F.floor(F.col("at") / unit).alias("step")).count()
        upto = F.sum("count").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
        if wanted is None:
            total = at.count()
            if not total:
                return None
            wanted = max(1, -int(-(share * total) // 1))
        found = counts.withColumn("upto", upto).filter(F.col("upto") >= wanted - low).orderBy("step").first()
        low += found["upto"] - found["count"]
        at = at.filter((F.col("at") >= found["step"] * unit) & (F.col("at") < (found["step"] + 1) * unit))
    return found["step"]


def time_split(rows: DataFrame, ts: str, train: float = 0.7, valid: float = 0.15) -> DataFrame:
    """The rows with a ``side``: train up to the time by which that share has happened, then valid, then test. Rows of one time stay
    together, on the earlier side; rows without a time have no side."""
    cuts = [quantile_time(rows, ts, share) for share in (train, train + valid)]
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    if cuts[0] is None:
        return rows.withColumn("side", F.lit(None).cast("string"))
    side = F.when(at.isNull(), F.lit(None)).when(at <= cuts[0], "train").when(at <= cuts[1], "valid").otherwise("test")
    return rows.withColumn("side", side)


def drift(rows: DataFrame, period: Column, value: str, bounds: Sequence[float], baseline: Column) -> DataFrame:
    """(period, rows, psi): how far each period's values have moved from those of the baseline rows (``baseline`` is a condition).

    The population-stability index over the bins between ``bounds``, and one more for missing values. A
    share of 0 counts as half a row, so that the index stays finite. Counts add up, so days can be counted apart and summed.
    """
    number = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        number = F.when(F.col(value) < float(bounds[i]), F.lit(i)).otherwise(number)
    bins = len(bounds) + 2
    number = F.when(F.col(value).isNull() | F.isnan(F.col(value).cast("double")), F.lit(bins - 1)).otherwise(number)
    counted = rows.select(period.alias("period"), number.alias("bin"), baseline.alias("base"))
    per_period = counted.groupBy("period").agg(
        F.count("*").alias("rows"), *[F.count_if(F.col("bin") == i).alias(f"n{i}") for i in range(bins)]
    )
    base = counted.filter("base").agg(
        F.count("*").alias("total"), *[F.count_if(F.col("bin") == i).alias(f"b{i}") for i in range(bins)]
    ).first()  # one row

    def term(i: int) -> Column:
        now = F.greatest(F.col(f"n{i}").cast("double"), F.lit(0.5)) / F.col("rows")
        then = max(base[f"b{i}"], 0.5) / max(base["total"], 1)
        both_empty = (F.col(f"n{i}") == 0) & F.lit(base[f"b{i}"] == 0)
        return F.when(both_empty, 0.0).otherwise((now - then) * F.log(now / then))

    return per_period.select("period", "rows", sum((term(i) for i in range(bins)), F.lit(0.0)).alias("psi"))


def even_bounds(rows: DataFrame, value: str, bins: int = 10, accuracy: int = 10_000) -> list[float]:
    """Bounds that cut the values in about equal parts: quantiles of a mergeable sketch, exact to one part in ``accuracy``."""
    cuts = rows.agg(F.percentile_approx(value, [i / bins for i in range(1, bins)], accuracy)).first()[0]
    return sorted({float(c) for c in cuts or []})


def pseudonym(value: Column, salt: str) -> Column:
    """A salted SHA-256 of the value as text, the same wherever it stands; a missing value stays missing."""
    return F.when(value.isNotNull(), F.sha2(F.concat(F.lit(salt), F.lit(":"), value.cast("string")), 256))
