"""Rates, totals, quantiles and sustained-condition alerts over event and sample logs."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.operators.skew import MIN_ROWS, has_hot_key, latest_so_far
from ledgerlens.session import stored


def _text(t: timedelta) -> str:
    return f"{int(t.total_seconds())} seconds"


def window_of(ts: str, length: timedelta, step: timedelta | None = None) -> Column:
    """Tumbling windows, or sliding ones when ``step`` is given."""
    return F.window(ts, _text(length), _text(step) if step else None)


def _sliding(events: DataFrame, ts: str, length: timedelta, step: timedelta, by: Sequence[str], value: Column) -> DataFrame:
    """(w, by..., total): sums over sliding windows of a table, put together from the sums of one step each.

    Rows are summed once per step, their *pane*; only panes are copied to the windows they belong to.
    """
    width, hop = int(length.total_seconds()), int(step.total_seconds())
    panes = events.groupBy(window_of(ts, step).alias("pane"), *by).agg(value.alias("part"))
    offsets = F.array(*[F.lit(k * hop) for k in range(width // hop)])
    copies = panes.select(*by, "part", F.unix_seconds("pane.start").alias("at"), F.explode(offsets).alias("back"))
    start = F.timestamp_seconds(F.col("at") - F.col("back"))
    window = F.struct(start.alias("start"), F.timestamp_seconds(F.col("at") - F.col("back") + width).alias("end"))
    return copies.groupBy(window.alias("w"), *by).agg(F.sum("part").alias("total"))


def _in_panes(df: DataFrame, length: timedelta, step: timedelta | None) -> bool:
    """Whether windows are made of whole steps; a stream has its own windows."""
    return step is not None and not df.isStreaming and step < length and length % step == timedelta(0)


def event_rate(
    events: DataFrame,
    ts: str,
    length: timedelta,
    step: timedelta | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Events per second in each window (and category). Batch or stream; on a stream set a
    watermark first."""
    if _in_panes(events, length, step):
        grouped = _sliding(events, ts, length, step, by, F.count("*")).withColumnRenamed("total", "events")
    else:
        grouped = events.groupBy(window_of(ts, length, step).alias("w"), *by).agg(F.count("*").alias("events"))
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *by,
        "events",
        (F.col("events") / length.total_seconds()).alias("per_second"),
    )


def outcome_counts(scored: DataFrame, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """How many rows were scored and how many were called fraud. Batch or stream."""
    return scored.groupBy(*by).agg(
        F.count("*").alias("predictions_total"),
        F.count_if(F.col(prediction) == 1).alias("fraud_predictions_total"),
    )


def counter_increases(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """(series..., ts, value, increase): growth of a cumulative counter since its previous
    sample. A drop means the counter restarted from 0. The first sample has no increase.

    Samples of one series and instant count once, by their largest value.
    """
    hot = has_hot_key(samples, series, min_rows)
    if not hot:
        # one shuffle by series serves both the grouping and the window below
        samples = samples.repartition(*series)
    once = samples.groupBy(*series, F.col(ts)).agg(F.max(value).alias(value))
    once = stored(once, "samples") if hot else once
    seen = latest_so_far(once, series, [ts], F.struct(ts, value), "__previous", hot, inclusive=False, min_rows=min_rows)
    before = F.col("__previous")[value]
    grown = F.when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    return seen.select(*series, ts, value, F.when(before.isNotNull(), grown).alias("increase"))


def counter_rate(
    increases: DataFrame,
    length: timedelta,
    by: Sequence[str] = (),
    step: timedelta | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Increase per second in each window. No extrapolation to the window's edges."""
    if _in_panes(increases, length, step):
        grouped = _sliding(increases, ts, length, step, by, F.sum("increase"))
    else:
        grouped = increases.groupBy(window_of(ts, length, step).alias("w"), *by).agg(F.sum("increase").alias("total"))
    grouped = grouped.withColumn("per_second", F.col("total") / length.total_seconds())
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "per_second"
    )


def bucket_counts(
    events: DataFrame, ts: str, value: str, length: timedelta, bounds: Sequence[float]
) -> DataFrame:
    """Cumulative histogram per window: (window_start, le, n) with an infinite last bound."""
    le = [*bounds, math.inf]
    wide = events.groupBy(window_of(ts, length).alias("w")).agg(
        *[F.count_if(F.col(value) <= b).alias(f"le{i}") for i, b in enumerate(le)]
    )
    pairs = [F.struct(F.lit(float(b)).alias("le"), F.col(f"le{i}").alias("n")) for i, b in enumerate(le)]
    return wide.select(F.col("w.start").alias("window_start"), F.inline(F.array(*pairs)))


def histogram_quantile(
    buckets: DataFrame, q: float, by: Sequence[str], le: str = "le", n: str = "n"
) -> DataFrame:
    """(by..., quantile) from cumulative buckets, linear inside the bucket that holds it.

    The lowest bucket starts at 0. In the infinite bucket the answer is the highest finite
    bound. An empty histogram gives NULL. A group holds one row per bound.
    """
    ordered = Window.partitionBy(*by).orderBy(le)
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = buckets.select(
        *by,
        F.col(le).alias("hi"),
        F.col(n).cast("double").alias("upto"),
        F.lag(le).over(ordered).alias("lo"),
        F.coalesce(F.lag(n).over(ordered).cast("double"), F.lit(0.0)).alias("below"),
        (F.lit(q) * F.last(n).over(everything)).alias("rank"),
    )
    holds = (F.col("rank") > 0) & (F.col("upto") >= F.col("rank"))
    picked = placed.groupBy(*by).agg(F.min(F.when(holds, F.struct("hi", "lo", "upto", "below", "rank"))).alias("b"))
    b = F.col("b")
    share = (b["rank"] - b["below"]) / F.nullif(b["upto"] - b["below"], F.lit(0.0))
    lo = F.coalesce(b["lo"], F.lit(0.0))
    quantile = (
        F.when(b["hi"] == math.inf, b["lo"])
        .when(b["lo"].isNull() & (b["hi"] <= 0), b["hi"])
        .otherwise(lo + (b["hi"] - lo) * share)
    )
    return picked.select(*by, quantile.alias("quantile"))


def latest_samples(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Last value of each series."""
    newest = F.max(F.struct(ts, value)).alias("s")
    return samples.groupBy(*series).agg(newest).select(*series, f"s.{ts}", f"s.{value}")


def counter_total(
    samples: DataFrame, series: Sequence[str], by: Sequence[str] = (), ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Sum over instances of each series' last value."""
    return latest_samples(samples, series, ts, value).groupBy(*by).agg(F.sum(value).alias("total"))


def gauge(
    samples: DataFrame, length: timedelta, series: Sequence[str], ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Last value of each series in each window."""
    windowed = samples.withColumn("w", window_of(ts, length))
    newest = F.max(F.struct(ts, value)).alias("s")
    grouped = windowed.groupBy("w", *series).agg(newest)
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *series,
        F.col(f"s.{value}").alias(value),
    )


def utilisation(rates: DataFrame, limits: DataFrame, key: str = "pod") -> DataFrame:
    """Each rate divided by its pod's limit; rates without a limit are left out.

    Rates hold one row per pod and window, so a pod's group is as long as the time covered;
    a plain equi-join is enough, and Spark broadcasts the limits if they are small.
    """
    joined = rates.join(limits.select(key, "limit"), key)
    return joined.withColumn("utilisation", F.col("per_second") / F.col("limit")).drop("limit")


def sustained(
    met: DataFrame, step: timedelta, hold: timedelta, by: Sequence[str] = (), at: str = "at"
) -> DataFrame:
    """(by..., since, until, steps) of unbroken runs that last at least ``hold``.

    ``met`` has one row per evaluation step (and ``by``) at which the condition held; a
    missing step breaks the run. Rows are steps of time, not events, so a group is only as
    long as the time covered.
    """
    width = int(step.total_seconds())
    keys = list(by) or ["__all"]
    met = met if by else met.withColumn("__all", F.lit(0))
    tick = F.unix_seconds(F.col(at)) / F.lit(width)
    w = Window.partitionBy(*keys).orderBy(at)
    runs = met.withColumn("__run", F.floor(tick) - F.row_number().over(w))
    grouped = runs.groupBy(*keys, "__run").agg(
        F.min(at).alias("since"), F.max(at).alias("until"), F.count("*").alias("steps")
    )
    lasting = F.unix_seconds("until") - F.unix_seconds("since") >= F.lit(int(hold.total_seconds()))
    return grouped.filter(lasting).select(*by, "since", "until", "steps")


def overload_alert(
    cpu: DataFrame,
    limits: DataFrame,
    replicas: DataFrame,
    length: timedelta = timedelta(minutes=5),
    step: timedelta = timedelta(minutes=1),
    hold: timedelta = timedelta(minutes=5),
    max_replicas: int = 6,
    busy: float = 0.8,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Times when all replicas were up while a pod ran above ``busy`` of its limit, for at
    least ``hold``.

    ``cpu``: counter samples (pod, ts, value); ``limits``: (pod, limit); ``replicas``: gauge
    samples (deployment, ts, value). Evaluated every ``step``; usage is the rate over the
    ``length`` before it. The two sides are matched on time only.
    """
    increases = counter_increases(cpu, ["pod"], min_rows=min_rows)
    usage = utilisation(counter_rate(increases, length, ["pod"], step), limits)
    busiest = usage.groupBy(F.col("window_end").alias("at")).agg(F.max("utilisation").alias("peak"))
    hot_times = busiest.filter(F.col("peak") > busy)
    full = gauge(replicas, step, ["deployment"]).filter(F.col("value") == max_replicas)
    met = full.select("deployment", F.col("window_end").alias("at")).join(hot_times, "at", "left_semi")
    return sustained(met, step, hold, ["deployment"])
