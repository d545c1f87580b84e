"""Point-in-time and latest-value feature retrieval, and on-demand scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions import zero_if_missing
from ledgerlens.operators.skew import MIN_ROWS, has_hot_key, latest_so_far, lookup_join
from ledgerlens.session import stored


@dataclass(frozen=True)
class FeatureView:
    """Named fields of a feature table, with how long a value stays usable.

    Views with the same ``source`` name read the same table and are looked up in one pass.
    """

    name: str
    source: str
    fields: Sequence[str]
    keys: Sequence[str] = ("driver_id",)
    event_ts: str = "event_timestamp"
    created: str = "created"
    ttl: timedelta | None = None


# The two views over the driver statistics, each valid for three years.
DRIVER_EFFICIENCY = FeatureView(
    "driver_efficiency", "driver_stats", ("conv_rate", "acc_rate"), ttl=timedelta(days=3 * 365)
)
DRIVER_ACTIVITY = FeatureView(
    "driver_activity", "driver_stats", ("avg_daily_trips",), ttl=timedelta(days=3 * 365)
)


def _by_source(views: Sequence[FeatureView]) -> dict[str, list[FeatureView]]:
    groups: dict[str, list[FeatureView]] = {}
    for view in views:
        groups.setdefault(view.source, []).append(view)
    return groups


def _fields(views: Sequence[FeatureView]) -> list[str]:
    return list(dict.fromkeys(f for v in views for f in v.fields))


def asof_join(
    entities: DataFrame,
    features: DataFrame,
    views: Sequence[FeatureView],
    entity_ts: str = "event_timestamp",
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Each entity row with the latest feature row of its keys at or before its time.

    Equal event times are settled by the later creation time. A value older than its
    view's ttl is NULL. Every entity row is kept once. All views must share one source.
    One union, one window: no row is ever paired with another, so there is no fan-out. If a key is hot,
    the union is written once and scanned in slices.
    """
    head = views[0]
    if any(list(v.keys) != list(head.keys) for v in views):
        raise ValueError("views of one source must have the same keys")
    keys, fields = list(head.keys), _fields(views)
    usable = features
    for c in (*keys, head.event_ts):
        usable = usable.filter(F.col(c).isNotNull())
    latest = F.struct(
        F.col(head.event_ts).cast("timestamp").alias("at"),
        F.col(head.created).cast("timestamp").alias("created"),
        *fields,
    )
    at_feature = F.col(head.event_ts).cast("timestamp").alias("__ts")
    at_entity = F.col(entity_ts).cast("timestamp").alias("__ts")
    side_f = usable.select(*keys, at_feature, F.lit(0).alias("__side"), latest.alias("__feature"))
    side_e = entities.select(*keys, at_entity, F.lit(1).alias("__side"), F.struct(*entities.columns).alias("__entity"))
    hot = has_hot_key(side_e.select(*keys).unionByName(side_f.select(*keys)), keys, min_rows)
    if hot:
        # one feature row per instant, so that a heavy instant is none for the sort; requests of an instant differ
        side_f = side_f.groupBy(*keys, "__ts", "__side").agg(F.max("__feature").alias("__feature"))
    both = side_e.unionByName(side_f, allowMissingColumns=True)
    order = ["__ts", "__side"]
    if hot:
        both = stored(both.withColumn("__tie", F.xxhash64("__entity")), "as-of")
        order.append("__tie")
    found = latest_so_far(both, keys, order, "__feature", "__found", hot, min_rows=min_rows)
    found = found.filter("__side = 1")

    seen = F.col("__found")
    columns = {}
    for view in views:
        for f in view.fields:
            fresh = F.lit(True)
            if view.ttl is not None:
                oldest = F.col("__ts") - F.lit(view.ttl)
                fresh = seen["at"] >= oldest
            columns[f] = F.when(fresh, seen[f])
    return found.select("__entity.*", *[c.alias(f) for f, c in columns.items()])


def historical_features(
    entities: DataFrame,
    sources: dict[str, DataFrame],
    views: Sequence[FeatureView],
    on_demand: Callable[[DataFrame], DataFrame] | None = None,
    entity_ts: str = "event_timestamp",
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Point-in-time values of several views; one pass per source table.

    Other columns of the entity frame (request data) pass through and are visible to
    ``on_demand``, which adds columns computed from both.
    """
    out = entities
    for source, group in _by_source(views).items():
        out = asof_join(out, sources[source], group, entity_ts, min_rows)
    return on_demand(out) if on_demand else out


def write_source(features: DataFrame, path: str, event_ts: str = "event_timestamp") -> None:
    """Write a feature table by date of its events, so that readers skip the dates they cannot need."""
    dated = features.withColumn("event_date", F.to_date(event_ts))
    dated.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(path)


def features_from_files(
    entities: DataFrame, paths: dict[str, str], views: Sequence[FeatureView], entity_ts: str = "event_timestamp", min_rows: int = MIN_ROWS
) -> DataFrame:
    """``historical_features`` with the sources named by the paths of ``write_source``.

    The times of the entities bound what is read: no date after the last of them, and none that all views of the source find
    too old for the first. One small aggregate finds the two.
    """
    spark = entities.sparkSession
    at = F.col(entity_ts).cast("timestamp")
    first, last = entities.agg(F.min(at), F.max(at)).first()
    sources = {}
    for source, group in _by_source(views).items():
        rows = spark.read.parquet(paths[source])
        if last is None:
            rows = rows.limit(0)
        else:
            rows = rows.filter(F.col("event_date") <= F.to_date(F.lit(last)))
            if all(v.ttl is not None for v in group):
                oldest = F.lit(first) - F.lit(max(v.ttl for v in group))
                rows = rows.filter(F.col("event_date") >= F.to_date(oldest))
        sources[source] = rows.drop("event_date")
    return historical_features(entities, sources, views, entity_ts=entity_ts, min_rows=min_rows)


def latest_features(
    features: DataFrame,
    views: Sequence[FeatureView],
    end=None,
    state: DataFrame | None = None,
) -> DataFrame:
    """The latest feature row per key, up to ``end``, on top of an earlier ``state``.

    Incremental use: pass only the rows since the last run, plus that run's result. A
    maximum combines before the shuffle, so hot keys cost nothing extra.
    """
    head = views[0]
    keys, fields = list(head.keys), _fields(views)
    columns = [*keys, head.event_ts, head.created, *fields]
    rows = features.select(*columns)
    if end is not None:
        rows = rows.filter(F.col(head.event_ts) <= end)
    if state is not None:
        rows = rows.unionByName(state.select(*columns))
    newest = F.max(F.struct(head.event_ts, head.created, *fields)).alias("row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "row.*")


def online_features(
    requests: DataFrame,
    latest: DataFrame,
    views: Sequence[FeatureView],
    on_demand: Callable[[DataFrame], DataFrame] | None = None,
    now=None,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Latest values for each request row, NULL where the key is unknown.

    With ``now``, values older than their view's ttl are NULL too.
    """
    head = views[0]
    keys, fields = list(head.keys), _fields(views)
    out = lookup_join(
        requests, latest.select(*keys, F.col(head.event_ts).alias("__at"), *fields), keys,
        min_rows=min_rows,
    )
    if now is not None:
        for view in views:
            if view.ttl is not None:
                oldest = F.lit(now) - F.lit(view.ttl)
                out = out.withColumns(
                    {f: F.when(F.col("__at") >= oldest, F.col(f)) for f in view.fields}
                )
    out = out.drop("__at")
    return on_demand(out) if on_demand else out


def driver_scores(df: DataFrame) -> DataFrame:
    """On-demand scores from stored rates and the request's surge multiplier.

    Missing stored values count as 0; a missing multiplier leaves the last score NULL.
    """
    rating = 0.6 * zero_if_missing(F.col("conv_rate")) + 0.4 * zero_if_missing(F.col("acc_rate"))
    trips = rating * F.log1p(zero_if_missing(F.col("avg_daily_trips")))
    return df.withColumns(
        {
            "weighted_rating": rating,
            "trip_score": trips,
            "surge_adjusted_score": trips * F.col("surge_multiplier"),
        }
    )
