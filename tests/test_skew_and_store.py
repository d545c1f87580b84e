import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import featurestore as FS
from ledgerlens.operators import scan, skew
from ledgerlens.operators.replay import first_rows, replay
from ledgerlens.operators.scan import numbered

T0 = datetime(2024, 1, 1)
STATS = "driver_id long, event_timestamp timestamp, created timestamp, conv_rate float, acc_rate float, avg_daily_trips long"
ENTITIES = "request_id long, driver_id long, event_timestamp timestamp, surge_multiplier double"
VIEWS = [
    FS.FeatureView("eff", "s", ("conv_rate", "acc_rate"), ttl=timedelta(hours=30)),
    FS.FeatureView("act", "s", ("avg_daily_trips",), ttl=None),
]


def random_case(seed, n=400):
    """Driver 0 holds half of all rows, and one of its hours holds half of those."""
    rng = random.Random(seed)

    def driver():
        return 0 if rng.random() < 0.5 else rng.choice([None, 1, 2, 3, 4, 5])

    def when(d):
        hours = 50 if d == 0 and rng.random() < 0.5 else rng.randrange(100)
        return None if rng.random() < 0.02 else T0 + timedelta(hours=hours)

    stats, entities = [], []
    for i in range(n):
        d = driver()
        stats.append((d, when(d), T0 + timedelta(hours=rng.randrange(200), seconds=i), i / 1000, i / 500, i))
        d = driver()
        entities.append((i, d, when(d), 1.0))
    return stats, entities


def brute_force(stats, entities):
    out = {}
    for i, d, at, _ in entities:
        seen = [s for s in stats if d is not None and at is not None and s[0] == d and s[1] is not None and s[1] <= at]
        best = max(seen, key=lambda s: (s[1], s[2]), default=None)
        fresh = best is not None and best[1] >= at - timedelta(hours=30)
        out[i] = (round(best[3], 4) if fresh else None, best[5] if best else None)
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("min_rows", [1_000_000, 40])
def test_asof_join_against_brute_force(spark, seed, min_rows):
    stats, entities = random_case(seed)
    out = FS.asof_join(spark.createDataFrame(entities, ENTITIES), spark.createDataFrame(stats, STATS), VIEWS, min_rows=min_rows)
    got = {
        r.request_id: (None if r.conv_rate is None else round(r.conv_rate, 4), r.avg_daily_trips)
        for r in out.collect()
    }
    assert out.count() == len(entities) and got == brute_force(stats, entities)


def test_small_slices_grow_once_there_are_many(spark, monkeypatch):
    assert scan.slices_of(900, 40) == 23 and scan.slices_of(2_400_000, 10) == scan.FEW and scan.slices_of(10**9, 10) == 1000
    monkeypatch.setattr(scan, "FEW", 6)
    cut, plain = [], scan.in_slices

    def watched(*args, **kw):
        out = plain(*args, **kw)
        cut.append(out.select(scan.SLICE).distinct().count())
        return out

    monkeypatch.setattr(scan, "in_slices", watched)
    stats, entities = random_case(3)
    out = FS.asof_join(spark.createDataFrame(entities, ENTITIES), spark.createDataFrame(stats, STATS), VIEWS, min_rows=3).collect()
    got = {r.request_id: (None if r.conv_rate is None else round(r.conv_rate, 4), r.avg_daily_trips) for r in out}
    assert len(out) == len(entities) and got == brute_force(stats, entities) and 1 < max(cut) <= 6


def test_created_time_settles_ties_and_ttl_is_inclusive(spark):
    at = T0 + timedelta(hours=30)
    stats = spark.createDataFrame([(1, T0, T0, 0.1, 0.1, 1), (1, T0, T0 + timedelta(hours=1), 0.2, 0.2, 2)], STATS)
    ask = spark.createDataFrame([(1, 1, at, 1.0), (2, 1, at + timedelta(seconds=1), 1.0)], ENTITIES)
    got = {r.request_id: (r.conv_rate, r.avg_daily_trips) for r in FS.asof_join(ask, stats, VIEWS).collect()}
    assert got[1][0] == pytest.approx(0.2) and got[1][1] == 2 and got[2] == (None, 2)


def test_views_of_two_sources(spark):
    stats = spark.createDataFrame([(1, T0, T0, 0.5, 0.25, 3)], STATS)
    views = [VIEWS[0], FS.FeatureView("act", "other", ("avg_daily_trips",))]
    ask = spark.createDataFrame([(1, 1, T0, 2.0), (2, 9, T0, None)], ENTITIES)
    got = {r.request_id: r for r in FS.historical_features(ask, {"s": stats, "other": stats}, views, FS.driver_scores).collect()}
    assert got[1].weighted_rating == pytest.approx(0.4) and got[1].avg_daily_trips == 3
    assert got[1].surge_adjusted_score == pytest.approx(got[1].trip_score * 2)
    assert got[2].weighted_rating == 0 and got[2].trip_score == 0 and got[2].surge_adjusted_score is None


def test_incremental_equals_full(spark):
    stats, _ = random_case(4)
    df = spark.createDataFrame(stats, STATS).filter("driver_id IS NOT NULL AND event_timestamp IS NOT NULL")
    cut = F.lit(T0 + timedelta(hours=40))
    state = FS.latest_features(df, VIEWS, end=cut)
    step = FS.latest_features(df.filter(F.col("event_timestamp") > cut), VIEWS, state=state)
    assert sorted(map(str, step.collect())) == sorted(map(str, FS.latest_features(df, VIEWS).collect()))


@pytest.mark.parametrize("min_rows", [1_000_000, 30])
def test_online_features(spark, min_rows):
    stats = spark.createDataFrame([(d, T0, T0, d / 10, d / 10, d) for d in range(3)], STATS)
    latest = FS.latest_features(stats, VIEWS)
    ask = spark.createDataFrame([(i, 0 if i % 2 else i % 7) for i in range(200)], "request_id long, driver_id long")
    rows = FS.online_features(ask, latest, VIEWS, min_rows=min_rows).collect()
    assert len(rows) == 200
    assert all(r.avg_daily_trips == (r.driver_id if r.driver_id < 3 else None) for r in rows)
    late = T0 + timedelta(days=3)
    expired = FS.online_features(ask, latest, VIEWS, now=late).filter("driver_id = 1").first()
    assert expired.conv_rate is None and expired.avg_daily_trips == 1


@pytest.mark.parametrize("min_rows", [1_000_000, 37])
def test_numbering_and_replay(spark, min_rows):
    ids = random.Random(5).sample(range(10**12), 500)
    df = spark.createDataFrame([(i,) for i in ids], "tranaction_id long").repartition(6)
    rows = {r.tranaction_id: r.row for r in numbered(df, ["tranaction_id"], slice_rows=min_rows).collect()}
    assert rows == {v: i for i, v in enumerate(sorted(ids))}


@pytest.mark.parametrize("limit", [0, 1, 7, 10, 23, 200_005])
def test_replay_wraps_around(spark, limit):
    from ledgerlens.schemas import RAW

    rows = [(i, "2022-11-04 10:00:00", 1, "7", 1.0, 1, 1, 0, 0) for i in range(10)]
    df = spark.createDataFrame(rows, RAW).withColumn("tx_datetime", F.col("tx_datetime").cast("timestamp"))
    out = replay(df, limit=limit).select("position", F.get_json_object("value", "$.tranaction_id").cast("int").alias("i"))
    assert sorted((r.position, r.i) for r in out.collect()) == [(p, p % 10) for p in range(limit)]


def test_replay_in_small_slices_makes_few_tasks(spark, monkeypatch):
    from ledgerlens.schemas import RAW

    made, plain = [], scan.in_slices

    def watched(*args, **kw):
        out = plain(*args, **kw)
        made.append(out.agg(F.max(scan.SLICE)).first()[0] + 1)
        return out

    monkeypatch.setattr(scan, "in_slices", watched)
    ids = random.Random(6).sample(range(10**9), 3000)
    rows = [(i, "2022-11-04 10:00:00", 1, "7", 1.0, 1, 1, 0, 0) for i in ids]
    df = spark.createDataFrame(rows, RAW).withColumn("tx_datetime", F.col("tx_datetime").cast("timestamp"))
    out = replay(df, passes=1.5, min_rows=2).select("position", F.get_json_object("value", "$.tranaction_id").cast("int").alias("i"))
    assert sorted((r.position, r.i) for r in out.collect()) == [*enumerate((sorted(ids) * 2)[:4500])]
    assert 100 < made[0] <= scan.FEW < 3000 / 2


def test_replay_of_nothing(spark):
    from ledgerlens.schemas import RAW

    assert replay(spark.createDataFrame([], RAW), limit=5).count() == 0


def test_lookup_join_hot_keys(spark):
    left = spark.createDataFrame([(None if i % 3 == 0 else i % 10, i) for i in range(300)], "k int, v int")
    right = spark.createDataFrame([(k, str(k)) for k in [*range(5), None]], "k int, name string")
    for how in ("left", "inner"):
        for null_safe in (True, False):
            plain = skew.lookup_join(left, right, ["k"], how, null_safe)
            split = skew.lookup_join(left, right, ["k"], how, null_safe, min_rows=25)
            assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert skew.hot_keys(left, ["k"], 25).count() == 1
