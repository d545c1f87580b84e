import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import decide as D
from ledgerlens.operators import history as H
from ledgerlens.operators import scan as S


@pytest.fixture(scope="module")
def rows(spark):
    """Group 0 holds most of the rows; some groups are null; values repeat."""
    rng = random.Random(1)
    data = [(0 if rng.random() < 0.7 else rng.choice([None, 1, 2]), i, rng.choice([None, rng.randrange(50)])) for i in range(900)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "g int, i int, v int").repartition(7)


@pytest.mark.parametrize("slice_rows, block", [(10**6, 1024), (40, 1024), (15, 4)])
def test_scans_equal_loops_at_any_number_of_slices(rows, monkeypatch, slice_rows, block):
    monkeypatch.setattr(S, "BLOCK", block)
    data, df = rows
    sums, tops, earlier_tops = {}, {}, {}
    for g, i, v in sorted(data, key=lambda r: r[1]):
        earlier_tops[i] = tops.get(g)
        sums[g] = sums.get(g, 0) + (v or 0)
        tops[g] = v if tops.get(g) is None else max(tops[g], v) if v is not None else tops[g]
        earlier_tops[i] = (earlier_tops[i], tops[g], sums[g])
    got = S.running_sums(df, ["g"], ["i"], {"v": "s"}, slice_rows).collect()
    assert len(got) == len(data) and all(r.s == earlier_tops[r.i][2] for r in got)
    got = S.running_sums(df, ["g"], ["i"], {"v": "s"}, slice_rows, inclusive=False).collect()
    assert all(r.s == earlier_tops[r.i][2] - (r.v or 0) for r in got)
    got = S.running_max(df, ["g"], ["i"], "v", "m", slice_rows).collect()
    assert len(got) == len(data) and all(r.m == earlier_tops[r.i][1] for r in got)
    got = S.running_max(df, ["g"], ["i"], "v", "m", slice_rows, inclusive=False).collect()
    assert all(r.m == earlier_tops[r.i][0] for r in got)
    got = {r.i: r.row for r in S.numbered(df, [F.desc("i")], "row", slice_rows).collect()}
    assert got == {i: 899 - i for i in range(900)}


def test_what_is_handed_on_is_broadcast(rows):
    """Rows are not shuffled for it, and a value made of columns is not stored beside them."""
    out = S.running_max(rows[1], ["g"], ["i"], F.struct("v", "i"), "m", 40)
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    assert joins and all("strategy=broadcast" in x for x in joins) and out.columns == ["g", "i", "v", "m"]


def test_scans_of_nothing(spark):
    none = spark.createDataFrame([], "g int, i int, v int")
    assert S.running_sums(none, ["g"], ["i"], {"v": "s"}).count() == S.numbered(none, ["i"]).count() == 0


# ------------------------------------------------------------ decisions


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(2)
    data = []
    for i in range(1500):
        fraud = int(rng.random() < 0.15)
        p = 0.25 if i % 3 == 0 else round(min(1.0, max(0.0, rng.gauss(0.3 + 0.3 * fraud, 0.2))), 2)
        data.append((i, fraud, p))
    extra = [(9001, None, 0.9), (9002, 1, None), (9003, 0, float("nan"))]
    return data, spark.createDataFrame(data + extra, "tranaction_id long, tx_fraud int, probability double").repartition(5)


@pytest.mark.parametrize("slice_rows", [10**6, 7])
def test_thresholds_equal_trying_them_all(scored, slice_rows):
    data, df = scored
    curve = D.decision_curve(df, slice_rows=slice_rows)
    frauds, legit = sum(y for _, y, _ in data), sum(1 - y for _, y, _ in data)
    tried = []
    for t in sorted({p for *_, p in data}, reverse=True):
        tp = sum(y for _, y, p in data if p >= t)
        fp = sum(1 - y for _, y, p in data if p >= t)
        tried.append((t, tp, fp))
    assert sorted(((r.score, r.caught, r.false_alarms) for r in curve.collect()), reverse=True) == tried
    recall, t, rate = max((tp / frauds, t, fp / legit) for t, tp, fp in tried if fp / legit <= 0.05)
    got = D.recall_at(curve, 0.05).first()
    assert (got.threshold, got.recall, got.false_alarm_rate) == pytest.approx((t, recall, rate))
    before, ap = 0, 0.0
    for _, tp, fp in tried:
        ap, before = ap + (tp - before) / frauds * tp / (tp + fp), tp
    assert D.average_precision(curve).first()[0] == pytest.approx(ap)
    value, t = max((100 * tp - 10 * (tp + fp) - 5 * fp, t) for t, tp, fp in tried if fp / legit <= 0.05)
    got = D.best_threshold(curve, 100, 10, 5).first()
    assert (got.threshold, got.value) == pytest.approx((t, value)) and got.flagged > 0
    none = D.best_threshold(curve, 1, 1000, 5).first()
    assert none.threshold is None and none.value == 0 and none.flagged == 0


@pytest.mark.parametrize("slice_rows, fan_in", [(10**6, 64), (4, 2)])
def test_bands_equal_pooling_adjacent_violators(scored, monkeypatch, slice_rows, fan_in):
    monkeypatch.setattr(D, "FAN_IN", fan_in)
    data, df = scored
    bands = [[p, p, sum(q == p for *_, q in data), sum(y for _, y, q in data if q == p)] for p in sorted({p for *_, p in data})]
    k = 1
    while k < len(bands):
        a, b = bands[k - 1], bands[k]
        if a[3] / a[2] >= b[3] / b[2]:
            bands[k - 1 : k + 1] = [[a[0], b[1], a[2] + b[2], a[3] + b[3]]]
            k = max(1, k - 1)
        else:
            k += 1
    got = D.reliability_bands(df, slice_rows=slice_rows).orderBy("low").collect()
    assert [(r.low, r.high, r.rows) for r in got] == [tuple(b[:3]) for b in bands] and len(bands) > 4
    assert [r.fraud_rate for r in got] == pytest.approx([b[3] / b[2] for b in bands])


def test_decisions_of_nothing(spark):
    none = spark.createDataFrame([], "tranaction_id long, tx_fraud int, probability double")
    curve = D.decision_curve(none)
    assert curve.count() == 0 and D.recall_at(curve).first().threshold is None
    assert D.average_precision(curve).first()[0] is None and D.best_threshold(curve, 1, 1, 1).first().value == 0
    assert D.reliability_bands(none).count() == 0 and D.precision_at(none, 5).first().k == 0


def test_calibration_and_routing(scored):
    data, df = scored
    row = D.brier_score(df).first()
    assert row.rows == 1500 and row.brier == pytest.approx(sum((p - y) ** 2 for _, y, p in data) / 1500)
    bins = {r["bin"]: r.rows for r in D.reliability(df).collect()}
    assert sum(bins.values()) == 1500 and bins[9] == sum(p >= 0.9 for *_, p in data)
    top = sorted(data, key=lambda r: (-r[2], r[0]))[:40]
    assert D.precision_at(df, 40).first().precision == pytest.approx(sum(y for _, y, _ in top) / 40)
    ways = {r.tranaction_id: r.decision for r in D.routed(df, 0.4, 0.7).collect()}
    assert all(ways[i] == ("decline" if p >= 0.7 else "review" if p >= 0.4 else "approve") for i, _, p in data)
    assert ways[9002] == ways[9003] == "review"


# ------------------------------------------------------------ history

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("width", [7, 9, 400])
def test_trailing_counts_equal_brute_force(spark, width):
    rng = random.Random(3)
    data = []
    for i in range(500):
        key = 0 if rng.random() < 0.6 else rng.choice([None, 1, 2])
        at = rng.choice([None, T0 + timedelta(days=rng.randrange(60)), T0 + timedelta(days=20, seconds=rng.randrange(3))])
        data.append((i, key, at, rng.choice([None, float(rng.randrange(100))]), 1))
    df = spark.createDataFrame(data, "id int, k int, at timestamp, v double, n int").repartition(4)
    out = H.with_trailing(df, ["k"], "at", "v", "week", width=timedelta(days=width), min_rows=30).collect()
    assert len(out) == 500
    for r in out:
        if r.k is None or r["at"] is None:
            assert r.week_n is None and r.week_mean is None
            continue
        seen = [v for _, k, at, v, _ in data if k == r.k and at is not None and r["at"] - timedelta(days=7) <= at <= r["at"]]
        known = [v for v in seen if v is not None]
        assert r.week_n == len(seen)
        assert (r.week_mean is None) if not known else r.week_mean == pytest.approx(sum(known) / len(known))


def test_time_split_is_exact(spark):
    rng = random.Random(4)
    times = [T0 + timedelta(microseconds=rng.randrange(10**12)) for _ in range(300)] + [T0 + timedelta(days=3)] * 90
    df = spark.createDataFrame([(t,) for t in times] + [(None,)], "at timestamp").repartition(3)
    ordered = sorted(times)
    for share in (0.001, 0.5, 0.7, 1.0):
        micros = H.quantile_time(df, "at", share)
        want = ordered[max(1, math.ceil(share * len(times))) - 1]
        assert datetime(1970, 1, 1) + timedelta(microseconds=micros) == want
    sides = {r.side: r["count"] for r in H.time_split(df, "at", 0.5, 0.25).groupBy("side").count().collect()}
    assert sides["train"] >= 195 and sides[None] == 1 and sum(sides.values()) == 391
    assert H.quantile_time(df.limit(0), "at", 0.5) is None


def test_drift(spark):
    data = [("a", float(i % 10)) for i in range(1000)] + [("b", float(i % 10)) for i in range(500)] + [("c", 9.0)] * 50 + [("c", None)] * 50
    df = spark.createDataFrame(data, "p string, v double")
    bounds = H.even_bounds(df.filter("p = 'a'"), "v", 5)
    got = {r.period: r.psi for r in H.drift(df, F.col("p"), "v", bounds, F.col("p") == "a").collect()}
    assert got["a"] == pytest.approx(0) and got["b"] == pytest.approx(0) and got["c"] > 1 and math.isfinite(got["c"])


def test_trailing_work_is_in_proportion_to_the_instants(spark):
    """No window recomputes a range per row, and a value that is not a number counts only where it is in range."""
    n, span = 30_000, 5_000
    value = F.when(F.col("id") == 9_000, float("nan")).when(F.col("id") == 20_000, float("inf")).otherwise(F.col("id").cast("double"))
    df = spark.range(n).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("at"), value.alias("v"))
    out = H.trailing(df, ["k"], "at", "v", timedelta(seconds=span), timedelta(seconds=7_001))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding" in plan and f"-{span}" not in plan
    rows = out.orderBy("at").collect()
    assert len(rows) == n
    for i, r in enumerate(rows):
        low = max(0, i - span)
        want = math.nan if low <= 9_000 <= i else math.inf if low <= 20_000 <= i else (low + i) / 2
        assert r.n == i - low + 1 and (math.isnan(r["mean"]) if math.isnan(want) else r["mean"] == pytest.approx(want))
