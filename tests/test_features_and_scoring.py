import json
import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import erf, int_or_null, normal_two_sided_p, number_or_null, strict_timestamp_or_null
from ledgerlens.operators import features as X
from ledgerlens.operators import scoring as S
from ledgerlens.schemas import FEATURES

CASES = [
    (250.0, "2026-03-22 03:00:00", [250, 3, 1, 1, 1]),
    (50.0, "2026-03-24 10:00:00", [50, 10, 3, 0, 0]),
    (150.0, "2026-03-22 14:30:00", [150, 14, 1, 1, 0]),
    (100.0, "2026-03-22 00:15:00", [100, 0, 1, 1, 1]),
    (100.0, "2026-03-22 23:59:00", [100, 23, 1, 1, 0]),
    (100.0, "2026-03-23 12:00:00", [100, 12, 2, 0, 0]),
    (100.0, "2026-03-25 12:00:00", [100, 12, 4, 0, 0]),
    (100.0, "2026-03-28 12:00:00", [100, 12, 7, 1, 0]),
    (100.0, "2026-03-22 00:00:00", [100, 0, 1, 1, 1]),
    (100.0, "2026-03-22 06:00:00", [100, 6, 1, 1, 1]),
    (100.0, "2026-03-22 07:00:00", [100, 7, 1, 1, 0]),
]


def test_feature_cases(spark):
    rows = [(i, a, t) for i, (a, t, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, tx_amount double, tx_datetime string")
    df = df.withColumn("tx_datetime", strict_timestamp_or_null(F.col("tx_datetime")))
    got = {r["i"]: [r[c] for c in FEATURES] for r in X.with_features(df).collect()}
    assert got == {i: [float(v) for v in want] for i, (_, _, want) in enumerate(CASES)}


def test_missing_time_gives_zero_flags(spark):
    df = spark.createDataFrame([(1.0, None)], "tx_amount double, tx_datetime timestamp")
    row = X.with_features(df).first()
    assert (row.hour_of_day, row.day_of_week, row.is_weekend, row.is_night) == (None, None, 0.0, 0.0)


def test_incomplete_rows_leave(spark):
    rows = [(1, 1.0, 1), (2, None, 1), (3, float("nan"), 0), (4, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, tx_amount double, tx_fraud int")
    df = df.withColumn("tx_datetime", F.lit("2026-03-22 07:00:00").cast("timestamp"))
    assert [r.id for r in X.feature_rows(X.with_features(df), "id").collect()] == [1]


TEST_MODEL = S.Coefficients(FEATURES, [0.5, -0.1, 0.05, 0.2, 0.3], -2.0)
SCORES = [
    ([100, 14, 1, 1, 0], 1.0, 1),
    ([0, 0, 0, 0, 0], 1 / (1 + math.exp(2)), 0),
    ([1, 12, 3, 0, 0], 1 / (1 + math.exp(2.55)), 0),
]


def test_score_cases(spark):
    rows = [[float(v) for v in f] for f, _, _ in SCORES]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FEATURES))
    got = {tuple(r[c] for c in FEATURES): (r.probability, r.prediction) for r in TEST_MODEL.score(df).collect()}
    for f, p, label in SCORES:
        probability, prediction = got[tuple(float(v) for v in f)]
        assert probability == pytest.approx(p, abs=1e-6) and prediction == label


def test_exactly_half_is_not_fraud_and_null_stays_null(spark):
    model = S.Coefficients(["x"], [1.0], 0.0)
    rows = model.score(spark.createDataFrame([(0.0,), (1e-9,), (None,)], "x double")).collect()
    assert {r.x: r.prediction for r in rows} == {0.0: 0, 1e-9: 1, None: None}


def test_probability_grows_with_amount_and_stays_in_range(spark):
    df = spark.range(0, 10000, 50).select(
        F.col("id").cast("double").alias("tx_amount"),
        *[F.lit(float(v)).alias(c) for c, v in zip(FEATURES[1:], (12, 3, 0, 0))],
    )
    ps = [r.probability for r in S.SHIPPED.score(df).orderBy("tx_amount").collect()]
    assert ps == sorted(ps) and 0 <= ps[0] and ps[-1] <= 1 and ps[0] < ps[-1]


def test_coefficient_file(spark, tmp_path):
    path = tmp_path / "model.json"
    path.write_text(
        json.dumps({"feature_names": FEATURES, "coefficients": list(TEST_MODEL.weights), "intercept": -2.0}, indent=2)
    )
    loaded = S.load_coefficients(spark, str(path))
    assert (list(loaded.names), list(loaded.weights), loaded.intercept) == (FEATURES, TEST_MODEL.weights, -2.0)
    table = S.coefficient_rows(spark, str(path)).orderBy("pos").collect()
    assert [(r.name, r.coefficient) for r in table] == list(zip(FEATURES, TEST_MODEL.weights))


def test_bad_coefficient_files_raise(spark, tmp_path):
    with pytest.raises(Exception):
        S.load_coefficients(spark, str(tmp_path / "absent.json"))
    broken = tmp_path / "broken.json"
    broken.write_text("{not json")
    with pytest.raises(Exception):
        S.load_coefficients(spark, str(broken))
    with pytest.raises(ValueError):
        S.Coefficients(["a", "b"], [1.0], 0.0)


def test_split_ignores_layout(spark):
    df = spark.range(5000).withColumnRenamed("id", "tranaction_id")
    train, test = X.hash_split(df)
    again, _ = X.hash_split(df.repartition(7))
    ids = {r[0] for r in train.collect()}
    assert ids == {r[0] for r in again.collect()}
    assert len(ids) + test.count() == 5000 and 0.77 < len(ids) / 5000 < 0.83


def test_erf_to_double_precision(spark):
    xs = [0.0, 1e-8, 0.1, 0.5, 1.0, 2.0, 3.5, 5.0, 6.0, 9.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", erf(F.col("x")).alias("e"))
    for r in df.collect():
        assert r.e == pytest.approx(math.erf(r.x), abs=1e-14)
    p = spark.range(1).select(normal_two_sided_p(F.lit(-1.96)).alias("p")).first().p
    assert p == pytest.approx(2 * (1 - 0.5 * (1 + math.erf(1.96 / math.sqrt(2)))), abs=1e-14)


def test_text_to_numbers(spark):
    texts = ["7", "12.7", "-3.9", "1e3", "Err", "", " 5 ", None, "99999999999", "1.2.3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.i, r.d) for r in df.select("t", int_or_null(F.col("t")).alias("i"), number_or_null(F.col("t")).alias("d")).collect()}
    assert {t: v[0] for t, v in got.items()} == {
        "7": 7, "12.7": 12, "-3.9": -3, "1e3": None, "Err": None, "": None, " 5 ": 5, None: None,
        "99999999999": None, "1.2.3": None,
    }
    assert got["1e3"][1] == 1000.0 and got["12.7"][1] == 12.7 and got["Err"][1] is None and got["1.2.3"][1] is None


def test_requests_are_scored_or_rejected(spark):
    """The shipped model gives a high amount the higher probability, and a low one at noon is legitimate."""
    rows = [
        (1, 10000.0, "2026-03-23 10:00:00"), (2, 1.0, "2026-03-23 10:00:00"), (None, 5.0, "2026-03-23 10:00:00"),
        (3, None, "2026-03-23 10:00:00"), (4, 5.0, None), (5, 5.0, "2026-03-23T10:00:00"), (6, 5.0, "2026-03-23"), (7, float("nan"), "x"),
    ]
    requests = spark.createDataFrame(rows, "transaction_id long, tx_amount double, tx_datetime string")
    responses, rejects = S.score_requests(requests)
    got = {r.transaction_id: r for r in responses.collect()}
    assert set(got) == {1, 2, None} and got[1].fraud_probability > got[2].fraud_probability and got[2].prediction == 0
    assert all((r.fraud_probability > 0.5) == (r.prediction == 1) for r in got.values())
    reasons = {r.transaction_id: r.reason for r in rejects.collect()}
    assert reasons == {3: "no amount", 7: "no amount", 4: "no time", 5: "unreadable time", 6: "unreadable time"}
