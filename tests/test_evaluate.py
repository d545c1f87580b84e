import math
import statistics

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate as E


@pytest.fixture(scope="module")
def scored(spark):
    """Scores with many ties, both classes, a third of all rows on one score."""
    u = F.rand(7)
    df = spark.range(6000).select(
        F.col("id").alias("tranaction_id"),
        (F.rand(1) < 0.1).cast("int").alias("tx_fraud"),
        F.when(F.col("id") % 3 == 0, 0.2).otherwise(F.round(u, 3)).alias("noise"),
    )
    df = df.withColumn("p1", F.round((F.col("noise") + F.col("tx_fraud") * 0.4) / 1.4, 4))
    df = df.withColumn("p2", F.round((F.col("noise") + F.col("tx_fraud") * 0.6) / 1.6, 4))
    return spark.createDataFrame(df.toPandas())


@pytest.mark.parametrize("min_rows", [10**6, 100])
def test_metrics_equal_mllib(scored, min_rows):
    row = E.evaluate(scored, score="p1", min_rows=min_rows).first()
    ml = scored.withColumn("prediction", (F.col("p1") > 0.5).cast("double")).withColumn("raw", F.col("p1"))
    auc = BinaryClassificationEvaluator(labelCol="tx_fraud", rawPredictionCol="raw", numBins=0).evaluate(ml)
    assert row.auc == pytest.approx(auc, abs=1e-12)
    for metric, column in (("f1", "f1"), ("accuracy", "accuracy")):
        ev = MulticlassClassificationEvaluator(labelCol="tx_fraud", predictionCol="prediction", metricName=metric)
        assert row[column] == pytest.approx(ev.evaluate(ml), abs=1e-12)
    fraud = MulticlassClassificationEvaluator(
        labelCol="tx_fraud", predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0
    )
    assert row.fraud_f1 == pytest.approx(fraud.evaluate(ml), abs=1e-12) and row.rows == 6000


def test_weighted_and_fraud_f1_differ(spark):
    rows = [(0, 0.1)] * 90 + [(1, 0.1)] * 8 + [(1, 0.9)] * 2
    row = E.evaluate(spark.createDataFrame(rows, "tx_fraud int, probability double")).first()
    assert round(row.f1, 3) == 0.895 and round(row.fraud_f1, 3) == 0.333


def test_one_class_has_no_auc(spark):
    row = E.evaluate(spark.createDataFrame([(0, 0.1), (0, 0.2)], "tx_fraud int, probability double")).first()
    assert row.auc is None and row.f1 == 1.0 and row.accuracy == 1.0


def test_bootstrap_ignores_layout_and_slicing(scored):
    scores = {"champion": "p1", "candidate": "p2"}

    def run(df, **kw):
        return sorted((r.model, r.replicate, round(r.auc, 12), round(r.f1, 12), r.rows) for r in E.bootstrap(df, scores, 6, **kw).collect())

    one = run(scored)
    assert one == run(scored.repartition(9)) == run(scored, min_rows=10**6) and len(one) == 12
    assert all(5700 < r[4] < 6300 for r in one) and len({r[4] for r in one}) > 3


def test_resample_counts_are_poisson(scored):
    weights = E.replicate_weights(scored, 8)
    row = weights.agg(
        *[F.avg(f"w{i}").alias(f"m{i}") for i in range(8)],
        *[F.var_samp(f"w{i}").alias(f"v{i}") for i in range(8)],
        F.corr("w0", "w1").alias("corr"),
    ).first()
    assert all(abs(row[f"m{i}"] - 1) < 0.06 and abs(row[f"v{i}"] - 1) < 0.12 for i in range(8))
    assert abs(row["corr"]) < 0.05


def test_weights_act_like_repeated_rows(scored, spark):
    first = E.bootstrap(scored, {"m": "p1"}, 1).first()
    copies = E.replicate_weights(scored, 1).withColumn("c", F.explode(F.expr("if(w0 > 0, sequence(1, w0), array())")))
    direct = E.evaluate(copies, score="p1").first()
    assert first.auc == pytest.approx(direct.auc, abs=1e-12) and first.f1 == pytest.approx(direct.f1, abs=1e-12)
    assert first.rows == direct.rows


def replicates(spark, a, b):
    rows = [("champion", i, 0.5, v) for i, v in enumerate(a)] + [("candidate", i, 0.6, v) for i, v in enumerate(b)]
    return spark.createDataFrame(rows, "model string, replicate int, auc double, f1 double")


def test_comparison_formulae(spark):
    a, b = [0.80, 0.82, 0.79, 0.81, 0.80], [0.83, 0.84, 0.80, 0.82, 0.85]
    row = E.compare(replicates(spark, a, b)).first()
    va, vb = statistics.variance(a), statistics.variance(b)
    gain = statistics.mean(b) - statistics.mean(a)
    t = gain / math.sqrt(va / 5 + vb / 5)
    assert row.t_statistic == pytest.approx(t) and row.cohens_d == pytest.approx(gain / math.sqrt((va + vb) / 2))
    assert row.p_value == pytest.approx(1 - math.erf(abs(t) / math.sqrt(2)), abs=1e-12)
    assert row.is_significant and row.should_deploy and row.improvement == pytest.approx(gain)
    back = E.compare(replicates(spark, b, a)).first()
    assert back.is_significant and not back.should_deploy


def test_comparison_without_spread(spark):
    row = E.compare(replicates(spark, [0.5, 0.5], [0.6, 0.6])).first()
    assert (row.t_statistic, row.p_value, row.cohens_d, row.should_deploy) == (0.0, 1.0, 0.0, False)


def test_version_numbers_not_text(spark):
    rows = [("m", "9", "r9"), ("m", "10", "r10"), ("m", "2", "r2"), ("lonely", "1", "r1")]
    got = E.latest_two_versions(spark.createDataFrame(rows, "model string, version string, run_id string")).collect()
    assert [tuple(r) for r in got] == [("m", 10, "r10", 9, "r9")]


def test_version_that_is_no_number_is_left_out(spark):
    from ledgerlens.operators.evaluate import latest_two_versions

    rows = spark.createDataFrame([("m", "1", "a"), ("m", "x", "b"), ("n", "2", "c"), ("n", "x", "d"), ("n", "3", "e")], "model string, version string, run_id string")
    assert [tuple(r) for r in latest_two_versions(rows).select("model", "candidate_version", "champion_version").collect()] == [("n", 3, 2)]


def test_bootstrap_of_one_row(spark):
    from ledgerlens.operators.evaluate import bootstrap

    row = spark.createDataFrame([(1, 1, 0.7)], "tranaction_id long, tx_fraud int, probability double")
    assert bootstrap(row, {"m": "probability"}, n=10).count() == 10
