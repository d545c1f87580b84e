import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens import streaming
from ledgerlens.operators import clean, features
from ledgerlens.operators import monitor as M
from ledgerlens.operators import scan
from ledgerlens.operators import scoring as S
from ledgerlens.plans import derive as D
from ledgerlens.sources import kafka
from ledgerlens.streaming.alerts import ended_runs, sustained_stream

T0 = datetime(2024, 1, 1)
MINUTE = timedelta(minutes=1)


def samples(spark, rows, label="pod string"):
    return spark.createDataFrame([(p, T0 + timedelta(seconds=s), float(v)) for p, s, v in rows], f"{label}, ts timestamp, value double")


@pytest.mark.parametrize("min_rows", [10**6, 40])
def test_counter_increases_against_brute_force(spark, min_rows):
    rng = random.Random(1)
    rows, totals = [], {p: 0 for p in "abc"}
    for s in range(0, 3000, 5):
        p = rng.choice("aaaabc")
        totals[p] = 0 if rng.random() < 0.02 else totals[p] + rng.randrange(5)
        rows.append((p, s, totals[p]))
    rows += rng.choices(rows, k=50)  # samples delivered twice
    got = M.counter_increases(samples(spark, rows), ["pod"], min_rows=min_rows).collect()
    want, last = {}, {}
    for p, s, v in sorted(set(rows), key=lambda r: r[1]):
        before = last.get(p)
        want[(p, s)] = None if before is None else float(v if v < before else v - before)
        last[p] = v
    assert {(r.pod, int((r.ts - T0).total_seconds())): r.increase for r in got} == want


def test_hot_series_make_few_tasks(spark, monkeypatch):
    made, plain = [], scan.in_slices

    def watched(*args, **kw):
        out = plain(*args, **kw)
        made.append(out.agg(F.max(scan.SLICE)).first()[0] + 1)
        return out

    monkeypatch.setattr(scan, "in_slices", watched)
    df = spark.range(4000).select((F.col("id") % 2).alias("pod"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 50).alias("value"))
    grown = M.counter_increases(df, ["pod"], min_rows=2)
    assert sorted(map(str, grown.collect())) == sorted(map(str, M.counter_increases(df, ["pod"]).collect()))
    assert 100 < made[0] <= scan.FEW < 4000 / 2


def test_rate_and_total(spark):
    df = samples(spark, [("a", 0, 10), ("a", 30, 20), ("a", 45, 5), ("a", 70, 11), ("b", 10, 1)])
    rates = {r.window_start: r.per_second for r in M.counter_rate(M.counter_increases(df, ["pod"]), MINUTE).collect()}
    assert rates == {T0: 15 / 60, T0 + MINUTE: 6 / 60}
    assert M.counter_total(df, ["pod"]).first().total == 12


def quantile(spark, pairs, q=0.95):
    rows = [(1, float(le), float(n)) for le, n in pairs]
    return M.histogram_quantile(spark.createDataFrame(rows, "w int, le double, n double"), q, ["w"]).first()["quantile"]


def test_histogram_quantile_rules(spark):
    inf = math.inf
    assert quantile(spark, [(1, 0), (2, 100), (inf, 100)]) == pytest.approx(1.95)
    assert quantile(spark, [(1, 100), (2, 100), (inf, 100)]) == pytest.approx(0.95)
    assert quantile(spark, [(1, 10), (2, 20), (inf, 100)]) == 2.0
    assert quantile(spark, [(-1, 100), (2, 100), (inf, 100)]) == -1.0
    assert quantile(spark, [(1, 0), (inf, 0)]) is None


def test_sustained_runs(spark):
    minutes = [0, 1, 2, 3, 4, 5, 7, 8, 9, 20, 21, 22, 23, 24, 25, 26]
    met = spark.createDataFrame([(T0 + m * MINUTE,) for m in minutes], "at timestamp")
    got = sorted(M.sustained(met, MINUTE, 5 * MINUTE).collect())
    assert [(r.since, r.until, r.steps) for r in got] == [
        (T0, T0 + 5 * MINUTE, 6), (T0 + 20 * MINUTE, T0 + 26 * MINUTE, 7)
    ]


def test_overload_alert(spark):
    """Pod a runs at 0.9 of its limit all the time; all six replicas are up from minute 10 to 19."""
    cpu = samples(spark, [("a", s, 0.9 * s) for s in range(0, 1800, 15)] + [("b", s, 0.1 * s) for s in range(0, 1800, 15)])
    limits = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "pod string, limit double")
    gauge = samples(spark, [("api", 60 * m, 6 if 10 <= m < 20 else 3) for m in range(30)], "deployment string")
    got = M.overload_alert(cpu, limits, gauge).collect()
    assert [(r.deployment, r.since, r.until) for r in got] == [("api", T0 + 11 * MINUTE, T0 + 20 * MINUTE)]
    calm = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "pod string, limit double")
    assert M.overload_alert(cpu, calm, gauge).count() == 0


def test_batch_and_stream_score_alike(spark, sf_dir, tmp_path):
    messages = D.messages_from(D.events(spark, sf_dir))
    messages.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    streamed = streaming.score_messages(source, D.CHAMPION.score)
    streaming.run_for(streaming.write_stream(streamed, out, checkpoint, "topic"))

    def plain(df):
        text = F.regexp_replace("value", r',"scored_at":"[^"]*"', "")
        return sorted((r.topic, r.v) for r in df.select("topic", text.alias("v")).collect())

    batch = plain(streaming.score_messages(messages, D.CHAMPION.score))
    read = spark.read.schema("value string, topic string").parquet(out)
    assert plain(read) == batch and len(batch) == messages.count()
    # a restart on the same checkpoint has nothing left to do
    streaming.run_for(streaming.write_stream(streamed, out, checkpoint, "topic"))
    assert spark.read.parquet(out).count() == len(batch)


def test_poison_messages_are_set_aside(spark, sf_dir):
    model = S.pipeline().fit(features.feature_rows(features.with_features(clean.clean(D.raw_transactions(spark, sf_dir)))))
    good = {"tranaction_id": 1, "tx_datetime": "2024-01-01 10:00:00", "customer_id": 1, "terminal_id": "7", "tx_amount": 5.0, "tx_fraud": 1}
    bodies = [
        json.dumps(good),
        json.dumps({**good, "tranaction_id": None}),
        json.dumps({**good, "tranaction_id": 3, "tx_amount": None}),
        json.dumps({**good, "tranaction_id": 4, "tx_datetime": "2024-01-01 24:00:00"}),
        json.dumps({**good, "tranaction_id": 5, "tx_amount": "text"}),
        "not json",
    ]
    df = spark.createDataFrame([(bytearray(b, "utf8"), T0) for b in bodies], "value binary, timestamp timestamp")
    rows = streaming.score_messages(df, model.transform).collect()
    assert sorted(r.topic for r in rows) == ["predictions"] + ["rejects"] * 5
    scored = json.loads(next(r.value for r in rows if r.topic == "predictions"))
    assert scored["tranaction_id"] == 1 and scored["ground_truth"] == 1 and scored["prediction"] in (0, 1)
    assert {"event_time", "scored_at", "tx_amount", "customer_id", "terminal_id"} <= set(scored)
    assert {json.loads(r.value).get("tranaction_id") for r in rows if r.topic == "rejects"} == {None, 3, 4, 5}


def test_timed_run_stops(spark, tmp_path):
    source = spark.readStream.format("rate").load()
    query = streaming.write_stream(source, str(tmp_path / "o"), str(tmp_path / "c"), live=True)
    streaming.run_for(query, 2)
    assert not query.isActive


def test_kafka_options():
    access = kafka.KafkaAccess("host:9091", "me", "secret", "/t.jks", "pw")
    options = kafka.source_options(access, "transactions", 1000)
    assert options["subscribe"] == "transactions" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "1000"
    assert options["kafka.security.protocol"] == "SASL_SSL" and options["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert 'username="me" password="secret";' in options["kafka.sasl.jaas.config"]
    assert options["kafka.ssl.truststore.location"] == "/t.jks"
    assert "kafka.ssl.truststore.location" not in kafka.KafkaAccess("h", "u", "p").options()


def test_alert_state_spans_batches(spark, tmp_path):
    """Runs that cross micro-batches fire once; a gap or a repeated step does not."""
    folder = str(tmp_path / "steps")
    for minutes in ([0, 1, 2, 3], [3, 4, 5, 6], [8, 9], [20, 21, 22], [23, 24, 25, 26, 27]):
        rows = [("api", T0 + m * MINUTE) for m in minutes]
        spark.createDataFrame(rows, "deployment string, at timestamp").coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema("deployment string, at timestamp").option("maxFilesPerTrigger", 1).parquet(folder)
    source = source.withWatermark("at", "2 minutes")
    alerts = sustained_stream(source, "deployment", MINUTE, 5 * MINUTE)
    out = str(tmp_path / "out")
    streaming.run_for(streaming.write_stream(alerts, out, str(tmp_path / "c")))
    got = sorted(tuple(r) for r in spark.read.schema(alerts.schema).parquet(out).collect())
    assert got == [("api", T0, T0 + 5 * MINUTE), ("api", T0 + 20 * MINUTE, T0 + 25 * MINUTE)]


def test_runs_end_by_gap_or_timer_and_leave_no_state(spark, tmp_path):
    """Key a breaks off by a gap, b falls silent, c is too short, d holds to the last step; unmet steps and beats move time on."""
    folder, beats = str(tmp_path / "steps"), str(tmp_path / "beats")
    schema = "pod string, at timestamp, value int"
    met = {"a": [*range(0, 6), *range(9, 12)], "b": range(0, 7), "c": range(2, 5), "d": range(8, 16)}
    for first in range(0, 16, 4):
        rows = [(p, T0 + m * MINUTE, int(m in met[p])) for p in met for m in range(first, first + 4) if p != "b" or m < 7]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([], "at timestamp").write.parquet(beats)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    clock = spark.readStream.schema("at timestamp").parquet(beats)
    awake = streaming.kept_awake(source, clock, "at", "1 minute")
    runs = ended_runs(awake, "pod", MINUTE, 5 * MINUTE, condition=F.col("value") == 1)
    out = str(tmp_path / "out")

    def run():
        query = streaming.write_stream(runs, out, str(tmp_path / "c"))
        streaming.run_for(query)
        return sorted(tuple(r) for r in spark.read.schema(runs.schema).parquet(out).collect()), query.lastProgress

    ended = [("a", T0, T0 + 5 * MINUTE, 6), ("b", T0, T0 + 6 * MINUTE, 7)]
    assert run()[0] == ended
    spark.createDataFrame([(T0 + 60 * MINUTE,)], "at timestamp").write.mode("append").parquet(beats)
    got, progress = run()
    assert got == [*ended, ("d", T0 + 8 * MINUTE, T0 + 15 * MINUTE, 8)]
    assert progress.stateOperators[0].numRowsTotal == 0
