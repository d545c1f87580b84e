"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame.

Times are returned as text and floats rounded, so that two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerlens.operators import clean as C
from ledgerlens.operators import decide as Z
from ledgerlens.operators import evaluate as E
from ledgerlens.operators import features as X
from ledgerlens.operators import featurestore as FS
from ledgerlens.operators import history as H
from ledgerlens.operators import monitor as M
from ledgerlens.operators import quality as Q
from ledgerlens.operators import scoring as S
from ledgerlens.operators.replay import replay
from ledgerlens.plans import derive as D
from ledgerlens.plans import jobs
from ledgerlens.schemas import LABEL, RAW
from ledgerlens.session import scratch_dir, stored
from ledgerlens.sources import files, manifest
from ledgerlens import streaming
from ledgerlens.streaming.alerts import ended_runs, sustained_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOUR = timedelta(hours=1)
LATENCY_BOUNDS = [10.0, 25.0, 50.0, 100.0, 250.0, 500.0]
SCORE_BOUNDS = [0.1, 0.25, 0.5, 0.75, 0.9]
SALT = "pepper"
REPLICATES = 10
VIEWS = [FS.DRIVER_EFFICIENCY, FS.DRIVER_ACTIVITY]
SHORT_VIEWS = [
    FS.FeatureView("efficiency", "driver_stats", ("conv_rate", "acc_rate"), ttl=timedelta(days=2)),
    FS.FeatureView("activity", "driver_stats", ("avg_daily_trips",), ttl=timedelta(days=1)),
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Times as text, floats as rounded doubles."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        out.append(c.alias(f.name))
    return df.select(*out)


def _off_ties(column: str) -> Column:
    """Moved off the middle between two rounded values, where means of cents often lie."""
    return (F.col(column) + 1e-9).alias(column)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(D.raw_transactions(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.with_features(cleaned(spark, sf_dir))


def scored_by_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.feature_rows(featured(spark, sf_dir), "tranaction_id")
    scored = rows.select(
        "tranaction_id",
        LABEL,
        D.CHAMPION.probability().alias("champion_p"),
        D.CANDIDATE.probability().alias("candidate_p"),
    )
    return stored(scored, "scored")


# ------------------------------------------------------------ flagship


@query
def fraud_by_time_of_week(spark, sf_dir):
    """Clean, derive features, score from coefficients, count outcomes."""
    scored = D.CHAMPION.score(featured(spark, sf_dir))
    out = scored.groupBy("is_weekend", "is_night").agg(
        F.count("*").alias("transactions"),
        F.count_if(F.col("prediction") == 1).alias("flagged"),
        F.sum(LABEL).alias("frauds"),
        F.avg("probability").alias("mean_probability"),
    )
    return comparable(out)


# ------------------------------------------------------------ scans and sinks


@query
def csv_scan_glob(spark, sf_dir):
    """Raw files per day, read back through one glob."""
    path = scratch_dir(spark, "raw")
    raw = D.raw_transactions(spark, sf_dir)
    day = F.date_format(F.timestamp_seconds("tx_time_seconds"), "yyyy-MM-dd")
    files.write_raw(raw.withColumn("day", day), path, ["day"])
    return files.read_raw(spark, f"{path}/day=*/*")


@query
def csv_scan_file_list(spark, sf_dir):
    """Raw files in two folders, read back as a list of paths."""
    path = scratch_dir(spark, "raw")
    raw = D.raw_transactions(spark, sf_dir)
    files.write_raw(raw.withColumn("half", F.pmod("customer_id", F.lit(2))), path, ["half"])
    return files.read_raw(spark, [f"{path}/half=0", f"{path}/half=1"])


@query
def parquet_round_trip(spark, sf_dir):
    """Cleaned data written by date and read back."""
    path = scratch_dir(spark, "cleaned")
    files.write_clean(cleaned(spark, sf_dir), path)
    return comparable(files.read_clean(spark, path).drop("tx_date"))


@query
def replay_messages(spark, sf_dir):
    """One and a half passes over the cleaned rows, as messages."""
    sent = replay(stored(cleaned(spark, sf_dir), "cleaned"), passes=1.5)
    return sent.select("position", F.from_json("value", RAW).alias("m")).select("position", "m.*")


@query
def replay_messages_sliced(spark, sf_dir):
    """The same with rows numbered in many slices."""
    sent = replay(stored(cleaned(spark, sf_dir), "cleaned"), passes=1.5, min_rows=50)
    return sent.select("position", F.from_json("value", RAW).alias("m")).select("position", "m.*")


def _manifest(ev: DataFrame) -> DataFrame:
    """Files of even days count as already processed."""
    return D.daily_files(ev.filter(F.dayofmonth("ts") % 2 == 0))


@query
def new_files(spark, sf_dir):
    ev = D.events(spark, sf_dir)
    return files.new_files(D.daily_files(ev), _manifest(ev))


@query
def manifest_update(spark, sf_dir):
    """Old files and new ones, committed as two versions and read back."""
    ev = D.events(spark, sf_dir)
    old = _manifest(ev)
    folder = scratch_dir(spark, "manifest")
    manifest.commit(old, folder, version=1)
    manifest.commit(files.new_files(D.daily_files(ev), old), folder, version=2)
    return manifest.latest(spark, folder)[0]


@query
def run_log(spark, sf_dir):
    """Evaluation metrics appended to a run log and read back."""
    metrics = E.evaluate(scored_by_both(spark, sf_dir), score="champion_p")
    path = scratch_dir(spark, "runs")
    metrics = metrics.select(*[F.format_number(c, 4).alias(c) for c in ("auc", "f1", "accuracy")], "rows")
    files.append_run_log(files.run_log_rows(metrics, "run-1", "metric"), path)
    return spark.read.parquet(path)


# ------------------------------------------------------------ cleaning and features


@query
def clean_transactions(spark, sf_dir):
    return comparable(cleaned(spark, sf_dir))


@query
def clean_any_survivor_ids(spark, sf_dir):
    """Ids left by the cleaning that keeps an arbitrary copy."""
    return C.clean(D.raw_transactions(spark, sf_dir), stable=False).select("tranaction_id")


@query
def incremental_cleaning(spark, sf_dir):
    """Rows of odd hours cleaned first, those of even hours added: copies, an hour apart, come in either order."""
    raw = D.raw_transactions(spark, sf_dir)
    path, out = scratch_dir(spark, "raw"), scratch_dir(spark, "cleaned")
    hour = F.pmod(F.floor(F.col("tx_time_seconds") / 3600), F.lit(2))
    files.write_raw(raw.withColumn("half", hour), path, ["half"])
    jobs.clean_files(spark, f"{path}/half=1", out)
    jobs.add_to_clean(spark, f"{path}/half=0", out)
    return comparable(files.read_clean(spark, out).drop("tx_date"))


@query
def time_features(spark, sf_dir):
    return comparable(X.feature_rows(featured(spark, sf_dir), "tranaction_id"))


@query
def hash_split_sides(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select("tranaction_id")
    train, test = X.hash_split(rows)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query
def time_split_sides(spark, sf_dir):
    """Train, valid and test by time, cut where exactly 70 and 85 percent of the rows have happened."""
    rows = stored(cleaned(spark, sf_dir).select("tranaction_id", "tx_datetime"), "times")
    return H.time_split(rows, "tx_datetime").select("tranaction_id", "side")


@query
def customer_history(spark, sf_dir):
    """Per transaction how many the customer has made in seven days, and their mean amount."""
    rows = stored(cleaned(spark, sf_dir).select("tranaction_id", "customer_id", "tx_datetime", "tx_amount"), "amounts")
    found = H.with_trailing(rows, ["customer_id"], "tx_datetime", "tx_amount", "week")
    return comparable(found.select("tranaction_id", "customer_id", "week_n", _off_ties("week_mean")))


@query
def terminal_history(spark, sf_dir):
    """The same per terminal, with narrow slices and every busy terminal on the path for hot keys."""
    rows = stored(cleaned(spark, sf_dir).select("tranaction_id", "terminal_id", "tx_datetime", "tx_amount"), "amounts")
    found = H.with_trailing(rows, ["terminal_id"], "tx_datetime", "tx_amount", "week", width=H.WEEK, min_rows=20)
    return comparable(found.select("tranaction_id", "terminal_id", "week_n", _off_ties("week_mean")))


@query
def amount_drift(spark, sf_dir):
    """Stability index of each week's amounts against those of the first ten days."""
    rows = stored(cleaned(spark, sf_dir).select("tx_datetime", "tx_amount"), "amounts")
    week, early = F.date_trunc("week", "tx_datetime"), F.col("tx_datetime") < "2024-01-11"
    return comparable(H.drift(rows, week, "tx_amount", LATENCY_BOUNDS, early))


@query
def score_drift(spark, sf_dir):
    """The same for the champion's scores, which fall and rise with the share of night hours."""
    rows = stored(D.CHAMPION.score(featured(spark, sf_dir)).select("tx_datetime", "probability"), "scores")
    week, early = F.date_trunc("week", "tx_datetime"), F.col("tx_datetime") < "2024-01-11"
    return comparable(H.drift(rows, week, "probability", SCORE_BOUNDS, early))


@query
def pseudonymous_customers(spark, sf_dir):
    """Transactions per customer, the id replaced by a salted hash."""
    rows = cleaned(spark, sf_dir).withColumn("customer", H.pseudonym(F.col("customer_id"), SALT))
    return Q.counts_by(rows, "customer")


# ------------------------------------------------------------ data quality


@query
def fault_counts(spark, sf_dir):
    return Q.fault_counts(D.raw_transactions(spark, sf_dir))


@query
def null_counts(spark, sf_dir):
    return Q.null_counts(D.raw_transactions(spark, sf_dir))


@query
def column_summary(spark, sf_dir):
    return comparable(Q.summary(D.raw_transactions(spark, sf_dir)), 3)


def _fault_query(fault: str) -> None:
    QUERIES[f"{fault}_rows"] = lambda spark, sf_dir: Q.faulty_rows(D.raw_transactions(spark, sf_dir), fault)


for _fault in ("null_terminal", "non_numeric_terminal", "negative_customer", "invalid_date", "zero_amount"):
    _fault_query(_fault)


@query
def invalid_terminal_values(spark, sf_dir):
    return Q.distinct_values(Q.faulty_rows(D.raw_transactions(spark, sf_dir), "non_numeric_terminal"), "terminal_id")


@query
def negative_customer_values(spark, sf_dir):
    return Q.distinct_values(Q.faulty_rows(D.raw_transactions(spark, sf_dir), "negative_customer"), "customer_id")


@query
def duplicate_rows(spark, sf_dir):
    return Q.duplicate_rows(D.raw_transactions(spark, sf_dir)).orderBy("tranaction_id", "tx_time_seconds")


@query
def repeated_customer_rows(spark, sf_dir):
    """Repeats by a key whose groups are large, on the path for hot keys."""
    raw = D.raw_transactions(spark, sf_dir).select("tranaction_id", "tx_time_seconds", "customer_id")
    return Q.duplicate_rows(raw, "customer_id", min_rows=60)


@query
def fraud_distribution(spark, sf_dir):
    return Q.counts_by(D.raw_transactions(spark, sf_dir), "tx_fraud")


@query
def scenario_distribution(spark, sf_dir):
    return Q.counts_by(D.raw_transactions(spark, sf_dir), "tx_fraud_scenario")


@query
def preview_rows(spark, sf_dir):
    return Q.preview(D.raw_transactions(spark, sf_dir), ["tranaction_id", "tx_time_seconds"], 20)


# ------------------------------------------------------------ feature store


@query
def point_in_time_features(spark, sf_dir):
    """Two views of one source plus on-demand scores, as of each entity row."""
    ev = D.events(spark, sf_dir)
    sources = {"driver_stats": D.driver_stats(ev)}
    return comparable(FS.historical_features(D.entity_rows(ev), sources, VIEWS, FS.driver_scores))


@query
def point_in_time_with_expiry(spark, sf_dir):
    """The same with lifetimes short enough to expire values."""
    ev = D.events(spark, sf_dir)
    return comparable(FS.asof_join(D.entity_rows(ev), D.driver_stats(ev), SHORT_VIEWS))


@query
def point_in_time_hot_keys(spark, sf_dir):
    """The same with every busy key cut into time slices."""
    ev = D.events(spark, sf_dir)
    return comparable(FS.asof_join(D.entity_rows(ev), D.driver_stats(ev), SHORT_VIEWS, min_rows=10))


@query
def point_in_time_from_files(spark, sf_dir):
    """The same with lifetimes, from a source written by date and read by path."""
    ev = D.events(spark, sf_dir)
    path = scratch_dir(spark, "features")
    FS.write_source(D.driver_stats(ev), path)
    asked = D.entity_rows(ev).filter("event_timestamp >= '2024-01-20'")
    return comparable(FS.features_from_files(asked, {"driver_stats": path}, SHORT_VIEWS))


@query
def latest_feature_values(spark, sf_dir):
    ev = D.events(spark, sf_dir)
    return comparable(FS.latest_features(D.driver_stats(ev), VIEWS))


@query
def incremental_feature_values(spark, sf_dir):
    """Materialised to mid-month, then continued with only the later rows."""
    stats = D.driver_stats(D.events(spark, sf_dir))
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    path = scratch_dir(spark, "latest")
    FS.latest_features(stats, VIEWS, end=cut).write.parquet(path)
    later = stats.filter(F.col("event_timestamp") > cut)
    return comparable(FS.latest_features(later, VIEWS, state=spark.read.parquet(path)))


@query
def online_features(spark, sf_dir):
    """Latest values and on-demand scores per request; some drivers are unknown."""
    ev = D.events(spark, sf_dir)
    latest = FS.latest_features(D.driver_stats(ev).filter("driver_id % 7 <> 0"), VIEWS)
    requests = D.entity_rows(ev).drop("event_timestamp")
    return comparable(FS.online_features(requests, latest, VIEWS, FS.driver_scores))


# ------------------------------------------------------------ scoring and models


@query
def score_from_coefficients(spark, sf_dir):
    """Probability and prediction from the shipped coefficients."""
    scored = S.SHIPPED.score(featured(spark, sf_dir))
    return scored.select("tranaction_id", F.round("probability", 6).alias("fraud_probability"), "prediction")


@query
def score_from_coefficient_file(spark, sf_dir):
    """Coefficients written to a file, loaded, and applied."""
    path = scratch_dir(spark, "coefficients")
    S.save_coefficients(spark, D.CHAMPION, path)
    scored = S.load_coefficients(spark, path).score(featured(spark, sf_dir))
    return scored.select("tranaction_id", F.round("probability", 6).alias("fraud_probability"), "prediction")


@query
def trained_model_metrics(spark, sf_dir):
    """Fit on 80 %, evaluate on the rest."""
    _, metrics = S.train(stored(featured(spark, sf_dir), "featured"))
    return comparable(metrics)


@query
def trained_model_agrees_with_its_coefficients(spark, sf_dir):
    """Fit, save, load, export; count rows where the two ways of scoring differ."""
    rows = stored(X.feature_rows(featured(spark, sf_dir), "tranaction_id"), "features")
    model = S.pipeline().fit(rows)
    path = scratch_dir(spark, "model")
    S.save_model(model, f"{path}/fitted")
    S.save_coefficients(spark, S.coefficients_of(model), f"{path}/coefficients")
    loaded = S.positive_probability(S.load_model(f"{path}/fitted").transform(rows))
    bare = S.load_coefficients(spark, f"{path}/coefficients")
    both = loaded.withColumn("bare", bare.probability())
    differs = (F.abs(F.col("bare") - F.col("probability")) > 1e-9) | (
        (F.col("bare") > 0.5).cast("double") != F.col("prediction")
    )
    return both.agg(F.count("*").alias("rows"), F.count_if(differs).alias("differing"))


@query
def exported_coefficient_rows(spark, sf_dir):
    """A fitted model's coefficient file as a table."""
    model = S.pipeline().fit(stored(X.feature_rows(featured(spark, sf_dir)), "features"))
    path = scratch_dir(spark, "coefficients")
    S.save_coefficients(spark, S.coefficients_of(model), path)
    return S.coefficient_rows(spark, path).select("pos", "name")


# ------------------------------------------------------------ evaluation


@query
def confusion_table(spark, sf_dir):
    return E.confusion(D.CHAMPION.score(featured(spark, sf_dir)))


@query
def model_metrics(spark, sf_dir):
    return comparable(E.evaluate(scored_by_both(spark, sf_dir), score="champion_p"))


@query
def model_metrics_sliced(spark, sf_dir):
    """The same with the score range cut into many slices."""
    return comparable(E.evaluate(scored_by_both(spark, sf_dir), score="champion_p", min_rows=50))


def _bootstrap(spark, sf_dir) -> DataFrame:
    scores = {"champion": "champion_p", "candidate": "candidate_p"}
    return E.bootstrap(scored_by_both(spark, sf_dir), scores, REPLICATES)


@query
def bootstrap_metrics(spark, sf_dir):
    return comparable(_bootstrap(spark, sf_dir))


@query
def bootstrap_mean_metrics(spark, sf_dir):
    return comparable(E.bootstrap_means(_bootstrap(spark, sf_dir)))


@query
def champion_against_candidate(spark, sf_dir):
    """t statistic, p-value, effect size and decision on the bootstrap replicates."""
    return comparable(E.compare(_bootstrap(spark, sf_dir)), 5)


@query
def latest_two_versions(spark, sf_dir):
    return E.latest_two_versions(D.model_versions(D.events(spark, sf_dir)))


@query
def resampled_rows(spark, sf_dir):
    """One bootstrap resample as rows."""
    return E.resample(cleaned(spark, sf_dir).select("tranaction_id"), replicate=3)


# ------------------------------------------------------------ thresholds and decisions


def _curve(spark, sf_dir) -> DataFrame:
    """The decision curve of scores to four digits, so that many rows share a score."""
    return Z.decision_curve(_rounded(spark, sf_dir), slice_rows=500)


def _rounded(spark, sf_dir, digits: int = 4) -> DataFrame:
    return stored(scored_by_both(spark, sf_dir).withColumn("probability", F.round("champion_p", digits)), "rounded")


@query
def decision_curve(spark, sf_dir):
    return _curve(spark, sf_dir)


@query
def recall_at_five_percent(spark, sf_dir):
    """The most recall with at most one in twenty legitimate transactions flagged."""
    return comparable(Z.recall_at(_curve(spark, sf_dir), 0.05))


@query
def average_precision(spark, sf_dir):
    return comparable(Z.average_precision(_curve(spark, sf_dir)))


@query
def best_threshold(spark, sf_dir):
    """The threshold of greatest expected value under the same bound."""
    return comparable(Z.best_threshold(_curve(spark, sf_dir), saved=100.0, checked=10.0, declined=5.0))


@query
def brier_score(spark, sf_dir):
    return comparable(Z.brier_score(scored_by_both(spark, sf_dir), score="champion_p"))


@query
def reliability_bins(spark, sf_dir):
    return comparable(Z.reliability(_rounded(spark, sf_dir)))


@query
def reliability_bands(spark, sf_dir):
    """Bands pooled by isotonic regression over scores to two digits, from many slices."""
    return comparable(Z.reliability_bands(_rounded(spark, sf_dir, 2), slice_rows=5))


@query
def precision_at_100(spark, sf_dir):
    return comparable(Z.precision_at(_rounded(spark, sf_dir), 100))


@query
def loss_report(spark, sf_dir):
    """Lost amounts and declined legitimate transactions per day, week and month after routing by two thresholds."""
    routed = Z.routed(D.CHAMPION.score(featured(spark, sf_dir)), review_from=0.5, decline_from=0.9)
    return comparable(Z.loss_report(routed, "tx_datetime", "tx_amount"), 4)


@query
def routed_decisions(spark, sf_dir):
    routed = Z.routed(D.CHAMPION.score(featured(spark, sf_dir)), review_from=0.5, decline_from=0.9)
    return routed.groupBy("decision", LABEL).agg(F.count("*").alias("rows"))


@query
def request_responses(spark, sf_dir):
    """Requests scored by the shipped coefficients; some lack an id."""
    return S.score_requests(D.requests(spark, sf_dir))[0]


@query
def request_rejects(spark, sf_dir):
    return comparable(S.score_requests(D.requests(spark, sf_dir))[1])


# ------------------------------------------------------------ messages and streams


@query
def parsed_messages(spark, sf_dir):
    """Message text to columns, features and completeness, on a batch."""
    rows = streaming.message_features(streaming.parse_messages(D.messages_from(D.events(spark, sf_dir))))
    return comparable(rows.drop("tx_ts"))


SCORED_FIELDS = (
    "tranaction_id long, customer_id long, terminal_id string, tx_amount double, "
    "ground_truth int, prediction int, event_time timestamp"
)


def _streamed(spark, sf_dir) -> DataFrame:
    """(topic, value) of all messages, scored by a stream that ends when its source is used up."""
    path = scratch_dir(spark, "scored")
    scored = streaming.score_messages(D.messages_from(D.event_stream(spark, sf_dir)), D.CHAMPION.score)
    started = streaming.write_stream(scored, f"{path}/out", f"{path}/checkpoint", partition_by="topic")
    streaming.run_for(started)
    return spark.read.schema("value string, topic string").parquet(f"{path}/out")


@query
def stream_scored(spark, sf_dir):
    rows = _streamed(spark, sf_dir).filter(F.col("topic") == streaming.SCORED)
    return comparable(rows.select(F.from_json("value", SCORED_FIELDS).alias("m")).select("m.*"))


@query
def stream_rejects(spark, sf_dir):
    rows = _streamed(spark, sf_dir).filter(F.col("topic") == streaming.REJECTED)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW.fields)
    return rows.select(F.from_json("value", fields).alias("m")).select("m.*")


@query
def stream_scored_by_fitted_model(spark, sf_dir):
    """A fitted model on the stream: messages per topic."""
    model = S.pipeline().fit(stored(X.feature_rows(featured(spark, sf_dir)), "features"))
    path = scratch_dir(spark, "scored")
    scored = streaming.score_messages(D.messages_from(D.event_stream(spark, sf_dir)), model.transform)
    started = streaming.write_stream(scored, f"{path}/out", f"{path}/checkpoint", partition_by="topic")
    streaming.run_for(started)
    out = spark.read.schema("value string, topic string").parquet(f"{path}/out")
    return out.groupBy("topic").agg(F.count("*").alias("messages"))


@query
def stream_outcome_counts(spark, sf_dir):
    """Running totals over a stream of scored transactions, in complete mode."""
    rows = streaming.message_features(streaming.parse_messages(D.messages_from(D.event_stream(spark, sf_dir))))
    totals = M.outcome_counts(D.CANDIDATE.score(rows.filter("complete")))
    path = scratch_dir(spark, "totals")
    streaming.run_for(streaming.write_totals(totals, f"{path}/out", f"{path}/checkpoint"))
    versions = spark.read.parquet(f"{path}/out")
    last = versions.groupBy().agg(F.max(F.struct("batch", *totals.columns)).alias("t"))
    return last.select(*[f"t.{c}" for c in totals.columns])


@query
def stream_event_rate(spark, sf_dir):
    """Hourly event rate on a stream; windows are emitted once the watermark closes them."""
    ev = D.event_stream(spark, sf_dir).withWatermark("ts", "10 minutes")
    path = scratch_dir(spark, "rate")
    rate = M.event_rate(ev, "ts", HOUR)
    streaming.run_for(streaming.write_stream(rate, f"{path}/out", f"{path}/checkpoint"))
    return comparable(spark.read.parquet(f"{path}/out"))


@query
def stream_sustained_alert(spark, sf_dir):
    """All replicas up for five hours in a row, watched on a stream of gauge samples."""
    samples = D.replica_samples(D.event_stream(spark, sf_dir).withWatermark("ts", "10 minutes"))
    steps = M.gauge(samples, HOUR, ["deployment"])
    path = scratch_dir(spark, "alerts")
    streaming.run_for(streaming.write_stream(steps, f"{path}/steps", f"{path}/steps_checkpoint"))
    closed = spark.readStream.schema(steps.schema).parquet(f"{path}/steps").withWatermark("window_end", "1 hour")
    alerts = sustained_stream(closed, "deployment", HOUR, 5 * HOUR, "window_end", F.col("value") == 6)
    streaming.run_for(streaming.write_stream(alerts, f"{path}/out", f"{path}/checkpoint"))
    return comparable(spark.read.schema(alerts.schema).parquet(f"{path}/out"))


def _to_the_end(spark, sf_dir, path, name, result):
    """Write ``result(beats)`` from a finite source, then once more after a beat two days past the last event.

    A live stream would take its beats from a clock; this one gets a single beat when the source has no more.
    """
    beat = D.events(spark, sf_dir).agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    beat.limit(0).write.parquet(f"{path}/{name}_beats")
    df = result(spark.readStream.schema(beat.schema).parquet(f"{path}/{name}_beats"))
    streaming.run_for(streaming.write_stream(df, f"{path}/{name}", f"{path}/{name}_checkpoint"))
    beat.write.mode("append").parquet(f"{path}/{name}_beats")
    streaming.run_for(streaming.write_stream(df, f"{path}/{name}", f"{path}/{name}_checkpoint"))
    return df.schema


@query
def stream_event_rate_to_the_end(spark, sf_dir):
    """Hourly event rate on a stream whose last windows are closed by a beat: the rows of the batch query."""
    path = scratch_dir(spark, "rate")
    ev = D.event_stream(spark, sf_dir)
    schema = _to_the_end(spark, sf_dir, path, "out", lambda beats: M.event_rate(streaming.kept_awake(ev, beats, "ts", "10 minutes"), "ts", HOUR))
    return comparable(spark.read.schema(schema).parquet(f"{path}/out"))


@query
def stream_ended_runs(spark, sf_dir):
    """Runs of five hours or more with all replicas up, each reported as it ends, the last one by a timer."""
    path = scratch_dir(spark, "runs")
    ev = D.event_stream(spark, sf_dir)

    def gauges(beats):
        return M.gauge(D.replica_samples(streaming.kept_awake(ev, beats, "ts", "10 minutes")), HOUR, ["deployment"])

    steps = _to_the_end(spark, sf_dir, path, "steps", gauges)

    def runs(beats):
        closed = spark.readStream.schema(steps).parquet(f"{path}/steps")
        awake = streaming.kept_awake(closed, beats.withColumnRenamed("ts", "window_end"), "window_end", "1 hour")
        return ended_runs(awake, "deployment", HOUR, 5 * HOUR, "window_end", F.col("value") == 6)

    schema = _to_the_end(spark, sf_dir, path, "out", runs)
    return comparable(spark.read.schema(schema).parquet(f"{path}/out"))


# ------------------------------------------------------------ monitoring


@query
def outcome_counts(spark, sf_dir):
    return M.outcome_counts(D.CHAMPION.score(featured(spark, sf_dir)))


@query
def event_rate(spark, sf_dir):
    return comparable(M.event_rate(D.events(spark, sf_dir), "ts", HOUR))


@query
def sliding_event_rate(spark, sf_dir):
    return comparable(M.event_rate(D.events(spark, sf_dir), "ts", 4 * HOUR, HOUR))


@query
def event_rate_by_type(spark, sf_dir):
    return comparable(M.event_rate(D.events(spark, sf_dir), "ts", HOUR, by=["event_type"]))


@query
def counter_rate_by_pod(spark, sf_dir):
    increases = M.counter_increases(D.counter_samples(D.events(spark, sf_dir)), ["pod"])
    return comparable(M.counter_rate(increases, HOUR, ["pod"]))


@query
def counter_rate_by_pod_hot_series(spark, sf_dir):
    """The same with every series cut into time slices."""
    increases = M.counter_increases(D.counter_samples(D.events(spark, sf_dir)), ["pod"], min_rows=50)
    return comparable(M.counter_rate(increases, HOUR, ["pod"]))


@query
def latency_p95(spark, sf_dir):
    """95th percentile per hour from a histogram of the values."""
    buckets = M.bucket_counts(D.events(spark, sf_dir), "ts", "value", HOUR, LATENCY_BOUNDS)
    return comparable(M.histogram_quantile(buckets, 0.95, ["window_start"]))


@query
def latency_p95_from_counters(spark, sf_dir):
    """95th percentile per six hours from cumulative bucket counters of all pods."""
    samples = D.bucket_samples(D.events(spark, sf_dir), LATENCY_BOUNDS)
    rates = M.counter_rate(M.counter_increases(samples, ["pod", "le"]), 6 * HOUR, ["le"])
    return comparable(M.histogram_quantile(rates, 0.95, ["window_start"], n="per_second"))


@query
def counter_totals(spark, sf_dir):
    return M.counter_total(D.counter_samples(D.events(spark, sf_dir)), ["pod"])


@query
def replica_gauge(spark, sf_dir):
    return comparable(M.gauge(D.replica_samples(D.events(spark, sf_dir)), HOUR, ["deployment"]))


@query
def cpu_utilisation(spark, sf_dir):
    ev = D.events(spark, sf_dir)
    rates = M.counter_rate(M.counter_increases(D.counter_samples(ev), ["pod"]), 5 * HOUR, ["pod"], HOUR)
    return comparable(M.utilisation(rates, D.pod_limits(ev)))


@query
def overload_alert(spark, sf_dir):
    """All replicas up and a pod above 80 %, held for five steps."""
    ev = D.events(spark, sf_dir)
    alert = M.overload_alert(
        D.counter_samples(ev), D.pod_limits(ev), D.replica_samples(ev), 5 * HOUR, HOUR, 5 * HOUR
    )
    return comparable(alert)
