"""Whole jobs, put together from the operators: clean, train, validate, replay, score a stream."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens import streaming
from ledgerlens.operators import clean as C
from ledgerlens.operators import evaluate as E
from ledgerlens.operators import features as X
from ledgerlens.operators import scoring as S
from ledgerlens.operators.replay import replay
from ledgerlens.schemas import FEATURES, KEY, LABEL
from ledgerlens.session import pin_utc, scratch_dir, stored
from ledgerlens.sources import files, kafka, manifest


def clean_files(spark: SparkSession, paths: str | list[str], out: str) -> None:
    """Raw files to cleaned Parquet by date, replacing what was there."""
    pin_utc(spark)
    files.write_clean(C.clean(files.read_raw(spark, paths)), out)


def add_to_clean(spark: SparkSession, paths: str | list[str], out: str) -> None:
    """Clean raw files into ``out``, which holds the cleaned rows of other files: as if all had been cleaned together.

    Only dates that get or lose a row are written anew. Repeating a run, or a run that died while it replaced dates,
    changes nothing that is right already.
    """
    pin_utc(spark)
    existing = files.read_clean(spark, out)
    fresh = stored(C.clean(files.read_raw(spark, paths)), "fresh")
    columns = fresh.columns
    survivors, replaced = C.merged_survivors(fresh, existing.select(*columns))
    survivors, replaced = stored(survivors, "survivors"), stored(replaced, "replaced")
    touched = survivors.select(F.to_date("tx_datetime").alias("d")).union(replaced.select(F.to_date("tx_datetime")))
    dates = [r["d"] for r in touched.distinct().collect()]  # one per date
    if not dates:
        return
    ids = fresh.select(F.col(KEY).alias("__id"))
    kept = existing.filter(F.col("tx_date").isin(dates)).select(*columns)
    kept = kept.join(ids, kept[KEY].eqNullSafe(ids["__id"]), "left_anti")
    whole = stored(kept.unionByName(survivors), "dates")
    files.replace_dates(whole, out, [str(d) for d in dates])


def clean_new_files(
    spark: SparkSession, folder: str, out: str, manifest_folder: str, incremental: bool = False
) -> bool:
    """Run the cleaning if the folder holds files the manifest lacks; True if it ran.

    By default everything is cleaned again. ``incremental`` reads the new files only and gives the same rows. The files
    are committed to the manifest last; a run that failed before is repeated by the next one, and of two runs at once
    the later one is told by ``manifest.VersionTaken``.
    """
    listing = files.list_files(spark, folder)
    known, version = manifest.latest(spark, manifest_folder)
    added = stored(files.new_files(listing, known), "new-files")
    if added.isEmpty():
        return False
    if incremental and version:
        # the reader takes its paths from the driver; only the new ones are listed
        add_to_clean(spark, [os.path.join(folder, r["file"]) for r in added.collect()], out)
    else:
        clean_files(spark, os.path.join(folder, "*.txt"), out)
    manifest.commit(added, manifest_folder, version + 1)
    return True


def model_rows(spark: SparkSession, clean_path: str) -> DataFrame:
    """Id, features and label of all complete cleaned rows."""
    return X.feature_rows(X.with_features(files.read_clean(spark, clean_path)), "tranaction_id")


def train_model(spark: SparkSession, clean_path: str, model_path: str, log_path: str, run_id: str) -> DataFrame:
    """Fit on the training side of the split, save the model, log parameters and metrics;
    gives the one-row metrics."""
    model, metrics = S.train(model_rows(spark, clean_path))
    S.save_model(model, model_path)
    result = metrics.collect()  # one row
    metrics = spark.createDataFrame(result, metrics.schema)
    parameters = spark.createDataFrame(
        [("LogisticRegression", S.MAX_ITER, S.REG_PARAM, ",".join(FEATURES))],
        "model string, maxIter int, regParam double, features string",
    )
    files.append_run_log(files.run_log_rows(parameters, run_id, "param"), log_path)
    files.append_run_log(files.run_log_rows(metrics, run_id, "metric"), log_path)
    return metrics


def validate_model(
    spark: SparkSession,
    clean_path: str,
    versions: DataFrame,
    name: str,
    log_path: str,
    run_id: str,
    replicates: int = 10,
    alpha: float = 0.05,
) -> DataFrame | None:
    """Newest version of a model against the one before it, on the test side of the split.

    ``versions`` holds (model, version, run_id, path). Gives the one-row comparison, or None
    when there are fewer than two versions. The decision is reported, not carried out.
    """
    pair = E.latest_two_versions(versions.filter(F.col("model") == name)).first()
    if pair is None:
        return None
    _, rows = X.hash_split(model_rows(spark, clean_path))
    for side in ("champion", "candidate"):
        number = F.col("version").try_cast("int") == pair[f"{side}_version"]
        path = versions.filter((F.col("model") == name) & number).first()["path"]
        scored = S.positive_probability(S.load_model(path).transform(rows))
        rows = scored.withColumnRenamed("probability", f"{side}_p").drop("features", "rawPrediction", "prediction")
    stored = scratch_dir(spark, "validation")
    rows.select("tranaction_id", LABEL, "champion_p", "candidate_p").write.parquet(stored)
    scores = {"champion": "champion_p", "candidate": "candidate_p"}
    verdict = E.compare(E.bootstrap(spark.read.parquet(stored), scores, replicates), alpha=alpha)
    verdict = spark.createDataFrame(verdict.collect(), verdict.schema)  # one row
    parameters = spark.createDataFrame(
        [(replicates, alpha, pair["candidate_version"], pair["champion_version"])],
        "bootstrap_iterations int, alpha double, candidate_version int, champion_version int",
    )
    files.append_run_log(files.run_log_rows(parameters, run_id, "param"), log_path)
    files.append_run_log(files.run_log_rows(verdict, run_id, "metric"), log_path)
    return verdict


def replay_to_kafka(spark: SparkSession, clean_path: str, access: kafka.KafkaAccess, topic: str, limit: int = 1500) -> None:
    kafka.send_messages(replay(files.read_clean(spark, clean_path), limit=limit), access, topic)


def score_kafka_stream(
    spark: SparkSession, access: kafka.KafkaAccess, topic: str, model_path: str, checkpoint: str
) -> StreamingQuery:
    """Start scoring a topic; predictions and rejects go to the topics of those names."""
    scored = streaming.score_messages(
        kafka.read_messages(spark, access, topic), S.load_model(model_path).transform
    )
    return kafka.write_messages(scored, access, checkpoint)
