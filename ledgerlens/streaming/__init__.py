"""Scoring and counting on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions import timestamp_or_null
from ledgerlens.operators.features import with_features
from ledgerlens.schemas import FEATURES, KEY, LABEL, RAW

SCORED = "predictions"
REJECTED = "rejects"


def parse_messages(messages: DataFrame, text: str | None = None) -> DataFrame:
    """(value, timestamp) messages to the raw columns plus ``kafka_ts``, and the message's own text as column ``text``.

    Text that is not JSON gives NULLs throughout; a field of the wrong type gives NULL for
    that field.
    """
    parsed = F.from_json(F.col("value").cast("string"), RAW).alias("data")
    own = [F.col("value").cast("string").alias(text)] if text else []
    return messages.select(parsed, F.col("timestamp").alias("kafka_ts"), *own).select("data.*", "kafka_ts", *([text] if text else []))


def message_features(parsed: DataFrame) -> DataFrame:
    """Features from the message's time text, and ``complete``: an id and no NULL or NaN input."""
    featured = with_features(parsed.withColumn("tx_ts", timestamp_or_null(F.col("tx_datetime"))), "tx_ts")
    complete = F.col(KEY).isNotNull()
    for c in FEATURES:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(c)
    return featured.withColumn("complete", complete)


def score_messages(messages: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(topic, value): each message scored as JSON, or set aside as a reject.

    ``scorer`` adds ``prediction``; both ``Coefficients.score`` and a fitted model's
    ``transform`` fit. One read of the source feeds both topics: a message without an id or
    with an unusable feature is written to the reject topic, with its text as it came and the
    reason, and cannot stop the query.
    Works on batches and streams.
    """
    rows = message_features(parse_messages(messages, "__text"))
    # rejects carry zeros through the scorer, which may refuse NULLs; their score is unused
    safe = {c: F.when(F.col("complete"), F.col(c)).otherwise(0.0) for c in FEATURES}
    scored = scorer(rows.withColumn("__amount", F.col("tx_amount")).withColumns(safe))
    scored_value = F.to_json(
        F.struct(
            KEY,
            "customer_id",
            "terminal_id",
            F.col("__amount").alias("tx_amount"),
            F.col(LABEL).alias("ground_truth"),
            F.col("prediction").cast("int").alias("prediction"),
            F.col("kafka_ts").alias("event_time"),
            F.current_timestamp().alias("scored_at"),
        )
    )
    reject_value = F.to_json(
        F.struct(
            *[c for c in RAW.fieldNames() if c != "tx_amount"],
            F.col("__amount").alias("tx_amount"),
            F.col("kafka_ts").alias("event_time"),
            F.col("__text").alias("message"),
            F.when(F.col(KEY).isNull(), "no readable id").otherwise("unusable feature").alias("reason"),
        )
    )
    ok = F.col("complete")
    return scored.select(
        F.when(ok, F.lit(SCORED)).otherwise(F.lit(REJECTED)).alias("topic"),
        F.when(ok, scored_value).otherwise(reject_value).alias("value"),
    )


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None, live: bool = False) -> StreamingQuery:
    """Start a checkpointed append query to Parquet files.

    By default it takes what the source holds now and stops; ``live`` keeps it running. The
    checkpoint path must be stable: a restart goes on where the last run stopped.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if not live:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def write_totals(df: DataFrame, path: str, checkpoint: str, live: bool = False) -> StreamingQuery:
    """Start a query that, after every batch, writes the full current totals of a streaming
    aggregate as one more numbered version under ``path``."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", checkpoint)
    if not live:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def kept_awake(events: DataFrame, beats: DataFrame, ts: str, late: str) -> DataFrame:
    """``events`` with a watermark on ``ts`` that the stream ``beats`` moves on too.

    A window or run is closed by a later time, so the last ones of a source that falls silent would stay open. ``beats`` has
    a column ``ts`` (a clock, for instance) and its rows are gone from the result. Filters on other columns
    belong before this call: after it, Spark moves them below the watermark, and the beats with them.
    """
    marked = events.withColumn("__beat", F.lit(False))
    beats = beats.filter(F.col(ts).isNotNull()).select(ts, F.lit(True).alias("__beat"))
    both = marked.unionByName(beats, allowMissingColumns=True).withWatermark(ts, late)
    # one predicate that names the event time stays above the watermark
    return both.filter(~F.col("__beat") | F.col(ts).isNull()).drop("__beat")


def run_for(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for a finite query, or let a live one run for a while and stop it."""
    if seconds is None:
        query.awaitTermination()
    else:
        query.awaitTermination(int(seconds))
        query.stop()
