"""Domain relations derived from the test tables by arithmetic only.

No derivation needs a join or a window, so each stays one narrow pass over ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.operators.scoring import Coefficients
from ledgerlens.schemas import FEATURES, RAW
from ledgerlens.session import pin_utc

# Two models that split the test data into both classes.
CHAMPION = Coefficients(FEATURES, [0.03, -0.01, 0.02, 0.1, 0.2], -4.2)
CANDIDATE = Coefficients(FEATURES, [0.035, 0.002, 0.0, 0.05, 0.1], -3.8)


def _with_k(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "ts": F.col("ts").cast("timestamp"),
            "k": F.get_json_object("props", "$.k").cast("long"),
        }
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return _with_k(spark.read.parquet(f"{sf_dir}/events.parquet"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream."""
    pin_utc(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a stream takes a folder or a pattern, so name the table by a pattern
    return _with_k(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def _dirt(every: int) -> Column:
    return F.col("event_id") % every == 0


def raw_from(events: DataFrame) -> DataFrame:
    """Raw transactions with faults injected by id, and every 73rd row repeated an hour later."""
    copies = F.when(_dirt(73), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.withColumn("copy", F.explode(copies)).withColumn(
        "t", F.timestamp_seconds(F.unix_seconds("ts") + F.col("copy") * 3600)
    )
    fraud = (F.col("value") > 100) & (F.col("k") % 2 == 0)
    columns = {
        "tranaction_id": F.col("event_id"),
        "tx_datetime": F.when(_dirt(83), F.date_format("t", "yyyy-MM-dd' 24:00:00'")).otherwise(
            F.date_format("t", "yyyy-MM-dd HH:mm:ss")
        ),
        "customer_id": F.when(_dirt(89), -F.col("user_id") - 1).otherwise(F.col("user_id")),
        "terminal_id": F.when(_dirt(101), F.lit(None))
        .when(_dirt(97), F.lit("Err"))
        .otherwise(F.col("k").cast("string")),
        "tx_amount": F.when(_dirt(79), 0.0).otherwise(F.col("value")),
        "tx_time_seconds": F.unix_seconds("t"),
        "tx_time_days": F.floor(F.unix_seconds("t") / 86400),
        "tx_fraud": F.when(fraud, 1).otherwise(0),
        "tx_fraud_scenario": F.when(fraud, F.col("event_id") % 3 + 1).otherwise(0),
    }
    return rows.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW.fields])


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(events(spark, sf_dir))


def messages_from(events: DataFrame) -> DataFrame:
    """Raw transactions as (value, timestamp) messages; every 211th lacks its id and every
    223rd is not JSON."""
    rows = raw_from(events).withColumn("timestamp", F.timestamp_seconds("tx_time_seconds"))
    no_id = F.when(F.col("tranaction_id") % 211 != 0, F.col("tranaction_id"))
    fields = [no_id.alias("tranaction_id"), *[c for c in RAW.fieldNames() if c != "tranaction_id"]]
    text = F.when(F.col("tranaction_id") % 223 == 0, F.lit("not json")).otherwise(F.to_json(F.struct(*fields)))
    return rows.select(text.cast("binary").alias("value"), "timestamp")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests from raw transactions: every 50th lacks its id, every 79th its amount."""
    no_id = F.when(F.col("tranaction_id") % 50 != 0, F.col("tranaction_id"))
    no_amount = F.when(F.col("tranaction_id") % 79 != 0, F.col("tx_amount"))
    rows = raw_transactions(spark, sf_dir)
    return rows.select(no_id.alias("transaction_id"), no_amount.alias("tx_amount"), "tx_datetime")


def driver_stats(events: DataFrame) -> DataFrame:
    """Feature rows; event times are cut to the hour, so that equal times occur."""
    return events.filter("event_type = 'view'").select(
        F.col("user_id").alias("driver_id"),
        F.date_trunc("hour", "ts").alias("event_timestamp"),
        (F.date_trunc("hour", "ts") + F.make_dt_interval(hours=(F.col("event_id") % 7).cast("int"))).alias("created"),
        (F.col("value") / 500).cast("float").alias("conv_rate"),
        (F.col("k") / 100).cast("float").alias("acc_rate"),
        F.col("k").alias("avg_daily_trips"),
    )


def entity_rows(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").alias("driver_id"),
        F.date_trunc("hour", "ts").alias("event_timestamp"),
        (1 + (F.col("event_id") % 5) / 10).alias("surge_multiplier"),
    )


def counter_samples(events: DataFrame) -> DataFrame:
    """A cumulative counter per pod that restarts every 500 ids."""
    return events.select(
        (F.col("user_id") % 4).alias("pod"), "ts", (F.col("event_id") % 500).alias("value")
    )


def bucket_samples(events: DataFrame, bounds) -> DataFrame:
    """Cumulative histogram counters: (pod, le, ts, value), growing with the id and the bound."""
    last = len(bounds)
    le = [F.struct(F.lit(float(b)).alias("le"), F.lit(i).alias("i")) for i, b in enumerate(bounds)]
    le.append(F.struct(F.lit(float("inf")).alias("le"), F.lit(last).alias("i")))
    rows = events.select((F.col("user_id") % 4).alias("pod"), "ts", "event_id", F.inline(F.array(*le)))
    grown = F.floor(F.col("event_id") * (F.col("i") + 1) / (last + 1))
    return rows.select("pod", "le", "ts", grown.alias("value"))


def replica_samples(events: DataFrame) -> DataFrame:
    """A gauge: six replicas in every other half day, fewer otherwise."""
    half_day = F.floor(F.unix_seconds("ts") / 43200)
    return events.select(
        F.lit("api").alias("deployment"),
        "ts",
        F.when(half_day % 2 == 0, 6).otherwise(3 + F.col("event_id") % 3).cast("long").alias("value"),
    )


def pod_limits(events: DataFrame) -> DataFrame:
    """One limit per pod, a little above its mean counter growth."""
    seconds = F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))
    growth = F.max("event_id") - F.min("event_id")
    return events.groupBy((F.col("user_id") % 4).alias("pod")).agg((growth * 1.2 / seconds).alias("limit"))


def model_versions(events: DataFrame) -> DataFrame:
    """A version list per model, with versions as text."""
    return events.select(
        F.col("event_type").alias("model"),
        F.col("event_id").cast("string").alias("version"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
    )


def daily_files(events: DataFrame) -> DataFrame:
    return events.select(F.date_format("ts", "yyyy-MM-dd'.txt'").alias("file")).distinct()
