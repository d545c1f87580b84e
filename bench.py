"""Headline timings: prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1) and BENCH_CPUS the local cores. Every query
writes its whole result to Spark's no-op sink. The streaming figure replays the cleaned
rows as about two million messages and scores them through a checkpointed file stream.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from ledgerlens import streaming
from ledgerlens.operators.replay import replay
from ledgerlens.plans import catalog as K
from ledgerlens.plans import derive as D
from ledgerlens.session import build_session, scratch_dir

HEADLINE = [
    "fraud_by_time_of_week",
    "clean_transactions",
    "parquet_round_trip",
    "fault_counts",
    "column_summary",
    "duplicate_rows",
    "point_in_time_features",
    "latest_feature_values",
    "online_features",
    "score_from_coefficients",
    "model_metrics",
    "bootstrap_metrics",
    "champion_against_candidate",
    "trained_model_metrics",
    "replay_messages",
    "stream_scored",
    "stream_outcome_counts",
    "stream_event_rate",
    "event_rate_by_type",
    "counter_rate_by_pod",
    "latency_p95",
    "overload_alert",
]
MESSAGES = 2_000_000


def stream_throughput(spark, sf_dir: str) -> float:
    """Messages scored per second, from first read to last committed write."""
    path = scratch_dir(spark, "throughput")
    rows = K.stored(K.cleaned(spark, sf_dir), "cleaned")
    sent = replay(rows, limit=MESSAGES).select(
        F.col("value").cast("binary"), F.timestamp_seconds("position").alias("timestamp")
    )
    sent.repartition(32).write.parquet(f"{path}/messages")
    source = spark.readStream.schema("value binary, timestamp timestamp").parquet(f"{path}/messages")
    scored = streaming.score_messages(source, D.CHAMPION.score)
    started = time.time()
    streaming.run_for(streaming.write_stream(scored, f"{path}/out", f"{path}/checkpoint", "topic"))
    return MESSAGES / (time.time() - started)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.time()
        K.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.time() - started

    run("fraud_by_time_of_week")  # start-up costs are not the query's
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "stream_messages_per_second": round(stream_throughput(spark, sf_dir)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
