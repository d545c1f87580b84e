"""Choosing a decision threshold and judging scores: recall under a bound on false alarms, average precision, expected value,
calibration, precision among the highest scores, and the decision itself.

Everything that depends on the order of scores is read off one table, the decision curve: per distinct score how
many frauds and legitimate rows have it, and how many have it or a higher one. Its sums run over slices of the
sorted table (``scan.py``); best thresholds are then plain aggregates. Rows without a score or a label take no part.
A row is flagged if its score reaches the threshold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.operators.scan import SLICE, SLICE_ROWS, in_slices, running_sums
from ledgerlens.schemas import KEY, LABEL
from ledgerlens.session import stored

FAN_IN = 64  # neighbouring slices merged at a time
BANDS = "slice long, low double, high double, rows long, frauds long"


def judged(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, fraud) of the rows that have both."""
    rows = scored.select(F.col(score).cast("double").alias("score"), (F.col(label) == 1).alias("fraud"))
    return rows.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("fraud").isNotNull())


def _per_score(scored: DataFrame, label: str, score: str) -> DataFrame:
    rows = judged(scored, label, score).withColumn("score", F.col("score") + 0.0)  # -0.0 and 0.0 are one score
    counts = rows.groupBy("score").agg(F.count_if("fraud").alias("frauds"), F.count_if(~F.col("fraud")).alias("legitimate"))
    return stored(counts, "scores")


def decision_curve(scored: DataFrame, label: str = LABEL, score: str = "probability", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(score, frauds, legitimate, caught, false_alarms), one row per distinct score: rows that have it, and rows that are flagged when it is
    the threshold. No rows give an empty curve."""
    sums = {"frauds": "caught", "legitimate": "false_alarms"}
    return running_sums(_per_score(scored, label, score), [], [F.desc("score")], sums, slice_rows)


def _with_rates(curve: DataFrame) -> DataFrame:
    """The curve with recall, false-alarm rate and precision of each threshold; totals are one row."""
    total = curve.agg(F.max("caught").alias("frauds"), F.max("false_alarms").alias("legitimate")).first()
    frauds, legitimate = (F.lit(total[c]).cast("double") for c in ("frauds", "legitimate"))
    return curve.withColumns(
        {
            "recall": F.try_divide("caught", frauds),
            "false_alarm_rate": F.coalesce(F.try_divide("false_alarms", legitimate), F.lit(0.0)),
            "precision": F.col("caught") / (F.col("caught") + F.col("false_alarms")),
        }
    )


def recall_at(curve: DataFrame, most_false_alarms: float = 0.05) -> DataFrame:
    """One row (threshold, recall, false_alarm_rate): the most recall with at most that share of legitimate rows flagged. Of equal
    recalls the highest threshold counts; threshold and rates are null if every threshold flags more."""
    allowed = _with_rates(curve).filter(F.col("false_alarm_rate") <= most_false_alarms)
    best = allowed.agg(F.max(F.struct("recall", "score", "false_alarm_rate")).alias("best"))
    return best.select(F.col("best.score").alias("threshold"), "best.recall", "best.false_alarm_rate")


def average_precision(curve: DataFrame) -> DataFrame:
    """One row: precision at each distinct score, weighed by the recall that this score adds. Null without frauds."""
    rates = _with_rates(curve)
    gained = F.sum(F.col("frauds") * F.col("precision"))
    return rates.agg(F.try_divide(gained, F.sum("frauds").cast("double")).alias("average_precision"))


def best_threshold(
    curve: DataFrame, saved: float, checked: float, declined: float, most_false_alarms: float = 0.05
) -> DataFrame:
    """One row (threshold, value, recall, precision, false_alarm_rate, flagged): the threshold of greatest expected value.

    A caught fraud saves ``saved``, each flagged row costs ``checked``, and a legitimate one ``declined`` besides. Flagging
    nothing is worth 0: the threshold is null where nothing better is allowed. Of equal values the highest
    threshold counts, which flags the fewest.
    """
    flagged = F.col("caught") + F.col("false_alarms")
    value = F.col("caught") * saved - flagged * checked - F.col("false_alarms") * declined
    worth = _with_rates(curve).withColumns({"value": value, "flagged": flagged})
    worth = worth.filter((F.col("false_alarm_rate") <= most_false_alarms) & (F.col("value") > 0))
    fields = ["value", "score", "recall", "precision", "false_alarm_rate", "flagged"]
    best = worth.agg(F.max(F.struct(*fields)).alias("best"))
    return best.select(
        F.col("best.score").alias("threshold"),
        F.coalesce("best.value", F.lit(0.0)).alias("value"),
        "best.recall",
        "best.precision",
        "best.false_alarm_rate",
        F.coalesce("best.flagged", F.lit(0)).alias("flagged"),
    )


# ------------------------------------------------------------ calibration


def brier_score(scored: DataFrame, label: str = LABEL, score: str = "probability") -> DataFrame:
    """One row (rows, brier): the mean squared distance of score and outcome."""
    missed = F.col("score") - F.col("fraud").cast("double")
    return judged(scored, label, score).agg(F.count("*").alias("rows"), F.avg(missed * missed).alias("brier"))


def reliability(scored: DataFrame, label: str = LABEL, score: str = "probability", bins: int = 10) -> DataFrame:
    """(bin, rows, mean_score, fraud_rate) for equal bins of [0, 1]; 1 belongs to the last, scores beyond go to the nearest."""
    number = F.least(F.greatest(F.floor(F.col("score") * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    grouped = judged(scored, label, score).groupBy(number.alias("bin"))
    return grouped.agg(
        F.count("*").alias("rows"), F.avg("score").alias("mean_score"), F.avg(F.col("fraud").cast("double")).alias("fraud_rate")
    )


def _pooling(fan_in: int):
    """A function for tasks, which need not have this package: neighbouring bands put together until fraud rates grow from
    band to band."""

    def pooled(bands: pd.DataFrame) -> pd.DataFrame:
        bands = bands.sort_values("low")
        kept: list[list] = []
        for low, high, rows, frauds in zip(bands["low"], bands["high"], bands["rows"], bands["frauds"]):
            kept.append([low, high, int(rows), int(frauds)])
            while len(kept) > 1 and kept[-2][3] * kept[-1][2] >= kept[-1][3] * kept[-2][2]:
                _, high_, rows_, frauds_ = kept.pop()
                kept[-1][1:] = [high_, kept[-1][2] + rows_, kept[-1][3] + frauds_]
        out = pd.DataFrame(kept, columns=["low", "high", "rows", "frauds"])
        # the number of the group in which this list meets its neighbours
        out.insert(0, "slice", np.int64(bands["slice"].iloc[0] // fan_in))
        return out

    return pooled


def reliability_bands(scored: DataFrame, label: str = LABEL, score: str = "probability", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(low, high, rows, fraud_rate): the bands of scores that isotonic regression pools, in which the observed rate grows.

    Pooling adjacent violators may start anywhere: slices of the sorted scores are pooled by themselves, then the bands of neighbouring slices
    together, ``FAN_IN`` slices at a time, until one list is left. A task sees a slice, or the bands of FAN_IN lists.
    """
    sliced = in_slices(_per_score(scored, label, score), ["score"], slice_rows, "bands")
    rows = F.col("frauds") + F.col("legitimate")
    bands = sliced.select(F.col(SLICE).cast("long").alias("slice"), F.col("score").alias("low"), F.col("score").alias("high"), rows.alias("rows"), "frauds")

    slices = sliced.agg(F.max(SLICE)).first()[0] or 0
    while True:
        bands = stored(bands.groupBy("slice").applyInPandas(_pooling(FAN_IN), BANDS), "bands")
        if not slices:
            break
        slices //= FAN_IN
    return bands.select("low", "high", "rows", (F.col("frauds") / F.col("rows")).alias("fraud_rate"))


# ------------------------------------------------------------ decisions


def precision_at(scored: DataFrame, k: int, label: str = LABEL, score: str = "probability", key: str = KEY) -> DataFrame:
    """One row (k, precision): the share of frauds among the k rows of highest score, ties by key; fewer rows give a smaller k."""
    rows = scored.select(key, F.col(score).alias("score"), (F.col(label) == 1).cast("double").alias("fraud"))
    rows = rows.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("fraud").isNotNull())
    top = rows.orderBy(F.desc("score"), key).limit(k)
    return top.agg(F.count("*").alias("k"), F.avg("fraud").alias("precision"))


def routed(scored: DataFrame, review_from: float, decline_from: float, score: str = "probability") -> DataFrame:
    """The rows with a ``decision``: approve, review or decline by two thresholds; without a score, review."""
    c: Column = F.col(score)
    decision = F.when(c.isNull() | F.isnan(c), "review").when(c >= decline_from, "decline").when(c >= review_from, "review")
    return scored.withColumn("decision", decision.otherwise("approve"))


def loss_report(decided: DataFrame, ts: str, amount: str, label: str = LABEL, decision: str = "decision") -> DataFrame:
    """(period, start, transactions, lost, frauds_lost, legitimate_declined, declined_share) per day, week and month.

    ``lost`` is the amount of frauds that were approved; ``declined_share`` that of legitimate rows that were declined. Each row is
    counted once, per day, and weeks, which begin on Monday, and months are sums of days.
    """
    fraud = F.col(label) == 1
    lost = fraud & (F.col(decision) == "approve")
    per_day = decided.groupBy(F.date_trunc("day", ts).alias("day")).agg(
        F.count("*").alias("transactions"),
        F.sum(F.when(lost, F.col(amount)).otherwise(0.0)).alias("lost"),
        F.count_if(lost).alias("frauds_lost"),
        F.count_if(~fraud).alias("legitimate"),
        F.count_if(~fraud & (F.col(decision) == "decline")).alias("legitimate_declined"),
    )
    starts = [F.struct(F.lit(p).alias("period"), F.date_trunc(p, "day").alias("start")) for p in ("day", "week", "month")]
    sums = ["transactions", "lost", "frauds_lost", "legitimate", "legitimate_declined"]
    periods = per_day.select("*", F.inline(F.array(*starts))).groupBy("period", "start").agg(*[F.sum(c).alias(c) for c in sums])
    share = F.coalesce(F.try_divide("legitimate_declined", F.col("legitimate").cast("double")), F.lit(0.0))
    return periods.withColumn("declined_share", share).drop("legitimate")
