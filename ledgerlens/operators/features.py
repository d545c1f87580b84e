"""Time and amount features of a transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions import hash_uniform
from ledgerlens.schemas import FEATURES, KEY, LABEL


def with_features(df: DataFrame, ts: str = "tx_datetime") -> DataFrame:
    """Add the model's inputs, all doubles; works on batches and streams alike.

    Weekdays run from 1 (Sunday) to 7 (Saturday); night is hours 0 to 6. A missing
    time gives a missing hour and weekday, and 0.0 for weekend and night.
    """
    hour, weekday = F.hour(ts), F.dayofweek(ts)
    return df.withColumns(
        {
            "hour_of_day": hour.cast("double"),
            "day_of_week": weekday.cast("double"),
            "is_weekend": F.when(weekday.isin(1, 7), 1.0).otherwise(0.0),
            "is_night": F.when(hour.between(0, 6), 1.0).otherwise(0.0),
            "tx_amount": F.col("tx_amount").cast("double"),
        }
    )


def feature_rows(df: DataFrame, *also: str) -> DataFrame:
    """Features and label (plus any other columns), without rows that miss one (NULL or NaN)."""
    needed = [*FEATURES, LABEL]
    return df.select(*also, *needed).na.drop(subset=needed)


def hash_split(df: DataFrame, train_share: float = 0.8, key: str = KEY, seed: int = 42):
    """(train, test) by a hash of the key: the same rows land on the same side for any
    file layout or partitioning, and both sides are plain filters."""
    u = hash_uniform(F.lit(seed), F.col(key))
    return df.filter(u < train_share), df.filter(u >= train_share)
