"""Relation schemas. The misspelt ``tranaction_id`` is the data's real column name."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types of the raw files and messages.
RAW = T.StructType(
    [
        T.StructField("tranaction_id", T.LongType()),
        T.StructField("tx_datetime", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("terminal_id", T.StringType()),
        T.StructField("tx_amount", T.DoubleType()),
        T.StructField("tx_time_seconds", T.LongType()),
        T.StructField("tx_time_days", T.LongType()),
        T.StructField("tx_fraud", T.IntegerType()),
        T.StructField("tx_fraud_scenario", T.IntegerType()),
    ]
)

# The model's input columns, in coefficient order.
FEATURES = ["tx_amount", "hour_of_day", "day_of_week", "is_weekend", "is_night"]

KEY = "tranaction_id"
LABEL = "tx_fraud"

COEFFICIENT_FILE = T.StructType(
    [
        T.StructField("feature_names", T.ArrayType(T.StringType())),
        T.StructField("coefficients", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
    ]
)
