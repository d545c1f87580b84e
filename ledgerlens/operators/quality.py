"""Data-quality profile of raw transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens.functions import int_or_null, number_or_null, timestamp_or_null
from ledgerlens.operators.skew import MIN_ROWS, lookup_join
from ledgerlens.schemas import KEY


def faults() -> dict[str, Column]:
    """The fault predicates, by name. Each is false (or NULL) on a good row."""
    terminal, when = F.col("terminal_id"), F.col("tx_datetime")
    return {
        "null_terminal": terminal.isNull(),
        "non_numeric_terminal": terminal.isNotNull() & int_or_null(terminal).isNull(),
        "negative_customer": F.col("customer_id") < 0,
        "invalid_date": when.isNotNull() & timestamp_or_null(when).isNull(),
        "zero_amount": F.col("tx_amount") == 0,
    }


def faulty_rows(raw: DataFrame, fault: str) -> DataFrame:
    return raw.filter(faults()[fault])


def fault_counts(raw: DataFrame) -> DataFrame:
    """(fault, rows) for every fault and the total, from one pass."""
    counts = {"total": F.count("*"), **{n: F.count_if(p) for n, p in faults().items()}}
    wide = raw.agg(*[c.alias(n) for n, c in counts.items()])
    return wide.unpivot([], list(counts), "fault", "rows")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, from one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "nulls")


def summary(df: DataFrame) -> DataFrame:
    """One row per column: count, mean, standard deviation, minimum and maximum, one pass.

    Mean and deviation of a text column are over the values that read as numbers; its
    extremes compare as text and stand in ``min_text`` and ``max_text``.
    """
    aggregates, blocks = [], []
    for i, field in enumerate(df.schema.fields):
        c = F.col(field.name)
        text = isinstance(field.dataType, T.StringType)
        number = number_or_null(c) if text else c.cast("double")
        names = [f"{s}_{i}" for s in ("n", "mean", "sd", "lo", "hi")]
        values = [F.count(c), F.avg(number), F.stddev(number), F.min(c), F.max(c)]
        aggregates += [v.alias(n) for v, n in zip(values, names, strict=True)]
        n, mean, sd, lo, hi = [F.col(name) for name in names]
        none_num, none_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        blocks.append(
            F.struct(
                F.lit(field.name).alias("column"),
                n.alias("count"),
                mean.alias("mean"),
                sd.alias("stddev"),
                (none_num if text else lo.cast("double")).alias("min"),
                (none_num if text else hi.cast("double")).alias("max"),
                (lo if text else none_text).alias("min_text"),
                (hi if text else none_text).alias("max_text"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*blocks)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def duplicate_rows(df: DataFrame, key: str = KEY, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rows whose key occurs more than once, with the number of occurrences; missing keys
    count as one key.

    Counts combine before their shuffle, and only repeated keys are joined back. A hot
    key's rows are not shuffled at all, where a window would sort them all in one task.
    """
    repeated = df.groupBy(key).agg(F.count("*").alias("dup_count")).filter("dup_count > 1")
    return lookup_join(df, repeated, [key], "inner", null_safe=True, min_rows=min_rows)


def preview(df: DataFrame, order_by: list[str], n: int = 20) -> DataFrame:
    """The first n rows in order (a top-n, not a sort of everything)."""
    return df.orderBy(*order_by).limit(n)


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows")).orderBy(column)
