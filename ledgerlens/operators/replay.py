"""Turning cleaned transactions back into messages."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.operators.scan import SLICE_ROWS, numbered
from ledgerlens.schemas import KEY, RAW

BLOCK = 10_000  # turns of a row listed at a time


def message_value() -> Column:
    """The row as JSON text, every field in its message type; NULL fields are left out."""
    fields = []
    for f in RAW.fields:
        c = F.col(f.name)
        if f.name == "tx_datetime":
            c = F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
        fields.append(c.cast(f.dataType).alias(f.name))
    return F.to_json(F.struct(*fields))


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The rows up to a value that at least n rows do not exceed, a little more than n as a rule: a cut that is estimated
    from a sketch and then counted, so that only the first rows need sorting. Missing values come first."""
    total = df.count()
    if n >= total:
        return df
    share = min(1.0, 1.02 * n / total + 0.001)
    cut = df.agg(F.percentile_approx(order, share, 10_000)).first()[0]
    head = df.filter((F.col(order) <= cut) | F.col(order).isNull()) if cut is not None else df
    return head if head.count() >= n else df


def replay(
    df: DataFrame,
    limit: int | None = None,
    passes: float | None = None,
    order: str = KEY,
    min_rows: int = SLICE_ROWS,
) -> DataFrame:
    """(position, value): ``limit`` messages (or ``passes`` times the table), going through
    the rows in order and starting over at the end. An empty table gives no messages.

    Each row works out on its own at which positions it is due. A limit below the size of the table sorts no
    more than the first rows. Turns are dealt out in blocks, so a short table replayed very often comes out of many tasks.
    """
    total = df.count()
    wanted = limit if limit is not None else math.floor(total * float(passes))
    spark = df.sparkSession
    if not total or wanted <= 0:
        return spark.createDataFrame([], "position long, value string")
    rows = numbered(first_rows(df, order, wanted), [F.asc_nulls_first(order)], "row", min_rows)
    turns = F.ceil((F.lit(wanted) - F.col("row")) / F.lit(total)) - 1
    due = rows.withColumn("last", turns.cast("long")).filter("last >= 0")
    due = due.withColumn("block", F.explode(F.expr(f"sequence(0L, last, {BLOCK}L)")))
    if wanted // total > BLOCK:
        due = due.repartition("row", "block")
    due = due.withColumn("turn", F.explode(F.expr(f"sequence(block, least(block + {BLOCK - 1}L, last))")))
    position = F.col("turn") * F.lit(total) + F.col("row")
    return due.select(position.alias("position"), message_value().alias("value"))
