"""From raw text-typed transactions to typed, valid, unique ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions import int_or_null, midnight_repaired, timestamp_or_null
from ledgerlens.schemas import KEY


def valid_rows(raw: DataFrame) -> DataFrame:
    """Typed columns, bad rows gone; no shuffle.

    Drops a missing or non-integer terminal, a negative or missing customer, an
    unparseable time and an amount that is not above zero. '24:00:00' is repaired to
    midnight of the same date. A missing transaction id is kept.
    """
    # cheap comparisons first, so the parses run on fewer rows
    numbers_ok = raw.filter((F.col("customer_id") >= 0) & (F.col("tx_amount") > 0))
    typed = numbers_ok.withColumns(
        {
            "terminal_id": int_or_null(F.col("terminal_id")),
            "tx_datetime": timestamp_or_null(midnight_repaired(F.col("tx_datetime"))),
        }
    )
    return typed.filter(F.col("terminal_id").isNotNull() & F.col("tx_datetime").isNotNull())


def keep_one_per_id(df: DataFrame, key: str = KEY, first_by: str = "tx_datetime") -> DataFrame:
    """One row per key (missing keys count as one key): the smallest by ``first_by``, then
    by the remaining columns in order.

    The survivor does not depend on how rows are laid out. A minimum combines before the
    shuffle, so a key with very many copies travels as one row per task.
    """
    rest = [first_by] + [c for c in df.columns if c not in (key, first_by)]
    smallest = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("row"))
    return smallest.select(key, "row.*").select(*df.columns)


def keep_any_per_id(df: DataFrame, key: str = KEY) -> DataFrame:
    """One arbitrary row per key; which one may change from run to run."""
    return df.dropDuplicates([key])


def clean(raw: DataFrame, stable: bool = True) -> DataFrame:
    """All cleaning steps, lazily, with a single shuffle (on the transaction id)."""
    valid = valid_rows(raw)
    return keep_one_per_id(valid) if stable else keep_any_per_id(valid)


def merged_survivors(fresh: DataFrame, existing: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(survivors, replaced) when cleaned rows join cleaned rows of earlier files.

    ``survivors`` holds one row for each id of ``fresh``, the same one that cleaning all files together keeps: the smallest
    of a set is the smaller of its parts' smallest. ``replaced`` are the existing rows of these ids. A missing id counts as one
    id. Existing rows of other ids are looked up by id only and not shuffled again where Spark can filter them first.
    """
    ids = fresh.select(F.col(key).alias("__id"))
    replaced = existing.join(ids, existing[key].eqNullSafe(ids["__id"]), "left_semi")
    return keep_one_per_id(fresh.unionByName(replaced), key), replaced
