"""Ordered scans over tables of any size: ranks, running sums and running maxima.

Rows are sorted once into range partitions, the *slices*, and written with the number of their slice. A slice is one
task's share, so more rows make more slices and not larger ones; slices asked to be smaller than that grow up to it once
there are ``FEW`` of them, as a task has a cost of its own. What a slice hands on to the later ones is its total per
group; the totals form a small table of their own, which is scanned in two levels, blocks of slices first. So no
step depends on a list of cut points in the driver and no number of slices is too large. Slices are sorted by group, so only
the first group of a slice gets anything from before: what is handed on is a row per slice at most, and is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.session import stored

SLICE_ROWS = 1_000_000
BLOCK = 1024  # slices per block of the second level
FEW = 256  # slices that may be smaller than a task's share
SLICE, PLACE = "__slice", "__place"


def slices_of(rows: int, slice_rows: int = SLICE_ROWS) -> int:
    """Into how many slices that many rows are cut."""
    share = max(slice_rows, min(SLICE_ROWS, -(-rows // FEW)))
    return max(1, -(-rows // share))


def in_slices(df: DataFrame, order: Sequence[str | Column], slice_rows: int = SLICE_ROWS, name: str = "slices") -> DataFrame:
    """The rows in that order, with the number of their slice and their place in all slices' numbering (growing, with gaps).

    Rows that are equal in ``order`` stay in one slice, so ``order`` should tell heavy ties apart. The input is
    looked at three times (count, sample, sort): it should be a stored table.
    """
    placed = df.repartitionByRange(slices_of(df.count(), slice_rows), *order).sortWithinPartitions(*order)
    return stored(placed.withColumns({SLICE: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()}), name)


def before(
    totals: DataFrame,
    groups: Sequence[str],
    columns: Mapping[str, str],
    aggregate: Callable[[str], Column],
    combine: Callable[[Column, Column], Column],
) -> DataFrame:
    """(groups..., slice, columns...): per slice and group, the aggregate over the group's earlier slices; null if none.

    ``columns`` maps a column of ``totals`` to the name of what lies before it. A window sees the slices of one block, or one row
    per block.
    """
    blocked = totals.withColumn("__block", F.floor(F.col(SLICE) / BLOCK))
    of_blocks = blocked.groupBy(*groups, "__block").agg(*[aggregate(c).alias(c) for c in columns])
    earlier = {
        level: Window.partitionBy(*groups, *also).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        for level, also, by in (("block", [], "__block"), ("slice", ["__block"], SLICE))
    }
    outer = of_blocks.select(*groups, "__block", *[aggregate(c).over(earlier["block"]).alias(f"__outer_{c}") for c in columns])
    inner = blocked.select(*groups, "__block", SLICE, *[aggregate(c).over(earlier["slice"]).alias(f"__inner_{c}") for c in columns])
    renamed = outer.withColumnsRenamed({g: f"__of_{g}" for g in [*groups, "__block"]})
    same = F.lit(True)
    for g in (*groups, "__block"):
        same = same & inner[g].eqNullSafe(renamed[f"__of_{g}"])

    def both(c: str) -> Column:
        inside, outside = F.col(f"__inner_{c}"), F.col(f"__outer_{c}")
        return F.coalesce(combine(inside, outside), inside, outside)

    return inner.join(renamed, same).select(*groups, SLICE, *[both(c).alias(out) for c, out in columns.items()])


def _with_carry(rows: DataFrame, carry: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The carry of each row's slice and group beside it, null where there is none; null groups match. At most one row of
    ``carry`` per slice has anything, so the rows stay where they are."""
    keys = [*groups, SLICE]
    some = reduce(Column.__or__, [F.col(c).isNotNull() for c in carry.columns if c not in keys])
    other = F.broadcast(carry.filter(some).withColumnsRenamed({k: f"__of_{k}" for k in keys}))
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(other[f"__of_{k}"])
    return rows.join(other, same, "left").drop(*[f"__of_{k}" for k in keys])


def numbered(df: DataFrame, order: Sequence[str | Column], out: str = "row", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Each row's rank in that order, from 0. The order should be unique; equal rows are ranked in some order."""
    sliced = in_slices(df, order, slice_rows, "numbered")
    sizes = sliced.groupBy(SLICE).agg(F.min(PLACE).alias("__first"), F.count("*").alias("__n"))
    starts = before(sizes, [], {"__n": "__start"}, F.sum, lambda a, b: a + b).join(sizes.select(SLICE, "__first"), SLICE)
    placed = _with_carry(sliced, starts, [])
    rank = F.coalesce("__start", F.lit(0)) + F.col(PLACE) - F.col("__first")
    return placed.withColumn(out, rank).drop(SLICE, PLACE, "__start", "__first")


def running_sums(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str | Column],
    sums: Mapping[str, str],
    slice_rows: int = SLICE_ROWS,
    inclusive: bool = True,
) -> DataFrame:
    """Sums of numeric columns over each row and the rows of its group before it, or over the rows before it only; 0 if none.

    ``sums`` maps a column to the name of its running sum. ``order`` has to be unique within a group.
    """
    sliced = in_slices(df, [*groups, *order], slice_rows, "running")
    totals = sliced.groupBy(*groups, SLICE).agg(*[F.sum(c).alias(c) for c in sums])
    carry = before(totals, groups, {c: f"__before_{c}" for c in sums}, F.sum, lambda a, b: a + b)
    end = Window.currentRow if inclusive else -1
    within = Window.partitionBy(SLICE, *groups).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, end)
    inner = sliced.withColumns({out: F.coalesce(F.sum(c).over(within), F.lit(0)) for c, out in sums.items()})
    placed = _with_carry(inner, carry, groups)
    whole = {out: F.col(out) + F.coalesce(f"__before_{c}", F.lit(0)) for c, out in sums.items()}
    return placed.withColumns(whole).drop(SLICE, PLACE, *[f"__before_{c}" for c in sums])


def running_max(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str | Column],
    value: str | Column,
    out: str,
    slice_rows: int = SLICE_ROWS,
    inclusive: bool = True,
) -> DataFrame:
    """The greatest ``value`` of each row and the rows of its group before it, or of the rows before it only; null if none.

    Rows that are equal in ``order`` should differ in no way that matters: which of them comes first is open.
    """
    sliced = in_slices(df, [*groups, *order], slice_rows, "running")
    totals = sliced.groupBy(*groups, SLICE).agg(F.max(value).alias("__top"))
    carry = before(totals, groups, {"__top": "__before"}, F.max, F.greatest)
    end = Window.currentRow if inclusive else -1
    within = Window.partitionBy(SLICE, *groups).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, end)
    placed = _with_carry(sliced.withColumn("__within", F.max(value).over(within)), carry, groups)
    return placed.withColumn(out, F.greatest("__within", "__before")).drop(SLICE, PLACE, "__within", "__before")
