"""Connected components of links between ids, in rounds of joins on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.store import stored


def _star(links: DataFrame, larger: bool, name: str) -> DataFrame:
    """Each node links some of its neighbours to the least id it knows.

    The larger neighbours in one kind of round, the smaller ones and itself in the other: components stay as they are
    and shrink towards stars. The least ids are a table of one row per node, so a node with very many links is an
    ordinary skewed join, which adaptive execution splits.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(stored(least, f"{name}-least"), "a")
    if larger:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = joined.select("a", F.col("m").alias("b"))
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return stored(out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)


def _all_stars(links: DataFrame) -> bool:
    """Whether no id has two smaller neighbours, or smaller and larger ones: then each is linked to its least id."""
    ends = links.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("b").alias("a"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    mixed = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    return mixed.isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every id in a link, the least id that can be reached from it. Ids are long and not null."""
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    pairs = stored(pairs, "links")

    while not _all_stars(pairs):
        pairs = _star(_star(pairs, True, "large-star"), False, "small-star")
    ends = pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ends.unionByName(pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
