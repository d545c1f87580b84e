"""Column expressions built only from Spark SQL functions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def int_or_null(c: Column) -> Column:
    """String to int, NULL when it is not a number; a fraction is cut off ('12.7' -> 12).

    Exponents ('1e3') stay NULL. Works the same with ANSI mode on or off.
    """
    whole = F.regexp_replace(c, r"^(\s*[+-]?\d+)\.\d*(\s*)$", "$1$2")
    return F.when(c.contains("."), whole).otherwise(c).try_cast("int")


def timestamp_or_null(c: Column) -> Column:
    """Lenient timestamp parse, NULL when unparseable."""
    return F.try_to_timestamp(c)


def strict_timestamp_or_null(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` only."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))


def midnight_repaired(c: Column) -> Column:
    """'<date> 24:00:00' becomes midnight of the same date (not of the next)."""
    wrong = " 24:00:00"
    date = F.substring(c, F.lit(1), F.length(c) - len(wrong))
    return F.when(c.endswith(wrong), F.concat(date, F.lit(" 00:00:00"))).otherwise(c)


def number_or_null(c: Column) -> Column:
    """String to double, NULL when it is not a number. The pattern comes first because a
    failing parse costs far more than a failing match."""
    number = r"(?i)^\s*([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?|[+-]?inf(inity)?|nan)\s*$"
    return F.when(c.rlike(number), c.try_cast("double"))


def zero_if_missing(c: Column) -> Column:
    """NULL and NaN become 0."""
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def linear(columns: Sequence[Column], weights: Sequence[float], intercept: float) -> Column:
    """Dot product plus intercept, as one generated expression."""
    z = F.lit(0.0)
    for column, weight in zip(columns, weights, strict=True):
        z = z + column * F.lit(float(weight))
    return z + F.lit(float(intercept))


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def decide(probability: Column, threshold: float = 0.5) -> Column:
    """1 above the threshold, 0 at or below it, NULL without a probability."""
    return F.when(probability > threshold, 1).when(probability.isNotNull(), 0)


def hash_hex(*parts: Column) -> Column:
    """md5 text of the parts: 32 hex digits that depend on values only, not on layout."""
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))


def hash_uniform(*parts: Column) -> Column:
    """A uniform number in [0, 1) from the first 32 bits of the hash."""
    first = F.substring(hash_hex(*parts), 1, 8)
    return F.conv(first, 16, 10).cast("double") / F.lit(4294967296.0)


def poisson1_thresholds() -> list[str]:
    """Inverse-CDF cut points of Poisson(1) as 8-digit hex; text order is number order."""
    cuts, cdf, k = [], 0.0, 0
    while True:
        cdf += math.exp(-1) / math.factorial(k)
        cut = int(cdf * 2**32)
        if cut >= 2**32 - 1:
            return cuts
        cuts.append(f"{cut:08x}")
        k += 1


def poisson1(hex8: str) -> Column:
    """A Poisson(1) draw from a SQL expression for eight uniform hex digits."""
    cuts = poisson1_thresholds()
    arms = " ".join(f"WHEN {hex8} < '{cut}' THEN {k}L" for k, cut in enumerate(cuts))
    return F.expr(f"CASE {arms} ELSE {len(cuts)}L END")


def erf(x: Column) -> Column:
    """erf for x >= 0 by its all-positive power series, to double precision.

    erf(x) = 2/sqrt(pi) * exp(-x^2) * x * sum_n (2x^2)^n / (1*3*...*(2n+1)).
    Beyond 6 the result is 1 in double precision.
    """
    capped = F.least(x, F.lit(6.0))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc: Column, n: Column) -> Column:
        term = acc["term"] * (F.lit(2.0) * capped * capped) / (F.lit(2.0) * n + F.lit(1.0))
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    terms = F.sequence(F.lit(1), F.lit(160))
    series = F.aggregate(terms, start, step, lambda acc: acc["total"])
    value = F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-capped * capped) * capped * series
    return F.least(value, F.lit(1.0))


def normal_two_sided_p(t: Column) -> Column:
    """P(|Z| > |t|) for a standard normal Z."""
    return F.lit(1.0) - erf(F.abs(t) / F.lit(math.sqrt(2.0)))
