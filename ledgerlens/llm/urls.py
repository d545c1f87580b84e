"""URL filters: host and path rules first, then a logistic regression on hashed character n-grams of host and path.

Everything runs as DataFrame operations and Spark's own feature and model stages.

A null url, or one without ``://``, has an empty host and path. A rule fits its host and all subdomains of it, if the
path starts with the rule's path; of several that fit the longest wins. Where the labelled urls have one class only,
that class is the verdict for urls without a rule; where there are none, such urls are allowed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.labelled import sample


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    host, path = split_url(F.col(url_col))
    return pages.withColumns({"host": host, "path": path})


def matched(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The rule that fits and its verdict, or nulls. Rules are tried from the longest; equal ones in the order given."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def _grams(df: DataFrame, features: int, sizes: tuple[int, ...]) -> DataFrame:
    """Hashed character n-grams; ``^``, ``|`` and ``$`` mark the begin, the border of host and path, and the end."""
    chars = F.split(F.concat(F.lit("^"), F.col("host"), F.lit("|"), F.col("path"), F.lit("$")), "")
    df = df.withColumn("__chars", F.filter(chars, lambda c: c != ""))
    for n in sizes:
        df = NGram(n=n, inputCol="__chars", outputCol=f"__{n}").transform(df)
    df = df.withColumn("__grams", F.concat(*[f"__{n}" for n in sizes]))
    df = HashingTF(numFeatures=features, binary=True, inputCol="__grams", outputCol="__features").transform(df)
    return df.drop("__chars", "__grams", *[f"__{n}" for n in sizes])


class Model(NamedTuple):
    regression: LogisticRegressionModel | None
    constant: str
    features: int
    sizes: tuple[int, ...]


def fit(labelled: DataFrame, most: int = 20_000, features: int = 1 << 14, sizes: tuple[int, ...] = (2, 3, 4)) -> Model:
    """From (host, path, verdict); at most ``most`` different urls, those that hash least."""
    rows = labelled.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rows = sample(rows.withColumn("__url", F.concat_ws("|", "host", "path")), "__url", most).drop("__url")
    rows = rows.withColumn("label", (F.col("verdict") == "block").cast("double"))
    of = {r["verdict"]: r["count"] for r in rows.groupBy("verdict").count().collect()}
    if len(of) < 2:
        return Model(None, next(iter(of), "allow"), features, sizes)
    total = sum(of.values())
    # both classes weigh the same
    weight = F.when(F.col("verdict") == "block", total / of["block"]).otherwise(total / of["allow"])
    known = _grams(rows.withColumn("weight", weight), features, sizes)
    regression = LogisticRegression(featuresCol="__features", labelCol="label", weightCol="weight", regParam=0.01, maxIter=30)
    return Model(regression.fit(known), "allow", features, sizes)


def judge(pages: DataFrame, model: Model, url_col: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row with host, path, rule, verdict and block_score (the regression's probability of block; null without one)."""
    rule, verdict = matched(rules)
    parts = with_parts(pages, url_col).withColumns({"rule": rule, "__verdict": verdict})
    if model.regression is None:
        return parts.withColumns({"verdict": F.coalesce("__verdict", F.lit(model.constant)), "block_score": F.lit(None).cast("double")}).drop("__verdict")
    graded = model.regression.setProbabilityCol("__probability").setRawPredictionCol("").setPredictionCol("").transform(_grams(parts, model.features, model.sizes))
    score = vector_to_array("__probability")[1]
    graded = graded.withColumn("block_score", score)
    guess = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return graded.withColumn("verdict", F.coalesce("__verdict", guess)).drop("__verdict", "__features", "__probability")


def labelled_by_rules(pages: DataFrame, url_col: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A labelled table of the urls that a rule decides."""
    return with_parts(pages, url_col).withColumn("verdict", matched(rules)[1]).filter("verdict is not null").select("host", "path", "verdict")
