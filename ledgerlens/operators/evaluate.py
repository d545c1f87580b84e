"""Model evaluation, bootstrap comparison and the promotion decision.

All metrics of all replicates come from one table: per distinct score, the weight of
positive and of negative rows. Ranks need the scores in order; running sums over slices of
that table (``scan.py``) supply what lies below each score.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions import hash_hex, normal_two_sided_p, poisson1
from ledgerlens.operators.scan import SLICE_ROWS, running_sums
from ledgerlens.schemas import KEY, LABEL
from ledgerlens.session import stored


def _ratio(a: Column, b: Column) -> Column:
    """a / b, or 0 when there is nothing to divide by."""
    return F.when(b == 0, 0.0).otherwise(F.try_divide(a, b))


# One replicate's metrics from its totals; {r} is the replicate's number.
_REPLICATE = """
    named_struct(
        'replicate', {r},
        'auc', try_divide(u{r}, pos{r} * neg{r}),
        'f1', try_divide(pos{r} * {fraud} + neg{r} * {legit}, pos{r} + neg{r}),
        'accuracy', try_divide(tp{r} + neg{r} - fp{r}, pos{r} + neg{r}),
        'fraud_f1', {fraud},
        'rows', cast(pos{r} + neg{r} as bigint))"""
_FRAUD_F1 = "coalesce(try_divide(2 * tp{r}, tp{r} + fp{r} + pos{r}), 0D)"
_LEGIT_F1 = "coalesce(try_divide(2 * (neg{r} - fp{r}), 2 * neg{r} - fp{r} + pos{r} - tp{r}), 0D)"


def _metrics(rows: DataFrame, weights: int, threshold: float, slice_rows: int) -> DataFrame:
    """(model, replicate, auc, f1, ...) from rows (model, score, positive, w0, w1, ...).

    Written as SQL text: there are a dozen expressions per replicate.
    """

    def per_replicate(*templates: str) -> list[Column]:
        return [F.expr(t.format(r=r)) for t in templates for r in range(weights)]

    per_score = rows.groupBy("model", "score").agg(
        *per_replicate("sum(if(positive, w{r}, 0)) AS p{r}", "sum(if(positive, 0, w{r})) AS n{r}")
    )
    below = {f"n{r}": f"below{r}" for r in range(weights)}
    # the table of distinct scores is read by a count, a sample and a sort
    ranked = running_sums(stored(per_score, "scores"), ["model"], ["score"], below, slice_rows, inclusive=False)
    totals = ranked.withColumn("flagged", F.col("score") > threshold).groupBy("model").agg(
        *per_replicate(
            "cast(sum(p{r}) as double) AS pos{r}",
            "cast(sum(n{r}) as double) AS neg{r}",
            "cast(sum(if(flagged, p{r}, 0)) as double) AS tp{r}",
            "cast(sum(if(flagged, n{r}, 0)) as double) AS fp{r}",
            "sum(cast(p{r} as double) * (below{r} + n{r} / 2D)) AS u{r}",
        )
    )
    structs = [
        _REPLICATE.format(r=r, fraud=_FRAUD_F1.format(r=r), legit=_LEGIT_F1.format(r=r))
        for r in range(weights)
    ]
    return totals.select("model", F.expr(f"inline(array({', '.join(structs)}))"))


def evaluate(
    scored: DataFrame,
    label: str = LABEL,
    score: str = "probability",
    threshold: float = 0.5,
    min_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row: exact rank AUC (ties count half), label-weighted F1, accuracy, fraud-class
    F1 and row count. No rows give no row. ``f1`` weighs both classes by size; ``fraud_f1`` is the fraud class."""
    rows = scored.select(F.col(score).alias("score"), (F.col(label) == 1).alias("positive"))
    rows = rows.withColumns({"model": F.lit("model"), "w0": F.lit(1)})
    return _metrics(rows, 1, threshold, min_rows).drop("model", "replicate")


def confusion(scored: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """(label, prediction, rows), at most four rows for two classes."""
    return scored.groupBy(label, prediction).agg(F.count("*").alias("rows"))


def replicate_weights(df: DataFrame, n: int, key: str = KEY) -> DataFrame:
    """Columns w0 .. w(n-1): how often each row occurs in each resample with replacement.

    A Poisson(1) count drawn from a hash of (key, block), so the resamples are the same
    for any layout of the rows and for every model. One hash serves four replicates.
    """
    blocks = {f"__h{b}": hash_hex(F.col(key), F.lit(b)) for b in range(-(-n // 4))}
    draws = {f"w{i}": poisson1(f"substr(__h{i // 4}, {8 * (i % 4) + 1}, 8)") for i in range(n)}
    return df.withColumns(blocks).withColumns(draws).drop(*blocks)


def resample(df: DataFrame, replicate: int = 0, key: str = KEY) -> DataFrame:
    """The rows of one resample with replacement: each row as often as its weight says, with the ``copy`` from 0 on."""
    weighted = replicate_weights(df, replicate + 1, key)
    weight = f"w{replicate}"
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(weight) - 1))
    return weighted.filter(F.col(weight) > 0).select(*df.columns, copies.alias("copy"))


def bootstrap(
    scored: DataFrame,
    scores: Mapping[str, str],
    n: int = 10,
    key: str = KEY,
    label: str = LABEL,
    threshold: float = 0.5,
    min_rows: int = SLICE_ROWS,
) -> DataFrame:
    """(model, replicate, auc, f1, accuracy, fraud_f1, rows) for n resamples of every model.

    ``scores`` maps a model's name to its score column. Rows are never multiplied by
    replicates: each replicate is a weight column summed next to the others.
    """
    rows = scored.select(key, (F.col(label) == 1).alias("positive"), *scores.values())
    rows = replicate_weights(rows, n, key)
    per_model = [F.struct(F.lit(name).alias("model"), F.col(column).alias("score")) for name, column in scores.items()]
    rows = rows.select("positive", *[f"w{i}" for i in range(n)], F.inline(F.array(*per_model)))
    return _metrics(rows, n, threshold, min_rows)


def bootstrap_means(replicates: DataFrame) -> DataFrame:
    return replicates.groupBy("model").agg(
        *[F.avg(m).alias(f"mean_{m}") for m in ("auc", "f1", "accuracy")]
    )


def compare(
    replicates: DataFrame,
    champion: str = "champion",
    candidate: str = "candidate",
    metric: str = "f1",
    alpha: float = 0.05,
) -> DataFrame:
    """One row: does the candidate beat the champion on the bootstrap replicates?

    Welch's t with a two-sided normal p-value, Cohen's d on the plain mean of the two
    variances, and the decision: significant and better. Replicates share their resamples
    across models, so treating them as independent samples is conservative.
    """
    stats = {}
    for side, name in (("a", champion), ("b", candidate)):
        value = F.when(F.col("model") == name, F.col(metric))
        stats |= {
            f"mean_{side}": F.avg(value),
            f"var_{side}": F.var_samp(value),
            f"n_{side}": F.count(value),
            f"auc_{side}": F.avg(F.when(F.col("model") == name, F.col("auc"))),
        }
    c = {name: F.col(name) for name in stats}
    gain = c["mean_b"] - c["mean_a"]
    se = F.sqrt(c["var_a"] / c["n_a"] + c["var_b"] / c["n_b"])
    pooled = F.sqrt((c["var_a"] + c["var_b"]) / 2)
    return (
        replicates.agg(*[v.alias(k) for k, v in stats.items()])
        .select(
            c["auc_a"].alias("champion_mean_auc"),
            c["auc_b"].alias("candidate_mean_auc"),
            c["mean_a"].alias(f"champion_mean_{metric}"),
            c["mean_b"].alias(f"candidate_mean_{metric}"),
            gain.alias("improvement"),
            _ratio(gain, se).alias("t_statistic"),
            F.when(se == 0, 1.0).otherwise(normal_two_sided_p(F.try_divide(gain, se))).alias("p_value"),
            _ratio(gain, pooled).alias("cohens_d"),
        )
        .withColumn("is_significant", F.col("p_value") < alpha)
        .withColumn("should_deploy", F.col("is_significant") & (F.col("improvement") > 0))
    )


def latest_two_versions(versions: DataFrame) -> DataFrame:
    """Per model its newest and second-newest version, by version *number*; models with
    fewer than two versions are left out. A version that is no number is none; equal numbers
    are settled by run id.

    The rank filter is applied per task before the shuffle as well, so a model with very
    many versions sends at most two rows per task.
    """
    w = Window.partitionBy("model").orderBy(F.col("number").desc(), F.col("run_id").desc())
    ranked = (
        versions.select("model", F.col("version").try_cast("int").alias("number"), "run_id")
        .filter("number is not null")
        .withColumn("rank", F.row_number().over(w))
        .filter("rank <= 2")
    )
    picks = {}
    for rank, side in ((1, "candidate"), (2, "champion")):
        row = F.col("rank") == rank
        picks[f"{side}_version"] = F.max(F.when(row, F.col("number")))
        picks[f"{side}_run_id"] = F.max(F.when(row, F.col("run_id")))
    return (
        ranked.groupBy("model")
        .agg(F.count("*").alias("n"), *[v.alias(k) for k, v in picks.items()])
        .filter("n = 2")
        .drop("n")
    )
