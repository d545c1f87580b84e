"""Logistic regression: training on MLlib, and scoring from bare coefficients."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.functions import decide, linear, logistic, strict_timestamp_or_null
from ledgerlens.operators.evaluate import evaluate
from ledgerlens.operators.features import feature_rows, hash_split, with_features
from ledgerlens.schemas import COEFFICIENT_FILE, FEATURES, LABEL

# The training parameters.
MAX_ITER = 10
REG_PARAM = 0.01


@dataclass(frozen=True)
class Coefficients:
    names: Sequence[str]
    weights: Sequence[float]
    intercept: float

    def __post_init__(self) -> None:
        if len(self.names) != len(self.weights):
            raise ValueError(f"{len(self.names)} names for {len(self.weights)} coefficients")

    def probability(self) -> Column:
        """Fraud probability as one generated expression; NULL if an input is NULL."""
        return logistic(linear([F.col(n) for n in self.names], self.weights, self.intercept))

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` and ``prediction`` to rows that carry the features."""
        return df.withColumn("probability", self.probability()).withColumn(
            "prediction", decide(F.col("probability"))
        )


# The coefficients of the model shipped with the scoring service.
SHIPPED = Coefficients(
    FEATURES,
    [
        0.0031468927874271266,
        -0.00021561636154178413,
        0.000783529122975925,
        -0.0029015964493936727,
        0.006050188467939219,
    ],
    -2.9465488921010925,
)


def score_requests(requests: DataFrame, model: Coefficients = SHIPPED) -> tuple[DataFrame, DataFrame]:
    """(responses, rejects) for requests (transaction_id, tx_amount, tx_datetime), the time as text.

    A response has the request's id, which may be missing, the prediction and the probability to six digits. A request without
    an amount or whose time is not exactly ``yyyy-MM-dd HH:mm:ss`` is rejected, with the reason beside its columns.
    Batch or stream; no shuffle.
    """
    amount = F.col("tx_amount").cast("double")
    at = strict_timestamp_or_null(F.col("tx_datetime"))
    reason = (
        F.when(amount.isNull() | F.isnan(amount), "no amount")
        .when(F.col("tx_datetime").isNull(), "no time")
        .when(at.isNull(), "unreadable time")
    )
    judged = requests.withColumn("reason", reason)
    rejects = judged.filter("reason is not null").select("transaction_id", "tx_amount", "tx_datetime", "reason")
    scored = model.score(with_features(judged.filter("reason is null").withColumn("tx_datetime", at)))
    responses = scored.select("transaction_id", "prediction", F.round("probability", 6).alias("fraud_probability"))
    return responses, rejects


def pipeline(handle_invalid: str = "error") -> Pipeline:
    """Assemble the five features, then logistic regression. Inputs must be complete:
    batches drop incomplete rows first and streams route them away."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid=handle_invalid)
    regression = LogisticRegression(
        featuresCol="features", labelCol=LABEL, maxIter=MAX_ITER, regParam=REG_PARAM
    )
    return Pipeline(stages=[assembler, regression])


def positive_probability(scored: DataFrame) -> DataFrame:
    """MLlib's output with ``probability`` as the double probability of fraud."""
    return scored.withColumn("probability", vector_to_array("probability")[1])


def train(featured: DataFrame, train_share: float = 0.8, seed: int = 42):
    """(model, one-row metrics frame) from rows that carry features, label and id."""
    rows = feature_rows(featured, "tranaction_id")
    train_rows, test_rows = hash_split(rows, train_share, seed=seed)
    model = pipeline().fit(train_rows)
    scored = positive_probability(model.transform(test_rows))
    return model, evaluate(scored)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def coefficients_of(model: PipelineModel) -> Coefficients:
    names = model.stages[0].getInputCols()
    regression = model.stages[-1]
    return Coefficients(names, [float(w) for w in regression.coefficients], float(regression.intercept))


def save_coefficients(spark: SparkSession, c: Coefficients, path: str) -> None:
    """One JSON record: feature_names, coefficients, intercept."""
    row = [(list(c.names), list(c.weights), c.intercept)]
    spark.createDataFrame(row, COEFFICIENT_FILE).coalesce(1).write.mode("overwrite").json(path)


def coefficient_rows(spark: SparkSession, path: str) -> DataFrame:
    """(pos, name, coefficient, intercept), one row per feature of a coefficient file."""
    record = spark.read.schema(COEFFICIENT_FILE).option("multiLine", True).json(path)
    pairs = F.posexplode(F.arrays_zip("feature_names", "coefficients")).alias("pos", "pair")
    return record.select(pairs, "intercept").select(
        "pos",
        F.col("pair.feature_names").alias("name"),
        F.col("pair.coefficients").alias("coefficient"),
        "intercept",
    )


def load_coefficients(spark: SparkSession, path: str) -> Coefficients:
    """Read one coefficient file. A bad record or unequal lengths raise."""
    record = spark.read.schema(COEFFICIENT_FILE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    row = record.first()
    if row is None or None in (row["feature_names"], row["coefficients"], row["intercept"]):
        raise ValueError(f"no complete coefficient record in {path}")
    return Coefficients(row["feature_names"], row["coefficients"], row["intercept"])
