"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned: words that labelled toxic documents use far more often than others. Features are its density,
the nearness of its words to words for the reader, capitals, punctuation, and obfuscated spellings (digits or marks
between letters; lexicon words that appear once these are read as letters).

Everything that learns uses a bounded sample of labelled rows (``most_labels``). Of it, three folds grow the trees and
one sets the calibration; the fold held out (crc32 of the id modulo 5 is 0) is never seen. Texts decide alone.
A null or empty text has features of zero and gets a score as any other.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.labelled import fold, sample
from ledgerlens.llm.store import stored

FOLDS = 5
FEATURES = ("hits", "density", "kinds", "weight", "near_you", "you", "capitals", "marks", "obfuscated", "hidden_hits", "length")
#: Words for the reader in the corpus's languages.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous vos votre tus ti usted ustedes vosotros".split())
LETTERS = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"[^\W\d_]+(?:[0-9@$*!.|+-]+[^\W\d_]+)+")
BETWEEN = re.compile(r"[*.|+-]+")
#: Marks read as letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
REACH = 20  # words


class Model(NamedTuple):
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    prior: float


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word, by label."""
    seen = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            seen[toxic].update(set(LETTERS.findall((text or "").lower())))
    words = list(seen[0].keys() | seen[1].keys())
    for at in range(0, len(words), 50_000):
        part = words[at : at + 50_000]
        yield pa.RecordBatch.from_pydict({"word": pa.array(part, pa.string()), "clean": pa.array([seen[0][w] for w in part], pa.int64()), "toxic": pa.array([seen[1][w] for w in part], pa.int64())})


def learn_lexicon(texts: DataFrame, clean: int, toxic: int, size: int = 300) -> dict[str, float]:
    """The words whose log odds ratio between toxic and clean documents is surest above zero, with that ratio."""
    words = texts.mapInArrow(_word_counts, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (toxic - F.col("toxic") + 0.5)) - F.log(b / (clean - F.col("clean") + 0.5))
    surest = words.filter("toxic >= 2").withColumn("odds", odds).withColumn("sure", F.col("odds") - 2.6 * F.sqrt(1 / a + 1 / b))
    rows = surest.filter("sure > 1").orderBy(F.desc("sure"), "word").limit(size).collect()
    return {r["word"]: float(r["odds"]) for r in rows}


def features_of(text: str, lexicon: dict[str, float]) -> tuple[float, ...]:
    lower = text.lower()
    words = LETTERS.findall(lower)
    n = len(words)
    hits = [i for i, w in enumerate(words) if w in lexicon]
    yous = [i for i, w in enumerate(words) if w in YOU]
    near = 0.0
    if hits and yous:
        at = np.array(yous)
        right = np.searchsorted(at, hits)  # the first one at or after a hit
        gaps = np.minimum(np.abs(at[np.minimum(right, len(at) - 1)] - hits), np.abs(at[np.maximum(right - 1, 0)] - hits))
        near = float((gaps <= REACH).mean())
    obfuscated = OBFUSCATED.findall(lower)
    hidden = sum(1 for w in obfuscated if BETWEEN.sub("", w).translate(LEET) in lexicon)
    kinds = {words[i] for i in hits}
    letters = sum(map(len, words))
    capitals = sum(map(str.isupper, text))
    return (
        float(len(hits)), len(hits) / n if n else 0.0, float(len(kinds)), sum(lexicon[w] for w in kinds), near, len(yous) / n if n else 0.0,
        capitals / letters if letters else 0.0, (text.count("!") + text.count("?")) / n if n else 0.0,
        len(obfuscated) / n if n else 0.0, float(hidden), float(np.log1p(n)),
    )


def features(docs: DataFrame, lexicon: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the features) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features_of(t.as_py() or "", lexicon) for t in batch.column(1)]).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **{f: pa.array(rows[:, k].copy()) for k, f in enumerate(FEATURES)}})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return texts.mapInArrow(run, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


def drop_toxic(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic. Rows pass through in place, without a join."""
    if model.trees is None:
        return docs if model.prior < 0.5 else docs.limit(0)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([features_of(t.as_py() or "", model_lexicon) for t in batch.column(1)]).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_pydict({"row": batch.column(0), **{f: pa.array(found[:, k].copy()) for k, f in enumerate(FEATURES)}})

    model_lexicon = model.lexicon
    known = rows.mapInArrow(run, rows.drop("text").select("row", *[F.lit(0.0).alias(f) for f in FEATURES]).schema)
    return _scored(known, model, "row").filter("score < 0.5").select("row.*")


def _scored(df: DataFrame, model: Model, key: str) -> DataFrame:
    raw = model.trees.transform(_vectors(df))
    stepped = model.steps.transform(raw.select(key, vector_to_array("probability")[1].alias("p")))
    # the steps tie many scores; a hundredth of the trees' own probability orders them
    mixed = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.99 * F.col("step") + 0.01 * F.col("p")))
    return stepped.select(key, mixed.alias("score"))


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000) -> Model:
    """Learns from at most ``most_labels`` labelled rows outside the fold held out; of several texts with one id the least
    counts. Lexicon and trees see all but one fold of these rows, which the isotonic steps are fitted on."""
    one = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    chosen = sample(one.filter(fold("doc_id", FOLDS) != 0), "doc_id", most_labels)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = stored(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")), "toxic-labelled")
    of = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    clean, toxic = of.get(0, 0), of.get(1, 0)
    if not clean or not toxic:
        return Model({}, None, None, float(bool(toxic)))
    seen = rows.filter(fold("doc_id", FOLDS) != 4)
    seen_of = {r["label"]: r["count"] for r in seen.groupBy("label").count().collect()}
    if len(seen_of) < 2:
        seen, seen_of = rows, of
    lexicon = learn_lexicon(seen.select("text", "label"), seen_of[0], seen_of[1])
    known = stored(features(rows, lexicon).join(rows.select("doc_id", "label"), "doc_id").coalesce(4), "toxic-features")
    known = _vectors(known)
    grow, rest = known.filter(fold("doc_id", FOLDS) != 4), known.filter(fold("doc_id", FOLDS) == 4)
    if grow.select("label").distinct().count() < 2:
        grow = known
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=7, featuresCol="features", labelCol="label").fit(grow)
    if rest.select("label").distinct().count() < 2:
        rest = known
    raw = trees.transform(rest).select(vector_to_array("probability")[1].alias("p"), F.col("label").cast("double").alias("label"))
    steps = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="step").fit(raw)
    return Model(lexicon, trees, steps, toxic / (clean + toxic))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    held = (fold("doc_id", FOLDS) == 0).alias("held_out")
    if model.trees is None:
        flat = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(model.prior).alias("score"))
    else:
        flat = _scored(features(docs, model.lexicon, id_col, text_col), model, "doc_id")
    return flat.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
