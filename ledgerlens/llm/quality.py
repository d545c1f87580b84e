"""Quality rules: counts per document, fixed limits, and an isolation forest on rates made of the counts.

The forest is fitted on all labelled rows of good quality, each of which goes to one tree at least. A tree
splits a random rate at a random place, somewhat beyond the range of the rows at hand as well, so that a document
outside all that was seen is soon alone: its path is short. All trees grow together, a level at a time, from the counts and
ranges of their nodes; only these come to the driver. The limit for the score is set on all labelled rows: the
lowest one that rejects at most ``good_loss`` of those of good quality.

A null or empty text has no words, so it fails the fixed limits. Where no labelled row exists, only these count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.labelled import at_ranks, sample
from ledgerlens.llm.store import stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rates that fixed limits judge already (length, repeats) are left out.
RATES = ("word_length", "symbols", "dup_lines", "capitals", "marks", "variety")
#: The characters that count as symbols.
SYMBOLS = re.compile(r"[#*$%&|<>]")
MARKS, CAPITALS = re.compile(r"[!?]"), re.compile(r"[A-ZÀ-ÖØ-Þ]")
TABLE = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{r} double" for r in RATES)


def counts(text: str) -> tuple[int, int, int, int, int, list[bytes], int]:
    """The five counts of a text, with its words and its number of lines that have a word."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line and line.encode("utf-8", "surrogatepass").split():
            lines += 1
            dup += line in seen
            seen.add(line)
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        often = {w for w, k in Counter(windows).items() if k > 1}
        upto = 0
        for i, w in enumerate(windows):
            if w in often:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return n, chars, len(SYMBOLS.findall(text)), dup, repeated, words, lines


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.zeros((batch.num_rows, len(COUNTS)), np.int64)
        rates = np.zeros((batch.num_rows, len(RATES)))
        for i, value in enumerate(batch.column(1)):
            text = value.as_py()
            if not text:
                continue
            *five, words, lines = counts(text)
            rows[i] = five
            n, chars, symbols, dup, repeated = five
            if n:
                rates[i] = (
                    chars / n, symbols / n, dup / max(lines, 1), len(CAPITALS.findall(text)) / chars, len(MARKS.findall(text)) / n,
                    math.log(len(set(words))) / math.log(n + 1),
                )
        columns = {"doc_id": batch.column(0), **{c: pa.array(rows[:, k].copy()) for k, c in enumerate(COUNTS)}}
        yield pa.RecordBatch.from_pydict(columns | {r: pa.array(rates[:, k].copy()) for k, r in enumerate(RATES)})


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the five counts, the rates) for every row."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(_statistics, TABLE)


def _mean_path(n: float) -> float:
    """Mean depth of a search tree of n keys, by which path lengths are scaled."""
    return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class IsolationForest:
    """Random trees over the rates of ``n`` rows (doc_id, rates); ``reach`` is how far beyond its rows' range a split of each rate may lie.
    A row goes to as many trees as make ``tree_rows`` rows a tree, one at least. ``score`` is near 1 for rows that few splits set apart, about 0.5 or less for others."""

    def __init__(self, rows: DataFrame, n: int, reach: np.ndarray, trees: int = 100, tree_rows: int = 256, seed: int = 0):
        each = min(trees, -(-trees * tree_rows // n))
        self.rows = n * each / trees
        rng = np.random.default_rng(seed)
        self.depth = max(1, math.ceil(math.log2(max(2, min(n, tree_rows)))))
        size = 2 ** (self.depth + 1)
        self.column = np.zeros((trees, size), np.int16)
        self.split = np.full((trees, size), np.inf)  # all go left where nothing is split
        self.path = np.zeros((trees, size))
        first = F.xxhash64("doc_id", F.lit(seed))
        of = F.explode(F.expr(f"sequence(0, {each - 1})"))
        dealt = stored(rows.withColumn("nth", of).select(F.pmod(first + F.col("nth"), F.lit(trees)).cast("int").alias("tree"), *RATES), "forest-rows")
        ended = set()
        for depth in range(self.depth + 1):
            for t, node, count, *ranges in sorted(self._nodes(dealt, depth)):
                if (t, node) in ended:
                    continue
                low, high = np.array(ranges[: len(RATES)]), np.array(ranges[len(RATES) :])
                wide = np.flatnonzero(high - low + reach > 0) if count > 1 else []
                if depth == self.depth or not len(wide):
                    # the path of a leaf goes on below it, so that every row walks to the same depth
                    self._leaf(t, node, depth, depth + _mean_path(count))
                    ended |= {(t, node << k) for k in range(1, self.depth - depth + 1)}
                    continue
                c = int(rng.choice(wide))
                self.column[t, node], self.split[t, node] = c, rng.uniform(low[c] - reach[c], high[c] + reach[c])
                for side in (2 * node, 2 * node + 1):  # a side may stay empty
                    self._leaf(t, side, depth + 1, depth + 1)

    def _nodes(self, dealt: DataFrame, depth: int) -> list[tuple]:
        """(tree, node, rows, least rates, greatest rates) of the nodes at that depth that have rows, one row per node."""
        column, split = self.column, self.split

        def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tree, *rates = (batch.column(i).to_numpy() for i in range(batch.num_columns))
                rates, index, node = np.column_stack(rates), np.arange(batch.num_rows), np.ones(batch.num_rows, np.int64)
                for _ in range(depth):
                    node = 2 * node + (rates[index, column[tree, node]] >= split[tree, node])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node), *batch.columns[1:]], ["tree", "node", *RATES])

        placed = dealt.mapInArrow(walked, "tree int, node long, " + ", ".join(f"{r} double" for r in RATES))
        found = placed.groupBy("tree", "node").agg(F.count("*").alias("n"), *[f(r).alias(f"{a}_{r}") for a, f in (("low", F.min), ("high", F.max)) for r in RATES])
        return [tuple(r) for r in found.collect()]

    def _leaf(self, t: int, node: int, depth: int, path: float) -> None:
        self.path[t, node << (self.depth - depth)] = path

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        index = np.arange(len(rows))
        for t in range(len(self.column)):
            node = np.ones(len(rows), np.int64)
            for _ in range(self.depth):
                node = 2 * node + (rows[index, self.column[t, node]] >= self.split[t, node])
            total += self.path[t, node]
        return 2.0 ** (-total / len(self.column) / (_mean_path(self.rows) or 1.0))


def base_failed() -> Column:
    """The fixed limits."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _scored(forest: IsolationForest, keep: tuple[str, ...] = ()):
    """The forest's score of each row as ``anomaly``, beside the columns to keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch.column(batch.schema.get_field_index(r)).to_numpy() for r in RATES])
            kept = {c: batch.column(batch.schema.get_field_index(c)) for c in keep}
            yield pa.RecordBatch.from_pydict({**kept, "anomaly": pa.array(forest.score(rows))})

    return run


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int | None = None, calibrate_rows: int | None = None, good_loss: float = 0.004, seed: int = 0) -> tuple[IsolationForest, float] | None:
    """The forest and the limit of its score, from all labelled rows that pass the fixed limits. A caller may bound how many of them
    set the limit (``calibrate_rows``) and how many the forest sees (``fit_rows``)."""
    one = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    if calibrate_rows is not None:
        one = sample(one, "doc_id", calibrate_rows)
    of_id = stats.filter(~base_failed()).join(one, "doc_id").groupBy("doc_id").agg(F.min(F.struct("quality", *RATES)).alias("row"))
    rows = stored(of_id.select("doc_id", "row.*"), "quality-labelled")
    n, *spread = rows.agg(F.count_if(F.col("quality") == 1), *[F.stddev_pop(r) for r in RATES]).first()
    if n < 2:
        return None
    good = rows.filter("quality = 1")
    seen = good if fit_rows is None else sample(good, "doc_id", fit_rows)
    # rounded, as the order of a sum must not matter
    forest = IsolationForest(seen, n if fit_rows is None else min(n, fit_rows), np.array([float(f"{x:.9g}") for x in spread]), seed=seed)
    scores = good.mapInArrow(_scored(forest), "anomaly double").select(F.lit("good"), "anomaly")
    rank = math.ceil((n - 1) * (1 - good_loss)) + 1
    return forest, at_ranks(scores, {"good": [rank]})["good", rank]


def judge(stats: DataFrame, model: tuple[IsolationForest, float] | None) -> DataFrame:
    """The counts with base_failed, anomaly (the forest's score; null without one) and kept."""
    base = stats.withColumn("base_failed", base_failed())
    if model is None:
        return base.select("doc_id", *COUNTS, "base_failed", F.lit(None).cast("double").alias("anomaly"), (~F.col("base_failed")).alias("kept"))
    forest, limit = model

    table = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, anomaly double"
    return base.mapInArrow(_scored(forest, ("doc_id", *COUNTS, "base_failed")), table).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= limit))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    stats = stored(statistics(docs, id_col, text_col), "quality-counts")
    return judge(stats, fit(stats, labels))
