"""Language of a text by interpolated Kneser-Ney models of its characters, one per language.

A text is its letters in lower case with one space for any run of other characters. Models are of order 4. The counts
cover all documents to learn from, and all grams make the model: its orders and discounts are aggregated over the whole
table. Keys are four 16-bit characters in one 64-bit number, sorted, with the log probabilities of all languages beside
them, so one binary search per character serves every language. A character beyond 16 bits counts as one letter that is
not known.

The table is cut into shards of about ``shard_grams`` grams, by the three characters before the last, read backwards: all
that backing off from a gram looks up has the same last characters before it, so it stands in the gram's own shard, and
only the few groups at a cut are in both (fewer than 65,536 grams of each order and language). Shards are built in tasks
and pass the driver one by one as broadcasts. A task holds one at a time if there are several, and reads them per 8 MB of text.

The language with the least cross-entropy per character wins. ``score`` is its share of the likelihood, as if the text
had at most ``SURE`` characters. The number of languages is taken to be small. A null text or one without a letter is
``und`` with score 0; without any language learned, all are.

``rejected`` is set if the cross-entropy lies above a limit that a new document of that language passes with a chance of
about ``1 - loss``. Limits come from all texts, each judged as if it were new: texts are dealt to ``FOLDS`` folds by hash, a model
is made per fold from the counts of the others, and the texts of a language told rightly give the limit, the
``ceil((n + 1) * (1 - loss))``-th least of their n entropies. Where n is too small for that, the entropies of all
languages less their language's median are taken together; where these are too few as well, nothing is rejected.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.labelled import at_ranks, fold
from ledgerlens.llm.store import stored
from ledgerlens.llm.text import column_bytes

U = np.uint64
ORDER = 4
SURE = 60  # characters
FOLDS = 3  # parts of the texts, each judged by the others
OTHER = 0xFFFF  # a letter beyond 16 bits
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """Per 16-bit character: its lower case if it is a letter, else a space."""
    table = np.full(65536, 32, np.uint16)
    for i in range(65536):
        c = chr(i)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[i] = low if low < 65536 else OTHER
    return table


class Stream(NamedTuple):
    grams: np.ndarray  # the last ORDER characters at each character, as one number
    rows: np.ndarray  # its row
    letters: np.ndarray  # whether a row has a letter
    first: int  # the first row


def streams(column: pa.Array, table: np.ndarray, size: int = 1 << 20) -> Iterator[Stream]:
    """The rows of a text column in groups of about ``size`` bytes; a longer row is a group of its own."""
    data, offsets = column_bytes(column)
    row, n = 0, len(column)
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        part = data[offsets[row] : offsets[stop]]
        points = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), "<u4")
        begins = np.r_[0, np.cumsum((part & 0xC0) != 0x80)][offsets[row : stop + 1] - offsets[row]]
        rows = np.repeat(np.arange(stop - row), np.diff(begins))
        wide = points > 0xFFFF
        chars = table[np.where(wide, 0, points)]
        if wide.any():
            for p in np.unique(points[wide]).tolist():
                chars[points == p] = OTHER if chr(p).isalpha() else 32
        space = chars == 32
        keep = ~space
        keep[1:] |= ~space[:-1] & (rows[1:] == rows[:-1])  # the first space after a letter
        chars, rows = chars[keep], rows[keep]
        letters = np.zeros(stop - row, bool)
        letters[rows[chars != 32]] = True
        # each row as if ORDER - 1 spaces stood before it
        grams = chars.astype(np.uint64)
        for back in range(1, ORDER):
            shifted = np.full(len(chars), 32, np.uint64)
            if len(chars) > back:
                same = rows[back:] == rows[:-back]
                shifted[back:] = np.where(same, chars[:-back], 32)
            grams |= shifted << U(16 * back)
        yield Stream(grams, rows, letters, row)
        row = stop


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = letter_table()
    for batch in batches:
        langs, of = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        found: list[list[np.ndarray]] = [[] for _ in langs]
        for s in streams(batch.column(1), table):
            lang = of[s.first + s.rows]
            for k in range(len(langs)):
                found[k].append(s.grams[lang == k])
        for lang, parts in zip(langs, found):
            grams, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()), "gram": pa.array(grams.view(np.int64)), "n": pa.array(n.astype(np.int64))})


class Level(NamedTuple):
    keys: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray
    discount: float


class KneserNey:
    """Interpolated Kneser-Ney probabilities from the counts (keys, n) of each order, the longest grams first."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def of(cls, counts: list[tuple[np.ndarray, np.ndarray]], discounts: list[float]) -> KneserNey:
        levels = []
        for (keys, n), discount in zip(counts, discounts):
            sort = np.argsort(keys)
            keys, n = keys[sort], n[sort].astype(np.float64)
            contexts, of = np.unique(keys >> U(16), return_inverse=True)
            totals = np.bincount(of, weights=n, minlength=len(contexts))
            levels.append(Level(keys, n, contexts, totals, np.bincount(of, minlength=len(contexts)).astype(float), discount))
        return cls(levels)

    @staticmethod
    def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted))
        i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[i] == wanted, values[i], 0.0)

    def probability(self, grams: np.ndarray, level: int = 0) -> np.ndarray:
        if level == ORDER:
            return np.full(len(grams), 1 / 65536)
        x = self.levels[level]
        context = grams >> U(16)
        total, kinds = self._at(x.contexts, x.totals, context), self._at(x.contexts, x.kinds, context)
        lower = self.probability(grams & U((1 << 16 * (ORDER - level - 1)) - 1), level + 1)
        own = np.maximum(self._at(x.keys, x.counts, grams) - x.discount, 0)
        return np.where(total > 0, (own + x.discount * kinds * lower) / np.maximum(total, 1), lower)


class Shard:
    """The languages' models over a range of grams, in one sorted table."""

    def __init__(self, models: list[KneserNey]):
        self.models = models
        self.keys = np.unique(np.concatenate([m.levels[0].keys for m in models]))
        self.table = self._logs(self.keys)

    def plain(self) -> tuple:
        """What is broadcast, without classes."""
        return [[tuple(x) for x in m.levels] for m in self.models], self.keys, self.table

    @classmethod
    def of(cls, plain: tuple) -> Shard:
        found = cls.__new__(cls)
        models, found.keys, found.table = plain
        found.models = [KneserNey([Level(*x) for x in m]) for m in models]
        return found

    def _logs(self, grams: np.ndarray) -> np.ndarray:
        return np.column_stack([np.log(m.probability(grams)) for m in self.models]).astype(np.float32)

    def logs(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return self._logs(grams)
        i = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        logs = self.table[i]
        miss = np.flatnonzero(self.keys[i] != grams)
        if len(miss):
            new, of = np.unique(grams[miss], return_inverse=True)
            logs[miss] = self._logs(new)[of]
        return logs


def _place(grams: np.ndarray) -> np.ndarray:
    """The three characters before the last, read backwards."""
    c = U(0xFFFF)
    return ((grams >> U(16)) & c) << U(32) | ((grams >> U(32)) & c) << U(16) | grams >> U(48)


class Model:
    """The languages' models, in shards."""

    def __init__(self, langs: list[str], cuts: np.ndarray, shards: list[Broadcast]):
        self.langs, self.cuts, self.shards = langs, cuts, shards
        self.most = np.full(len(langs), np.inf)  # cross-entropy above which a text is rejected

    @property
    def models(self) -> list[KneserNey]:
        """The languages' models of the first shard."""
        return self._shard(0).models

    @property
    def group(self) -> int:
        """Bytes of text that are looked up together."""
        return 1 << 20 if len(self.shards) == 1 else 1 << 23

    def _shard(self, k: int) -> Shard:
        found = Shard.of(self.shards[k].value)
        if len(self.shards) > 1:
            del self.shards[k]._value  # read again when needed
        return found

    def entropies(self, s: Stream) -> tuple[np.ndarray, np.ndarray]:
        """Per row: cross-entropy in each language, and characters."""
        total = np.zeros((len(s.letters), len(self.langs)))
        length = np.bincount(s.rows, minlength=len(s.letters))
        if len(self.shards) > 1:
            new, of = np.unique(s.grams, return_inverse=True)
            shard = np.searchsorted(self.cuts, _place(new), side="right")
            known = np.zeros((len(new), len(self.langs)), np.float32)
            for k in np.unique(shard).tolist():
                at = np.flatnonzero(shard == k)
                known[at] = self._shard(k).logs(new[at])
        for at in range(0, len(s.grams), 1 << 18):
            grams, rows = s.grams[at : at + (1 << 18)], s.rows[at : at + (1 << 18)]
            logs = self._shard(0).logs(grams) if len(self.shards) == 1 else known[of[at : at + (1 << 18)]]
            heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            total[rows[heads]] += np.add.reduceat(logs, heads, axis=0, dtype=np.float64)
        return -total / np.maximum(length, 1)[:, None], length


def _judge(model: Model | None, keep: bool = False):
    """Judges (id, text, ...) rows; ``keep`` passes the columns after these on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table()
        for batch in batches:
            n = batch.num_rows
            lang, score, entropy, rejected = np.full(n, UNDETERMINED, object), np.zeros(n), np.full(n, np.nan), np.zeros(n, bool)
            if model is not None:
                for s in streams(batch.column(1), table, model.group):
                    each, length = model.entropies(s)
                    best = each.argmin(axis=1)
                    low = each[np.arange(len(each)), best]
                    share = 1 / np.exp(-(each - low[:, None]) * np.minimum(length, SURE)[:, None]).sum(axis=1)
                    rows = s.first + np.flatnonzero(s.letters)
                    lang[rows] = np.array(model.langs, object)[best[s.letters]]
                    score[rows], entropy[rows] = share[s.letters], low[s.letters]
                    rejected[rows] = low[s.letters] > model.most[best[s.letters]]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "lang_pred": pa.array(lang.tolist(), pa.string()), "score": pa.array(score),
                "cross_entropy": pa.array(entropy, mask=np.isnan(entropy)), "rejected": pa.array(rejected),
                **(dict(zip(batch.schema.names[2:], batch.columns[2:])) if keep else {}),
            })

    return run


JUDGED = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"


def _orders(counted: DataFrame) -> DataFrame:
    """(lang, level, key, n) of grams of all orders; a shorter gram counts the different characters it follows."""
    levels = [counted.select("lang", F.lit(0).alias("level"), F.col("gram").alias("key"), "n")]
    for level in range(1, ORDER):
        key = F.col("key").bitwiseAND(F.lit((1 << 16 * (ORDER - level)) - 1)).alias("key")
        shorter = levels[-1].groupBy("lang", key).agg(F.count("*").alias("n"))
        levels.append(stored(shorter.select("lang", F.lit(level).alias("level"), "key", "n"), "shorter-grams"))
    return reduce(DataFrame.unionByName, levels)


def _dealt(cuts: np.ndarray):
    """Each gram to the shard of its place; a shorter one to all that have longer ones ending in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, key = batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
            low = _place(key)  # what a shorter gram lacks is zero
            free = U(1) << (16 * np.minimum(level, ORDER - 1)).astype(np.uint64)
            first, last = np.searchsorted(cuts, low, side="right"), np.searchsorted(cuts, low + (free - U(1)), side="right")
            n = last - first + 1
            row = np.repeat(np.arange(len(n)), n)
            shard = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *batch.take(pa.array(row)).columns], ["shard", *batch.schema.names])

    return run


def _built(langs: list[str], discounts: dict[tuple[str, int], float]):
    def run(table: pa.Table) -> pa.Table:
        level, key, n = table["level"].to_numpy(), table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
        lang = pc.index_in(table["lang"], pa.array(langs, pa.string())).to_numpy()
        models = []
        for k, name in enumerate(langs):
            own = [(lang == k) & (level == x) for x in range(ORDER)]
            models.append(KneserNey.of([(key[o], n[o]) for o in own], [discounts[name, x] for x in range(ORDER)]))
        return pa.table({"shard": table["shard"][:1], "data": pa.array([pickle.dumps(Shard(models).plain())], pa.binary())})

    return run


def counted_grams(known: DataFrame) -> DataFrame:
    """(lang, gram, n) of (lang, text) rows."""
    return known.select("lang", "text").mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learned(counted: DataFrame, shard_grams: int) -> Model | None:
    """The model of all grams of a stored table (lang, gram, n)."""
    orders = _orders(counted)
    once, twice = (F.sum((F.col("n") == k).cast("long")).alias(a) for k, a in ((1, "once"), (2, "twice")))
    discounts = {}
    for r in orders.groupBy("lang", "level").agg(once, twice).collect():
        discount = r["once"] / (r["once"] + 2 * r["twice"]) if r["once"] else 0.5
        discounts[r["lang"], r["level"]] = min(max(discount, 0.1), 0.95)
    if not discounts:
        return None
    langs = sorted({lang for lang, _ in discounts})
    several = -(-counted.count() // shard_grams)
    cuts = np.zeros(0, np.uint64)
    if several > 1:
        c = [F.shiftrightunsigned("gram", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(ORDER)]
        place = counted.select((c[1] * (1 << 32) + c[2] * (1 << 16) + c[3]).cast("double").alias("place"))
        cuts = np.unique(np.array(place.approxQuantile("place", [i / several for i in range(1, several)], 0.25 / several)).astype(np.uint64))
    dealt = orders.mapInArrow(_dealt(cuts), "shard int, lang string, level int, key long, n long")
    shards = stored(dealt.groupBy("shard").applyInArrow(_built(langs, discounts), "shard int, data binary"), "language-shards")
    context = counted.sparkSession.sparkContext
    return Model(langs, cuts, [context.broadcast(pickle.loads(r["data"])) for r in shards.orderBy("shard").toLocalIterator()])


def _rank(n: int, loss: float) -> int:
    """Which of n values, least first, is the limit; beyond n if there are too few."""
    return math.ceil((n + 1) * (1 - loss) - 1e-9)


def limits(found: list[tuple[str, float]], loss: float) -> dict[str, float]:
    """Per language the entropy above which a text is rejected, from (lang, cross-entropy) of texts that were not counted."""

    def limit(values: np.ndarray) -> float:
        k = _rank(len(values), loss)
        return float(np.sort(values)[k - 1]) if k <= len(values) else np.inf

    by: dict[str, list[float]] = {}
    for lang, entropy in found:
        by.setdefault(lang, []).append(entropy)
    middle = {lang: float(np.median(v)) for lang, v in by.items()}
    spread = limit(np.array([entropy - middle[lang] for lang, entropy in found]))
    own = {lang: limit(np.array(v)) for lang, v in by.items()}
    return {lang: v if np.isfinite(v) else middle[lang] + spread for lang, v in own.items()}


def table_limits(found: DataFrame, loss: float) -> dict[str, float]:
    """The same from a table (lang, cross_entropy) of any size: exact ranks, sorted by Spark."""
    sizes = {r["lang"]: r["count"] for r in found.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    at = at_ranks(found.select("lang", "cross_entropy"), {lang: [(n + 1) // 2, n // 2 + 1, _rank(n, loss)] for lang, n in sizes.items()})
    middle = {lang: (at[lang, (n + 1) // 2] + at[lang, n // 2 + 1]) / 2 for lang, n in sizes.items()}
    own = {lang: at.get((lang, _rank(n, loss)), np.inf) for lang, n in sizes.items()}
    if all(np.isfinite(v) for v in own.values()):
        return own
    middles = found.sparkSession.createDataFrame([*middle.items()], "of string, middle double")  # a row per language
    off = found.join(F.broadcast(middles), F.col("lang") == F.col("of")).select(F.lit("all"), F.col("cross_entropy") - F.col("middle"))
    k = _rank(sum(sizes.values()), loss)
    spread = at_ranks(off, {"all": [k]}).get(("all", k), np.inf)
    return {lang: v if np.isfinite(v) else middle[lang] + spread for lang, v in own.items()}


def known_texts(labelled: DataFrame) -> DataFrame:
    """(lang, text, hash, fold) of the rows to learn from; equal texts are in one fold."""
    known = labelled.filter("lang is not null and text is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    return known.withColumn("hash", F.xxhash64("text")).withColumn("fold", F.pmod("hash", F.lit(FOLDS)).cast("int"))


def counted_folds(known: DataFrame) -> DataFrame:
    """(fold, lang, gram, n), stored."""
    # the fold is a digit before the language while grams are counted
    found = counted_grams(known.select(F.concat("fold", "lang").alias("lang"), "text"))
    return stored(found.select(F.left("lang", F.lit(1)).cast("int").alias("fold"), F.expr("substring(lang, 2)").alias("lang"), "gram", "n"), "gram-counts-folds")


def judged_apart(known: DataFrame, counted: DataFrame, shard_grams: int) -> DataFrame:
    """(hash, lang, lang_pred, cross_entropy): each different text once, judged by the counts of the other folds."""
    parts = []
    for k in range(FOLDS):
        others = stored(counted.filter(F.col("fold") != k).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts-left")
        model = learned(others, shard_grams)
        if model is None:  # no text in the other folds
            continue
        asked = known.filter(F.col("fold") == k).select(F.col("hash").alias("doc_id"), "text", "lang")
        told = asked.mapInArrow(_judge(model, keep=True), JUDGED + ", lang string").select(F.col("doc_id").alias("hash"), "lang", "lang_pred", "cross_entropy")
        parts.append(stored(told, "language-calibration"))
        for shard in model.shards:
            shard.unpersist()
    if not parts:
        return known.sparkSession.createDataFrame([], "hash long, lang string, lang_pred string, cross_entropy double")
    one = reduce(DataFrame.unionByName, parts).groupBy("hash").agg(F.min(F.struct("lang", "lang_pred", "cross_entropy")).alias("of"))
    return one.select("hash", "of.*")


def fit(labelled: DataFrame, shard_grams: int = 1_000_000, calibrate_rows: int | None = None, loss: float = 0.01) -> Model | None:
    """From (doc_id, text, lang) rows, all of which are counted and judged for the limits; equal texts are one there. A caller may bound
    the texts for the limits to the ``calibrate_rows`` whose hash is least."""
    known = known_texts(labelled)
    folds = counted_folds(known)
    model = learned(stored(folds.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts"), shard_grams)
    if model is None:
        return None
    judged = known
    if calibrate_rows is not None:
        judged = known.join(F.broadcast(known.select("hash").distinct().orderBy("hash").limit(calibrate_rows)), "hash", "left_semi")
    told = judged_apart(judged, folds, shard_grams).filter("lang_pred = lang and cross_entropy is not null")
    for lang, most in table_limits(stored(told.select("lang", "cross_entropy"), "language-entropies"), loss).items():
        model.most[model.langs.index(lang)] = most
    return model


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) for every row."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(_judge(model), JUDGED)


def held_out():
    return (fold("doc_id", 4) == 2).alias("held_out")
