"""Benchmark decontamination: passages of documents within a small edit distance of a benchmark item.

Texts are sequences of lower-case words. An item of n words is found where a stretch of a document is within ``rate * n``
edits of it, each the change, loss or gain of a word; items of fewer than ``1 / rate`` words are found verbatim.

Candidates come from the random-walk embedding of Chakraborty, Goldenberg and Koucky. A walk through a window of the item's size puts
out the word it stands at, step by step, and then a random bit of that word decides whether it goes on or
stays. Two walks with the same bits that have come apart over an edit tend to meet again, so few edits leave few
differing places: edit distance becomes Hamming distance. Bit sampling then hashes the words put out at ``SAMPLES`` random places; each
of ``TABLES`` repetitions has bits and places of its own. They are enough for a recall of ``RECALL`` at the full number of edits,
which the tests measure for items of 1 to 60 words. Items go by size classes, a class walks through windows of its size at
every word of a document. A class whose items allow no edit samples all places, so it finds all.

A window can only hold an item if all but ``rate`` of its words occur in items of the class at all; walks start at such windows alone,
which loses nothing. The edit distance to the best stretch around a candidate is computed exactly.

The tables hold the items alone. They are taken in blocks of bounded numbers of items and words, each a pass over the documents, so a
task never holds more than one block; documents are not shuffled. Null or empty items and texts match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.text import column_bytes, mix, word_groups

U = np.uint64
RECALL = 0.99  # of passages with the full number of edits
TABLES, SAMPLES = 20, 2
STEPS = 48  # of a walk, within which places are sampled
REGIONS = 4_000_000  # words of regions counted at a time
BLOCK_WORDS = 2_000_000  # of the items in a block; a larger item is a block by itself


def lowered(column: pa.Array) -> pa.Array:
    return pa.array([(t or "").lower() for t in column.to_pylist()], pa.large_string())


def search(pattern: Sequence, text: Sequence) -> int:
    """The least edit distance between the pattern and any part of the text (bit-parallel columns)."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    of: dict = {}
    for i, c in enumerate(pattern):
        of[c] = of.get(c, 0) | 1 << i
    up, down, now, best = full, 0, m, m
    for c in text:
        same = of.get(c, 0)
        x = same | down
        flat = (((same & up) + up) ^ up) | same
        more, less = down | (full & ~(flat | up)), up & flat
        if more & high:
            now += 1
        elif less & high:
            now -= 1
            best = min(best, now)
        more, less = (more << 1) & full, (less << 1) & full
        up, down = less | (full & ~(x | more)), more & x
    return best


def size_class(words: int, rate: float) -> tuple[int, int]:
    """(size, edits): the largest class that is not above that many words, in steps of a quarter, and the edits that its longest
    items allow. Sizes without edits are classes of their own."""
    size, after = 1, 2
    while after <= words:
        size, after = after, max(after + 1, after * 5 // 4 if int(rate * after) else 0)
    return size, int(rate * (after - 1))


class Walk(NamedTuple):
    """One table of a class: the bits of its walks and the steps that are sampled."""

    seed: int
    steps: list[int]


def walks(size: int, edits: int) -> list[Walk]:
    rng = np.random.default_rng(size)
    if not edits:
        # equal windows have equal walks, whatever is sampled; all steps tell others apart
        return [Walk(int(rng.integers(1, 2**63)), list(range(size * 3)))]
    within = min(STEPS, size * 8 // 5)
    return [Walk(int(rng.integers(1, 2**63)), sorted(rng.choice(within, SAMPLES, replace=False).tolist())) for _ in range(TABLES)]


def embedded(code: np.ndarray, start: np.ndarray, end: np.ndarray, walk: Walk) -> np.ndarray:
    """The hash of the sampled steps of the walks from ``start``; beyond ``end`` there is nothing."""
    at, last = start.copy(), len(code) - 1
    out = np.full(len(start), walk.seed, np.uint64)
    sampled = set(walk.steps)
    for step in range(walk.steps[-1] + 1):
        word = np.where(at < end, code[np.minimum(at, last)], U(0))
        if step in sampled:
            out = mix(out ^ word) * U(3)
        bits = mix(word ^ U(walk.seed) ^ U(step * 0x9E3779B97F4A7C15 % 2**64))
        at += (bits >> U(63)).astype(np.int64)
    return out


class SizeClass(NamedTuple):
    size: int
    edits: int
    known: np.ndarray  # whether a word of the vocabulary is in its items
    tables: list[tuple[Walk, np.ndarray, np.ndarray]]  # sorted hashes, and their items


class Items(NamedTuple):
    ids: list[int]
    words: list[list[bytes]]
    size: np.ndarray
    limit: np.ndarray
    different: np.ndarray  # words of each item, counted once
    vocabulary: np.ndarray  # sorted codes of all words of the items
    own: np.ndarray  # sorted: item * words of the vocabulary + word, for the words of each item
    classes: list[SizeClass]

    def places(self, code: np.ndarray) -> np.ndarray:
        """The place of each word in the vocabulary, or one beyond it."""
        if not len(self.vocabulary):
            return np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, code), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == code, at, len(self.vocabulary))


def index_items(rows: list[tuple[int, str]], rate: float) -> Items:
    data, offsets = column_bytes(lowered(pa.array([t for _, t in rows], pa.string())))
    texts: list[list[bytes]] = [[] for _ in rows]
    codes: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    for words in word_groups(data, offsets):
        for k in range(len(words.bounds) - 1):
            a, b = words.bounds[k], words.bounds[k + 1]
            item = words.first_row + k
            texts[item] = [data[s:e].tobytes() for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist())]
            if b > a:
                codes.setdefault(size_class(int(b - a), rate), []).append((item, words.code[a:b]))
    every = [member for members in codes.values() for member in members]
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *[c for _, c in every]]))
    of = {item: np.searchsorted(vocabulary, np.unique(c)) for item, c in every}
    own = np.sort(np.concatenate([np.zeros(0, np.int64), *[item * (len(vocabulary) + 1) + w for item, w in of.items()]]))
    classes = []
    for (size, edits), members in sorted(codes.items()):
        item = np.array([i for i, _ in members])
        heads = np.concatenate([c[:size] for _, c in members])
        start = np.arange(len(members)) * size
        tables = []
        for walk in walks(size, edits):
            h = embedded(heads, start, start + size, walk)
            order = np.argsort(h, kind="stable")
            tables.append((walk, h[order], item[order]))
        known = np.zeros(len(vocabulary) + 1, bool)
        known[np.concatenate([of[i] for i, _ in members])] = True
        classes.append(SizeClass(size, edits, known, tables))
    counts = np.array([len(t) for t in texts], np.int64)
    limit, different = (np.array([f(t) for t in texts], np.int64) for f in (lambda t: int(rate * len(t)), lambda t: len(set(t))))
    return Items([i for i, _ in rows], texts, counts, limit, different, vocabulary, own, classes)


def _pairs(sorted_hashes: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into h, index into sorted_hashes) of equal hashes."""
    low, high = np.searchsorted(sorted_hashes, h, "left"), np.searchsorted(sorted_hashes, h, "right")
    n = high - low
    which = np.repeat(np.arange(len(h)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def _region(at: np.ndarray, item: np.ndarray, items: Items, row_start: np.ndarray, row_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words among which a passage may lie whose window begins at ``at``."""
    reach = 2 * items.limit[item] + 1
    return np.maximum(row_start[at], at - reach), np.minimum(row_end[at], at + items.size[item] + reach)


def _enough_words(place: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray, items: Items) -> np.ndarray:
    """Whether a region holds as many different words of the item as a passage must: an edit takes away one at most."""
    keep = np.zeros(len(item), bool)
    length = high - low
    edges = np.r_[0, np.flatnonzero(np.diff(np.cumsum(length) // REGIONS)) + 1, len(item)]
    for a, b in zip(edges[:-1], edges[1:]):
        n = length[a:b]
        if a == b or not n.sum():
            continue
        first = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(low[a:b], n)
        key = np.repeat(item[a:b], n) * (len(items.vocabulary) + 1) + place[at]
        found = np.minimum(np.searchsorted(items.own, key), len(items.own) - 1)
        hit = items.own[found] == key
        different = np.unique(np.repeat(np.arange(b - a), n)[hit] * len(items.own) + found[hit]) // len(items.own)
        keep[a:b] = np.bincount(different, minlength=b - a) >= items.different[item[a:b]] - items.limit[item[a:b]]
    return keep


def _candidates(code: np.ndarray, row_start: np.ndarray, row_end: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(word, item, from, to) where a window that begins at the word shares a table entry with an item, in order."""
    found = [np.zeros((0, 2), np.int64)]
    every, place = np.arange(len(code)), items.places(code)
    for c in items.classes:
        known = np.r_[0, np.cumsum(c.known[place])]
        end = np.minimum(every + c.size, row_end)
        start = np.flatnonzero(known[end] - known[:-1] >= c.size - c.edits)
        if not len(start):
            continue
        for walk, hashes, of in c.tables:
            which, entry = _pairs(hashes, embedded(code, start, end[start], walk))
            found.append(np.stack([start[which], of[entry]], axis=1))
    at, item = np.unique(np.concatenate(found), axis=0).T
    low, high = _region(at, item, items, row_start, row_end)
    good = _enough_words(place, low, high, item, items)
    yield from zip(at[good].tolist(), item[good].tolist(), low[good].tolist(), high[good].tolist())


def find(column: pa.Array, items: Items) -> Iterator[tuple[int, int, int]]:
    """(row, item, edit distance) of a text column, once per row and item."""
    data, offsets = column_bytes(lowered(column))
    for words in word_groups(data, offsets):
        if not len(words.code):
            continue
        sizes = np.diff(words.bounds)
        row_start, row_end = np.repeat(words.bounds[:-1], sizes), np.repeat(words.bounds[1:], sizes)
        best: dict[tuple[int, int], int] = {}
        done: dict[tuple[int, int], int] = {}  # up to where a row was searched for an item
        for at, item, low, high in _candidates(words.code, row_start, row_end, items):
            row = int(words.rows[at])
            pattern, limit = items.words[item], int(items.limit[item])
            seen = done.get((row, item), 0)
            if high <= seen or best.get((row, item)) == 0:
                continue
            # what was searched is searched again as far as a passage can reach back
            low = max(low, seen - len(pattern) - limit)
            done[row, item] = high
            part = [data[s:e].tobytes() for s, e in zip(words.start[low:high].tolist(), words.end[low:high].tolist())]
            distance = search(pattern, part)
            if distance <= limit:
                best[row, item] = min(distance, best.get((row, item), distance))
        for (row, item), distance in sorted(best.items()):
            yield row, item, distance


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_items: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks, in order of their ids, so that the driver holds one block at a time."""
    rows = items.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).orderBy(id_col)
    block: list[tuple[int, str]] = []
    words = 0
    for r in rows.toLocalIterator():
        n = r[1].count(" ") + 1
        if block and (len(block) == block_items or words + n > BLOCK_WORDS):
            yield block
            block, words = [], 0
        block.append((r[0], r[1]))
        words += n
    if block:
        yield block


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = 0.2, block_items: int = 20_000) -> DataFrame:
    """(doc_id, item_id, distance) for every document row and item that it holds within ``rate`` edits per word of the item, once.

    distance is that of the best place looked at. Rows without an id, repeated rows and items of one id are each taken by
    themselves; empty tables give no rows; other columns are not looked at.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance long")
    for block in item_blocks(items, item_col, item_text, block_items):
        index = index_items(block, rate)

        def run(batches: Iterator[pa.RecordBatch], index: Items = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = [(ids[row], index.ids[item], d) for row, item, d in find(batch.column(1), index)]
                yield pa.RecordBatch.from_pydict({n: pa.array([f[k] for f in found], pa.int64()) for k, n in enumerate(("doc_id", "item_id", "distance"))})

        out = out.unionByName(texts.mapInArrow(run, out.schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = 0.2, block_items: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows are read and passed on in place, without a shuffle."""
    for block in item_blocks(items, item_col, item_text, block_items):
        index = index_items(block, rate)

        def run(batches: Iterator[pa.RecordBatch], index: Items = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                column = batch.column(batch.schema.get_field_index(text_col))
                keep[[row for row, _, _ in find(column, index)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
