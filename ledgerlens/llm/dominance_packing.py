"""Packing of whole token sequences into as few windows as can be found: dominance reduction, then best fit.

What a window can hold depends on lengths alone, so the instance is a histogram of piece lengths: at most ``width`` numbers
whatever the size of the corpus. Tasks make the ids, cut longer documents and number the pieces of each length; the
driver sees the histogram only. There the reduction of Martello and Toth takes the lengths from the longest down. It asks which
companions of a length dominate all others: a set of pieces dominates another one if the other's pieces, some of them put
together, fit in the places of the first. Such windows belong to some best packing, so they are fixed for good, as many at
once as the histogram allows; this is repeated while it changes something. What is left goes by best fit, longest first.
Both give *patterns* (lengths in a window, and how many such windows); the k-th piece of a length finds its place
by a binary search in them.

Ids are those of a ``tokenizers`` file with a BPE over words that end in a mark. Words of plain Latin letters go through
``tiktoken`` with the same ranks, where the mark is a byte that no UTF-8 text holds; everything else through
``tokenizers`` itself. Both give the same ids, because every token of the file is what its own spelling is
merged to (the tests try all of them).
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.llm.store import stored

WIDTH = 2048
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long, ids binary"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary"
END = b"\xff"  # stands for the end of a word
#: Texts of these characters only are split and merged here; lower case keeps their number and form.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: Fixed value: how the file splits a text in lower case, for the characters of PLAIN.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")
GAPS = re.compile(r"[\t-\r ]+")  # chunks between these never merge
REMEMBERED, LONGEST = 400_000, 40  # words whose ids a task keeps, and the longest of them


def byte_letters() -> dict[str, int]:
    """The character that byte-level files write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordEncoder:
    """Token ids of texts by a BPE file with word ends, which drops white space and case."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        mark, letters = spec["model"]["end_of_word_suffix"], byte_letters()
        self.ranks: dict[bytes, int] = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in special:
                ends = token.endswith(mark)
                spelt = bytes(letters[c] for c in (token[: -len(mark)] if ends else token)) + END * ends
                if spelt in self.ranks:
                    raise ValueError(f"two tokens are spelt {spelt!r}")
                self.ranks[spelt] = i
        self.merged = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=self.ranks, special_tokens={})._encode_single_piece
        self.special = special
        self.known: dict[str, list[int]] = {}  # of words in lower case
        self.known_chunks: dict[str, list[int]] = {}  # of chunks as they stand

    def _of_word(self, word: str) -> list[int]:
        return self.merged(word.encode() + END)

    def _of_chunk(self, chunk: str) -> list[int]:
        return self.whole.encode(chunk, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            parts, encode, known = SPLIT.findall(text.lower()), self._of_word, self.known
        else:
            parts, encode, known = GAPS.split(text), self._of_chunk, self.known_chunks
        out: list[int] = []
        for part in parts:
            found = known.get(part)
            if found is None:
                found = encode(part) if part else []
                if len(part) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = found
            out += found
        return out


# ------------------------------------------------------------ the plan, from the histogram

Pattern = tuple[tuple[int, int], ...]  # (length, how many of it)


class Lengths:
    """How many pieces there are of each length, with the neighbours that the reduction asks for."""

    def __init__(self, counts: Mapping[int, int], width: int):
        self.width = width
        self.n = [0] * (width + 1)
        for length, n in counts.items():
            self.n[length] += n

    def take(self, length: int, n: int = 1) -> None:
        self.n[length] -= n

    def least(self, k: int, above: int = 0) -> list[int]:
        """The k least lengths over ``above``, equal ones included."""
        out: list[int] = []
        for length in range(above + 1, self.width + 1):
            out += [length] * min(self.n[length], k - len(out))
            if len(out) == k:
                break
        return out

    def most(self, limit: int) -> int:
        """The greatest length up to ``limit``, or 0."""
        for length in range(min(limit, self.width), 0, -1):
            if self.n[length]:
                return length
        return 0

    def best_pair(self, limit: int) -> int:
        """The greatest sum up to ``limit`` of two pieces, or 0."""
        best, low = 0, 1
        high = min(limit, self.width)
        while low <= high:
            if not self.n[low]:
                low += 1
            elif not self.n[high]:
                high -= 1
            elif low + high > limit:
                high -= 1
            elif low < high or self.n[low] > 1:
                best = max(best, low + high)
                low += 1
            else:
                break
        return best


def companions(lengths: Lengths, first: int) -> tuple[int, ...] | None:
    """Lengths that together with ``first`` (already taken out) dominate every window that holds it; None if unknown.

    Where no companion fits, or one fills the window, or one at most fits and the longest is taken, this is plain.
    Where two at most fit, the longest alone dominates if no two together are longer; the longest and the longest
    that still fits beside it dominate if every pair with a longer second is too long.
    """
    room = lengths.width - first
    longest = lengths.most(room)
    if longest == 0:
        return ()
    if longest == room:
        return (longest,)
    least = lengths.least(3)
    if len(least) < 2 or sum(least[:2]) > room:
        return (longest,)
    if len(least) == 3 and sum(least) <= room:
        return None
    if lengths.best_pair(room) <= longest:
        return (longest,)
    lengths.take(longest)
    second = lengths.most(room - longest)
    lengths.take(longest, -1)
    if second:
        over = lengths.least(2, above=second)
        if len(over) < 2 or sum(over) > room:
            return (longest, second)
    return None


def reduce(counts: Mapping[int, int], width: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """(patterns that are fixed, lengths that are left). Some best packing consists of the fixed windows and a best
    packing of the rest."""
    lengths, fixed = Lengths(counts, width), []
    changed = True
    while changed:
        changed = False
        for first in range(width, 0, -1):
            while lengths.n[first]:
                lengths.take(first)
                found = companions(lengths, first)
                lengths.take(first, -1)
                if found is None:
                    break
                pattern: dict[int, int] = {}
                for length in (first, *found):
                    pattern[length] = pattern.get(length, 0) + 1
                # a reason that holds goes on holding while the same lengths are there: pieces only become fewer
                times = min(lengths.n[length] // k for length, k in pattern.items())
                if len(found) == 2:
                    times = 1
                for length, k in pattern.items():
                    lengths.take(length, times * k)
                fixed.append((tuple(pattern.items()), times))
                changed = True
    return fixed, {length: n for length, n in enumerate(lengths.n) if n}


def best_fit(counts: Mapping[int, int], width: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, many equal pieces at a time: each goes where the least room is left that suffices."""
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}  # room -> windows of one content, and how many
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = next((r for r in range(length, width) if open_.get(r)), width)
            content, n = open_[room].pop() if room < width else ([], left)
            # the window just used has the least room that suffices until no further piece fits
            most = room // length
            used, part = divmod(left, most)
            used, part = (n, 0) if used >= n else (used, part)
            if used:
                open_.setdefault(room - most * length, []).append(([*content, (length, most)], used))
            if part:
                open_.setdefault(room - part * length, []).append(([*content, (length, part)], 1))
            untouched = n - used - bool(part)
            if untouched and room < width:
                open_[room].append((content, untouched))
            left -= used * most + part
    return [(tuple(content), n) for windows in open_.values() for content, n in windows]


class Plan:
    """Where the k-th piece of each length goes."""

    def __init__(self, counts: Mapping[int, int], width: int):
        fixed, rest = reduce(counts, width)
        patterns = [*fixed, *best_fit(rest, width)]
        self.fixed, self.windows = sum(n for _, n in fixed), sum(n for _, n in patterns)
        sizes = np.zeros(width + 2, np.int64)
        for length, n in counts.items():
            sizes[length + 1] = n
        self.first = np.cumsum(sizes)  # pieces of smaller lengths
        used = self.first.copy()
        runs, window = [], 0
        for pattern, n in patterns:
            offset = 0
            for length, k in pattern:
                runs.append((used[length], window, k, offset, length))
                used[length] += n * k
                offset += k * length
            window += n
        runs.sort()
        self.runs = np.array(runs, np.int64).reshape(-1, 5)

    def place(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, offset) of the nth piece of a length."""
        at = self.first[length] + nth
        start, window, k, offset, size = self.runs[np.searchsorted(self.runs[:, 0], at, side="right") - 1].T
        turn, slot = np.divmod(at - start, k)
        return window + turn, offset + slot * size


# ------------------------------------------------------------ the jobs


def _cut(path: str, width: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordEncoder(path), TaskContext.get().partitionId()
        seen = [0] * (width + 1)  # pieces of each length so far
        schema = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        names = [f.split()[0] for f in PIECES.split(", ")]

        def rows(columns: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema)], names)

        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encoder.ids(text.as_py() or ""), end_id], "<u4")
                for piece, start in enumerate(range(0, len(ids), width)):
                    now = ids[start : start + width].tobytes()
                    length = len(now) // 4
                    for c, v in zip(columns, (doc, piece, start, length, zlib.crc32(now), part, seen[length], now if keep_ids else None)):
                        c.append(v)
                    seen[length] += 1
                if len(columns[0]) > 20_000:
                    yield rows(columns)
                    columns = [[] for _ in names]
            yield rows(columns)

    return run


def _place(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = batch.column("length").to_numpy().astype(np.int64), batch.column("nth").to_numpy()
            window, offset = plan.place(length, nth)
            kept = [batch.column(c) for c in ("doc_id", "piece", "start")]
            columns = [*kept, pa.array(length), batch.column("ids_crc32"), pa.array(window), pa.array(offset), batch.column("ids")]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PLACED.split(", ")])

    return run


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start (its document's ids before it), length, ids_crc32 (of its ids as
    little-endian unsigned 32-bit numbers), sequence_id (from 0, without gaps), offset (its place there, gapless from 0), and
    ids (those numbers; null unless ``keep_ids``).

    A null or empty text, or one without a word, is the end id alone. Every row is packed by itself: rows without an id
    or of one id are not put together. A text longer than ``width`` ids is cut into pieces of ``width``, the last may be
    shorter; no other one is cut. Columns other than the two named are not looked at. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stored(texts.mapInArrow(_cut(path, width, end_id, keep_ids), PIECES), "pieces")
    per_part = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-lengths")
    # at most ``width`` rows
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before")).drop("before", "part")
    return numbered.mapInArrow(_place(Plan(counts, width)), PLACED)
