"""Packing of token ids into fixed windows, online and in bounded space.

Each partition keeps ``open_windows`` windows open. A document's whole windows are filled at once; its rest goes into the
open window that it fits best. If it fits none, the fullest window is filled up with the rest's beginning and
emitted, which frees a place for what is left of it. So only the windows still open at the end of a partition are
not full. Their contents are strung together there into full windows and one leftover of less than a window, and
leftovers are merged in rounds, ``fan_in`` at a time, until one is left; it is cut at powers of two, which need no
padding. No task ever holds more than a batch of texts, the open windows, or ``fan_in`` leftovers.

Ids are those of a byte-level BPE file of the ``tokenizers`` library, with ``end_id`` after each document. They are made
by ``tiktoken``, which reads the same ranks and gives the same ids about five times as fast; a text that holds the name
of a special token, or a run of white space so long that ``tiktoken`` would run out of stack, goes through ``tokenizers`` itself. A null or empty text is the end id alone.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.store import stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Fixed value: how the BPE splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: White space that the pattern would have to try one by one from its end.
BLANKS = re.compile(r"\s{5000}")


class Encoder:
    """Token ids of texts by a byte-level BPE file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # the file writes each byte as a printable character
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path, self.whole = path, None

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or BLANKS.search(text):
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Window:
    """Pieces of documents, in order: (doc, start, ids, doc_tokens)."""

    def __init__(self):
        self.pieces: list[tuple] = []
        self.size = 0

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        if len(ids):
            self.pieces.append((doc, start, ids, total))
            self.size += len(ids)


class Packer:
    """Emits full windows as lists of pieces."""

    def __init__(self, width: int, open_windows: int):
        self.width, self.most = width, open_windows
        self.open: list[Window] = []

    def put(self, doc, start: int, ids: np.ndarray, total: int) -> Iterator[Window]:
        while len(ids) >= self.width:
            full = Window()
            full.add(doc, start, ids[: self.width], total)
            yield full
            ids, start = ids[self.width :], start + self.width
        if not len(ids):
            return
        fits = [w for w in self.open if w.size + len(ids) <= self.width]
        if not fits and len(self.open) == self.most:
            fullest = max(self.open, key=lambda w: w.size)
            gap = self.width - fullest.size
            fullest.add(doc, start, ids[:gap], total)
            ids, start = ids[gap:], start + gap
            self.open.remove(fullest)
            yield fullest
        if fits:
            best = max(fits, key=lambda w: w.size)
            best.add(doc, start, ids, total)
            if best.size == self.width:
                self.open.remove(best)
                yield best
        elif len(ids):
            self.open.append(Window())
            self.open[-1].add(doc, start, ids, total)

    def close(self) -> Iterator[Window]:
        """Full windows made of what is open; the rest stays as one open window."""
        pieces = [p for w in self.open for p in w.pieces]
        self.open = []
        yield from strung(pieces, self.width, self.open)


def strung(pieces: list[tuple], width: int, rest: list[Window]) -> Iterator[Window]:
    """The pieces one after the other in full windows; what is left goes to ``rest``."""
    now = Window()
    for doc, start, ids, total in pieces:
        while len(ids):
            room = width - now.size
            now.add(doc, start, ids[:room], total)
            ids, start = ids[room:], start + room
            if now.size == width:
                yield now
                now = Window()
    if now.size:
        rest.append(now)


def _rows(windows: list[Window], first_id: int, keep_ids: bool) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(8)]
    for k, w in enumerate(windows):
        at = 0
        for doc, start, ids, total in w.pieces:
            raw = np.ascontiguousarray(ids, "<u4").tobytes()
            for c, v in zip(columns, (doc, start, len(ids), zlib.crc32(raw), total, first_id + k, at, raw if keep_ids else None)):
                c.append(v)
            at += len(ids)
    names = [f.split()[0] for f in PIECES.split(", ")]
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, columns)})


def _pack(path: str, width: int, open_windows: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(path), Packer(width, open_windows)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            done: list[Window] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encoder.ids(text.as_py() or ""), end_id], "<u4")
                done += packer.put(doc, 0, ids, len(ids))
                if len(done) > 2000:
                    yield _rows(done, number, False)
                    number, done = number + len(done), []
            yield _rows(done, number, False)
            number += len(done)
        done = list(packer.close())
        yield _rows(done, number, False)
        yield _rows(packer.open, number + len(done), True)

    return run


def _merge(width: int, round_: int, last: bool):
    """The leftovers of one group, strung together; with their ids as long as something is left to merge."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> dict[int, list[tuple]]:
        groups: dict[int, list[tuple]] = {}
        for batch in batches:
            for group, doc, start, total, seq, at, ids in zip(*(batch.column(i).to_pylist() for i in range(7))):
                groups.setdefault(group, []).append((seq, at, (doc, start, np.frombuffer(ids, "<u4"), total)))
        return {g: [p for *_, p in sorted(rows, key=lambda r: r[:2])] for g, rows in sorted(groups.items())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in pieces(batches).items():
            rest: list[Window] = []
            number = (round_ << 56) | (group << 24)
            done = list(strung(rows, width, rest))
            if last and rest:
                # cut at powers of two, the largest first
                left, rest = rest[0].pieces, []
                size = sum(len(p[2]) for p in left)
                for bit in reversed(range(size.bit_length())):
                    if size >> bit & 1:
                        head = next(strung(left, 1 << bit, []))
                        skip, after = 1 << bit, []
                        for doc, start, ids, total in left:
                            cut = min(skip, len(ids))
                            skip -= cut
                            if cut < len(ids):
                                after.append((doc, start + cut, ids[cut:], total))
                        done.append(head)
                        left = after
            yield _rows(done, number, False)
            yield _rows(rest, number + len(done), True)

    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", width: int = 2048, open_windows: int = 64, end_id: int = 1, fan_in: int = 64) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length, ids_crc32 (of its ids as little-endian
    unsigned 32-bit numbers), doc_tokens (with the end id), sequence_id, offset (its place in the sequence)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    first = stored(texts.mapInArrow(_pack(path, width, open_windows, end_id), PIECES), "packed")
    out = first.filter("ids is null").drop("ids")
    left = first.filter("ids is not null")
    group = F.shiftright("sequence_id", 32)
    count = left.select("sequence_id").distinct().count()
    round_ = 1
    while count:
        # leftovers are numbered by their partition, so nearby ones meet; every group holds at most fan_in of them
        last = count <= fan_in
        number = F.lit(0).cast("long") if last else F.floor(group / fan_in).cast("long")
        picked = left.select(number.alias("group"), "doc_id", "start", "doc_tokens", "sequence_id", "offset", "ids")
        merged = stored(picked.repartition(F.col("group")).mapInArrow(_merge(width, round_, last), PIECES), "packed-leftovers")
        out = out.unionByName(merged.filter("ids is null").drop("ids"))
        left = merged.filter("ids is not null")
        group = F.shiftright(F.col("sequence_id").bitwiseAND(F.lit((1 << 56) - 1)), 24)
        count = left.select("sequence_id").distinct().count() if not last else 0
        round_ += 1
    return out
