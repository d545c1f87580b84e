"""Repeated word windows, with a count-min sketch before the exact grouping.

A window is ``window`` consecutive words of one document; it repeats if the same words also start in a document with a
smaller id. Grouping every window would move many times the corpus, so a sketch tells first which can repeat:

1. Each part of the corpus makes a sketch of its own. It counts, per window, the window's key: the least hash of the
   grams of ``gram`` words inside it, which neighbouring windows share, so that far fewer cells are touched. A cell
   counts documents, up to two. A key stands wherever its window stands, so its count is never less than the window's.
2. The part sketches are merged by block of cells. Cells that reach two are one bit each: ``rows * cells / 8`` bytes,
   a fixed size (32 MB by default), which is broadcast. The sketch only decides what is looked at: with more keys than
   cells it passes more windows, and the result stays the same. Set ``cells`` by the corpus.
3. The second pass reads the texts again and groups exactly the windows whose key reached two in every row of the
   sketch. They go to the task of their key, the consecutive windows of one key as one row of 64-bit hashes. Windows
   are first grouped within each few megabytes of text, so a passage in very many documents is one row for each.

Words are separated by ASCII white space and compared as they are. A null or empty text has no words. A null id comes
after all others. Rows with the same id are one document: none is earlier than another. What is
cut from a row is known by the hash of its id and text, so rows that share an id, or have none, do not share it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from zstandard import ZstdDecompressor

from ledgerlens.llm.suffix_dedup import LAST, compressed, ids_of, row_key
from ledgerlens.llm.text import PIECE, RangeHash, Words, column_bytes, joined, minimizers, mix, sliding, word_bounds, word_groups

U = np.uint64
ROWS = 2  # of the sketch
BLOCK = 16  # bits of a cell's number within its block
HELD = 1 << 18  # windows that a task compares at a time


def _cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(keys + U(0x9E3779B97F4A7C15 * (row + 1) % 2**64)) >> U(64 - bits)


def _gram_hashes(code: np.ndarray, gram: int) -> np.ndarray:
    return mix(RangeHash(code).of_length(gram)) | U(1)


def _part_sketch(window: int, gram: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            # rows of one id are one document
            _, doc = np.unique(ids_of(batch.column(0)), return_inverse=True)
            keys, docs = [], []
            for words in word_groups(data, offsets, size=PIECE):
                h = _gram_hashes(words.code, gram)
                at = minimizers(h, words.bounds[1:], gram, window)
                keys.append(h[at])
                docs.append(doc[words.rows[at]])
            if not keys:
                continue
            keys, docs = np.concatenate(keys), np.concatenate(docs).astype(np.uint64)
            for row in range(ROWS):
                seen = np.unique(_cells(keys, row, bits) << U(32) | docs) >> U(32)  # a batch has fewer than 2**32 rows
                cell, count = np.unique(seen, return_counts=True)
                block = cell >> U(BLOCK)
                edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else block
                inner = (cell & U((1 << BLOCK) - 1)).astype("<u2")
                parts = [(inner[a:b], count[a:b] > 1) for a, b in zip(edge, np.r_[edge[1:], len(block)])]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array((block[edge] | U(row) << U(bits - BLOCK)).astype(np.int64)),
                    "once": pa.array([i[~m].tobytes() for i, m in parts], pa.binary()),
                    "twice": pa.array([i[m].tobytes() for i, m in parts], pa.binary()),
                })

    return run


def _merge_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows come sorted by block: the cells that two or more documents touch, as bits. One block is held at a time."""
    now, seen, many = None, np.zeros(1 << BLOCK, bool), np.zeros(1 << BLOCK, bool)

    def bits() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([now], pa.int64()), "bits": pa.array([np.packbits(many, bitorder="little").tobytes()], pa.binary())})

    for batch in batches:
        for block, one, two in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if block != now:
                if many.any():
                    yield bits()
                now = block
                seen[:] = many[:] = False
            one, two = (np.frombuffer(x.as_buffer(), "<u2") for x in (one, two))
            many[one[seen[one]]] = True
            many[two] = True
            seen[one] = True
            seen[two] = True
    if many.any():
        yield bits()


def _repeated_windows(window: int, gram: int, bits: int, sketch):
    def estimated(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
        passed = np.ones(len(keys), bool)
        for row in range(ROWS):
            cell = _cells(keys, row, bits)
            passed &= (table[row][(cell >> U(3)).astype(np.int64)] >> (cell & U(7)).astype(np.uint8)) & 1 == 1
        return passed

    def found(words: Words, ids: np.ndarray, own: np.ndarray) -> list[pa.RecordBatch]:
        """The windows of a group of texts whose key repeats. What is made on the way goes before the next group is read."""
        h = _gram_hashes(words.code, gram)
        key = sliding(np.minimum, h, window - gram + 1)
        if not len(key):
            return []
        run_of = np.r_[0, np.cumsum(key[1:] != key[:-1])]
        heads = key[np.r_[True, key[1:] != key[:-1]]]
        passed = estimated(heads, sketch.value)[run_of]
        passed &= words.rows[: len(key)] == words.rows[window - 1 :]
        del h, run_of, heads
        at = np.flatnonzero(passed)
        key, row = key[at], words.rows[at]
        print_ = mix(RangeHash(mix(words.code ^ U(0xD1B54A32D192ED03))).of(at, at + window))
        doc, pos, own = ids[row], at - words.bounds[row - words.first_row], own[row]
        order = np.lexsort((doc, print_, key))
        later = np.zeros(len(at), bool)
        later[order] = _later(key[order], print_[order], doc[order])
        return [_spans(own[later], pos[later], window), _runs(*(x[~later] for x in (key, doc, own, pos, print_)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = ids_of(batch.column(0)), batch.column(2).to_numpy()
            for words in word_groups(*column_bytes(batch.column(1))):
                yield from found(words, ids, own)

    return run


def _runs(key: np.ndarray, doc: np.ndarray, row: np.ndarray, pos: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    """Consecutive windows of one key as one row."""
    n = len(key)
    head = np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (pos[1:] != pos[:-1] + 1)] if n else np.zeros(0, bool)
    start = np.flatnonzero(head)
    ends = (np.r_[start, n] * 8).astype(np.int32)
    blob = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(prints.tobytes())])
    return pa.RecordBatch.from_pydict({"key": pa.array(key[start].view(np.int64)), "doc": pa.array(doc[start]), "row": pa.array(row[start]), "pos": pa.array(pos[start].astype(np.int32)), "end": pa.array(np.full(len(start), -1, np.int32)), "prints": blob})


def _later(key: np.ndarray, prints: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of rows sorted by window and document: whether the window stands in a smaller document."""
    new = np.r_[True, (key[1:] != key[:-1]) | (prints[1:] != prints[:-1])] if len(key) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    return doc > doc[first] if len(key) else new


def _spans(row: np.ndarray, pos: np.ndarray, window: int) -> pa.RecordBatch:
    row, start, end = joined(row, pos.astype(np.int64), pos.astype(np.int64) + window)
    return pa.RecordBatch.from_pydict({"key": pa.array(np.zeros(len(row), np.int64)), "doc": pa.array(np.zeros(len(row), np.int64)), "row": pa.array(row), "pos": pa.array(start.astype(np.int32)), "end": pa.array(end.astype(np.int32)), "prints": pa.nulls(len(row), pa.binary())})


def _group_windows(window: int, most: int = HELD):
    """The rows come sorted by key, so those of a window are together; spans that are ready pass. Keys are settled as they
    end, about ``most`` windows at a time."""

    def settled(key: np.ndarray, prints: np.ndarray, doc: np.ndarray, row: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((doc, prints, key))
        later = order[_later(key[order], prints[order], doc[order])]
        return _spans(row[later], pos[later], window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, limit = [], 0, most
        for batch in batches:
            ready = batch.column(4).to_numpy() >= 0
            if ready.any():
                yield batch.filter(pa.array(ready))
            runs = batch.filter(pa.array(~ready))
            data, offsets = column_bytes(runs.column(5))
            n = np.diff(offsets) // 8
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            key, doc, row, pos = (np.repeat(runs.column(i).to_numpy(), n) for i in range(4))
            parts.append((key, data.copy().view(np.uint64), doc, row, pos + inner))
            held += len(key)
            if held >= limit:
                whole = [np.concatenate(x) for x in zip(*parts)]
                ended = int(np.searchsorted(whole[0], whole[0][-1]))  # the last key may go on
                parts, held = [[x[ended:].copy() for x in whole]], len(whole[0]) - ended
                # a key of more windows is held whole
                limit = max(most, 2 * held)
                if ended:
                    yield settled(*(x[:ended] for x in whole))
        if held:
            yield settled(*(np.concatenate(x) for x in zip(*parts)))

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, gram: int = 6, cells: int = 1 << 27) -> DataFrame:
    """(row, spans): per row with repeats, by its ``row_key``, the ranges of word numbers to remove."""
    bits = cells.bit_length() - 1
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), row_key(docs, id_col, text_col).alias("row"))
    parts = texts.mapInArrow(_part_sketch(window, gram, bits), "block long, once binary, twice binary")
    # sorted, as a small input puts all blocks into one task
    merged = parts.repartition(F.col("block")).sortWithinPartitions("block").mapInArrow(_merge_sketches, "block long, bits binary")
    # rows * cells / 8 bytes, whatever the corpus, which the tasks of a worker share
    table = np.zeros((ROWS, 1 << bits - BLOCK, (1 << BLOCK) // 8), np.uint8)
    for r in merged.collect():
        table[divmod(r["block"], 1 << bits - BLOCK)] = np.frombuffer(r["bits"], np.uint8)
    sketch = docs.sparkSession.sparkContext.broadcast(table.reshape(ROWS, -1))
    rows = "key long, doc long, row long, pos int, end int, prints binary"
    windows = texts.mapInArrow(_repeated_windows(window, gram, bits, sketch), rows)
    # spans that are ready go by document, so that they spread as well
    spread = F.when(F.col("end") < 0, F.col("key")).otherwise(F.xxhash64("row", "pos"))
    spans = windows.repartition(spread).sortWithinPartitions("key").mapInArrow(_group_windows(window), rows)
    return spans.groupBy("row").agg(F.collect_list(F.struct(F.col("pos").cast("long").alias("start"), F.col("end").cast("long").alias("end"))).alias("spans"))


def _kept(raw: bytes, spans: pa.Scalar) -> tuple[int, bytes, str]:
    """Words of a text, those kept joined by one space, and the text without the others."""
    start, end = word_bounds(np.frombuffer(raw, np.uint8), np.zeros(1, np.int64))
    if not spans.is_valid or not len(start):
        return len(start), b" ".join(raw.split()), raw.decode("utf-8", "replace")
    edge = np.zeros(len(start) + 1, np.int64)
    a, b = (np.minimum(spans.values.field(n).to_numpy(), len(start)) for n in ("start", "end"))
    np.add.at(edge, a, 1)
    np.add.at(edge, b, -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    words = b" ".join([raw[i:j] for i, j in zip(start[kept].tolist(), end[kept].tolist())])
    # what stays keeps its white space; a removed word takes the space behind it along
    stop = np.r_[start[1:], len(raw)]
    text = raw[: start[0]] + b"".join([raw[i:j] for i, j in zip(start[kept].tolist(), stop[kept].tolist())])
    return len(start), words, text.decode("utf-8", "replace")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, z, spans in zip(*(batch.column(i) for i in range(3))):
            n, words, text = _kept(ZstdDecompressor().decompress(z.as_py()), spans)
            left = words.count(b" ") + 1 if words else 0
            doc = doc.as_py()
            rows.append((None if doc == LAST else doc, n, n - left, words, text))
        names = ("doc_id", "n_words", "n_removed", "kept_words", "kept_text")
        yield pa.RecordBatch.from_pylist(
            [dict(zip(names, r)) for r in rows],
            pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_words", pa.binary()), ("kept_text", pa.string())]),
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_words, kept_text), one row per input row.

    ``kept_words`` are the words left, joined by one space (UTF-8 bytes); ``kept_text`` is the text without the
    removed words and the white space behind each of them.
    """
    spans = repeated_spans(docs, id_col, text_col, **options)
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), row_key(docs, id_col, text_col).alias("row"))
    packed = texts.mapInArrow(compressed, "doc long, z binary, row long")
    return packed.join(spans, "row", "left").select("doc", "z", "spans").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_words binary, kept_text string"
    )


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with ``text_col`` as it is without the repeats; the other columns stay as they are."""
    spans = repeated_spans(docs, id_col, text_col, **options)
    rows = docs.select(F.struct(*docs.columns).alias("whole"), row_key(docs, id_col, text_col).alias("row"))
    joined_ = rows.join(spans, "row", "left").select(F.col("whole").alias("row"), "spans")
    whole = joined_.filter("spans is null").select("row.*")
    cut = joined_.filter("spans is not null").select(F.lit(0).cast("long").alias("doc"), F.encode(F.col(f"row.{text_col}").cast("string"), "UTF-8").alias("raw"), "spans", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_kept(raw.as_py() or b"", spans)[2] for raw, spans in zip(batch.column(1), batch.column(2))]
            row = batch.column(3)
            names = [f.name for f in row.type]
            yield pa.RecordBatch.from_pydict({n: pa.array(texts, pa.string()) if n == text_col else row.field(n) for n in names})

    return whole.unionByName(cut.mapInArrow(run, docs.schema))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM words)
), first AS (
  SELECT s, min(doc_id) AS first_doc FROM windows GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM (SELECT doc_id, i, unnest(generate_series(0, 12)) AS k FROM windows JOIN first USING (s) WHERE doc_id > first_doc)
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM words
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
