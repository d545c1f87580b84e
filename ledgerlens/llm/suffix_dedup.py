"""Repeated byte strings, by sorting sampled suffixes: deep-shallow sorting.

A string of ``length`` bytes repeats if it also starts earlier (smaller document id, or the same document and an
earlier start). Sorting a suffix for every byte would move many times the corpus, so only suffixes at anchors are
sorted. An anchor is the place of the least gram hash within some window of ``length`` bytes; equal strings have their
anchors at equal places, so each repeated string holds an anchor that repeats with it. What an anchor can tell is
limited to its context, the ``length - gram`` bytes on either side of it.

1. Anchors go to the task of their gram, with a hash of the context. An anchor whose gram stands nowhere else is
   done. One whose whole context stands earlier is done as well: all its context repeats. Both are first settled
   within each task's rows, so a passage in a third of all documents sends one row per task.
2. Anchors of grams with several contexts are sorted: the suffixes from the anchor on, and the reversed prefixes
   before it. Multikey quicksort orders them to a shallow depth, and blind tries order the groups that still tie. The
   common prefixes of neighbours then tell, for every offset of a window around the anchor, which contexts share it.
3. A gram with more contexts than one task should sort is cut by the bytes around it. A window with ``o`` bytes before
   the gram lies either in the lower or the upper half of the offsets; all windows of the upper half share the bytes
   just before the gram, those of the lower half the bytes just after it. So contexts are dealt anew for each half, by
   these bytes, cut to what the half can see. Contexts that are now the same become one, as in step 1, and what is
   still too large is halved again, at most once for each bit of the number of offsets.

Texts are UTF-8 bytes; a null or empty text has none. Documents with a null id come after all others. A row is known
by a hash of its id and text: rows with the same of both are one document given more than once, so none of them is earlier
than another; other rows of one id, or without one, are documents of their own, in order of that hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from ledgerlens.llm.store import stored
from ledgerlens.llm.text import BYTE_CODE, RangeHash, column_bytes, joined, minimizers, mix, piece_groups

LAST = np.iinfo(np.int64).max  # stands for a null id
SINGLE, WITNESS, CONTEXT, SPAN = range(4)
ROWS = "kind int, h long, c long, doc long, row long, pos int, left int, ctx binary"
PART = "kind int, h long, c long, doc long, row long, pos int, left int, ctx binary, lo int, hi int"
SHALLOW = 2  # words of 8 bytes
BROADCAST_KEYS = 1_000_000  # of 8 bytes


# ------------------------------------------------------------- sorting


class BlindTrie:
    """Orders distinct strings. A node keeps only where its strings part and by which byte, not the text between."""

    def __init__(self, first: bytes):
        self.root: tuple | bytes = first

    @staticmethod
    def common(a: bytes, b: bytes) -> int:
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            return n
        low, high = 0, n
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
        return low

    def add(self, s: bytes) -> None:
        """Two descents: a blind one to some leaf, one comparison with it, and one to where they part."""
        node = self.root
        while isinstance(node, tuple):
            depth, kids = node
            node = kids.get(s[depth] if depth < len(s) else -1) or next(iter(kids.values()))
        part = self.common(s, node)
        mine = s[part] if part < len(s) else -1
        theirs = node[part] if part < len(node) else -1
        above, label, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < part:
            above, label = node, s[node[0]]
            node = node[1][label]
        if isinstance(node, tuple) and node[0] == part:
            node[1][mine] = s
            return
        new = (part, {theirs: node, mine: s})
        if above is None:
            self.root = new
        else:
            above[1][label] = new

    def sorted(self) -> Iterator[bytes]:
        todo = [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                yield node


def deep_shallow(group: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The order of byte strings (rows of a zero-padded matrix, with their lengths) within groups.

    Shallow: quicksort by one 8-byte character at a time, where only ties go on to the next character. Deep: the rows
    that tie to the end of that go into a blind trie per tied group.
    """
    order = np.argsort(group, kind="stable")
    tied = np.cumsum(np.r_[0, group[order][1:] != group[order][:-1]]) if len(order) else order
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    words = padded.view(">u8").astype(np.uint64)
    for depth in range(min(SHALLOW, words.shape[1])):
        size = np.bincount(tied)
        again = np.flatnonzero(size[tied] > 1)
        if not len(again):
            return order
        at = order[again]
        word = words[at, depth]
        inner = np.lexsort((word, tied[again]))
        order[again] = at[inner]
        value = np.zeros(len(order), np.uint64)
        value[again] = word[inner]
        tied = np.cumsum(np.r_[0, (tied[1:] != tied[:-1]) | (value[1:] != value[:-1])])
    size = np.bincount(tied)
    ends = np.cumsum(size)
    for g in np.flatnonzero(size > 1).tolist():
        at = order[ends[g] - size[g] : ends[g]]
        same: dict[bytes, list[int]] = {}
        for i in at.tolist():
            same.setdefault(rows[i, : lengths[i]].tobytes(), []).append(i)
        if len(same) > 1:
            texts = iter(same)
            trie = BlindTrie(next(texts))
            for s in texts:
                trie.add(s)
            order[ends[g] - size[g] : ends[g]] = [i for s in trie.sorted() for i in same[s]]
    return order


def common_prefixes(order: np.ndarray, group: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before it in the order; -1 where a group begins."""
    common = np.full(len(order), -1, np.int64)
    for at in range(1, len(order), 65536):
        a, b = order[at - 1 : at + 65535][: len(order[at : at + 65536])], order[at : at + 65536]
        differ = rows[a] != rows[b]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        length = np.minimum(first, np.minimum(lengths[a], lengths[b]))
        common[at : at + len(a)] = np.where(group[a] == group[b], length, -1)
    return common


def shared_offsets(
    group: np.ndarray, place: np.ndarray, before: np.ndarray, n_before: np.ndarray, after: np.ndarray, n_after: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by place: the least and largest offset o at which the window of o bytes before the anchor and
    ``reach - o`` after it also stands at an earlier place of the same group; -1 where there is none.

    ``before`` is read away from the anchor. Rows of one place are one occurrence.
    """
    n, reach = len(group), before.shape[1]
    least, most = np.full(n, -1), np.full(n, -1)
    orders = [deep_shallow(group, m, k) for m, k in ((before, n_before), (after, n_after))]
    common = [common_prefixes(o, group, m, k) for o, m, k in zip(orders, (before, after), (n_before, n_after))]

    def classes(side: int, depth: int) -> np.ndarray:
        """Rows with the same first ``depth`` bytes on a side have the same number."""
        out = np.empty(n, np.int64)
        out[orders[side]] = np.cumsum(common[side] < depth)
        return out

    for o in range(reach + 1):
        rows = np.flatnonzero((n_before >= o) & (n_after >= reach - o))
        if len(rows) < 2:
            continue
        key = classes(0, o)[rows] * (n + 1) + classes(1, reach - o)[rows]
        by_key = np.argsort(key, kind="stable")  # rows stay sorted by place
        start = np.r_[True, key[by_key][1:] != key[by_key][:-1]]
        earliest = place[rows[by_key]][np.maximum.accumulate(np.where(start, np.arange(len(rows)), 0))]
        hit = rows[by_key][place[rows[by_key]] > earliest]
        least[hit] = np.where(least[hit] < 0, o, least[hit])
        most[hit] = o
    return least, most


# -------------------------------------------------------------- stages


def _batch(**columns) -> pa.RecordBatch:
    n = len(columns["doc"])
    whole = {
        name: columns.get(name, np.zeros(n, np.int64))
        for name in ("kind", "h", "c", "doc", "row", "pos", "left")
    }
    kinds = {"kind": pa.int32(), "pos": pa.int32(), "left": pa.int32()}
    arrays = {k: pa.array(np.asarray(v).astype(np.int64), pa.int64()).cast(kinds.get(k, pa.int64())) for k, v in whole.items()}
    arrays["ctx"] = columns.get("ctx", pa.nulls(n, pa.binary()))
    return pa.RecordBatch.from_pydict(arrays)


def row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """What tells a row from others, those with the same id too."""
    return F.xxhash64(docs[id_col].cast("long"), docs[text_col].cast("string"))


def _spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    row, start, end = joined(row, start, end)
    return _batch(kind=np.full(len(row), SPAN), doc=np.zeros(len(row), np.int64), row=row, pos=start, c=end)


def _contexts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    sizes = end - start
    offsets = np.r_[0, np.cumsum(sizes)]
    index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, sizes)
    return pa.Array.from_buffers(
        pa.binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[index].tobytes())]
    )


def ids_of(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _anchors(length: int, gram: int):
    reach = length - gram

    def found(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        out = [[] for _ in range(6)]
        for group in piece_groups(offsets, overlap=4 * length):
            part = np.concatenate([data[p.start : p.end] for p in group])
            sizes = np.array([p.end - p.start for p in group])
            ends = np.cumsum(sizes)
            grams = RangeHash(BYTE_CODE[part])
            h = mix(grams.of_length(gram)) | np.uint64(1)
            at = minimizers(h, ends, gram, length)
            which = np.searchsorted(ends, at, side="right")
            low, high = (ends - sizes)[which], ends[which]
            # anchors near a cut inside a row are whole in the neighbouring piece
            opens, closes = np.array([p.opens for p in group]), np.array([p.closes for p in group])
            whole = (opens[which] | (at - low >= 2 * length)) & (closes[which] | (high - at >= length))
            at, which, low, high = at[whole], which[whole], low[whole], high[whole]
            start, end = np.maximum(at - reach, low), np.minimum(at + gram + reach, high)
            context = mix(mix(grams.of(start, end)) + np.uint64(0x9E3779B97F4A7C15) * (at - start).astype(np.uint64) + (end - at).astype(np.uint64))
            shift = np.array([p.start for p in group])[which] - low  # to the column's bytes
            rows = np.array([p.row for p in group])[which]
            for x, v in zip(out, (h[at], context, rows, at + shift, start + shift, end + shift)):
                x.append(v)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ids_of(batch.column(0))
            data, offsets = column_bytes(batch.column(1))
            h, c, row, at, start, end = found(data, offsets)
            if not len(h):
                continue
            doc, base, row = ids[row], offsets[row], batch.column(2).to_numpy()[row]
            order = np.lexsort((at - base, row, doc, c, h))
            h, c, doc, row, at, start, end, base = (x[order] for x in (h, c, doc, row, at, start, end, base))
            pos = at - base
            new_h = np.r_[True, h[1:] != h[:-1]]
            new_c = new_h | np.r_[True, c[1:] != c[:-1]]
            first = np.maximum.accumulate(np.where(new_c, np.arange(len(h)), 0))
            later = (row != row[first]) | (pos != pos[first])  # the whole context stands earlier
            yield _spans(row[later], (start - base)[later], (end - base)[later])
            several = np.bincount(np.cumsum(new_h) - 1, weights=new_c)[np.cumsum(new_h) - 1] > 1
            lone = new_c & ~several
            yield _batch(h=h[lone].view(np.int64), c=c[lone].view(np.int64), doc=doc[lone], row=row[lone], pos=pos[lone])
            tell = new_h & several
            yield _batch(kind=np.full(tell.sum(), WITNESS), h=h[tell].view(np.int64), c=c[tell].view(np.int64), doc=doc[tell], row=row[tell], pos=pos[tell])
            many = np.flatnonzero(new_c & several)
            for i in range(0, len(many), 50_000):
                m = many[i : i + 50_000]
                yield _batch(kind=np.full(len(m), CONTEXT), h=h[m].view(np.int64), c=c[m].view(np.int64), doc=doc[m], row=row[m], pos=pos[m], left=(at - start)[m], ctx=_contexts(data, start[m], end[m]))

    return run


def _settle(length: int, gram: int):
    """One gram's rows are together: what repeats as a whole, and whose context must be looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            ready = kind >= CONTEXT
            if ready.any():
                yield batch.filter(pa.array(ready))
            if not ready.all():
                b = batch.filter(pa.array(~ready))
                kept.append([b.column(i).to_numpy() for i in range(6)])
        if not kept:
            return
        kind, h, c, doc, row, pos = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((pos, row, doc, c, h))
        kind, h, c, doc, row, pos = (x[order] for x in (kind, h, c, doc, row, pos))
        new_h = np.r_[True, h[1:] != h[:-1]]
        new_c = new_h | np.r_[True, c[1:] != c[:-1]]
        first = np.maximum.accumulate(np.where(new_c, np.arange(len(h)), 0))
        later = (row != row[first]) | (pos != pos[first])
        reach = length - gram
        yield _spans(row[later], np.maximum(0, pos[later] - reach), pos[later] + gram + reach)
        of = np.cumsum(new_h) - 1
        several = (np.bincount(of, weights=new_c)[of] > 1) | (np.bincount(of, weights=kind == WITNESS)[of] > 0)
        fetch = new_c & several & (kind == SINGLE)
        yield _batch(h=h[fetch], c=c[fetch], doc=doc[fetch], row=row[fetch], pos=pos[fetch])

    return run


def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, z, row): texts squeezed before a shuffle."""
    squeeze = ZstdCompressor(level=1).compress
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        packed = [squeeze(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_pydict({"doc": pa.array(ids_of(batch.column(0))), "z": pa.array(packed, pa.binary()), "row": batch.column(2)})


def _expand(z: bytes) -> np.ndarray:
    return np.frombuffer(ZstdDecompressor().decompress(z), np.uint8)


def _fetch(length: int, gram: int):
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, z, row, wanted in zip(*(batch.column(i) for i in range(4))):
                text = _expand(z.as_py())
                want = wanted.values
                h, pos = want.field("h").to_numpy(), want.field("pos").to_numpy().astype(np.int64)
                start, end = np.maximum(0, pos - reach), np.minimum(len(text), pos + gram + reach)
                yield _batch(kind=np.full(len(h), CONTEXT), h=h, doc=np.full(len(h), doc.as_py()), row=np.full(len(h), row.as_py()), pos=pos, left=pos - start, ctx=_contexts(text, start, end))

    return run


def _runs(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.Table]:
    """Rows sorted by ``h`` in parts that end where a key ends."""
    parts, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        parts.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        whole = pa.Table.from_batches(parts)
        h = whole.column("h").to_numpy()
        end = int(np.searchsorted(h, h[-1]))
        if end:
            yield whole.slice(0, end)
        parts, size = whole.slice(end).to_batches(), whole.num_rows - end
    if size:
        yield pa.Table.from_batches(parts)


def _sorted_spans(length: int, gram: int):
    """Contexts come sorted by ``h``; those of one ``h`` are compared with each other."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _runs(batches):
            order = np.lexsort([whole.column(n).to_numpy() for n in ("pos", "row", "doc")])
            h, row, pos, left = (whole.column(n).to_numpy()[order].astype(np.int64) for n in ("h", "row", "pos", "left"))
            data, offsets = column_bytes(whole.column("ctx"))
            start, n = offsets[:-1][order], np.diff(offsets)[order]
            right = n - left - gram
            place = np.cumsum(np.r_[0, (row[1:] != row[:-1]) | (pos[1:] != pos[:-1])])
            steps = np.arange(reach)
            pad = np.r_[data, np.zeros(1, np.uint8)]
            # reversed prefixes and suffixes of the gram, padded with zeros
            before = np.where(steps < left[:, None], pad[np.clip((start + left)[:, None] - 1 - steps, 0, len(data))], 0).astype(np.uint8)
            after = np.where(steps < right[:, None], pad[np.clip((start + left + gram)[:, None] + steps, 0, len(data))], 0).astype(np.uint8)
            least, most = shared_offsets(h, place, before, left, after, right)
            hit = least >= 0
            yield _spans(row[hit], pos[hit] - most[hit], pos[hit] - least[hit] + length)

    return run


def _one_each(ordered: bool):
    """Of the contexts with one (h, c) the earliest is kept, those at later places become the spans they cover.

    ``ordered``: the input is sorted by (kind, h, c, doc, row, pos) and (h, c) is whole, else every batch is looked at alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            ready = batch.column("kind").to_numpy() == SPAN
            if ready.any():
                yield batch.filter(pa.array(ready))
                batch = batch.filter(pa.array(~ready))
            if not batch.num_rows:
                continue
            order = np.lexsort([batch.column(n).to_numpy() for n in ("pos", "row", "doc", "c", "h")])
            batch = batch.take(pa.array(order))
            h, c, row, pos, left = (batch.column(n).to_numpy().astype(np.int64) for n in ("h", "c", "row", "pos", "left"))
            new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])]
            first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            first_row, first_pos = row[first], pos[first]
            if ordered and last is not None and last[:2] == (h[0], c[0]):
                new[0] = False
                first_row, first_pos = np.where(first == 0, last[2], first_row), np.where(first == 0, last[3], first_pos)
            last = h[-1], c[-1], first_row[-1], first_pos[-1]
            yield batch.filter(pa.array(new))
            later = (row != first_row) | (pos != first_pos)
            start = pos - left
            of, start, end = joined(row[later], start[later], (start + np.diff(column_bytes(batch.column("ctx"))[1]))[later])
            zero = np.zeros(len(of), np.int32)
            columns = {"kind": zero + SPAN, "h": of, "c": end, "doc": zero, "row": of, "pos": start, "left": zero, "lo": zero, "hi": zero}
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name].astype(np.int64)).cast(f.type) if f.name in columns else pa.nulls(len(of), f.type) for f in batch.schema],
                schema=batch.schema,
            )

    return run


def _halved(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """Contexts with windows at offsets ``lo`` to ``hi``, dealt anew for either half by what all its windows share."""
    reach = length - gram
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.explode(F.array(
        F.struct(F.col("lo"), middle.alias("hi")),
        F.struct((middle + 1).alias("lo"), F.col("hi")),
    ))
    rows = contexts.select("h", "doc", "row", "pos", "left", "ctx", halves.alias("half"))
    lo, hi = F.col("half.lo"), F.col("half.hi")
    left = F.least("left", hi)
    right = F.least(F.length("ctx") - F.col("left") - gram, reach - lo)
    rows = rows.filter((left >= lo) & (right >= reach - hi) & (left + right >= reach)).select(
        "h", "doc", "row", "pos", lo.alias("lo"), hi.alias("hi"), left.alias("left"),
        F.substring("ctx", F.col("left") - left + 1, left + gram + right).alias("ctx"),
    )
    shared = F.substring("ctx", F.col("left") - F.col("lo") + 1, F.col("lo") + gram + reach - F.col("hi"))
    rows = rows.withColumn("h", F.xxhash64("h", "lo", "hi", shared)).withColumn("c", F.xxhash64("left", "ctx"))
    rows = rows.select(F.lit(CONTEXT).alias("kind"), "h", "c", "doc", "row", "pos", "left", "ctx", "lo", "hi")
    rows = rows.mapInArrow(_one_each(False), PART).repartition("h", "c").sortWithinPartitions("kind", "h", "c", "doc", "row", "pos")
    return rows.mapInArrow(_one_each(True), PART)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = 40, task_contexts: int = 5_000) -> DataFrame:
    """(row, spans): per row with repeats, by its ``row_key``, the byte ranges to remove.

    ``task_contexts`` is how many contexts of one gram are sorted together; more are first cut by the bytes around it.
    """
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), row_key(docs, id_col, text_col).alias("row"))
    settled = stored(
        texts.mapInArrow(_anchors(length, gram), ROWS).repartition(F.col("h")).mapInArrow(_settle(length, gram), ROWS),
        "anchors",
    )
    wanted = settled.filter(F.col("kind") == SINGLE).groupBy("row").agg(F.collect_list(F.struct("h", "pos")).alias("wanted"))
    packed = texts.mapInArrow(compressed, "doc long, z binary, row long")
    fetched = packed.join(wanted, "row").select("doc", "z", "row", "wanted").mapInArrow(_fetch(length, gram), ROWS)
    contexts = stored(settled.filter(F.col("kind") == CONTEXT).unionByName(fetched).select("h", "doc", "row", "pos", "left", "ctx"), "contexts")
    spans = settled.filter(F.col("kind") == SPAN).select("row", "pos", "c")
    contexts = contexts.withColumns({"lo": F.lit(0), "hi": F.lit(length - gram)})
    while True:
        sizes = contexts.groupBy("h").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        large = stored(sizes.filter((F.col("n") > task_contexts) & (F.col("lo") < F.col("hi"))).select("h"), "large-grams")
        n_large = large.count()
        large = F.broadcast(large) if n_large <= BROADCAST_KEYS else large
        light = contexts.join(large, "h", "left_anti") if n_large else contexts
        sort = light.select("h", "doc", "row", "pos", "left", "ctx").repartition(F.col("h")).sortWithinPartitions("h")
        spans = spans.unionByName(sort.mapInArrow(_sorted_spans(length, gram), ROWS).select("row", "pos", "c"))
        if not n_large:
            break
        halves = _halved(contexts.join(large, "h", "left_semi"), length, gram)
        halves = stored(halves, "halves")
        spans = spans.unionByName(halves.filter(F.col("kind") == SPAN).select("row", "pos", "c"))
        contexts = halves.filter(F.col("kind") == CONTEXT).drop("kind", "c")
    return spans.groupBy("row").agg(F.collect_list(F.struct(F.col("pos").cast("long").alias("start"), F.col("c").alias("end"))).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, z, spans in zip(*(batch.column(i) for i in range(3))):
            raw = ZstdDecompressor().decompress(z.as_py())
            runs = []
            if spans.is_valid:
                start, end = (spans.values.field(n).to_numpy() for n in ("start", "end"))
                end = np.minimum(end, len(raw))
                ok = start < end
                _, start, end = joined(np.zeros(ok.sum(), np.int64), start[ok], end[ok])
                runs = list(zip(start.tolist(), end.tolist()))
            kept, at = [], 0
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            doc = doc.as_py()
            rows.append((None if doc == LAST else doc, len(raw), len(raw) - len(kept), [{"start": a, "end": b} for a, b in runs], kept))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("doc_id", "n_bytes", "n_removed", "spans", "kept"), r)) for r in rows],
            pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]),
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): each document with the bytes that are left, one row per input row."""
    spans = repeated_spans(docs, id_col, text_col, length, **options)
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), row_key(docs, id_col, text_col).alias("row"))
    packed = texts.mapInArrow(compressed, "doc long, z binary, row long")
    return packed.join(spans, "row", "left").select("doc", "z", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    )


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
