"""SimHash near-duplicates, found with an inverted index on byte positions and a count filter.

Two fingerprints of 64 bits that differ in at most two bits agree in at least six of their eight bytes, so of the four
pairs of neighbouring bytes at least two agree. The index lists fingerprints by each of the six ways to take two such
pairs, place and value. Fingerprints that meet in a short list are paired, their equal bytes counted, and pairs
with fewer than the guaranteed six dropped before the bits are compared.

A list longer than ``LIST`` is not paired: there may be thousands of near copies. Its members also go, each with its
64 one-bit neighbours, into groups by value. Two fingerprints share such a value exactly if they differ in at most two
bits, and at most 65 different ones can, so linking each to the least of its group finds every link in linear time.

Copies are one fingerprint from the start; nothing is paired within a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.components import components
from ledgerlens.llm.store import stored
from ledgerlens.llm.suffix_dedup import row_key

LAST = np.iinfo(np.int64).max  # stands for a null id: it comes after all others
LIST = 8


def words_of(text: str | None) -> list[bytes]:
    """The words between ASCII white space, with A-Z as a-z."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(words: list[bytes], n: int) -> list[bytes]:
    """Runs of n words, repeats included; the whole sequence if it is shorter."""
    if len(words) < n:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    return [line[a:b] for a, b in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())]


def majority(hashes: np.ndarray) -> np.ndarray:
    """For rows of 64-bit hashes: the bits set in over half of them, per column, as 64-bit words."""
    counts = np.zeros((hashes.shape[1], 64), np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.ascontiguousarray(hashes[at : at + 8192])
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), -1, 8), axis=2, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprints(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column(1)):
                parts = shingles(words_of(text.as_py()), n)
                if parts:
                    hashes = np.fromiter((digest(s, 42) for s in parts), np.uint64, len(parts))
                    out[i] = majority(hashes[:, None])[0]
            ids = batch.column(0).fill_null(LAST)
            yield pa.RecordBatch.from_pydict({"doc": ids, "fp": pa.array(out.view(np.int64)), "row": batch.column(2)})

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, row: Column | None = None) -> DataFrame:
    """(doc, fp, row) for every row, ``row`` being a column to carry along. A null or empty text, or one without words, has the fingerprint 0."""
    carried = F.lit(None) if row is None else row
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string"), carried.cast("long").alias("row"))
    return texts.mapInArrow(_fingerprints(words), "doc long, fp long, row long")


def _byte_keys(fp: Column) -> list[Column]:
    """The value of two byte pairs at a time, with their places."""
    keys = []
    for i, pair in enumerate(combinations(range(4), 2)):
        mask = sum(0xFFFF << (16 * p) for p in pair)
        keys.append(F.struct(F.lit(i).alias("place"), fp.bitwiseAND(F.lit(mask - 2**64 if mask >= 2**63 else mask)).alias("value")))
    return keys


def _equal_bytes(a: Column, b: Column) -> Column:
    x = a.bitwiseXOR(b)
    return sum((F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8))


def close_pairs(distinct: DataFrame, max_list: int = LIST) -> DataFrame:
    """(a, b) between the (distinct) fingerprints in ``fp``: links that join exactly those within two bits of each other,
    directly or through others that are themselves within two bits of one another."""
    index = distinct.select("fp", F.explode(F.array(*_byte_keys(F.col("fp")))).alias("k")).select("fp", "k.place", "k.value")
    sizes = stored(index.groupBy("place", "value").agg(F.count("*").alias("n")).filter("n > 1"), "byte-lists")
    listed = stored(index.join(sizes, ["place", "value"]), "byte-index")
    short = listed.filter(F.col("n") <= max_list).groupBy("place", "value").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = short.select(F.posexplode("fps").alias("i", "a"), "fps").select("a", F.explode(F.slice("fps", F.col("i") + 2, max_list)).alias("b"))
    counted = pairs.filter(_equal_bytes(F.col("a"), F.col("b")) >= 6)
    verified = counted.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).distinct()

    many = listed.filter(F.col("n") > max_list).select("fp").distinct()
    flips = [F.lit(0)] + [F.lit(-(2**63) if i == 63 else 1 << i) for i in range(64)]
    near = many.select("fp", F.explode(F.array(*[f.cast("long") for f in flips])).alias("flip"))
    groups = near.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).agg(F.collect_set("fp").alias("fps"))  # at most 65
    stars = groups.filter(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return verified.unionByName(stars.distinct())


def _classes(prints: DataFrame, first: Column, max_list: int) -> DataFrame:
    """(fp, component): for every fingerprint the least ``first`` of the rows whose fingerprints links reach from it."""
    of_print = stored(prints.groupBy("fp").agg(F.min(first).alias("first")), "distinct-fingerprints")
    # links join fingerprints, not ids: rows without an id, or of one id, are reached each by itself
    found = stored(components(close_pairs(of_print.select("fp"), max_list)), "components")
    part = of_print.join(found, of_print["fp"] == found["id"], "left").select("fp", "first", F.coalesce("component", "fp").alias("part"))
    least = part.groupBy("part").agg(F.min("first").alias("component"))
    return stored(part.join(least, "part").select("fp", "component"), "fingerprint-classes")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_list: int = LIST) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row; fingerprints link at two differing bits or fewer.

    component_id is the smallest id that links reach, the document itself included; null ids are reached last. Rows of one id
    with different texts are linked by their texts alone.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    joined = prints.join(_classes(prints, F.col("doc"), max_list), "fp")
    real = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return joined.select(real("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), real("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_list: int = LIST) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the document with the smallest id stays.

    Rows with the same id and text are one document and stay or go together. Other rows of one id, or without one, are
    documents of their own; those without an id come last. Texts without words are copies of each other.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words, row_key(docs, id_col, text_col)), "fingerprints")
    first = F.struct("doc", "row")
    classes = _classes(prints, first, max_list)
    gone = prints.join(classes, "fp").filter(first != F.col("component")).select("row").distinct()
    return docs.join(gone, row_key(docs, id_col, text_col) == gone["row"], "left_anti")
