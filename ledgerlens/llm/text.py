"""Whole Arrow text columns as byte arrays: pieces, words and rolling hashes, without a loop per character.

All hashes are 64-bit prefix hashes ``sum(x[i] * B**i) * B**-start`` (mod 2**64), so the hash of any
range costs one subtraction and one product. Modulo a power of two, long ranges can be made to collide (a Thue-Morse word
of 1,024 letters and its complement always do), so a word of more than ``LONG_WORD`` bytes is known by a digest instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
_rng = np.random.default_rng(20_240_517)
BYTE_CODE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
#: The same, with A-Z read as a-z.
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[65:91] = BYTE_CODE[97:123]
BASE = 0x9E3779B97F4A7C15
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
PIECE = 1 << 20  # bytes handled at a time
LONG_WORD = 32
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i below n, kept for the next call."""
    if not _powers or len(_powers[0]) < n:
        m = max(n, PIECE + PIECE // 2)
        _powers[:] = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads the weak low bits."""
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


class RangeHash:
    """Hashes of ranges of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        up, self.down = powers(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def of_length(self, k: int) -> np.ndarray:
        """The hash of every range of k codes."""
        n = max(0, len(self.sums) - k)
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and the n + 1 offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    ends = np.zeros(1, np.int64)
    if len(column):
        ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


class Piece(NamedTuple):
    row: int
    start: int  # byte range in the column's bytes
    end: int
    opens: bool  # the row begins here
    closes: bool  # the row ends here


def piece_groups(offsets: np.ndarray, overlap: int = 0, size: int = PIECE) -> Iterator[list[Piece]]:
    """The rows in groups of about ``size`` bytes; a longer row is cut into pieces that overlap."""
    group: list[Piece] = []
    total = 0
    for row in range(len(offsets) - 1):
        start, end = int(offsets[row]), int(offsets[row + 1])
        at = start
        while True:
            stop = end if end - at <= size + overlap else at + size
            group.append(Piece(row, at, stop, at == start, stop == end))
            total += stop - at
            if total >= size:
                yield group
                group, total = [], 0
            if stop == end:
                break
            at = stop - overlap
    if group:
        yield group


def sliding(op: np.ufunc, a: np.ndarray, w: int) -> np.ndarray:
    """``op`` over every run of w neighbours, by doubling."""
    if len(a) < w:
        return a[:0]
    done = 1
    while done * 2 <= w:
        a = op(a[:-done], a[done:])
        done *= 2
    return op(a[: len(a) - (w - done)], a[w - done :]) if w > done else a


def minimizers(h: np.ndarray, ends: np.ndarray, k: int, window: int) -> np.ndarray:
    """Positions whose gram hash is the least of some window, for windows of ``window`` symbols within one piece.

    ``h`` are the hashes of the grams of k symbols at each position, ``ends`` the ends of the pieces in symbols.
    Equal windows get the same positions wherever they stand; equal least grams are all taken.
    """
    w = window - k + 1
    least = sliding(np.minimum, h, w)
    if not len(least):
        return np.zeros(0, np.int64)
    inside = np.ones(len(least), bool)
    for e in ends.tolist():
        inside[max(0, e - window + 1) : e] = False
    padded = np.zeros(len(least) + 2 * (w - 1), np.uint64)
    padded[w - 1 : w - 1 + len(least)] = np.where(inside, least, U(0))
    return np.flatnonzero((sliding(np.maximum, padded, w) == h) & (h != 0))


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of the bytes, where a word also ends at each of ``starts`` (row or piece starts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~WHITE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts[starts < len(data)]] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | cut[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | cut[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def joined(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of half-open ranges per row, as sorted ranges that neither meet nor overlap."""
    if not len(rows):
        return rows, start, end
    order = np.lexsort((start, rows))
    rows, start, end = rows[order], start[order], end[order]
    new_row = np.r_[True, rows[1:] != rows[:-1]]
    # ends as they grow within a row: shift each row's ends above those of the rows before it
    lift = (np.cumsum(new_row) - 1) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    first = np.r_[True, (start + lift)[1:] > reach[:-1]] | new_row
    last = np.r_[first[1:], True]
    return rows[first], start[first], (reach - lift)[last]


class Words(NamedTuple):
    first_row: int
    rows: np.ndarray  # row of each word
    start: np.ndarray  # its bytes in the column
    end: np.ndarray
    code: np.ndarray  # its hash
    bounds: np.ndarray  # words before each row of the group, and in all


def word_groups(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray = BYTE_CODE, size: int = 4 * PIECE) -> Iterator[Words]:
    """The words of the rows with their hashes, in groups of whole rows of about ``size`` bytes."""
    n = len(offsets) - 1
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        base, part = offsets[row], data[offsets[row] : offsets[stop]]
        start, end = word_bounds(part, offsets[row:stop] - base)
        code = np.empty(len(start), np.uint64)
        at = 0
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(end, start[at] + PIECE, side="right")))
            grams = RangeHash(codes[part[start[at] : end[to - 1]]])
            a, b = start[at:to] - start[at], end[at:to] - start[at]
            code[at:to] = mix(grams.of(a, b) + U(0x632BE59BD9B4E019) * (b - a).astype(np.uint64))
            at = to
        for i in np.flatnonzero(end - start > LONG_WORD).tolist():
            word = part[start[i] : end[i]].tobytes()
            code[i] = xxhash.xxh3_64_intdigest(word.lower() if codes is LOWER_CODE else word)
        bounds = np.searchsorted(start, offsets[row : stop + 1] - base)
        rows = np.repeat(np.arange(row, stop), np.diff(bounds))
        yield Words(row, rows, start + base, end + base, code, bounds)
        row = stop
