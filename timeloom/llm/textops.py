"""Vectorised word and shingle hashing over Arrow string columns.

A word is a maximal run of bytes other than space and \\x09-\\x0D. All hashes
are 64-bit polynomial hashes computed with prefix sums, so a k-word window
costs the same for every k; each is finalised by a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BYTE_BASE, _WORD_BASE, _WORD_BASE_2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64)
_FOLDED_VALUES = _BYTE_VALUES.copy()
_FOLDED_VALUES[65:91] = _BYTE_VALUES[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Texts are hashed in groups of about so many bytes, which bounds a worker's memory.
GROUP_BYTES = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16, 2 * len(have[0]) if have else 0)
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, _U(b))
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _powers[base] = have = tuple(tables)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> _U(31))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(29)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(32)
    return x


def _prefix(values: np.ndarray) -> np.ndarray:
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values, out=out[1:])
    return out


@dataclass
class WordBlock:
    """The words of consecutive rows: rows[i] has hashes[bounds[i]:bounds[i + 1]]."""

    first_row: int
    bounds: np.ndarray
    hashes: np.ndarray
    begins: np.ndarray  # of each word, a byte position in the column's data
    ends: np.ndarray

    @property
    def n_rows(self) -> int:
        return len(self.bounds) - 1

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.bounds))


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offs


def _hash_span(data: np.ndarray, lo: int, hi: int, cuts: np.ndarray, values: np.ndarray):
    """Words of data[lo:hi]; cuts: positions where a word must end; values: of each byte."""
    part = data[lo:hi]
    space = _IS_SPACE[part]
    edge = np.zeros(len(part) + 1, bool)
    edge[cuts - lo] = True
    edge[0] = edge[-1] = True
    word = ~space
    before = np.empty(len(part), bool)
    before[:1] = True
    before[1:] = space[:-1]
    begins = np.flatnonzero(word & (before | edge[:-1]))
    after = np.empty(len(part), bool)
    after[-1:] = True
    after[:-1] = space[1:]
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    power, inverse = _power_tables(_BYTE_BASE, len(part) + 1)
    sums = _prefix(values[part] * power[: len(part)])
    hashes = mix((sums[ends] - sums[begins]) * inverse[begins])
    return hashes, begins + lo, ends + lo


def word_blocks(column: pa.Array, group_bytes: int = GROUP_BYTES, fold: bool = False) -> Iterator[WordBlock]:
    """Blocks of rows in order; a text longer than group_bytes is a block of its own. fold: A-Z count as a-z."""
    values = _FOLDED_VALUES if fold else _BYTE_VALUES
    data, offs = string_parts(column)
    n, row = len(offs) - 1, 0
    while row < n:
        last = int(np.searchsorted(offs, offs[row] + group_bytes, "right")) - 1
        last = min(max(last, row + 1), n)
        lo, hi = int(offs[row]), int(offs[last])
        if hi - lo <= group_bytes:
            parts = [_hash_span(data, lo, hi, offs[row : last + 1], values)] if hi > lo else []
        else:
            parts = []
            while lo < hi:  # one long text, cut where white space stands
                cut = min(lo + group_bytes, hi)
                if cut < hi:
                    gaps = np.flatnonzero(_IS_SPACE[data[lo:cut]])
                    if len(gaps):
                        cut = lo + int(gaps[-1]) + 1
                    else:
                        size = group_bytes
                        while cut < hi and not _IS_SPACE[data[cut]]:
                            more = np.flatnonzero(_IS_SPACE[data[cut : cut + size]])
                            cut = min(cut + (int(more[0]) if len(more) else size), hi)
                parts.append(_hash_span(data, lo, cut, np.empty(0, np.int64), values))
                lo = cut
        if len(parts) == 1:
            hashes, begins, ends = parts[0]
        elif parts:
            hashes, begins, ends = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            hashes, begins, ends = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        bounds = np.searchsorted(begins, offs[row : last + 1], "left")
        yield WordBlock(row, bounds, hashes, begins, ends)
        row = last


def window_hashes(hashes: np.ndarray, k: int, second: bool = False) -> np.ndarray:
    """A hash for each run of k consecutive words, rows' borders ignored."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    power, inverse = _power_tables(_WORD_BASE_2 if second else _WORD_BASE, n + 1)
    sums = _prefix(hashes * power[:n])
    return mix((sums[k:] - sums[:-k]) * inverse[: n - k + 1])


def range_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of hashes[begin:end] for each pair, of another kind than window_hashes."""
    power, inverse = _power_tables(_WORD_BASE_2, len(hashes) + 1)
    sums = _prefix(hashes * power[: len(hashes)])
    return mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def whole_windows(bounds: np.ndarray, k: int, n_words: int) -> np.ndarray:
    """For each of the n_words - k + 1 windows: does it lie in one row?"""
    if n_words < k:
        return np.empty(0, bool)
    inside = np.zeros(n_words + 1, np.int64)
    sizes = np.diff(bounds)
    full = sizes >= k
    np.add.at(inside, bounds[:-1][full], 1)
    np.add.at(inside, bounds[1:][full] - k + 1, -1)
    return np.cumsum(inside)[: n_words - k + 1] > 0


def sliding(values: np.ndarray, w: int, pick=np.minimum) -> np.ndarray:
    """pick over each run of w values, by doubling."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    out, span = values, 1
    while 2 * span <= w:
        out = pick(out[: len(out) - span], out[span:])
        span *= 2
    return pick(out[:n], out[w - span : w - span + n])


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by keys, with the borders of their groups."""
    held: list[pa.RecordBatch] = []

    def ready(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for c in keys:
            k = rows.column(c).to_numpy()
            new[1:] |= k[1:] != k[:-1]
        return rows, np.append(np.flatnonzero(new), rows.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in keys):
            yield ready(held)
            held = []
        last = np.ones(batch.num_rows, bool)
        for c in keys:
            k = batch.column(c).to_numpy(zero_copy_only=False)
            last &= k == k[-1]
        others = np.flatnonzero(~last)
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield ready([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield ready(held)
