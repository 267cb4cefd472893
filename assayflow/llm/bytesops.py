"""Arrays over the UTF-8 bytes of an Arrow text column.

The operators that read whole texts run as ``mapInArrow`` tasks: Spark splits
the rows, and inside a task the texts of a block of documents are one byte
array. Everything here is plain numpy on such a block. A block holds whole
documents, about ``BLOCK_BYTES`` of text, so the working memory of a task does
not depend on the size of its partition (one longer text is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Word hashes: sum of table[byte] * BASE**position, modulo 2**64.
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C1B
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] | None = None


class Block:
    """Whole documents ``first`` to ``last`` (not included) of a batch: their bytes and ``len + 1`` offsets."""

    def __init__(self, first: int, last: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.last, self.data, self.offsets = first, last, data, offsets

    def __len__(self) -> int:
        return self.last - self.first

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_arrays(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ``len + 1`` offsets of a text column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's documents in order, in blocks of about ``limit`` bytes."""
    data, offsets = text_arrays(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield Block(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than ASCII white space: starts, ends, and ``len + 1`` word offsets by document.

    ``cut[i]`` (``i`` from 1) also ends a run before byte i."""
    solid = ~_SPACE[data]
    before, after = np.zeros_like(solid), np.zeros_like(solid)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    if cut is not None:
        before &= ~cut
        after[:-1] &= ~cut[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        made = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        if size > 8 * BLOCK_BYTES:  # one very long text: not kept
            return made[0], made[1]
        _powers = (made[0], made[1])
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice ``data[start:end]``, equal for equal bytes wherever they stand."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * power[: len(data)], dtype=np.uint64, out=total[1:])
    return mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of ``start, start + 1, ...`` for each slice, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def sum_by_key(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts (1 each by default)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts.astype(np.int64), first)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]`` for each i (0 for an empty slice), along axis 0."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0)
    return out
