"""Token n-grams of a block of texts, hashed together with numpy.

Used inside Arrow batches of ``operators.fingerprints``. The tokens of a block are laid out with one space
between them, so every n-gram is a slice of one byte array, and the MD5 rounds run over
arrays of slices: a short message costs a fraction of a call to a hash function.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Texts are taken in blocks of about so many bytes and at most so many rows; slices are hashed so many at a time.
BLOCK_BYTES, BLOCK_ROWS, LANES = 1 << 20, 1024, 1 << 13

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# MD5 (RFC 1321): the constants are those of its definition.
_SINES = (np.abs(np.sin(np.arange(1, 65))) * 2**32).astype(np.uint64).astype(np.uint32)
_SHIFTS = np.array([7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4, np.uint32)
_START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)


# What is kept and what is set of a message word of which -1 (none, nor the end mark), 0 ... 4 bytes are text.
_KEEP = np.array([0, 0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
_MARK = np.array([0, 0x80, 0x8000, 0x800000, 0x80000000, 0], np.uint32)


def _md5_block(state: list[np.ndarray], words: list[np.ndarray | None]) -> list[np.ndarray]:
    """One 64-byte block of each message, given as its 16 words (None: zero in all messages)."""
    a, b, c, d = state
    for i in range(64):
        if i < 16:
            mixed, k = d ^ (b & (c ^ d)), i
        elif i < 32:
            mixed, k = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            mixed, k = b ^ c ^ d, (3 * i + 5) % 16
        else:
            mixed, k = c ^ (b | ~d), 7 * i % 16
        mixed += a
        if words[k] is not None:
            mixed += words[k]
        mixed += _SINES[i]
        turned = mixed << _SHIFTS[i]
        mixed >>= 32 - _SHIFTS[i]
        turned |= mixed
        turned += b
        a, d, c, b = d, c, b, turned
    return [old + new for old, new in zip(state, (a, b, c, d), strict=True)]


def md5_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first 32 bits of the MD5 of each slice ``data[start:end]`` (as the number that their hex digits write)."""
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    four = padded[:-3] | padded[1:-2] << np.uint32(8) | padded[2:-1] << np.uint32(16) | padded[3:] << np.uint32(24)
    sizes = ends - starts
    order = np.argsort(sizes.astype(np.uint16) if sizes.max(initial=0) < 1 << 16 else sizes, kind="stable")
    out = np.empty(len(starts), np.uint32)
    first = 0
    while first < len(order):
        n_blocks = int(sizes[order[first]] + 8) // 64 + 1
        which = order[first : first + max(1, LANES // n_blocks)]
        size, start = sizes[which], starts[which]
        which = which[: np.searchsorted((size + 8) // 64 + 1, n_blocks, "right")]  # messages of as many blocks
        size, start = size[: len(which)], start[: len(which)]
        state = [np.full(len(which), x, np.uint32) for x in _START]
        for block in range(n_blocks):
            words: list[np.ndarray | None] = [None] * 16
            for k in range(16):
                at = 64 * block + 4 * k
                if at <= size[-1]:
                    kind = np.clip(size - at, -1, 4) + 1
                    words[k] = four[np.minimum(start + at, len(data))] & _KEEP[kind] | _MARK[kind]
            if block == n_blocks - 1:
                words[14], words[15] = (size << 3).astype(np.uint32), (size >> 29).astype(np.uint32)
            state = _md5_block(state, words)
        out[which] = state[0].byteswap()
        first += len(which)
    return out


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with one space for each run of white space, the tokens' starts and ends there, and their texts."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    after_solid = np.concatenate([[False], solid[:-1]])
    first = solid & (~after_solid | edge[:-1])
    last = solid & (~np.concatenate([solid[1:], [False]]) | edge[1:])
    kept = solid | after_solid  # a space stands for the run that it begins
    place = np.cumsum(kept) - 1
    at = np.flatnonzero(first)
    text = np.searchsorted(offsets, at, "right") - 1
    return np.where(solid, data, 0x20)[kept].astype(np.uint8), place[at], place[np.flatnonzero(last)] + 1, text


def _block_bits(data: np.ndarray, offsets: np.ndarray, radius: int, n_bits: int) -> np.ndarray:
    """One row of ``n_bits`` flags for each text."""
    flags = np.zeros((len(offsets) - 1, n_bits), bool)
    data, starts, ends, text = _tokens(data, offsets)
    for n in range(min(radius + 1, len(starts))):
        within = text[: len(text) - n] == text[n:]
        bits = (md5_prefixes(data, starts[: len(starts) - n][within], ends[n:][within]) >> 4) % np.uint32(n_bits)
        flags[text[n:][within], bits] = True
    return flags


def text_bits(texts: pa.Array, radius: int, n_bits: int) -> pa.Array:
    """The sorted distinct bits of each text, as lists of 32-bit integers."""
    column = texts.fill_null("").cast(pa.large_binary())
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    values, counts, first = [], [], 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), first + BLOCK_ROWS, len(column))
        flags = _block_bits(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], radius, n_bits)
        rows, bits = np.nonzero(flags)
        values.append(bits.astype(np.int32))
        counts.append(np.bincount(rows, minlength=last - first))
        first = last
    ends = np.cumsum(np.concatenate([[0], *counts])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *values])))
