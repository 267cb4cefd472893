"""Hashed bit vectors of a text column.

Features are the whitespace tokens of the text and their n-grams up to
``radius + 1`` tokens (the text analogue of atom environments up to a radius).
Each feature is hashed to a bit: the first 7 hex digits of its MD5, modulo
``n_bits``. The job is a pure map over the input: no shuffle, and a long text
costs time linear in its length. Hashing a few bytes at a time is what it costs,
so the features of a block of texts are hashed together, as Arrow batches
(``operators.hashing``); texts are never taken apart row by row.

Forms: ``on_bits`` (sorted distinct bit indices, the compact canonical form),
``packed`` (``ceil(n_bits/64)`` longs), ``dense`` (array of 0/1 bytes) and
``widen`` (one ``morgan_<i>`` column per bit, for CSV and for parity with a
wide table).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow import constants as K
from assayflow.operators import hashing


def on_bits(c: Column, radius: int = K.FINGERPRINT_RADIUS, n_bits: int = K.FINGERPRINT_BITS) -> Column:
    """Sorted distinct set bits of the text; empty for a null text or one without tokens."""

    @F.arrow_udf("array<int>")
    def bits(texts: pa.Array) -> pa.Array:
        return hashing.text_bits(texts, radius, n_bits)

    return bits(c)


def is_valid(c: Column) -> Column:
    """A text is usable when it has at least one token."""
    return F.coalesce(F.rlike(c, F.lit(r"\S")), F.lit(False))


def _scattered(bits: pa.Array, n_bits: int) -> np.ndarray:
    """One row of ``n_bits`` flags for each list of bit numbers."""
    flags = np.zeros((len(bits), n_bits), bool)
    lengths = np.diff(bits.offsets.to_numpy())
    flags[np.repeat(np.arange(len(bits)), lengths), bits.flatten().to_numpy()] = True
    return flags


def _lists(values: np.ndarray, rows: int) -> pa.Array:
    width = values.size // rows if rows else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.ravel()))


def packed(bits: Column, n_bits: int = K.FINGERPRINT_BITS) -> Column:
    """Set bits packed into ``ceil(n_bits/64)`` longs (bit k in word k div 64, position k mod 64)."""
    words = (n_bits + 63) // 64

    @F.arrow_udf("array<bigint>")
    def pack(lists: pa.Array) -> pa.Array:
        flags = _scattered(lists, 64 * words)
        return _lists(np.packbits(flags, axis=1, bitorder="little").view("<i8"), len(lists))

    return pack(bits)


def dense(bits: Column, n_bits: int = K.FINGERPRINT_BITS) -> Column:
    """0/1 byte per bit position."""

    @F.arrow_udf("array<tinyint>")
    def unpack(lists: pa.Array) -> pa.Array:
        return _lists(_scattered(lists, n_bits).view(np.int8), len(lists))

    return unpack(bits)


def bitstring(vector: Column) -> Column:
    """The dense vector as a string of ``0``/``1`` characters."""

    @F.arrow_udf("string")
    def joined(lists: pa.Array) -> pa.Array:
        digits = lists.flatten().to_numpy().astype(np.uint8) + ord("0")
        offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).astype(np.int32)
        return pa.StringArray.from_buffers(len(lists), pa.py_buffer(offsets), pa.py_buffer(digits))

    return joined(vector)


def widen(df: DataFrame, vector: str, n_bits: int = K.FINGERPRINT_BITS, prefix: str = "morgan_") -> DataFrame:
    """Replace an array column by ``n_bits`` scalar columns ``prefix0 .. prefix{n-1}``."""
    others = [F.col(f"`{c}`") for c in df.columns if c != vector]
    bits = [F.col(vector)[i].alias(f"{prefix}{i}") for i in range(n_bits)]
    return df.select(*others, *bits)
