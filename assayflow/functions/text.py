"""Text normalizers and keys as Column expressions.

A normalizer is any ``Column -> Column`` function. Those here are built-in
Spark string functions, so they run inside whole-stage codegen; a caller may
pass a ``pandas_udf`` instead when the normalization needs a Python library.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_space(c: Column) -> Column:
    """Whitespace runs -> one space, trimmed, lower-cased."""
    # Only what changes is matched: a single space between words is left alone.
    return F.lower(F.trim(F.regexp_replace(c, r"[\t-\r]\s*| \s+", " ")))


def drop_trailing(mark: str):
    """Normalizer that removes one trailing ``mark`` per application."""

    def step(c: Column) -> Column:
        return F.when(c.endswith(mark), F.substring(c, F.lit(1), F.length(c) - F.lit(len(mark)))).otherwise(c)

    return step


def reverse_text(c: Column) -> Column:
    return F.reverse(c)


def rotate_left(c: Column) -> Column:
    """Move the first character to the end."""
    return F.concat(F.substring(c, F.lit(2), F.length(c)), F.substring(c, F.lit(1), F.lit(1)))


def long_key(c: Column) -> Column:
    """Long identifier of a standardized text (the role of an InChI): SHA-256 hex."""
    return F.sha2(c, 256)


def short_key(c: Column) -> Column:
    """Fixed-length hashed key used for joining (the role of an InChIKey): MD5 hex."""
    return F.md5(c)
