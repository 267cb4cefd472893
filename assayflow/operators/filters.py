"""Row filters. Every predicate is a built-in Column expression, so Catalyst
pushes it into the parquet / JDBC scan where the source allows it.

Null rules follow the source workflow: ``!=``, ``not in`` and ``not contains``
drop rows whose value is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.operators.columns import col


def equals(df: DataFrame, name: str, value) -> DataFrame:
    return df.filter(col(name) == F.lit(value))


def not_equals(df: DataFrame, name: str, value) -> DataFrame:
    return df.filter(col(name) != F.lit(value))


def keep_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    return df.filter(col(name).isin(list(values)))


def exclude_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    return df.filter(~col(name).isin(list(values)))


def exclude_substrings(df: DataFrame, name: str, parts: Sequence[str]) -> DataFrame:
    """Drop rows whose value contains any of ``parts`` as a literal substring.

    ``contains`` is used, not ``LIKE``: in ``_ch1`` the underscore must not be a wildcard.
    """
    cond = None
    for part in parts:
        c = ~F.contains(col(name), F.lit(part))
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def semi_filter(df: DataFrame, ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keep rows whose key appears in ``ids`` (a left-semi join, never an IN list on the driver)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(ids.select(*keys), on=keys, how="left_semi")


#: Bits that ``prefilter`` marks keys by; 64 of them are a row of the table that every task gets (2^18 rows at most).
PREFILTER_BITS = 1 << 24


def prefilter(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key may be in ``ids``, before a join on it: no row that the join needs is lost, and few others are shuffled.

    A hash of each id marks a bit. The table of marked bits has a fixed size: the more ids,
    the more other rows pass, and it never grows past what a task can hold. Keys of two types, whose hashes differ, are not filtered."""
    if df.select(col(key)).schema[0].dataType != ids.select(col(key)).schema[0].dataType:
        return df

    def place(name: str) -> Column:
        return F.xxhash64(col(name)).bitwiseAND(F.lit(PREFILTER_BITS - 1))

    own = ids.where(col(key).isNotNull()).select(place(key).alias("__at"))
    bit = F.expr("shiftleft(1L, cast(__at & 63 as int))")
    marked = own.groupBy(F.shiftright("__at", 6).alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    at = place(key)
    hit = F.getbit(F.col("__bits"), at.bitwiseAND(F.lit(63)).cast("int")) == 1
    return df.join(F.broadcast(marked), (F.shiftright(at, 6) == F.col("__word")) & hit, "left_semi")


def at_least(df: DataFrame, name: str, threshold) -> DataFrame:
    return df.filter(col(name) >= F.lit(threshold))


def non_blank(df: DataFrame, name: str) -> DataFrame:
    """Not null and not the empty string."""
    return df.filter(col(name).isNotNull() & (col(name) != F.lit("")))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def head_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order (a bare limit would not be deterministic)."""
    return df.orderBy(*[col(c) for c in order_by]).limit(n)
