"""Column-level operators: ordered select, strict drop and rename, column
resolution, case-variant validation and unions with a dtype check.

All of these are plan-time: they inspect ``df.columns`` / ``df.schema`` (no
job) and return a new lazy DataFrame. Names are compared as Python strings, so
they are case-sensitive even though Spark resolves columns case-insensitively.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Backtick-quote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def _missing(df: DataFrame, names: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [n for n in names if n not in present]


def select_ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Select ``order`` in that order; every name must exist."""
    missing = _missing(df, order)
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")
    return df.select(*[col(n) for n in order])


def drop_strict(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop ``names``; fail if any is absent (Spark itself ignores missing names)."""
    missing = _missing(df, names)
    if missing:
        raise ValueError(f"cannot drop missing columns: {missing}; available: {df.columns}")
    return df.drop(*names)


def drop_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop whichever of ``names`` exist."""
    return df.drop(*[n for n in names if n in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; every old name must exist."""
    missing = _missing(df, mapping)
    if missing:
        raise ValueError(f"cannot rename missing columns: {missing}; available: {df.columns}")
    return df.withColumnsRenamed(mapping)


def resolve_column(df: DataFrame, candidates: Sequence[str], label: str) -> str:
    """The candidate that ``df`` has; of several, the one listed earliest."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"{label}: the table has none of the columns {', '.join(candidates)}; its columns are {', '.join(df.columns)}")


def keep_present(df: DataFrame, candidates: Sequence[str], first: str | None = None) -> list[str]:
    """Candidates that ``df`` has, in their order; ``first`` leads the list unless it is one of them."""
    present = [name for name in candidates if name in df.columns]
    return present if first is None or first in present else [first, *present]


def normalize_case_variant(df: DataFrame, canonical: str = "SMILES", variant: str = "smiles") -> DataFrame:
    """Exactly one of ``canonical`` / ``variant`` must exist; rename the variant to the canonical name."""
    present = [c for c in (canonical, variant) if c in df.columns]
    if len(present) != 1:
        raise ValueError(f"expected one of the columns {canonical!r} and {variant!r}, got {present or 'neither'}")
    # Positional rename: withColumnRenamed would resolve case-insensitively.
    return df.toDF(*[canonical if c == variant else c for c in df.columns])


def union_strict(dfs: Sequence[DataFrame]) -> DataFrame:
    """Vertical concat that requires equal column names (same order) and equal types."""
    if not dfs:
        raise ValueError("nothing to union")
    first = [(f.name, f.dataType) for f in dfs[0].schema.fields]
    for other in dfs[1:]:
        fields = [(f.name, f.dataType) for f in other.schema.fields]
        if fields != first:
            raise ValueError(f"schemas differ: {first} vs {fields}")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_aligned(dfs: Sequence[DataFrame]) -> DataFrame:
    """Vertical concat aligned by name; columns missing on one side become null."""
    if not dfs:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
