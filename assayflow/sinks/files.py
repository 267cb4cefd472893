"""File sinks. Every write runs on the executors, one file per task; nothing
is collected to the driver. Output folders are overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

FORMATS = ("parquet", "csv", "both")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    if any(isinstance(f.dataType, ArrayType) for f in df.schema.fields):
        raise ValueError("CSV cannot hold array columns; widen them first")
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def save_table(df: DataFrame, stem: str, fmt: str = "parquet") -> list[str]:
    """Write ``stem.parquet`` and/or ``stem.csv`` folders; returns the paths written."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    written = []
    if fmt in ("parquet", "both"):
        write_parquet(df, f"{stem}.parquet")
        written.append(f"{stem}.parquet")
    if fmt in ("csv", "both"):
        write_csv(df, f"{stem}.csv")
        written.append(f"{stem}.csv")
    return written


def write_if_any(df: DataFrame, path: str, counted: Observation | None = None) -> bool:
    """Write a side output (e.g. rejected rows) only when it has rows; ``counted`` gets how many (``rows``)."""
    if df.isEmpty():
        return False
    write_csv(df if counted is None else df.observe(counted, F.count(F.lit(1)).alias("rows")), path)
    return True


def by_chunk(df: DataFrame, chunk_column: str = "chunk") -> DataFrame:
    """The rows with chunk n in partition n - 1, each partition sorted: one task for each chunk, and none idle.

    Chunks are numbered from 1 without gaps, so the last number is how many partitions there are."""
    last = df.agg(F.max(F.col(chunk_column))).first()[0]
    others = [c for c in df.columns if c != chunk_column]
    placed = df.repartitionById(max(1, int(last or 1)), (F.col(chunk_column) - 1).cast("int"))
    return placed.sortWithinPartitions(chunk_column, *others)


def write_chunks(df: DataFrame, path: str, chunk_column: str = "chunk") -> None:
    """One CSV file per chunk, under ``path/<chunk_column>=<n>/``."""
    by_chunk(df, chunk_column).write.mode("overwrite").option("header", True).partitionBy(chunk_column).csv(path)
