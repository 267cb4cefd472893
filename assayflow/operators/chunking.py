"""Exact, numbered chunks of a sorted id list, without a global window.

A ``row_number()`` over the whole table would pull every row into one task.
Instead the ids are range-partitioned and sorted once and written to the
shared checkpoint folder; a row's position inside its partition comes from
``monotonically_increasing_id`` (partition index in the upper bits, position
in the lower 33 bits), the per-partition row counts (one row per partition)
give each partition's offset, and offset + position is the global 1-based
index. Offsets and rows both read the written rows: range bounds are sampled,
so a second evaluation could place a row elsewhere. Each chunk
(``(index - 1) div size + 1``) has exactly ``size`` rows except the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayflow import constants as K
from assayflow.operators.columns import col
from assayflow.session import cut_lineage

_LOW_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, order: str, partitions: int | None = None) -> DataFrame:
    """Add ``row_index`` (1-based, in ``order`` ascending, nulls first) without a single-task window."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, col(order).asc_nulls_first()).sortWithinPartitions(col(order).asc_nulls_first())
    mid = F.monotonically_increasing_id()
    placed = ranged.select("*", F.shiftright(mid, 33).alias("__part"), (mid.bitwiseAND(F.lit(_LOW_BITS)) + 1).alias("__pos"))
    placed = cut_lineage(placed)
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__part",
        (F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    ).fillna(0, subset=["__off"])
    # ``offsets`` has one row per partition: broadcasting it is bounded by the partition count.
    out = placed.join(F.broadcast(offsets), "__part").withColumn("row_index", F.col("__off") + F.col("__pos"))
    return out.drop("__part", "__pos", "__off")


def chunk_ids(df: DataFrame, id_column: str, size: int = K.CHUNK_SIZE, partitions: int | None = None) -> DataFrame:
    """Distinct ids with a 1-based ``chunk`` number, ``size`` ids per chunk in id order."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    ids = df.select(col(id_column)).distinct()
    numbered = number_rows(ids, id_column, partitions)
    return numbered.select(col(id_column), (F.expr(f"(row_index - 1) div {int(size)}") + 1).alias("chunk"))
