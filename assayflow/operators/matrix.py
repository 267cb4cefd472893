"""Long -> wide operators: checked pivots and the class-balance filter.

The long form (id, label, value) is the canonical result, filtered there. A wide
matrix is made last, from a label list that the caller gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayflow import constants as K
from assayflow.operators.chunking import number_rows
from assayflow.operators.columns import col


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Eager check that ``keys`` identify rows; raises with an example key."""
    dup = df.groupBy(*[col(k) for k in keys]).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate rows for key {dict(dup[0].asDict())}")


def pivot_known(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    value: str,
    values: Sequence[str],
) -> DataFrame:
    """Pivot with a fixed list of column values; a duplicate cell fails the job.

    Written as one conditional aggregate per value (what Spark's pivot does
    inside), plus a count per cell so a second row for a cell raises an error
    in the same pass instead of being silently dropped.
    """
    aggs = []
    checks = []
    for v in values:
        hit = col(column) == F.lit(v)
        aggs.append(F.first(F.when(hit, col(value)), ignorenulls=True).alias(f"__v_{v}"))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"__n_{v}"))
        checks.append(v)
    grouped = df.groupBy(*[col(k) for k in index]).agg(*aggs)
    out = [col(k) for k in index]
    for v in checks:
        out.append(
            F.when(
                F.col(f"`__n_{v}`") > 1,
                F.raise_error(F.lit(f"pivot: more than one row for a cell of '{v}'")),
            )
            .otherwise(F.col(f"`__v_{v}`"))
            .alias(v)
        )
    return grouped.select(*out)


def balanced_labels(
    long_df: DataFrame, label: str, value: str, min_count: int = K.MIN_CLASS_COUNT
) -> DataFrame:
    """Labels with at least ``min_count`` zeros and ``min_count`` ones, with their counts."""
    return (
        long_df.groupBy(col(label))
        .agg(
            F.count_if(col(value) == 0).alias("n_zero"),
            F.count_if(col(value) == 1).alias("n_one"),
        )
        .filter((F.col("n_zero") >= min_count) & (F.col("n_one") >= min_count))
    )


def _one_value(label: str, value: str):
    """The value of a cell; a second row for it is an error."""
    twice = F.raise_error(F.lit(f"more than one row for a cell of {label}"))
    return F.when(F.count(F.lit(1)) > 1, twice).otherwise(F.first(col(value)))


def binary_rows(long_df: DataFrame, index: str, label: str, value: str, min_count: int = K.MIN_CLASS_COUNT) -> DataFrame:
    """The 0/1 matrix as rows: a (index, label, value) row for each cell of a balanced label.

    An index value without such a cell has one row with a null label, as it has an empty
    row in the wide form. Null labels are dropped; two rows for one cell are an error.
    An index value has at most one row for each label, so its rows are looked at together."""
    base = long_df.filter(col(label).isNotNull())
    kept = balanced_labels(base, label, value, min_count).select(col(label).alias("__kept"))
    cells = base.groupBy(col(index), col(label)).agg(_one_value(label, value).alias("__value"))
    cells = cells.join(kept, col(label) == F.col("__kept"), "left")
    own = Window.partitionBy(col(index))
    lone = F.count("__kept").over(own) == 0
    cells = cells.select("*", lone.alias("__lone"), F.row_number().over(own.orderBy(col(label))).alias("__at"))
    cells = cells.where(F.col("__kept").isNotNull() | F.col("__lone") & (F.col("__at") == 1))
    return cells.select(col(index), F.col("__kept").alias(label), F.when(F.col("__kept").isNotNull(), F.col("__value")).alias(value))


def binary_matrix(long_df: DataFrame, index: str, label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """Wide 0/1 matrix: one row per index value, one column for each of the given labels.

    Rows of other labels still create their index row (all nulls). A second row for a cell of a given
    label is an error."""
    base = long_df.filter(col(label).isNotNull())
    if not labels:
        return base.select(col(index)).distinct()
    return base.groupBy(col(index)).pivot(label, list(labels)).agg(_one_value(label, value))


def label_dictionary(long_df: DataFrame, label: str, value: str, min_count: int = K.MIN_CLASS_COUNT) -> DataFrame:
    """(label, label_id): the balanced labels, numbered from 0 in their order."""
    kept = balanced_labels(long_df.filter(col(label).isNotNull()), label, value, min_count).select(col(label))
    return number_rows(kept, label).select(col(label), (F.col("row_index") - 1).alias("label_id"))


def sparse_rows(long_df: DataFrame, index: str, label: str, value: str, dictionary: DataFrame) -> DataFrame:
    """The matrix without its names: for each index value ``label_ids`` (ascending) and their ``cell_values``.

    The names stay in ``dictionary`` (label, label_id), which no step collects. An index value without a cell has empty
    arrays; two rows for one cell are an error. A row is as long as the labels its index value has."""
    names = dictionary.select(col(label).alias("__label"), F.col("label_id").alias("__id"))
    base = long_df.filter(col(label).isNotNull()).select(col(index), col(label), col(value))
    cell = F.when(F.col("__id").isNotNull(), F.struct(F.col("__id").alias("id"), col(value).alias("v")))
    rows = base.join(names, col(label) == F.col("__label"), "left").groupBy(col(index)).agg(F.array_sort(F.collect_list(cell)).alias("__cells"))
    ids = F.col("__cells.id")
    twice = F.raise_error(F.lit(f"more than one row for a cell of {label}")).cast("array<bigint>")
    checked = F.when(F.size(F.array_distinct(ids)) < F.size(ids), twice).otherwise(ids)
    return rows.select(col(index), checked.alias("label_ids"), F.col("__cells.v").alias("cell_values"))


def write_wide_blocks(rows: DataFrame, dictionary: DataFrame, index: str, label: str, path: str, width: int = 1000) -> list[str]:
    """The wide matrix in Parquet tables of ``width`` labels each (``path/block=k``), from stored ``sparse_rows``.

    Only the names of one block are on the driver at a time, as its columns; each block holds every index value."""
    last = dictionary.agg(F.max("label_id")).first()[0]
    written = []
    for k in range(0, (last if last is not None else -1) // width + 1):
        block = dictionary.where((F.col("label_id") >= k * width) & (F.col("label_id") < (k + 1) * width))
        names = [r[0] for r in block.orderBy("label_id").select(col(label)).collect()]
        cells = [
            F.when(F.array_contains("label_ids", i), F.element_at("cell_values", F.array_position("label_ids", i).cast("int"))).alias(name)
            for i, name in enumerate(names, k * width)
        ]
        rows.select(col(index), *cells).write.mode("overwrite").parquet(f"{path}/block={k}")
        written.append(f"{path}/block={k}")
    return written
