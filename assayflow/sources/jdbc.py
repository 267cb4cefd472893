"""Database tables over JDBC.

Each table is read by the executors in ``num_partitions`` parallel range
queries on a numeric id column, so no row passes through the driver.
Projections and literal filters written on the returned DataFrame are pushed
into the database query by Spark (``PushedFilters`` / pruned ``ReadSchema``).
An id list from another table is applied as a ``left_semi`` join, never as a
giant ``IN`` literal.

The connection (URL, user, password, driver class) is the caller's: pass it in
``options``; nothing is read from the environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayflow.plans.screening import ScreeningInputs

# Partition column of each assay-database table (its numeric id).
PARTITION_COLUMNS = {
    "assay": "aid",
    "assay_component": "acid",
    "assay_component_endpoint": "aeid",
    "mc4": "m4id",
    "mc5": "m5id",
    "mc5_param": "m5id",
    "sample": "chid",
    "chemical": "chid",
}


def read_jdbc(
    spark: SparkSession,
    table: str,
    options: dict[str, str],
    partition_column: str | None = None,
    num_partitions: int = 64,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """Read ``table``; split into ``num_partitions`` range queries on ``partition_column``.

    ``bounds`` (min, max of the column) only shape the ranges; rows outside
    them are still read, by the first and last partitions.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        if bounds is None:
            bounds = column_bounds(spark, table, partition_column, options)
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1] + 1))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def column_bounds(spark: SparkSession, table: str, column: str, options: dict[str, str]) -> tuple[int, int]:
    """Min and max of a numeric column, computed by the database (one small query)."""
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    row = spark.read.format("jdbc").options(**options).option("dbtable", q).load().first()
    return int(row["lo"] or 0), int(row["hi"] or 0)


def screening_inputs(
    spark: SparkSession, options: dict[str, str], num_partitions: int = 64
) -> ScreeningInputs:
    """The assay-database tables, each partitioned on its id."""

    def t(name: str) -> DataFrame:
        return read_jdbc(spark, name, options, PARTITION_COLUMNS.get(name), num_partitions)

    return ScreeningInputs(
        assay=t("assay"),
        assay_component=t("assay_component"),
        assay_component_endpoint=t("assay_component_endpoint"),
        mc4=t("mc4"),
        sample=t("sample"),
        mc5=t("mc5"),
        mc5_param=t("mc5_param"),
        chemical=t("chemical"),
    )
