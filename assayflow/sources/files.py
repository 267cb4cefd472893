"""File sources: CSV / TSV (plain or gzip), one file or many, or a DataFrame
passed through.

Spark reads every file in parallel splits on the executors (gzip files are one
split each); nothing is read on the driver. Schemas are given explicitly where
the caller knows them; inference is the fallback for ad-hoc inputs.

Differences from a pandas reader, kept on purpose:

* a comment character drops lines that *start* with it; pandas would also
  cut a value at a ``!`` in the middle of a line;
* the text ``NA`` stays a string; only empty fields are null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from pathlib import PurePath
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assayflow import constants as K


def delimiter_for(path: str) -> str:
    """``,`` for .csv / .csv.gz; tab for .tsv / .txt (optionally .gz); anything else is an error."""
    suffixes = "".join(PurePath(path).suffixes[-2:]).lower()
    last = PurePath(path).suffix.lower()
    for candidate in (suffixes, last):
        if candidate in K.COMMA_SUFFIXES:
            return ","
        if candidate in K.TAB_SUFFIXES:
            return "\t"
    raise ValueError(f"{path}: no delimiter is known for this suffix")


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | None = None,
    comment: str | None = None,
    sep: str | None = None,
    sampling_ratio: float = 1.0,
    multi_line: bool = False,
) -> DataFrame:
    """Read one or more delimited files with a header line each, columns by name.

    Files with the same header are one scan. Files may order their columns differently; a column of the schema (or of the first
    file) that a file lacks is null there. The delimiter comes from each file's suffix
    unless ``sep`` is given. Without a schema, types are inferred from a full pass
    (``samplingRatio=1``). Quoted line breaks need ``multi_line``, which makes a file
    one task; without it large files are split."""
    files = [paths] if isinstance(paths, str) else list(paths)
    if not files:
        raise ValueError("no input files")
    options = {"header": True, "escape": '"', "mode": "FAILFAST", "multiLine": multi_line}
    if comment:
        options["comment"] = comment

    def one(names: list[str], mark: str, group: list[str]) -> DataFrame:
        own = options | {"sep": mark}
        if schema is None:
            return spark.read.options(**own, inferSchema=True, samplingRatio=sampling_ratio).csv(group)
        # The header's names are typed by the schema's fields of these names.
        known = {f.name: f for f in schema.fields}
        ordered = StructType([known.get(c, StructField(c, StringType())) for c in names])
        found = spark.read.options(**own, enforceSchema=False).schema(ordered).csv(group)
        return found.select(*[F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    groups = header_groups(spark, files, options, sep)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(list(n), m, g) for (n, m), g in groups.items()])


def header_groups(spark: SparkSession, files: Sequence[str], options: dict, sep: str | None = None) -> dict[tuple, list[str]]:
    """The files of each (column names, delimiter), in the order in which these first occur.

    Two jobs for each delimiter, whatever the number of files: one finds the first line that is no comment
    of each file (a row a file comes back, and no other line leaves its task), and these lines are parsed
    by the reader that will read the files."""
    groups: dict[tuple, list[str]] = {}
    by_mark: dict[str, list[str]] = {}
    for path in files:
        by_mark.setdefault(sep or delimiter_for(path), []).append(path)
    for mark, group in by_mark.items():
        if len(group) == 1:
            names = spark.read.options(**(options | {"sep": mark})).csv(group[0]).columns
            groups.setdefault((tuple(names), mark), []).append(group[0])
            continue
        headers = first_lines(spark, group, options.get("comment"))
        parsed: dict[str, tuple] = {}
        for path in group:
            line = headers.get(_place(path))
            if line is None:  # a folder, a pattern or a file without a header: its own group
                names = tuple(spark.read.options(**(options | {"sep": mark})).csv(path).columns)
            elif line in parsed:
                names = parsed[line]
            else:
                one = spark.createDataFrame([(line,)], "value string").select("value")
                names = parsed[line] = tuple(_columns(one, options | {"sep": mark}))
            groups.setdefault((names, mark), []).append(path)
    return groups


def _columns(line: DataFrame, options: dict) -> list[str]:
    return line.sparkSession.read.options(**options).csv(line.rdd.map(lambda r: r.value)).columns


def _place(path: str) -> str:
    """A path without its scheme, as files are told apart."""
    return re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?(?=/)", "", path)


def first_lines(spark: SparkSession, files: Sequence[str], comment: str | None = None) -> dict[str, str]:
    """The first line of each file that is neither blank nor a comment, by the path without its scheme."""
    lines = spark.read.text(list(files)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    if comment:
        lines = lines.where(~F.startswith("value", F.lit(comment)))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            paths, starts, values = (batch.column(i).to_pylist() for i in range(3))
            rows = []
            for path, start, value in zip(paths, starts, values, strict=True):
                if (path, start) not in seen and value.strip():
                    seen.add((path, start))
                    rows.append((path, start, value))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
                ["path", "start", "value"],
            )

    first = lines.mapInArrow(heads, "path string, start long, value string").groupBy("path").agg(F.min_by("value", "start").alias("line"))
    return {_place(unquote(r.path)): r.line for r in first.collect()}


def read_aligned(spark: SparkSession, paths: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Read files whose headers may differ and stack them by column name (missing columns null)."""
    return read_delimited(spark, paths, schema)


def read_table(
    spark: SparkSession,
    source: str | DataFrame,
    schema: StructType | None = None,
    comment: str | None = K.COMMENT_CHAR,
) -> DataFrame:
    """A path (CSV / TSV / gzip) or a DataFrame; any other type is rejected."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, (str, PurePath)):
        return read_delimited(spark, str(source), schema, comment=comment)
    raise ValueError(f"expected a path or a DataFrame, got {type(source).__name__}")


def require_nonempty(df: DataFrame) -> DataFrame:
    """Fail when ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise ValueError("the table has no rows")
    return df
