"""Drop or choose rows of a stored table without a shuffle of its columns.

A row is known by its file and its place in it. The places to drop (or choose) are gathered for
each ``RANGE`` rows of a file as a sorted list in the shared folder, whose name follows from the file's name and
the range; the tasks that read these rows look for it there and map it. The lists hold a number for each such row,
a task needs only those of its own rows, and nothing but the number of places goes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from .shared import bounded_batches, mapped_file, publish, scratch, staged, tidy

PLACE = ["__file", "__row"]
RANGE = 1 << 20


def placed(docs: DataFrame) -> DataFrame:
    """The rows with their file and row number; rows that come from no Parquet file are stored first."""
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return staged(docs, "rows").select("*", *place)


def without(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """The placed rows but the rejected ones (any frame with the two place columns), without the place columns."""
    return _listed(rows, rejected, False)


def only(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The placed rows that are chosen (any frame with the two place columns), without the place columns."""
    return _listed(rows, chosen, True)


def _listed(rows: DataFrame, places: DataFrame, wanted: bool) -> DataFrame:
    bounded_batches(rows.sparkSession)
    folder = scratch(rows.sparkSession, "places")
    span = RANGE

    def name(file: str, part: int) -> str:
        return f"{hashlib.sha1(file.encode()).hexdigest()}-{part}"

    def write(key, table):
        listed = np.sort(table.column("__row").to_numpy())
        publish(folder, name(key[0].as_py(), key[1].as_py()), [listed])
        return pa.table({"n": [len(listed)]})

    parts = places.select(*PLACE, F.floor(F.col("__row") / span).alias("part")).groupBy("__file", "part")
    parts.applyInArrow(write, "n long").agg(F.sum("n")).collect()  # writes the lists

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("__file").dictionary_encode()
            places, number = batch.column("__row").to_numpy(), files.indices.to_numpy()
            found = np.zeros(batch.num_rows, bool)
            for i, file in enumerate(files.dictionary.to_pylist()):
                own = np.flatnonzero(number == i)
                for part in np.unique(places[own] // span).tolist():
                    try:
                        listed = mapped_file(f"{folder}/{name(file, part)}").view(np.int64)
                    except FileNotFoundError:  # no place of this range is listed
                        continue
                    at = np.searchsorted(listed, places[own])
                    at[at == len(listed)] = 0
                    found[own] |= listed[at] == places[own]
            kept = found == wanted
            names = [n for n in batch.schema.names if n not in PLACE]
            whole = batch.select(names)
            for first in range(0, batch.num_rows, 512):  # small copies
                yield whole.slice(first, 512).filter(pa.array(kept[first : first + 512]))

    return rows.mapInArrow(keep, rows.drop(*PLACE).schema)
