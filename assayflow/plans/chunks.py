"""Id chunking (P1): distinct ids, numbered chunks of a fixed size, one file per chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame

from assayflow import constants as K
from assayflow.operators.chunking import chunk_ids
from assayflow.sinks.files import write_chunks


def distinct_ids(df: DataFrame, id_column: str) -> DataFrame:
    return df.select(id_column).distinct()


def write_id_chunks(df: DataFrame, id_column: str, path: str, size: int = K.CHUNK_SIZE) -> None:
    write_chunks(chunk_ids(df, id_column, size), path)
