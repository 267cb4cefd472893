"""Intermediate tables and files in the folder that the driver and all executors share.

The folder is the session's ``spark.checkpoint.dir`` (see ``assayflow.session``). What is
written there survives a lost executor; callers that no longer need it remove it.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import bounded_batches, ensure_checkpoint_dir, hand_back  # noqa: F401


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used yet."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet in the shared folder and read them again: later steps start from there."""
    return staged_at(df, name)[0]


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of ours in the shared folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, parts: list[np.ndarray]) -> str:
    """Write arrays one after the other to a new file and return its address.

    Each attempt of a task writes a file of its own and only a finished attempt
    returns its address, so a repeated task does no harm."""
    filesystem, base = _filesystem(folder)
    filesystem.create_dir(base, recursive=True)
    own = f"{name}-{uuid.uuid4().hex}"
    with filesystem.open_output_stream(f"{base}/{own}") as out:
        for part in parts:
            out.write(memoryview(np.ascontiguousarray(part)).cast("B") if part.size else b"")
    return f"{folder.rstrip('/')}/{own}"


def read_file(folder: str, name: str) -> np.ndarray:
    """The bytes of a shared file; FileNotFoundError if there is none."""
    filesystem, base = _filesystem(folder)
    with filesystem.open_input_file(f"{base}/{name}") as source:
        return np.frombuffer(source.read(), np.uint8)


def publish(folder: str, name: str, parts: list[np.ndarray]) -> None:
    """Write arrays one after the other as the file ``name``, which appears when it is whole.

    The content must follow from the name, so that an attempt that finds the file there already leaves it."""
    filesystem, base = _filesystem(folder)
    own = write_file(folder, name, parts).rsplit("/", 1)[1]
    try:
        filesystem.move(f"{base}/{own}", f"{base}/{name}")
    except OSError:
        if filesystem.get_file_info(f"{base}/{name}").type.name != "File":
            raise
        filesystem.delete_file(f"{base}/{own}")


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same ``mapInArrow`` function; its worker hands freed memory back when the task ends."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            hand_back()

    return task


_local: dict[str, np.ndarray] = {}


def mapped_file(uri: str) -> np.ndarray:
    """The bytes of a shared file, memory-mapped read-only.

    A file on a mounted folder is mapped where it lies. From another store it is
    copied once for each worker to a temporary file that has no name any more, so
    its space is free again as soon as the mapping goes."""
    if uri not in _local:
        parts = urlsplit(uri)
        if parts.scheme in ("", "file"):
            path = parts.path
            if len(_local) > 4096:
                _local.clear()
            import os

            _local[uri] = np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
        else:
            import shutil
            import tempfile

            filesystem, base = _filesystem(uri)
            with tempfile.TemporaryFile() as copy, filesystem.open_input_stream(base) as source:
                shutil.copyfileobj(source, copy, 1 << 20)
                size = copy.tell()
                _local[uri] = np.memmap(copy, np.uint8, "r", shape=(size,)) if size else np.zeros(0, np.uint8)
    return _local[uri]
