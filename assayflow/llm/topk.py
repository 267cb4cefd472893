"""Exact top-k inner products by vector-approximation files.

Vectors are whole numbers: floor(scale * x) of every component. Every row is written once, in blocks, to two kinds of
files in the shared folder: the cells (one byte for each component, on a grid between the block's least and largest
value) and the exact vectors. The queries' vectors are files of the same folder. A task takes a block of rows where it
lies, maps its cells and scans them for each block of queries: a cell's edges bound every score from
below and above. Exact vectors are read from their file only as far as needed, in the order of their upper
bounds, until the next bound is below the k-th score found, so the block's k best are certain. What is
shuffled are the k best of each query and block; nothing goes through the driver.

The work is queries times rows, as stated; nothing is left out.

Defined results: a row whose vector is null or has a null or non-finite component, or whose id is null, takes no part;
every other row is a candidate, and a query if its id is divisible by ``every``, also if it repeats
another's id or vector (each query row has its own k results). Only vectors of equal length are compared (empty ones have
score 0 with each other); only the query's own row is left out. Ties go to the smaller id; with fewer than k
candidates all are returned. Scores beyond 64 bits are cut to that range. Other columns may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import _filesystem, mapped_file, scratch, staged, staged_at

BLOCK = 4096
QUERY_BLOCK = 512
STEP = 64
_FAR = 1 << 53


def usable(vector: str) -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))


_BLOCK_COLUMNS = [("dim", pa.int32()), ("n", pa.int64()), ("cells", pa.string()), ("cells_at", pa.int64()), ("vectors", pa.string()), ("vectors_at", pa.int64())]
_BLOCK_SCHEMA = "dim int, n long, cells string, cells_at long, vectors string, vectors_at long"


class _File:
    """A new file of this task attempt in the shared folder, written from front to back."""

    def __init__(self, folder: str, name: str):
        filesystem, base = _filesystem(folder)
        filesystem.create_dir(base, recursive=True)
        own = f"{name}-{uuid.uuid4().hex}"
        self.uri, self.size, self.out = f"{folder.rstrip('/')}/{own}", 0, filesystem.open_output_stream(f"{base}/{own}")

    def write(self, *arrays: np.ndarray) -> int:
        """Append the arrays, each padded to 8 bytes; returns where the first begins."""
        at = self.size
        for array in arrays:
            raw = np.ascontiguousarray(array).tobytes()
            raw += bytes(-len(raw) % 8)
            self.out.write(raw)
            self.size += len(raw)
        return at


def _write_blocks(rows: DataFrame, size: int, folder: str) -> DataFrame:
    """Write rows (row, id, v) as blocks of ``size`` rows of one length; a row of the result says where a block lies.

    In the cells' file: row numbers, ids, least values, steps, cells; in the vectors' file: the vectors. Rows of
    equal length are gathered for each batch, so memory follows the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells_file = vectors_file = None
        for batch in batches:
            row, ids, lists = batch.column("row").to_numpy(), batch.column("id").to_numpy(), batch.column("v")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            dims = np.diff(at)
            made = []
            for dim in np.unique(dims).tolist():
                whole = np.flatnonzero(dims == dim)
                for first in range(0, len(whole), size):
                    own = whole[first : first + size]
                    values = flat[at[own][:, None] + np.arange(dim)].reshape(len(own), dim)
                    low = values.min(axis=0)
                    spread = values.max(axis=0).astype(np.float64) - low
                    step = np.maximum(1, np.ceil((spread + 1) / 256)).astype(np.int64)
                    cells = ((values - low) // step).clip(0, 255).astype(np.uint8)
                    if cells_file is None:
                        cells_file, vectors_file = _File(folder, "cells"), _File(folder, "vectors")
                    cells_at = cells_file.write(row[own], ids[own], low, step, cells)
                    made.append((dim, len(own), cells_file.uri, cells_at, vectors_file.uri, vectors_file.write(values)))
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, (_, t) in enumerate(_BLOCK_COLUMNS)], [c for c, _ in _BLOCK_COLUMNS])
        for file in (cells_file, vectors_file):
            if file is not None:
                file.out.close()

    return rows.mapInArrow(run, _BLOCK_SCHEMA)


class _Block:
    """A written block: its small parts, and the vectors as a mapping of their file."""

    def __init__(self, dim: int, n: int, cells: str, cells_at: int, vectors: str, vectors_at: int):
        raw, at = mapped_file(cells), cells_at
        parts = []
        for length in (n, n, dim, dim):
            parts.append(raw[at : at + 8 * length].view(np.int64))
            at += 8 * length
        self.rows, self.ids, self.low, self.step = parts
        self.cells = raw[at : at + n * dim].reshape(n, dim)
        self.vectors = mapped_file(vectors)[vectors_at : vectors_at + 8 * n * dim].view(np.int64).reshape(n, dim)

    def largest(self) -> float:
        """No component is larger, by the grid alone."""
        low, step = self.low.astype(np.float64), self.step.astype(np.float64)
        return float(np.maximum(np.abs(low), np.abs(low + 256 * step)).max(initial=0))


def best_of_block(asking: _Block, block: _Block, k: int) -> tuple[np.ndarray, ...]:
    """(query row, query id, row, id, score) of the k best of the block for each query; only a query's own row is left out."""
    queries = np.asarray(asking.vectors)
    dim = queries.shape[1]
    largest = float(np.abs(queries.astype(np.float64)).max(initial=0)) * block.largest() * max(1, dim)
    slack = 0.0 if largest < _FAR else largest * 2.0**-40
    edges = block.low.astype(np.float64) + block.cells.astype(np.float64) * block.step
    wide = block.step.astype(np.float64) - 1
    asked = queries.astype(np.float64)
    base = asked @ edges.T
    lower = base + (np.minimum(asked, 0) @ wide)[:, None] - slack
    upper = base + (np.maximum(asked, 0) @ wide)[:, None] + slack
    exact_type = np.int64 if largest < 2.0**62 else object
    rows, ids = np.asarray(block.rows), np.asarray(block.ids)
    found = []
    for q in range(len(queries)):
        others = np.flatnonzero(rows != asking.rows[q])
        if not len(others):
            continue
        bound = upper[q, others]
        if len(others) > k:
            certain = np.partition(lower[q, others], len(others) - k)[len(others) - k]
            keep = bound >= certain
            others, bound = others[keep], bound[keep]
        order = others[np.argsort(-bound, kind="stable")]
        bound = upper[q, order]
        own = queries[q].astype(exact_type)
        seen, scores = order[:0], np.zeros(0, exact_type)
        for first in range(0, len(order), STEP):
            if len(scores) >= k and bound[first] < scores[k - 1]:
                break
            part = order[first : first + STEP]
            exact = block.vectors[part].astype(exact_type) @ own if dim else np.zeros(len(part), exact_type)
            scores, seen = np.concatenate([scores, exact]), np.concatenate([seen, part])
            if exact_type is np.int64:
                rank = np.lexsort((rows[seen], ids[seen], -scores))[:k]
            else:
                rank = np.array(sorted(range(len(seen)), key=lambda i: (-scores[i], ids[seen[i]], rows[seen[i]]))[:k])
            seen, scores = seen[rank], scores[rank]
        limit = (1 << 63) - 1
        final = scores if exact_type is np.int64 else np.array([max(-limit - 1, min(limit, x)) for x in scores], np.int64)
        n = len(seen)
        found.append((np.full(n, asking.rows[q]), np.full(n, asking.ids[q]), rows[seen], ids[seen], final))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate([empty, *[x[i] for x in found]]).astype(np.int64) for i in range(5))


def top_k(vectors: DataFrame, k: int = 10, scale: int = 1024, every: int = 100, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    folder = scratch(spark, "approximations")
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(usable(vector) & F.col(key).isNotNull())
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), whole.alias("v"))
    rows = staged(rows, "vectors")
    blocks = staged(_write_blocks(rows, BLOCK, folder), "blocks")
    asking = _write_blocks(rows.where(F.col("id") % every == 0).repartition(slices, "row"), QUERY_BLOCK, folder)
    _, listed = staged_at(asking, "queries")  # where each 512 queries lie: a table in the shared folder, read by the tasks
    names = ["query_row", "query_id", "row", "vec_id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet

        filesystem, base = _filesystem(listed)
        table = parquet.read_table(base, filesystem=filesystem, columns=[c for c, _ in _BLOCK_COLUMNS])
        queries = list(zip(*(table.column(c).to_pylist() for c, _ in _BLOCK_COLUMNS), strict=True))
        for batch in batches:
            for place in zip(*(batch.column(c).to_pylist() for c, _ in _BLOCK_COLUMNS), strict=True):
                block = _Block(*place)
                for query in queries:
                    if query[0] == place[0]:
                        best = best_of_block(_Block(*query), block, k)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], names)

    offered = blocks.repartition(slices, "cells", "cells_at")
    best = offered.mapInArrow(search, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
