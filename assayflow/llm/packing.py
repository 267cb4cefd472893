"""Packing of tokenized documents into fixed-length sequences, shortest pack first.

A document is its ids and an end id. It is cut every ``capacity`` ids, so all pieces
but its last fill a sequence. The lengths' histogram, at most ``capacity`` numbers
whatever the corpus, goes to the driver, where the lengths are placed longest first:
each onto the shortest pack that still holds it, all equal packs at once by their
count, and into new packs if none holds it. The result are packing patterns with
counts. Pieces are joined to the patterns by their rank among the pieces of their
length. Ranks are counted within (length, hash bucket) and offset by the buckets'
sums, so a length that a third of all pieces have is ranked by many tasks.

Defined results: a null text is empty and has the end id alone; repeated rows are
packed each for itself; rows with a null id are packed like others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .chunks import cuts_at_runs, library_table
from .shared import bounded_batches, staged, tidy

CAPACITY = 4096
END_ID = 2


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document cut at multiples of the capacity."""
    cuts_at_runs(path)
    bounded_batches(docs.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for block, ids, at in library_table(path).ids(batch.column("text")):
                ids = np.insert(ids, at[1:], end_id).astype("<u4")
                at = at + np.arange(len(at))
                rows = []
                for i in range(len(block)):
                    own = ids[at[i] : at[i + 1]]
                    for start in range(0, len(own), capacity):
                        part = own[start : start + capacity]
                        rows.append((keys[block.first + i], start, len(part), zlib.crc32(part.tobytes()), len(own)))
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths, longest first) and their counts that hold each length as often as the histogram says.

    The work depends on the distinct lengths and the patterns, not on the number of pieces."""
    by_space: list[list[tuple[list[int], int]]] = [[] for _ in range(capacity + 1)]
    most = 0  # no pack has more space than this
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} with a capacity of {capacity}")
        while left:
            while most >= length and not by_space[most]:
                most -= 1
            if most >= length:
                pattern, count = by_space[most].pop()
                taken = min(left, count)
                if count > taken:
                    by_space[most].append((pattern, count - taken))
                by_space[most - length].append(([*pattern, length], taken))
                left -= taken
            else:
                each = min(left, capacity // length)
                opened = left // each
                by_space[capacity - each * length].append(([length] * each, opened))
                most = max(most, capacity - each * length)
                left -= each * opened
    return [found for packs in by_space for found in packs]


class Placement:
    """For each length, where the pieces of rank 0, 1, ... go."""

    def __init__(self, patterns: list[tuple[list[int], int]], capacity: int):
        entries = []
        first = 0
        for lengths, count in patterns:
            offset = 0
            for length in lengths:
                entries.append((length, first, count, offset))
                offset += length
            first += count
        entries.sort()
        table = np.array(entries, np.int64).reshape(-1, 4)
        self.sequence, self.offset = table[:, 1], table[:, 3]
        self.base = np.cumsum(table[:, 2]) - table[:, 2]
        self.of_length = np.searchsorted(table[:, 0], np.arange(capacity + 1))
        self.sequences = first

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank."""
        slot = self.base[self.of_length[lengths]] + ranks
        entry = np.searchsorted(self.base, slot, "right") - 1
        return self.sequence[entry] + slot - self.base[entry], self.offset[entry]


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (any rows with ``doc_id``, ``start``, ``length``; every column kept) with ``sequence_id`` and ``offset``.

    Sequences are numbered from 0 without gaps; offsets within one too. The pieces are read more than
    once: pass a stored table."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = cut.drop("sequence_id", "offset")
    if not histogram:
        return rows.withColumn("sequence_id", F.lit(None).cast("long")).withColumn("offset", F.lit(None).cast("long"))
    placement = Placement(shortest_pack_first(histogram, capacity), capacity)
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("__bucket", F.pmod(F.xxhash64(*rows.columns), buckets))
    sums = dealt.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("length", "__bucket").orderBy(*rows.columns)
    ranked = dealt.withColumn("__rank", F.row_number().over(within) - 1).join(sums, ["length", "__bucket"])
    ranked = ranked.select(*rows.columns, (F.col("__rank") + F.col("__before")).alias("__rank"))
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    @tidy
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            sequence, offset = placement.find(*(batch.column(names.index(c)).to_numpy() for c in ("length", "__rank")))
            kept = [i for i, name in enumerate(names) if name != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], pa.array(sequence), pa.array(offset)],
                [*[names[i] for i in kept], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(staged(pieces(docs, path, capacity, text=text, key=key), "pieces"), capacity)
