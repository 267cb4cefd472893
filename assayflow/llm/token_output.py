"""Token ids in training order, as fixed-stride binary shards.

The documents of a scan split, in row order, are one stream of ids with an end id
behind each; it is cut into sequences of ``length`` ids (the last one of a split is
padded). Texts are encoded once: the sequences are stored compressed in the shared folder with their number
within the split, and counting the stored rows gives every sequence a number without gaps. A split is
known by a hash of its file and place in it, not by a task's number, so a repeated task or
another order of tasks gives the same numbers.

A keyed Feistel permutation of the numbers, walking its cycle until it falls below
the number of sequences, gives each sequence its slot. A shard holds ``per_shard``
consecutive slots; a range partition writes up to ``SHARDS_PER_TASK`` of them, each sorted and written from its first
slot to its last. The place of a slot follows from its number, so a reader can start
at any slot and read on sequentially.

Two numbers for each scan split go through the driver (16 bytes for 128 MB of input), into a file that
the tasks map. Defined results: null and empty texts are an end id alone; rows with a null id are kept, with null in
``doc_ids``; an empty table gives no sequence and no file; repeated rows count each for itself; other columns,
whatever their name, are ignored. Ids that do not fit ``width`` bytes are an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from .bytesops import mix64
from .chunks import cuts_at_runs, library_table
from .shared import _filesystem, mapped_file, scratch, staged, write_file

LENGTH = 2048
PER_SHARD = 4096
END_ID = 2
ROUNDS = 6
SHARDS_PER_TASK = 64


def permute(index: np.ndarray, size: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0 .. size - 1 at the given numbers (or its inverse)."""
    half = np.uint64(max(1, -(-max(1, size - 1).bit_length() // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    keys = mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 64)))
    value = np.asarray(index).astype(np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        if inverse:
            for k in keys[::-1]:
                left, right = right ^ (mix64(left ^ k) & mask), left
        else:
            for k in keys:
                left, right = right, left ^ (mix64(right ^ k) & mask)
        return (left << half) | right

    value = once(value)
    while (out := np.flatnonzero(value >= np.uint64(size))).size:
        value[out] = once(value[out])
    return value.astype(np.int64)


def _with_split(docs: DataFrame, text: str, key: str) -> DataFrame:
    """doc_id, text and the scan split of each row; rows that come from no file are stored first."""
    rows = docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"))
    split = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).alias("split")
    try:
        return docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"), split)
    except AnalysisException:
        return staged(rows, "documents").select("doc_id", "text", split)


def _by_split(batch: pa.RecordBatch, path: str, end_id: int) -> Iterator[tuple[int, list, np.ndarray, np.ndarray]]:
    """(split, doc ids, ids with end ids, offsets) for the batch's rows, in order, never across two splits."""
    splits, keys = batch.column("split").to_numpy(), batch.column("doc_id").to_pylist()
    cuts = np.flatnonzero(splits[1:] != splits[:-1]) + 1
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        if first == last:
            continue
        part = batch.column("text").slice(first, last - first)
        for block, ids, at in library_table(path).ids(part):
            ids = np.insert(ids, at[1:], end_id)
            yield int(splits[first]), keys[first + block.first : first + block.last], ids, at + np.arange(len(at))


class _Stream:
    """Sequences of one split, and the documents that each touches."""

    def __init__(self, length: int, pad: int):
        self.length, self.pad = length, pad
        self.ids, self.done = np.zeros(0, np.uint32), 0
        self.doc_ids: list = []
        self.ends = np.zeros(0, np.int64)  # of doc_ids, counted from the split's first id

    def add(self, keys: list, ids: np.ndarray, at: np.ndarray) -> list[tuple]:
        seen = self.done * self.length + len(self.ids)
        self.doc_ids += keys
        self.ends = np.concatenate([self.ends, seen + at[1:]])
        self.ids = np.concatenate([self.ids, ids])
        return self._cut(len(self.ids) // self.length)

    def finish(self) -> list[tuple]:
        if not len(self.ids):
            return []
        real = len(self.ids)
        self.ids = np.concatenate([self.ids, np.full(self.length - real, self.pad, np.uint32)])
        return [(*row[:2], real, row[3]) for row in self._cut(1)]

    def _cut(self, n: int) -> list[tuple]:
        """(number in the split, ids, how many are real, doc ids) of the next n sequences."""
        out = []
        for i in range(n):
            first = (self.done + i) * self.length
            a = np.searchsorted(self.ends, first, "right")
            b = np.searchsorted(self.ends, first + self.length, "left") + 1
            out.append((self.done + i, self.ids[i * self.length : (i + 1) * self.length], self.length, self.doc_ids[a:b]))
        self.done += n
        self.ids = self.ids[n * self.length :]
        gone = int(np.searchsorted(self.ends, self.done * self.length, "right"))
        self.doc_ids, self.ends = self.doc_ids[gone:], self.ends[gone:]
        return out


def materialise(
    docs: DataFrame, path: str, key: int, length: int = LENGTH, per_shard: int = PER_SHARD, width: int = 2,
    folder: str | None = None, end_id: int = END_ID, text: str = "text", id_column: str = "doc_id",
) -> DataFrame:
    """Write all documents' ids as shards and return a row for each sequence, in stored form:

    slot, shard, byte_offset (in the shard's file), sequence (number before the permutation),
    n_tokens (without padding), ids_crc32 (of the stored bytes), doc_ids (of the documents in it) and file.
    Ids are little-endian unsigned integers of ``width`` bytes; an id that does not fit is an error."""
    spark = docs.sparkSession
    cuts_at_runs(path)
    folder = folder or scratch(spark, "shards")
    kind = {1: "<u1", 2: "<u2", 4: "<u4"}[width]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(3)
        stream, current = _Stream(length, end_id), None

        def made(found: list[tuple], split: int) -> Iterator[pa.RecordBatch]:
            if not found:
                return
            if any(int(x[1].max()) >> (8 * width) for x in found):
                raise ValueError(f"an id needs more than {width} bytes")
            columns = [
                pa.array([split] * len(found), pa.int64()), pa.array([x[0] for x in found], pa.int64()),
                pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.list_(pa.int64())),
                pa.array([packer.compress(x[1].astype(kind).tobytes()) for x in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["split", "at", "n_tokens", "doc_ids", "ids"])

        for batch in batches:
            for split, keys, ids, at in _by_split(batch, path, end_id):
                if split != current:
                    yield from made(stream.finish(), current)
                    stream, current = _Stream(length, end_id), split
                yield from made(stream.add(keys, ids, at), split)
        yield from made(stream.finish(), current)

    schema = "split long, at long, n_tokens int, doc_ids array<long>, ids binary"
    sequences = staged(_with_split(docs, text, id_column).mapInArrow(cut, schema), "cut")
    # A split is one task's, but two splits could share a hash: then their numbers within the split repeat.
    per_split = sequences.groupBy("split").agg(F.count("*").alias("n"), F.max("at").alias("last")).collect()
    if any(r["n"] != r["last"] + 1 for r in per_split):
        raise RuntimeError("two scan splits share a hash")
    splits = np.array(sorted((r["split"], r["n"]) for r in per_split), np.int64).reshape(-1, 2)
    size = int(splits[:, 1].sum())
    firsts = write_file(folder, "splits", [np.ascontiguousarray(splits[:, 0]), np.cumsum(splits[:, 1]) - splits[:, 1]]) if size else ""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, first = np.asarray(mapped_file(firsts).view(np.int64)).reshape(2, -1)
            own = np.searchsorted(names, batch.column("split").to_numpy())
            number = first[own] + batch.column("at").to_numpy()
            slot = permute(number, size, key)
            kept = [batch.column(c) for c in ("n_tokens", "doc_ids", "ids")]
            yield pa.RecordBatch.from_arrays(
                [pa.array((slot // per_shard).astype(np.int32)), pa.array(slot), pa.array(number), *kept],
                ["shard", "slot", "sequence", "n_tokens", "doc_ids", "ids"],
            )

    stride = length * width

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        filesystem, base = _filesystem(folder)
        filesystem.create_dir(base, recursive=True)
        unpacker = zstandard.ZstdDecompressor()
        out, shard, name, following = None, None, "", 0
        for batch in batches:
            shards, slots = batch.column("shard").to_pylist(), batch.column("slot").to_pylist()
            files, sums = [], []
            for s, slot, blob in zip(shards, slots, batch.column("ids"), strict=True):
                if s != shard:
                    if out:
                        out.close()
                    shard, following = s, s * per_shard
                    name = f"shard-{s:08d}-{uuid.uuid4().hex}.bin"
                    out = filesystem.open_output_stream(f"{base}/{name}")
                if slot != following:
                    raise RuntimeError(f"slot {slot} stands where {following} is due")
                following += 1
                raw = unpacker.decompress(blob.as_py(), max_output_size=stride)
                out.write(raw)
                files.append(f"{folder.rstrip('/')}/{name}")
                sums.append(zlib.crc32(raw))
            kept = {n: batch.column(batch.schema.names.index(n)) for n in ("slot", "shard", "sequence", "n_tokens", "doc_ids")}
            offset = np.array(slots, np.int64) % per_shard * stride
            made = kept | {"byte_offset": pa.array(offset), "ids_crc32": pa.array(sums, pa.int64()), "file": pa.array(files, pa.string())}
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))
        if out:
            out.close()

    placed = sequences.mapInArrow(place, "shard int, slot long, sequence long, n_tokens int, doc_ids array<long>, ids binary")
    shards = max(1, -(-size // per_shard))
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // SHARDS_PER_TASK)))
    each = -(-shards // tasks)
    dealt = placed.repartitionById(-(-shards // each), F.floor(F.col("shard") / each).cast("int")).sortWithinPartitions("slot")
    schema = "slot long, shard int, sequence long, n_tokens int, doc_ids array<long>, byte_offset long, ids_crc32 long, file string"
    return staged(dealt.mapInArrow(write, schema), "sequences")


def read_sequences(stored: DataFrame, slot: int = 0, length: int = LENGTH, per_shard: int = PER_SHARD, width: int = 2) -> Iterator[np.ndarray]:
    """The sequences from a slot on, in order, read from the shards' files (their addresses are all that is collected)."""
    files = {r["shard"]: r["file"] for r in stored.select("shard", "file").distinct().collect()}
    kind = {1: "<u1", 2: "<u2", 4: "<u4"}[width]
    for shard in range(slot // per_shard, max(files, default=-1) + 1):
        table = mapped_file(files[shard]).view(kind).reshape(-1, length)
        yield from table[slot - shard * per_shard if shard == slot // per_shard else 0 :]
