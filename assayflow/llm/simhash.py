"""SimHash fingerprints and their near-duplicate groups, by exact tiled comparison.

A fingerprint has a bit set if more than half of the text's shingle hashes have
it set. Two fingerprints link if they differ in at most ``radius`` bits.

Equal fingerprints are one entry. The entries are laid out in tiles by the
population counts of their two halves, a cell of more than ``TILE`` entries in
several tiles. Two fingerprints differ in at least as many bits as the
population counts of their halves differ in sum, so only pairs of tiles within
the radius meet; every such pair is compared in full with exclusive-or and
bit counts. Tiles are files in the shared folder; what is shuffled are the numbers of the tiles of a pair,
and the task that compares them reads the tiles. A pair of tiles reports the links that span its groups (a forest),
not all pairs of a group, and the forest's components are found in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .rows import PLACE, placed, without
from .shared import bounded_batches, publish, read_file, scratch, staged, tidy

TILE = 1 << 15  # fingerprints; a file of 256 KB
TILES_KEPT = 64
RADIUS = 4
SHINGLE = 4
_MATRIX = 1 << 21


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text's word shingles (0 without a word)."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= shingle:
        hashes = np.array([digest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)], np.uint64)
    votes = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", key: str = "doc_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, extra columns): the fingerprint of every text as a signed 64-bit integer."""
    bounded_batches(docs.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            found = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in column), np.uint64, len(column))
            kept = [batch.column(batch.schema.names.index(c)) for c in extra]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64)), *kept], ["doc_id", "fp", *extra])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *extra)
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(run, "doc_id long, fp long" + kinds)


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the ends of all links (a, b) one label: the smallest index of their group."""
    while True:
        x, y = labels[a], labels[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        low = np.minimum(x, y)
        np.minimum.at(labels, x, low)
        np.minimum.at(labels, y, low)
        while True:
            nxt = labels[labels]
            if np.array_equal(nxt, labels):
                break
            labels[:] = nxt


def spanning_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups within ``left`` and ``right`` (None: among ``left`` alone) at the radius."""
    both = left if right is None else np.concatenate([left, right])
    other, shift = (left, 0) if right is None else (right, len(left))
    labels = np.arange(len(both))
    step = max(1, _MATRIX // max(1, len(other)))
    for at in range(0, len(left), step):
        near = np.flatnonzero(np.bitwise_count(left[at : at + step, None] ^ other[None, :]) <= radius)
        if len(near):
            a, b = np.divmod(near, len(other))
            _join_labels(labels, a + at, b + shift)
    child = np.flatnonzero(labels != np.arange(len(both)))
    return both[child], both[labels[child]]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): a spanning forest of the links between the distinct fingerprints ``fp``."""
    half = lambda shift: F.bit_count(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0xFFFFFFFF)))
    cells = distinct.select("fp", (half(32) * 33 + half(0)).cast("int").alias("cell"))
    # At most 33 * 33 cells, whatever the number of fingerprints.
    rows = {r["cell"]: r["n"] for r in cells.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    sizes, total = {c: -(-n // tile) for c, n in rows.items()}, sum(rows.values())
    spark = distinct.sparkSession
    bounded_batches(spark)
    near = [
        (c, sizes[c], o, sizes[o])
        for c in sizes
        for o in sizes
        if c <= o and abs(c // 33 - o // 33) + abs(c % 33 - o % 33) <= radius
    ]
    if not near:
        return spark.createDataFrame([], "a long, b long")
    parts = F.element_at(F.create_map(*[F.lit(x) for item in sizes.items() for x in item]), F.col("cell"))
    part = F.pmod(F.xxhash64("fp"), parts).cast("int")
    folder = scratch(spark, "tiles")

    def write(key, table):
        found = np.sort(table.column("fp").to_numpy())
        publish(folder, f"{key[0].as_py()}-{key[1].as_py()}", [found])
        return pa.table({"n": [len(found)]})

    written = cells.withColumn("part", part).groupBy("cell", "part").applyInArrow(write, "n long").agg(F.sum("n")).first()[0]
    if written != total:
        raise RuntimeError(f"{written} of {total} fingerprints are in the tiles")
    pairs = spark.createDataFrame(near, "cell int, parts int, other int, other_parts int")
    pairs = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
    names = ["cell", "part", "other", "other_part"]
    pairs = pairs.where("cell < other or part <= other_part").select(*names)
    dealt = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *names).sortWithinPartitions(*names)

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(TILES_KEPT)
        def tile_at(cell: int, part: int) -> np.ndarray:
            try:
                return read_file(folder, f"{cell}-{part}").view(np.uint64)
            except FileNotFoundError:  # no fingerprint fell into this part
                return np.zeros(0, np.uint64)

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in ends]).view(np.int64)) for k in (0, 1)], ["a", "b"])

        ends, found = [], 0
        for batch in batches:
            for cell, part, other, other_part in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                same = (cell, part) == (other, other_part)
                ends.append(spanning_links(tile_at(cell, part), None if same else tile_at(other, other_part), radius))
                found += len(ends[-1][0])
                if found >= tile or len(ends) == 1024:
                    yield made()
                    ends, found = [], 0
        if ends:
            yield made()

    return dealt.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, text: str = "text", key: str = "doc_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fingerprint, component_id, extra columns) for every row of ``docs``; repeated rows stay repeated.

    ``component_id`` is the smallest id of the rows that links lead to, the row itself
    included. A null or wordless text has fingerprint zero and links like any other; a
    row with a null id is linked, but lends no id (null if its group has none)."""
    rows = staged(fingerprints(docs, shingle, text, key, extra), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes.select("fp"), radius))
    rooted = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    rooted = staged(rooted.select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    firsts = staged(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "firsts")
    named = staged(rooted.join(firsts, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *extra
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest id, the first stored if ids repeat.

    Rows of a group without any id are one for each fingerprint. The texts are not shuffled."""
    docs = placed(docs)
    rows = staged(near_duplicates(docs, extra=tuple(PLACE)), "groups")
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("#"), "fingerprint"))
    heads = rows.where("component_id is null or doc_id = component_id").groupBy(group.alias("group"))
    heads = heads.agg(F.min(F.struct(*PLACE)).alias("head")).select("head.*")
    return without(docs, rows.select(*PLACE).join(heads, PLACE, "left_anti"))
