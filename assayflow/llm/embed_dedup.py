"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets.

Vectors of one label are linked at a cosine of ``THRESHOLD`` or more. Equal vectors are
one class with a count. A class is rotated by random signs and fast Hadamard transforms;
a hash is the nearest signed axis, a bucket several of them in a row (the last one among fewer
axes), and there are ``TABLES`` independent sets. The number of buckets follows the
label's classes of that length (``bucket_bits``), so a class meets about equally many unlike ones at every
size. It stands in its own bucket of each set and probes the ``PROBES`` buckets that it came closest to next.

A bucket's task verifies every pair of it in double precision, with the vectors at
hand. It reports the number of links by class and the links that span its groups, not
the pairs. A pair that meets in several buckets counts in the first one only, which both
sides know from their codes. A bucket of more than ``TILE`` rows is cut into tiles, and
each pair of tiles is a task's work of its own, so a very large group of near copies
takes no more memory, and no pair is lost.

The hashes are fixed by a seed; nothing is fitted. Links that no bucket brings together are
missed: recall is measured in the tests (over 0.99 of the pairs). It falls slowly with the bits: of pairs
at the threshold itself, 0.99 at 24 bits (33 million classes of a label) and 0.95 at 32 (8 billion), at 16 and 64
dimensions. None is found below the threshold.

Defined results: a row takes no part if its label or id is null, or its vector is null,
zero or has a null or non-finite component; it has no links and is its own component (a
row with a null id has none, and is kept). Vectors of different length never link.
Repeated rows count as vectors of their own. Rows that share an id but not the vector
share their links, too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import staged
from .simhash import _join_labels
from .topk import usable

THRESHOLD = 0.98
TABLES = 4
FILL = 2
PROBES = 3
TILE = 512
SEED = 20240229
_GATHER = 16_384


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row (its length a power of two), scaled to keep norms."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def bucket_bits(rows: int) -> int:
    """Bits of a bucket's code among so many rows of a label: about ``FILL`` unlike rows share a bucket, whatever their number."""
    return max(1, math.ceil(math.log2(max(1, rows) / FILL)))


def bucket_codes(vectors: np.ndarray, bits: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """(rows, tables, 1 + probes): each row's own bucket of each table and the buckets it probes."""
    n, dim = vectors.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    padded /= np.sqrt((padded**2).sum(axis=1, keepdims=True))
    whole = width.bit_length()  # bits of a signed axis of the whole space
    hashes = [whole] * (bits // whole) + [bits % whole] * (bits % whole > 0)
    out = np.empty((n, tables, 1 + probes), np.int64)
    rows = np.arange(n)[:, None]
    for table in range(tables):
        own, shift = np.zeros(n, np.int64), 0
        swaps, costs = [], []
        for h, size in enumerate(hashes):
            signs = np.random.Generator(np.random.PCG64([SEED, width, table, h])).choice([-1.0, 1.0], (3, width))
            turned = padded
            for sign in signs:
                turned = _hadamard(turned * sign)
            turned = turned[:, : 1 << (size - 1)]
            turned = np.concatenate([turned, -turned], axis=1)
            near = min(probes + 1, turned.shape[1])
            top = np.argpartition(-turned, near - 1, axis=1)[:, :near]
            top = top[rows, np.argsort(-turned[rows, top], axis=1, kind="stable")].astype(np.int64)
            reach = turned[rows, top]
            own += top[:, 0] << shift
            swaps.append((top[:, 1:] - top[:, :1]) << shift)
            costs.append((reach[:, :1] - reach[:, 1:]) ** 2)
            shift += size
        pick = np.argsort(np.concatenate(costs, axis=1), axis=1, kind="stable")[:, :probes]
        found = own[:, None] + np.concatenate(swaps, axis=1)[rows, pick]
        out[:, table, 0] = own
        out[:, table, 1 : 1 + found.shape[1]] = found
        out[:, table, 1 + found.shape[1] :] = -1 - np.arange(probes - found.shape[1])
    return out


def _coded(classes: DataFrame) -> DataFrame:
    """The classes (rep, n, label, vector, peers) with their codes, all tables in a row, in place of ``peers``."""
    kept = classes.drop("peers").schema
    names = kept.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.names.index("vector"))
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            dims, peers = np.diff(at), batch.column("peers").to_numpy()
            sizes = {x: bucket_bits(x) for x in np.unique(peers).tolist()}
            kinds = np.array([sizes[x] for x in peers.tolist()]) + (dims.astype(np.int64) << 8)
            codes = np.empty((batch.num_rows, TABLES * (1 + PROBES)), np.int64)
            for kind in np.unique(kinds).tolist():
                own = np.flatnonzero(kinds == kind)
                for first in range(0, len(own), 2048):
                    part = own[first : first + 2048]
                    codes[part] = bucket_codes(flat[at[part][:, None] + np.arange(kind >> 8)], kind & 255).reshape(len(part), -1)
            offsets = pa.array(np.arange(batch.num_rows + 1) * codes.shape[1], pa.int32())
            coded = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, coded], [*names, "codes"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.fields)
    return classes.mapInArrow(run, schema + ", codes array<long>")


def _first_meeting(x: np.ndarray, y: np.ndarray, table: int, way: int) -> np.ndarray:
    """Whether pairs with codes x and y (the smaller id's first) meet in no earlier table and by no earlier way.

    Ways: 0 both in their own bucket, 1 the first probes the second's bucket, 2 the reverse."""
    x, y = x.reshape(len(x), TABLES, 1 + PROBES), y.reshape(len(y), TABLES, 1 + PROBES)
    met = np.stack(
        [x[:, :, 0] == y[:, :, 0], (x[:, :, 1:] == y[:, :, :1]).any(axis=2), (y[:, :, 1:] == x[:, :, :1]).any(axis=2)], axis=2
    )
    return ~met[:, :table].any(axis=(1, 2)) & ~met[:, table, :way].any(axis=1)


def verify(rep, n, own, tile, vectors, codes, table: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of one bucket (or of a pair of its tiles): link counts (id, number), spanning links (a, b), pairs found."""
    homes = np.flatnonzero(own)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that no square is too large or too small
    norms = np.sqrt((vectors**2).sum(axis=1))
    cosine = vectors @ vectors[homes].T / (norms[:, None] * norms[homes][None, :])
    a, b = np.nonzero(cosine >= THRESHOLD)
    b = homes[b]
    fit = rep[a] != rep[b]
    if not same:
        fit &= tile[a] != tile[b]
    fit &= ~own[a] | (rep[a] < rep[b])  # two that live here are met once
    a, b = a[fit], b[fit]
    swap = rep[a] > rep[b]
    first, second = np.where(swap, b, a), np.where(swap, a, b)
    way = np.where(own[a], 0, np.where(swap, 2, 1))
    keep = np.zeros(len(a), bool)
    for w in (0, 1, 2):
        at = np.flatnonzero(way == w)
        keep[at] = _first_meeting(codes[first[at]], codes[second[at]], table, w)
    a, b = first[keep], second[keep]
    links = np.zeros(len(rep), np.int64)
    np.add.at(links, a, n[b])
    np.add.at(links, b, n[a])
    labels = np.arange(len(rep))
    _join_labels(labels, a, b)
    child = np.flatnonzero(labels != np.arange(len(rep)))
    linked = np.flatnonzero(links)
    return rep[linked], links[linked], rep[child], rep[labels[child]], np.array([len(a)])


KEYS = ["label", "dim", "table", "code", "i", "j"]


def _verified(rows: DataFrame) -> DataFrame:
    """(a, n, b) of all buckets: a link count has no b, a spanning link no n."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
        """Tables of whole groups and where their groups begin; a group is never cut."""
        waiting: list[pa.RecordBatch] = []

        def cut(last: bool) -> Iterator[tuple[pa.Table, np.ndarray]]:
            table = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            change = np.zeros(table.num_rows, bool)
            change[:1] = True
            for name in KEYS:
                column = table.column(name).combine_chunks()
                values = column.dictionary_encode().indices.to_numpy() if name == "label" else column.to_numpy()
                change[1:] |= values[1:] != values[:-1]
            starts = np.flatnonzero(change)
            if not last:
                waiting.extend(table.slice(starts[-1]).to_batches())
                table, starts = table.slice(0, starts[-1]), starts[:-1]
            if table.num_rows:
                yield table, np.append(starts, table.num_rows)

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
            if sum(x.num_rows for x in waiting) >= _GATHER:
                yield from cut(False)
        if waiting:
            yield from cut(True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches):
            get = lambda name: table.column(name).combine_chunks()
            rep, n, own, tile = (get(c).to_numpy(zero_copy_only=False) for c in ("rep", "n", "own", "tile"))
            number, i, j, dims = (get(c).to_numpy() for c in ("table", "i", "j", "dim"))
            lists = get("vector")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            codes = get("codes").flatten().to_numpy().reshape(len(rep), -1)
            homes = np.concatenate([[0], np.cumsum(own)])
            counts, edges = [], []
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                if e - s < 2 or homes[e] == homes[s]:
                    continue
                vectors = flat[at[s] : at[e]].reshape(e - s, dims[s])
                who, links, a, b, _ = verify(rep[s:e], n[s:e], own[s:e], tile[s:e], vectors, codes[s:e], number[s], i[s] == j[s])
                counts.append((who, links))
                edges.append((a, b))
            empty = [np.zeros(0, np.int64)]
            who, links = (np.concatenate(empty + [x[k] for x in counts]) for k in (0, 1))
            a, b = (np.concatenate(empty + [x[k] for x in edges]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([who, a])),
                    pa.array(np.concatenate([links, np.zeros(len(a), np.int64)]), mask=np.arange(len(who) + len(a)) >= len(who)),
                    pa.array(np.concatenate([np.zeros(len(who), np.int64), b]), mask=np.arange(len(who) + len(a)) < len(who)),
                ],
                ["a", "n", "b"],
            )

    return rows.mapInArrow(run, "a long, n long, b long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    valid = usable("vector") & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("__in", valid & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    inside = rows.where("__in").drop("__in")
    classes = inside.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = staged(classes.select("rep", "n", "label", "vector", F.size("vector").alias("size")), "distinct")
    peers = classes.groupBy("label", "size").agg(F.count("*").alias("peers"))
    classes = classes.join(peers, ["label", "size"]).select("rep", "n", "label", "vector", "peers")
    classes = staged(_coded(classes), "classes")
    each = classes.select(
        "label", F.size("vector").alias("dim"), "rep", "n", "vector", "codes", F.posexplode("codes").alias("place", "code")
    )
    each = each.select(
        "*",
        F.expr(f"cast(place div {1 + PROBES} as int)").alias("table"),
        (F.col("place") % (1 + PROBES) == 0).alias("own"),
    ).drop("place")
    bucket = ["label", "dim", "table", "code"]
    large = each.groupBy(*bucket).agg(F.count("*").alias("rows")).where(F.col("rows") > TILE)
    large = staged(large.select(*bucket, F.ceil(F.col("rows") / TILE).cast("int").alias("tiles")), "large")
    tiled = each.join(large, bucket, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiled.select(*KEYS, "rep", "n", "own", "tile", "vector", "codes").repartition(parts, *KEYS).sortWithinPartitions(*KEYS)
    found = staged(_verified(dealt), "links")
    sums = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    known = classes.select("rep", "n", "label", "vector").join(sums.withColumnRenamed("a", "rep"), "rep", "left")
    known = known.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    known = staged(
        known.select(
            "label", "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id")
        ),
        "known",
    )
    linked = inside.join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("__in")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
