"""Conversation prefix trie: how much of their beginnings conversations share.

A node is a distinct sequence of first turns; the textless root is shared by all. A turn counts by its role
and text. Each prefix has a 128-bit digest: the sum of the MD5 values of its (position, role, text) triples,
in four lanes of 32 bits. Sums make the digest of every prefix one running total, and the parent's
digest a subtraction.

1. Prefix digests of all conversations (``paths``), one row for each conversation and depth.
2. Nodes: one aggregate on the digest, combined before the shuffle, so that a first turn of a third of all
   conversations is a few rows. It also verifies the digests: all conversations of a node must agree on the
   last turn's MD5 and on the parent's digest, or the job fails.
3. The trie is cut where a subtree has ``CUT`` path rows or fewer. What hangs below a cut is at most that large
   and lies whole in one shard; the nodes above are few (each stands for more than ``CUT`` rows).
4. In a shard (``Table``) the distinct digests get slots by a minimal perfect hash, verified digest by digest; counts
   are scattered into flat arrays by slot, the parents' slots are looked up the same way, and leaves and saved tokens are
   added up through the parent-slot array, deepest nodes first.
5. The nodes above the cuts take the totals of the shards below them, and then of each other: in round k each
   adds its total to the node 2**k above it, so a path of any depth takes a logarithmic number of rounds.

A node is named by its smallest member and its depth: no two nodes of a depth share a member.

Defined results
* ``turns`` holds conv_id, pos (1, 2, ... without gaps), digest and n_bytes (see ``digested``). A row with pos 0
  says only that the conversation exists; each conversation needs exactly one. Null conversation ids are no conversations.
* A null role or text is empty. Repeated rows are positions of their own.
* An empty table has no conversation and hence no node, not even the root.
* Very long texts are only hashed. Extra columns, whatever their name, are ignored. Turns of one conversation (some
  60 bytes each, no text) are numbered by one window, which spills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .bytesops import mix64
from .shared import remove, staged, staged_at

#: A subtree with so many path rows or fewer lies in one shard.
CUT = 1 << 14

#: Subtrees are processed together until they have so many nodes.
SHARD_NODES = 1 << 16

LANES = ["l0", "l1", "l2", "l3"]
_LANE = (1 << 32) - 1

NODE_COLUMNS = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def digested(rows: DataFrame) -> DataFrame:
    """conv_id, turn, digest (MD5 of role and text) and n_bytes (of the text) of conversation rows."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return rows.where("conv_id is not null").select("conv_id", "turn", F.md5(content).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def numbered(rows: DataFrame) -> DataFrame:
    """``digested`` rows with ``pos`` from 1 in the order of turn (nulls first), then digest."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", "digest", "n_bytes", F.row_number().over(order).cast("long").alias("pos"))


def _lanes(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(x) for i, x in enumerate(LANES)]


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, the prefix's digest lanes, its parent's (p0...), the turn's MD5, n_bytes and n_below.

    ``n_below``: rows of the conversation from this depth on."""
    own = F.when(F.col("pos") > 0, F.md5(F.concat_ws(":", F.col("pos").cast("string"), "digest"))).otherwise("0" * 32)
    rows = turns.where("conv_id is not null").select("conv_id", "pos", "digest", "n_bytes", own.alias("own"))
    rows = rows.select("conv_id", F.col("pos").alias("depth"), "digest", "n_bytes", *_lanes(F.col("own")))
    order = Window.partitionBy("conv_id").orderBy("depth")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(x).over(so_far).bitwiseAND(F.lit(_LANE)).alias(f"s{i}") for i, x in enumerate(LANES)]
    rows = rows.select("*", *sums, F.max("depth").over(Window.partitionBy("conv_id")).alias("last"))
    return rows.select(
        "conv_id",
        "depth",
        *[F.col(f"s{i}").alias(x) for i, x in enumerate(LANES)],
        *[(F.col(f"s{i}") - F.col(x)).bitwiseAND(F.lit(_LANE)).alias(f"p{i}") for i, x in enumerate(LANES)],
        F.coalesce("digest", F.lit("")).alias("turn_digest"),
        F.coalesce("n_bytes", F.lit(0).cast("long")).alias("n_bytes"),
        (F.col("last") - F.col("depth") + 1).alias("n_below"),
    )


def build(turns: DataFrame, cut: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The nodes (``NODE_COLUMNS``) and the ends: (node, depth, conv_id) of each conversation with exactly ``depth`` turns."""
    cut = CUT if cut is None else cut
    rows = staged(paths(turns), "prefixes")
    parent, content = [F.col(f"p{i}") for i in range(4)], F.struct("turn_digest", "n_bytes", *[f"p{i}" for i in range(4)])
    found = rows.groupBy(*LANES, "depth").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("node"),
        F.sum("n_below").alias("below"),
        F.min(content).alias("low"),
        F.max(content).alias("high"),
    )
    verified = F.when(F.col("low") == F.col("high"), F.col("n_convs")).otherwise(F.raise_error(F.lit("two prefixes share a digest")).cast("long"))
    found = found.select(*[F.col(x).alias(f"n{i}") for i, x in enumerate(LANES)], F.col("depth").alias("n_depth"), verified.alias("n_convs"), "node", "below")
    same = [F.col(x) == F.col(f"n{i}") for i, x in enumerate(LANES)] + [F.col("depth") == F.col("n_depth")]
    known = rows.join(found, on=same)
    path = Window.partitionBy("conv_id").orderBy("depth")
    whole = path.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    small = F.when(F.col("below") <= cut, F.struct(*LANES, "depth"))
    known = staged(
        known.select(
            "conv_id",
            "depth",
            *LANES,
            *parent,
            "n_bytes",
            "n_convs",
            "node",
            (F.col("n_below") == 1).alias("ends"),
            F.lag("node").over(path).alias("parent_conv_id"),
            F.first(small, ignorenulls=True).over(whole).alias("root"),
            (F.col("below") <= cut).alias("small"),
        ),
        "known-prefixes",
    )
    ends = known.where("ends").select("node", "depth", "conv_id")
    own = known.where("node = conv_id").drop("node", "ends")
    below = staged(_shards(own.where("small")), "shard-nodes")
    above = _above(own.where("not small"), below.where("is_root"))
    names = [c.split()[0] for c in NODE_COLUMNS.split(", ")]
    return below.select(*names).union(above.select(*names)), ends


# ---------------------------------------------------------------- shards


class Table:
    """Slots 0 ... n - 1 for n distinct 128-bit keys: a minimal perfect hash by levels, with the keys kept by slot.

    At each level the remaining keys are hashed to twice as many places; those alone at theirs are done, and a
    place's slot is its rank among the places taken alone. A look-up compares the key that it finds."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.keys = np.zeros_like(keys)
        left, base = np.arange(len(keys)), 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("keys repeat")
            at = self._places(keys[left], len(self.levels), 2 * len(left))
            alone = np.bincount(at, minlength=2 * len(left)) == 1
            rank = base + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            done = alone[at]
            self.keys[rank[at[done]]] = keys[left[done]]
            base += int(alone.sum())
            left = left[~done]

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & ((1 << 64) - 1))
        return (mix64(keys[:, 0] ^ mix64(keys[:, 1] ^ salt)) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key that is not there."""
        found, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            if not len(left):
                break
            at = self._places(keys[left], level, len(alone))
            hit = alone[at]
            found[left[hit]] = rank[at[hit]]
            left = left[~hit]
        there = found >= 0
        found[there] = np.where((self.keys[found[there]] == keys[there]).all(axis=1), found[there], -1)
        return found


def accumulate(keys: np.ndarray, parents: np.ndarray, depth: np.ndarray, saved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Children, leaves and saved tokens of the subtree, and whether the parent is elsewhere, for each of the distinct keys."""
    table = Table(keys)
    slot, up = table.slots(keys), table.slots(parents)
    if len(np.unique(slot)) != len(keys) or (slot < 0).any():
        raise ValueError("a key lost its slot")
    n = len(keys)
    parent_slot, depth_at, total = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
    parent_slot[slot], depth_at[slot], total[slot] = up, depth, saved
    inner = parent_slot >= 0
    children = np.bincount(parent_slot[inner], minlength=n)
    leaves = (children == 0).astype(np.int64)
    order = np.flatnonzero(inner)
    order = order[np.argsort(-depth_at[order], kind="stable")]
    for level in np.split(order, np.flatnonzero(np.diff(depth_at[order])) + 1):
        np.add.at(leaves, parent_slot[level], leaves[level])
        np.add.at(total, parent_slot[level], total[level])
    return children[slot], leaves[slot], total[slot], up < 0


def _wide(batch: pa.Table, names: list[str]) -> np.ndarray:
    lanes = [batch.column(x).to_numpy().astype(np.uint64) for x in names]
    return np.stack([lanes[0] << np.uint64(32) | lanes[1], lanes[2] << np.uint64(32) | lanes[3]], axis=1)


def _shard_rows(table: pa.Table) -> pa.RecordBatch:
    depth, n_convs = table.column("depth").to_numpy(), table.column("n_convs").to_numpy()
    saved = (n_convs - 1) * table.column("n_bytes").to_numpy()
    # The depth is part of the key, as it is in the aggregate.
    keys, parents = _wide(table, LANES), _wide(table, ["p0", "p1", "p2", "p3"])
    keys[:, 1] ^= mix64(depth.astype(np.uint64))
    parents[:, 1] ^= mix64((depth - 1).astype(np.uint64))
    children, leaves, total, is_root = accumulate(keys, parents, depth, saved)
    out = [pa.array(x) for x in (children, leaves, total, is_root)]
    kept = [table.column(c).combine_chunks() for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "p0", "p1", "p2", "p3")]
    return pa.RecordBatch.from_arrays(
        kept[:4] + out[:3] + kept[4:] + out[3:],
        ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "p0", "p1", "p2", "p3", "is_root"],
    )


def _shards(own: DataFrame) -> DataFrame:
    """The nodes below the cuts with their totals; ``is_root`` marks the uppermost of each subtree."""
    n = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < SHARD_NODES:
                continue
            table = pa.Table.from_batches(held)
            marks = np.stack([table.column(f"r{i}").to_numpy() for i in range(5)], axis=1)
            changes = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1))
            if len(changes):  # all but the last subtree is complete
                whole = int(changes[-1]) + 1
                yield _shard_rows(table.slice(0, whole))
                held, size = table.slice(whole).to_batches(), table.num_rows - whole
        if size:
            yield _shard_rows(pa.Table.from_batches(held))

    marks = [F.col(f"root.{x}").alias(f"r{i}") for i, x in enumerate([*LANES, "depth"])]
    rows = own.select("conv_id", "depth", *LANES, *[f"p{i}" for i in range(4)], "n_bytes", "n_convs", "parent_conv_id", *marks)
    names = [f"r{i}" for i in range(5)]
    return rows.repartition(n, *names).sortWithinPartitions(*names).mapInArrow(
        work, f"{NODE_COLUMNS}, p0 long, p1 long, p2 long, p3 long, is_root boolean"
    )


# ---------------------------------------------------------------- above the cuts


def _above(own: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes above the cuts: totals of the subtrees below, then of each other, by doubling distances."""
    spark = own.sparkSession
    key, up = F.struct(*LANES, "depth"), F.struct(*[F.col(f"p{i}").alias(x) for i, x in enumerate(LANES)], (F.col("depth") - 1).alias("depth"))
    nodes = own.select(key.alias("key"), F.when(F.col("depth") > 0, up).alias("up"), "conv_id", "depth", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    hung = roots.select(up.alias("to"), "n_leaves", "saved_tokens", F.lit(1).alias("n"))
    hung = hung.union(nodes.where("up is not null").select("up", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(1)))
    hung = hung.groupBy("to").agg(F.sum("n").alias("n_children"), F.sum("n_leaves").alias("hung_leaves"), F.sum("saved_tokens").alias("hung_saved"))
    state = nodes.join(hung, F.col("key") == F.col("to"), "left").select(
        "key",
        "up",
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.col("hung_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + F.coalesce("hung_saved", F.lit(0))).cast("long").alias("saved_tokens"),
    )
    state, path = staged_at(state, "above")
    deepest = state.agg(F.max("depth")).first()[0]
    for _ in range((deepest or 0).bit_length()):
        given = state.where("up is not null").groupBy(F.col("up").alias("to")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        beyond = state.select(F.col("key").alias("at"), F.col("up").alias("next"))
        state = (
            state.join(given, F.col("key") == F.col("to"), "left")
            .join(beyond, F.col("up") == F.col("at"), "left")
            .select(
                "key",
                F.col("next").alias("up"),
                "conv_id",
                "depth",
                "parent_conv_id",
                "n_convs",
                "n_children",
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            )
        )
        (state, new_path), old = staged_at(state, "above"), path
        remove(spark, old)
        path = new_path
    return state


# ---------------------------------------------------------------- digests of the ends

#: Ids of a node are joined to pieces of about so many bytes before they meet.
PIECE = 1 << 16


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256): SHA-256 of the comma-joined, ascending ids of the conversations that end at each node.

    Ids are sorted over ranges of (node, depth, id) and joined to pieces there; the pieces of a node then pass one
    task as a stream, since the digest is of one sequence."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, ids, size, out = None, None, [], 0, []

        def batch_of(rows):
            types = [("node", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], [x for x, _ in types])

        for batch in batches:
            for node, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "conv_id")), strict=True):
                if at != (node, depth) or size > PIECE:
                    if ids:
                        out.append((*at, first, ",".join(ids)))
                    at, first, ids, size = (node, depth), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if len(out) >= 1000:
                yield batch_of(out)
                out = []
        if ids:
            out.append((*at, first, ",".join(ids)))
        if out:
            yield batch_of(out)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha, done = None, None, []

        def batch_of(rows):
            types = [("node", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], [x for x, _ in types])

        for batch in batches:
            for node, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids")), strict=True):
                if at != (node, depth):
                    if at is not None:
                        done.append((*at, sha.hexdigest()))
                    at, sha = (node, depth), hashlib.sha256()
                    sha.update(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if len(done) >= 10_000:
                yield batch_of(done)
                done = []
        if at is not None:
            done.append((*at, sha.hexdigest()))
        if done:
            yield batch_of(done)

    order = ["node", "depth", "conv_id"]
    joined = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(pieces, "node long, depth long, first long, ids string")
    joined = joined.repartition(n, "node", "depth").sortWithinPartitions("node", "depth", "first")
    return joined.mapInArrow(hashes, "node long, depth long, ends_sha256 string")
