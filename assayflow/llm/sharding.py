"""Shards by extendible hashing, in DataFrame operations only.

Every row has 60 hash bits of its id and text. A directory is indexed by leading
bits: a bucket over the byte limit is split on its next bit, and only such a bucket.
A bucket is final when it fits the limit or holds a single row (which may be larger
than the limit by itself).

The bits are summed once to (bits, rows, bytes). From there the directory is made in
rounds: the bytes of all prefixes up to some depth are summed from cells of that depth.
A prefix that does not fit has only ancestors that do not fit, so a cell's final depth
is the number of its prefixes that do not fit. Cells that do not fit themselves go on
with more bits in the next round. Copies of one row, equal in all bits, are numbered and
dealt to as many parts as the limit asks for.

Defined results: a null text has 0 bytes, a null id counts as empty text in the hash;
an empty table gives no rows; columns called like ours are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import staged

BITS = 60
MORE = 8
OWN = ("bits", "bytes", "depth", "prefix", "part")


def hash_bits(key: str, text: str) -> Column:
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def directory(keys: DataFrame, limit: int) -> DataFrame:
    """(bits, depth) for the stored table ``keys`` (bits, n, bytes); depth BITS + 1 where copies alone exceed the limit."""
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    known, depth = -1, min(BITS, max(1, math.ceil(math.log2(max(1, total / limit))) + 4))
    todo, done = keys, None
    while True:
        cells = todo.withColumn("cell", F.shiftright("bits", BITS - depth)).groupBy("cell")
        cells = staged(cells.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")), "cells")
        at_depth = cells.withColumn("d", F.explode(F.sequence(F.lit(known + 1), F.lit(depth))))
        at_depth = at_depth.withColumn("p", F.expr(f"shiftright(cell, {depth} - d)"))
        full = at_depth.groupBy("d", "p").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        full = staged(full.where((F.col("bytes") > limit) & (F.col("n") > 1)).select("d", "p", F.lit(1).alias("full")), "full")
        final = at_depth.select("cell", "d", "p").join(full, ["d", "p"], "left").groupBy("cell")
        final = staged(final.agg((F.count("full") + (known + 1)).cast("int").alias("depth")), "depths")
        found = todo.withColumn("cell", F.shiftright("bits", BITS - depth)).join(final, "cell")
        found = staged(found.select("bits", "n", "bytes", "depth"), "found")
        settled = found.where((F.col("depth") <= depth) | F.lit(depth == BITS)).select("bits", "depth")
        done = settled if done is None else done.union(settled)
        if depth == BITS or final.where(F.col("depth") > depth).isEmpty():
            return done
        todo = found.where(F.col("depth") > depth).select("bits", "n", "bytes")
        known, depth = depth, min(BITS, depth + MORE)


def assign(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with ``bytes`` (of the text) and their shard: ``depth``, ``prefix`` (its leading bits) and ``part``.

    ``part`` is 0 but for copies of one row that together exceed the limit."""
    rows = docs.drop(*OWN).withColumn("bits", hash_bits(key, text))
    rows = rows.withColumn("bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    keys = staged(rows.groupBy("bits").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "keys")
    final = staged(directory(keys, limit), "directory")
    placed = rows.join(final, "bits")
    single = placed.where(F.col("depth") <= BITS).withColumn("part", F.lit(0).cast("long"))
    if not final.where(F.col("depth") > BITS).isEmpty():
        single = single.unionByName(_copies(placed.where(F.col("depth") > BITS), limit))
    return single.select(
        *[c for c in docs.columns if c not in OWN],
        "bytes",
        F.least("depth", F.lit(BITS)).alias("depth"),
        F.when(F.col("depth") == 0, 0).otherwise(F.expr(f"shiftright(bits, {BITS} - least(depth, {BITS}))")).alias("prefix"),
        "part",
    )


def _copies(rows: DataFrame, limit: int) -> DataFrame:
    """Number the copies of each row by task and place in it, and cut them into parts that fit."""
    numbered = rows.withColumn("__task", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id())
    numbered = staged(numbered, "copies")
    sums = numbered.groupBy("bits", "__task").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("bits").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("bits", "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("bits", "__task").orderBy("__row")
    ranked = numbered.withColumn("__rank", F.row_number().over(within) - 1).join(sums, ["bits", "__task"])
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))))
    return ranked.withColumn("part", F.floor((F.col("__rank") + F.col("__before")) / each).cast("long")).drop(
        "__task", "__row", "__rank", "__before"
    )


def write_shards(assigned: DataFrame, folder: str) -> None:
    """Write the rows as Parquet, one folder for each shard; a shard's rows come from one task."""
    shard = ["depth", "prefix", "part"]
    assigned.repartition(*shard).write.partitionBy(*shard).parquet(folder)
