"""Connected components of a graph given by its edges, in Spark.

Alternating large-star and small-star rounds: every node hands its larger
neighbours to its smallest one, then every node hands its smaller neighbours to
the smallest of them, until each node points at the smallest node of its
component. A node's minimum is aggregated before the shuffle, and it is joined
back between two stored tables, so that Spark can split a node with very many
neighbours. Nothing is collected but two numbers for each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import remove, staged_at

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node on an edge (a, b); root is the smallest node of the component.

    Edges may repeat, run either way or be loops; a null end is ignored. No edges: no rows."""
    spark = edges.sparkSession
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    links, path = staged_at(oriented, "links")
    before = _state(links)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select(F.col("lo"), F.col("hi")))
        least, least_path = staged_at(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        wide, wide_path = staged_at(larger, "links")
        smallest, small_path = staged_at(wide.groupBy("hi").agg(F.min("lo").alias("m")), "star")
        rest = wide.join(smallest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links, new_path = staged_at(rest.union(smallest.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        for old in (path, least_path, wide_path, small_path):
            remove(spark, old)
        path, after = new_path, _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        links.select("lo", "lo").distinct()
    )


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo") % 1_000_000_007)).first()
    return row[0], row[1]
