"""Join operators. All are equi-joins; the physical strategy is left to Spark:
AQE turns a sort-merge join into a broadcast hash join only when it has
measured a side below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and
splits skewed partitions of a sort-merge join (``skewJoin``), so a hot key
does not land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.operators.columns import col, quote


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _overlap(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in right.columns if c in left.columns and c not in keys]


def inner(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner equi-join; null keys never match."""
    keys = _keys(key)
    clash = _overlap(left, right, keys)
    if clash:
        raise ValueError(f"non-key columns on both sides: {clash}; project one side first")
    return left.join(right, on=keys, how="inner")


def left(left_df: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = _keys(key)
    clash = _overlap(left_df, right, keys)
    if clash:
        raise ValueError(f"non-key columns on both sides: {clash}; project one side first")
    return left_df.join(right, on=keys, how="left")


def nullsafe_inner(left_df: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join where a null key matches a null key (pandas ``merge`` semantics).

    Null keys of both sides meet in one shuffle partition: with many nulls on
    both sides this is a product, exactly as in the source semantics.
    """
    keys = _keys(key)
    r = right.select(*[col(c).alias(f"__r_{c}") if c in keys else col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left_df[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    out = left_df.join(r, on=cond, how="inner")
    return out.drop(*[f"__r_{k}" for k in keys])


def left_renamed_key(left_df: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on differently named keys; the right key column is dropped."""
    r = right.withColumnRenamed(right_key, "__rk")
    out = left_df.join(r, left_df[left_key] == r["__rk"], "left")
    return out.drop("__rk")


def anti(left_df: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = _keys(key)
    return left_df.join(right.select(*keys), on=keys, how="left_anti")


def fallback_join(
    left_df: DataFrame,
    levels: Sequence[tuple[Sequence[str], DataFrame, str]],
    tag_column: str = "source",
) -> DataFrame:
    """Hierarchical fallback join.

    ``levels`` is a list of ``(keys, right, tag)`` from the finest to the
    coarsest key. Each left row is matched at the first level whose keys it
    finds on the right and tagged with that level's ``tag``; rows unmatched at
    every level are dropped. The right sides have the same non-key columns.

    Keys that all levels share join once: the levels' rows are gathered for each of their values, as many as it has finer
    keys, and the other keys are compared there, so the left side is shuffled once whatever the levels.
    Without shared keys there is one left join for each level, which looks only at rows still unmatched. Neither
    way reads the left side or a level twice.
    """
    values = [c for c in levels[0][1].columns if c not in levels[0][0]]
    shared = [c for c in levels[0][0] if all(c in keys for keys, _, _ in levels)]
    if shared:
        return _fallback_shared(left_df, levels, shared, values, tag_column)
    out = left_df.withColumn(tag_column, F.lit(None).cast("string"))
    for i, (keys, right, tag) in enumerate(levels):
        keys = list(keys)
        side = right.select(
            *[col(c).alias(f"__k{i}_{c}") for c in keys], *[col(c).alias(f"__v{i}_{c}") for c in values]
        ).withColumn(f"__t{i}", F.lit(tag))
        match = [out[c] == side[f"__k{i}_{c}"] for c in keys] + [out[tag_column].isNull()]
        out = out.join(side, match, "left").withColumn(tag_column, F.coalesce(col(tag_column), F.col(f"__t{i}")))
    picked = [
        F.coalesce(*[F.when(F.col(f"__t{i}").isNotNull(), F.col(f"__v{i}_{c}")) for i in range(len(levels))]).alias(c)
        for c in values
    ]
    return out.where(col(tag_column).isNotNull()).select(*[col(c) for c in left_df.columns], *picked, col(tag_column))


def _fallback_shared(
    left_df: DataFrame, levels: Sequence[tuple[Sequence[str], DataFrame, str]], shared: list[str], values: list[str], tag_column: str
) -> DataFrame:
    """``fallback_join`` by the keys that all levels share."""
    mark = "__"  # begins no name of the left side
    while any(c.startswith(mark) for c in left_df.columns):
        mark += "_"
    own = [col(c) for c in left_df.columns]
    keyed = {c: f"{mark}s{n}" for n, c in enumerate(shared)}
    valued = {c: f"{mark}v{n}" for n, c in enumerate(values)}
    lists, tagged = [f"{mark}l{i}" for i in range(len(levels))], f"{mark}tag"

    def answers(name: str, rest: list[str]) -> Column:
        """The answers of one level whose other keys are the row's."""
        same = [lambda x, n=n, c=c: x[f"k{n}"] == col(c) for n, c in enumerate(rest)]
        fits = F.filter(F.col(name), lambda x: reduce(lambda a, b: a & b, [s(x) for s in same], F.lit(True)))
        return F.transform(fits, lambda x: F.struct(*[x[v].alias(v) for v in [*valued.values(), tagged]]))

    sides, found = [], []
    for name, (keys, right, tag) in zip(lists, levels, strict=True):
        rest = [c for c in keys if c not in shared]
        row = [col(c).alias(f"k{n}") for n, c in enumerate(rest)] + [col(c).alias(v) for c, v in valued.items()]
        known = right.dropna(subset=[quote(c) for c in keys])  # a null key matches nothing
        sides.append(known.select(*[col(c).alias(s) for c, s in keyed.items()], F.struct(*row, F.lit(tag).alias(tagged)).alias(name)))
        found.append(answers(name, rest).alias(name))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    gathered = stacked.groupBy(*keyed.values()).agg(*[F.collect_list(name).alias(name) for name in lists])
    met = left_df.join(gathered, [left_df[quote(c)] == gathered[s] for c, s in keyed.items()]).select(*own, *found)
    met = met.select(*own, F.inline(F.coalesce(*[F.when(F.size(name) > 0, F.col(name)) for name in lists])))
    return met.select(*own, *[F.col(v).alias(c) for c, v in valued.items()], F.col(tagged).alias(tag_column))


def fallback_stacked(
    left_df: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    levels: Sequence[tuple[Sequence[str], str]],
    level_column: str = "level",
    tag_column: str = "source",
) -> DataFrame:
    """``fallback_join`` against one table of all levels, in one join and one aggregate.

    ``levels`` lists ``(left columns, tag)`` from the finest to the coarsest; ``right`` has a row for each
    level (its tag in ``level_column``) and ``keys``. Each left row asks for all its levels at once
    and keeps the finest that answers; a null key gets no answer.
    """
    values = [c for c in right.columns if c not in (*keys, level_column)]
    asks = [
        F.struct(F.lit(tag).alias("__tag"), *[col(c).alias(f"__k{i}") for i, c in enumerate(cols)]) for cols, tag in levels
    ]
    # A left row keeps its identity, as equal rows are rows of their own (numbered before they are multiplied).
    rows = left_df.select("*", F.monotonically_increasing_id().alias("__id")).select(F.struct("*").alias("__row"), F.array(*asks).alias("__asks"))
    probes = rows.select("__row", F.posexplode("__asks").alias("__rank", "__ask"))
    match = [probes["__ask.__tag"] == right[quote(level_column)]]
    match += [probes[f"__ask.__k{i}"] == right[quote(k)] for i, k in enumerate(keys)]
    answer = F.struct(F.col("__ask.__tag").alias("__tag"), *[right[quote(c)] for c in values])
    best = probes.join(right, match).groupBy("__row").agg(F.min_by(answer, "__rank").alias("__best"))
    own = [F.col(f"__row.{quote(c)}").alias(c) for c in left_df.columns]
    return best.select(*own, *[F.col(f"__best.{quote(c)}").alias(c) for c in values], F.col("__best.__tag").alias(tag_column))
