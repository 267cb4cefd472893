"""Group-by aggregates. All of them are algebraic or mergeable, so Spark runs
a partial (map-side) aggregate before the shuffle and a hot group is reduced
on every map task before it reaches one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow import constants as K
from assayflow.operators.columns import col


def nonnull_sum(name: str) -> Column:
    """Sum that gives 0, not null, for a group of only nulls."""
    return F.coalesce(F.sum(col(name)), F.lit(0)).cast("long")


def row_count() -> Column:
    """Rows per group, nulls included."""
    return F.count(F.lit(1))


def median_where(value: str, cond: Column) -> Column:
    """Exact (interpolating) median of ``value`` over rows where ``cond`` holds; null if none."""
    return F.median(F.when(cond, col(value)))


def hit_stats(
    df: DataFrame,
    keys: Sequence[str],
    hit: str = "hitcall",
    ac50: str = "ac50",
    median_name: str = "cytotox_median_ac50",
) -> DataFrame:
    """Per group: rows tested, hits, and the median AC50 of the hits.

    The exact median keeps, per group, a map of distinct AC50 -> count that
    is merged map-side, so memory follows distinct values, not rows.
    """
    return df.groupBy(*[col(k) for k in keys]).agg(
        row_count().alias("ntested"),
        nonnull_sum(hit).alias("nhit"),
        median_where(ac50, col(hit) == 1).alias(median_name),
    )


def majority_vote(df: DataFrame, keys: Sequence[str], flag: str, out: str | None = None) -> DataFrame:
    """1 when more than half of the group's rows have flag 1; ties and nulls count against."""
    return df.groupBy(*[col(k) for k in keys]).agg(
        (F.lit(2) * F.coalesce(F.sum(col(flag)), F.lit(0)) > row_count()).cast("long").alias(out or flag)
    )


def distinct_values(
    df: DataFrame,
    key: str | Sequence[str],
    value: str,
    count_name: str,
    list_name: str | None = None,
    sep: str = K.LIST_SEPARATOR,
) -> DataFrame:
    """Distinct non-null ``value`` per key: their count and (optionally) their sorted, joined list.

    One shuffle: ``collect_set`` de-duplicates on the map side, so what reaches
    the reducer of a key is bounded by its distinct values (the size of the
    result itself), not by its rows. A key whose values are all null gets
    count 0 and an empty list.
    """
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [F.size(F.collect_set(col(value))).cast("long").alias(count_name)]
    if list_name is not None:
        aggs.append(joined_distinct(value, sep).alias(list_name))
    return df.groupBy(*[col(k) for k in keys]).agg(*aggs)


def joined_distinct(value: str, sep: str = K.LIST_SEPARATOR) -> Column:
    """Distinct non-null values of a group, sorted and joined (empty string if none)."""
    return F.array_join(F.array_sort(F.collect_set(col(value).cast("string"))), sep)


#: Leading bits of a value's code that make its bucket, and those that make the part of a bucket.
BUCKET_BITS, PART_BITS = 20, 40

# What a row counts: a bucket, a part of a bucket or a value (grouping_id() of the three grouping sets).
_BUCKET, _PART, _VALUE = 3, 1, 0


def order_code(value: Column) -> Column:
    """A 64-bit integer that orders doubles as Spark does: by sign, exponent and mantissa, NaN last, both zeros equal."""
    given = F.coalesce(value + F.lit(0.0), F.lit(0.0))  # the method takes no null
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), given).cast("long")
    return F.when(value.isNotNull(), F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1))))


def _count_values(df: DataFrame, keys: Sequence[str], value: Column, hits: Column, rows: Column) -> DataFrame:
    return df.groupBy(*[col(k) for k in keys], value.alias("__v")).agg(
        rows.alias("__rows"), F.coalesce(F.sum(hits), F.lit(0)).cast("long").alias("__hits")
    )


def hit_values(df: DataFrame, keys: Sequence[str], hit: str = "hitcall", ac50: str = "ac50") -> DataFrame:
    """Rows and hits counted per (keys, AC50 of a hit); the AC50 is null for all other rows.

    The one pre-aggregate that ``hit_stats_from_values`` reads, for any subset of ``keys``.
    """
    return _count_values(df, keys, F.when(col(hit) == 1, col(ac50).cast("double")), col(hit), F.count(F.lit(1)))


def bucket_counts(counted: DataFrame, keys: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """Counts per group and bucket, part of a bucket, and value: one expand and one aggregate (GROUPING SETS)."""
    code = counted.withColumn("__code", order_code(F.col("__v")))
    code = code.withColumns({"__b": F.shiftright("__code", 64 - BUCKET_BITS), "__p": F.shiftright("__code", 64 - PART_BITS)})
    group = [col(c) for c in [*keys, *carried]]
    sets = [[*group, F.col("__b")], [*group, F.col("__b"), F.col("__p")], [*group, F.col("__b"), F.col("__p"), F.col("__v")]]
    filled = F.when(F.col("__code").isNotNull(), F.col("__rows")).otherwise(F.lit(0))
    return code.groupingSets(sets, *group, F.col("__b"), F.col("__p"), F.col("__v")).agg(
        F.grouping_id().alias("__kind"),
        F.sum("__rows").alias("__rows"),
        F.sum("__hits").alias("__hits"),
        F.sum(filled).alias("__c"),
    )


def hit_stats_from_values(
    values: DataFrame, keys: Sequence[str], median_name: str = "cytotox_median_ac50", carried: str | None = None
) -> DataFrame:
    """``hit_stats`` from ``hit_values``: rows tested, hits and exact median, no group held by one task.

    ``F.median`` would merge a group's values in one task. Here the middle ranks are found by radix
    selection on an order-preserving code of the values: the counts of a group's buckets (the leading
    ``BUCKET_BITS`` of the code) tell which holds the middle rank, the counts of that bucket's parts
    (``PART_BITS``) which part, and only inside parts are values ranked. A group's buckets
    meet in one task, and so do a bucket's parts and a part's values; a hot group is
    spread over all its parts. Every step is a window over what the step before shuffled: no part of
    the plan is evaluated twice. Interpolates like ``F.median``; null without values.

    ``carried`` names a column that is null but for rows that count nothing and only ask for
    their group's figures: these rows are returned, with the figures (null if the group has no other row).
    """
    from pyspark.sql import Window

    k = list(keys)
    riders = [carried] if carried else []
    if not carried:
        values = _count_values(values, k, F.col("__v"), F.col("__hits"), F.sum("__rows"))
    rows = bucket_counts(values, k, riders)
    asks = col(carried).isNotNull() if carried else F.lit(False)
    kind, b, part, c = F.col("__kind"), F.col("__b"), F.col("__p"), F.col("__c")
    rows = rows.where((kind == _BUCKET) & ~asks | (kind == _PART) & b.isNotNull() | (kind == _VALUE) & (b.isNotNull() | asks))
    group = [col(x) for x in k]
    names = [*k, *riders]

    # 1. Running counts: of buckets in a group, of parts in a bucket, of values in a part.
    inside = Window.partitionBy(*group, "__kind", F.when(kind != _BUCKET, b), F.when(kind == _VALUE, part))
    upto = inside.orderBy(b.asc_nulls_first(), part.asc_nulls_first(), "__v").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        *[col(x) for x in names],
        "__kind",
        "__b",
        "__p",
        "__v",
        "__c",
        (F.sum("__c").over(upto) - c).alias("__before"),
        F.row_number().over(inside.orderBy(b.asc_nulls_first(), part.asc_nulls_first(), "__v")).alias("__at"),
        F.when(kind == _BUCKET, F.struct(F.sum("__rows").over(inside).alias("rows"), F.sum("__hits").over(inside).alias("hits"), F.sum("__c").over(inside).alias("n"))).alias("__all"),
    )

    def middle(n: Column) -> Column:
        """Whether the rows of this count hold one of the middle ranks (n + 1) div 2 and n div 2 + 1."""
        return (c > 0) & (F.col("__before") < F.floor(n / 2) + 1) & (F.col("__before") + c >= F.floor((n + 1) / 2))

    # 2. The middle buckets tell their parts, then the middle parts their values, what came before and n.
    found = F.struct(F.col("__before").alias("before"), F.col("__all.n").alias("n"))
    for above, within, below in ((_BUCKET, [b, F.when(kind == _VALUE, part)], _PART), (_PART, [b, part], _VALUE)):
        told = F.when((kind == above) & middle(F.col("__all.n")), found)
        place = Window.partitionBy(*group, *within)
        rows = rows.withColumn("__told", F.max(told).over(place))
        hit = kind == below
        rows = rows.withColumns(
            {
                "__before": F.when(hit, F.col("__before") + F.col("__told.before")).otherwise(F.col("__before")),
                "__all": F.when(hit, F.struct(F.lit(None).cast("long").alias("rows"), F.lit(None).cast("long").alias("hits"), F.col("__told.n").alias("n"))).otherwise(F.col("__all")),
            }
        )
        asked = col(carried).isNotNull() if carried else F.lit(False)
        rows = rows.where((kind == _BUCKET) | (kind == _VALUE) & (F.lit(below == _PART) | middle(F.col("__all.n")) | asked) | (kind == _PART) & middle(F.col("__all.n")))
        if below == _VALUE:
            rows = rows.where((kind == _VALUE) | (kind == _BUCKET) & (F.col("__at") == 1))

    # 3. The figures of each group, on its one total row or on the rows that ask.
    whole = Window.partitionBy(*group)
    n = F.col("__all.n")

    def at(rank: Column) -> Column:
        here = (kind == _VALUE) & (F.col("__before") < rank) & (F.col("__before") + c >= rank)
        return F.max(F.when(here, F.col("__v"))).over(whole)

    total = F.max(F.when(kind == _BUCKET, F.col("__all"))).over(whole)
    out = rows.select(
        *[col(x) for x in names],
        "__kind",
        total.alias("__total"),
        at(F.floor((n + 1) / 2)).alias("__lo"),
        at(F.floor(n / 2) + 1).alias("__hi"),
    )
    out = out.where(col(carried).isNotNull() if carried else kind == _BUCKET)
    half = F.when(F.col("__total.n") % 2 == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    median = F.when(F.col("__lo") == F.col("__hi"), F.col("__lo")).otherwise(F.col("__lo") * (F.lit(1.0) - half) + F.col("__hi") * half)
    return out.select(*[col(x) for x in names], F.col("__total.rows").alias("ntested"), F.col("__total.hits").alias("nhit"), median.alias(median_name))


def hit_stats_skew_safe(
    df: DataFrame,
    keys: Sequence[str],
    hit: str = "hitcall",
    ac50: str = "ac50",
    median_name: str = "cytotox_median_ac50",
) -> DataFrame:
    """``hit_stats`` without ever holding a group in one task (see ``hit_stats_from_values``)."""
    return hit_stats_from_values(hit_values(df, keys, hit, ac50), keys, median_name)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """Exact interpolating median of ``value`` per group; null values ignored, groups without values absent."""
    counted = _count_values(
        df.where(col(value).isNotNull()), keys, col(value).cast("double"), F.lit(0), F.count(F.lit(1))
    )
    return hit_stats_from_values(counted, keys, out).drop("ntested", "nhit")
