"""Exact medians by radix selection, and the levels that share one aggregate."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from assayflow.operators import aggregates as agg
from assayflow.operators import joins
from assayflow.plans import screening as S


def _same(x, y):
    return x == y or (x is not None and y is not None and math.isnan(x) and math.isnan(y))


def test_radix_medians_equal_the_built_in(spark):
    random.seed(1)
    values = [0.0, -0.0, -1.5, 1e-9, 3.25, float("inf"), -float("inf"), None, 1e300, -1e300, 5e-324, 1.0, 1.0, 2.0]
    rows = [
        (g or None, random.choice([1, 1, 0, None]), random.choice([*values, random.random() * 1e-3, *([float("nan")] if g % 5 == 0 else [])]))
        for g in range(25)
        for _ in range(random.randrange(1, 50))
    ]
    df = spark.createDataFrame(rows, "g long, hitcall int, ac50 double")
    want = {r[0]: tuple(r)[1:] for r in agg.hit_stats(df, ["g"]).collect()}
    got = {r[0]: tuple(r)[1:] for r in agg.hit_stats_skew_safe(df, ["g"]).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][:2] == want[k][:2] and _same(got[k][2], want[k][2]) for k in want)
    none = df.limit(0)
    assert agg.hit_stats_skew_safe(none, ["g"]).count() == 0
    medians = {r.g: r.median for r in agg.exact_median(df.where("hitcall = 1"), ["g"], "ac50").collect()}
    assert all(_same(medians.get(k), want[k][2]) for k in want)


@pytest.mark.parametrize("scale, least", [(1e-8, 100), (1e-300, 100), (1e6, 100)])
def test_close_values_fill_many_buckets(spark, scale, least):
    df = spark.range(100_000).select(F.lit(1).alias("g"), (F.col("id") * scale).alias("ac50"), F.lit(1).alias("hitcall"))
    counts = agg.bucket_counts(agg.hit_values(df, ["g"]), ["g"])
    assert counts.where(F.col("__kind") == 3).count() >= least
    assert agg.hit_stats_skew_safe(df, ["g"]).first().cytotox_median_ac50 == df.agg(F.median("ac50")).first()[0]


def test_order_code_follows_the_order(spark):
    values = [-float("inf"), -1e300, -2.0, -1.0, -5e-324, 0.0, 5e-324, 1e-9, 1.0, 1.0000001, 2.0, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double")
    codes = [r.c for r in df.orderBy("i").select(agg.order_code(F.col("v")).alias("c")).collect()]
    assert codes == sorted(set(codes))
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "v double").select(agg.order_code(F.col("v")).alias("c")).collect()
    assert [r.c for r in zeros] == [0, 0, None]


def _cell_rows(spark):
    rows = [(1, "viability", "c1", "t1", 0.95, 4.0), (1, "viability", "c1", "t1", 0.99, 2.0), (1, "viability", "c2", "t1", 0.1, 9.0)]
    rows += [(1, "viability", None, "t9", 0.95, 7.0), (2, "viability", "c1", None, 0.95, 5.0)]
    rows += [(1, "other", "c1", "t1", 0.5, 1.0)] * 3 + [(1, "other", "c3", "t1", 0.5, 1.0), (1, "other", "c3", "t9", None, None)]
    rows += [(1, "other", "c4", "t4", 0.5, 1.0), (2, "other", "c4", None, 0.5, 1.0), (3, "other", "c1", "t1", 0.5, 1.0)]
    return spark.createDataFrame(rows, "chid long, branch string, cell_short_name string, tissue string, hitcall double, ac50 double")


def test_estimates_fall_back_to_the_tissue(spark):
    rows = _cell_rows(spark)
    got = sorted(tuple(r) for r in S.cytotox_estimate(rows).collect())
    assert got == [
        (1, "c1", "t1", 2, 2, 3.0, "cell_short_name"),
        (1, "c3", "t1", 3, 2, 3.0, "tissue"),
        (1, "c3", "t9", 1, 1, 7.0, "tissue"),
    ]
    levels = {(r.chid, r.level, r.source): (r.ntested, r.nhit, r.cytotox_median_ac50) for r in S.level_stats(rows).collect()}
    assert levels[(1, 0, "c2")] == (1, 0, None) and levels[(1, 1, "t1")] == (3, 2, 3.0) and levels[(2, 1, None)] == (1, 1, 5.0)
    assert S.cytotox_estimate(rows.limit(0)).count() == 0


def test_stacked_fallback_equals_level_by_level(spark):
    left = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", None), (None, "x"), ("c", "z")], "fine string, coarse string")
    fine = spark.createDataFrame([("a", 1), (None, 9)], "fine string, n long")
    coarse = spark.createDataFrame([("x", 2), ("y", 3), (None, 8)], "coarse string, n long")
    want = joins.fallback_join(left, [(["fine"], fine, "f"), (["coarse"], coarse, "c")], tag_column="tag")
    stacked = fine.selectExpr("'f' level", "fine as k", "n").union(coarse.selectExpr("'c'", "coarse", "n"))
    got = joins.fallback_stacked(left, stacked, ["k"], [(["fine"], "f"), (["coarse"], "c")], tag_column="tag")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_pass_over_the_fits(spark):
    import __spark_entry__ as entry

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = entry.queries()["cytotox_estimate"](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 21 and "ReusedExchange" not in plan
