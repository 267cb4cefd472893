import pytest
from pyspark.sql import functions as F

from assayflow.functions import rules
from assayflow.operators import aggregates as agg
from assayflow.plans import screening as S


def test_majority_vote_ties_and_nulls_count_against(spark):
    groups = {"a": [1], "b": [1, 0], "c": [1, 1, 0], "d": [0], "e": [None], "f": [1, None]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, h long")
    out = dict(agg.majority_vote(df, ["g"], "h").collect())
    assert out == {"a": 1, "b": 0, "c": 1, "d": 0, "e": 0, "f": 0}


def _stats(spark, rows):
    df = spark.createDataFrame(rows, "chid long, cell string, hitcall double, ac50 double")
    df = df.withColumn("hitcall", rules.hit_flag("hitcall"))
    return agg.hit_stats(df, ["chid", "cell"]).collect()[0]


def test_hit_stats_threshold_is_strict(spark):
    r = _stats(spark, [(1, "x", 0.9, 1.0), (1, "x", 0.91, 4.0), (1, "x", None, 9.0)])
    assert (r.ntested, r.nhit, r.cytotox_median_ac50) == (3, 1, 4.0)


def test_hit_stats_median_interpolates(spark):
    r = _stats(spark, [(1, "x", 0.95, 1.0), (1, "x", 0.99, 4.0)])
    assert r.cytotox_median_ac50 == 2.5


def test_hit_stats_no_hit_and_all_null(spark):
    r = _stats(spark, [(1, "x", 0.1, 3.0)])
    assert (r.ntested, r.nhit, r.cytotox_median_ac50) == (1, 0, None)
    r = _stats(spark, [(1, "x", None, 3.0)])
    assert (r.ntested, r.nhit, r.cytotox_median_ac50) == (1, 0, None)


def test_corrected_hit(spark):
    df = spark.createDataFrame(
        [(10.0, 5.0, 1), (10.0, 5.1, 1), (None, 5.0, 1), (10.0, None, 1)], "c double, a double, h long"
    )
    df = df.withColumn("c", rules.with_sentinel("c"))
    got = [r[0] for r in df.select(rules.corrected_hit("h", "c", "a")).collect()]
    assert got == [1, 0, 1, 1]


def test_share_and_dose_rules(spark):
    df = spark.createDataFrame(
        [(1, 5, 50.0), (1, 6, 50.0), (1, 1, 100.0), (1, 1, 101.0), (1, 1, None)], "nhit long, ntested long, m double"
    )
    df = df.withColumn("p", rules.share("nhit", "ntested"))
    df = df.withColumn("m", rules.null_below("m", "p", 0.2)).withColumn("m", rules.null_above("m", 100.0))
    assert [r.m for r in df.collect()] == [50.0, None, 100.0, None, None]


def test_label_replaces_spaces_and_propagates_null(spark):
    df = spark.createDataFrame([("tissue", "bone marrow"), ("tissue", None)], "k string, s string")
    assert [r[0] for r in df.select(rules.label("k", "s")).collect()] == ["tissue__bone_marrow", None]


def test_distinct_values_count_and_list(spark):
    df = spark.createDataFrame([("k", "b"), ("k", None), ("k", "a"), ("k", "b"), ("n", None)], "key string, t string")
    out = {r.key: (r.cnt, r.lst) for r in agg.distinct_values(df, "key", "t", "cnt", "lst").collect()}
    assert out == {"k": (2, "a, b"), "n": (0, "")}


def test_presence_flag(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(rules.presence_flag("x")).collect()] == [1, 0]


def test_vote_drops_null_keys(spark):
    df = spark.createDataFrame(
        [("c1", "e1", 1), (None, "e1", 1), ("c1", None, 0)], "dsstox_substance_id string, assay_component_endpoint_name string, h long"
    )
    out = S.vote(df, S.ENDPOINT, "h").collect()
    assert [(r[0], r[1], r[2]) for r in out] == [("c1", "e1", 1)]


def test_hit_flag_null_stays_null(spark):
    df = spark.createDataFrame([(None,), (0.95,)], "h double")
    assert [r[0] for r in df.select(rules.hit_flag(F.col("h"))).collect()] == [None, 1]


def test_exact_median_matches_builtin_with_a_hot_group(spark):
    import random

    rnd = random.Random(7)
    rows = [("hot", None, float(rnd.randint(0, 300))) for _ in range(4000)]
    rows += [(f"g{i % 20}", "x" if i % 3 else None, float(rnd.randint(0, 40))) for i in range(600)]
    rows += [("odd", "y", 1.0), ("odd", "y", 2.0), ("odd", "y", 9.0), ("even", "y", 1.0), ("even", "y", 4.0)]
    rows += [("nullv", "z", None)]
    df = spark.createDataFrame(rows, "g string, c string, v double")
    expect = {
        (r.g, r.c): r.m for r in df.groupBy("g", "c").agg(F.median("v").alias("m")).collect() if r.m is not None
    }
    got = {(r.g, r.c): r.m for r in agg.exact_median(df, ["g", "c"], "v", "m").collect()}
    assert got == expect
    assert got[("odd", "y")] == 2.0 and got[("even", "y")] == 2.5


def test_skew_safe_hit_stats_keeps_groups_without_hits(spark):
    df = spark.createDataFrame(
        [(1, "x", 1, 4.0), (1, "x", 1, 1.0), (1, "x", 0, 9.0), (2, None, 0, 3.0)], "chid long, cell string, hitcall long, ac50 double"
    )
    out = {(r.chid, r.cell): (r.ntested, r.nhit, r.cytotox_median_ac50) for r in agg.hit_stats_skew_safe(df, ["chid", "cell"]).collect()}
    assert out == {(1, "x"): (3, 2, 2.5), (2, None): (1, 0, None)}


def test_median_and_numbering_do_not_need_exchange_reuse(spark):
    from assayflow.operators.chunking import number_rows

    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        F.when(F.col("id") % 13 > 0, ((F.col("id") * 7919) % 60013 - 20000) / 7.0).alias("v"),
        (F.col("id") % 4 > 0).cast("int").alias("hit"),
    )
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        want = {r.g: tuple(r)[1:] for r in agg.hit_stats(rows, ["g"], "hit", "v").collect()}
        got = {r.g: tuple(r)[1:] for r in agg.hit_stats_skew_safe(rows, ["g"], "hit", "v").collect()}
        assert got == want
        ids = spark.range(300000).select(((F.col("id") * 7919) % 300007).alias("k"))
        numbered = number_rows(ids, "k", partitions=6)
        assert numbered.agg(F.countDistinct("row_index"), F.max("row_index")).first()[:] == (300000, 300000)
        places = [r.k for r in numbered.orderBy("row_index").limit(1000).collect()]
        assert places == sorted(places)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_median_of_extreme_values(spark):
    inf, nan = float("inf"), float("nan")
    values = {"a": [-inf, 1e-300, inf], "b": [inf, inf], "c": [-0.0, 0.0], "d": [1e308, -1e308], "e": [1.0, nan, nan]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v double")
    got = {r.g: r.m for r in agg.exact_median(df, ["g"], "v", "m").collect()}
    assert (got["a"], got["b"], got["c"], got["d"]) == (1e-300, inf, 0.0, 0.0) and got["e"] != got["e"]
