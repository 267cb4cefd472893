import pytest
from pyspark.sql import functions as F

from assayflow.operators import filters as flt
from assayflow.operators import joins


def test_fallback_join_levels(spark):
    keys = spark.createDataFrame(
        [(1, "HepG2", "liver"), (2, "X", "liver"), (3, "X", "skin"), (4, None, "liver")],
        "chid long, cell string, tissue string",
    )
    fine = spark.createDataFrame([(1, "HepG2", 10)], "chid long, cell string, n long")
    coarse = spark.createDataFrame([(1, "liver", 20), (2, "liver", 30), (4, "liver", 40)], "chid long, tissue string, n long")
    out = joins.fallback_join(keys, [(["chid", "cell"], fine, "fine"), (["chid", "tissue"], coarse, "coarse")])
    got = {r.chid: (r.source, r.n) for r in out.collect()}
    assert got == {1: ("fine", 10), 2: ("coarse", 30), 4: ("coarse", 40)}


def test_nullsafe_join_matches_null_keys(spark):
    a = spark.createDataFrame([(None, "x"), ("k", "y")], "key string, a string")
    b = spark.createDataFrame([(None, "p"), ("k", "q")], "key string, b string")
    assert sorted((r.a, r.b) for r in joins.nullsafe_inner(a, b, "key").collect()) == [("x", "p"), ("y", "q")]
    assert [(r.a, r.b) for r in joins.inner(a, b, "key").collect()] == [("y", "q")]


def test_left_renamed_key_drops_right_key(spark):
    a = spark.createDataFrame([("s1", 1), ("s2", 2)], "orig string, v long")
    b = spark.createDataFrame([("s1", "x")], "SMILES string, other string")
    out = joins.left_renamed_key(a, b, "orig", "SMILES")
    assert out.columns == ["orig", "v", "other"]
    assert sorted(out.collect(), key=lambda r: r.orig)[1].other is None


def test_join_refuses_clashing_columns(spark):
    a = spark.createDataFrame([(1, 1)], "k long, x long")
    with pytest.raises(ValueError):
        joins.inner(a, a, "k")


def test_anti_two_keys(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b")], "c long, d string")
    b = spark.createDataFrame([(1, "a", 9)], "c long, d string, z long")
    assert [tuple(r) for r in joins.anti(a, b, ["c", "d"]).collect()] == [(1, "b")]


def test_support_threshold(spark):
    df = spark.createDataFrame([(6,), (7,), (None,)], "support long")
    assert [r[0] for r in flt.at_least(df, "support", 7).collect()] == [7]


def test_contains_is_literal(spark):
    df = spark.createDataFrame([("x_ch1",), ("xych1",), (None,)], "n string")
    assert [r[0] for r in flt.exclude_substrings(df, "n", ["_ch1"]).collect()] == ["xych1"]


def test_not_equals_drops_null_and_na_string(spark):
    df = spark.createDataFrame([("human",), ("rat",), (None,)], "o string")
    assert [r[0] for r in flt.not_equals(df, "o", "rat").collect()] == ["human"]
    df = spark.createDataFrame([("NA",), (None,), ("HepG2",)], "c string")
    assert [r[0] for r in flt.not_equals(df, "c", "NA").collect()] == ["HepG2"]


def test_semi_filter_plan_is_left_semi(spark):
    a = spark.createDataFrame([(1,), (2,)], "aid long")
    ids = spark.createDataFrame([(2,), (2,)], "aid long")
    out = flt.semi_filter(a, ids, "aid")
    assert [r[0] for r in out.collect()] == [2]
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()


def test_non_blank_and_head_rows(spark):
    df = spark.createDataFrame([("b",), ("",), (None,), ("a",)], "s string")
    assert sorted(r[0] for r in flt.non_blank(df, "s").collect()) == ["a", "b"]
    assert [r[0] for r in flt.head_rows(flt.non_blank(df, "s"), 1, ["s"]).collect()] == ["a"]


def test_fallback_join_by_shared_keys(spark):
    left = spark.createDataFrame(
        [(1, "a", "x", "r1"), (1, "a", "x", "r1"), (1, "b", "x", "r2"), (1, None, "x", "r3"), (2, "a", "y", "r4"), (None, "a", "x", "r5"), (3, "a", None, "r6")],
        "chid long, cell string, tissue string, `__v0` string",
    )
    # One finer key twice, null keys, and a value that is null where its key is found.
    fine = spark.createDataFrame([(1, "a", 10, None), (1, "a", 11, 0.5), (None, "a", 12, 0.5), (1, None, 13, 0.5)], "chid long, cell string, n long, m double")
    coarse = spark.createDataFrame([(1, "x", 20, 1.5), (2, "z", 21, 1.5), (None, "x", 22, 1.5), (3, None, 23, 1.5)], "chid long, tissue string, n long, m double")
    out = joins.fallback_join(left, [(["chid", "cell"], fine, "fine"), (["chid", "tissue"], coarse, "coarse")], "from")
    assert out.columns == ["chid", "cell", "tissue", "__v0", "n", "m", "from"]
    got = sorted(((r["__v0"], r["n"], r["m"], r["from"]) for r in out.collect()), key=str)
    once = [("r1", 10, None, "fine"), ("r1", 11, 0.5, "fine")]
    assert got == sorted([*once, *once, ("r2", 20, 1.5, "coarse"), ("r3", 20, 1.5, "coarse")], key=str)
    # Keys of which all are shared; the other columns come in another order.
    whole = joins.fallback_join(left.select("chid"), [(["chid"], fine.select("m", "n", "chid"), "f"), (["chid"], coarse.select("chid", "n", "m"), "c")])
    assert sorted(((r.chid, r.n, r.source) for r in whole.collect()), key=str) == sorted([(1, n, "f") for n in (10, 11, 13)] * 4 + [(2, 21, "c"), (3, 23, "c")], key=str)


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_prefilter_loses_no_row_that_joins(spark, monkeypatch, bits):
    monkeypatch.setattr(flt, "PREFILTER_BITS", bits)
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v")).union(spark.sql("select cast(null as long), -1L"))
    ids = spark.range(0, 3000, 20).select(F.col("id").alias("k")).union(spark.sql("select cast(null as long)"))
    kept = flt.prefilter(df, ids, "k")
    assert kept.columns == ["k", "v"]
    assert sorted(map(tuple, kept.join(ids, "k").collect())) == sorted(map(tuple, df.join(ids, "k").collect()))
    assert kept.count() < (5001 if bits == 64 else 300)
    assert flt.prefilter(df, ids.where("false"), "k").count() == 0
    other_type = flt.prefilter(df, ids.select(F.col("k").cast("int").alias("k")), "k")
    assert sorted(map(tuple, other_type.join(ids, "k").collect())) == sorted(map(tuple, df.join(ids, "k").collect()))
