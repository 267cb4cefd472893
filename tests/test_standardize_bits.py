import pytest
from pyspark.sql import functions as F

from assayflow.functions import text
from assayflow.operators import fingerprints as fp
from assayflow.operators.standardize import fixpoint, rejects, standardize
from assayflow.plans.bitvectors import bit_tables


def _fix(spark, value, fn):
    df = spark.createDataFrame([(value,)], "s string")
    return df.select(fixpoint(fn, F.col("s")).alias("r")).first().r


def test_fixpoint_converges(spark):
    assert _fix(spark, "x!!", text.drop_trailing("!")) == "x"


def test_fixpoint_no_convergence_takes_first(spark):
    assert _fix(spark, "x" + "!" * 9, text.drop_trailing("!")) == "x" + "!" * 8


def test_fixpoint_two_cycle_takes_mode(spark):
    assert _fix(spark, "ab", text.reverse_text) == "ba"


def test_fixpoint_tie_goes_to_first_seen(spark):
    assert _fix(spark, "abc", text.rotate_left) == "bca"


def test_fixpoint_null_round_gives_null(spark):
    assert _fix(spark, "a", lambda c: F.when(c == "a", F.lit("b")).otherwise(F.lit(None).cast("string"))) is None


def test_standardize_distinct_and_augment(spark):
    df = spark.createDataFrame([(" A ", 1), ("a", 2), (None, 3), ("a", 4)], "SMILES string, id long")
    plain = standardize(df)
    assert plain.count() == 2
    assert sorted(r.SMILES_standardized for r in plain.collect()) == ["a", "a"]
    aug = standardize(df, augment=True)
    assert sorted(r.id for r in aug.collect()) == [1, 2, 4]
    assert "SMILES" not in aug.columns and aug.columns[:4] == [
        "SMILES_original",
        "SMILES_standardized",
        "InChI_standardized",
        "InChIKey_standardized",
    ]
    rows = {r.id: r for r in aug.collect()}
    assert rows[1].InChIKey_standardized == rows[2].InChIKey_standardized
    same = standardize(df, augment=True, distinct_first=True)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, aug.collect()))


def test_standardize_rejects_and_validation(spark):
    df = spark.createDataFrame([("  ",), ("x",)], "smiles string")
    out = standardize(df)
    assert [r.SMILES_original for r in rejects(out).collect()] == ["  "]
    assert rejects(out).first().InChIKey_standardized is None
    with pytest.raises(ValueError):
        standardize(df, method="other")
    with pytest.raises(ValueError):
        standardize(spark.createDataFrame([], "SMILES string"))
    limited = standardize(spark.createDataFrame([("b",), ("a",), ("c",)], "SMILES string"), limit_rows=2, order_by=["SMILES"])
    assert sorted(r.SMILES_original for r in limited.collect()) == ["a", "b"]


def test_bit_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "a b")], "DTXSID long, SMILES_standardized string")
    t = bit_tables(df, radius=2, n_bits=64)
    assert sorted(r.DTXSID for r in t.invalid.collect()) == [1, 2, 3]
    row = t.valid.first()
    assert row.DTXSID == 4 and set(row.fingerprint) <= {0, 1} and len(row.fingerprint) == 64
    bits = df.filter("DTXSID = 4").select(fp.on_bits(F.col("SMILES_standardized"), 2, 64).alias("b")).first().b
    assert [i for i, v in enumerate(row.fingerprint) if v == 1] == bits
    assert 1 <= len(bits) <= 3  # features: a, b, "a b"


def test_dense_round_trip_full_width(spark):
    df = spark.createDataFrame([([0, 63, 64, 2047],)], "bits array<int>")
    dense = df.select(fp.dense(F.col("bits"), 2048).alias("d")).first().d
    assert [i for i, v in enumerate(dense) if v] == [0, 63, 64, 2047]
    wide = fp.widen(df.select(fp.dense(F.col("bits"), 8).alias("d")), "d", 8)
    assert wide.columns == [f"morgan_{i}" for i in range(8)]


def test_bits_against_hashlib(spark):
    import hashlib
    import random

    from assayflow.operators import hashing

    random.seed(2)
    words = ["a", "bé", "", "x" * 40, "y" * 70, "\t", "\n", "z" * 300]
    texts = [None, "", "  ", "a", " a  b\tc\n", *[" ".join(random.choices(words, k=random.randrange(30))) for _ in range(60)], "w " * 3000 + "end"]

    def slow(text, radius, n_bits):
        tok = (text or "").encode().split()
        grams = [b" ".join(tok[i : i + n]) for n in range(1, radius + 2) for i in range(len(tok) - n + 1)]
        return sorted({int(hashlib.md5(g).hexdigest()[:7], 16) % n_bits for g in grams})

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2)
    for radius, n_bits in [(2, 2048), (0, 64), (3, 100)]:
        got = {r.i: r.b for r in df.select("i", fp.on_bits(F.col("t"), radius, n_bits).alias("b")).collect()}
        assert all(got[i] == slow(t, radius, n_bits) for i, t in enumerate(texts))
    packed = df.limit(0).select(fp.packed(fp.on_bits(F.col("t"))).alias("p"))
    assert packed.count() == 0
    row = spark.createDataFrame([([0, 63, 64, 130],)], "b array<int>").select(fp.packed(F.col("b"), 192).alias("p"), fp.bitstring(fp.dense(F.col("b"), 140)).alias("s")).first()
    assert row.p == [1 - (1 << 63), 1, 4] and [i for i, c in enumerate(row.s) if c == "1"] == [0, 63, 64, 130] and len(row.s) == 140
    assert hashing.BLOCK_BYTES > 0


@pytest.mark.parametrize("first", [False, True])
def test_settled_values_are_not_normalized_again(spark, tmp_dir, first):
    from collections import Counter
    from pathlib import Path

    from assayflow.operators.standardize import row_safe

    log = Path(tmp_dir) / f"calls-{first}"

    def counting(value):
        with open(log, "a") as out:
            out.write(value + "\n")
        return value[:-1] if value.endswith("!") else value

    df = spark.createDataFrame([("a", 1), ("b!", 2), ("c!!!", 3), ("d!!!!!!!!!", 4), (None, 5)], "SMILES string, id long").coalesce(1)
    out = {r.id: r.SMILES_standardized for r in standardize(df, normalizer=row_safe(counting), augment=True, distinct_first=first).collect()}
    assert out == {1: "a", 2: "b", 3: "c", 4: "d!!!!!!!!"}
    calls = Counter(line[0] for line in log.read_text().split())
    assert calls == {"a": 1, "b": 2, "c": 4, "d": 5}


def _batch_bytes(spark, build, rows):
    """The largest batch of 1 MB texts that a Python step gets after ``build``."""
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        texts = spark.range(rows, numPartitions=1).select(F.repeat(F.lit("word "), 200_000).alias("SMILES"), F.col("id").alias("DTXSID"))
        build(texts)

        @F.arrow_udf("long")
        def size(values: pa.Array) -> pa.Array:
            return pa.array([values.nbytes] * len(values), pa.int64())

        return texts.select(size("SMILES").alias("n")).agg(F.max("n")).first()[0]
    finally:
        spark.conf.set(key, before)


def test_reasons_are_asked_in_bounded_batches(spark):
    from assayflow.operators.standardize import with_reasons

    assert _batch_bytes(spark, lambda df: with_reasons(df, "SMILES", str.strip), 30) <= 10_000_000


def test_bit_tables_get_bounded_batches(spark):
    assert _batch_bytes(spark, bit_tables, 30) <= 10_000_000
