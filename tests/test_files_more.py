"""Scans by header, chunks by partition, counts with the write, failures with their reason."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from assayflow.operators import columns as cols
from assayflow.operators.chunking import chunk_ids
from assayflow.operators.standardize import with_reasons, write_with_rejects
from assayflow.sinks import files as sinks
from assayflow.sources import files as src


def test_two_headers_are_two_scans(spark, tmp_dir):
    names = []
    for i in range(200):
        path = os.path.join(tmp_dir, f"part {i}.csv")
        names.append(path)
        with open(path, "w") as out:
            out.write("!made by hand\n" + ("id,SMILES\n%d,C%d\n" if i % 2 else 'SMILES,"id"\nC%d,%d\n') % (i, i))
    schema = StructType([StructField("id", LongType()), StructField("SMILES", StringType())])
    for frame in (src.read_delimited(spark, names, schema, comment="!"), src.read_delimited(spark, names, comment="!")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan csv") == 2
        assert sorted((r.id, r.SMILES) for r in frame.collect()) == [(i, f"C{i}") for i in range(200)]


def test_odd_files_keep_their_own_header(spark, tmp_dir):
    texts = {"a.csv": "x,y\n1,2\n", "b.csv": "y\n5\n", "c.tsv": "x\ty\n3\t4\n", "d.csv": ""}
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "w") as out:
            out.write(text)
    schema = StructType([StructField("x", LongType()), StructField("y", LongType())])
    got = src.read_delimited(spark, [os.path.join(tmp_dir, n) for n in texts], schema).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 2), (3, 4), (None, 5)]


def test_chunk_n_is_partition_n(spark, tmp_dir):
    ids = spark.createDataFrame([(i,) for i in range(95)], "id long")
    placed = sinks.by_chunk(chunk_ids(ids, "id", 10, partitions=3)).withColumn("p", F.spark_partition_id())
    assert {(r.chunk, r.p) for r in placed.collect()} == {(n, n - 1) for n in range(1, 11)}
    path = os.path.join(tmp_dir, "chunks")
    sinks.write_chunks(chunk_ids(ids, "id", 10, partitions=3), path)
    assert len(glob.glob(os.path.join(path, "chunk=*", "part-*.csv"))) == 10
    assert sinks.by_chunk(spark.createDataFrame([], "id long, chunk long")).count() == 0


def test_failures_carry_their_reason(spark, tmp_dir):
    def _strict(value):
        if "bad" in value:
            raise ValueError(f"cannot read {value}")
        return value.upper() if value != "none" else None

    rows = [("bad 1", 1), ("ok", 2), (None, 3), ("none", 4), ("ok", 5), ("bad 1", 6), ("", 7)]
    df = spark.createDataFrame(rows, "SMILES string, __digest long")
    out = with_reasons(df, "SMILES", _strict)
    got = {r["__digest"]: (r.value, r.reason) for r in out.collect()}
    bad = (None, "ValueError: cannot read bad 1")
    assert got == {1: bad, 2: ("OK", None), 3: (None, "null"), 4: (None, "no value"), 5: ("OK", None), 6: bad, 7: ("", None)}
    stem = os.path.join(tmp_dir, "out")
    assert write_with_rejects(out, stem) == {"rows": 3, "rejects": 4}
    assert spark.read.parquet(f"{stem}.parquet").columns == ["SMILES", "__digest", "value"]
    rejects = spark.read.option("header", True).csv(f"{stem}_rejects.csv")
    assert sorted(r.reason for r in rejects.collect()) == ["ValueError: cannot read bad 1"] * 2 + ["no value", "null"]
    clean = with_reasons(df.where("SMILES = 'ok'"), "SMILES", _strict)
    assert write_with_rejects(clean, os.path.join(tmp_dir, "clean")) == {"rows": 2, "rejects": 0}
    assert not os.path.exists(os.path.join(tmp_dir, "clean_rejects.csv"))
    assert with_reasons(df.limit(0), "SMILES", _strict).count() == 0
    with pytest.raises(ValueError):
        with_reasons(df, "SMILES", _strict, out="SMILES")


def test_unresolved_column_names_both_lists(spark):
    df = spark.createDataFrame([(1, "x")], "id long, other string")
    with pytest.raises(ValueError, match="SMILES, smiles; its columns are id, other"):
        cols.resolve_column(df, ["SMILES", "smiles"], "structure")
