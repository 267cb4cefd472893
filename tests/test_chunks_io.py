import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from assayflow.operators.chunking import chunk_ids
from assayflow.sinks import files as sinks
from assayflow.sources import files as src


def test_chunks_exact_sizes(spark):
    ids = spark.createDataFrame([(f"DTXSID{i:03d}",) for i in range(25)] * 2, "id string")
    out = chunk_ids(ids, "id", 10, partitions=3).collect()
    sizes = {}
    for r in out:
        sizes[r.chunk] = sizes.get(r.chunk, 0) + 1
    assert sizes == {1: 10, 2: 10, 3: 5}
    ordered = sorted(out, key=lambda r: r.id)
    assert [r.chunk for r in ordered] == sorted(r.chunk for r in out)


def test_write_chunks_one_file_each(spark, tmp_dir):
    ids = spark.createDataFrame([(i,) for i in range(25)], "id long")
    path = os.path.join(tmp_dir, "chunks")
    sinks.write_chunks(chunk_ids(ids, "id", 10, partitions=4), path)
    dirs = sorted(glob.glob(os.path.join(path, "chunk=*")))
    assert [os.path.basename(d) for d in dirs] == ["chunk=1", "chunk=2", "chunk=3"]
    for d in dirs:
        assert len(glob.glob(os.path.join(d, "part-*.csv"))) == 1


def test_delimiters():
    assert src.delimiter_for("a.csv") == ","
    assert src.delimiter_for("a.csv.gz") == ","
    assert src.delimiter_for("a.tsv") == "\t"
    assert src.delimiter_for("a.txt.gz") == "\t"
    with pytest.raises(ValueError):
        src.delimiter_for("a.json")


def test_read_csv_tsv_gzip_comments_and_na(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "a.csv")
    with open(csv, "w") as f:
        f.write("SMILES,cell\n!comment line\nC!C,NA\nCC,\n")
    df = src.read_table(spark, csv)
    rows = sorted(map(tuple, df.collect()), key=str)
    assert rows == [("C!C", "NA"), ("CC", None)]
    tsv = os.path.join(tmp_dir, "b.tsv.gz")
    with gzip.open(tsv, "wt") as f:
        f.write("SMILES\tid\nCCO\t1\n")
    assert src.read_table(spark, tsv).collect()[0].id == 1
    with pytest.raises(ValueError):
        src.read_table(spark, 42)
    assert src.read_table(spark, df) is df


def test_read_aligned_files(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "1.csv"), os.path.join(tmp_dir, "2.csv")
    open(a, "w").write("DTXSID,SMILES\nD1,C\n")
    open(b, "w").write("DTXSID,smiles_extra,SMILES\nD2,x,CC\n")
    df = src.read_aligned(spark, [a, b])
    assert sorted(df.columns) == ["DTXSID", "SMILES", "smiles_extra"] and df.count() == 2


def test_require_nonempty(spark):
    with pytest.raises(ValueError):
        src.require_nonempty(spark.createDataFrame([], "a long"))


def test_save_table_and_side_output(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    written = sinks.save_table(df, os.path.join(tmp_dir, "t"), "both")
    assert len(written) == 2 and spark.read.parquet(written[0]).count() == 1
    with pytest.raises(ValueError):
        sinks.save_table(df, os.path.join(tmp_dir, "t"), "xml")
    assert not sinks.write_if_any(df.filter(F.lit(False)), os.path.join(tmp_dir, "none.csv"))
    assert sinks.write_if_any(df, os.path.join(tmp_dir, "some.csv"))
    with pytest.raises(ValueError):
        sinks.write_csv(spark.createDataFrame([([1],)], "x array<int>"), os.path.join(tmp_dir, "arr.csv"))
