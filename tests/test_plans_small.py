from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assayflow.operators.chunking import chunk_ids
from assayflow.plans import annotate


def test_columns_are_read_by_name(spark, tmp_dir):
    from assayflow.sources.files import read_aligned

    for name, text in (("a", "DTXSID,SMILES\nD1,C\n"), ("b", "SMILES,DTXSID\nCC,D2\n"), ("c", "DTXSID\nD3\n")):
        with open(f"{tmp_dir}/{name}.csv", "w") as out:
            out.write(text)
    files = [f"{tmp_dir}/{name}.csv" for name in "abc"]
    schema = StructType([StructField("DTXSID", StringType()), StructField("SMILES", StringType())])
    want = [("D1", "C"), ("D2", "CC"), ("D3", None)]
    for frame in (read_aligned(spark, files, schema), read_aligned(spark, files)):
        assert sorted((r.DTXSID, r.SMILES) for r in frame.collect()) == want


def test_chunks_put_null_first(spark):
    ids = spark.createDataFrame([(None,), ("b",), ("a",), ("c",)], "id string")
    got = {r.id: r.chunk for r in chunk_ids(ids, "id", 2, partitions=2).collect()}
    assert got == {None: 1, "a": 1, "b": 2, "c": 2}


def test_annotate_keeps_unmatched_with_null_counts(spark):
    targets = spark.createDataFrame(
        [("D1", "t2", 9), ("D1", "t1", 8), ("D2", "t1", 6), ("D3", "t3", 7)], "DTXSID string, target string, support long"
    )
    keys = spark.createDataFrame([("D1", "K1"), ("D2", "K1"), ("D3", "K1")], "DTXSID string, INCHIKEY string")
    compounds = spark.createDataFrame([("K1", "x"), ("K9", "y")], "INCHIKEY string, name string")
    out = {r.INCHIKEY: r for r in annotate.annotate(compounds, targets, keys).collect()}
    assert (out["K1"].target_count, out["K1"].targets, out["K1"].DTXSID) == (3, "t1, t2, t3", "D1, D3")
    assert out["K9"].target_count is None and out["K9"].targets is None


def test_write_bit_tables_counts_from_outputs(spark, tmp_dir):
    import os

    from assayflow.plans.bitvectors import write_bit_tables

    df = spark.createDataFrame([(1, "a b"), (2, "  "), (3, "c")], "DTXSID long, SMILES string")
    stem = os.path.join(tmp_dir, "x")
    assert write_bit_tables(df, stem, "both", n_bits=16) == {"valid": 2, "invalid": 1}
    wide = spark.read.parquet(f"{stem}_fingerprints.parquet")
    assert wide.columns[:3] == ["standardized_smiles", "DTXSID", "valid_mol"] and "morgan_15" in wide.columns


def _list(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def _three_lists(spark):
    from assayflow.plans.compounds import CompoundLists

    text = "SMILES string"
    return CompoundLists(
        pesticides=_list(
            spark,
            [("A b", "p1", "C1", "E1", "fungicide"), ("q", "p2", None, None, "other")],
            f"{text}, `Descriptive name` string, CHEMBL_ID string, ChEBI string, `Pesticide type` string",
        ),
        drugs=_list(
            spark,
            [("1-1", "old", "d1", "t0"), ("2-2", "old", "d2", None), (None, "old", "d3", None)],
            f"`CAS Number` string, {text}, Name string, Target string",
        ),
        drug_structures=_list(spark, [("1-1", "a  B"), ("2-2", ""), (None, "z")], f"`CAS Number` string, {text}"),
        reference_chunks=[
            _list(spark, [("D1", "a b")], f"DTXSID string, {text}"),
            _list(spark, [("x", "D2", "z")], f"extra string, DTXSID string, {text}"),
        ],
    )


def test_three_lists_and_two_annotations(spark, tmp_dir):
    from assayflow.plans.compounds import prepare_lists, write_lists

    inputs = _three_lists(spark)
    lists = prepare_lists(inputs)
    assert {n: df.count() for n, df in lists.items()} == {"pesticides": 2, "drugs": 1, "reference": 2}
    assert prepare_lists(inputs, null_safe=True)["drugs"].count() == 2  # a null id matches a null id only on request
    paths = write_lists(inputs, tmp_dir)
    assert spark.read.option("header", True).csv(paths["reference"]).count() == 2

    targets = _list(spark, [("D1", "t1", 7), ("D1", "t2", 9), ("D2", "t3", 8)], "dsstox_substance_id string, target string, support long")
    out = annotate.annotate_lists(lists["drugs"], lists["pesticides"], lists["reference"], targets)
    drug = out["drugs"].first()
    assert (drug["name"], drug.orig_target_ann, drug.target_count, drug.targets, drug.DTXSID) == ("d1", "t0", 2, "t1, t2", "D1")
    found = {r["name"]: (r.target_count, r["Pesticide type"]) for r in out["pesticides"].collect()}
    assert found == {"p1": (2, "fungicide"), "p2": (None, "other")}
    written = annotate.write_annotations(out, tmp_dir)
    assert spark.read.option("header", True).csv(written["pesticides"]).count() == 2


def test_a_raising_normalizer_rejects_its_row_only(spark):
    from assayflow.operators.standardize import rejects, row_safe, standardize

    def strict(value):
        if value == "bad":
            raise ValueError(value)
        return value.upper()

    df = spark.createDataFrame([("bad", 1), ("ok", 2), (None, 3)], "SMILES string, id long")
    for first in (False, True):
        out = standardize(df, normalizer=row_safe(strict), method="single_pass", augment=True, distinct_first=first)
        assert {r.id: r.SMILES_standardized for r in out.collect()} == {1: None, 2: "OK"}
        assert [r.id for r in rejects(out).collect()] == [1]
