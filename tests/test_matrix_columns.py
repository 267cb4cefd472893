import pytest
from pyspark.sql import functions as F

from assayflow.operators import columns as cols
from assayflow.operators.matrix import assert_unique, balanced_labels, binary_matrix, binary_rows, label_dictionary, pivot_known, sparse_rows, write_wide_blocks


def _long(spark, spec):
    rows = []
    i = 0
    for label, (zeros, ones) in spec.items():
        for v in [0] * zeros + [1] * ones:
            rows.append((f"c{i}", label, v))
            i += 1
    rows.append((f"c{i}", "A", None))
    return spark.createDataFrame(rows, "id string, label string, v long")


def test_balance_filter(spark):
    df = _long(spark, {"A": (5, 5), "B": (4, 5), "C": (5, 4), "D": (5, 5)})
    kept = sorted(r.label for r in balanced_labels(df, "label", "v", 5).collect())
    assert kept == ["A", "D"]


def test_pivot_keeps_compounds_of_dropped_labels(spark):
    df = _long(spark, {"A": (5, 5), "B": (1, 1)})
    wide = binary_matrix(df, "id", "label", "v", ["A"])
    assert "B" not in wide.columns and "A" in wide.columns
    assert wide.count() == df.select("id").distinct().count()
    b_only = df.filter(F.col("label") == "B").select("id").first()[0]
    assert wide.filter(F.col("id") == b_only).first()["A"] is None


def test_pivot_known_fails_on_duplicate_cell(spark):
    ok = spark.createDataFrame([(1, 7, "ac50", 1.0), (1, 7, "hitcall", 0.5)], "m5id long, aeid long, p string, v double")
    row = pivot_known(ok, ["m5id", "aeid"], "p", "v", ["ac50", "hitcall"]).first()
    assert (row.ac50, row.hitcall) == (1.0, 0.5)
    dup = ok.unionByName(spark.createDataFrame([(1, 7, "ac50", 2.0)], ok.schema))
    with pytest.raises(Exception, match="more than one row"):
        pivot_known(dup, ["m5id", "aeid"], "p", "v", ["ac50", "hitcall"]).collect()
    with pytest.raises(ValueError):
        assert_unique(dup.filter(F.col("p") == "ac50"), ["m5id", "aeid"])


def test_pivot_then_unpivot_is_long_form(spark):
    df = _long(spark, {"A": (5, 5), "B": (6, 5)}).dropna()
    wide = binary_matrix(df, "id", "label", "v", ["A", "B"])
    back = wide.unpivot("id", ["A", "B"], "label", "v").dropna()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_binary_rows_keep_every_compound_once(spark):
    df = _long(spark, {"A": (5, 5), "B": (1, 1)})
    rows = binary_rows(df, "id", "label", "v", 5).collect()
    assert {r.id for r in rows} == {r.id for r in df.select("id").collect()}
    assert {r.label for r in rows} == {"A", None}
    twice = df.union(df.limit(1))
    with pytest.raises(Exception, match="more than one row"):
        binary_rows(twice, "id", "label", "v", 5).collect()


def test_wide_matrix_has_no_label_limit(spark):
    df = spark.createDataFrame([("c", "l0", 1)], "id string, label string, v long")
    assert len(binary_matrix(df, "id", "label", "v", [f"l{i}" for i in range(10_001)]).columns) == 10_002


def test_resolve_column(spark):
    df = spark.createDataFrame([(1, "x")], "id long, smiles string")
    assert cols.resolve_column(df, ["SMILES", "smiles"], "SMILES") == "smiles"
    with pytest.raises(ValueError, match="none of the columns"):
        cols.resolve_column(df, ["SMILES"], "SMILES")


def test_keep_present_puts_key_first(spark):
    df = spark.createDataFrame([(1, "x", "n")], "CASRN long, s string, name string")
    assert cols.keep_present(df, ["name", "CASRN", "missing"], first="s") == ["s", "name", "CASRN"]


def test_case_variant_validation(spark):
    both = spark.createDataFrame([("a", "b")], "SMILES string, smiles string")
    neither = spark.createDataFrame([("a",)], "other string")
    only = spark.createDataFrame([("a",)], "smiles string")
    with pytest.raises(ValueError):
        cols.normalize_case_variant(both)
    with pytest.raises(ValueError):
        cols.normalize_case_variant(neither)
    assert cols.normalize_case_variant(only).columns == ["SMILES"]


def test_strict_drop_rename_and_unions(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    with pytest.raises(ValueError):
        cols.drop_strict(df, ["c"])
    assert cols.drop_strict(df, ["b"]).columns == ["a"]
    assert cols.rename(df, {"a": "x"}).columns == ["x", "b"]
    other = spark.createDataFrame([(1, 2)], "a int, b long")
    with pytest.raises(ValueError):
        cols.union_strict([df, other])
    assert cols.union_strict([df, df]).count() == 2
    extra = spark.createDataFrame([(3, "z")], "a long, c string")
    aligned = cols.union_aligned([df, extra])
    assert sorted(aligned.columns) == ["a", "b", "c"] and aligned.count() == 2


def test_select_ordered_with_dotted_name(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` long, c long")
    assert cols.select_ordered(df, ["c", "a.b"]).columns == ["c", "a.b"]


def test_sparse_rows_and_wide_blocks(spark, tmp_dir):
    df = _long(spark, {"A": (5, 5), "B": (1, 1), "C.x": (5, 5), "D": (6, 5)}).dropna()
    names = label_dictionary(df, "label", "v", 5)
    assert sorted(map(tuple, names.collect())) == [("A", 0), ("C.x", 1), ("D", 2)]
    rows = sparse_rows(df, "id", "label", "v", names)
    got = {r.id: dict(zip(r.label_ids, r.cell_values, strict=True)) for r in rows.collect()}
    number = {r.label: r.label_id for r in names.collect()}
    want = {}
    for r in df.collect():
        want.setdefault(r.id, {}).update({number[r.label]: r.v} if r.label in number else {})
    assert got == want
    paths = write_wide_blocks(rows, names, "id", "label", tmp_dir, width=2)
    assert len(paths) == 2
    first, second = (spark.read.parquet(p) for p in paths)
    assert first.columns == ["id", "A", "C.x"] and second.columns == ["id", "D"] and second.count() == len(want)
    assert {r["id"]: r["C.x"] for r in first.collect()} == {i: cells.get(1) for i, cells in want.items()}
    twice = df.union(df.where("label = 'A'").limit(1))
    with pytest.raises(Exception, match="more than one row"):
        sparse_rows(twice, "id", "label", "v", names).collect()
    with pytest.raises(Exception, match="more than one row"):
        binary_matrix(twice, "id", "label", "v", ["A", "D"]).collect()
    assert sparse_rows(df.limit(0), "id", "label", "v", names).count() == 0
