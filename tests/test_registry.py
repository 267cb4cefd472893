import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"

#: Queries about files and stored stages write these when they are built.
WRITING = {"chunk_ids", "experiment_table_staged", "cell_sparse_matrix", "csv_round_trip", "csv_inferred", "tsv_gzip_comments"}
WRITING |= {"files_by_header", "parquet_round_trip", "rejects_file", "bit_tables_written"}


def test_every_query_has_an_oracle():
    from assayflow.oracle import ORACLE
    from assayflow.registry import QUERIES

    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["dsstox_substance_id", "assay_component_endpoint_name", "corr_hitcall"]
    assert df.count() > 0


def test_flagship_plan_stays_in_the_jvm(spark):
    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_unused_columns_are_not_read(spark):
    df = entry.queries()["param_long_filter"](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan
    assert "l_linestatus" not in plan  # column pruning: unused columns are not read


def test_building_a_query_starts_no_job(spark, monkeypatch):
    from assayflow.registry import QUERIES
    from assayflow.sources.bindings import TABLES, Tables

    frames = {name: spark.read.parquet(f"{SMOKE}/{name}.parquet") for name in TABLES}  # reads the schemas
    monkeypatch.setattr(Tables, "raw", lambda self, name: frames[name])
    spark.sparkContext.setJobGroup("building", "registered queries")
    try:
        for name in set(QUERIES) - WRITING:
            QUERIES[name](spark, SMOKE)
            assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building"), name
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_queries_run(spark):
    qs = entry.queries()
    for name in ["chunk_ids", "annotate_compounds", "standardize_augment", "fingerprint_invalid", "union_aligned"]:
        assert qs[name](spark, SMOKE).count() > 0


def test_write_all_outputs(spark, tmp_dir):
    from assayflow.plans import screening as S
    from assayflow.sources.bindings import Tables

    written = S.write_all(S.ScreeningInputs.from_tables(Tables(spark, SMOKE)), tmp_dir)
    assert len(written) == 8
    hits = spark.read.parquet(written["cell_assay_hits"])
    assert hits.columns[0] == "dsstox_substance_id" and hits.count() > 0
    info = spark.read.option("header", True).csv(written["cell_assay_info"])
    assert info.count() > 0


def test_staged_fits_need_no_shuffle_on_their_ids(spark):
    from assayflow.plans import screening as S
    from assayflow.sources.bindings import Tables

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inputs = S.ScreeningInputs.from_tables(Tables(spark, SMOKE))
        ids = S.selected_endpoint_ids(S.endpoint_metadata(inputs))
        exp = S.staged_fits(inputs, ids)
        plan = exp._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(m5id" not in plan and "hashpartitioning(m4id" not in plan and "hashpartitioning(spid" in plan
        assert sorted(map(str, exp.collect())) == sorted(map(str, S.experiment_table(inputs, ids).select(*exp.columns).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_entry_works_without_an_optional_library():
    import subprocess
    import sys

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert 'majority_vote' in q and 'op3_simhash' not in q and 'pipeline' not in q"
    assert subprocess.run([sys.executable, "-c", code], cwd=str(__import__("pathlib").Path(entry.__file__).parent)).returncode == 0
