"""Results of primary cell endpoints on hand-made fits, and what the fits are shuffled by."""

import re

import pytest
from pyspark.sql import functions as F

from assayflow.operators import joins
from assayflow.plans import screening as S


def _plan(spark, df):
    """The plan without broadcasts and adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _inputs(spark):
    """Endpoints 1 (viability, c1/t1), 2 (other, c1/t1), 3 (other, c2/t1), 4 (other, c3/t3), 5 (other, no tissue)."""
    where = {1: ("c1", "t1"), 2: ("c1", "t1"), 3: ("c2", "t1"), 4: ("c3", "t3"), 5: ("c1", None)}
    assay = [(k, f"a{k}", "human", "cell line", 24, t, c) for k, (c, t) in where.items()]
    component = [(k, k, f"n{k}", "d", "inducible reporter", "x", "y", "z", "w") for k in where]
    endpoint = [(k, k, f"e{k}", "signaling", "gain", "up", int(k == 1)) for k in where]
    # fit, endpoint, sample, hitcall, ac50
    fits = [("1", 1, 1, 0.95, 4.0), ("2", 1, 1, 0.99, 2.0), ("3", 2, 1, 0.5, 1.0), ("4", 3, 1, 0.95, 8.0), ("5", 4, 1, 0.95, 8.0)]
    fits += [("6", 5, 1, 0.95, 8.0), ("7", 2, 2, 0.95, None), ("8", 2, None, 0.95, 1.0), ("9", 2, 9, 0.95, 1.0)]
    params = [(f"f{m}", e, p, v) for m, e, _, h, a in fits for p, v in (("hitcall", h), ("ac50", a), ("top", 9.0))]
    make = spark.createDataFrame
    return S.ScreeningInputs(
        assay=make(assay, "aid long, assay_name string, organism string, cell_format string, timepoint_hr int, tissue string, cell_short_name string"),
        assay_component=make(
            component,
            "acid long, aid long, assay_component_name string, assay_component_desc string, assay_design_type string, intended_target_type string, "
            "intended_target_type_sub string, intended_target_family string, intended_target_family_sub string",
        ),
        assay_component_endpoint=make(
            endpoint,
            "aeid long, acid long, assay_component_endpoint_name string, assay_function_type string, normalized_data_type string, "
            "signal_direction string, cell_viability_assay int",
        ),
        mc4=make([(m, s, 1.0, 2.0, 3) for m, _, s, _, _ in fits], "m4id string, spid long, logc_max double, logc_min double, nconc long"),
        sample=make([(1, 10), (2, 20), (3, None), (None, 10)], "spid long, chid long"),
        mc5=make([(f"f{m}", m) for m, *_ in fits] + [(None, "1")], "m5id string, m4id string"),
        mc5_param=make(params, "m5id string, aeid long, hit_param string, hit_val double"),
        chemical=make([(10, "D10"), (10, "D10b"), (20, "D20")], "chid long, dsstox_substance_id string"),
    )


def test_figures_come_from_the_cell_else_the_tissue(spark):
    inputs = _inputs(spark)
    eps = S.endpoint_metadata(inputs)
    levels = S.level_stats(S.cell_rows(inputs, eps))
    rows = S.cell_results(S.other_rows(inputs, eps), eps.cell_other, levels).collect()
    # A sample's chemical is there twice, so its fits are, and the viability fits count twice; fits 5 to 9 find nothing.
    got = sorted((r.m4id, r.dsstox_substance_id, r.aeid, r.cytotox_source, r.cytotox_ntested, r.cytotox_nhit, r.cytotox_median_ac50) for r in rows)
    assert got == [
        ("3", "D10", 2, "cell_short_name", 4, 4, 3.0),
        ("3", "D10b", 2, "cell_short_name", 4, 4, 3.0),
        ("4", "D10", 3, "tissue", 4, 4, 3.0),
        ("4", "D10b", 3, "tissue", 4, 4, 3.0),
    ]
    # the estimates for each (chid, cell, tissue) say the same
    estimate = S.cytotox_estimate(S.cell_rows(inputs, eps))
    other = S.cell_other_results(S.experiment_table(inputs, S.selected_endpoint_ids(eps)), eps.cell_other)
    names = S.K.CELL_RESULT_COLUMNS
    want = joins.inner(other, estimate, ["chid", "cell_short_name", "tissue"]).select(*names).collect()
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_metadata_joins_last_and_is_not_shuffled_on(spark, no_broadcast):
    import __spark_entry__ as entry

    plan = _plan(spark, entry.queries()["cell_results"](spark, "/root/testdata/sf0.001"))
    # Only the joins of assays, components and endpoints shuffle the description, before any fit is joined with it.
    assert plan.index("SortMergeJoin [aeid") < plan.index("SortMergeJoin [chid")
    assert "hashpartitioning(chid" in plan and not re.search(r"hashpartitioning\(chid#\w+, cell_short_name#\w+, tissue#\w+, \d+\)", plan)


def test_the_pivot_shuffles_once_with_its_join(spark, no_broadcast):
    inputs = _inputs(spark)
    whole = S.experiment_table(inputs)
    assert whole.columns == ["chid", "spid", "m4id", "m5id", "aeid", "ac50", "hitcall", "logc_max", "logc_min", "nconc", "dsstox_substance_id"]
    plan = _plan(spark, whole)
    # Fits: by m5id (parameters and ids), by m4id (both sides), by spid; chemicals meet the samples, not the fits.
    assert plan.count("hashpartitioning(m5id") == 2
    assert not re.search(r"hashpartitioning\(m5id#\w+, aeid", plan)
    assert plan.count("Exchange hashpartitioning") == 8
    got = sorted((r.m4id, r.dsstox_substance_id) for r in whole.collect())
    assert got == sorted([(m, d) for m in "123456" for d in ("D10", "D10b")] + [("7", "D20")])


def test_staged_fits_store_two_tables(spark):
    inputs = _inputs(spark)
    before = {t.name for t in spark.catalog.listTables()}
    staged = S.staged_fits(inputs)
    stored = sorted(t.name.split("_")[0] for t in spark.catalog.listTables() if t.name not in before)
    assert stored == ["fits", "mc4"]
    assert sorted(map(str, staged.collect())) == sorted(map(str, S.experiment_table(inputs).select(*staged.columns).collect()))


def test_parameters_of_other_endpoints_are_not_shuffled(spark, no_broadcast):
    inputs = _inputs(spark)
    eps = S.endpoint_metadata(inputs)
    got = S.prefiltered_cell_results(inputs, eps)
    want = S.cell_results(S.other_rows(inputs, eps), eps.cell_other, S.level_stats(S.cell_rows(inputs, eps)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns


def test_cell_results_filter_parameters_and_shuffle_rows_by_chid_once(spark, no_broadcast):
    import __spark_entry__ as entry

    plan = _plan(spark, entry.queries()["cell_results"](spark, "/root/testdata/sf0.001"))
    assert re.search(r"BroadcastHashJoin \[\(?shiftright\(.*LeftSemi", plan)
    # The cytotox figures of both levels are met in one join by chid; no row is shuffled by cell or by tissue for them.
    assert not re.search(r"hashpartitioning\(chid#\w+, (cell_short_name|tissue)#\w+, \d+\)", plan)
