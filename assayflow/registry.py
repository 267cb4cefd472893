"""Registered queries: one per operator or plan, each ``(spark, folder) -> DataFrame``.

Every query reads the driver tables of ``folder`` through the role views in
``assayflow.sources.bindings`` and runs over whole tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from assayflow import constants as K
from assayflow.functions import text
from assayflow.operators import aggregates, chunking, fingerprints, standardize
from assayflow.operators import columns as cols
from assayflow.operators import filters as flt
from assayflow.operators import joins
from assayflow.operators.matrix import balanced_labels, label_dictionary, sparse_rows
from assayflow.plans import annotate, bitvectors, chunks, compounds
from assayflow.plans import screening as S
from assayflow.session import bounded_batches, shared_path, stored
from assayflow.sinks import files as sinks
from assayflow.sources import files as sources
from assayflow.sources.bindings import Tables

def _with_header(frames):
    first = True
    for frame in frames:
        yield pd.concat([pd.DataFrame({"value": ["o_orderkey\to_orderstatus"]}), frame]) if first else frame
        first = False


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _inputs(spark: SparkSession, folder: str) -> S.ScreeningInputs:
    return S.ScreeningInputs.from_tables(Tables(spark, folder))


class _Screen:
    """Shared steps of the screening queries for one folder. Lazy: building a query starts no job."""

    def __init__(self, spark: SparkSession, folder: str, restrict: bool = True):
        self.tables = Tables(spark, folder)
        self.inputs = S.ScreeningInputs.from_tables(self.tables)
        self.eps = S.endpoint_metadata(self.inputs)
        self.exp = S.experiment_table(self.inputs, S.selected_endpoint_ids(self.eps) if restrict else None)

    def rows(self) -> DataFrame:
        return S.cell_rows(self.inputs, self.eps)

    def levels(self) -> DataFrame:
        return S.level_stats(self.rows())

    def by_cell(self) -> DataFrame:
        return S.hit_stats_by_cell(self.levels())

    def by_tissue(self) -> DataFrame:
        return S.hit_stats_by_tissue(self.levels())

    def other(self) -> DataFrame:
        return S.cell_other_results(self.exp, self.eps.cell_other)

    def cytotox(self) -> DataFrame:
        return S.cytotox_estimate(self.rows())

    def cell_results(self) -> DataFrame:
        return S.cell_results(S.other_rows(self.inputs, self.eps), self.eps.cell_other, self.levels())

    def cellfree_results(self) -> DataFrame:
        return S.cellfree_results(self.exp, self.eps.cellfree)

    def cytotox_proc(self) -> DataFrame:
        return S.cytotox_with_chemical(S.cytotox_summary(self.levels()), self.inputs.chemical)


# ---------------------------------------------------------------------------
# P4: metadata selection
# ---------------------------------------------------------------------------


@query
def assay_filter_cell(spark, folder):
    return S.select_assays(Tables(spark, folder).assay())[0]


@query
def assay_filter_cellfree(spark, folder):
    return S.select_assays(Tables(spark, folder).assay())[1]


@query
def exclude_name_list(spark, folder):
    comp = Tables(spark, folder).assay_component().select("acid", "assay_component_name")
    return flt.exclude_values(comp, "assay_component_name", K.EXCLUDED_COMPONENTS)


@query
def exclude_substring(spark, folder):
    comp = Tables(spark, folder).assay_component().select("acid", "assay_component_name")
    return flt.exclude_substrings(comp, "assay_component_name", K.EXCLUDED_COMPONENT_MARKS)


@query
def component_semi_filter(spark, folder):
    t = Tables(spark, folder)
    cell_assay, cellfree_assay = S.select_assays(t.assay())
    return S.select_components(t.assay_component(), cell_assay, cellfree_assay)[0]


@query
def endpoint_semi_filter(spark, folder):
    t = Tables(spark, folder)
    cell_assay, cellfree_assay = S.select_assays(t.assay())
    cell_comp, _ = S.select_components(t.assay_component(), cell_assay, cellfree_assay)
    return flt.semi_filter(S.clean_endpoints(t.assay_component_endpoint()), cell_comp, "acid")


@query
def endpoint_metadata_join(spark, folder):
    return S.endpoint_metadata(_inputs(spark, folder)).cell


@query
def cell_viability_endpoints(spark, folder):
    return S.endpoint_metadata(_inputs(spark, folder)).cell_viability


@query
def cell_other_endpoints(spark, folder):
    return S.endpoint_metadata(_inputs(spark, folder)).cell_other


@query
def cellfree_endpoints(spark, folder):
    return S.endpoint_metadata(_inputs(spark, folder)).cellfree


# ---------------------------------------------------------------------------
# P5: experiment table
# ---------------------------------------------------------------------------


@query
def param_long_filter(spark, folder):
    return S.hit_params_long(Tables(spark, folder).mc5_param())


@query
def param_pivot(spark, folder):
    return S.hit_params_wide(Tables(spark, folder).mc5_param())


@query
def experiment_table(spark, folder):
    return S.experiment_table(_inputs(spark, folder))


@query
def experiment_table_staged(spark, folder):
    """Stores the fits by bucket when it is built."""
    return S.staged_fits(_inputs(spark, folder))


# ---------------------------------------------------------------------------
# P6: cytotoxicity
# ---------------------------------------------------------------------------


@query
def hit_stats_by_cell(spark, folder):
    return _Screen(spark, folder).by_cell()


@query
def hit_stats_by_tissue(spark, folder):
    return _Screen(spark, folder).by_tissue()


@query
def anti_join_two_keys(spark, folder):
    s = _Screen(spark, folder)
    keys = s.other().select("chid", "cell_short_name", "tissue").distinct()
    return joins.anti(keys, s.by_cell(), ["chid", "cell_short_name"])


@query
def fallback_join(spark, folder):
    s = _Screen(spark, folder)
    keys = s.other().select("chid", "cell_short_name", "tissue").distinct()
    levels = s.levels().withColumn("level", F.when(F.col("level") == 0, "cell").otherwise("tissue"))
    asked = [(["chid", "cell_short_name"], "cell"), (["chid", "tissue"], "tissue")]
    found = joins.fallback_stacked(keys, levels, ["chid", "source"], asked, tag_column="level_")
    return found.withColumnRenamed("level_", "level")


@query
def cytotox_estimate(spark, folder):
    return _Screen(spark, folder).cytotox()


# ---------------------------------------------------------------------------
# P7: results, info and hits
# ---------------------------------------------------------------------------


@query
def cellfree_results(spark, folder):
    return _Screen(spark, folder).cellfree_results()


@query
def cellfree_assay_info(spark, folder):
    return S.assay_info(_Screen(spark, folder).cellfree_results())


@query
def cellfree_hits(spark, folder):
    return S.cellfree_hits(_Screen(spark, folder).cellfree_results())


@query
def cell_results(spark, folder):
    s = _Screen(spark, folder)
    return S.prefiltered_cell_results(s.inputs, s.eps)


@query
def cell_assay_info(spark, folder):
    return S.assay_info(_Screen(spark, folder).cell_results())


@query
def cell_hits(spark, folder):
    return S.cell_hits(_Screen(spark, folder).cell_results())


@query
def cytotox_rules(spark, folder):
    return _Screen(spark, folder).cytotox_proc()


@query
def cytotox_hits(spark, folder):
    return S.cytotox_hits(_Screen(spark, folder).cytotox_proc())


# ---------------------------------------------------------------------------
# P8: binary tables
# ---------------------------------------------------------------------------


@query
def corrected_hitcall(spark, folder):
    return S.corrected_hits(_Screen(spark, folder).cell_results())


@query
def majority_vote(spark, folder):
    return S.cell_binary_long(_Screen(spark, folder).cell_results())


@query
def balanced_labels_cell(spark, folder):
    long_df = S.cell_binary_long(_Screen(spark, folder).cell_results())
    return balanced_labels(long_df, S.ENDPOINT, "corr_hitcall", min_count=BALANCE_QUERY_MIN)


@query
def cell_binary_matrix(spark, folder):
    return S.matrix_rows(S.cell_binary_long(_Screen(spark, folder).cell_results()), S.ENDPOINT, "corr_hitcall")


@query
def cell_sparse_matrix(spark, folder):
    """Stores the voted cells and numbers the labels when it is built."""
    cells = stored(S.cell_binary_long(_Screen(spark, folder).cell_results()), "cells")
    names = label_dictionary(cells, S.ENDPOINT, "corr_hitcall")
    rows = sparse_rows(cells, S.COMPOUND, S.ENDPOINT, "corr_hitcall", names)
    joined = [F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("label_ids", "cell_values")]
    return rows.select(S.COMPOUND, *joined)


@query
def cellfree_binary_matrix(spark, folder):
    return S.matrix_rows(S.cellfree_binary_long(_Screen(spark, folder).cellfree_results()), S.ENDPOINT, "hitcall")


@query
def cytotox_binary_matrix(spark, folder):
    return S.matrix_rows(S.cytotox_binary_long(_Screen(spark, folder).cytotox_proc()), "assay_label", "hitcall")


# ---------------------------------------------------------------------------
# Column operators
# ---------------------------------------------------------------------------


@query
def select_ordered(spark, folder):
    return cols.select_ordered(Tables(spark, folder).assay(), ["cell_short_name", "tissue", "timepoint_hr", "aid"])


@query
def drop_strict(spark, folder):
    return cols.drop_strict(Tables(spark, folder).assay_component(), ["assay_component_desc", "assay_design_type"])


@query
def rename_columns(spark, folder):
    return cols.rename(Tables(spark, folder).reference_targets(), {"DTXSID": "dsstox_substance_id", "support": "n"})


@query
def resolve_and_keep_columns(spark, folder):
    return bitvectors.meta_columns(_standardized_structures(spark, folder))


@query
def union_strict(spark, folder):
    s = _Screen(spark, folder)
    levels = s.levels()
    order = ["chid", "level", "source", "ntested", "nhit", "cytotox_median_ac50"]
    parts = [levels.where(F.col("level") == i).withColumn("level", F.lit(tag)) for i, tag in enumerate(["cell", "tissue"])]
    return cols.union_strict([p.select(*order) for p in parts])


@query
def union_aligned(spark, folder):
    return compounds.stack_chunks(Tables(spark, folder).document_chunks())


# ---------------------------------------------------------------------------
# P1: id chunks
# ---------------------------------------------------------------------------


@query
def distinct_ids(spark, folder):
    return chunks.distinct_ids(Tables(spark, folder).reference_targets(), "DTXSID")


@query
def chunk_ids(spark, folder):
    return chunking.chunk_ids(Tables(spark, folder).mc4(), "m4id", K.CHUNK_SIZE)


# ---------------------------------------------------------------------------
# P2: compound lists and standardization
# ---------------------------------------------------------------------------


@query
def nullsafe_inner_join(spark, folder):
    t = Tables(spark, folder)
    return joins.nullsafe_inner(t.drugs(), t.drug_structures(), "CASRN")


@query
def compound_lists(spark, folder):
    t = Tables(spark, folder)
    return compounds.attach_structures(t.drugs(), t.drug_structures(), "CASRN")


@query
def standardize_text(spark, folder):
    return _standardize(Tables(spark, folder).documents_as_structures())


@query
def standardize_single_pass(spark, folder):
    return _standardize(Tables(spark, folder).documents_as_structures(), method="single_pass")


@query
def standardize_augment(spark, folder):
    return _standardized_structures(spark, folder)


@query
def standardize_augment_distinct_first(spark, folder):
    return _standardize(Tables(spark, folder).drug_structures(), augment=True, distinct_first=True)


@query
def standardize_rejects(spark, folder):
    return standardize.rejects(_standardized_structures(spark, folder, faults=True))


def _five_words(value: str) -> str | None:
    """A normalizer that refuses short texts: what an external library does with what it cannot read."""
    words = [w for w in re.split("[ \t\n\x0b\f\r]+", value) if w]
    if value and len(words) < 5:
        raise ValueError(f"only {len(words)} words")
    return " ".join(words) if words else None


@query
def standardize_failures(spark, folder):
    table = Tables(spark, folder).drug_structures(faults=True)
    out = standardize.with_reasons(table, "SMILES", _five_words)
    return out.select("CASRN", F.md5("SMILES").alias("source_md5"), F.md5("value").alias("value_md5"), "reason")


@query
def left_join_renamed_key(spark, folder):
    t = Tables(spark, folder)
    ref = t.reference_keys().withColumnRenamed("INCHIKEY", "ref_key")
    return joins.left_renamed_key(t.compounds(), ref, "INCHIKEY", "ref_key")


@query
def standardize_fixpoint_trailing(spark, folder):
    return _standardize(Tables(spark, folder).documents_as_structures(), normalizer=text.drop_trailing("."))


@query
def standardize_fixpoint_reverse(spark, folder):
    names = Tables(spark, folder).raw("part").select(F.col("p_name").alias("SMILES"))
    return _standardize(names, normalizer=text.reverse_text)


@query
def standardize_fixpoint_rotate(spark, folder):
    return _standardize(Tables(spark, folder).documents_as_structures(), normalizer=text.rotate_left)


def _standardize(df, **options):
    return standardize.standardize(df, check_nonempty=False, **options)


def _standardized_structures(spark, folder, faults=False):
    return _standardize(Tables(spark, folder).drug_structures(faults), augment=True)


# ---------------------------------------------------------------------------
# P3: target annotation
# ---------------------------------------------------------------------------


@query
def target_counts(spark, folder):
    t = Tables(spark, folder)
    supported = annotate.supported_targets(t.reference_targets(), t.reference_keys())
    return aggregates.distinct_values(supported, "INCHIKEY", "target", "target_count")


@query
def target_lists(spark, folder):
    t = Tables(spark, folder)
    supported = annotate.supported_targets(t.reference_targets(), t.reference_keys())
    return annotate.target_summary(supported, t.compounds())


@query
def annotate_compounds(spark, folder):
    t = Tables(spark, folder)
    return annotate.annotate(t.compounds(), t.reference_targets(), t.reference_keys())


# ---------------------------------------------------------------------------
# P9: bit vectors
# ---------------------------------------------------------------------------


@query
def fingerprint_bits(spark, folder):
    bounded_batches(spark)
    docs = Tables(spark, folder).raw("documents")
    return docs.select("doc_id", F.explode(fingerprints.on_bits(F.col("text"))).alias("bit"))


@query
def fingerprint_matrix(spark, folder):
    valid = bitvectors.bit_tables(_standardized_structures(spark, folder)).valid
    return valid.select(
        *[c for c in valid.columns if c != "fingerprint"],
        fingerprints.bitstring(F.col("fingerprint")).alias("bits"),
    )


@query
def fingerprint_invalid(spark, folder):
    return bitvectors.bit_tables(_standardized_structures(spark, folder, faults=True)).invalid


# ---------------------------------------------------------------------------
# Files: a whole table is written to the shared folder when the query is built, and read again
# ---------------------------------------------------------------------------


@query
def csv_round_trip(spark, folder):
    """CSV sink and typed CSV scan (quoted line breaks included)."""
    docs = Tables(spark, folder).raw("documents").select("doc_id", "text", "lang")
    path = sinks.save_table(docs, shared_path(spark, "documents"), "csv")[0]
    return sources.read_delimited(spark, path, docs.schema, multi_line=True, sep=",")


@query
def csv_inferred(spark, folder):
    """CSV scan with types inferred from the whole file, from a path or a table, not empty."""
    part = Tables(spark, folder).raw("part").select("p_partkey", "p_name", "p_size")
    path = sinks.save_table(part, shared_path(spark, "part"), "both")[1]
    found = sources.require_nonempty(sources.read_table(spark, path))
    return sources.read_table(spark, found.select(F.col("p_partkey").cast("long"), "p_name", F.col("p_size").cast("long")))


@query
def tsv_gzip_comments(spark, folder):
    """Tab-separated, compressed text with comment lines, the delimiter from the suffix."""
    rows = Tables(spark, folder).raw("orders").select(F.col("o_orderkey").cast("string"), "o_orderstatus")
    lines = rows.select(F.explode(F.array(F.lit("! made by hand"), F.concat_ws("\t", "o_orderkey", "o_orderstatus"))).alias("value"))
    path = shared_path(spark, "orders")
    # Every part begins with the header line, as each file has one of its own.
    lines.mapInPandas(_with_header, "value string").write.option("compression", "gzip").text(path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_orderstatus", StringType())])
    return sources.read_delimited(spark, path, schema, comment=K.COMMENT_CHAR, sep=sources.delimiter_for("part.tsv.gz"))


@query
def files_by_header(spark, folder):
    """Four files, two of them with their columns the other way round: two scans, columns by name."""
    part = Tables(spark, folder).raw("part")
    paths = []
    for i in range(4):
        order = ["p_partkey", "p_name"] if i % 2 else ["p_name", "p_partkey"]
        paths.append(sinks.save_table(part.where(F.col("p_partkey") % 4 == i).select(*order), shared_path(spark, f"part-{i}"), "csv")[0])
    schema = StructType([StructField("p_partkey", LongType()), StructField("p_name", StringType())])
    return sources.read_aligned(spark, paths, schema)


@query
def parquet_round_trip(spark, folder):
    orders = Tables(spark, folder).raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return spark.read.parquet(sinks.save_table(orders, shared_path(spark, "orders"), "parquet")[0])


@query
def rejects_file(spark, folder):
    """The rows that a job turns away, written only if there are any, with the counts that came with the write."""
    table = Tables(spark, folder).drug_structures(faults=True)
    stem = shared_path(spark, "structures")
    counts = standardize.write_with_rejects(standardize.with_reasons(table, "SMILES", _five_words), stem)
    schema = StructType([StructField(c, StringType()) for c in ("CASRN", "SMILES", "value", "reason")])
    rejects = sources.read_delimited(spark, f"{stem}_rejects.csv", schema, multi_line=True)
    return rejects.groupBy("reason").agg(F.count("*").alias("n")).withColumn("written", F.lit(counts["rows"]).cast("long"))


@query
def bit_tables_written(spark, folder):
    """Bit vectors and invalid rows as files; how many rows each has comes with the writes."""
    table = Tables(spark, folder).drug_structures(faults=True)
    counts = bitvectors.write_bit_tables(table, shared_path(spark, "bits"), n_bits=64)
    return table.limit(1).select(F.lit(counts["valid"]).cast("long").alias("valid"), F.lit(counts["invalid"]).cast("long").alias("invalid"))


@query
def head_of_table(spark, folder):
    return flt.head_rows(Tables(spark, folder).raw("orders").select("o_orderkey", "o_totalprice"), 100, ["o_totalprice", "o_orderkey"])


# The rule default; at sf0.01 it already drops labels with fewer than 5 ones.
BALANCE_QUERY_MIN = K.MIN_CLASS_COUNT


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Cytotox-corrected, majority-voted hit calls per (compound, endpoint), long form."""
    return majority_vote(spark, folder)


__all__ = ["QUERIES", "flagship", "F"]
