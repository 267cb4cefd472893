"""Target annotation (P3): compounds get the distinct targets of reference
ids that share their standardized key.

Shape: reference targets ⋈ reference keys (filter on support pushed below the
join), distinct (id, target, key); semi-joined to the compound keys so only
keys that can match are aggregated; one group-by per key with map-side
de-duplication; left join back to the compounds, so a compound without a
match keeps null counts (not 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow import constants as K
from assayflow.operators import aggregates as agg
from assayflow.operators import filters as flt
from assayflow.operators import joins
from assayflow.operators.columns import rename
from assayflow.sinks.files import write_csv

KEY = "INCHIKEY"


def supported_targets(targets: DataFrame, keys: DataFrame, min_support: int = K.MIN_TARGET_SUPPORT) -> DataFrame:
    """Distinct (DTXSID, target, INCHIKEY) of reference targets with enough support."""
    ref = joins.inner(flt.at_least(targets, "support", min_support), keys.select("DTXSID", KEY), "DTXSID")
    return ref.select("DTXSID", "target", KEY).distinct()


def target_summary(supported: DataFrame, compounds: DataFrame) -> DataFrame:
    """Per key of ``compounds``: target_count, targets and DTXSID (sorted, comma-joined)."""
    matched = flt.semi_filter(supported, compounds, KEY)
    return matched.groupBy(KEY).agg(
        F.size(F.collect_set("target")).cast("long").alias("target_count"),
        agg.joined_distinct("target").alias("targets"),
        agg.joined_distinct("DTXSID").alias("DTXSID"),
    )


def annotate(
    compounds: DataFrame, targets: DataFrame, keys: DataFrame, min_support: int = K.MIN_TARGET_SUPPORT
) -> DataFrame:
    summary = target_summary(supported_targets(targets, keys, min_support), compounds)
    return joins.left(compounds, summary, KEY)


# Columns of the two standardized lists that are annotated, with their new names.
DRUG_COLUMNS = {"InChIKey_standardized": KEY, "Name": "name", "Target": "orig_target_ann"}
PESTICIDE_COLUMNS = {
    "InChIKey_standardized": KEY,
    "Descriptive name": "name",
    "CHEMBL_ID": "CHEMBL_ID",
    "ChEBI": "ChEBI",
    "Pesticide type": "Pesticide type",
}


def project(standardized: DataFrame, columns: dict[str, str]) -> DataFrame:
    return rename(standardized.select(*[f"`{c}`" for c in columns]), columns)


def annotate_lists(
    drugs: DataFrame,
    pesticides: DataFrame,
    reference: DataFrame,
    targets: DataFrame,
    min_support: int = K.MIN_TARGET_SUPPORT,
) -> dict[str, DataFrame]:
    """Both standardized lists, projected, renamed and annotated.

    ``reference`` is the standardized reference list (key and ``DTXSID``), ``targets``
    names its ids ``dsstox_substance_id``.
    """
    keys = project(reference, {"InChIKey_standardized": KEY, "DTXSID": "DTXSID"})
    named = rename(targets, {"dsstox_substance_id": "DTXSID"})
    lists = {"drugs": project(drugs, DRUG_COLUMNS), "pesticides": project(pesticides, PESTICIDE_COLUMNS)}
    return {name: annotate(df, named, keys, min_support) for name, df in lists.items()}


def write_annotations(annotated: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each annotated list as a CSV folder below ``folder``; returns their paths."""
    paths = {name: f"{folder.rstrip('/')}/{name}_annotated.csv" for name in annotated}
    for name, df in annotated.items():
        write_csv(df, paths[name])
    return paths
