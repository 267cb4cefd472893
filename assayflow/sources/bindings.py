"""Role views over the driver's parquet tables.

The screening workflow reads an assay database (assays, components,
endpoints, fits, samples, chemicals), a reference target list and compound
lists. None of these ship with the test data, so each role is played by a
projection of a driver table. Every view is a plain ``select`` over one
parquet scan, so Catalyst prunes columns and pushes filters into the scan, and
the views grow with the data they are read from.

| role | driver table |
|---|---|
| chemical(chid, dsstox_substance_id) | customer |
| sample(spid, chid) | orders |
| mc4 / mc5 / mc5_param (one fit per line) | lineitem |
| assay / component / endpoint | part |
| reference targets | lineitem ⋈ part |
| compound lists | part, documents |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow import constants as K

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def _first_word(col: str) -> Column:
    return F.substring_index(F.col(col), " ", 1)


def _last_word(col: str) -> Column:
    return F.substring_index(F.col(col), " ", -1)


def fit_key() -> Column:
    """Unique key of one fitted result (one lineitem)."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


class Tables:
    """Lazy access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- assay database roles -------------------------------------------------

    def chemical(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("chid"), F.col("c_name").alias("dsstox_substance_id")
        )

    def sample(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("spid"), F.col("o_custkey").alias("chid"))

    def mc4(self) -> DataFrame:
        return self.raw("lineitem").select(
            fit_key().alias("m4id"),
            F.col("l_orderkey").alias("spid"),
            F.col("l_extendedprice").alias("logc_max"),
            F.col("l_tax").alias("logc_min"),
            F.col("l_linenumber").alias("nconc"),
        )

    def mc5(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.concat(F.lit("f"), fit_key()).alias("m5id"), fit_key().alias("m4id")
        )

    def mc5_param(self) -> DataFrame:
        """Long parameter table: hitcall, ac50 and a decoy parameter per fit."""
        li = self.raw("lineitem")
        ac50 = F.when((F.col("l_returnflag") == "N") & (F.col("l_discount") == 0), F.lit(None)).otherwise(
            F.col("l_quantity") * 4
        )
        return li.select(
            F.concat(F.lit("f"), fit_key()).alias("m5id"),
            F.col("l_partkey").alias("aeid"),
            F.stack(
                F.lit(3),
                F.lit("hitcall"),
                F.col("l_discount") * 13,
                F.lit("ac50"),
                ac50.cast("double"),
                F.lit("top"),
                F.col("l_tax"),
            ).alias("hit_param", "hit_val"),
        )

    def assay(self) -> DataFrame:
        p = self.raw("part")
        key = F.col("p_partkey")
        name = (
            F.when(key % 20 == 1, F.concat("p_brand", F.lit("_Followup")))
            .when(key % 20 == 2, F.concat("p_brand", F.lit("_TRANS")))
            .when(key % 20 == 3, F.concat(F.lit("EcoTox_"), "p_brand"))
            .when(key % 20 == 4, F.element_at(F.array(*[F.lit(n) for n in _NAMED]), (key % 80 / 20 + 1).cast("int")))
            .otherwise(F.concat_ws("_", "p_brand", "p_type", key.cast("string")))
        )
        fmt = F.element_at(F.array(*[F.lit(v) for v in _FORMATS]), (key % 16 + 1).cast("int"))
        tissue = F.when(F.col("p_size") % 23 == 0, F.lit(None)).otherwise(
            F.element_at(F.create_map(*[F.lit(x) for kv in _TISSUES.items() for x in kv]), F.col("p_type"))
        )
        cell = F.when(F.col("p_size") % 9 == 0, F.lit("NA")).otherwise(_first_word("p_name"))
        return p.select(
            key.alias("aid"),
            name.alias("assay_name"),
            F.when(F.col("p_size") % 10 == 0, F.lit("rat")).otherwise(F.lit("human")).alias("organism"),
            fmt.alias("cell_format"),
            ((F.col("p_size") % 4) * 12).alias("timepoint_hr"),
            tissue.alias("tissue"),
            cell.alias("cell_short_name"),
        )

    def assay_component(self) -> DataFrame:
        p = self.raw("part")
        key = F.col("p_partkey")
        name = (
            F.when(key % 25 == 5, F.concat("p_brand", F.lit("_ch1")))
            .when(key % 25 == 6, F.concat("p_brand", F.lit("_ch2")))
            .when(key % 25 == 7, F.concat("p_brand", F.lit("xch1")))
            .when(key % 25 == 8, F.lit("TOX21_RT_HEK293_GLO_16hr_viability"))
            .when(key % 25 == 9, F.lit("TOX21_RT_HEPG2_FLO_00hr_viability"))
            .otherwise(F.concat_ws("_", "p_brand", "p_name"))
        )
        return p.select(
            key.alias("acid"),
            key.alias("aid"),
            name.alias("assay_component_name"),
            F.concat(F.col("p_name"), F.lit(" readout")).alias("assay_component_desc"),
            F.when(key % 13 == 0, F.lit("background reporter")).otherwise(F.lit("inducible reporter")).alias(
                "assay_design_type"
            ),
            F.element_at(F.array(F.lit("protein"), F.lit("pathway"), F.lit("cellular")), (key % 3 + 1).cast("int")).alias(
                "intended_target_type"
            ),
            F.lower("p_type").alias("intended_target_type_sub"),
            _last_word("p_name").alias("intended_target_family"),
            F.col("p_brand").alias("intended_target_family_sub"),
        )

    def assay_component_endpoint(self) -> DataFrame:
        p = self.raw("part")
        key = F.col("p_partkey")
        return p.select(
            key.alias("aeid"),
            key.alias("acid"),
            F.concat(F.col("p_brand"), F.lit("__"), F.col("p_type")).alias("assay_component_endpoint_name"),
            F.when(key % 17 == 0, F.lit("background control")).otherwise(F.lit("signaling")).alias(
                "assay_function_type"
            ),
            F.when(F.col("p_size") % 2 == 0, F.lit("percent_activity"))
            .otherwise(F.lit("log2_fold_induction"))
            .alias("normalized_data_type"),
            F.when(key % 2 == 0, F.lit("gain")).otherwise(F.lit("loss")).alias("signal_direction"),
            (F.col("p_size") <= 5).cast("int").alias("cell_viability_assay"),
        )

    # -- annotation roles -----------------------------------------------------

    def reference_targets(self) -> DataFrame:
        """(DTXSID, target, support): one row per lineitem, id = part key."""
        return self.raw("lineitem").select(
            F.col("l_partkey").cast("string").alias("DTXSID"),
            F.concat(
                F.col("l_returnflag"), F.col("l_linestatus"), F.lit("_S"), (F.col("l_suppkey") % 9).cast("string")
            ).alias("target"),
            F.col("l_quantity").cast("long").alias("support"),
        )

    def reference_keys(self) -> DataFrame:
        """(DTXSID, INCHIKEY): standardized keys of the reference ids, every second of which no compound has."""
        group = compound_group()
        return self.raw("part").select(
            F.col("p_partkey").cast("string").alias("DTXSID"),
            F.concat(F.when(group % 2 == 0, F.lit("K")).otherwise(F.lit("X")), group.cast("string")).alias("INCHIKEY"),
        )

    def compounds(self) -> DataFrame:
        """(INCHIKEY, name, orig_target_ann): compounds to annotate, four to a key."""
        return self.raw("part").select(
            F.concat(F.lit("K"), compound_group().cast("string")).alias("INCHIKEY"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("orig_target_ann"),
        )

    def drugs(self) -> DataFrame:
        """(CASRN, name, target): four drugs to a CAS number, one drug without any."""
        key = F.col("p_partkey")
        return self.raw("part").select(
            F.when(key != 40, F.concat(F.lit("CAS-"), F.floor(key / 4).cast("string"))).alias("CASRN"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("target"),
        )

    def documents_as_structures(self) -> DataFrame:
        """(DTXSID, SMILES): every document's whole text as a structure text."""
        return self.raw("documents").select(F.col("doc_id").alias("DTXSID"), F.col("text").alias("SMILES"))

    def document_chunks(self) -> list[DataFrame]:
        """Four id-chunk result files whose headers differ (the last one has an extra column)."""
        d = self.raw("documents")
        frames = [
            d.filter(F.col("doc_id") % 4 == i).select(F.col("doc_id").alias("DTXSID"), F.col("text").alias("SMILES"))
            for i in range(3)
        ]
        frames.append(
            d.filter(F.col("doc_id") % 4 == 3).select(
                F.col("doc_id").alias("DTXSID"), F.col("lang"), F.col("text").alias("SMILES")
            )
        )
        return frames

    def drug_structures(self, faults: bool = False) -> DataFrame:
        """(CASRN, SMILES): a whole text per row, three to a CAS number, some without one.

        ``faults`` adds null and blank texts, for the queries about rows that cannot be standardized.
        """
        doc = F.col("doc_id")
        whole = F.col("text")
        return self.raw("documents").select(
            F.when(doc % 50 != 0, F.concat(F.lit("CAS-"), F.floor(doc / 3).cast("string"))).alias("CASRN"),
            (F.when(doc % 31 == 0, F.lit(None)).when(doc % 37 == 0, F.lit("")).otherwise(whole) if faults else whole).alias(
                "SMILES"
            ),
        )


def compound_group() -> Column:
    return F.floor(F.col("p_partkey") / 4)


# Binding vocabularies (not rule constants).
_NAMED = list(K.EXCLUDED_CELL_ASSAYS)
_FORMATS = [
    "whole embryo",
    "cell-free",
    "tissue-based cell-free",
    "cell-free",
    "cell line",
    "primary cell",
    "secondary cell",
    "primary cell co-culture",
    "organism",
    "cell-based",
    "cell-based",
    "cell-based",
    "cell line",
    "cell-based",
    "primary cell",
    "cell-based",
]
_TISSUES = {
    "ECONOMY": "liver",
    "LARGE": "bone marrow",
    "MEDIUM": "kidney",
    "PROMO": "lung",
    "SMALL": "skin",
    "STANDARD": "blood vessel",
}
