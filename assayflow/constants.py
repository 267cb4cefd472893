"""Rule constants and output column orders.

Everything below the "fixed values" marker must equal the values of the
screening workflow this library re-implements; results depend on them.
"""

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written)
# ---------------------------------------------------------------------------

# Minimum support of a reference target before it is used for annotation.
MIN_TARGET_SUPPORT = 7

# A fitted result counts as a hit when its hitcall is strictly above this.
HITCALL_THRESHOLD = 0.9

# Cytotoxicity estimates with a hit share below this are voided.
CYTOTOX_MIN_HIT_SHARE = 0.2

# Cytotoxicity estimates with a median AC50 above this (highest tested dose) are voided.
CYTOTOX_MAX_AC50 = 100.0

# A hit is dropped when cytotox_median_ac50 / CYTOTOX_MARGIN < ac50.
CYTOTOX_MARGIN = 2.0

# Placeholder for "no cytotoxicity known" before the margin rule.
NO_CYTOTOX_SENTINEL = 999999.0

# A label column is kept in a binary matrix only with at least this many 0s and 1s.
MIN_CLASS_COUNT = 5

# Rows per numbered id chunk.
CHUNK_SIZE = 10_000

# Rounds of the standardize fixpoint.
FIXPOINT_ROUNDS = 5

# Hashed bit-vector defaults.
FINGERPRINT_RADIUS = 2
FINGERPRINT_BITS = 2048

# Assay formats of the two branches.
CELL_BASED_FORMATS = ["cell-based", "cell line", "primary cell", "secondary cell", "primary cell co-culture"]
CELL_FREE_FORMATS = ["tissue-based cell-free", "cell-free"]

# Excluded by assay format and organism (both branches).
EXCLUDED_CELL_FORMAT = "whole embryo"
REQUIRED_ORGANISM = "human"

# Assay-name substrings removed: FOLLOWUP_MARK from both branches, the others from cell-based only.
FOLLOWUP_MARK = "Followup"
CELL_ONLY_NAME_MARKS = ["TRANS", "EcoTox"]

# Assays removed by name (cell-based only).
EXCLUDED_CELL_ASSAYS = ["CLD_6hr", "CLD_24hr", "APR_HepG2_1hr", "APR_HepG2_72hr"]

# Component-name substrings removed before the split.
EXCLUDED_COMPONENT_MARKS = ["_ch1", "_ch2"]

# Components removed by name before the split: the real-time viability read-outs,
# TOX21_RT_{HEPG2,HEK293}_{FLO,GLO}_{00,08,16,24,32}hr_viability (20 names).
EXCLUDED_COMPONENTS = [
    "TOX21_RT_HEPG2_FLO_00hr_viability",
    "TOX21_RT_HEPG2_FLO_08hr_viability",
    "TOX21_RT_HEPG2_FLO_16hr_viability",
    "TOX21_RT_HEPG2_FLO_24hr_viability",
    "TOX21_RT_HEPG2_FLO_32hr_viability",
    "TOX21_RT_HEPG2_GLO_00hr_viability",
    "TOX21_RT_HEPG2_GLO_08hr_viability",
    "TOX21_RT_HEPG2_GLO_16hr_viability",
    "TOX21_RT_HEPG2_GLO_24hr_viability",
    "TOX21_RT_HEPG2_GLO_32hr_viability",
    "TOX21_RT_HEK293_FLO_00hr_viability",
    "TOX21_RT_HEK293_FLO_08hr_viability",
    "TOX21_RT_HEK293_FLO_16hr_viability",
    "TOX21_RT_HEK293_FLO_24hr_viability",
    "TOX21_RT_HEK293_FLO_32hr_viability",
    "TOX21_RT_HEK293_GLO_00hr_viability",
    "TOX21_RT_HEK293_GLO_08hr_viability",
    "TOX21_RT_HEK293_GLO_16hr_viability",
    "TOX21_RT_HEK293_GLO_24hr_viability",
    "TOX21_RT_HEK293_GLO_32hr_viability",
]

# Design type removed from cell-based components; function type removed from all endpoints.
EXCLUDED_DESIGN_TYPE = "background reporter"
EXCLUDED_FUNCTION_TYPE = "background control"

# Cell name that marks "not stated" in the source data (a string, not a null).
NA_CELL_NAME = "NA"

# Fitted parameters kept from the long parameter table.
HIT_PARAMS = ["ac50", "hitcall"]

# Sources of a cytotoxicity estimate.
CYTOTOX_SOURCE_CELL = "cell_short_name"
CYTOTOX_SOURCE_TISSUE = "tissue"
CYTOTOX_TYPE_CELL = "cell_type"
CYTOTOX_TYPE_TISSUE = "tissue"
LABEL_SEPARATOR = "__"

# Separator of joined distinct values.
LIST_SEPARATOR = ", "

# Column order of the joined endpoint metadata.
ENDPOINT_COLUMNS = [
    "assay_component_endpoint_name",
    "assay_component_desc",
    "cell_format",
    "tissue",
    "cell_short_name",
    "timepoint_hr",
    "assay_design_type",
    "assay_function_type",
    "intended_target_type",
    "intended_target_type_sub",
    "intended_target_family",
    "intended_target_family_sub",
    "normalized_data_type",
    "signal_direction",
    "cell_viability_assay",
    "aid",
    "acid",
    "aeid",
]

# Assay-level columns kept after assay selection.
ASSAY_KEEP = ["aid", "timepoint_hr", "cell_format", "tissue", "cell_short_name"]

# Columns dropped from the component and endpoint tables.
COMPONENT_DROP = [
    "detection_technology_type",
    "detection_technology_type_sub",
    "detection_technology",
    "key_assay_reagent_type",
    "key_assay_reagent",
    "technological_target_type",
    "technological_target_type_sub",
    "parameter_readout_type",
    "assay_component_target_desc",
    "assay_design_type_sub",
    "biological_process_target",
]
ENDPOINT_DROP = [
    "export_ready",
    "internal_ready",
    "fit_all",
    "data_usability",
    "burst_assay",
    "key_positive_control",
    "assay_component_endpoint_desc",
]

# Cell-free result columns, in order.
CELLFREE_RESULT_COLUMNS = [
    "dsstox_substance_id",
    "assay_component_endpoint_name",
    "assay_component_desc",
    "cell_format",
    "tissue",
    "cell_short_name",
    "timepoint_hr",
    "assay_design_type",
    "assay_function_type",
    "intended_target_type",
    "intended_target_type_sub",
    "intended_target_family",
    "intended_target_family_sub",
    "normalized_data_type",
    "signal_direction",
    "hitcall",
    "ac50",
    "logc_max",
    "logc_min",
    "nconc",
    "aid",
    "acid",
    "aeid",
    "chid",
    "m4id",
    "m5id",
]

# Cell-based result columns, in order.
CELL_RESULT_COLUMNS = [
    "dsstox_substance_id",
    "assay_component_endpoint_name",
    "assay_component_desc",
    "cell_format",
    "tissue",
    "cell_short_name",
    "timepoint_hr",
    "assay_design_type",
    "assay_function_type",
    "intended_target_type",
    "intended_target_type_sub",
    "intended_target_family",
    "intended_target_family_sub",
    "normalized_data_type",
    "signal_direction",
    "hitcall",
    "ac50",
    "cytotox_ntested",
    "cytotox_nhit",
    "cytotox_median_ac50",
    "cytotox_source",
    "logc_max",
    "logc_min",
    "nconc",
    "aid",
    "acid",
    "aeid",
    "chid",
    "m4id",
    "m5id",
]

# Assay-info columns (both branches).
ASSAY_INFO_COLUMNS = [
    "assay_component_endpoint_name",
    "assay_component_desc",
    "cell_format",
    "tissue",
    "cell_short_name",
    "timepoint_hr",
    "assay_design_type",
    "assay_function_type",
    "intended_target_type",
    "intended_target_type_sub",
    "intended_target_family",
    "intended_target_family_sub",
    "normalized_data_type",
]

# Hit-table columns.
CELLFREE_HIT_COLUMNS = [
    "dsstox_substance_id",
    "assay_component_endpoint_name",
    "signal_direction",
    "hitcall",
    "ac50",
    "logc_max",
    "logc_min",
    "nconc",
]
CELL_HIT_COLUMNS = [
    "dsstox_substance_id",
    "assay_component_endpoint_name",
    "signal_direction",
    "hitcall",
    "ac50",
    "cytotox_ntested",
    "cytotox_nhit",
    "cytotox_median_ac50",
    "cytotox_source",
    "logc_max",
    "logc_min",
    "nconc",
]

# Cytotox summary columns before the label.
CYTOTOX_SUMMARY_COLUMNS = ["chid", "cytotox_source_type", "cytotox_source", "ntested", "nhit", "cytotox_median_ac50"]

# Candidate structure-text columns and id columns of the bit-vector job, in priority order.
STRUCTURE_COLUMNS = [
    "SMILES_standardized",
    "standardized_smiles",
    "Standardized_SMILES",
    "standardized_SMILES",
    "Canonical_SMILES_standardized",
    "canonical_smiles",
    "SMILES",
    "smiles",
]
ID_COLUMNS = [
    "DTXSID",
    "dsstox_substance_id",
    "INCHIKEY",
    "InChIKey_standardized",
    "InChIKey",
    "CHEMBL_ID",
    "ChEBI",
    "CAS Number",
    "CASRN",
    "Name",
    "name",
    "Descriptive name",
    "Pesticide type",
]

# Output columns of the standardize job.
STANDARDIZE_OUTPUTS = ["SMILES_original", "SMILES_standardized", "InChI_standardized", "InChIKey_standardized"]

# Input-file suffixes and their delimiters.
COMMA_SUFFIXES = [".csv", ".csv.gz"]
TAB_SUFFIXES = [".tsv", ".txt", ".tsv.gz", ".txt.gz"]
COMMENT_CHAR = "!"
