"""DuckDB SQL for the registered queries (the correctness oracle).

Each query is written independently of the Spark code, as plain SQL over the
driver tables, with the role views repeated as CTEs.
"""

from __future__ import annotations

from assayflow import constants as K


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _cols(names, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

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

VIEWS: dict[str, str] = {
    "chemical": "SELECT c_custkey AS chid, c_name AS dsstox_substance_id FROM customer",
    "sample": "SELECT o_orderkey AS spid, o_custkey AS chid FROM orders",
    "mc4": f"SELECT {KEY} AS m4id, l_orderkey AS spid, l_extendedprice AS logc_max, l_tax AS logc_min, "
    "l_linenumber AS nconc FROM lineitem",
    "mc5": f"SELECT 'f' || {KEY} AS m5id, {KEY} AS m4id FROM lineitem",
    "mc5_param": f"""
        SELECT 'f' || {KEY} AS m5id, l_partkey AS aeid, 'hitcall' AS hit_param, l_discount * 13 AS hit_val FROM lineitem
        UNION ALL
        SELECT 'f' || {KEY}, l_partkey, 'ac50',
               CASE WHEN l_returnflag = 'N' AND l_discount = 0 THEN NULL ELSE l_quantity * 4 END FROM lineitem
        UNION ALL
        SELECT 'f' || {KEY}, l_partkey, 'top', l_tax FROM lineitem""",
    "assay": f"""
        SELECT p_partkey AS aid,
               CASE WHEN p_partkey % 20 = 1 THEN p_brand || '_Followup'
                    WHEN p_partkey % 20 = 2 THEN p_brand || '_TRANS'
                    WHEN p_partkey % 20 = 3 THEN 'EcoTox_' || p_brand
                    WHEN p_partkey % 20 = 4 THEN
                         ['CLD_6hr', 'CLD_24hr', 'APR_HepG2_1hr', 'APR_HepG2_72hr'][(p_partkey % 80) // 20 + 1]
                    ELSE concat_ws('_', p_brand, p_type, p_partkey) END AS assay_name,
               CASE WHEN p_size % 10 = 0 THEN 'rat' ELSE 'human' END AS organism,
               [{_list(_FORMATS)}][p_partkey % 16 + 1] AS cell_format,
               (p_size % 4) * 12 AS timepoint_hr,
               CASE WHEN p_size % 23 = 0 THEN NULL
                    ELSE CASE p_type WHEN 'ECONOMY' THEN 'liver' WHEN 'LARGE' THEN 'bone marrow'
                                     WHEN 'MEDIUM' THEN 'kidney' WHEN 'PROMO' THEN 'lung'
                                     WHEN 'SMALL' THEN 'skin' WHEN 'STANDARD' THEN 'blood vessel' END
               END AS tissue,
               CASE WHEN p_size % 9 = 0 THEN 'NA' ELSE split_part(p_name, ' ', 1) END AS cell_short_name
        FROM part""",
    "assay_component": """
        SELECT p_partkey AS acid, p_partkey AS aid,
               CASE WHEN p_partkey % 25 = 5 THEN p_brand || '_ch1'
                    WHEN p_partkey % 25 = 6 THEN p_brand || '_ch2'
                    WHEN p_partkey % 25 = 7 THEN p_brand || 'xch1'
                    WHEN p_partkey % 25 = 8 THEN 'TOX21_RT_HEK293_GLO_16hr_viability'
                    WHEN p_partkey % 25 = 9 THEN 'TOX21_RT_HEPG2_FLO_00hr_viability'
                    ELSE concat_ws('_', p_brand, p_name) END AS assay_component_name,
               p_name || ' readout' AS assay_component_desc,
               CASE WHEN p_partkey % 13 = 0 THEN 'background reporter' ELSE 'inducible reporter' END
                    AS assay_design_type,
               ['protein', 'pathway', 'cellular'][p_partkey % 3 + 1] AS intended_target_type,
               lower(p_type) AS intended_target_type_sub,
               split_part(p_name, ' ', 2) AS intended_target_family,
               p_brand AS intended_target_family_sub
        FROM part""",
    "assay_component_endpoint": """
        SELECT p_partkey AS aeid, p_partkey AS acid,
               p_brand || '__' || p_type AS assay_component_endpoint_name,
               CASE WHEN p_partkey % 17 = 0 THEN 'background control' ELSE 'signaling' END AS assay_function_type,
               CASE WHEN p_size % 2 = 0 THEN 'percent_activity' ELSE 'log2_fold_induction' END
                    AS normalized_data_type,
               CASE WHEN p_partkey % 2 = 0 THEN 'gain' ELSE 'loss' END AS signal_direction,
               CAST(p_size <= 5 AS INTEGER) AS cell_viability_assay
        FROM part""",
}

_NOT_CONTAINS = lambda col, parts: " AND ".join(f"NOT contains({col}, '{p}')" for p in parts)

STEPS: dict[str, str] = {
    "cell_assay": f"""
        SELECT {_cols(K.ASSAY_KEEP)} FROM assay
        WHERE cell_format <> 'whole embryo' AND organism = 'human'
          AND cell_format IN ({_list(K.CELL_BASED_FORMATS)})
          AND {_NOT_CONTAINS("assay_name", ["Followup", "TRANS", "EcoTox"])}
          AND assay_name NOT IN ({_list(K.EXCLUDED_CELL_ASSAYS)})""",
    "cellfree_assay": f"""
        SELECT {_cols(K.ASSAY_KEEP)} FROM assay
        WHERE cell_format <> 'whole embryo' AND organism = 'human'
          AND cell_format IN ({_list(K.CELL_FREE_FORMATS)})
          AND NOT contains(assay_name, 'Followup')""",
    "comp": f"""
        SELECT * EXCLUDE (assay_component_name) FROM assay_component
        WHERE NOT contains(assay_component_name, '_ch1') AND NOT contains(assay_component_name, '_ch2')
          AND assay_component_name NOT IN ({_list(K.EXCLUDED_COMPONENTS)})""",
    "ep": "SELECT * FROM assay_component_endpoint WHERE assay_function_type <> 'background control'",
    "cell_meta": f"""
        SELECT {_cols(K.ENDPOINT_COLUMNS)} FROM comp JOIN ep USING (acid) JOIN cell_assay USING (aid)
        WHERE assay_design_type <> 'background reporter'""",
    "cellfree_meta": f"SELECT {_cols(K.ENDPOINT_COLUMNS)} FROM comp JOIN ep USING (acid) JOIN cellfree_assay USING (aid)",
    "cell_viability": "SELECT * FROM cell_meta WHERE cell_viability_assay = 1",
    "cell_other": "SELECT * FROM cell_meta WHERE cell_viability_assay = 0 AND cell_short_name <> 'NA'",
    "params": """
        SELECT m5id, aeid,
               max(CASE WHEN hit_param = 'ac50' THEN hit_val END) AS ac50,
               max(CASE WHEN hit_param = 'hitcall' THEN hit_val END) AS hitcall
        FROM mc5_param WHERE hit_param IN ('ac50', 'hitcall') GROUP BY m5id, aeid""",
    "exp": """
        SELECT m4id, spid, logc_max, logc_min, nconc, chid, m5id, aeid, ac50, hitcall, dsstox_substance_id
        FROM mc4 JOIN sample USING (spid) JOIN mc5 USING (m4id) JOIN params USING (m5id) JOIN chemical USING (chid)""",
    "viab": """
        SELECT v.aeid, v.cell_short_name, v.tissue, e.chid, e.ac50, CAST(e.hitcall > 0.9 AS BIGINT) AS hitcall
        FROM cell_viability v JOIN exp e ON v.aeid = e.aeid""",
    "by_cell": """
        SELECT chid, cell_short_name, count(*) AS ntested, CAST(coalesce(sum(hitcall), 0) AS BIGINT) AS nhit,
               median(ac50) FILTER (WHERE hitcall = 1) AS cytotox_median_ac50
        FROM viab GROUP BY chid, cell_short_name""",
    "by_tissue": """
        SELECT tissue, chid, count(*) AS ntested, CAST(coalesce(sum(hitcall), 0) AS BIGINT) AS nhit,
               median(ac50) FILTER (WHERE hitcall = 1) AS cytotox_median_ac50
        FROM viab GROUP BY tissue, chid""",
    "other": "SELECT * FROM exp JOIN cell_other USING (aeid)",
    "keys": "SELECT DISTINCT chid, cell_short_name, tissue FROM other",
    "unmatched": """
        SELECT k.* FROM keys k
        WHERE NOT EXISTS (SELECT 1 FROM by_cell b WHERE b.chid = k.chid AND b.cell_short_name = k.cell_short_name)""",
    "levels": """
        SELECT k.chid, k.cell_short_name, k.tissue, b.ntested, b.nhit, b.cytotox_median_ac50, 'cell' AS level
        FROM keys k JOIN by_cell b ON k.chid = b.chid AND k.cell_short_name = b.cell_short_name
        UNION ALL
        SELECT u.chid, u.cell_short_name, u.tissue, t.ntested, t.nhit, t.cytotox_median_ac50, 'tissue'
        FROM unmatched u JOIN by_tissue t ON u.chid = t.chid AND u.tissue = t.tissue""",
    "cyto": """
        SELECT chid, cell_short_name, tissue, ntested AS cytotox_ntested, nhit AS cytotox_nhit, cytotox_median_ac50,
               CASE level WHEN 'cell' THEN 'cell_short_name' ELSE 'tissue' END AS cytotox_source
        FROM levels""",
    "cell_res": f"""
        SELECT {_cols(K.CELL_RESULT_COLUMNS)} FROM other JOIN cyto USING (chid, cell_short_name, tissue)""",
    "cellfree_res": f"SELECT {_cols(K.CELLFREE_RESULT_COLUMNS)} FROM exp JOIN cellfree_meta USING (aeid)",
    "summary": """
        SELECT chid, 'cell_type' AS cytotox_source_type, cell_short_name AS cytotox_source, ntested, nhit,
               cytotox_median_ac50 FROM by_cell
        UNION ALL
        SELECT chid, 'tissue', tissue, ntested, nhit, cytotox_median_ac50 FROM by_tissue""",
    "proc": """
        SELECT chid, cytotox_source_type, cytotox_source, ntested, nhit,
               CASE WHEN m > 100 THEN NULL ELSE m END AS cytotox_median_ac50,
               assay_label, percent_hit, dsstox_substance_id
        FROM (
          SELECT *, CASE WHEN percent_hit < 0.2 THEN NULL ELSE cytotox_median_ac50 END AS m
          FROM (
            SELECT *, cytotox_source_type || '__' || replace(cytotox_source, ' ', '_') AS assay_label,
                   CAST(nhit AS DOUBLE) / CAST(ntested AS DOUBLE) AS percent_hit
            FROM summary)) s
        JOIN chemical USING (chid)""",
    "corr": """
        SELECT dsstox_substance_id, assay_component_endpoint_name, h AS hitcall, ac50, c AS cytotox_median_ac50,
               CASE WHEN c / 2 < ac50 THEN CAST(0 AS BIGINT) ELSE h END AS corr_hitcall
        FROM (SELECT dsstox_substance_id, assay_component_endpoint_name, ac50,
                     CAST(hitcall > 0.9 AS BIGINT) AS h, coalesce(cytotox_median_ac50, 999999.0) AS c
              FROM cell_res)""",
    "cell_long": """
        SELECT dsstox_substance_id, assay_component_endpoint_name,
               CAST(2 * coalesce(sum(corr_hitcall), 0) > count(*) AS BIGINT) AS corr_hitcall
        FROM corr
        WHERE dsstox_substance_id IS NOT NULL AND assay_component_endpoint_name IS NOT NULL
        GROUP BY 1, 2""",
    "cellfree_long": """
        SELECT dsstox_substance_id, assay_component_endpoint_name,
               CAST(2 * coalesce(sum(CAST(hitcall > 0.9 AS BIGINT)), 0) > count(*) AS BIGINT) AS hitcall
        FROM cellfree_res
        WHERE dsstox_substance_id IS NOT NULL AND assay_component_endpoint_name IS NOT NULL
        GROUP BY 1, 2""",
    "cytotox_long": """
        SELECT dsstox_substance_id, assay_label,
               CAST(2 * sum(CAST(cytotox_median_ac50 IS NOT NULL AS BIGINT)) > count(*) AS BIGINT) AS hitcall
        FROM proc
        WHERE dsstox_substance_id IS NOT NULL AND assay_label IS NOT NULL
        GROUP BY 1, 2""",
}

# Which steps each step needs (in dependency order when emitted).
_ORDER = list(VIEWS) + list(STEPS)


def with_steps(final: str, *needed: str) -> str:
    """``WITH`` clause holding every view / step up to the last one needed, then ``final``."""
    last = max(_ORDER.index(n) for n in needed)
    parts = []
    for name in _ORDER[: last + 1]:
        body = VIEWS.get(name) or STEPS[name]
        parts.append(f"{name} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n" + final


def _matrix(long_step: str, label: str, value: str, min_count: int = K.MIN_CLASS_COUNT) -> str:
    final = f"""
        , kept AS (SELECT {label} FROM {long_step} GROUP BY {label}
                   HAVING count(*) FILTER (WHERE {value} = 0) >= {min_count}
                      AND count(*) FILTER (WHERE {value} = 1) >= {min_count})
        SELECT ids.dsstox_substance_id, p.{label}, p.{value}
        FROM (SELECT DISTINCT dsstox_substance_id FROM {long_step} WHERE {label} IS NOT NULL) ids
        LEFT JOIN (SELECT dsstox_substance_id, {label}, {value} FROM {long_step}
                   WHERE {label} IN (SELECT {label} FROM kept)) p
        ON ids.dsstox_substance_id = p.dsstox_substance_id"""
    return with_steps("", long_step).rstrip() + final


ORACLE: dict[str, str] = {
    "assay_filter_cell": with_steps("SELECT * FROM cell_assay", "cell_assay"),
    "assay_filter_cellfree": with_steps("SELECT * FROM cellfree_assay", "cellfree_assay"),
    "exclude_name_list": f"""
        WITH c AS ({VIEWS["assay_component"]})
        SELECT acid, assay_component_name FROM c WHERE assay_component_name NOT IN ({_list(K.EXCLUDED_COMPONENTS)})""",
    "exclude_substring": f"""
        WITH c AS ({VIEWS["assay_component"]})
        SELECT acid, assay_component_name FROM c
        WHERE NOT contains(assay_component_name, '_ch1') AND NOT contains(assay_component_name, '_ch2')""",
    "component_semi_filter": with_steps(
        "SELECT * FROM comp WHERE aid IN (SELECT aid FROM cell_assay) AND assay_design_type <> 'background reporter'",
        "comp",
    ),
    "endpoint_semi_filter": with_steps(
        """SELECT * FROM ep WHERE acid IN (SELECT acid FROM comp WHERE aid IN (SELECT aid FROM cell_assay)
                                           AND assay_design_type <> 'background reporter')""",
        "ep",
    ),
    "endpoint_metadata_join": with_steps("SELECT * FROM cell_meta", "cell_meta"),
    "cell_viability_endpoints": with_steps("SELECT * FROM cell_viability", "cell_viability"),
    "cell_other_endpoints": with_steps("SELECT * FROM cell_other", "cell_other"),
    "cellfree_endpoints": with_steps("SELECT * FROM cellfree_meta", "cellfree_meta"),
    "param_long_filter": with_steps(
        "SELECT m5id, aeid, hit_param, hit_val FROM mc5_param WHERE hit_param IN ('ac50', 'hitcall')", "mc5_param"
    ),
    "param_pivot": with_steps("SELECT * FROM params", "params"),
    "experiment_table": with_steps("SELECT * FROM exp", "exp"),
    "hit_stats_by_cell": with_steps("SELECT * FROM by_cell", "by_cell"),
    "hit_stats_by_tissue": with_steps("SELECT * FROM by_tissue", "by_tissue"),
    "anti_join_two_keys": with_steps("SELECT * FROM unmatched", "unmatched"),
    "fallback_join": with_steps("SELECT * FROM levels", "levels"),
    "cytotox_estimate": with_steps("SELECT * FROM cyto", "cyto"),
    "cellfree_results": with_steps("SELECT * FROM cellfree_res", "cellfree_res"),
    "cellfree_assay_info": with_steps(f"SELECT DISTINCT {_cols(K.ASSAY_INFO_COLUMNS)} FROM cellfree_res", "cellfree_res"),
    "cellfree_hits": with_steps(f"SELECT DISTINCT {_cols(K.CELLFREE_HIT_COLUMNS)} FROM cellfree_res", "cellfree_res"),
    "cell_results": with_steps("SELECT * FROM cell_res", "cell_res"),
    "cell_assay_info": with_steps(f"SELECT DISTINCT {_cols(K.ASSAY_INFO_COLUMNS)} FROM cell_res", "cell_res"),
    "cell_hits": with_steps(f"SELECT DISTINCT {_cols(K.CELL_HIT_COLUMNS)} FROM cell_res", "cell_res"),
    "cytotox_rules": with_steps("SELECT * FROM proc", "proc"),
    "cytotox_hits": with_steps("SELECT DISTINCT * EXCLUDE (chid, assay_label) FROM proc", "proc"),
    "corrected_hitcall": with_steps("SELECT * FROM corr", "corr"),
    "majority_vote": with_steps("SELECT * FROM cell_long", "cell_long"),
    "balanced_labels_cell": with_steps(
        """SELECT assay_component_endpoint_name,
                  count(*) FILTER (WHERE corr_hitcall = 0) AS n_zero, count(*) FILTER (WHERE corr_hitcall = 1) AS n_one
           FROM cell_long GROUP BY 1 HAVING n_zero >= 5 AND n_one >= 5""",
        "cell_long",
    ),
    "cell_binary_matrix": _matrix("cell_long", "assay_component_endpoint_name", "corr_hitcall"),
    "cellfree_binary_matrix": _matrix("cellfree_long", "assay_component_endpoint_name", "hitcall"),
    "cytotox_binary_matrix": _matrix("cytotox_long", "assay_label", "hitcall"),
}


# ---------------------------------------------------------------------------
# Annotation, compound lists, standardization, bit vectors, chunks
# ---------------------------------------------------------------------------

ROLE = {
    "reference_targets": """
        SELECT CAST(l_partkey AS VARCHAR) AS DTXSID,
               l_returnflag || l_linestatus || '_S' || CAST(l_suppkey % 9 AS VARCHAR) AS target,
               CAST(l_quantity AS BIGINT) AS support
        FROM lineitem""",
    "reference_keys": """
        SELECT CAST(p_partkey AS VARCHAR) AS DTXSID,
               CASE WHEN (p_partkey // 4) % 2 = 0 THEN 'K' ELSE 'X' END || CAST(p_partkey // 4 AS VARCHAR) AS INCHIKEY
        FROM part""",
    "compounds": """
        SELECT 'K' || CAST(p_partkey // 4 AS VARCHAR) AS INCHIKEY, p_name AS name, p_type AS orig_target_ann
        FROM part""",
    "drugs": """
        SELECT CASE WHEN p_partkey <> 40 THEN 'CAS-' || CAST(p_partkey // 4 AS VARCHAR) END AS CASRN,
               p_name AS name, p_type AS target
        FROM part""",
    "drug_structures": """
        SELECT CASE WHEN doc_id % 50 <> 0 THEN 'CAS-' || CAST(doc_id // 3 AS VARCHAR) END AS CASRN, text AS SMILES
        FROM documents""",
    "faulty_structures": """
        SELECT CASE WHEN doc_id % 50 <> 0 THEN 'CAS-' || CAST(doc_id // 3 AS VARCHAR) END AS CASRN,
               CASE WHEN doc_id % 31 = 0 THEN NULL WHEN doc_id % 37 = 0 THEN '' ELSE text END AS SMILES
        FROM documents""",
}


def _role(final: str) -> str:
    """Role views as CTEs; ``final`` may start with ``, name AS (...)`` to add more CTEs."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ROLE.items()) + final


# Normalizers written as SQL over an input expression.
def _collapse(x: str) -> str:
    n = f"lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"
    return f"CASE WHEN {n} = '' THEN NULL ELSE {n} END"


def _drop_dot(x: str) -> str:
    return f"CASE WHEN ends_with({x}, '.') THEN left({x}, length({x}) - 1) ELSE {x} END"


def _reverse(x: str) -> str:
    return f"reverse({x})"


def _rotate(x: str) -> str:
    return f"(substr({x}, 2) || substr({x}, 1, 1))"


def _fixpoint(source: str, norm, rounds: int = K.FIXPOINT_ROUNDS, single: bool = False) -> str:
    """SELECT x, std FROM (source with column x): up to ``rounds`` applications, stop at a repeat, else the mode."""
    if single:
        return f"SELECT x, {norm('x')} AS std FROM ({source})"
    layers = [f"f0 AS (SELECT x FROM ({source}))"]
    prev = "x"
    for i in range(1, rounds + 1):
        layers.append(f"f{i} AS (SELECT *, {norm(prev)} AS r{i} FROM f{i - 1})")
        prev = f"r{i}"
    rs = [f"r{i}" for i in range(1, rounds + 1)]
    counts = [" + ".join(f"CAST({a} = {b} AS INTEGER)" for a in rs) for b in rs]
    stop = " ".join(
        [f"WHEN r1 = x THEN r1"] + [f"WHEN {rs[i]} = {rs[i - 1]} THEN {rs[i]}" for i in range(1, rounds)]
    )
    pick = " ".join(f"WHEN c{i + 1} = m THEN {r}" for i, r in enumerate(rs))
    any_null = " OR ".join(f"{r} IS NULL" for r in rs)
    return (
        "WITH "
        + ", ".join(layers)
        + f", g AS (SELECT *, {', '.join(f'({c}) AS c{i + 1}' for i, c in enumerate(counts))} FROM f{rounds})"
        + f", h AS (SELECT *, greatest({', '.join(f'c{i + 1}' for i in range(rounds))}) AS m FROM g)"
        + f" SELECT x, CASE WHEN {any_null} THEN NULL {stop} ELSE (CASE {pick} END) END AS std FROM h"
    )


def _standardized(source: str, norm=_collapse, single: bool = False) -> str:
    """Distinct non-null values of ``source`` (column x) with the four standardize outputs."""
    fx = _fixpoint(f"SELECT DISTINCT x FROM ({source}) WHERE x IS NOT NULL", norm, single=single)
    return f"""SELECT x AS SMILES_original, std AS SMILES_standardized,
                      sha256(std) AS InChI_standardized, md5(std) AS InChIKey_standardized
               FROM ({fx})"""


def _augmented(structures: str) -> str:
    return f"""
    SELECT s.*, d.CASRN FROM {structures} d
    JOIN ({_standardized(f"SELECT SMILES AS x FROM {structures}")}) s ON d.SMILES = s.SMILES_original"""


_STD_AUG = _augmented("drug_structures")
_STD_FAULTY = _augmented("faulty_structures")

_TOKENS = "list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"


def _bits(source: str, key: str, radius: int = K.FINGERPRINT_RADIUS, n_bits: int = K.FINGERPRINT_BITS) -> str:
    """Distinct (key, bit) of the token lists ``tok`` of ``source``: tokens as rows, longer n-grams by ``lead``."""
    step = f"OVER (PARTITION BY {key} ORDER BY pos)"
    grams = ["t"]
    for n in range(1, radius + 1):
        grams.append(f"{grams[-1]} || ' ' || lead(t, {n}) {step}")
    return f"""
        SELECT DISTINCT {key}, CAST(CAST(('0x' || substr(md5(g), 1, 7)) AS BIGINT) % {n_bits} AS INTEGER) AS bit
        FROM (SELECT {key}, unnest([{", ".join(grams)}]) AS g
              FROM (SELECT {key}, unnest(tok) AS t, generate_subscripts(tok, 1) AS pos FROM ({source})))
        WHERE g IS NOT NULL"""


_FP_META = f"""
    SELECT SMILES_standardized AS standardized_smiles, InChIKey_standardized, CASRN,
           coalesce(len({_TOKENS.format(x="SMILES_standardized")}) > 0, false) AS valid_mol,
           {_TOKENS.format(x="SMILES_standardized")} AS tok
    FROM std_aug"""

ORACLE.update(
    {
        "select_ordered": with_steps("SELECT cell_short_name, tissue, timepoint_hr, aid FROM assay", "assay"),
        "drop_strict": with_steps(
            "SELECT * EXCLUDE (assay_component_desc, assay_design_type) FROM assay_component", "assay_component"
        ),
        "rename_columns": _role("SELECT DTXSID AS dsstox_substance_id, target, support AS n FROM reference_targets"),
        "resolve_and_keep_columns": _role(
            f"""SELECT SMILES_standardized AS standardized_smiles, InChIKey_standardized, CASRN
                FROM ({_STD_AUG})"""
        ),
        "union_strict": with_steps(
            """SELECT chid, 'cell' AS level, cell_short_name AS source, ntested, nhit, cytotox_median_ac50 FROM by_cell
               UNION ALL
               SELECT chid, 'tissue', tissue, ntested, nhit, cytotox_median_ac50 FROM by_tissue""",
            "by_tissue",
        ),
        "union_aligned": """
            SELECT doc_id AS DTXSID, CASE WHEN doc_id % 4 = 3 THEN lang END AS lang, text AS SMILES FROM documents""",
        "distinct_ids": _role("SELECT DISTINCT DTXSID FROM reference_targets"),
        "chunk_ids": with_steps(
            f"""SELECT m4id, (row_number() OVER (ORDER BY m4id NULLS FIRST) - 1) // {K.CHUNK_SIZE} + 1 AS chunk
                FROM (SELECT DISTINCT m4id FROM mc4)""",
            "mc4",
        ),
        "nullsafe_inner_join": _role(
            """SELECT d.CASRN, d.name, d.target, s.SMILES FROM drugs d
               JOIN drug_structures s ON d.CASRN IS NOT DISTINCT FROM s.CASRN"""
        ),
        "compound_lists": _role(
            """SELECT d.CASRN, d.name, d.target, s.SMILES FROM drugs d
               JOIN drug_structures s ON d.CASRN = s.CASRN
               WHERE s.SMILES IS NOT NULL AND s.SMILES <> ''"""
        ),
        "standardize_text": _standardized("SELECT text AS x FROM documents"),
        "standardize_single_pass": _standardized("SELECT text AS x FROM documents", single=True),
        "standardize_augment": _role(_STD_AUG),
        "standardize_augment_distinct_first": _role(_STD_AUG),
        "standardize_rejects": _role(f"SELECT * FROM ({_STD_FAULTY}) WHERE SMILES_standardized IS NULL"),
        "left_join_renamed_key": _role(
            """SELECT c.INCHIKEY, c.name, c.orig_target_ann, r.DTXSID
               FROM compounds c LEFT JOIN reference_keys r ON c.INCHIKEY = r.INCHIKEY"""
        ),
        "standardize_fixpoint_trailing": _standardized("SELECT text AS x FROM documents", _drop_dot),
        "standardize_fixpoint_reverse": _standardized("SELECT p_name AS x FROM part", _reverse),
        "standardize_fixpoint_rotate": _standardized("SELECT text AS x FROM documents", _rotate),
        "fingerprint_bits": _bits(f"SELECT doc_id, {_TOKENS.format(x='text')} AS tok FROM documents", "doc_id"),
        "fingerprint_matrix": _role(
            f""", std_aug AS ({_STD_AUG}),
                 meta AS (SELECT *, row_number() OVER () AS place FROM ({_FP_META}) WHERE valid_mol),
                 lists AS (SELECT place, list(bit) AS bits
                           FROM ({_bits("SELECT place, tok FROM meta", "place")}) GROUP BY place)
               SELECT standardized_smiles, InChIKey_standardized, CASRN, valid_mol,
                      array_to_string(list_transform(range({K.FINGERPRINT_BITS}),
                          lambda b: CASE WHEN list_contains(bits, b) THEN '1' ELSE '0' END), '') AS bits
               FROM meta JOIN lists USING (place)"""
        ),
        "fingerprint_invalid": _role(
            f""", std_aug AS ({_STD_FAULTY}), meta AS ({_FP_META})
               SELECT standardized_smiles, InChIKey_standardized, CASRN, valid_mol FROM meta WHERE NOT valid_mol"""
        ),
    }
)

_SUPPORTED = """, supported AS (SELECT DISTINCT t.DTXSID, t.target, k.INCHIKEY
                     FROM reference_targets t JOIN reference_keys k ON t.DTXSID = k.DTXSID
                     WHERE t.support >= 7),
    lists AS (SELECT INCHIKEY, count(DISTINCT target) AS target_count,
                     string_agg(DISTINCT target, ', ' ORDER BY target) AS targets,
                     string_agg(DISTINCT DTXSID, ', ' ORDER BY DTXSID) AS DTXSID
              FROM supported WHERE INCHIKEY IN (SELECT INCHIKEY FROM compounds) GROUP BY INCHIKEY)
"""

ORACLE["target_counts"] = _role(
    _SUPPORTED + "SELECT INCHIKEY, count(DISTINCT target) AS target_count FROM supported GROUP BY INCHIKEY"
)
ORACLE["target_lists"] = _role(_SUPPORTED + "SELECT * FROM lists")
ORACLE["annotate_compounds"] = _role(_SUPPORTED + "SELECT * FROM compounds LEFT JOIN lists USING (INCHIKEY)")

ORACLE["experiment_table_staged"] = with_steps("SELECT * FROM exp", "exp")
ORACLE["cell_sparse_matrix"] = (
    with_steps("", "cell_long").rstrip()
    + """
    , kept AS (SELECT assay_component_endpoint_name, row_number() OVER (ORDER BY assay_component_endpoint_name) - 1 AS id
               FROM (SELECT assay_component_endpoint_name FROM cell_long GROUP BY 1
                     HAVING count(*) FILTER (WHERE corr_hitcall = 0) >= 5 AND count(*) FILTER (WHERE corr_hitcall = 1) >= 5))
    SELECT c.dsstox_substance_id,
           coalesce(string_agg(CAST(k.id AS VARCHAR), ',' ORDER BY k.id), '') AS label_ids,
           coalesce(string_agg(CAST(CASE WHEN k.id IS NOT NULL THEN c.corr_hitcall END AS VARCHAR), ',' ORDER BY k.id), '') AS cell_values
    FROM cell_long c LEFT JOIN kept k USING (assay_component_endpoint_name) GROUP BY 1"""
)
_REFUSED = f"""
    SELECT CASRN, SMILES, {_TOKENS.format(x="SMILES")} AS tok,
           CASE WHEN SMILES IS NULL THEN 'null' WHEN SMILES = '' THEN 'no value'
                WHEN len({_TOKENS.format(x="SMILES")}) < 5 THEN 'ValueError: only ' || len({_TOKENS.format(x="SMILES")}) || ' words' END AS reason
    FROM faulty_structures"""
ORACLE["standardize_failures"] = _role(
    f"""SELECT CASRN, md5(SMILES) AS source_md5, CASE WHEN reason IS NULL THEN md5(array_to_string(tok, ' ')) END AS value_md5, reason
        FROM ({_REFUSED})"""
)
ORACLE["rejects_file"] = _role(
    f""", refused AS ({_REFUSED})
        SELECT reason, count(*) AS n, (SELECT count(*) FROM refused WHERE reason IS NULL) AS written
        FROM refused WHERE reason IS NOT NULL GROUP BY reason"""
)
ORACLE["csv_round_trip"] = "SELECT doc_id, text, lang FROM documents"
ORACLE["csv_inferred"] = "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part"
ORACLE["tsv_gzip_comments"] = "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus FROM orders"
ORACLE["files_by_header"] = "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name FROM part"
ORACLE["parquet_round_trip"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"
ORACLE["bit_tables_written"] = _role(
    f"""SELECT count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid
        FROM (SELECT coalesce(len({_TOKENS.format(x="SMILES")}) > 0, false) AS ok FROM faulty_structures)"""
)
ORACLE["head_of_table"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100"
