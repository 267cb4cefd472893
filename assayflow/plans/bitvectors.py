"""Bit-vector table (P9): resolve the structure and id columns, hash each
text to a bit vector, split valid from invalid rows, write both.

A map-only job: no shuffle between the read and the writes. Only the valid
write hashes texts; the counts come with the writes (``observe``), nothing is read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from assayflow import constants as K
from assayflow.operators import fingerprints as fp
from assayflow.operators.columns import col, keep_present, resolve_column
from assayflow.session import bounded_batches
from assayflow.sinks.files import save_table, write_if_any

TEXT = "standardized_smiles"


def meta_columns(df: DataFrame) -> DataFrame:
    """Structure column (renamed ``standardized_smiles``) first, then the id columns present."""
    source = resolve_column(df, K.STRUCTURE_COLUMNS, "SMILES")
    keep = keep_present(df, K.ID_COLUMNS, first=source)
    return df.select(*[col(c).alias(TEXT) if c == source else col(c) for c in keep])


@dataclass
class BitTables:
    valid: DataFrame
    invalid: DataFrame


def bit_tables(df: DataFrame, radius: int = K.FINGERPRINT_RADIUS, n_bits: int = K.FINGERPRINT_BITS) -> BitTables:
    """Valid rows with ``fingerprint`` (array of 0/1 bytes) and invalid rows (null or blank text)."""
    bounded_batches(df.sparkSession)
    meta = meta_columns(df).withColumn("valid_mol", fp.is_valid(F.col(TEXT)))
    valid = meta.filter(F.col("valid_mol")).withColumn(
        "fingerprint", fp.dense(fp.on_bits(F.col(TEXT), radius, n_bits), n_bits)
    )
    invalid = meta.filter(~F.col("valid_mol"))
    return BitTables(valid, invalid)


def write_bit_tables(
    df: DataFrame,
    stem: str,
    fmt: str = "parquet",
    radius: int = K.FINGERPRINT_RADIUS,
    n_bits: int = K.FINGERPRINT_BITS,
) -> dict[str, int]:
    """Write ``stem_fingerprints`` (wide ``morgan_<i>`` columns) and, if any, ``stem_invalid_smiles.csv``."""
    tables = bit_tables(df, radius, n_bits)
    valid, invalid = Observation("valid"), Observation("invalid")
    rows = F.count(F.lit(1)).alias("rows")
    save_table(fp.widen(tables.valid, "fingerprint", n_bits).observe(valid, rows), f"{stem}_fingerprints", fmt)
    wrote_invalid = write_if_any(tables.invalid, f"{stem}_invalid_smiles.csv", invalid)
    return {"valid": valid.get["rows"], "invalid": invalid.get["rows"] if wrote_invalid else 0}
