"""Compound lists (P2): attach structure text to a list by a shared id,
stack id-chunk results, and standardize each list.

The structure table may have null ids. A null id matches nothing unless
``null_safe=True`` asks for the pandas rule (null matches null), whose rows
grow with the product of the null ids on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from assayflow.operators import filters as flt
from assayflow.operators import joins
from assayflow.operators.columns import drop_present, union_aligned
from assayflow.operators.standardize import standardize
from assayflow.sinks.files import write_csv


def attach_structures(
    compounds: DataFrame,
    structures: DataFrame,
    key: str,
    text: str = "SMILES",
    null_safe: bool = False,
) -> DataFrame:
    """Compounds (without their own ``text`` column) joined to structures with a non-blank ``text``."""
    left = drop_present(compounds, [text])
    right = flt.non_blank(structures, text)
    return joins.nullsafe_inner(left, right, key) if null_safe else joins.inner(left, right, key)


def stack_chunks(frames: Sequence[DataFrame]) -> DataFrame:
    """Results of several id chunks stacked by column name."""
    return union_aligned(list(frames))


def standardize_lists(lists: dict[str, DataFrame], **options) -> dict[str, DataFrame]:
    """Standardize each named list (augment mode: the list's columns are kept)."""
    return {name: standardize(df, augment=True, **options) for name, df in lists.items()}


@dataclass
class CompoundLists:
    """Inputs of the list preparation: ``drugs`` gets its texts from ``drug_structures`` by ``key``;
    ``reference_chunks`` are the results of the reference ids' chunks."""

    pesticides: DataFrame
    drugs: DataFrame
    drug_structures: DataFrame
    reference_chunks: Sequence[DataFrame]
    key: str = "CAS Number"


def prepare_lists(inputs: CompoundLists, null_safe: bool = False, **options) -> dict[str, DataFrame]:
    """The three lists, standardized: texts attached to the drugs, reference chunks stacked."""
    lists = {
        "pesticides": inputs.pesticides,
        "drugs": attach_structures(inputs.drugs, inputs.drug_structures, inputs.key, null_safe=null_safe),
        "reference": stack_chunks(inputs.reference_chunks),
    }
    return standardize_lists(lists, **options)


def write_lists(inputs: CompoundLists, folder: str, **options) -> dict[str, str]:
    """Write the three standardized lists as CSV folders below ``folder``; returns their paths."""
    paths = {}
    for name, df in prepare_lists(inputs, **options).items():
        paths[name] = f"{folder.rstrip('/')}/{name}.csv"
        write_csv(df, paths[name])
    return paths
