"""Standardize a text column and derive keys for joining.

The job around a per-value normalizer: validate the input, normalize every
distinct non-null value (as a fixpoint of up to ``rounds`` applications, or
one pass), derive a long and a short hashed key, route failures to null
outputs, and optionally carry the input's other columns along.

Two physical shapes give the same rows:

* the normalizer is a Column expression (default): it is evaluated in the
  row's own projections, with no shuffle at all; duplicates of a value cost
  a cheap evaluation or two each;
* the normalizer is expensive (a ``pandas_udf`` around a Python library):
  ``distinct_first=True`` normalizes each distinct value once after one
  shuffle and joins the results back on the original value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from assayflow import constants as K
from assayflow.functions import text
from assayflow.functions.arrays import let
from assayflow.operators.columns import col, drop_present, normalize_case_variant
from assayflow.operators.filters import head_rows
from assayflow.session import bounded_batches, cut_lineage, hand_back
from assayflow.sinks.files import write_csv
from assayflow.sources.files import require_nonempty

Normalizer = Callable[[Column], Column]
METHODS = ("fixpoint", "single_pass")


def default_normalizer(c: Column) -> Column:
    """Collapse whitespace, trim, lower-case; a blank value cannot be standardized (null)."""
    return let(text.collapse_space(c), lambda norm: F.when(norm != F.lit(""), norm))


def row_safe(fn: Callable[[str], str | None]) -> Normalizer:
    """A normalizer from a Python function, for libraries Spark has no expression for.

    A value for which ``fn`` raises gets null, so its row goes to the rejects and
    the task goes on. Runs on Arrow batches; use it with ``distinct_first=True``.
    """
    def one(value):
        if value is None:
            return None
        try:
            return fn(value)
        except Exception:  # whatever the library raises for a value it cannot handle
            return None

    @F.pandas_udf("string")
    def normalized(values: pd.Series) -> pd.Series:
        return pd.Series([one(v) for v in values], index=values.index, dtype=object)

    # Not to be repeated by the optimizer, e.g. in a filter on its result: it is the dear part.
    return _PythonNormalizer(normalized.asNondeterministic())


def with_reasons(df: DataFrame, column: str, fn: Callable[[str], str | None], out: str = "value", reason: str = "reason") -> DataFrame:
    """``df`` with ``fn`` of a text column and, where there is none, why: each distinct value is asked once.

    The reason is the error's type and message, ``no value`` for a null result and ``null`` for a
    null input; exactly one of ``out`` and ``reason`` is null. Values are told apart by their SHA-256, and a value
    that a third of the rows share is one row of the distinct values (joined back as a skewed key).
    ``reason`` and ``out`` may not be columns of ``df`` yet."""
    taken = [c for c in (out, reason) if c in df.columns]
    if taken:
        raise ValueError(f"the table has columns named {taken} already")

    bounded_batches(df.sparkSession)

    @F.arrow_udf("struct<value string, reason string>")
    def asked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for values in batches:
                found, why = [], []
                for value in values.to_pylist():
                    try:
                        result = fn(value)
                        found.append(result)
                        why.append("no value" if result is None else None)
                    except Exception as error:  # whatever the library raises for a value it cannot handle
                        found.append(None)
                        why.append(f"{type(error).__name__}: {error}")
                yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(why, pa.string())], ["value", "reason"])
        finally:
            hand_back()

    rows = df.select(F.struct("*").alias("__row"), F.unhex(F.sha2(col(column), 256)).alias("__digest"))
    values = rows.where(F.col("__digest").isNotNull()).groupBy("__digest").agg(F.any_value(F.col("__row")[column]).alias("__value"))
    answers = values.select(F.col("__digest").alias("__id"), asked.asNondeterministic()("__value").alias("__answer"))
    joined = rows.join(answers, F.col("__digest") == F.col("__id"), "left")
    why = F.when(F.col("__digest").isNull(), F.lit("null")).otherwise(F.col("__answer.reason"))
    return joined.select("__row.*", F.col("__answer.value").alias(out), why.alias(reason))


def write_with_rejects(df: DataFrame, path: str, reason: str = "reason") -> dict[str, int]:
    """Write the rows of ``with_reasons`` that have a value as Parquet and, if any, the others with their reason as CSV.

    The failing rows are kept in the shared checkpoint folder in between, so ``fn`` is not asked again;
    the counts come with the writes (``observe``)."""
    kept = cut_lineage(df)
    good, bad = Observation("good"), Observation("bad")
    kept.where(col(reason).isNull()).drop(reason).observe(good, F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}.parquet")
    rejected = kept.where(col(reason).isNotNull())
    if rejected.isEmpty():
        return {"rows": good.get["n"], "rejects": 0}
    write_csv(rejected.observe(bad, F.count("*").alias("n")), f"{path}_rejects.csv")
    return {"rows": good.get["n"], "rejects": bad.get["n"]}


class _PythonNormalizer:
    """A normalizer that Spark evaluates for whole batches: no lambda variable can reach it."""

    def __init__(self, udf: Normalizer):
        self.udf = udf

    def __call__(self, c: Column) -> Column:
        return self.udf(c)


def _decided(x: Column, outs: list[Column]) -> Column:
    """The result of the rounds ``outs`` on ``x``; a round after the value settled is null."""
    arr = F.array(*outs)
    ranked = F.transform(
        arr,
        lambda v, i: F.struct((-F.size(F.filter(arr, lambda w: w == v))).alias("n"), i.alias("i"), v.alias("v")),
    )
    chain, before = None, x
    for out in outs:
        # Evaluated in order: where a round is reached, all before it gave a new value.
        chain = F.when(out.isNull(), F.lit(None).cast("string")) if chain is None else chain.when(out.isNull(), F.lit(None).cast("string"))
        chain = chain.when(out == before, out)
        before = out
    return chain.otherwise(F.array_min(ranked)["v"])


def fixpoint(fn: Normalizer, c: Column, rounds: int = K.FIXPOINT_ROUNDS) -> Column:
    """Apply ``fn`` up to ``rounds`` times.

    Stops at the first round whose output equals its input and returns it.
    Otherwise returns the most frequent of the ``rounds`` outputs, a tie going
    to the output seen first. Null if any round yields null. Each round's output is bound once as a
    lambda variable (``let``), and a round is evaluated only for a value that the one before changed.
    ``fn`` is a Column expression; for Python functions see ``fixpoint_rounds``.
    """

    def step(x: Column, prev: Column, outs: list[Column]) -> Column:
        if len(outs) == rounds:
            return _decided(x, outs)

        def then(r: Column) -> Column:
            settled = F.when(r.isNull() | (r == prev), r)
            return settled.otherwise(step(x, r, outs + [r])) if len(outs) + 1 < rounds else step(x, r, outs + [r])

        return let(fn(prev), then)

    return let(c, lambda x: step(x, x, []))


def fixpoint_rounds(df: DataFrame, value: str, out: str, fn: Normalizer, rounds: int = K.FIXPOINT_ROUNDS) -> DataFrame:
    """``df`` with ``fixpoint`` of the column ``value`` as ``out``, by a shrinking frontier: for Python normalizers.

    Each round is a projection that passes on only the values still changing; a settled one is null
    from then on, and ``fn`` (from ``row_safe``) is not called for it again."""
    keep = list(df.columns)
    names = [f"__round{k}" for k in range(rounds)]
    before, active = col(value), col(value)
    for name in names:
        df = df.withColumn(f"{name}_in", active).withColumn(name, F.when(F.col(f"{name}_in").isNotNull(), fn(F.col(f"{name}_in"))))
        active = F.when(F.col(name) != F.col(f"{name}_in"), F.col(name))
    return df.select(*[col(c) for c in keep], _decided(before, [F.col(n) for n in names]).alias(out))


def standardize(
    df: DataFrame,
    column: str = "SMILES",
    normalizer: Normalizer = default_normalizer,
    method: str = "fixpoint",
    rounds: int = K.FIXPOINT_ROUNDS,
    augment: bool = False,
    limit_rows: int | None = None,
    order_by: Sequence[str] | None = None,
    distinct_first: bool = False,
    outputs: Sequence[str] = tuple(K.STANDARDIZE_OUTPUTS),
    variant: str | None = None,
    check_nonempty: bool = True,
) -> DataFrame:
    """Standardized rows: (original, standardized, long key, short key) [+ the input's other columns].

    Without ``augment``: one row per distinct non-null value of ``column``.
    With ``augment``: one row per input row whose value is not null (rows with
    a null value are dropped, as the standardized list is the left side).
    An empty table is an error, found by reading one row at once;
    ``check_nonempty=False`` starts no job and gives an empty result instead.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    variant = variant if variant is not None else column.lower()
    if variant != column:
        df = normalize_case_variant(df, column, variant)
    elif column not in df.columns:
        raise ValueError(f"no column {column!r} in the table")
    if check_nonempty:
        require_nonempty(df)
    if limit_rows is not None:
        if not order_by:
            raise ValueError("limit_rows needs the columns that order the rows (order_by)")
        df = head_rows(df, limit_rows, order_by)

    o_orig, o_std, o_long, o_short = outputs

    def keyed(src: DataFrame, rest: Sequence[str] = ()) -> DataFrame:
        """The four outputs for the column ``__value``."""
        if method == "single_pass":
            std = src.withColumn("__std", normalizer(F.col("__value")))
        elif isinstance(normalizer, _PythonNormalizer):
            std = fixpoint_rounds(src, "__value", "__std", normalizer, rounds)
        else:
            std = src.withColumn("__std", fixpoint(normalizer, F.col("__value"), rounds))
        return std.select(
            F.col("__value").alias(o_orig),
            F.col("__std").alias(o_std),
            text.long_key(F.col("__std")).alias(o_long),
            text.short_key(F.col("__std")).alias(o_short),
            *[col(r) for r in rest],
        )

    if not augment:
        return keyed(df.select(col(column).alias("__value")).dropna().distinct())

    originals = drop_present(df, list(outputs))
    rest = [c for c in originals.columns if c != column]
    originals = originals.filter(col(column).isNotNull()).select(col(column).alias("__value"), *[col(r) for r in rest])
    if not distinct_first:
        return keyed(originals, rest)
    # Values are told apart and found again by their SHA-256, not by their texts.
    originals = originals.select(F.unhex(F.sha2("__value", 256)).alias("__digest"), "__value", *[col(r) for r in rest])
    values = keyed(originals.groupBy("__digest").agg(F.any_value("__value").alias("__value")), ["__digest"])
    return values.join(originals.drop("__value"), "__digest").drop("__digest")


def rejects(standardized: DataFrame, outputs: Sequence[str] = tuple(K.STANDARDIZE_OUTPUTS)) -> DataFrame:
    """Rows whose value could not be standardized."""
    return standardized.filter(col(outputs[1]).isNull())
