"""Scalar rules as Column expressions (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayflow import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hit_flag(hitcall, threshold: float = K.HITCALL_THRESHOLD) -> Column:
    """1 when hitcall > threshold, else 0; null stays null. 64-bit like the source flags."""
    return (_c(hitcall) > F.lit(threshold)).cast("long")


def null_below(value, guard, bound: float) -> Column:
    """``value`` unless ``guard < bound``, then null (a null guard keeps the value)."""
    return F.when(_c(guard) < F.lit(bound), F.lit(None)).otherwise(_c(value))


def null_above(value, bound: float) -> Column:
    """``value`` unless it is above ``bound``, then null (the bound itself is kept)."""
    return F.when(_c(value) > F.lit(bound), F.lit(None)).otherwise(_c(value))


def with_sentinel(value, sentinel: float = K.NO_CYTOTOX_SENTINEL) -> Column:
    return F.coalesce(_c(value), F.lit(sentinel))


def corrected_hit(hit, cytotox, ac50, margin: float = K.CYTOTOX_MARGIN) -> Column:
    """0 when ``cytotox / margin < ac50`` (activity within the cytotoxic range), else the hit flag.

    A null comparison (null ac50) keeps the flag.
    """
    return F.when(_c(cytotox) / F.lit(margin) < _c(ac50), F.lit(0).cast("long")).otherwise(_c(hit).cast("long"))


def presence_flag(value) -> Column:
    """1 when not null, else 0."""
    return _c(value).isNotNull().cast("long")


def share(part, whole) -> Column:
    """True division of two counts; null when the whole is 0 (ANSI-safe)."""
    return F.try_divide(_c(part).cast("double"), _c(whole).cast("double"))


def label(kind, source, sep: str = K.LABEL_SEPARATOR) -> Column:
    """``kind + sep + source`` with spaces in the source replaced by ``_``; null if either part is null."""
    return F.concat(_c(kind), F.lit(sep), F.replace(_c(source), F.lit(" "), F.lit("_")))
