"""Helpers for array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Spark does not share a sub-expression between a higher-order function's
    lambda body and the enclosing expression: an outer expression named inside
    a lambda is evaluated again for every element. Binding it as the single
    element of ``transform(array(value), v -> body(v))`` evaluates it once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def shift_left(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits)


def shift_right(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, bits)
