"""Predicates and small expressions on numeric columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, functions as F


def any_nonzero(columns: Sequence[str]) -> Column:
    """True if at least one column differs from zero; a null counts as no difference."""
    if not columns:
        raise ValueError("no numeric columns to test")
    return reduce(or_, [F.coalesce(F.col(c) != 0, F.lit(False)) for c in columns])


def is_finite(column: str) -> Column:
    """True for a number; false for null, NaN and the infinities."""
    value = F.col(column).cast("double")
    return F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))


def all_present(columns: Sequence[str]) -> Column:
    """True if every column is a finite number."""
    return reduce(and_, [is_finite(c) for c in columns])


def finite_or_null(column: str) -> Column:
    return F.when(is_finite(column), F.col(column))


def total(columns: Sequence[str]) -> Column:
    return reduce(add, [F.col(c) for c in columns])


#: Days whose bits go into one BIGINT.
DAYS_PER_WORD = 63


def day_bits(day: Column, days: int) -> list[Column]:
    """The bit of day number ``day`` (0 to ``days`` - 1), in one word per 63 days.

    ``bit_or`` over these words followed by ``bit_count`` is an exact count of distinct days with a
    fixed-size buffer: it stays in the hash aggregate and is allowed on streams, where a distinct
    count is not.
    """
    words = []
    for first in range(0, days, DAYS_PER_WORD):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), day - F.lit(first))
        inside = (day >= first) & (day < first + DAYS_PER_WORD)
        words.append(F.when(inside, bit).otherwise(F.lit(0).cast("long")) if days > DAYS_PER_WORD else bit)
    return words
