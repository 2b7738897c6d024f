"""Column helpers that keep missing values missing.

Spark runs with ANSI mode on, so plain division and casts raise. Everything
here returns NULL for a value that cannot be computed, and stays inside
generated code: there is no Python UDF in this package.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\f\v"


def nan_to_null(c: Column) -> Column:
    """NaN sorts above every number in ``max`` and spoils ``avg``; NULL is skipped."""
    return F.nanvl(c, F.lit(None).cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division where x/0 is missing."""
    return F.try_divide(numerator, denominator)


def clamp_at_zero(c: Column) -> Column:
    """max(c, 0) with a missing value kept; ``greatest`` would turn it into 0."""
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def rounded(c: Column, digits: int | None) -> Column:
    """Round when a scale is asked for, else pass through."""
    return c if digits is None else F.round(c, digits)


def strip(c: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(c, F.lit(_BLANKS))


def number(text: Column) -> Column:
    """Text to double, missing when it is not a number.

    The JVM parser also reads a trailing type letter (``12d``) as a number, so
    such text is ruled out first.
    """
    last = F.right(text, F.lit(1))
    plain = F.when(~last.isin("d", "D", "f", "F"), text)
    return nan_to_null(plain.try_cast("double"))


def rim_size(sku: Column) -> Column:
    """Characters 9 and 10 of the product code as an integer, else 0."""
    two = F.rtrim(F.substring(sku, 9, 2), F.lit("."))
    return F.coalesce(two.try_cast("int"), F.lit(0))


def case_of(key: Column, values: dict[str, float | str]) -> Column:
    """Value of a key from a handful of fixed ones; missing for any other key.

    Reads as a CASE inside generated code, so no lookup table is joined. The
    result accepts ``otherwise``.
    """
    def literal(v: float | str) -> Column:
        return F.lit(v if isinstance(v, str) else float(v))

    (first, value), *rest = values.items()
    start = F.when(key == first, literal(value))
    return reduce(lambda acc, kv: acc.when(key == kv[0], literal(kv[1])), rest, start)
