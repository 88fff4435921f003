"""Tolerant numbers, and small row-wise helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(value: Column) -> Column:
    """Number or null; blank text and NaN count as missing."""
    number = F.nullif(F.trim(value.cast("string")), F.lit("")).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_long(value: Column) -> Column:
    """Whole number or null, exact over the whole range of a long.

    Text such as ``301.0`` or ``3e2`` is accepted, ``301.5`` is not whole, nor is any text with a
    digit but 0 behind the point, however far. Zeros behind the point are cut off as text; what is
    left beside plain digits goes through a decimal only if that can hold it without rounding (at
    most nine decimals and exponents from -9 to 99), and nothing through a double.
    """
    text = F.regexp_replace(F.trim(value.cast("string")), r"\.0*$", "")
    shape = r"^[+-]?\d{0,20}(\.\d{0,9})?([eE](\+?\d{1,2}|-\d))?$"
    number = F.when(text.rlike(shape), text.try_cast("decimal(38,18)"))
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), whole)


def number_or(value: Column, default: float) -> Column:
    """Number, with a default for blank and unreadable text."""
    return F.coalesce(to_double(value), F.lit(float(default)))


def null_below(value: Column, floor: float) -> Column:
    """Null out impossible values below ``floor``; the rest stays."""
    return F.when(value < floor, F.lit(None)).otherwise(value)


def row_mean(values: list[Column]) -> Column:
    """Mean of the values that are there; null if none is."""
    present = [F.when(v.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for v in values]
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
    count = reduce(lambda a, b: a + b, present)
    return F.when(count > 0, total / count)


def fill_from_mean(value: Column, others: list[Column], last: Column | None = None) -> Column:
    """The value, else the mean of the others, else one last resort."""
    choices = [value, row_mean(others)] + ([last] if last is not None else [])
    return F.coalesce(*choices)
