"""Dates that arrive in several notations, and closeness in time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notations seen in the feed, month before day.
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "M/d/yy", "d-MMM-yyyy", "yyyy/M/d", "yyyyMMdd")


def parse_date(value: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """The first notation that fits; null where none does. A time of day is cut off."""
    text = F.regexp_replace(F.trim(value.cast("string")), r"[ T]\d{1,2}:\d{2}.*$", "")
    tries = []
    for fmt in formats:
        shape = {
            "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
            "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
            "M/d/yy": r"^\d{1,2}/\d{1,2}/\d{2}$",
        }.get(fmt)
        parsed = F.try_to_date(text, fmt)
        tries.append(F.when(text.rlike(shape), parsed) if shape else parsed)
    return F.coalesce(*tries)


def parse_compact_date(value: Column) -> Column:
    """``yyyyMMdd`` as text or number, also where a number reader left ``.0`` behind."""
    return F.try_to_date(F.regexp_replace(F.trim(value.cast("string")), r"\.0$", ""), "yyyyMMdd")


def date_closeness(left: Column, right: Column, max_days: int = 10) -> Column:
    """1 on the same day, falling evenly to 0 at ``max_days``; a missing date gives 0."""
    days = F.abs(F.datediff(left, right))
    return F.coalesce(F.greatest(F.lit(0.0), 1 - days / F.lit(float(max_days))), F.lit(0.0))
