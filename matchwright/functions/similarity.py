"""Sequence similarity (gestalt pattern matching) and exact ways to avoid computing it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import gestalt


@F.pandas_udf(DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Gestalt ratio of two short texts, a batch at once; null if one is null. The order matters."""
    out = pd.Series(float("nan"), index=left.index, dtype="float64")
    known = (left.notna() & right.notna()).to_numpy()
    out[known] = gestalt.ratios(left[known].tolist(), right[known].tolist())
    return out.astype("Float64")


def ratio_bound(left: Column, right: Column) -> Column:
    """No ratio can exceed this: the shorter text fully contained in the longer one."""
    total = F.length(left) + F.length(right)
    shorter = F.least(F.length(left), F.length(right))
    return F.when(total == 0, F.lit(1.0)).otherwise(2 * shorter / total)


def shared_bound(left: Column, right: Column) -> Column:
    """A closer bound than ``ratio_bound``: matched characters can't exceed the shared ones.

    Counts every different character of the left text in both texts; runs in the JVM.
    """
    total = F.length(left) + F.length(right)

    def times(text: Column, char: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, char, F.lit("")))

    shared = F.aggregate(
        F.array_distinct(F.filter(F.split(left, ""), lambda x: x != "")),
        F.lit(0),
        lambda n, char: n + F.least(times(left, char), times(right, char)),
    )
    return F.when(total == 0, F.lit(1.0)).otherwise(2 * shared / total)


def _edits(one: Column, other: Column, least_ratio: float) -> Column:
    """How many characters may stay unmatched in both texts together at that ratio."""
    return F.floor((one + other) * F.lit(1 - least_ratio) + F.lit(1e-6)).cast("int")


def _lengths(length: Column, least_ratio: float) -> Column:
    """Lengths a partner can have at that ratio."""
    low = F.ceil(length * F.lit(least_ratio / (2 - least_ratio)) - F.lit(1e-6)).cast("int")
    high = F.floor(length * F.lit((2 - least_ratio) / least_ratio) + F.lit(1e-6)).cast("int")
    return F.sequence(low, high)


def _piece_start(index: Column, length: Column, pieces: Column) -> Column:
    return F.floor(index * length / pieces).cast("int") + 1


def _piece_length(index: Column, length: Column, pieces: Column) -> Column:
    return _piece_start(index + 1, length, pieces) - _piece_start(index, length, pieces)


def piece_keys(text: Column, least_ratio: float) -> Column:
    """Join keys of an indexed text: its cut into one piece more than the edits allowed.

    With e characters unmatched in total, at least one of e + 1 pieces is untouched and stands
    somewhere in the partner (the partition argument of Li et al., PVLDB 2011). Joining
    ``piece_keys`` with ``probe_keys`` therefore loses no pair whose ratio reaches the bound.
    """
    size = F.length(text)
    return F.flatten(
        F.transform(
            _lengths(size, least_ratio),
            lambda other: F.transform(
                F.sequence(F.lit(0), _edits(size, other, least_ratio)),
                lambda i: F.concat_ws(
                    ":",
                    size,
                    other,
                    i,
                    F.substr(
                        text,
                        _piece_start(i, size, _edits(size, other, least_ratio) + 1),
                        _piece_length(i, size, _edits(size, other, least_ratio) + 1),
                    ),
                ),
            ),
        )
    )


def probe_keys(text: Column, least_ratio: float) -> Column:
    """Join keys of a probing text: every place where a piece of a partner could stand."""
    size = F.length(text)

    def places(other: Column) -> Column:
        edits = _edits(size, other, least_ratio)

        def at(i: Column) -> Column:
            start = _piece_start(i, other, edits + 1)
            width = _piece_length(i, other, edits + 1)
            first = F.greatest(F.lit(1), start - edits)
            last = F.least(size - width + 1, start + edits)
            return F.when(
                last >= first,
                F.transform(
                    F.sequence(first, F.greatest(first, last)),
                    lambda p: F.concat_ws(":", other, size, i, F.substr(text, p, width)),
                ),
            ).otherwise(F.array().cast("array<string>"))

        return F.flatten(F.transform(F.sequence(F.lit(0), edits), at))

    return F.array_distinct(F.flatten(F.transform(_lengths(size, least_ratio), places)))
