"""Declared orders, dedupe by key, and reports that keep the first k rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chronological(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Ascending by those of the columns that are present, nulls last."""
    present = [F.col(c).asc_nulls_last() for c in columns if c in df.columns]
    return df.orderBy(*present) if present else df


def dedupe(df: DataFrame, keys: list[str], order: list[Column], keep: str = "first") -> DataFrame:
    """One row per key, the first or last in a declared order; null keys are equal.

    The order must be total within a key. Written as an aggregate, not a window: each task sends
    on one row per key, so a key with a third of all rows costs no more than any other.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows in a total order; each task keeps k rows."""
    return df.orderBy(*order).limit(k)


def weakest_first(df: DataFrame, score: str, below: float, ties: list[str]) -> DataFrame:
    """Review list: everything under the threshold, lowest score first."""
    return df.where(F.col(score) < below).orderBy(score, *ties)


def seeded_sample(df: DataFrame, keys: list[str], n: int, seed: int) -> DataFrame:
    """n rows drawn by MD5 of key and seed: the same rows whatever the partitioning or engine."""
    return df.orderBy(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))), *keys).limit(n)
