"""Renames, fixed layouts, typed coercion, recoding and rule rewrites."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import dates, numbers


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns that are missing as typed nulls; the others stay untouched."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order, absent ones as null."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def coerce(
    df: DataFrame,
    *,
    longs: Iterable[str] = (),
    doubles: Iterable[str] = (),
    texts: Iterable[str] = (),
    days: Iterable[str] = (),
    compact_days: Iterable[str] = (),
) -> DataFrame:
    """Type the columns that are present; a value that does not fit becomes null."""
    rules = (
        (longs, numbers.to_long),
        (doubles, numbers.to_double),
        (texts, lambda c: c.cast("string")),
        (days, dates.parse_date),
        (compact_days, dates.parse_compact_date),
    )
    typed = {
        name: rule(F.col(f"`{name}`"))
        for names, rule in rules
        for name in names
        if name in df.columns
    }
    return df.withColumns(typed) if typed else df


def lookup(table: Mapping[str, object], value: Column) -> Column:
    """Entry of a fixed table, null if there is none.

    ``try_element_at`` keeps the table one literal; indexing it would be unrolled to a chain of
    comparisons, and several of those make the generated code too large to be compiled.
    """
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), value)


def recode(value: Column, table: Mapping[str, object], *, keep_unmapped: bool = True) -> Column:
    """Look values up in a fixed table; the rest stays, or becomes null."""
    found = lookup(table, value)
    return F.coalesce(found, value) if keep_unmapped else found


def null_invalid(df: DataFrame, columns: Iterable[str], floor: float = 1.0) -> DataFrame:
    """Null out values below ``floor`` in those of the columns that are present."""
    fixed = {c: numbers.null_below(F.col(c), floor) for c in columns if c in df.columns}
    return df.withColumns(fixed) if fixed else df


def count_invalid(df: DataFrame, columns: Iterable[str], floor: float = 1.0) -> DataFrame:
    """How many values ``null_invalid`` would remove, per column."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c) < floor).alias(c) for c in present])
    return counts.unpivot([], present, "column", "removed")


def union_seasons(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name of frames whose columns differ; absent columns are null."""
    frames = iter(frames)
    out = next(frames)
    for frame in frames:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def rewrite(df: DataFrame, rules: Iterable[tuple[str, Column, object]]) -> DataFrame:
    """Apply (column, condition, value) rules one after another; a null condition is no hit."""
    for column, condition, value in rules:
        new = value if isinstance(value, Column) else F.lit(value)
        df = df.withColumn(column, F.when(condition, new).otherwise(F.col(f"`{column}`")))
    return df


def swap_blocks(
    df: DataFrame, id_column: str, first: object, second: object, columns: list[str], where: Column
) -> DataFrame:
    """Exchange the identity columns of two blocks of rows.

    The two identities are read by one aggregate, in which every task keeps a single row per
    block; the exchange itself is a projection.
    """
    inside = df.where(where & F.col(id_column).isin(first, second))
    identity = inside.groupBy(F.col(id_column).alias("_id")).agg(
        F.min(F.struct(*columns)).alias("_identity")
    )
    turned = identity.withColumn(
        "_id", F.when(F.col("_id") == first, F.lit(second)).otherwise(F.lit(first))
    )
    hit = where & (F.col(id_column) == F.col("_id"))
    joined = df.join(turned, hit, "left")
    return joined.select(
        *[
            F.when(F.col("_identity").isNotNull(), F.col(f"_identity.{c}"))
            .otherwise(F.col(f"`{c}`"))
            .alias(c)
            if c in columns
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def complete_rows(df: DataFrame, required: Iterable[str], status: str, value: str) -> DataFrame:
    """Rows with that status whose required columns are all present."""
    return df.where(F.col(status) == value).dropna(subset=list(required))


def not_equal(value: Column, unwanted: object) -> Column:
    """Different from ``unwanted``, where a null counts as different."""
    return ~value.eqNullSafe(F.lit(unwanted))


def player_sides(df: DataFrame, key: Column, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Present winner/loser columns as side 1 and side 2, alternating by a hash of the key.

    ``pairs`` maps an output stem to its (winner, loser) columns. The hash replaces row parity,
    which means nothing in a distributed table.
    """
    first = F.pmod(F.xxhash64(key), F.lit(2)) == 0
    added: dict[str, Column] = {"first_is_winner": first}
    for stem, (won, lost) in pairs.items():
        added[f"{stem}_1"] = F.when(first, F.col(won)).otherwise(F.col(lost))
        added[f"{stem}_2"] = F.when(first, F.col(lost)).otherwise(F.col(won))
    return df.withColumns(added)
