"""Lookups, semi and anti joins, and joins with a range.

No join here carries a broadcast hint. Spark broadcasts a side only after checking its size: by
``spark.sql.autoBroadcastJoinThreshold`` when planning, and again by adaptive execution at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def single_valued(lookup: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key; an error where a key has several values, so that no join multiplies rows."""
    several = F.min(value) < F.max(value)
    message = F.concat(
        F.lit(f"several values of {value} for {', '.join(keys)}: "),
        F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]),
    )
    counted = lookup.groupBy(*keys).agg(several.alias("_several"), F.min(value).alias(value))
    kind = lookup.schema[value].dataType
    checked = F.when(F.col("_several"), F.raise_error(message).cast(kind)).otherwise(F.col(value))
    return counted.select(*keys, checked.alias(value))


def attach_official_ids(
    matches: DataFrame,
    bridge: DataFrame,
    *,
    source: str,
    id_column: str,
    year_column: str = "year",
    scope: tuple[str, ...] = ("tour",),
    out: str = "official_tournament_id",
) -> DataFrame:
    """Left lookup of the permanent id by (scope, year, the source's own id).

    Event ids repeat across tours, so the tour is part of the key; a scope column that the bridge
    doesn't have is left out, and its ids then hold everywhere. Null keys stay unmapped. A key
    with several permanent ids is an error.
    """
    scope = [c for c in scope if c in bridge.columns]
    own = bridge.where(F.col("source") == source).select(
        *[F.col(c).alias(f"_{c}") for c in scope],
        F.col("year").alias("_year"),
        F.col("source_tournament_id").alias("_id"),
        F.col("official_tournament_id").alias(out),
    )
    keys = [*[f"_{c}" for c in scope], "_year", "_id"]
    own = single_valued(own, keys, out)
    same = (F.col(year_column) == F.col("_year")) & (F.col(id_column) == F.col("_id"))
    for c in scope:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return matches.drop(out).join(own, same, "left").drop(*keys)


def bridge_duplicates(bridge: DataFrame, scope: tuple[str, ...] = ("tour",)) -> DataFrame:
    """Source ids that would map to several permanent ids within their scope."""
    keys = [c for c in scope if c in bridge.columns] + ["source", "year", "source_tournament_id"]
    return (
        bridge.select(*keys, "official_tournament_id")
        .distinct()
        .groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )


def fill_or_override(
    df: DataFrame, lookup: DataFrame, key: str | list[str], value: str, *, override: bool = False
) -> DataFrame:
    """Fill blanks from a lookup, or let the lookup win wherever it has a value.

    A lookup key with several values is an error; the number of rows never changes.
    """
    keys = [key] if isinstance(key, str) else list(key)
    named = single_valued(lookup.where(F.col(value).isNotNull()), keys, value)
    named = named.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(value).alias("_value"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    both = ("_value", value) if override else (value, "_value")
    joined = df.join(named, same, "left").withColumn(value, F.coalesce(*both))
    return joined.drop("_value", *[f"_k_{k}" for k in keys])


def missing_references(keys: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Keys that the known table does not have."""
    return keys.select(column).distinct().join(known.select(column), column, "left_anti")


def rows_of(df: DataFrame, offenders: DataFrame, keys: list[str]) -> DataFrame:
    """The records that belong to offending keys."""
    return df.join(offenders.select(*keys), keys, "left_semi")


def residual(df: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """The records whose key is not taken."""
    return df.join(taken.select(key), key, "left_anti")


def preferred_side(
    left: DataFrame, right: DataFrame, on: str, columns: dict[str, str], how: str = "inner"
) -> DataFrame:
    """Join and choose for each output column which side supplies it (``left`` or ``right``)."""
    a, b = left.alias("l"), right.alias("r")
    picked = [
        F.col(f"{'l' if side == 'left' else 'r'}.{name}").alias(name)
        for name, side in columns.items()
    ]
    return a.join(b, F.col(f"l.{on}") == F.col(f"r.{on}"), how).select(*picked)


def disagreeing_ids(
    links: DataFrame, canonical: DataFrame, key: str | list[str], columns: list[str]
) -> DataFrame:
    """Links whose copied ids differ from the record they point to, a missing id included."""
    keys = [key] if isinstance(key, str) else list(key)
    truth = canonical.select(*keys, *[F.col(c).alias(f"_true_{c}") for c in columns])
    wrong = F.lit(False)
    for c in columns:
        wrong = wrong | ~F.col(c).eqNullSafe(F.col(f"_true_{c}"))
    return links.select(*keys, *columns).join(truth, keys, "left").where(wrong)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_point: Column,
    right_point: Column,
    low: int,
    high: int,
) -> DataFrame:
    """Pairs with equal keys and ``low <= right_point - left_point <= high`` (whole numbers).

    Both sides meet on (keys, bucket of the line), so a key with very many records is spread over
    its buckets instead of being paired as a whole; only neighbouring buckets are compared.
    """
    width = max(1, high - low)
    cell = F.floor((left_point + low) / width)
    a = left.withColumns({"_p": left_point, "_bucket": F.explode(F.sequence(cell, cell + 1))})
    b = right.withColumns({"_q": right_point, "_bucket": F.floor(right_point / width)})
    inside = (F.col("_q") - F.col("_p")).between(low, high)
    return a.join(b, [*keys, "_bucket"]).where(inside).drop("_p", "_q", "_bucket")
