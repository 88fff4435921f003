"""Season files of the canonical archive, typed and tagged."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import archive as contract
from ..operators.columns import coerce, ensure_columns
from ..operators.linking import add_canonical_key
from .files import read_text_csv, reject_ragged


def year_range(first: int, last: int) -> range:
    """Both ends included."""
    if first > last:
        raise ValueError(f"first year {first} is after last year {last}")
    return range(first, last + 1)


def clean_matches(df: DataFrame, match_type: str = "singles", scope: tuple = ()) -> DataFrame:
    """Type the columns that are present and add the match key, counted per season file."""
    typed = coerce(
        df,
        longs=contract.longs(match_type),
        doubles=contract.doubles(match_type),
        compact_days=["tourney_date"],
    )
    return add_canonical_key(typed, scope=scope)


def scan_archive(
    spark: SparkSession, root: str, tour: str, years: Iterable[int], level: str = "main"
) -> DataFrame:
    """Matches of one tour and tier for any set of years: one scan per distinct header.

    A ragged line ends the scan with an error.
    """
    name = contract.FILES[(tour, level)]
    paths = [f"{root.rstrip('/')}/{name.format(year=year)}" for year in years]
    match_type = "doubles" if level == "doubles" else "singles"
    raw = reject_ragged(read_text_csv(spark, paths))
    year = F.regexp_extract("_file", r"_(\d{4})\.csv", 1).cast("bigint")
    known = ensure_columns(raw, dict.fromkeys(contract.layout(match_type), "string"))
    tagged = known.select(*contract.layout(match_type), year.alias("source_year"))
    out = clean_matches(tagged, match_type, ("source_year",)).withColumns(
        {"tour": F.lit(tour), "match_type": F.lit(match_type)}
    )
    return out if match_type == "doubles" else out.withColumn("match_level", F.lit(level))


def scan_people(spark: SparkSession, root: str, tour: str) -> DataFrame:
    """Biographies, typed."""
    return _typed(
        spark, f"{root.rstrip('/')}/{contract.PEOPLE_FILE.format(tour=tour)}", contract.PEOPLE_TYPES
    )


def scan_rankings(spark: SparkSession, root: str, tour: str) -> DataFrame:
    """Current rankings, typed."""
    return _typed(
        spark,
        f"{root.rstrip('/')}/{contract.RANKINGS_FILE.format(tour=tour)}",
        contract.RANKINGS_TYPES,
    )


def _typed(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """One scan with declared types; columns that are not declared stay text."""
    raw = reject_ragged(read_text_csv(spark, [path])).drop("_file")
    of = lambda kind: [c for c, t in types.items() if t == kind]
    return coerce(raw, longs=of("long"), compact_days=of("day"))
