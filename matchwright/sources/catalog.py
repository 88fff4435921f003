"""Pages of the tournament catalog (JSON), flattened."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import catalog as contract
from ..functions.dates import parse_date
from ..operators.ordering import dedupe


def first_champion(winners: Column) -> Column:
    """Full name of the first singles winner that has one."""
    named = F.filter(winners, lambda w: w["singles"]["player"].isNotNull())
    return F.try_element_at(named, F.lit(1))["singles"]["player"]["fullName"]


def flatten(entries: DataFrame) -> DataFrame:
    """One flat row per entry; ``entries`` has the columns of a catalog entry."""
    c = F.col
    return entries.select(
        c("tournamentGroup.id").alias("tournament_group_id"),
        c("tournamentGroup.name").alias("group_name"),
        "level",
        "title",
        "year",
        c("startDate").alias("start_date"),
        c("endDate").alias("end_date"),
        "surface",
        c("inOutdoor").alias("in_outdoor"),
        "city",
        "country",
        c("singlesDrawSize").alias("singles_draw_size"),
        c("doublesDrawSize").alias("doubles_draw_size"),
        c("prizeMoney").alias("prize_money"),
        c("prizeMoneyCurrency").alias("prize_money_currency"),
        first_champion(c("winners")).alias("singles_champion"),
        "status",
    )


def scan_catalog(
    spark: SparkSession,
    path: str,
    *,
    exclude_levels: str | Iterable[str] = (),
    multi_line: bool = True,
) -> DataFrame:
    """Landed pages, without the levels named; an entry without a level stays.

    A page is one file (``multi_line``) or one line.
    """
    levels = [exclude_levels] if isinstance(exclude_levels, str) else list(exclude_levels)
    pages = spark.read.schema(contract.PAGE).option("multiLine", multi_line).json(path)
    flat = flatten(pages.select(F.explode("content").alias("e")).select("e.*"))
    return flat.where(~F.coalesce(F.col("level").isin(levels), F.lit(False))) if levels else flat


def catalog_table(flat: DataFrame, tour: str = "wta") -> DataFrame:
    """Typed table, one row per (tour, year, permanent id): the first in title order stays."""
    named = flat.withColumnsRenamed({"tournament_group_id": "official_tournament_id"}).withColumns(
        {
            "tour": F.lit(tour),
            "start_date": parse_date(F.col("start_date")),
            "end_date": parse_date(F.col("end_date")),
        }
    )
    kept = named.select(*contract.KEY, *contract.ATTRIBUTES)
    order = [F.col("title"), F.col("start_date"), F.col("city")]
    return dedupe(kept, contract.KEY, order).orderBy(*contract.KEY)
