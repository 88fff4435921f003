"""From event links to lookup tables: place crosswalk, long source links, wide view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import place_key
from ..functions.text import normalize_title
from .ordering import dedupe

FEED_SOURCE = "tennis_data_uk"
ARCHIVE_SOURCE = "sackmann"


def ambiguous_places(
    df: DataFrame, place: str, value: str, scope: list[str] | None = None
) -> DataFrame:
    """Places (within ``scope``) that carry more than one id."""
    keys = [*(scope or []), place]
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.count_distinct(value).alias("ids"))
        .where("ids > 1")
    )


def location_crosswalk(
    links: DataFrame, feed: DataFrame, scope: list[str] | None = None
) -> DataFrame:
    """``location_key`` to permanent id; the title joins the key where a place has several ids.

    ``scope`` names the columns within which a place counts as ambiguous. Of several rows with one
    key the earliest event in key order stays.
    """
    scope = scope or []
    events = feed.select(
        *scope,
        F.col("source_event_key").alias("uk_source_event_key"),
        "location",
        "tournament_name",
        normalize_title(F.col("location")).alias("_place"),
    )
    resolved = links.dropna(subset=["uk_source_event_key", "official_tournament_id"]).join(
        events, [*scope, "uk_source_event_key"]
    )
    several = ambiguous_places(resolved, "_place", "official_tournament_id", scope)
    marked = resolved.join(several, [*scope, "_place"], "left")
    keyed = marked.select(
        *scope,
        place_key(F.col("location"), F.col("tournament_name"), F.col("ids").isNotNull()).alias(
            "location_key"
        ),
        "official_tournament_id",
        "location",
        "uk_source_event_key",
    )
    order = [F.col("uk_source_event_key"), F.col("official_tournament_id"), F.col("location")]
    return dedupe(keyed, [*scope, "location_key"], order).drop("uk_source_event_key")


def source_links(
    links: DataFrame, *, feed: str = FEED_SOURCE, archive: str = ARCHIVE_SOURCE
) -> DataFrame:
    """One row per (source, year, the source's own id); an unknown permanent id stays null."""
    extra = [c for c in ("tour",) if c in links.columns]
    parts = [
        links.where(F.col(column).isNotNull()).select(
            *extra,
            "official_tournament_id",
            "year",
            F.lit(tag).alias("source"),
            F.col(column).alias("source_tournament_id"),
        )
        for tag, column in ((feed, "uk_source_event_key"), (archive, "sackmann_tourney_id"))
    ]
    return parts[0].unionByName(parts[1])


def pivot_links(
    links: DataFrame, sources: tuple[str, ...] = (FEED_SOURCE, ARCHIVE_SOURCE)
) -> DataFrame:
    """One row per (permanent id, year) and one column per source, ``<source>_id``."""
    wide = (
        links.where("official_tournament_id is not null and year is not null")
        .groupBy("official_tournament_id", "year")
        .agg(
            *[
                F.min(F.when(F.col("source") == s, F.col("source_tournament_id"))).alias(f"{s}_id")
                for s in sources
            ]
        )
    )
    return wide
