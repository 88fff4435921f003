"""Tournament identity: match events across sources and keep the lookup tables up to date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import archive as archive_contract
from ..contracts import feed as feed_contract
from ..operators import identity, matching, merge
from ..operators.columns import not_equal
from ..operators.ordering import dedupe
from ..session import materialize
from ..sources.sinks import current, store, touched

CROSSWALK = "tour string, location_key string, official_tournament_id bigint, location string"
SOURCE_LINKS = (
    "tour string, official_tournament_id bigint, year bigint, source string, "
    "source_tournament_id string"
)
MANUAL = (
    "tour string, year bigint, uk_source_event_key string, sackmann_tourney_id string, "
    "official_tournament_id bigint"
)


@dataclass(frozen=True)
class Mapping:
    links: DataFrame
    review: DataFrame
    crosswalk: DataFrame
    source_links: DataFrame
    conflicts: DataFrame


def map_tournaments(
    spark: SparkSession,
    feed: DataFrame,
    archive: DataFrame,
    root: str,
    *,
    manual: DataFrame | None = None,
    catalog: DataFrame | None = None,
    floor: float = matching.FLOOR,
) -> Mapping:
    """All tours and seasons in one run. Order matters: extracted ids, then ids given by hand, then
    the catalog for what is still blank."""
    block = ["tour", "year"]
    events = archive.where(not_equal(F.col("tourney_level"), archive_contract.TEAM_EVENT_LEVEL))
    found = matching.match_events(feed, events, manual, block=block, floor=floor)
    links = materialize(found.links)
    if catalog is not None:
        blank = links.where("official_tournament_id is null").select(
            *block, F.col("sackmann_tourney_id").alias("tourney_id")
        )
        rest = events.join(blank, [*block, "tourney_id"], "left_semi")
        extra = matching.match_catalog(rest, catalog, block=block)
        links = materialize(matching.backfill_ids(links, extra))

    by_season = identity.location_crosswalk(links, feed, block)
    earliest = dedupe(by_season, ["tour", "location_key"], [F.col("year"), F.col("location")])
    new_places = earliest.select("tour", "location_key", "official_tournament_id", "location")
    old_places = current(spark, f"{root}/crosswalk", CROSSWALK)
    conflicts = materialize(merge.conflict_report(old_places, new_places, ["tour"]))
    store(
        merge.upsert(
            touched(old_places, new_places, ["tour"]), new_places, ["tour", "location_key"], keep="first"
        ),
        f"{root}/crosswalk",
        ["tour"],
        sort=["tour", "location_key"],
    )

    key = ["tour", *merge.LINK_KEY]
    old_links = current(spark, f"{root}/source_links", SOURCE_LINKS)
    forced = None
    if manual is not None:
        forced = merge.forced_keys(manual, feed_contract.SOURCE, archive_contract.SOURCE, ("tour",))
    new_links = identity.source_links(links).select(*old_links.columns)
    merged = merge.priority_merge(touched(old_links, new_links, block), new_links, forced, keys=key)
    store(merged, f"{root}/source_links", block, sort=key)
    return Mapping(
        links,
        found.review,
        current(spark, f"{root}/crosswalk", CROSSWALK),
        current(spark, f"{root}/source_links", SOURCE_LINKS),
        conflicts,
    )
