"""Results and odds feed: raw names, clean layout, recodings. All values here are fixed values."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

SOURCE = "tennis_data_uk"
TOURS = ("atp", "wta")

# Raw column holding the event id, and the one holding the series, per tour.
ID_COLUMN = {"atp": "ATP", "wta": "WTA"}
SERIES_COLUMN = {"atp": "Series", "wta": "Tier"}

TEXT_COLUMNS = ("Location", "Tournament", "Winner", "Loser")
CATEGORY_COLUMNS = ("Series", "Tier", "Court", "Surface", "Round", "Comment")
SETS = (1, 2, 3, 4, 5)
RANK_COLUMNS = ("WRank", "LRank")
POINT_COLUMNS = ("WPts", "LPts")
LONG_COLUMNS = (
    "ATP", "WTA", "Year", "Best of", *RANK_COLUMNS,
    *[f"{side}{i}" for i in SETS for side in "WL"], "Wsets", "Lsets",
)

BOOKMAKERS = {"B365": "b365", "PS": "pinnacle", "Max": "max", "Avg": "avg"}
RAW_ODDS = tuple(f"{raw}{side}" for raw in BOOKMAKERS for side in "WL")
ODDS = tuple(f"odds_{name}_{side}" for name in BOOKMAKERS.values() for side in ("winner", "loser"))

SET_GAMES = tuple(f"{side}_set_{i}_games" for i in SETS for side in ("winner", "loser"))


def required(tour: str) -> tuple[str, ...]:
    """Raw columns that a season can't do without; keys, the year and round counts are derived."""
    return (
        ID_COLUMN[tour], SERIES_COLUMN[tour], "Location", "Tournament", "Date", "Court", "Surface",
        "Round", "Best of", "Winner", "Loser", "Comment",
    )


def rename_map(tour: str) -> dict[str, str]:
    """Raw to clean names."""
    sides = {"W": "winner", "L": "loser"}
    return {
        ID_COLUMN[tour]: "uk_tournament_id",
        "Year": "year",
        "Location": "location",
        "Tournament": "tournament_name",
        "Date": "match_date",
        SERIES_COLUMN[tour]: "series",
        "Court": "is_outdoor",
        "Surface": "surface",
        "Round": "round",
        "Best of": "best_of",
        "Winner": "winner_name",
        "Loser": "loser_name",
        **{f"{s}Rank": f"{name}_rank" for s, name in sides.items()},
        **{f"{s}Pts": f"{name}_rank_points" for s, name in sides.items()},
        **{f"{s}{i}": f"{name}_set_{i}_games" for i in SETS for s, name in sides.items()},
        **{f"{s}sets": f"{name}_sets" for s, name in sides.items()},
        "Comment": "match_status",
        **dict(zip(RAW_ODDS, ODDS, strict=True)),
    }


ROUND_MAP = {
    "atp": {"Quarterfinals": "QF", "Semifinals": "SF", "The Final": "F", "Round Robin": "RR"},
}
ROUND_MAP["wta"] = {**ROUND_MAP["atp"], "Third Place": "BR"}

SURFACE_MAP = {"Hard": "hard", "Clay": "clay", "Grass": "grass", "Carpet": "carpet"}
COURT_MAP = {"Indoor": False, "Outdoor": True}
STATUS_MAP = {
    "atp": {
        "Completed": "completed",
        "Retired": "retired",
        "Walkover": "walkover",
        "Awarded": "awarded",
        "Disqualified": "disqualified",
    },
}
STATUS_MAP["wta"] = {**STATUS_MAP["atp"], "Cancelled": "cancelled"}
SERIES_MAP = {
    "atp": {
        "ATP250": "atp_250",
        "ATP500": "atp_500",
        "Masters 1000": "masters_1000",
        "Masters Cup": "tour_finals",
        "Grand Slam": "grand_slam",
    },
    "wta": {
        "Grand Slam": "grand_slam",
        "Premier": "premier",
        "International": "international",
        "WTA1000": "wta_1000",
        "WTA500": "wta_500",
        "WTA250": "wta_250",
        "Tier 1": "tier_1",
        "Tier 2": "tier_2",
        "Tier 3": "tier_3",
        "Tier 4": "tier_4",
        "Tour Championships": "tour_championships",
    },
}
EXPECTED_ROUNDS = {"atp": ("R128", "R64", "R32", "R16", "QF", "SF", "F", "RR")}
EXPECTED_ROUNDS["wta"] = (*EXPECTED_ROUNDS["atp"], "BR")
BEST_OF = {"atp": (3, 5), "wta": (3,)}

# Attributes that must not vary within an event, and seasons with reviewed exceptions.
CONSISTENT = {
    "atp": ["Tournament", "Series", "Court", "Surface"],
    "wta": ["Tournament", "Tier", "Court", "Surface", "Best of"],
}
EXEMPT_YEARS = {"atp": (2023,), "wta": ()}

FIVE_SET_EVENTS = ("Australian Open", "French Open", "Roland Garros", "Wimbledon", "US Open")
FIVE_SET_FINAL_SERIES = "Masters"

STATUSES = tuple(STATUS_MAP["wta"].values())

_LONGS = {"year", "uk_tournament_id", "players_remaining", "best_of", "winner_rank", "loser_rank"}
_LONGS |= {"winner_sets", "loser_sets", *SET_GAMES}
_DOUBLES = {"winner_rank_points", "loser_rank_points", *ODDS}

CLEAN_COLUMNS = (
    "source", "tour", "year", "uk_tournament_id", "tournament_name", "location", "match_date",
    "series", "is_outdoor", "surface", "round", "players_remaining", "best_of",
    "winner_name", "loser_name", "winner_rank", "loser_rank",
    "winner_rank_points", "loser_rank_points", "winner_sets", "loser_sets", *SET_GAMES,
    "match_status", *ODDS, "source_event_key", "source_match_key",
)


def _type(name: str):
    if name in _LONGS:
        return LongType()
    if name in _DOUBLES:
        return DoubleType()
    return {"match_date": DateType(), "is_outdoor": BooleanType()}.get(name, StringType())


CLEAN_SCHEMA = StructType([StructField(c, _type(c)) for c in CLEAN_COLUMNS])
