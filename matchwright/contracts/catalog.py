"""Tournament catalog: the JSON entry and the flat table. All values here are fixed values."""

from __future__ import annotations

# One entry, and a page that lists entries under ``content``.
ENTRY = (
    "struct<tournamentGroup: struct<id: bigint, name: string, level: string>, "
    "level: string, title: string, year: bigint, startDate: string, endDate: string, "
    "surface: string, inOutdoor: string, city: string, country: string, "
    "singlesDrawSize: bigint, doublesDrawSize: bigint, "
    "prizeMoney: bigint, prizeMoneyCurrency: string, status: string, "
    "winners: array<struct<singles: struct<player: struct<fullName: string>>>>>"
)
PAGE = f"content array<{ENTRY}>"

KEY = ["tour", "year", "official_tournament_id"]
ATTRIBUTES = [
    "group_name", "level", "title", "surface", "in_outdoor", "city", "country",
    "singles_draw_size", "doubles_draw_size", "prize_money", "start_date", "end_date",
    "singles_champion",
]
