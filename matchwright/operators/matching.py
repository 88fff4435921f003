"""One-to-one matching of events: greedy assignment, refilled lists, review lists.

Candidates and their score are in ``candidates``. The choice is that of a walk down all pairs sorted
by score: a pair is taken if both of its events are still free.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..session import stage
from .candidates import (
    DATE_WEIGHT,
    FLOOR,
    MAX_DAYS,
    NAME_WEIGHT,
    SURFACE_WEIGHT,
    Rule,
    Side,
    candidates,
    lists,
    prepared,
    tie,
)
from .joins import fill_or_override

__all__ = ["DATE_WEIGHT", "NAME_WEIGHT", "SURFACE_WEIGHT", "Side", "candidates"]

BACKFILL_FLOOR = 0.8
# Pairs on the list of an event; it gets more when its list has run dry.
KEEP = 16
# Blocks of up to this many pairs are walked in one task, larger ones are resolved in rounds.
WALK_ROWS = 1_000_000


def assign(scored: DataFrame, block: list[str], *, walk_rows: int = WALK_ROWS) -> DataFrame:
    """Greedy one-to-one choice: best score first, both partners then taken.

    ``scored`` has the block, l_id, r_id and score; equal scores are ordered by the MD5 of the pair
    of ids, and by the ids. With ``in_l`` and ``in_r`` it holds lists (``candidates.lists``): a pair
    that is the best one left, but not on the lists of both of its events, isn't decided, as an
    event may have better pairs that are on no list; nor is what both events could take after it.

    Blocks are counted first. A block that fits is one sorted walk: tasks sort the pairs of their
    blocks and read them in a stream, holding the ids taken of one block. Blocks beyond ``walk_rows``
    are resolved everywhere at once, see ``_rounds``. Both give the same pairs.
    """
    return _assign(stage(scored, "pairs"), block, walk_rows)


def _assign(scored: DataFrame, block: list[str], walk_rows: int) -> DataFrame:
    """``assign`` of pairs that are stored."""
    flags = [F.col(c) if c in scored.columns else F.lit(True).alias(c) for c in ("in_l", "in_r")]
    pairs = scored.select(*block, "l_id", "r_id", "score", tie(F.col("l_id"), F.col("r_id")).alias("_tie"), *flags)
    large = scored.groupBy(*block).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > walk_rows)
    if large.isEmpty():
        return _walk(pairs, block)
    large = stage(large.drop("_n"), "large-blocks")
    walked = _walk(pairs.join(large, block, "left_anti"), block)
    return walked.unionByName(_rounds(pairs.join(large, block, "left_semi"), block))


def _walk(pairs: DataFrame, block: list[str]) -> DataFrame:
    """The sorted walk of every block, in the task that holds its sorted pairs."""
    fields = [*block, "l_id", "r_id", "score"]
    order = [*block, F.desc("score"), "_tie", "l_id", "r_id"]
    dealt = pairs.repartition(*block).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gone_l, gone_r = None, set(), set()
        for batch in batches:
            own = [batch.column(c).to_pylist() for c in block]
            left, right = batch.column("l_id").to_pylist(), batch.column("r_id").to_pylist()
            sure = zip(batch.column("in_l").to_pylist(), batch.column("in_r").to_pylist(), strict=True)
            taken = []
            for i, (at, l, r, (in_l, in_r)) in enumerate(zip(zip(*own, strict=True), left, right, sure, strict=True)):
                if at != now:
                    now, gone_l, gone_r = at, set(), set()
                if l not in gone_l and r not in gone_r:
                    gone_l.add(l)
                    gone_r.add(r)
                    if in_l and in_r:
                        taken.append(i)
            yield batch.select(fields).take(pa.array(taken, pa.int64()))

    return dealt.mapInArrow(run, pairs.select(*fields).schema)


def _rounds(pairs: DataFrame, block: list[str]) -> DataFrame:
    """The same choice for blocks of any size, all at once.

    A pair that is the best of both of its events is taken. One that has a single better competitor
    is taken if that one is dropped and dropped if that one is taken: such pairs form chains, and
    pointer doubling carries the answer along a chain of n pairs in about log2(n) steps. A round
    ranks what is left, resolves chains and drops the competitors of what was taken; pairs with
    more than one better competitor wait for the next. States: T taken, D dropped, Z undecidable by
    these lists, U unknown in this round.
    """
    fields = [*block, "l_id", "r_id", "score"]
    order = F.struct((-F.col("score")).alias("down"), "_tie", "l_id", "r_id")
    left = stage(pairs.withColumn("_at", order), "open-pairs")
    done: list[DataFrame] = []
    while not left.isEmpty():
        ranked = left
        for side in ("l", "r"):
            key = [*block, f"{side}_id"]
            first = left.groupBy(*key).agg(F.min("_at").alias(f"_{side}1"))
            ranked = ranked.join(first, key)
            second = ranked.where(F.col("_at") > F.col(f"_{side}1")).groupBy(*key).agg(F.min("_at").alias(f"_{side}2"))
            ranked = ranked.join(second, key, "left")
        def better(side: str):
            top, next_ = F.col(f"_{side}1"), F.col(f"_{side}2")
            return F.when(F.col("_at") == top, 0).when(F.col("_at") == next_, 1).otherwise(2)

        # The only better competitor: the best pair of the side on which this one is second.
        above = F.when(better("l") == 1, F.col("_l1")).otherwise(F.col("_r1"))
        alone = F.when(F.col("in_l") & F.col("in_r"), "T").otherwise("Z")
        count = better("l") + better("r")
        nodes = ranked.select(
            *fields,
            "_at",
            F.when(count == 0, alone).when(count > 1, "U").alias("state"),
            F.when(count == 1, above).alias("above"),
            F.when(count == 1, F.lit("D")).alias("if_taken"),
            F.when(count == 1, alone).alias("if_dropped"),
        )
        nodes = _follow(stage(nodes, "chains"), block)
        done.append(nodes.where("state = 'T'").select(*fields))
        fixed = nodes.where("state in ('T', 'Z')")
        rest = nodes.where("state = 'U'").select(*fields, "_at")
        rest = rest.join(fixed.select(*block, "l_id"), [*block, "l_id"], "left_anti")
        rest = rest.join(fixed.select(*block, "r_id"), [*block, "r_id"], "left_anti")
        flags = left.select(*block, "_at", "_tie", "in_l", "in_r")
        left = stage(rest.join(flags, [*block, "_at"]), "open-pairs")
    out = done[0] if done else pairs.select(*fields).limit(0)
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _follow(nodes: DataFrame, block: list[str]) -> DataFrame:
    """All states, by pointer doubling along the only better competitors."""

    def through(state, taken: str, dropped: str):
        return F.when(state == "T", F.col(taken)).when(state == "D", F.col(dropped)).otherwise(state)

    while not nodes.where("state is null").isEmpty():
        target = nodes.select(
            *block,
            F.col("_at").alias("above"),
            F.col("state").alias("_state"),
            F.col("above").alias("_above"),
            F.col("if_taken").alias("_taken"),
            F.col("if_dropped").alias("_dropped"),
        )
        waiting = nodes.where("state is null").join(target, [*block, "above"])
        moved = waiting.select(
            *[c for c in nodes.columns if c not in ("state", "above", "if_taken", "if_dropped")],
            F.when(F.col("_state").isNotNull(), through(F.col("_state"), "if_taken", "if_dropped")).alias("state"),
            F.col("_above").alias("above"),
            through(F.col("_taken"), "if_taken", "if_dropped").alias("if_taken"),
            through(F.col("_dropped"), "if_taken", "if_dropped").alias("if_dropped"),
        )
        nodes = stage(nodes.where("state is not null").unionByName(moved), "chains")
    return nodes


def match(
    left: DataFrame,
    right: DataFrame,
    left_side: Side,
    right_side: Side,
    *,
    block: list[str],
    floor: float = FLOOR,
    max_days: int = MAX_DAYS,
    keep: int = KEEP,
    walk_rows: int = WALK_ROWS,
) -> DataFrame:
    """block, l_id, r_id, score: the greedy choice among all pairs at or above the floor.

    Each event brings a list of its ``keep`` best partners, so no block is ever there with all of
    its pairs. Pairs that the lists decide are taken. An event whose list ran dry while it had more
    partners asks again, and with it all events of its block that are still free; the best pair of a
    block is always decided, so this ends, usually after one or two turns.
    """
    rule = Rule(floor, max_days)
    l = stage(prepared(left, left_side, block), "left-events")
    r = stage(prepared(right, right_side, block), "right-events")
    done: DataFrame | None = None
    while True:
        found = stage(lists(l, r, block, rule, keep), "lists")
        taken = stage(_assign(found, block, walk_rows), "taken")
        done = taken if done is None else done.unionByName(taken)
        dry = [
            found.where(f"{side}_more")
            .select(*block, f"{side}_id")
            .join(taken, [*block, f"{side}_id"], "left_anti")
            .select(*block)
            for side in ("l", "r")
        ]
        blocks = dry[0].unionByName(dry[1]).distinct()
        if blocks.isEmpty():
            return done
        blocks = stage(blocks, "dry-blocks")
        l, r = (
            stage(
                events.join(blocks, block, "left_semi")
                .withColumn(f"{side}_id", F.col("event.id"))
                .join(done.select(*block, f"{side}_id"), [*block, f"{side}_id"], "left_anti")
                .drop(f"{side}_id"),
                "free-events",
            )
            for side, events in (("l", l), ("r", r))
        )


# --- tournaments --------------------------------------------------------------------------------

FEED_EVENT = Side("source_event_key", ["tournament_name", "location"])
ARCHIVE_EVENT = Side("tourney_id", ["tournament_name"])
CATALOG_EVENT = Side("official_tournament_id", ["group_name", "title"])


@dataclass(frozen=True)
class EventLinks:
    """``links`` keeps unmatched events of both sides with the other side null."""

    links: DataFrame
    review: DataFrame


def match_events(
    feed: DataFrame,
    archive: DataFrame,
    manual: DataFrame | None = None,
    *,
    block: list[str] = ["tour", "year"],  # noqa: B006
    floor: float = FLOOR,
    max_days: int = MAX_DAYS,
) -> EventLinks:
    """Match the events of all seasons; ``manual`` forces pairs and supplies ids.

    A manual row with both keys forces the pair, with an archive key and an id supplies the id of
    that event, with a feed key and an id that of a feed event without counterpart.
    """
    free_feed, free_archive = feed, archive
    forced = None
    if manual is not None:
        forced = manual.where(
            "uk_source_event_key is not null and sackmann_tourney_id is not null"
        ).join(feed.select(*block).distinct(), [c for c in block if c in manual.columns], "inner")
        forced = forced.select(*block, "uk_source_event_key", "sackmann_tourney_id")
        free_feed = feed.join(
            forced.select(*block, F.col("uk_source_event_key").alias("source_event_key")),
            [*block, "source_event_key"],
            "left_anti",
        )
        free_archive = archive.join(
            forced.select(*block, F.col("sackmann_tourney_id").alias("tourney_id")),
            [*block, "tourney_id"],
            "left_anti",
        )
    found = match(
        free_feed, free_archive, FEED_EVENT, ARCHIVE_EVENT,
        block=block, floor=floor, max_days=max_days,
    )
    matched = found.select(
        *block,
        F.col("l_id").alias("uk_source_event_key"),
        F.col("r_id").alias("sackmann_tourney_id"),
        "score",
    )
    own = free_feed.select(*block, F.col("source_event_key").alias("uk_source_event_key"))
    other = free_archive.select(*block, F.col("tourney_id").alias("sackmann_tourney_id"))
    links = (
        matched.drop("score")
        .unionByName(
            own.join(matched, [*block, "uk_source_event_key"], "left_anti"),
            allowMissingColumns=True,
        )
        .unionByName(
            other.join(matched, [*block, "sackmann_tourney_id"], "left_anti"),
            allowMissingColumns=True,
        )
    )
    if forced is not None:
        links = links.unionByName(forced)
    links = links.withColumn(
        "official_tournament_id", keys.permanent_id(F.col("sackmann_tourney_id"))
    )
    if manual is not None:
        links = apply_manual_ids(links, manual)
    review = (
        matched.join(
            feed.select(
                *block,
                F.col("source_event_key").alias("uk_source_event_key"),
                "location",
                F.col("tournament_name").alias("uk_name"),
            ),
            [*block, "uk_source_event_key"],
        )
        .join(
            archive.select(
                *block,
                F.col("tourney_id").alias("sackmann_tourney_id"),
                F.col("tournament_name").alias("sackmann_name"),
            ),
            [*block, "sackmann_tourney_id"],
        )
        .select(*block, "score", "location", "uk_name", "sackmann_name")
    )
    return EventLinks(links, review)


def apply_manual_ids(links: DataFrame, manual: DataFrame) -> DataFrame:
    """Ids given by hand win over extracted ones, first by archive key, then by feed key.

    Event ids repeat across tours and seasons: the tour and year of the manual row count too.
    """
    given = manual.where("official_tournament_id is not null")
    scope = [c for c in ("tour", "year") if c in given.columns and c in links.columns]
    by_archive = given.where("sackmann_tourney_id is not null")
    by_feed = given.where("sackmann_tourney_id is null and uk_source_event_key is not null")
    for rows, column in ((by_archive, "sackmann_tourney_id"), (by_feed, "uk_source_event_key")):
        keys = [*scope, column]
        rows = rows.select(*keys, "official_tournament_id")
        links = fill_or_override(links, rows, keys, "official_tournament_id", override=True)
    return links


def match_catalog(
    archive: DataFrame,
    catalog: DataFrame,
    *,
    block: list[str] = ["tour", "year"],  # noqa: B006
    floor: float = BACKFILL_FLOOR,
    max_days: int = MAX_DAYS,
) -> DataFrame:
    """Archive events against the catalog, with a stricter floor: tourney id, catalog id, score."""
    found = match(
        archive, catalog, ARCHIVE_EVENT, CATALOG_EVENT,
        block=block, floor=floor, max_days=max_days,
    )
    return found.select(
        *block,
        F.col("l_id").alias("sackmann_tourney_id"),
        F.col("r_id").alias("official_tournament_id"),
        "score",
    )


def backfill_ids(links: DataFrame, found: DataFrame) -> DataFrame:
    """Fill ids that are still blank; a known id is never replaced."""
    scope = [c for c in ("tour", "year") if c in found.columns and c in links.columns]
    return fill_or_override(links, found, [*scope, "sackmann_tourney_id"], "official_tournament_id")
