"""Linking records of two sources without guessing.

Three passes, each accepting only evidence that is unique on both sides:

* manual links, named by hand;
* exact rank pairs inside one event;
* compatible names of both players inside one event and round, for what is left.

Neither pass builds the pairs of a block. Records with equal evidence are first counted per side
(``n`` feed and ``m`` archive records), and a pair is accepted where both counts are 1. A block
with very many equal records is thus one row with two numbers, not n times m pairs. The pair list
of ambiguous records, which reviewers read, is a separate call on what stayed ambiguous.

Both frames follow one column contract (``FEED_COLUMNS``, ``ARCHIVE_COLUMNS``); the block columns
are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..session import stage
from .columns import ensure_columns

MANUAL = "manual_override"
BY_RANK = "tournament_rank_unique"
BY_NAMES = "tournament_round_name_pair"

BLOCK = ("year", "tour", "official_tournament_id")
RANKS = ("winner_rank", "loser_rank")

# What a side may carry; absent columns count as null.
FEED_COLUMNS = {
    "source_match_key": "string", "year": "bigint", "tour": "string",
    "official_tournament_id": "bigint", "round": "string",
    "winner_name": "string", "loser_name": "string",
    "winner_rank": "bigint", "loser_rank": "bigint",
    "winner_rank_points": "double", "loser_rank_points": "double",
}
ARCHIVE_COLUMNS = {
    **{c: t for c, t in FEED_COLUMNS.items() if c != "source_match_key"},
    "canonical_match_key": "string", "winner_id": "bigint", "loser_id": "bigint",
}

# The layouts of links, crosswalk and enriched matches, here and below.
LINK_COLUMNS = {
    "source_match_key": "string", "canonical_match_key": "string",
    "official_tournament_id": "bigint", "year": "bigint", "tour": "string", "round": "string",
    "winner_rank": "bigint", "loser_rank": "bigint",
    "winner_id": "bigint", "loser_id": "bigint",
    "match_method": "string", "review_flag": "boolean", "data_quality_flag": "string",
    "source_candidate_count": "bigint", "canonical_candidate_count": "bigint",
    "round_agrees": "boolean", "winner_rank_agrees": "boolean", "loser_rank_agrees": "boolean",
    "winner_rank_points_diff": "double", "loser_rank_points_diff": "double",
}


def scope_of(block: tuple[str, ...], *frames: DataFrame) -> list[str]:
    """The block without its event id: within it a match key is unique. Only what all frames have."""
    return [c for c in block[:-1] if all(c in df.columns for df in frames)]


def _links(df: DataFrame) -> DataFrame:
    return ensure_columns(df, LINK_COLUMNS).select(
        *[F.col(c).cast(t).alias(c) for c, t in LINK_COLUMNS.items()]
    )


def add_canonical_key(
    df: DataFrame, *, parts: tuple[str, str] = ("tourney_id", "match_num"), suffix: str = "round",
    scope: tuple[str, ...] = (), out: str = "canonical_match_key",
) -> DataFrame:
    """``event_number``, with the round behind it only where that plain key is taken twice.

    Collisions are counted per ``scope`` (season file), by an aggregate and a join with the few
    keys that collide.
    """
    if out in df.columns:
        return df
    df = df.withColumn(out, F.concat_ws("_", *[F.col(p).cast("string") for p in parts]))
    taken = (
        df.groupBy(*scope, out)
        .agg(F.count("*").alias("_n"))
        .where("_n > 1")
        .select(*scope, out, F.lit(True).alias("_taken"))
    )
    longer = F.concat_ws("_", out, F.col(suffix).cast("string"))
    columns = df.columns
    return (
        df.join(taken, [*scope, out], "left")
        .withColumn(out, F.when(F.col("_taken"), longer).otherwise(F.col(out)))
        .select(*columns)
    )


# --- evidence -----------------------------------------------------------------------------------


def agrees(left: Column, right: Column) -> Column:
    """True, false, or null where a side is missing."""
    return left == right


def quality_flag(winner_agrees: Column, loser_agrees: Column) -> Column:
    """A mismatch outranks a missing rank; null where both ranks agree."""
    mismatch = F.coalesce(~winner_agrees, F.lit(False)) | F.coalesce(~loser_agrees, F.lit(False))
    missing = winner_agrees.isNull() | loser_agrees.isNull()
    return F.when(mismatch, "rank_mismatch").when(missing, "missing_rank")


def unmatched_reason(
    official_id: str = "official_tournament_id", ranks: tuple[str, str] = RANKS
) -> Column:
    """Why a record found no partner: no event id, else no rank, else no fitting names."""
    no_rank = F.col(ranks[0]).isNull() | F.col(ranks[1]).isNull()
    return (
        F.when(F.col(official_id).isNull(), "missing_tournament_mapping")
        .when(no_rank, "no_rank_candidate")
        .otherwise("no_name_pair_candidate")
    )


# --- pass 1: rank pairs -------------------------------------------------------------------------


def rank_blocks(
    feed: DataFrame, archive: DataFrame, block: tuple[str, ...] = BLOCK
) -> DataFrame:
    """One row per (block, rank pair) found on both sides: counts ``n``, ``m`` and one record each.

    Each side is shuffled once, by the block; the join of the two aggregates needs no further one.
    The records ``f`` and ``a`` mean something only where their count is 1.
    """
    keys = [*block, *RANKS]
    carried = ["round", "winner_name", "loser_name", "winner_rank_points", "loser_rank_points"]

    def side(df: DataFrame, columns: dict[str, str], own: list[str], n: str, rec: str):
        df = ensure_columns(df, columns).dropna(subset=[block[-1], *RANKS])
        return df.groupBy(*keys).agg(
            F.count("*").alias(n), F.min(F.struct(*own, *carried)).alias(rec)
        )

    left = side(feed, FEED_COLUMNS, ["source_match_key"], "n", "f")
    right = side(
        archive, ARCHIVE_COLUMNS, ["canonical_match_key", "winner_id", "loser_id"], "m", "a"
    )
    return left.join(right, keys)


def _contradicted() -> Column:
    """Rounds are known and differ, and some known name pair cannot be the same person."""
    rounds = F.coalesce(F.col("f.round") != F.col("a.round"), F.lit(False))
    winner = names.names_conflict(F.col("f.winner_name"), F.col("a.winner_name"))
    loser = names.names_conflict(F.col("f.loser_name"), F.col("a.loser_name"))
    return rounds & (winner | loser)


def judged(blocks: DataFrame) -> DataFrame:
    """Blocks with ``linked``: a single record on each side, not contradicted by round and names.

    The contradiction is looked at after counting, so it can never turn an ambiguous block into a
    unique one.
    """
    return blocks.withColumn("linked", (F.col("n") == 1) & (F.col("m") == 1) & ~_contradicted())


def rank_links(blocks: DataFrame) -> DataFrame:
    """Accepted links of the linked blocks; blocks that aren't judged yet are judged here."""
    linked = blocks if "linked" in blocks.columns else judged(blocks)
    return _links(
        linked.where("linked").withColumns(
            {
                "source_match_key": F.col("f.source_match_key"),
                "canonical_match_key": F.col("a.canonical_match_key"),
                "winner_id": F.col("a.winner_id"),
                "loser_id": F.col("a.loser_id"),
                "match_method": F.lit(BY_RANK),
                "review_flag": F.lit(False),
                "source_candidate_count": F.col("m"),
                "canonical_candidate_count": F.col("n"),
                "round_agrees": F.coalesce(F.col("f.round") == F.col("a.round"), F.lit(False)),
                "winner_rank_points_diff": F.abs(
                    F.col("f.winner_rank_points") - F.col("a.winner_rank_points")
                ),
                "loser_rank_points_diff": F.abs(
                    F.col("f.loser_rank_points") - F.col("a.loser_rank_points")
                ),
            }
        )
    )


def rank_ambiguous(
    feed: DataFrame, blocks: DataFrame, block: tuple[str, ...] = BLOCK
) -> DataFrame:
    """Feed records in a block with several candidates on either side, with both counts."""
    several = blocks.where("n > 1 or m > 1").select(
        *block, *RANKS,
        F.col("m").alias("source_candidate_count"), F.col("n").alias("canonical_candidate_count"),
    )
    return feed.join(several, [*block, *RANKS])


def rank_pairs(feed: DataFrame, archive: DataFrame, block: tuple[str, ...] = BLOCK) -> DataFrame:
    """Key pairs with an equal block and rank pair: the review list of chosen records.

    Meant for the records that stayed ambiguous; its size is the number of pairs.
    """
    keys = [*block, *RANKS]
    left = feed.dropna(subset=[block[-1], *RANKS]).select(*keys, "source_match_key")
    right = archive.dropna(subset=[block[-1], *RANKS]).select(*keys, "canonical_match_key")
    return left.join(right, keys)


# --- pass 2: name pairs -------------------------------------------------------------------------

_NAMES = ("winner_name", "loser_name")


def _same(keys: tuple[str, ...], left: str, right: str) -> Column:
    """Equal block columns; the round also where both sides lack it."""
    out = F.lit(True)
    for c in keys:
        a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        out = out & (a.eqNullSafe(b) if c == "round" else a == b)
    return out


def _spellings(df: DataFrame) -> DataFrame:
    """Every different spelling of a name, once."""
    spelled = df.select(F.explode(F.array("winner_name", "loser_name")).alias("name"))
    return spelled.where("name is not null").distinct()


def short_names(feed: DataFrame) -> DataFrame:
    """(name, family, letters): surname and initials of every spelling in the feed."""
    # The parsed name leaves a generator, so that filters don't parse it again.
    parsed = F.explode(F.array(names.parse_abbreviated(F.col("name")))).alias("_short")
    return _spellings(feed).select("name", parsed).where("_short.surname <> ''").select(
        "name",
        names.compact(F.col("_short.surname")).alias("family"),
        F.col("_short.initials").alias("letters"),
    )


def full_names(archive: DataFrame) -> DataFrame:
    """(name, family, given): every surname reading of every spelling in the archive."""
    runs = F.explode(names.trailing_runs(F.col("name"))).alias("_run")
    return _spellings(archive).select("name", runs).select(
        "name", F.col("_run.run").alias("family"), F.col("_run.given").alias("given")
    )


def known_readings(full: DataFrame, short: DataFrame) -> DataFrame:
    """The readings whose surname some short name has; no other can fit."""
    return full.join(short.select("family").distinct(), "family", "left_semi").select(*full.columns)


def spelled(feed: DataFrame, archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both name tables, parsed and staged once; they grow with the people, not the records."""
    short = stage(short_names(feed), "short-names")
    return short, stage(known_readings(full_names(archive), short), "full-names")


def _with_names(df: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """The parsed names of both players; records with an unknown name drop out."""
    for side in ("winner", "loser"):
        own = table.select(
            F.col("name").alias(f"{side}_name"),
            F.col("family").alias(f"_{side}_family"),
            F.col(value).alias(f"_{side}_{value}"),
        )
        df = df.join(own, f"{side}_name")
    return df


def _fitting(left: DataFrame, right: DataFrame, block: tuple[str, ...]) -> DataFrame:
    """Equality join on block, round and both surnames; only initials are left to test."""
    keys = (*block, "round", "_winner_family", "_loser_family")
    return (
        left.alias("u")
        .join(right.alias("k"), _same(keys, "u", "k"))
        .where(names.initials_fit(F.col("u._winner_letters"), F.col("k._winner_given")))
        .where(names.initials_fit(F.col("u._loser_letters"), F.col("k._loser_given")))
    )


def name_groups(
    feed: DataFrame,
    archive: DataFrame,
    block: tuple[str, ...] = BLOCK,
    parsed: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Pairs of fitting (block, round, name pair) groups with the number of records in each.

    Records with the same spelling are counted before names are parsed and compared, so copies of
    one record cost nothing here. ``f`` and ``a`` hold the record of a group of one. ``parsed`` are
    the name tables (``spelled``) of frames that hold these records.
    """
    keys = [*block, "round", *_NAMES]
    left = (
        ensure_columns(feed, FEED_COLUMNS)
        .dropna(subset=[block[-1], *_NAMES])
        .groupBy(*keys)
        .agg(F.count("*").alias("n"), F.min(F.struct("source_match_key", *RANKS)).alias("f"))
    )
    right = (
        ensure_columns(archive, ARCHIVE_COLUMNS)
        .dropna(subset=[block[-1], *_NAMES])
        .groupBy(*keys)
        .agg(
            F.count("*").alias("m"),
            F.min(F.struct("canonical_match_key", "winner_id", "loser_id", *RANKS)).alias("a"),
        )
    )
    short, full = spelled(feed, archive) if parsed is None else parsed
    left, right = _with_names(left, short, "letters"), _with_names(right, full, "given")
    pairs = _fitting(left, right, block)
    return pairs.select(*[F.col(f"u.{c}") for c in keys], "n", "f", "m", "a")


def name_links(groups: DataFrame, block: tuple[str, ...] = BLOCK) -> DataFrame:
    """Accepted links: one fitting archive record for the feed record, and the other way round."""
    scope = scope_of(block)
    seen = groups.groupBy(*scope, F.col("f.source_match_key").alias("_f")).agg(
        F.sum("m").alias("_m"),
        F.min("n").alias("_n"),
        F.min(F.struct("a", F.struct(*block, "round").alias("b"), "f")).alias("_pair"),
    )
    back = groups.groupBy(*scope, F.col("a.canonical_match_key").alias("_a")).agg(
        F.sum("n").alias("_back")
    )
    single = seen.where("_m = 1 and _n = 1").withColumn("_a", F.col("_pair.a.canonical_match_key"))
    single = single.join(back.where("_back = 1"), [*scope, "_a"])
    winner = agrees(F.col("_pair.f.winner_rank"), F.col("_pair.a.winner_rank"))
    loser = agrees(F.col("_pair.f.loser_rank"), F.col("_pair.a.loser_rank"))
    return _links(
        single.select(
            F.col("_f").alias("source_match_key"),
            F.col("_a").alias("canonical_match_key"),
            *[F.col(f"_pair.b.{c}").alias(c) for c in (*block, "round")],
            F.col("_pair.a.winner_id").alias("winner_id"),
            F.col("_pair.a.loser_id").alias("loser_id"),
            F.lit(BY_NAMES).alias("match_method"),
            F.lit(False).alias("review_flag"),
            quality_flag(winner, loser).alias("data_quality_flag"),
            F.col("_m").alias("source_candidate_count"),
            F.col("_back").alias("canonical_candidate_count"),
            F.lit(True).alias("round_agrees"),
            winner.alias("winner_rank_agrees"),
            loser.alias("loser_rank_agrees"),
        )
    )


def name_candidates(
    feed: DataFrame, groups: DataFrame, block: tuple[str, ...] = BLOCK
) -> DataFrame:
    """Feed records with at least one fitting archive record, and how many there are."""
    keys = (*block, "round", *_NAMES)
    counted = groups.groupBy(*keys).agg(F.sum("m").alias("source_candidate_count"))
    return (
        feed.alias("u")
        .join(counted.alias("k"), _same(keys, "u", "k"))
        .select("u.*", "source_candidate_count")
    )


def name_pairs(feed: DataFrame, archive: DataFrame, block: tuple[str, ...] = BLOCK) -> DataFrame:
    """Key pairs with fitting names: the review list of chosen records."""
    keys = [*block, "round", *_NAMES]
    left = feed.dropna(subset=[block[-1], *_NAMES]).select("source_match_key", *keys)
    right = archive.dropna(subset=[block[-1], *_NAMES]).select("canonical_match_key", *keys)
    short, full = spelled(left, right)
    left, right = _with_names(left, short, "letters"), _with_names(right, full, "given")
    return _fitting(left, right, block).select(
        *[F.col(f"u.{c}") for c in (*block, "round")], "source_match_key", "canonical_match_key"
    )


# --- pass 0: manual links -----------------------------------------------------------------------


def _due(manual: DataFrame, feed: DataFrame, block: tuple[str, ...] = BLOCK) -> DataFrame:
    """Manual links of the tours and seasons at hand; the table may hold others."""
    scope = scope_of(block, manual, feed)
    return manual.join(feed.select(*scope).distinct(), scope, "left_semi")


def manual_problems(
    manual: DataFrame, feed: DataFrame, archive: DataFrame, block: tuple[str, ...] = BLOCK
) -> DataFrame:
    """Manual links that name an unknown record or name one twice; empty when all is well.

    Named and known keys are counted by one aggregate for each side, so no task sorts both of them
    for a join. A key with a null part names no record.
    """
    due = _due(manual, feed, block)
    twice, unknown = F.col("_named") > 1, (F.col("_named") > 0) & (F.col("_known") == 0)
    problem = F.array_compact(F.array(F.when(twice, "named twice"), F.when(unknown, "unknown")))
    out = None
    for column, known in (("source_match_key", feed), ("canonical_match_key", archive)):
        keys = [*scope_of(block, manual, known), column]
        named = due.select(*keys, F.lit(1).alias("_named"), F.lit(0).alias("_known"))
        there = known.select(*keys, F.lit(0).alias("_named"), F.lit(1).alias("_known")).dropna(subset=keys)
        counted = named.unionByName(there).groupBy(*keys).agg(
            F.sum("_named").alias("_named"), F.max("_known").alias("_known")
        )
        part = counted.where(twice | unknown).select(
            F.lit(column).alias("column"), F.col(column).alias("match_key"), F.explode(problem).alias("problem")
        )
        out = part if out is None else out.unionByName(part)
    return out


def manual_links(
    manual: DataFrame, feed: DataFrame, archive: DataFrame, block: tuple[str, ...] = BLOCK
) -> DataFrame:
    """Links named by hand, as accepted. Feed and archive must carry their official ids.

    A manual table without a tour holds for every tour that has both records.
    """
    left = ensure_columns(feed, FEED_COLUMNS).select("source_match_key", *block, *RANKS)
    right = ensure_columns(archive, ARCHIVE_COLUMNS).select(
        *scope_of(block), "canonical_match_key", "winner_id", "loser_id"
    )
    given = scope_of(block, manual)
    named = (
        _due(manual, feed, block)
        .select(*given, "source_match_key", "canonical_match_key")
        .join(left, [*given, "source_match_key"])
        .join(right, [*scope_of(block), "canonical_match_key"])
    )
    return _links(
        named.withColumns({"match_method": F.lit(MANUAL), "review_flag": F.lit(False)})
    )


# --- all passes ---------------------------------------------------------------------------------


# Keys in one row of a list of members.
MEMBERS = 1024


@dataclass(frozen=True)
class Candidates:
    """Who could belong together, without a row per pair.

    ``members`` has the records of every group of equal evidence (a block and a rank pair, or a
    block, a round and a pair of spellings): found_in_pass, the block, side (``feed`` or
    ``archive``), evidence, and ``keys``, at most about MEMBERS match keys in a row. ``links`` says
    which feed group fits which archive group. Both grow with the records and the spellings; a
    group with a third of all records on both sides is that many keys, not their product.
    """

    members: DataFrame
    links: DataFrame
    block: tuple[str, ...] = BLOCK

    def _linked(self, side: str, other: DataFrame) -> DataFrame:
        own = self.members.where(F.col("side") == side)
        own = own.select("found_in_pass", *self.block, F.col("evidence").alias(f"{side}_evidence"), F.col("keys").alias(side))
        return other.join(own, ["found_in_pass", *self.block, f"{side}_evidence"])

    def pairs(self) -> DataFrame:
        """All pairs, unnested on demand: their number is that of the pairs."""
        both = self._linked("archive", self._linked("feed", self.links))
        one = both.withColumn("source_match_key", F.explode("feed"))
        return one.select(
            "found_in_pass", *self.block, "source_match_key", F.explode("archive").alias("canonical_match_key")
        )

    def best(self, k: int) -> DataFrame:
        """The first ``k`` candidates of every record, by key: at most k rows for each of them.

        A group's list is cut to k before groups meet, so no step holds more than k keys for a
        row of members.
        """
        first = lambda keys: F.slice(F.array_sort(F.flatten(keys)), 1, k)
        on = ["found_in_pass", *self.block]
        of_group = (
            self.members.where("side = 'archive'")
            .withColumn("keys", F.slice(F.array_sort("keys"), 1, k))
            .withColumn("_part", F.pmod(F.xxhash64("keys"), F.lit(64)))
            .groupBy(*on, "evidence", "_part")
            .agg(first(F.collect_list("keys")).alias("keys"))
            .groupBy(*on, F.col("evidence").alias("archive_evidence"))
            .agg(first(F.collect_list("keys")).alias("keys"))
        )
        met = self.links.join(of_group, [*on, "archive_evidence"])
        met = met.groupBy(*on, "feed_evidence").agg(first(F.collect_list("keys")).alias("archive"))
        own = self._linked("feed", met).withColumn("source_match_key", F.explode("feed"))
        return own.select(*on, "source_match_key", F.posexplode("archive").alias("rank", "canonical_match_key")).withColumn(
            "rank", F.col("rank") + 1
        )


def _evidence(keys: list[str]) -> Column:
    """The values of a group as one text; null differs from every value."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in keys]))


def _sides(left: DataFrame, right: DataFrame, number: int, block: tuple[str, ...]) -> DataFrame:
    """Records of both sides with their evidence, as (found_in_pass, block, side, evidence, key)."""
    parts = [
        df.select(F.lit(number).alias("found_in_pass"), *block, F.lit(side).alias("side"), "evidence", F.col(key).alias("key"))
        for df, side, key in ((left, "feed", "source_match_key"), (right, "archive", "canonical_match_key"))
    ]
    return parts[0].unionByName(parts[1])


def _linked_groups(pairs: DataFrame, number: int, block: tuple[str, ...]) -> DataFrame:
    return pairs.select(F.lit(number).alias("found_in_pass"), *block, "feed_evidence", "archive_evidence").distinct()


def _rank_groups(feed: DataFrame, archive: DataFrame, block: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Members and links of the groups with equal block and rank pair: each fits itself."""
    known = [block[-1], *RANKS]
    left, right = (df.dropna(subset=known).withColumn("evidence", _evidence([*RANKS])) for df in (feed, archive))
    on = [*block, "evidence"]
    groups = left.select(*on).distinct().join(right.select(*on).distinct(), on)
    members = _sides(left, right.join(groups, on, "left_semi"), 1, block)
    own = groups.select(*block, F.col("evidence").alias("feed_evidence"), F.col("evidence").alias("archive_evidence"))
    return members, _linked_groups(own, 1, block)


def _name_groups(feed: DataFrame, archive: DataFrame, block: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Members and links of the groups with equal block, round and spellings of both names."""
    keys = [*block, "round", *_NAMES]
    known = [block[-1], *_NAMES]
    left, right = (
        df.dropna(subset=known).withColumn("evidence", _evidence(["round", *_NAMES])) for df in (feed, archive)
    )
    spelled_left, spelled_right = (df.select(*keys, "evidence").distinct() for df in (left, right))
    short, full = spelled(spelled_left, spelled_right)
    fits = _fitting(_with_names(spelled_left, short, "letters"), _with_names(spelled_right, full, "given"), block)
    links = fits.select(
        *[F.col(f"u.{c}") for c in block], F.col("u.evidence").alias("feed_evidence"), F.col("k.evidence").alias("archive_evidence")
    )
    links = stage(_linked_groups(links, 2, block), "name-group-links")
    on = [*block, "evidence"]
    met = [links.select(*block, F.col(f"{side}_evidence").alias("evidence")).distinct() for side in ("feed", "archive")]
    return _sides(left.join(met[0], on, "left_semi"), right.join(met[1], on, "left_semi"), 2, block), links


def _listed(members: DataFrame, block: tuple[str, ...]) -> DataFrame:
    """Members as lists; a large group is split by a hash of the match key."""
    on = ["found_in_pass", *block, "side", "evidence"]
    large = members.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > MEMBERS)
    parts = F.coalesce(F.ceil(F.col("_n") / MEMBERS), F.lit(1))
    return (
        members.join(large, on, "left")
        .withColumn("_part", F.pmod(F.xxhash64("key"), parts))
        .groupBy(*on, "_part")
        .agg(F.sort_array(F.collect_list("key")).alias("keys"))
        .drop("_part")
    )


@dataclass(frozen=True)
class Linked:
    """Outcome of all passes.

    ``status`` has one row per feed record: ``linked``, ``ambiguous`` or ``unmatched``, the last
    with a reason. ``ambiguous`` lists the ambiguous feed records with their candidate counts and
    the pass that found them; ``candidates`` turns it into the review list.
    """

    feed: DataFrame
    archive: DataFrame
    accepted: DataFrame
    status: DataFrame
    ambiguous: DataFrame
    block: tuple[str, ...] = BLOCK

    @property
    def unmatched(self) -> DataFrame:
        """Feed records without a partner, with the reason."""
        keys = [*scope_of(self.block), "source_match_key"]
        rest = self.status.where("linkage_status = 'unmatched'").select(*keys, "linkage_status")
        return self.feed.join(rest, keys).withColumn("unmatched_reason", unmatched_reason())

    def candidates(self) -> Candidates:
        """Candidates of the ambiguous records by groups of equal evidence, never as pairs."""
        by_pass = {}
        keys = [*scope_of(self.block), "source_match_key"]
        for number in (1, 2):
            found = self.ambiguous.where(F.col("found_in_pass") == number)
            by_pass[number] = self.feed.join(found.select(*keys), keys, "left_semi")
        taken = self.accepted.where(F.col("match_method") != BY_NAMES)
        free = self.archive.join(taken, [*scope_of(self.block), "canonical_match_key"], "left_anti")
        by_ranks = _rank_groups(by_pass[1], self.archive, self.block)
        by_names = _name_groups(by_pass[2], free, self.block)
        members = _listed(by_ranks[0].unionByName(by_names[0]), self.block)
        return Candidates(members, by_ranks[1].unionByName(by_names[1]), self.block)

    def pairs(self) -> DataFrame:
        """Candidate pairs of the ambiguous records, one row per pass and pair."""
        return self.candidates().pairs()


def link(
    feed: DataFrame,
    archive: DataFrame,
    manual: DataFrame | None = None,
    *,
    block: tuple[str, ...] = BLOCK,
) -> Linked:
    """Run all passes for all seasons and tours at once.

    Both frames carry the official id already (``attach_official_ids``) and match keys that are
    unique within tour and season (the block without its event id).
    A record that is ambiguous by rank gets another chance by names; a linked record is never
    reconsidered. What the passes need of both sides is stored once, and so are the judged blocks of
    pass 1, the feed with the block of each record, and the name groups of pass 2. What pass 1 says
    of a record is read off its block, so the rest of both sides needs no join by match key.
    """
    feed, archive = ensure_columns(feed, FEED_COLUMNS), ensure_columns(archive, ARCHIVE_COLUMNS)
    scope = scope_of(block)
    own, other = [*scope, "source_match_key"], [*scope, "canonical_match_key"]
    all_feed = stage(feed.select(*dict.fromkeys([*block, *FEED_COLUMNS])), "link-feed")
    all_archive = stage(archive.select(*dict.fromkeys([*block, *ARCHIVE_COLUMNS])), "link-archive")
    by_hand = None
    free_feed, free_archive = all_feed, all_archive
    if manual is not None:
        by_hand = stage(manual_links(manual, all_feed, all_archive, block), "manual-links")
        free_feed = all_feed.join(by_hand, own, "left_anti")
        free_archive = all_archive.join(by_hand, other, "left_anti")

    blocks = stage(judged(rank_blocks(free_feed, free_archive, block)), "rank-blocks")
    first = rank_links(blocks)
    met = [*block, *RANKS]
    seen = stage(free_feed.join(blocks.select(*met, "n", "m", "linked"), met, "left"), "met-feed")
    several = seen.where("n > 1 or m > 1").select(
        *own, F.lit(1).alias("found_in_pass"),
        F.col("m").alias("source_candidate_count"), F.col("n").alias("canonical_candidate_count"),
    )

    left = seen.where("not coalesce(linked, false)").drop("n", "m", "linked")
    right = free_archive.join(blocks.where("linked").select(*met), met, "left_anti")
    parsed = spelled(all_feed, all_archive)
    groups = stage(name_groups(left, right, block, parsed), "name-groups")
    second = name_links(groups, block)
    named = name_candidates(left, groups, block).select(
        *own, F.lit(2).alias("found_in_pass"),
        "source_candidate_count", F.lit(None).cast("bigint").alias("canonical_candidate_count"),
    )

    accepted = first.unionByName(second)
    if by_hand is not None:
        accepted = by_hand.unionByName(accepted)
    candidates = several.unionByName(named)
    status = final_status(all_feed, accepted, candidates, scope)
    ambiguous = candidates.join(accepted, own, "left_anti")
    return Linked(feed, archive, accepted, status, ambiguous, block)


def final_status(
    feed: DataFrame, accepted: DataFrame, candidates: DataFrame, scope: list[str] = ["year", "tour"]  # noqa: B006
) -> DataFrame:
    """One status per feed record: linked beats ambiguous beats unmatched.

    One shuffle by scope and match key: the strongest evidence per key is a minimum over a union.
    """
    own = [*scope, "source_match_key"]
    every = feed.select(*own, F.lit(2).alias("_rank"))
    seen = accepted.select(
        *own, F.lit(0).alias("_rank"), F.col("match_method").alias("_method")
    ).unionByName(candidates.select(*own, F.lit(1).alias("_rank")), allowMissingColumns=True)
    best = (
        every.unionByName(seen, allowMissingColumns=True)
        .groupBy(*own)
        .agg(
            F.min("_rank").alias("_rank"),
            F.max("_method").alias("match_method"),
        )
    )
    label = F.element_at(
        F.array(F.lit("linked"), F.lit("ambiguous"), F.lit("unmatched")), F.col("_rank") + 1
    )
    return best.select(
        "source_match_key", *scope, label.alias("linkage_status"), "match_method"
    )


# --- outputs ------------------------------------------------------------------------------------

CROSSWALK_COLUMNS = (
    "year", "tour", "source_match_key", "canonical_match_key", "official_tournament_id",
    "winner_id", "loser_id", "match_method", "review_flag", "data_quality_flag",
    "source_candidate_count", "canonical_candidate_count", "round_agrees",
    "winner_rank_points_diff", "loser_rank_points_diff",
)

ENRICHED_BLOCK = (
    "canonical_match_key", "official_tournament_id", "canonical_tourney_id",
    "canonical_tourney_name", "canonical_round", "canonical_winner_id", "canonical_winner_name",
    "canonical_loser_id", "canonical_loser_name", "match_method", "review_flag",
    "data_quality_flag",
)


def crosswalk(accepted: DataFrame) -> DataFrame:
    """Compact lineage: one row per accepted link."""
    return accepted.select(*CROSSWALK_COLUMNS)


def enrich(feed: DataFrame, archive: DataFrame, accepted: DataFrame) -> DataFrame:
    """Every feed record, with a fixed block of link and archive columns behind its own."""
    scope = ["year", "tour"]
    links = accepted.select(
        *scope,
        "source_match_key",
        "canonical_match_key",
        "official_tournament_id",
        F.col("winner_id").alias("canonical_winner_id"),
        F.col("loser_id").alias("canonical_loser_id"),
        "match_method",
        "review_flag",
        "data_quality_flag",
    )
    texts = ("winner_name", "loser_name", "tourney_id", "tourney_name", "round")
    truth = ensure_columns(archive, {c: "string" for c in texts}).select(
        *scope, "canonical_match_key", *[F.col(c).alias(f"canonical_{c}") for c in texts]
    )
    detail = links.join(truth, [*scope, "canonical_match_key"], "left")
    own = [c for c in feed.columns if c not in ENRICHED_BLOCK]
    return (
        feed.select(*own)
        .join(detail, [*scope, "source_match_key"], "left")
        .select(*own, *ENRICHED_BLOCK)
    )


def linkage_summary(status: DataFrame, archive: DataFrame) -> DataFrame:
    """Coverage per (tour, year). The three buckets add up to the total by construction."""

    def method(name: str) -> Column:
        return F.count_if(F.col("match_method") == name)

    def bucket(name: str) -> Column:
        return F.count_if(F.col("linkage_status") == name)

    total = F.count("*")
    own = status.groupBy("year", "tour").agg(
        total.alias("uk_total_matches"),
        bucket("linked").alias("linked_matches"),
        method(MANUAL).alias("linked_manual"),
        method(BY_RANK).alias("linked_pass_1"),
        method(BY_NAMES).alias("linked_pass_2"),
        bucket("ambiguous").alias("ambiguous_matches"),
        bucket("unmatched").alias("unmatched_matches"),
        F.bround(100 * bucket("linked") / total, 1).alias("coverage_pct"),
    )
    other = archive.groupBy("year", "tour").agg(F.count("*").alias("sackmann_total_matches"))
    return own.join(other, ["year", "tour"], "left").select(
        "year", "tour", "uk_total_matches",
        F.coalesce("sackmann_total_matches", F.lit(0)).alias("sackmann_total_matches"),
        "linked_matches", "linked_manual", "linked_pass_1", "linked_pass_2",
        "ambiguous_matches", "unmatched_matches", "coverage_pct",
    )
