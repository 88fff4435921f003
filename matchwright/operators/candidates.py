"""Scored pairs of events: who could be the same, without pairing a block with itself.

score = 0.5 * name + 0.4 * date + 0.1 * surface, where name is the best gestalt ratio over the
name variants of both sides, date falls evenly to 0 at ``max_days``, and surface is 1 if equal.

The ratio that a pair's names need to reach the floor follows from its dates and surfaces. Pairs
that need less than any two days would do with are so near that they meet in a bucket of days; a
stricter floor makes the buckets narrow. All others are found by an index of pieces of their names,
cut so that some piece is untouched at that ratio; where the floor can't be reached without near
days, there is no such step. The two cases exclude each other and lose no pair at or above the floor.

Events meet in tiles of bounded lists. A task scores a whole tile with arrays and lets go what is
below the floor, most of it by bounds on the characters that can match; asked for lists, it keeps only the best pairs of every event and says which events
had more. So a day with thousands of events never becomes rows for all of its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import gestalt, similarity
from ..functions.text import normalize_title
from ..session import stage

NAME_WEIGHT, DATE_WEIGHT, SURFACE_WEIGHT = 0.5, 0.4, 0.1
FLOOR = 0.5
MAX_DAYS = 10
TILE = 256
# Ids in one list of equal events.
MEMBERS = 1024
PAIRS_AT_ONCE = 1 << 18
BINS = 32
_SLACK = 1e-9


@dataclass(frozen=True)
class Side:
    """Columns of one side: its id, the name variants, the day and the surface."""

    id: str
    names: list[str]
    day: str = "start_date"
    surface: str = "surface"


@dataclass(frozen=True)
class Rule:
    floor: float = FLOOR
    max_days: int = MAX_DAYS

    def __post_init__(self) -> None:
        if self.floor <= SURFACE_WEIGHT:
            raise ValueError(f"the floor must be above {SURFACE_WEIGHT}: any pair would reach it")

    @property
    def indexed(self) -> float:
        """The ratio that suffices on any two days; pairs that need it or more are found by their names."""
        least = (self.floor - SURFACE_WEIGHT) / NAME_WEIGHT
        return least if least <= 1 + _SLACK else float("inf")

    @property
    def reach(self) -> int:
        """Days apart within which a pair can do with a lower ratio."""
        rest = NAME_WEIGHT * min(self.indexed, 1.0) + DATE_WEIGHT + SURFACE_WEIGHT - self.floor
        return min(self.max_days, int(np.floor(rest * self.max_days / DATE_WEIGHT + _SLACK)))


def prepared(df: DataFrame, side: Side, block: list[str]) -> DataFrame:
    """(block, event): the event as id, id as text, day, surface and different names."""
    texts = [normalize_title(F.col(n)) for n in side.names]
    return df.select(
        *block,
        F.struct(
            F.col(side.id).alias("id"),
            F.col(side.id).cast("string").alias("text"),
            F.unix_date(F.col(side.day).cast("date")).alias("day"),
            F.lower(F.col(side.surface)).alias("surface"),
            F.array_distinct(F.array(*texts)).alias("names"),
        ).alias("event"),
    )


def _chunks(events: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, events): lists of about TILE events; large groups are split by a hash of the id."""
    sizes = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > TILE)
    parts = F.coalesce(F.ceil(F.col("_n") / TILE), F.lit(1))
    return (
        events.join(sizes, keys, "left")
        .withColumn("_part", F.pmod(F.xxhash64("event.text"), parts))
        .groupBy(*keys, "_part")
        .agg(F.collect_list("event").alias("events"))
        .drop("_part")
    )


def _near_tiles(left: DataFrame, right: DataFrame, block: list[str], rule: Rule) -> DataFrame:
    """Lists of the same and of neighbouring buckets of days."""
    width = max(1, rule.reach + 1)
    bucket = F.floor(F.col("event.day") / width)

    def lists(events: DataFrame, name: str) -> DataFrame:
        dated = events.where("event.day is not null").withColumn("_bucket", bucket)
        return _chunks(dated, [*block, "_bucket"]).withColumnRenamed("events", name)

    around = F.explode(F.sequence(F.col("_bucket") - 1, F.col("_bucket") + 1))
    a = lists(left, "l").withColumn("_bucket", around)
    return a.join(lists(right, "r"), [*block, "_bucket"]).select(*block, "l", "r", F.lit(True).alias("near"))


def _alike_tiles(left: DataFrame, right: DataFrame, block: list[str], rule: Rule) -> DataFrame:
    """Lists of events whose names reach the ratio of the index; each pair of names is asked once."""
    least = rule.indexed

    def named(events: DataFrame, name: str) -> DataFrame:
        return events.withColumn(name, F.explode("event.names")).where(F.col(name).isNotNull())

    def keyed(events: DataFrame, name: str, cut) -> DataFrame:
        names = named(events, name).select(*block, name).distinct()
        return names.withColumn("_key", F.explode(cut(F.col(name), least)))

    a, b = keyed(left, "_a", similarity.probe_keys), keyed(right, "_b", similarity.piece_keys)
    met = a.join(b, [*block, "_key"]).select(*block, "_a", "_b").distinct()
    close = similarity.shared_bound(F.col("_a"), F.col("_b")) >= least - _SLACK
    alike = met.where(close).where(similarity.sequence_ratio("_a", "_b") >= least - _SLACK)
    l = _chunks(named(left, "_a"), [*block, "_a"]).withColumnRenamed("events", "l")
    r = _chunks(named(right, "_b"), [*block, "_b"]).withColumnRenamed("events", "r")
    tiles = alike.join(l, [*block, "_a"]).join(r, [*block, "_b"])
    return tiles.select(*block, "l", "r", F.lit(False).alias("near"))


class _Events:
    """The events of one side of a batch, as arrays."""

    def __init__(self, lists: pa.ListArray, codes: dict[str, int], surfaces: dict[str, int]) -> None:
        self.sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        fields = dict(zip([f.name for f in lists.type.value_type], lists.flatten().flatten(), strict=True))
        self.ids, self.texts = fields["id"], fields["text"]
        days = fields["day"].cast(pa.float64())
        self.days = days.fill_null(np.nan).to_numpy(zero_copy_only=False)
        self.surfaces = np.array(
            [-1 if s is None else surfaces.setdefault(s, len(surfaces)) for s in fields["surface"].to_pylist()],
            dtype=np.int64,
        )
        names = fields["names"].to_pylist()
        self.names = np.full((len(names), max(map(len, names), default=0)), -1, dtype=np.int64)
        for i, own in enumerate(names):
            self.names[i, : len(own)] = [-1 if n is None else codes.setdefault(n, len(codes)) for n in own]


def _upper(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of names and how often each class of characters stands in them."""
    lengths = np.array([len(n) for n in names], dtype=np.int64)
    counts = np.zeros((len(names), BINS), dtype=np.int64)
    codes = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.int32)
    np.add.at(counts, (np.repeat(np.arange(len(names)), lengths), codes % BINS), 1)
    return lengths, np.minimum(counts, 255).astype(np.uint8)


def _byte_sums(rows: np.ndarray) -> np.ndarray:
    """Sums of rows of BINS bytes: bytes in lanes of 16 bits, lanes added by one multiplication."""
    words, low = rows.view(np.uint64), np.uint64(0x00FF00FF00FF00FF)
    lanes = ((words & low) + (words >> np.uint64(8) & low)).sum(axis=1)
    return (lanes * np.uint64(0x0001000100010001) >> np.uint64(48)).astype(np.int64)


def _rank(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Place of each element in its group by falling value, from 0."""
    order = np.lexsort((-value, group))
    own = group[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    out = np.empty(len(own), np.int64)
    out[order] = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
    return out


def _kth(group: np.ndarray, value: np.ndarray, k: int, size: int, least: float) -> np.ndarray:
    """The k-th largest value of each of ``size`` groups, ``least`` for smaller groups."""
    out = np.full(size, least)
    at = _rank(group, value) == k - 1
    out[group[at]] = value[at]
    return out


class _Tile:
    """Pairs of some tiles, scored."""

    def __init__(self, left: _Events, right: _Events, li, ri, near, rule: Rule, names: list[str]) -> None:
        days = np.abs(left.days[li] - right.days[ri])
        # Where near pairs are wanted, none is more than the reach apart; most of a tile may be.
        within = np.flatnonzero(~near | (days <= rule.reach))
        if len(within) < len(li):
            li, ri, near, days = li[within], ri[within], near[within], days[within]
        date = np.nan_to_num(np.maximum(0.0, 1 - days / float(rule.max_days)))
        own = left.surfaces[li]
        surface = ((own >= 0) & (own == right.surfaces[ri])).astype(float)
        rest = DATE_WEIGHT * date + SURFACE_WEIGHT * surface
        need = (rule.floor - rest) / NAME_WEIGHT
        kept = np.where(near, need < rule.indexed, need >= rule.indexed) & (need <= 1 + _SLACK)
        self.left, self.right, self.rule, self.names = left, right, rule, names
        self.li, self.ri, self.date, self.surface = li[kept], ri[kept], date[kept], surface[kept]
        self.rest = rest[kept]

    def cut(self, kept: np.ndarray) -> None:
        for name in ("li", "ri", "date", "surface", "rest"):
            setattr(self, name, getattr(self, name)[kept])

    def variants(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows with a name on both sides, and these names, for every two variants."""
        for a in range(self.left.names.shape[1]):
            for b in range(self.right.names.shape[1]):
                x, y = self.left.names[self.li[rows], a], self.right.names[self.ri[rows], b]
                known = (x >= 0) & (y >= 0)
                yield np.flatnonzero(known), x[known], y[known]

    def bounds(self, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """No score can be higher: names match at most in the characters they share."""
        out = np.full(len(self.li), -np.inf)
        for at, x, y in self.variants(np.arange(len(self.li))):
            shared = _byte_sums(np.minimum(counts[x], counts[y]))
            # Counts end at 255: beyond, only the lengths bound.
            long, short = np.maximum(lengths[x], lengths[y]), np.minimum(lengths[x], lengths[y])
            shared = np.where(long < 255, shared, short)
            ratio = np.where(long == 0, 1.0, 2.0 * shared / np.maximum(1, long + short))
            out[at] = np.maximum(out[at], NAME_WEIGHT * ratio)
        return out + self.rest

    def closer(self, upper: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Lower bounds than ``upper``: what matches stands in the same order in both names."""
        out = np.full(len(self.li), -np.inf)
        for at, x, y in self.variants(np.arange(len(self.li))):
            total = lengths[x] + lengths[y]
            ratio = np.where(total == 0, 1.0, 2.0 * gestalt.subsequence_bounds(self.names, x, y) / np.maximum(1, total))
            out[at] = np.maximum(out[at], NAME_WEIGHT * ratio)
        return np.minimum(upper, out + self.rest)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Exact scores; every two different names are compared once."""
        best = np.full(len(rows), -np.inf)
        found = list(self.variants(rows))
        keys = np.concatenate([x * len(self.names) + y for _, x, y in found]) if found else np.zeros(0, np.int64)
        pairs, back = np.unique(keys, return_inverse=True)
        a, b = pairs // max(1, len(self.names)), pairs % max(1, len(self.names))
        rated = gestalt.ratios([self.names[i] for i in a], [self.names[i] for i in b])[back]
        start = 0
        for at, x, _ in found:
            np.maximum.at(best, at, rated[start : start + len(x)])
            start += len(x)
        return NAME_WEIGHT * best + DATE_WEIGHT * self.date[rows] + SURFACE_WEIGHT * self.surface[rows]

    def best(self, upper: np.ndarray, keep: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows at or above the floor with their scores, and which events had more than is kept."""
        every = np.arange(len(self.li))
        n_left, n_right = len(self.left.days), len(self.right.days)
        more_left, more_right = np.zeros(n_left, bool), np.zeros(n_right, bool)
        if keep is None:
            scores = self.scores(every)
            good = scores >= self.rule.floor
            return every[good], scores[good], more_left, more_right
        # First the pairs that look best; then those that could still be among the best of an event.
        first = (_rank(self.li, upper) < keep) | (_rank(self.ri, upper) < keep)
        rows = every[first]
        scores = self.scores(rows)
        least = [self.kth(side, rows, scores, keep) for side in (0, 1)]
        second = every[~first & ((upper >= least[0][self.li] - _SLACK) | (upper >= least[1][self.ri] - _SLACK))]
        rows, scores = np.r_[rows, second], np.r_[scores, self.scores(second)]
        good = scores >= self.rule.floor
        rows, scores = rows[good], scores[good]
        least = [self.kth(side, rows, scores, keep) for side in (0, 1)]
        tied = (scores >= least[0][self.li[rows]]) | (scores >= least[1][self.ri[rows]])
        kept, kept_scores = rows[tied], scores[tied]
        ties = self.ties(kept)
        order = np.lexsort((ties, -kept_scores))
        place = np.empty(len(kept))
        place[order] = -np.arange(len(kept), dtype=float)
        own = (_rank(self.li[kept], place) < keep) | (_rank(self.ri[kept], place) < keep)
        left_out = np.ones(len(every), bool)
        left_out[kept[own]] = False
        below = np.setdiff1d(np.r_[every[first], second], rows, assume_unique=True)
        left_out[below] = False
        more_left[self.li[left_out]] = True
        more_right[self.ri[left_out]] = True
        return kept[own], kept_scores[own], more_left, more_right

    def kth(self, side: int, rows: np.ndarray, scores: np.ndarray, keep: int) -> np.ndarray:
        good = scores >= self.rule.floor
        group, size = ((self.li, len(self.left.days)), (self.ri, len(self.right.days)))[side]
        return _kth(group[rows][good], scores[good], keep, size, self.rule.floor)

    def ties(self, rows: np.ndarray) -> np.ndarray:
        """MD5 of both ids, as the assignment orders equal scores."""
        left, right = self.left.texts.take(pa.array(self.li[rows])), self.right.texts.take(pa.array(self.ri[rows]))
        joined = ("|".join(x for x in p if x is not None) for p in zip(left.to_pylist(), right.to_pylist(), strict=True))
        return np.array([hashlib.md5(x.encode()).hexdigest() for x in joined], dtype="S32")


def _scored(tiles: DataFrame, block: list[str], rule: Rule, keep: int | None) -> DataFrame:
    """(block, l_id, r_id, score, l_more, r_more) of all tiles."""
    from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

    event = lambda side: tiles.schema[side].dataType.elementType["id"].dataType
    schema = StructType(
        [tiles.schema[c] for c in block]
        + [StructField("l_id", event("l")), StructField("r_id", event("r")), StructField("score", DoubleType())]
        + [StructField("l_more", BooleanType()), StructField("r_more", BooleanType())]
    )

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes: dict[str, int] = {}
        surfaces: dict[str, int] = {}
        left, right = (_Events(batch.column(c), codes, surfaces) for c in ("l", "r"))
        names = list(codes)
        lengths, counts = _upper(names)
        sizes = left.sizes * right.sizes
        # For every event on the left, the tile it is in and how many events on the right it meets.
        tile = np.repeat(np.arange(len(sizes)), left.sizes)
        meets = right.sizes[tile]
        li = np.repeat(np.arange(len(tile), dtype=np.int32), meets)
        first = (np.cumsum(right.sizes) - right.sizes)[tile] - (np.cumsum(meets) - meets)
        ri = (np.arange(len(li)) + np.repeat(first, meets)).astype(np.int32)
        near = np.repeat(batch.column("near").to_numpy(zero_copy_only=False).astype(bool), sizes)
        pairs = _Tile(left, right, li, ri, near, rule, names)
        upper = pairs.bounds(lengths, counts)
        good = upper >= rule.floor - _SLACK
        pairs.cut(good)
        upper = pairs.closer(upper[good], lengths)
        good = upper >= rule.floor - _SLACK
        pairs.cut(good)
        upper = upper[good]
        rows, scores, more_left, more_right = pairs.best(upper, keep)
        li, ri = pairs.li[rows], pairs.ri[rows]
        owner = pa.array(tile[li])
        columns = [batch.column(c).take(owner) for c in block]
        columns += [left.ids.take(pa.array(li)), right.ids.take(pa.array(ri)), pa.array(scores, pa.float64())]
        columns += [pa.array(more_left[li]), pa.array(more_right[ri])]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.multiply(
                *(pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("l", "r"))
            )
            start = 0
            while start < batch.num_rows:
                end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), PAIRS_AT_ONCE)))
                yield scored(batch.slice(start, end - start))
                start = end

    # The tiles of one crowded day are one key of the join before; here they go to all tasks.
    parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.select(*block, "l", "r", "near").repartition(parts, F.xxhash64("l.text", "r.text"))
    return dealt.mapInArrow(run, schema)


def _met(left: DataFrame, right: DataFrame, block: list[str], rule: Rule, keep: int | None) -> DataFrame:
    """Scored pairs of two prepared sides, each once, also if several of their names are alike."""
    near = _scored(_near_tiles(left, right, block, rule), block, rule, keep)
    if rule.indexed > 1 + _SLACK:
        found = near
    else:
        found = near.unionByName(_scored(_alike_tiles(left, right, block, rule), block, rule, keep))
    return found.groupBy(*block, "l_id", "r_id").agg(
        F.max("score").alias("score"), F.max("l_more").alias("l_more"), F.max("r_more").alias("r_more")
    )


def candidates(
    left: DataFrame,
    right: DataFrame,
    left_side: Side,
    right_side: Side,
    *,
    block: list[str],
    floor: float = FLOOR,
    max_days: int = MAX_DAYS,
) -> DataFrame:
    """Every pair of a block whose score reaches ``floor``: block, l_id, r_id, score.

    A missing name is an empty one; ids count once, whatever the number of their rows.

    Events of one block that are equal but for their id are scored as one, and their pairs are
    unnested from lists of ids at the end. So pairs of events are rows of the result only: they cross
    no exchange, unless one of their ids has several different rows.
    """
    l, r = (
        stage(_alike(prepared(df, side, block), block), "alike-events")
        for df, side in ((left, left_side), (right, right_side))
    )
    kinds = [events.select(*block, _kind_event().alias("event")).distinct() for events in (l, r)]
    found = stage(_met(*kinds, block, Rule(floor, max_days), None), "kind-pairs")
    found = found.select(*block, F.col("l_id").alias("l_kind"), F.col("r_id").alias("r_kind"), "score")
    for side, events in (("l", l), ("r", r)):
        found = found.join(_members(events, block, side), [*block, f"{side}_kind"])
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.repartition(parts, F.xxhash64("l_ids", "r_ids"))

    def unnested(rows: DataFrame) -> DataFrame:
        rows = rows.select(*block, F.explode("l_ids").alias("l_id"), "r_ids", "score")
        return rows.select(*block, "l_id", F.explode("r_ids").alias("r_id"), "score")

    several = unnested(found.where("l_several or r_several"))
    several = several.groupBy(*block, "l_id", "r_id").agg(F.max("score").alias("score"))
    return unnested(found.where("not l_several and not r_several")).unionByName(several)


def _alike(events: DataFrame, block: list[str]) -> DataFrame:
    """(block, id, kind, event, several): different rows; equal but for the id is one kind.

    ``several`` says that the id has rows of more than one kind in its block.
    """
    kind = F.to_json(F.struct("event.day", "event.surface", "event.names"))
    rows = events.withColumn("kind", kind).select(*block, F.col("event.id").alias("id"), "kind", "event").distinct()
    twice = rows.groupBy(*block, "id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    twice = twice.select(*[F.col(c).alias(f"_b_{c}") for c in block], F.col("id").alias("_id"))
    same = F.col("id").eqNullSafe(F.col("_id"))
    for c in block:
        same = same & (F.col(c) == F.col(f"_b_{c}"))
    joined = rows.join(twice.withColumn("_twice", F.lit(True)), same, "left")
    return joined.select(*block, "id", "kind", "event", F.col("_twice").isNotNull().alias("several"))


def _kind_event() -> Column:
    """An event that stands for all of its kind."""
    fields = [F.col(f"event.{c}").alias(c) for c in ("day", "surface", "names")]
    return F.struct(F.col("kind").alias("id"), F.col("kind").alias("text"), *fields)


def _members(events: DataFrame, block: list[str], side: str) -> DataFrame:
    """Ids of every kind as lists of about MEMBERS, those with several rows in lists of their own."""
    keys = [*block, "kind", "several"]
    sizes = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MEMBERS)
    part = F.pmod(F.xxhash64("id"), F.coalesce(F.ceil(F.col("_n") / MEMBERS), F.lit(1)))
    lists = events.join(sizes, keys, "left").withColumn("_part", part).groupBy(*keys, "_part")
    # Null is an id like any other here, but no list holds a null of itself.
    ids = F.transform(F.collect_list(F.struct("id")), lambda x: x["id"])
    return lists.agg(ids.alias(f"{side}_ids")).select(
        *block, F.col("kind").alias(f"{side}_kind"), F.col("several").alias(f"{side}_several"), f"{side}_ids"
    )


def tie(l_id: Column, r_id: Column) -> Column:
    """Equal scores are ordered by the MD5 of both ids."""
    return F.md5(F.concat_ws("|", l_id.cast("string"), r_id.cast("string")))


def lists(left: DataFrame, right: DataFrame, block: list[str], rule: Rule, keep: int) -> DataFrame:
    """Each event's ``keep`` best pairs: block, l_id, r_id, score, in_l, in_r, l_more, r_more.

    A pair is there if it is on the list of either event, ``in_l`` and ``in_r`` tell on which.
    ``l_more`` and ``r_more`` tell that the event has pairs that are on no list; all of them come
    after those on its own list, in the order by falling score and MD5 of the ids.
    """
    from pyspark.sql import Window

    found = _met(left, right, block, rule, keep)
    found = found.withColumn("_tie", tie(F.col("l_id"), F.col("r_id")))
    for side in ("l", "r"):
        own = Window.partitionBy(*block, f"{side}_id")
        place = F.row_number().over(own.orderBy(F.desc("score"), "_tie", "l_id", "r_id"))
        more = F.max(f"{side}_more").over(own) | (F.count(F.lit(1)).over(own) > keep)
        found = found.withColumn(f"in_{side}", place <= keep).withColumn(f"{side}_more", more)
    return found.where("in_l or in_r").drop("_tie")
