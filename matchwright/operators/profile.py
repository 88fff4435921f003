"""Coverage, agreement, majority mappings and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import interval_join


def coverage(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Rows, rows with and without the value, and the share with it."""
    groups = df.groupBy(*(by or []))
    return groups.agg(
        F.count("*").alias("matches"),
        F.count(value).alias("mapped"),
        F.count_if(F.col(value).isNull()).alias("unmapped"),
        (F.count(value) / F.count("*")).alias("coverage"),
    )


def link_coverage(source: DataFrame, links: DataFrame, key: str, by: list[str]) -> DataFrame:
    """How many source records have a link, per ``by``."""
    linked = links.select(key).distinct().withColumn("_linked", F.lit(1))
    joined = source.join(linked, key, "left")
    return joined.groupBy(*by).agg(
        F.count("*").alias("total_matches"),
        F.count("_linked").alias("linked_matches"),
        (F.count("*") - F.count("_linked")).alias("unlinked_matches"),
        (F.count("_linked") / F.count("*")).alias("coverage"),
    )


def dominant_mapping(
    df: DataFrame, source: list[str], target: str, *, least: int = 2, share: float = 0.9
) -> DataFrame:
    """The target most often seen with a source, if seen ``least`` times and with that share.

    Counted per (source, target) first, then the best per source is an aggregate too; equal counts
    are decided by the smaller target.
    """
    votes = df.groupBy(*source, target).agg(F.count("*").alias("n"))
    best = votes.groupBy(*source).agg(
        F.min(F.struct((-F.col("n")).alias("m"), F.col(target).alias("t"))).alias("_top"),
        F.sum("n").alias("n_total"),
    )
    top = best.select(
        *source, F.col("_top.t").alias(target), (-F.col("_top.m")).alias("n"), "n_total"
    )
    return top.where((F.col("n") >= least) & (F.col("n") / F.col("n_total") >= share))


def column_profile(df: DataFrame, columns: list[str] | None = None, *, exact: bool = False):
    """Per column: type, share missing in percent, number of distinct values.

    One aggregate over all columns. Distinct counts are sketches unless ``exact`` is asked for,
    which costs one more shuffle of the data per column.
    """
    columns = columns or df.columns
    count = F.count_distinct if exact else F.approx_count_distinct
    one = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)],
        *[count(F.col(f"`{c}`")).alias(f"_d{i}") for i, c in enumerate(columns)],
    )
    types = dict(df.dtypes)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            F.bround(100 * (F.col("_rows") - F.col(f"_c{i}")) / F.col("_rows"), 2).alias(
                "missing_pct"
            ),
            F.col(f"_d{i}").alias("distinct_values"),
        )
        for i, c in enumerate(columns)
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def pair_agreement(df: DataFrame, pairs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Percent of rows with equal values, among the rows where both are there."""
    one = df.agg(
        *[
            F.bround(
                100 * F.count_if(a == b) / F.nullif(F.count_if((a == b).isNotNull()), F.lit(0)), 2
            ).alias(name)
            for name, (a, b) in pairs.items()
        ]
    )
    return one.unpivot([], list(pairs), "concept", "agreement_pct")


def unique_both(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs whose partners occur in no other pair."""
    single_left = pairs.groupBy(left).agg(F.count("*").alias("_n")).where("_n = 1")
    single_right = pairs.groupBy(right).agg(F.count("*").alias("_n")).where("_n = 1")
    return pairs.join(single_left.select(left), left, "left_semi").join(
        single_right.select(right), right, "left_semi"
    )


def unique_in_window(
    feed: DataFrame, archive: DataFrame, keys: list[str], low: int, high: int
) -> DataFrame:
    """Pairs with equal keys, ``low`` to ``high`` days from ``archive_day`` to ``feed_day``, whose
    partners have no other pair.

    Records are counted per (key, day) first and only days are compared, so a key with very many
    records costs as many comparisons as the window has days, not as there are pairs of records.
    """
    left = feed.groupBy(*keys, "feed_day").agg(
        F.count("*").alias("_n"),
        F.min(F.struct(*[c for c in feed.columns if c not in keys])).alias("_f"),
    )
    right = archive.groupBy(*keys, "archive_day").agg(
        F.count("*").alias("_m"),
        F.min(F.struct(*[c for c in archive.columns if c not in keys])).alias("_a"),
    )
    near = interval_join(
        right, left, keys, F.unix_date("archive_day"), F.unix_date("feed_day"), low, high
    )
    of_feed = near.groupBy(*keys, "feed_day").agg(
        F.sum("_m").alias("_partners"), F.min(F.struct("archive_day", "_a", "_f", "_n")).alias("_p")
    )
    of_archive = near.groupBy(*keys, "archive_day").agg(F.sum("_n").alias("_back"))
    single = of_feed.where("_partners = 1 and _p._n = 1").withColumn(
        "archive_day", F.col("_p.archive_day")
    )
    found = single.join(of_archive.where("_back = 1"), [*keys, "archive_day"])
    return found.select(*keys, "_p._f.*", "_p._a.*")


def link_by_aliases(
    feed: DataFrame,
    archive: DataFrame,
    *,
    low: int = -2,
    high: int = 25,
    least: int = 2,
    share: float = 0.9,
) -> DataFrame:
    """Link without an event table, learning which feed name is which archive person.

    First equal rank pairs within a window of days that are unique both ways; their names vote for
    a person id; then what is left is joined by the learned ids within the same window, again only
    where unique. Feed: ``tour, feed_id, day, winner, loser, winner_rank, loser_rank``; archive:
    ``tour, archive_id, day, winner_id, loser_id, winner_rank, loser_rank``.
    """
    f = feed.withColumnRenamed("day", "feed_day")
    a = archive.withColumnRenamed("day", "archive_day")
    ranks = ["tour", "winner_rank", "loser_rank"]
    by_rank = unique_in_window(f.dropna(subset=ranks), a.dropna(subset=ranks), ranks, low, high)
    seen = by_rank.select(
        "tour",
        F.explode(
            F.array(
                F.struct(F.col("winner").alias("name"), F.col("winner_id").alias("person")),
                F.struct(F.col("loser").alias("name"), F.col("loser_id").alias("person")),
            )
        ).alias("p"),
    ).select("tour", "p.*")
    learned = dominant_mapping(seen, ["tour", "name"], "person", least=least, share=share)

    rest = f.drop("winner_rank", "loser_rank").join(by_rank, "feed_id", "left_anti")
    for side in ("winner", "loser"):
        known = learned.select(
            "tour", F.col("name").alias(side), F.col("person").alias(f"{side}_id")
        )
        rest = rest.join(known, ["tour", side])
    free = a.drop("winner_rank", "loser_rank").join(by_rank, "archive_id", "left_anti")
    by_name = unique_in_window(rest, free, ["tour", "winner_id", "loser_id"], low, high)
    return by_rank.select("feed_id", "archive_id", F.lit("rank").alias("link_method")).unionByName(
        by_name.select("feed_id", "archive_id", F.lit("name").alias("link_method"))
    )
