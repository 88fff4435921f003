"""Gates as data: every check yields violations, the caller decides whether to stop."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

# Fixed values.
SURFACES = ("hard", "clay", "grass", "carpet")
ROUNDS = ("R128", "R64", "R32", "R16", "QF", "SF", "F", "RR")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise KeyError(f"missing required columns: {missing}")


def require_own_dataset(df: DataFrame, own: str, others: Iterable[str]) -> None:
    """The id column of this tour must be there; that of another tour hints at a mix-up."""
    if own in df.columns:
        return
    hint = [c for c in others if c in df.columns]
    raise ValueError(f"no column {own!r}" + (f", but {hint}: wrong data set?" if hint else ""))


def schema_drift(columns: Iterable[str], previous: Iterable[str]) -> dict[str, list[str]]:
    """Columns that came and went between two versions of a file."""
    now, before = set(columns), set(previous)
    return {"added": sorted(now - before), "removed": sorted(before - now)}


def presence_drift(df: DataFrame, season: str, code: str) -> DataFrame:
    """The same on data: codes that appear or vanish from one season (a number) to the next."""
    seen = df.select(F.col(season).alias("season"), F.col(code).alias("code")).distinct()
    seasons = seen.select("season").distinct()
    shifted = seen.select((F.col("season") + 1).alias("season"), "code")
    both = (
        seen.withColumn("_now", F.lit(1))
        .join(shifted.withColumn("_before", F.lit(1)), ["season", "code"], "full_outer")
        .join(seasons.join(seasons.select((F.col("season") + 1).alias("season")), "season"), "season")
    )
    change = F.when(F.col("_before").isNull(), "added").when(F.col("_now").isNull(), "removed")
    return both.select("season", "code", change.alias("change")).where("change is not null")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    some = duplicate_keys(df, keys).limit(5).collect()
    if some:
        raise ValueError(f"{what} must be unique by {keys}, e.g. {[tuple(r)[:-1] for r in some]}")


def clean_rules(
    *,
    surfaces: Iterable[str] = SURFACES,
    rounds: Iterable[str] = ROUNDS,
    odds: Iterable[str] = (),
    best_of: Iterable[int] = (3, 5),
) -> dict[str, Column]:
    """Rules of a clean match, as conditions that hold for a bad row; order is the report order."""
    c = F.col
    day_year, day_month = F.year("match_date"), F.month("match_date")
    in_season = (c("year") == day_year) | ((c("year") == day_year + 1) & (day_month == 12))
    completed = c("match_status") == "completed"
    rules = {
        "unexpected_surface": c("surface").isNotNull() & ~c("surface").isin(*surfaces),
        "unexpected_round": c("round").isNotNull() & ~c("round").isin(*rounds),
        "missing_players_remaining": c("round").isNotNull() & c("players_remaining").isNull(),
        "players_remaining_below_2": c("players_remaining") < 2,
        "missing_match_date": c("match_date").isNull(),
        "date_outside_season": ~F.coalesce(in_season, F.lit(False)),
        "winner_is_loser": c("winner_name") == c("loser_name"),
        "unexpected_best_of": ~F.coalesce(c("best_of").isin(*best_of), F.lit(False)),
        "completed_without_first_set": completed
        & (c("winner_set_1_games").isNull() | c("loser_set_1_games").isNull()),
        "completed_winner_sets_not_above": completed & (c("winner_sets") <= c("loser_sets")),
    }
    return {**rules, **{f"{o}_below_1": c(o) < 1 for o in odds}}


def _beyond_first(df: DataFrame, by: list[str], key: str, out: str) -> DataFrame:
    """Rows beyond the first of their key, summed within ``by``.

    Nearly all keys differ, so a task that counted them where they are read would hold its whole
    split beside what the steps before it sort. They are rebalanced by a hash first, which adaptive
    execution keeps small, also where one key has very many rows.
    """
    dealt = df.select(*by, key, F.xxhash64(*by, key).alias("_deal")).hint("rebalance", F.col("_deal"))
    counted = dealt.groupBy(*by, key).agg((F.count("*") - 1).alias("_extra"))
    return counted.groupBy(*by).agg(F.sum("_extra").alias(out))


def violations(
    df: DataFrame,
    rules: Mapping[str, Column],
    by: list[str],
    *,
    key: str | None = None,
) -> DataFrame:
    """(by, rule, rows) for every broken rule: one aggregate for all partitions and rules.

    ``key`` adds the rule ``duplicate_key``: rows beyond the first of their key within ``by``.
    """
    counts = df.groupBy(*by).agg(*[F.count_if(rule).alias(n) for n, rule in rules.items()])
    names = list(rules)
    if key:
        counts = counts.join(_beyond_first(df, by, key, "duplicate_key"), by)
        names.append("duplicate_key")
    return counts.unpivot(by, names, "rule", "rows").where("rows > 0")


def reused_ids(df: DataFrame, id_column: str, apart: list[str], by: list[str]) -> DataFrame:
    """Ids used for entities that differ in some of the columns ``apart``."""
    keys = [*by, id_column]
    compact = df.where(F.col(id_column).isNotNull()).groupBy(*keys, *apart).agg(F.count("*").alias("_n"))
    counts = compact.groupBy(*keys).agg(*[F.count_distinct(c).alias(c) for c in apart])
    return counts.where(reduce(lambda a, b: a | b, [F.col(c) > 1 for c in apart]))


def quality_report(
    df: DataFrame,
    by: list[str],
    *,
    key: str = "source_match_key",
    status: str = "match_status",
    completed: str = "completed",
    needed: list[str] | None = None,
) -> DataFrame:
    """Long report ``(by, metric, value)`` per partition: rows, duplicate keys, rows per status,
    completed rows without all needed values, and the share missing of every column that has gaps.

    Two aggregates over the data and one over the key; statuses need no declared list, because
    the report is long.
    """
    total = F.count("*")
    columns = [c for c in df.columns if c not in by]
    measures = [
        total.cast("double").alias("rows"),
        *[
            F.bround(100 * F.count_if(F.col(f"`{c}`").isNull()) / total, 4).alias(f"missing_pct_{c}")
            for c in columns
        ],
    ]
    if needed:
        gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])
        measures.append(
            F.count_if((F.col(status) == completed) & gap)
            .cast("double")
            .alias("completed_missing_odds")
        )
    wide = df.groupBy(*by).agg(*measures)
    names = [c for c in wide.columns if c not in by]
    long = wide.unpivot(by, names, "metric", "value").where(
        ~F.col("metric").startswith("missing_pct_") | (F.col("value") > 0)
    )
    label = F.lower(F.coalesce(F.col(status), F.lit("nan")))
    statuses = (
        df.groupBy(*by, label.alias("_s"))
        .agg(total.cast("double").alias("value"))
        .select(*by, F.concat(F.lit("status_count_"), "_s").alias("metric"), "value")
    )
    extra = F.col("extra").cast("double").alias("value")
    repeated = _beyond_first(df, by, key, "extra").select(*by, F.lit("duplicate_match_keys").alias("metric"), extra)
    return long.unionByName(statuses).unionByName(repeated)


@dataclass(frozen=True)
class Measures:
    """All that gates and report ask of a table, counted in one pass over its rows.

    ``counts`` has a row per partition and status: the rows, a count for every rule, for every
    column that is missing and for completed rows without all needed values. ``repeated`` has the
    rows beyond the first of their key; that is the one further pass.
    """

    by: list[str]
    rules: list[str]
    columns: list[str]
    counts: DataFrame
    repeated: DataFrame

    def violations(self) -> DataFrame:
        """As ``violations``: (by, rule, rows) for every broken rule."""
        summed = self.counts.groupBy(*self.by).agg(*[F.sum(f"rule_{r}").alias(r) for r in self.rules])
        broken = summed.unpivot(self.by, self.rules, "rule", "rows")
        keys = self.repeated.select(*self.by, F.lit("duplicate_key").alias("rule"), F.col("extra").alias("rows"))
        return broken.unionByName(keys).where("rows > 0")

    def rows(self) -> DataFrame:
        return self.counts.groupBy(*self.by).agg(F.sum("n").alias("rows"))

    def report(self) -> DataFrame:
        """As ``quality_report``: (by, metric, value)."""
        total = F.sum("n")
        measures = [total.cast("double").alias("rows")]
        measures += [F.bround(100 * F.sum(f"missing_{c}") / total, 4).alias(f"missing_pct_{c}") for c in self.columns]
        measures.append(F.sum("gaps").cast("double").alias("completed_missing_odds"))
        wide = self.counts.groupBy(*self.by).agg(*measures)
        long = wide.unpivot(self.by, [c for c in wide.columns if c not in self.by], "metric", "value").where(
            "not startswith(metric, 'missing_pct_') or value > 0"
        )
        statuses = self.counts.select(
            *self.by, F.concat(F.lit("status_count_"), "label").alias("metric"), F.col("n").cast("double").alias("value")
        )
        keys = self.repeated.select(
            *self.by, F.lit("duplicate_match_keys").alias("metric"), F.col("extra").cast("double").alias("value")
        )
        return long.unionByName(statuses).unionByName(keys)


def measure(
    df: DataFrame,
    rules: Mapping[str, Column],
    by: list[str],
    *,
    key: str = "source_match_key",
    status: str = "match_status",
    completed: str = "completed",
    needed: Iterable[str] = (),
) -> Measures:
    """Count a table once for its gates and its report; the counts are staged."""
    columns = [c for c in df.columns if c not in by]
    gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed], F.lit(False))
    counts = df.groupBy(*by, F.lower(F.coalesce(F.col(status), F.lit("nan"))).alias("label")).agg(
        F.count("*").alias("n"),
        *[F.count_if(rule).alias(f"rule_{name}") for name, rule in rules.items()],
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"missing_{c}") for c in columns],
        F.count_if((F.col(status) == completed) & gap).alias("gaps"),
    )
    repeated = _beyond_first(df, by, key, "extra")
    return Measures(by, list(rules), columns, stage(counts, "measures"), stage(repeated, "repeated-keys"))


def wide_report(long: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    """Wide view of the long report for the metrics named, absent ones as 0."""
    return long.groupBy(*by).agg(
        *[
            F.coalesce(F.max(F.when(F.col("metric") == m, F.col("value"))), F.lit(0.0)).alias(m)
            for m in metrics
        ]
    )


def unreconciled(status: DataFrame, total: DataFrame, by: list[str]) -> DataFrame:
    """Partitions whose buckets do not add up to their source rows."""
    have = status.groupBy(*by).agg(F.count("*").alias("bucketed"))
    want = total.groupBy(*by).agg(F.count("*").alias("source_rows"))
    return want.join(have, by, "left").where("bucketed is null or bucketed <> source_rows")
