"""Roll-ups, audits, brackets, profiles, coverage and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import brackets, identity, linking, profile, quality, rollup
from .registry import query, table

c = F.col

_LINES = """
WITH l AS (SELECT l_suppkey AS supp, year(l_shipdate) AS y, l_returnflag AS f, l_linestatus AS s, l_linenumber AS ln,
  CAST(l_shipdate AS DATE) AS d, l_partkey AS w, -1 - (l_orderkey % 50) AS o, l_quantity AS q,
  CASE WHEN l_linenumber = 7 THEN 'F' ELSE 'R' || l_linenumber END AS rnd, l_discount AS odds FROM lineitem)
"""


def _entity_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        c("l_suppkey").alias("supplier"),
        F.year("l_shipdate").cast("bigint").alias("year"),
        c("l_returnflag").alias("flag"),
        c("l_linestatus").alias("status"),
        c("l_linenumber").cast("bigint").alias("line"),
        c("l_shipdate").cast("date").alias("day"),
        c("l_partkey").alias("winner"),
        (-1 - c("l_orderkey") % 50).alias("loser"),
        F.when(c("l_linenumber") == 7, "F")
        .otherwise(F.concat(F.lit("R"), c("l_linenumber")))
        .alias("stage"),
        c("l_quantity").alias("rank"),
        c("l_discount").alias("odds"),
    )


_SPEC = rollup.RollUp(
    keys=["supplier", "year"], attributes=["flag", "line"], day="day",
    winner="winner", loser="loser", stage="stage", status="status", statuses=["O", "F"],
    rank="rank", odds="odds", carry=["flag_of_first"], order=["day", "winner", "loser"],
)


@query(_LINES + """
, mf AS (SELECT supp, y, f FROM (SELECT supp, y, f, row_number() OVER (PARTITION BY supp, y ORDER BY count(*) DESC, f) AS r
         FROM l GROUP BY supp, y, f) WHERE r = 1),
ml AS (SELECT supp, y, ln FROM (SELECT supp, y, ln, row_number() OVER (PARTITION BY supp, y ORDER BY count(*) DESC, ln) AS r
         FROM l GROUP BY supp, y, ln) WHERE r = 1),
g AS (SELECT supp, y, min(d) AS start_date, max(d) AS end_date, count(*) AS n, count(DISTINCT rnd) AS rounds,
        count(*) FILTER (s = 'O') AS o, count(*) FILTER (s = 'F') AS fin, min(f) AS ff FROM l GROUP BY supp, y),
e AS (SELECT supp, y, count(DISTINCT p) AS players FROM (SELECT supp, y, w AS p FROM l UNION ALL SELECT supp, y, o FROM l)
      GROUP BY supp, y)
SELECT supp AS supplier, CAST(y AS BIGINT) AS year, mf.f AS flag, CAST(ml.ln AS BIGINT) AS line, start_date, end_date,
  CAST(n AS BIGINT) AS num_matches, CAST(rounds AS BIGINT) AS num_rounds, CAST(o AS BIGINT) AS "num_O_matches",
  CAST(fin AS BIGINT) AS "num_F_matches", ff AS flag_of_first, CAST(players AS BIGINT) AS num_players
FROM g JOIN mf USING (supp, y) JOIN ml USING (supp, y) JOIN e USING (supp, y)
""")
def roll_up(spark, sf):
    df = _entity_rows(spark, sf).withColumn("flag_of_first", c("flag"))
    return rollup.roll_up(df, _SPEC).select(
        "supplier", "year", "flag", "line", "start_date", "end_date", "num_matches", "num_rounds",
        "num_O_matches", "num_F_matches", "flag_of_first", "num_players",
    )


@query(_LINES + """
SELECT supp AS supplier, CAST(y AS BIGINT) AS year, CAST(count(DISTINCT f) AS BIGINT) AS flag,
  CAST(count(DISTINCT s) AS BIGINT) AS status
FROM l GROUP BY supp, y HAVING count(DISTINCT f) > 1 OR count(DISTINCT s) > 1
""")
def roll_up_audit(spark, sf):
    spec = rollup.RollUp(keys=["supplier", "year"], attributes=["flag", "status"], day="day")
    return rollup.audit(_entity_rows(spark, sf), spec)


@query(_LINES + """
, w AS (SELECT supp, y, w AS champion FROM (SELECT supp, y, w, row_number() OVER (PARTITION BY supp, y ORDER BY d, w, o) AS r
        FROM l WHERE rnd = 'F') WHERE r = 1),
ru AS (SELECT supp, y, o AS runner_up FROM (SELECT supp, y, o, row_number() OVER (PARTITION BY supp, y ORDER BY d, w, o) AS r
        FROM l WHERE rnd = 'F') WHERE r = 1)
SELECT supp AS supplier, CAST(y AS BIGINT) AS year, champion, runner_up, round(avg(q), 3) AS champion_avg_rank,
  round(avg(odds), 3) AS champion_avg_odds
FROM w JOIN ru USING (supp, y) JOIN l USING (supp, y) WHERE l.w = champion GROUP BY ALL
""")
def champion_stats(spark, sf):
    df = _entity_rows(spark, sf).withColumn("flag_of_first", c("flag"))
    out = rollup.roll_up(df, _SPEC).where("champion is not null")
    return out.select(
        "supplier", "year", "champion", "runner_up",
        F.round("champion_avg_rank", 3).alias("champion_avg_rank"),
        F.round("champion_avg_odds", 3).alias("champion_avg_odds"),
    )


@query("""
WITH x AS (SELECT CAST(ts AS DATE) AS d, user_id AS w, 1000 + event_id % 90 AS o FROM events),
p AS (SELECT d, pl, count(*) AS n FROM (SELECT d, w AS pl FROM x UNION ALL SELECT d, o FROM x) GROUP BY d, pl),
s AS (SELECT d, max(n) + 1 AS size, sum(n) / 2 AS total FROM p GROUP BY d)
SELECT d AS day, CAST(round_even(total / floor(size * (size - 1) / 2), 0) * size AS BIGINT) AS field_size FROM s
""")
def group_size(spark, sf):
    events = table(spark, sf, "events").select(
        c("ts").cast("date").alias("day"), "user_id", (1000 + c("event_id") % 90).alias("other")
    )
    return brackets.group_field_sizes(events, "day", "user_id", "other")


_LABELS = (
    *brackets.NUMBERED_ROUNDS,
    "Quarterfinals",
    "Round Robin",
)
_CODES = {"Quarterfinals": "QF", "Round Robin": "RR"}


def _rounds(spark, sf):
    label = F.array(*[F.lit(x) for x in _LABELS])
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", c("l_linenumber").cast("bigint").alias("line"),
        F.element_at(label, c("l_linenumber")).alias("round"),
    )


_BRACKET_SQL = """
WITH l AS (SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS line FROM lineitem),
k AS (SELECT l_orderkey, line, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY line DESC) AS r
      FROM (SELECT DISTINCT l_orderkey, line FROM l WHERE line <= 5)),
b AS (SELECT l.*, CASE WHEN line = 6 THEN 'QF' WHEN line = 7 THEN 'RR'
  ELSE ['R16', 'R32', 'R64', 'R128', 'R256'][r] END AS round FROM l LEFT JOIN k USING (l_orderkey, line))
"""


@query(_BRACKET_SQL + "SELECT l_orderkey, l_partkey, l_suppkey, line, round FROM b")
def bracket_codes(spark, sf):
    return brackets.assign_round_codes(_rounds(spark, sf), "l_orderkey", "round", _CODES)


@query(_BRACKET_SQL + """
, p AS (SELECT l_orderkey, pl, count(*) AS n FROM (SELECT l_orderkey, l_partkey AS pl FROM b WHERE round = 'RR'
        UNION ALL SELECT l_orderkey, -l_suppkey - 1 FROM b WHERE round = 'RR') GROUP BY 1, 2),
s AS (SELECT l_orderkey, max(n) + 1 AS size, sum(n) / 2 AS total FROM p GROUP BY 1)
SELECT l_orderkey, l_partkey, line, CAST(CASE round WHEN 'QF' THEN 8 WHEN 'R16' THEN 16 WHEN 'R32' THEN 32 WHEN 'R64' THEN 64
  WHEN 'R128' THEN 128 WHEN 'R256' THEN 256
  ELSE round_even(total / floor(size * (size - 1) / 2), 0) * size END AS BIGINT) AS players_remaining
FROM b LEFT JOIN s USING (l_orderkey)
""")
def players_remaining(spark, sf):
    coded = brackets.assign_round_codes(_rounds(spark, sf), "l_orderkey", "round", _CODES)
    coded = coded.withColumn("other", -c("l_suppkey") - 1)
    out = brackets.add_players_remaining(
        coded, event="l_orderkey", winner="l_partkey", loser="other"
    )
    return out.select("l_orderkey", "l_partkey", "line", "players_remaining")


_GAPS = """
WITH o AS (SELECT year(o_orderdate) AS year, o_custkey AS k, o_orderstatus AS s,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders)
"""


@query(_GAPS + """
SELECT CAST(year AS BIGINT) AS year, metric, value FROM (
  SELECT year, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM o GROUP BY year
  UNION ALL SELECT year, 'missing_pct_price', round_even(100.0 * count(*) FILTER (price IS NULL) / count(*), 4) FROM o GROUP BY year
  UNION ALL SELECT year, 'missing_pct_priority', round_even(100.0 * count(*) FILTER (priority IS NULL) / count(*), 4) FROM o GROUP BY year
  UNION ALL SELECT year, 'completed_missing_odds', count(*) FILTER (s = 'F' AND (price IS NULL OR priority IS NULL)) FROM o GROUP BY year
  UNION ALL SELECT year, 'status_count_' || lower(s), count(*) FROM o GROUP BY year, s
  UNION ALL SELECT year, 'duplicate_match_keys', count(*) - count(DISTINCT k) FROM o GROUP BY year)
""")
def quality_report(spark, sf):
    df = table(spark, sf, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("year"),
        c("o_custkey").alias("k"),
        c("o_orderstatus").alias("s"),
        F.when(c("o_orderkey") % 9 != 0, c("o_totalprice")).alias("price"),
        F.when(c("o_orderkey") % 4 != 0, c("o_orderpriority")).alias("priority"),
    )
    return quality.quality_report(
        df, ["year"], key="k", status="s", completed="F", needed=["price", "priority"]
    )


@query(_GAPS + """
SELECT CAST(year AS BIGINT) AS year, CAST(count(*) AS DOUBLE) AS "rows",
  CAST(count(*) FILTER (s = 'P') AS DOUBLE) AS status_count_p, CAST(0 AS DOUBLE) AS status_count_never
FROM o GROUP BY year
""")
def quality_wide(spark, sf):
    long = quality_report(spark, sf)
    return quality.wide_report(long, ["year"], ["rows", "status_count_p", "status_count_never"])


@query("""
WITH o AS (SELECT year(o_orderdate) AS y, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS v FROM orders)
SELECT CAST(y AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS matches, CAST(count(v) AS BIGINT) AS mapped,
  CAST(count(*) - count(v) AS BIGINT) AS unmapped, round(count(v) / count(*), 6) AS coverage
FROM o GROUP BY y
""")
def coverage(spark, sf):
    df = table(spark, sf, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.when(c("o_custkey") % 7 != 0, c("o_custkey")).alias("v"),
    )
    return profile.coverage(df, "v", ["year"]).withColumn("coverage", F.round("coverage", 6))


@query("""
WITH k AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R')
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS total_matches,
  CAST(count(k) AS BIGINT) AS linked_matches, CAST(count(*) - count(k) AS BIGINT) AS unlinked_matches,
  round(count(k) / count(*), 6) AS coverage
FROM orders LEFT JOIN k ON o_orderkey = k GROUP BY 1
""")
def link_coverage(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("year")
    )
    links = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    links = links.select(c("l_orderkey").alias("o_orderkey"))
    out = profile.link_coverage(orders, links, "o_orderkey", ["year"])
    return out.withColumn("coverage", F.round("coverage", 6))


@query("""
SELECT CAST(official_tournament_id AS BIGINT) AS official_tournament_id, CAST(year AS BIGINT) AS year, customer_id, supplier_id FROM (
  SELECT n_regionkey AS official_tournament_id, c_custkey % 20 + 2000 AS year, min('c' || c_custkey) AS customer_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
FULL JOIN (
  SELECT n_regionkey AS official_tournament_id, s_suppkey % 25 + 2000 AS year, min('s' || s_suppkey) AS supplier_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2) USING (official_tournament_id, year)
""")
def pivot_links(spark, sf):
    nation = table(spark, sf, "nation")

    def links(name, prefix, key, years):
        rows = table(spark, sf, name).join(nation, c(f"{prefix}_nationkey") == c("n_nationkey"))
        return rows.select(
            c("n_regionkey").cast("bigint").alias("official_tournament_id"),
            (c(key) % years + 2000).alias("year"),
            F.lit(name).alias("source"),
            F.concat(F.lit(prefix), c(key)).alias("source_tournament_id"),
        )

    long = links("customer", "c", "c_custkey", 20).unionByName(
        links("supplier", "s", "s_suppkey", 25)
    )
    return identity.pivot_links(long, ("customer", "supplier"))


@query("""
WITH v AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r,
      sum(n) OVER (PARTITION BY user_id) AS t FROM v)
SELECT user_id, event_type, CAST(n AS BIGINT) AS n, CAST(t AS BIGINT) AS n_total FROM b
WHERE r = 1 AND n >= 2 AND n / t >= 0.25
""")
def dominant_mapping(spark, sf):
    return profile.dominant_mapping(
        table(spark, sf, "events"), ["user_id"], "event_type", share=0.25
    )


@query("""
SELECT 'o_custkey' AS "column", 0.0 AS missing_pct, CAST(count(DISTINCT o_custkey) AS BIGINT) AS distinct_values FROM orders
UNION ALL SELECT 'o_orderstatus', 0.0, count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'priority', round_even(100.0 * count(*) FILTER (o_orderkey % 6 = 0) / count(*), 2),
  count(DISTINCT o_orderpriority) FILTER (o_orderkey % 6 <> 0) FROM orders
""")
def column_profile(spark, sf):
    df = table(spark, sf, "orders").withColumn(
        "priority", F.when(c("o_orderkey") % 6 != 0, c("o_orderpriority"))
    )
    out = profile.column_profile(df, ["o_custkey", "o_orderstatus", "priority"], exact=True)
    return out.drop("type")


@query("""
WITH p AS (SELECT year(o_orderdate) AS a, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE year(l_shipdate) END AS b,
  o_orderstatus AS s, l_linestatus AS t FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT 'year' AS concept, round_even(100.0 * count(*) FILTER (a = b) / count(*) FILTER (b IS NOT NULL), 2) AS agreement_pct FROM p
UNION ALL SELECT 'status', round_even(100.0 * count(*) FILTER (s = t) / count(*), 2) FROM p
""")
def pair_agreement(spark, sf):
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "lineitem"), c("o_orderkey") == c("l_orderkey")
    )
    ship = F.when(c("l_partkey") % 5 != 0, F.year("l_shipdate"))
    pairs = {
        "year": (F.year("o_orderdate"), ship),
        "status": (c("o_orderstatus"), c("l_linestatus")),
    }
    return profile.pair_agreement(joined, pairs)


_RULES_SQL = """
WITH l AS (SELECT year(l_shipdate) AS year, l_orderkey || '-' || l_linenumber AS k, l_quantity AS q, l_discount AS d,
  l_returnflag AS f, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_tax END AS t FROM lineitem)
"""


@query(_RULES_SQL + """
SELECT CAST(year AS BIGINT) AS year, rule, CAST(n AS BIGINT) AS "rows" FROM (
  SELECT year, 'quantity_above_49' AS rule, count(*) FILTER (q > 49) AS n FROM l GROUP BY year
  UNION ALL SELECT year, 'missing_tax', count(*) FILTER (t IS NULL) FROM l GROUP BY year
  UNION ALL SELECT year, 'returned_without_discount', count(*) FILTER (f = 'R' AND d = 0) FROM l GROUP BY year
  UNION ALL SELECT year, 'duplicate_key', count(*) - count(DISTINCT k) FROM l GROUP BY year) WHERE n > 0
""")
def gate_violations(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"),
        "l_quantity", "l_discount", "l_returnflag",
        F.when(c("l_partkey") % 50 != 0, c("l_tax")).alias("tax"),
    )
    rules = {
        "quantity_above_49": c("l_quantity") > 49,
        "missing_tax": c("tax").isNull(),
        "returned_without_discount": (c("l_returnflag") == "R") & (c("l_discount") == 0),
        "discount_above_1": c("l_discount") > 1,
    }
    return quality.violations(df, rules, ["year"], key="k")


@query("""
SELECT CAST(year(l_shipdate) AS BIGINT) AS year, l_orderkey, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS l_suppkey,
  CAST(count(DISTINCT l_returnflag) AS BIGINT) AS l_returnflag
FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_suppkey) > 1 OR count(DISTINCT l_returnflag) > 1
""")
def id_reuse(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate").cast("bigint"))
    return quality.reused_ids(lines, "l_orderkey", ["l_suppkey", "l_returnflag"], ["year"])


@query("""
WITH s AS (SELECT DISTINCT CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS season, l_partkey % 300 AS code FROM lineitem),
q AS (SELECT DISTINCT season FROM s)
SELECT a.season, a.code, 'added' AS change FROM s a JOIN q ON q.season = a.season - 1
WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.season = a.season - 1 AND b.code = a.code)
UNION ALL
SELECT b.season + 1, b.code, 'removed' FROM s b JOIN q ON q.season = b.season + 1
WHERE NOT EXISTS (SELECT 1 FROM s a WHERE a.season = b.season + 1 AND a.code = b.code)
""")
def schema_drift(spark, sf):
    """What appears and vanishes from one month to the next, as a file's columns would."""
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("bigint")
    lines = table(spark, sf, "lineitem").select(
        month.alias("month"), (c("l_partkey") % 300).alias("part")
    )
    return quality.presence_drift(lines, "month", "part")


@query("""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS source_rows,
  CAST(count(*) FILTER (o_totalprice > 2000) AS BIGINT) AS bucketed
FROM orders GROUP BY 1 HAVING count(*) <> count(*) FILTER (o_totalprice > 2000)
""")
def unreconciled(spark, sf):
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    return quality.unreconciled(orders.where(c("o_totalprice") > 2000), orders, ["year"])


@query("""
WITH d AS (SELECT o_orderstatus AS s, CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS BIGINT) AS x
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT s AS status, CAST(count(x) AS BIGINT) AS n, CAST(min(x) AS BIGINT) AS low, CAST(max(x) AS BIGINT) AS high,
  round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS median FROM d GROUP BY s
""")
def describe_difference(spark, sf):
    """Spread of a difference per status. The exact median counts equal values first."""
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "lineitem"), c("o_orderkey") == c("l_orderkey")
    )
    days = F.abs(F.datediff(c("o_orderdate").cast("date"), c("l_shipdate").cast("date")))
    seen = joined.groupBy(c("o_orderstatus").alias("status"), days.cast("bigint").alias("x")).agg(
        F.count("*").alias("n")
    )
    return seen.groupBy("status").agg(
        F.sum("n").alias("n"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.round(F.sum(c("x") * c("n")) / F.sum("n"), 4).alias("mean"),
        F.round(F.percentile("x", F.lit(0.5), c("n")), 4).alias("median"),
    ).select("status", "n", "low", "high", "mean", "median")


@query("""
SELECT lang, CAST(count(*) AS BIGINT) AS documents FROM documents GROUP BY lang
""")
def frequency(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("documents"))


@query("""
WITH k AS (SELECT l_orderkey || '_' || l_linenumber AS key, count(*) AS n FROM lineitem GROUP BY 1)
SELECT key, CAST(n AS BIGINT) AS n FROM k WHERE n > 1
""")
def duplicate_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("key")
    )
    return quality.duplicate_keys(lines, ["key"])


@query("""
SELECT p_brand AS place, CAST(count(DISTINCT p_type) AS BIGINT) AS ids FROM part
GROUP BY 1 HAVING count(DISTINCT p_type) > 1
""")
def ambiguous_places(spark, sf):
    part = table(spark, sf, "part")
    return identity.ambiguous_places(part.withColumnRenamed("p_brand", "place"), "place", "p_type")


@query("""
WITH s AS (SELECT l_suppkey, CASE WHEN l_returnflag = 'R' THEN 'linked' WHEN l_returnflag = 'A' THEN 'ambiguous' END AS e FROM lineitem)
SELECT CAST(s_suppkey AS VARCHAR) AS source_match_key, CASE WHEN count(*) FILTER (e = 'linked') > 0 THEN 'linked'
  WHEN count(*) FILTER (e = 'ambiguous') > 0 THEN 'ambiguous' ELSE 'unmatched' END AS linkage_status
FROM supplier LEFT JOIN s ON l_suppkey = s_suppkey GROUP BY 1
""")
def final_status(spark, sf):
    """Evidence from two tables of very different size folded to one status per key."""
    key = c("l_suppkey").cast("string").alias("source_match_key")
    lines = table(spark, sf, "lineitem")
    feed = table(spark, sf, "supplier").select(
        c("s_suppkey").cast("string").alias("source_match_key"),
        F.lit(2024).cast("bigint").alias("year"),
        F.lit("x").alias("tour"),
    )
    season = [F.lit(2024).cast("bigint").alias("year"), F.lit("x").alias("tour")]
    method = F.lit("rank").alias("match_method")
    accepted = lines.where("l_returnflag = 'R'").select(key, *season, method)
    candidates = lines.where("l_returnflag = 'A'").select(key, *season)
    status = linking.final_status(feed, accepted, candidates)
    return status.select("source_match_key", "linkage_status")
