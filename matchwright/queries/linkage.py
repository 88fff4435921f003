"""The linker over the line items.

Odd orders are the feed, even orders the archive. A block is (ship year, supplier), the rank pair
is (line number, quantity), the round is the return flag. Names come from the part and its type;
suppliers of every tenth nation have no entry in the bridge.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import joins, linking, matching, profile
from ..plans.linking import KEY, review
from ..session import stage
from .registry import query, table

c = F.col

# The same records for DuckDB. One player fits if the family name is equal and the initial fits.
_BASE = """
WITH base AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS key,
    year(l_shipdate) AS year, l_orderkey % 2 AS side, l_suppkey AS supp,
    CASE WHEN s_nationkey % 10 = 0 THEN NULL ELSE l_suppkey END AS oid,
    CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_linenumber END AS wr,
    CAST(l_quantity AS BIGINT) AS lr, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_returnflag END AS rnd,
    split_part(p_name, ' ', 1) AS wg, split_part(p_name, ' ', 2) AS wf, p_type AS lf,
    l_extendedprice AS wp, l_tax AS lp, l_partkey AS wid, l_orderkey AS lid
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
u AS (SELECT * FROM base WHERE side = 1), k AS (SELECT * FROM base WHERE side = 0),
c1 AS (
  SELECT u.key AS uk, k.key AS kk, u.year, u.oid, u.wr, u.lr, u.rnd AS ur, k.rnd AS kr,
    k.wid AS wid, k.lid AS lid,
    u.wf = k.wf AND left(u.wg, 1) = left(k.wg, 1) AND u.lf = k.lf AS fits,
    abs(u.wp - k.wp) AS wd, abs(u.lp - k.lp) AS ld,
    count(*) OVER (PARTITION BY u.key) AS m, count(*) OVER (PARTITION BY k.key) AS n
  FROM u JOIN k ON u.year = k.year AND u.oid = k.oid AND u.wr = k.wr AND u.lr = k.lr),
a1 AS (SELECT * FROM c1 WHERE m = 1 AND n = 1 AND NOT (coalesce(ur <> kr, false) AND NOT fits)),
c2 AS (
  SELECT u.key AS uk, k.key AS kk, u.year, u.oid, u.rnd, u.wr AS uwr, k.wr AS kwr, u.lr AS ulr, k.lr AS klr,
    k.wid AS wid, k.lid AS lid,
    count(*) OVER (PARTITION BY u.key) AS m, count(*) OVER (PARTITION BY k.key) AS n
  FROM u JOIN k ON u.year = k.year AND u.oid = k.oid AND u.rnd IS NOT DISTINCT FROM k.rnd
    AND u.wf = k.wf AND left(u.wg, 1) = left(k.wg, 1) AND u.lf = k.lf
  WHERE u.key NOT IN (SELECT uk FROM a1) AND k.key NOT IN (SELECT kk FROM a1)),
a2 AS (SELECT * FROM c2 WHERE m = 1 AND n = 1),
st AS (
  SELECT u.key AS source_match_key, CAST(u.year AS BIGINT) AS year, u.oid, u.wr, u.lr,
    CASE WHEN a1.uk IS NOT NULL OR a2.uk IS NOT NULL THEN 'linked'
         WHEN u.key IN (SELECT uk FROM c1 WHERE m > 1 OR n > 1) OR u.key IN (SELECT uk FROM c2)
         THEN 'ambiguous' ELSE 'unmatched' END AS linkage_status,
    CASE WHEN a1.uk IS NOT NULL THEN 'tournament_rank_unique'
         WHEN a2.uk IS NOT NULL THEN 'tournament_round_name_pair' END AS match_method
  FROM u LEFT JOIN a1 ON u.key = a1.uk LEFT JOIN a2 ON u.key = a2.uk)
"""


def records(spark, sf):
    """Line items under the names of the linker's contract."""
    words = F.split("p_name", " ")
    feed = c("l_orderkey") % 2 == 1
    short = F.concat(F.initcap(words[1]), F.lit(" "), F.upper(F.substring(words[0], 1, 1)), F.lit("."))
    lines = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("key"),
            F.year("l_shipdate").cast("bigint").alias("year"),
            F.lit("all").alias("tour"),
            F.concat(F.when(feed, "F").otherwise("A"), c("l_suppkey")).alias("event"),
            F.when(c("l_partkey") % 11 != 0, c("l_linenumber").cast("bigint")).alias("winner_rank"),
            c("l_quantity").cast("bigint").alias("loser_rank"),
            F.when(c("l_partkey") % 13 != 0, c("l_returnflag")).alias("round"),
            F.when(feed, short).otherwise(c("p_name")).alias("winner_name"),
            F.when(feed, F.concat(F.initcap("p_type"), F.lit(" K.")))
            .otherwise(F.concat(F.lit("Kim "), F.lower("p_type")))
            .alias("loser_name"),
            c("l_extendedprice").alias("winner_rank_points"),
            c("l_tax").alias("loser_rank_points"),
            c("l_partkey").alias("winner_id"),
            c("l_orderkey").alias("loser_id"),
        )
    )
    return lines


def bridge(spark, sf):
    """Event ids of both sides, for suppliers that have an entry."""
    known = table(spark, sf, "supplier").where(c("s_nationkey") % 10 != 0)
    years = F.explode(F.sequence(F.lit(1990), F.lit(2010))).alias("year")
    sides = [
        known.select(
            c("s_suppkey").alias("official_tournament_id"),
            F.lit("all").alias("tour"),
            years,
            F.lit(tag).alias("source"),
            F.concat(F.lit(letter), c("s_suppkey")).alias("source_tournament_id"),
        )
        for tag, letter in (("feed", "F"), ("archive", "A"))
    ]
    return sides[0].unionByName(sides[1])


def both_sides(spark, sf):
    lines, ids = records(spark, sf), bridge(spark, sf)
    feed = lines.where(c("event").startswith("F")).withColumnRenamed("key", "source_match_key")
    archive = lines.where(c("event").startswith("A")).withColumnRenamed("key", "canonical_match_key")
    feed = joins.attach_official_ids(
        feed.drop("winner_id", "loser_id"), ids, source="feed", id_column="event"
    )
    archive = joins.attach_official_ids(archive, ids, source="archive", id_column="event")
    return feed, archive


@query(_BASE + """
SELECT uk AS source_match_key, CAST(max(m) AS BIGINT) AS source_candidate_count,
       CAST(max(n) AS BIGINT) AS canonical_candidate_count
FROM c1 WHERE uk IN (SELECT uk FROM c1 WHERE m > 1 OR n > 1) GROUP BY uk
""")
def rank_candidates(spark, sf):
    """Records with several candidates by rank; counts come from the blocks, not from pairs."""
    feed, archive = both_sides(spark, sf)
    blocks = linking.rank_blocks(feed, archive)
    return linking.rank_ambiguous(feed, blocks).select(
        "source_match_key", "source_candidate_count", "canonical_candidate_count"
    )


@query(_BASE + """
SELECT uk AS source_match_key, kk AS canonical_match_key, CAST(wid AS BIGINT) AS winner_id,
  CAST(lid AS BIGINT) AS loser_id, coalesce(ur = kr, false) AS round_agrees, round(wd, 2) AS winner_rank_points_diff
FROM a1
""")
def rank_links(spark, sf):
    blocks = linking.rank_blocks(*both_sides(spark, sf))
    return linking.rank_links(blocks).select(
        "source_match_key", "canonical_match_key", "winner_id", "loser_id", "round_agrees",
        F.round("winner_rank_points_diff", 2).alias("winner_rank_points_diff"),
    )


@query(_BASE + """
SELECT uk AS source_match_key, kk AS canonical_match_key,
  CASE WHEN uwr <> kwr OR ulr <> klr THEN 'rank_mismatch'
       WHEN uwr IS NULL OR kwr IS NULL THEN 'missing_rank' END AS data_quality_flag,
  uwr = kwr AS winner_rank_agrees, ulr = klr AS loser_rank_agrees
FROM a2
""")
def round_block_links(spark, sf):
    """Name pairs inside (event, round) for what the ranks left over."""
    feed, archive = (stage(df, "side") for df in both_sides(spark, sf))
    first = linking.rank_links(stage(linking.judged(linking.rank_blocks(feed, archive)), "blocks"))
    left = joins.residual(feed, first, "source_match_key")
    right = joins.residual(archive, first, "canonical_match_key")
    parsed = linking.spelled(feed, archive)
    links = linking.name_links(stage(linking.name_groups(left, right, parsed=parsed), "groups"))
    return links.select(
        "source_match_key", "canonical_match_key", "data_quality_flag",
        "winner_rank_agrees", "loser_rank_agrees",
    )


@query(_BASE + "SELECT source_match_key, year, linkage_status, match_method FROM st")
def link_all_passes(spark, sf):
    out = linking.link(*both_sides(spark, sf))
    return out.status.select("source_match_key", "year", "linkage_status", "match_method")


@query(_BASE + """
SELECT year, CAST(count(*) AS BIGINT) AS uk_total_matches,
  CAST((SELECT count(*) FROM k WHERE k.year = st.year) AS BIGINT) AS sackmann_total_matches,
  CAST(count(*) FILTER (linkage_status = 'linked') AS BIGINT) AS linked_matches,
  CAST(count(*) FILTER (match_method = 'tournament_rank_unique') AS BIGINT) AS linked_pass_1,
  CAST(count(*) FILTER (match_method = 'tournament_round_name_pair') AS BIGINT) AS linked_pass_2,
  CAST(count(*) FILTER (linkage_status = 'ambiguous') AS BIGINT) AS ambiguous_matches,
  CAST(count(*) FILTER (linkage_status = 'unmatched') AS BIGINT) AS unmatched_matches,
  CAST(round_even(100.0 * count(*) FILTER (linkage_status = 'linked') / count(*), 1) AS DOUBLE) AS coverage_pct
FROM st GROUP BY year
""")
def linkage_summary(spark, sf):
    out = linking.link(*both_sides(spark, sf))
    return linking.linkage_summary(out.status, out.archive).drop("tour", "linked_manual")


@query(_BASE + """
SELECT year, CAST(count(*) AS BIGINT) AS uk_total_matches,
  CAST(count(*) FILTER (linkage_status = 'linked') AS BIGINT) AS linked_matches
FROM st WHERE year IN (1996, 1997, 1998) GROUP BY year ORDER BY year
""")
def summary_review(spark, sf):
    out = linking.link(*both_sides(spark, sf))
    summary = linking.linkage_summary(out.status, out.archive)
    return review(summary, [1996, 1997, 1998]).select("year", "uk_total_matches", "linked_matches")


@query(_BASE + """
SELECT CASE WHEN oid IS NULL THEN 'missing_tournament_mapping' WHEN wr IS NULL OR lr IS NULL THEN 'no_rank_candidate'
       ELSE 'no_name_pair_candidate' END AS unmatched_reason, CAST(count(*) AS BIGINT) AS n
FROM st WHERE linkage_status = 'unmatched' GROUP BY 1
""")
def unmatched_reason(spark, sf):
    out = linking.link(*both_sides(spark, sf))
    return out.unmatched.groupBy("unmatched_reason").agg(F.count("*").alias("n"))


@query(_BASE + """
SELECT source_match_key, canonical_match_key, canonical_winner_id, canonical_round, canonical_winner_name
FROM (SELECT u.key AS source_match_key, a1.kk AS canonical_match_key, CAST(a1.wid AS BIGINT) AS canonical_winner_id,
  k.rnd AS canonical_round, k.wg || ' ' || k.wf AS canonical_winner_name
  FROM u LEFT JOIN a1 ON u.key = a1.uk LEFT JOIN k ON a1.kk = k.key)
""")
def enrich_left(spark, sf):
    feed, archive = both_sides(spark, sf)
    links = linking.rank_links(linking.rank_blocks(feed, archive))
    return linking.enrich(feed, archive, links).select(
        "source_match_key", "canonical_match_key", "canonical_winner_id", "canonical_round",
        "canonical_winner_name",
    )


@query(_BASE + """
, m AS (SELECT uk, kk, m, n FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY uk) AS r FROM a1) WHERE r <= 2),
p AS (SELECT least(min(uk)) AS x FROM m)
SELECT u.key AS source_match_key, m.kk AS canonical_match_key, CAST(u.oid AS BIGINT) AS official_tournament_id,
  CAST(u.year AS BIGINT) AS year, 'manual_override' AS match_method
FROM m JOIN u ON u.key = m.uk
""")
def manual_links(spark, sf):
    """Pass 0 with the first two rank links of every year given by hand."""
    feed, archive = both_sides(spark, sf)
    links = linking.rank_links(linking.rank_blocks(feed, archive))
    keys = links.groupBy("year").agg(F.min("source_match_key").alias("first_key"))
    rest = links.join(keys, "year").where("source_match_key <> first_key")
    second = rest.groupBy("year").agg(F.min("source_match_key").alias("first_key"))
    given = keys.unionByName(second).select(c("first_key").alias("source_match_key"))
    manual = links.join(given, "source_match_key", "left_semi").select(
        "year", "source_match_key", "canonical_match_key"
    )
    return linking.manual_links(manual, feed, archive).select(
        "source_match_key", "canonical_match_key", "official_tournament_id", "year", "match_method"
    )


@query("""
WITH l AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS key, l_returnflag AS f
           FROM lineitem WHERE l_orderkey % 2 = 1)
SELECT 'source_match_key' AS "column", 'wrong-' || key AS match_key, 'unknown' AS problem FROM l WHERE f = 'R'
UNION ALL SELECT 'canonical_match_key', key || '-wrong', 'unknown' FROM l WHERE f = 'A'
""")
def reference_check(spark, sf):
    """Manual links, one per feed record, that name records one side does not have."""
    feed, _ = both_sides(spark, sf)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    flag = c("l_returnflag")
    manual = table(spark, sf, "lineitem").where(c("l_orderkey") % 2 == 1).select(
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.when(flag == "R", F.concat(F.lit("wrong-"), key)).otherwise(key).alias("source_match_key"),
        F.when(flag == "A", F.concat(key, F.lit("-wrong")))
        .otherwise(key)
        .alias("canonical_match_key"),
    )
    stand_in = feed.select(c("source_match_key").alias("canonical_match_key"))
    return linking.manual_problems(manual, feed, stand_in)


@query(_BASE + """
SELECT kk AS canonical_match_key, CAST(CASE WHEN wid % 10 = 0 THEN -1 WHEN wid % 10 = 1 THEN NULL ELSE wid END AS BIGINT)
  AS winner_id FROM a1 WHERE wid % 10 IN (0, 1)
""")
def id_agreement(spark, sf):
    """Links whose copied id was damaged: wrong or lost."""
    feed, archive = both_sides(spark, sf)
    links = linking.rank_links(linking.rank_blocks(feed, archive))
    last = c("winner_id") % 10
    damaged = links.withColumn(
        "winner_id",
        F.when(last == 0, F.lit(-1)).when(last == 1, F.lit(None)).otherwise(c("winner_id")),
    )
    wrong = joins.disagreeing_ids(damaged, archive, [*KEY, "canonical_match_key"], ["winner_id", "loser_id"])
    return wrong.select("canonical_match_key", "winner_id")


@query("""
WITH p AS (SELECT p_partkey, p_brand, p_size, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b,
                  p_type FROM part)
SELECT u.p_partkey AS part, CAST(count(*) AS BIGINT) AS candidates
FROM p u JOIN p k ON u.p_brand = k.p_brand AND u.p_partkey % 2 = 1 AND k.p_partkey % 2 = 0
  AND u.b = k.b AND left(u.a, 1) = left(k.a, 1) AND u.p_type = k.p_type
GROUP BY 1
""")
def name_pair(spark, sf):
    """How many archive parts fit each feed part by both names, inside its brand."""
    words = F.split("p_name", " ")
    part = table(spark, sf, "part").select(
        c("p_partkey").cast("string").alias("key"),
        F.lit(2024).cast("bigint").alias("year"),
        c("p_brand").alias("tour"),
        F.lit(1).cast("bigint").alias("official_tournament_id"),
        F.lit(None).cast("string").alias("round"),
        F.concat(
            F.initcap(words[1]), F.lit(" "), F.upper(F.substring(words[0], 1, 1)), F.lit(".")
        ).alias("short_winner"),
        F.concat(F.initcap("p_type"), F.lit(" T.")).alias("short_loser"),
        c("p_name").alias("full_winner"),
        F.concat(F.lit("Tony "), c("p_type")).alias("full_loser"),
    )
    odd = c("key").cast("bigint") % 2 == 1
    feed = part.where(odd).withColumnsRenamed(
        {"key": "source_match_key", "short_winner": "winner_name", "short_loser": "loser_name"}
    )
    archive = part.where(~odd).withColumnsRenamed(
        {"key": "canonical_match_key", "full_winner": "winner_name", "full_loser": "loser_name"}
    )
    groups = linking.name_groups(feed, archive)
    return linking.name_candidates(feed, groups).select(
        c("source_match_key").cast("bigint").alias("part"),
        c("source_candidate_count").alias("candidates"),
    )


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE l_linenumber = l_quantity % 7 END AS winner_agrees,
  CASE WHEN (l_partkey % 4 <> 0 AND l_linenumber <> l_quantity % 7)
         OR (l_suppkey % 5 <> 0 AND l_quantity <> l_partkey % 50) THEN 'rank_mismatch'
       WHEN l_partkey % 4 = 0 OR l_suppkey % 5 = 0 THEN 'missing_rank' END AS flag,
  CASE WHEN l_suppkey % 5 = 0 THEN 'missing_tournament_mapping' WHEN l_partkey % 4 = 0 THEN 'no_rank_candidate'
       ELSE 'no_name_pair_candidate' END AS reason
FROM lineitem
""")
def evidence_flags(spark, sf):
    rank = F.when(c("l_partkey") % 4 != 0, c("l_linenumber"))
    other = F.when(c("l_suppkey") % 5 != 0, c("l_quantity"))
    winner = linking.agrees(rank, c("l_quantity") % 7)
    loser = linking.agrees(other, c("l_partkey") % 50)
    df = table(spark, sf, "lineitem").withColumns(
        {"official_tournament_id": other, "winner_rank": rank, "loser_rank": c("l_quantity")}
    )
    return df.select(
        "l_orderkey", c("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey",
        winner.alias("winner_agrees"),
        linking.quality_flag(winner, loser).alias("flag"),
        linking.unmatched_reason().alias("reason"),
    )


def _scored_orders(spark, sf):
    """Orders of one customer less than 10 days apart, odd against even, scored."""
    orders = table(spark, sf, "orders").withColumn("day", c("o_orderdate").cast("date"))
    odd = c("o_orderkey") % 2 == 1

    def side(prefix):
        return [
            "o_custkey",
            c("o_orderkey").alias(f"{prefix}_id"),
            c("day").alias(f"{prefix}_day"),
            c("o_orderstatus").alias(f"{prefix}_status"),
            c("o_orderpriority").alias(f"{prefix}_priority"),
        ]

    pairs = joins.interval_join(
        orders.where(odd).select(*side("l")),
        orders.where(~odd).select(*side("r")),
        ["o_custkey"],
        F.unix_date("l_day"),
        F.unix_date("r_day"),
        -9,
        9,
    )
    score = (
        matching.NAME_WEIGHT * (c("l_priority") == c("r_priority")).cast("double")
        + matching.DATE_WEIGHT * dates.date_closeness(c("l_day"), c("r_day"))
        + matching.SURFACE_WEIGHT * (c("l_status") == c("r_status")).cast("double")
    )
    return pairs.select("o_custkey", "l_id", "r_id", score.alias("score"))


@query("""
WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT a.o_custkey, a.o_orderkey AS l_id, b.o_orderkey AS r_id,
  round(0.5 * CAST(a.o_orderpriority = b.o_orderpriority AS INT) + 0.4 * (1 - abs(a.day - b.day) / 10.0)
    + 0.1 * CAST(a.o_orderstatus = b.o_orderstatus AS INT), 4) AS score
FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey % 2 = 1 AND b.o_orderkey % 2 = 0
 AND abs(a.day - b.day) < 10
""")
def pair_score(spark, sf):
    return _scored_orders(spark, sf).withColumn("score", F.round("score", 4))


@query("""
WITH RECURSIVE o AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders),
s AS (
  SELECT a.o_custkey, a.o_orderkey AS l_id, b.o_orderkey AS r_id,
    round(0.5 * CAST(a.o_orderpriority = b.o_orderpriority AS INT) + 0.4 * (1 - abs(a.day - b.day) / 10.0)
      + 0.1 * CAST(a.o_orderstatus = b.o_orderstatus AS INT), 4) AS score
  FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey % 2 = 1 AND b.o_orderkey % 2 = 0
   AND abs(a.day - b.day) < 10),
p AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, md5(l_id || '|' || r_id), l_id, r_id) AS n
  FROM s WHERE score >= 0.5),
w AS (
  SELECT o_custkey, n, l_id, r_id, score, true AS taken, [l_id] AS ls, [r_id] AS rs FROM p WHERE n = 1
  UNION ALL
  SELECT p.o_custkey, p.n, p.l_id, p.r_id, p.score,
    NOT (list_contains(w.ls, p.l_id) OR list_contains(w.rs, p.r_id)),
    CASE WHEN list_contains(w.ls, p.l_id) OR list_contains(w.rs, p.r_id) THEN w.ls ELSE list_append(w.ls, p.l_id) END,
    CASE WHEN list_contains(w.ls, p.l_id) OR list_contains(w.rs, p.r_id) THEN w.rs ELSE list_append(w.rs, p.r_id) END
  FROM w JOIN p ON p.o_custkey = w.o_custkey AND p.n = w.n + 1)
SELECT o_custkey, l_id, r_id, score FROM w WHERE taken
""")
def greedy_match(spark, sf):
    """One-to-one choice among those pairs."""
    scored = _scored_orders(spark, sf).withColumn("score", F.round("score", 4))
    return matching.assign(scored.where(c("score") >= matching.FLOOR), ["o_custkey"])


@query("""
WITH n AS (SELECT p_brand, p_partkey, p_size % 2 AS s, p_type AS t, p_size % 8 AS k, p_size % 7 AS m FROM part),
p AS (SELECT a.p_brand AS year, a.p_partkey AS l_id, b.p_partkey AS r_id,
    0.5 * 24 / (24 + a.k + b.m) + CASE WHEN a.s = b.s THEN 0.1 ELSE 0 END AS score
  FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.t = b.t AND a.p_partkey % 2 = 1 AND b.p_partkey % 2 = 0)
SELECT year, l_id, r_id, round(score, 4) AS score FROM p WHERE score >= 0.5 - 1e-9
""")
def similar_names(spark, sf):
    """Parts whose names reach the floor by their names alone.

    A name is a block that equal types share, followed by letters only its own side has, so the
    longest common block, and with it the gestalt ratio, is known.
    """
    letters = F.when(c("p_partkey") % 2 == 1, F.repeat(F.lit("x"), (c("p_size") % 8).cast("int")))
    letters = letters.otherwise(F.repeat(F.lit("z"), (c("p_size") % 7).cast("int")))
    named = table(spark, sf, "part").select(
        c("p_brand").alias("year"),
        c("p_partkey").alias("id"),
        F.when(c("p_size") % 2 == 1, "hard").otherwise("clay").alias("surface"),
        F.concat(F.left(F.md5(c("p_type").cast("binary")), F.lit(12)), letters).alias("name"),
        F.lit(None).cast("date").alias("start_date"),
    )
    side = matching.Side("id", ["name"])
    odd = c("id") % 2 == 1
    found = matching.candidates(
        named.where(odd), named.where(~odd), side, side, block=["year"], floor=0.5
    )
    return found.withColumn("score", F.round("score", 4))


def _events(spark, sf, shift):
    """Supplier seasons as events; the title is a hash, so that different events differ in name."""
    seasons = table(spark, sf, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").cast("bigint").alias("year")
    ).distinct()
    day = F.date_add(
        F.make_date("year", F.lit(1), F.lit(1)), (c("l_suppkey") * 37 % 330).cast("int") + shift
    )
    return seasons.select(
        F.lit("all").alias("tour"),
        "year",
        "l_suppkey",
        F.md5(c("l_suppkey").cast("string")).alias("tournament_name"),
        F.when(c("l_suppkey") % 2 == 0, "hard").otherwise("clay").alias("surface"),
        day.alias("start_date"),
    )


@query("""
WITH s AS (SELECT DISTINCT l_suppkey AS s, year(l_shipdate) AS y FROM lineitem)
SELECT CAST(y AS BIGINT) AS year, 'K-' || s AS sackmann_tourney_id, s AS official_tournament_id,
  round(0.5 + 0.4 * (1 - (s % 8) / 10.0) + 0.1, 4) AS score
FROM s WHERE s % 3 <> 0 AND s % 8 <= 4
""")
def second_chance(spark, sf):
    """Archive events against the catalog at the strict floor; the dates drift by up to a week."""
    drift = (c("l_suppkey") % 8).cast("int")
    archive = _events(spark, sf, 0).where(c("l_suppkey") % 3 != 0)
    archive = archive.withColumn("tourney_id", F.concat(F.lit("K-"), c("l_suppkey")))
    catalog = _events(spark, sf, drift).select(
        "tour", "year", "surface", "start_date",
        c("l_suppkey").alias("official_tournament_id"),
        F.upper("tournament_name").alias("group_name"),
        F.concat(F.lit("title "), c("tournament_name")).alias("title"),
    )
    found = matching.match_catalog(archive, catalog)
    return found.select(
        "year", "sackmann_tourney_id", "official_tournament_id", F.round("score", 4).alias("score")
    )


@query("""
WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, CAST(floor(value) AS BIGINT) AS v, event_id % 2 AS side FROM events),
f AS (SELECT * FROM e WHERE side = 1), a AS (SELECT * FROM e WHERE side = 0),
p AS (SELECT f.event_id AS fid, a.event_id AS aid, f.event_type AS w, 'u' || (f.user_id % 40) AS l, a.event_type AS wi,
        a.user_id % 40 AS li
      FROM f JOIN a ON f.user_id = a.user_id AND f.v = a.v AND f.day - a.day BETWEEN -2 AND 25
      WHERE f.event_id % 6 <> 1),
u AS (SELECT * FROM p WHERE fid IN (SELECT fid FROM p GROUP BY 1 HAVING count(*) = 1)
      AND aid IN (SELECT aid FROM p GROUP BY 1 HAVING count(*) = 1)),
votes AS (SELECT name, person, count(*) AS n FROM (SELECT w AS name, wi AS person FROM u
          UNION ALL SELECT l, 'p' || li FROM u) GROUP BY 1, 2),
best AS (SELECT name, person FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, person) AS r,
         sum(n) OVER (PARTITION BY name) AS t FROM votes) WHERE r = 1 AND n >= 2 AND n / t >= 0.3),
r AS (SELECT f.event_id AS fid, f.day, x.person AS wp, y.person AS lp FROM f JOIN best x ON x.name = f.event_type
      JOIN best y ON y.name = 'u' || (f.user_id % 40) WHERE f.event_id NOT IN (SELECT fid FROM u)),
q AS (SELECT fid, a.event_id AS aid FROM r JOIN a ON a.event_type = wp AND 'p' || (a.user_id % 40) = lp
      AND r.day - a.day BETWEEN -2 AND 25 WHERE a.event_id NOT IN (SELECT aid FROM u)),
z AS (SELECT fid, aid, 'rank' AS link_method FROM u UNION ALL
  SELECT fid, aid, 'name' FROM q WHERE fid IN (SELECT fid FROM q GROUP BY 1 HAVING count(*) = 1)
    AND aid IN (SELECT aid FROM q GROUP BY 1 HAVING count(*) = 1))
SELECT fid AS feed_id, aid AS archive_id, link_method FROM z
""")
def alias_linker(spark, sf):
    """Two halves of the events linked without an event table; names are learned on the way."""
    person = c("user_id") % 40
    events = table(spark, sf, "events").select(
        F.lit("x").alias("tour"),
        "event_id",
        c("ts").cast("date").alias("day"),
        c("event_type").alias("winner"),
        F.concat(F.lit("u"), person).alias("loser"),
        F.concat(F.lit("p"), person).alias("loser_id"),
        F.when((c("event_id") % 6 != 1) | (c("event_id") % 2 == 0), c("user_id")).alias("winner_rank"),
        F.floor("value").alias("loser_rank"),
    )
    odd = c("event_id") % 2 == 1
    feed = events.where(odd).drop("loser_id").withColumnRenamed("event_id", "feed_id")
    archive = (
        events.where(~odd)
        .drop("loser")
        .withColumnsRenamed({"event_id": "archive_id", "winner": "winner_id"})
    )
    return profile.link_by_aliases(feed, archive, share=0.3)
