"""Whole jobs: files written and read back, cleaning, mapping, linking, export, refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import archive as archive_contract
from ..operators import columns, linking
from ..plans import cleaning, curated, mapping, tournaments
from ..plans import linking as linking_job_plan
from ..session import scratch_path, stage
from ..sources import archive, catalog, feed, files, sinks
from ..streaming.refresh import refresh_rollup
from . import linkage
from .registry import query, table

c = F.col


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) = 1997 THEN 'X' ELSE o_orderstatus END AS status,
  CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS BIGINT) AS year
FROM orders
""")
def scan_round_trip(spark, sf):
    """CSV drops with differing headers, read by name; stored by year; one year replaced."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        c("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("day"),
        F.year("o_orderdate").alias("year"),
    )
    landing, store = scratch_path(spark, "landing"), scratch_path(spark, "store")
    early, late = c("year") < 1998, c("year") >= 1998
    layout = ["o_orderkey", "o_custkey", "status", "day"]
    for name, rows, header in (
        ("early", orders.where(early), layout),
        ("late", orders.where(late), [*reversed(layout), "extra"]),
    ):
        rows = rows.withColumn("extra", F.lit("?"))
        rows.select(*header).write.option("header", True).csv(f"{landing}/{name}")
    raw = files.reject_ragged(files.read_text_csv(spark, [f"{landing}/early", f"{landing}/late"]))
    typed = columns.coerce(raw, longs=["o_orderkey", "o_custkey"], days=["day"])
    typed = typed.drop("extra", "_file").withColumn("year", F.year("day").cast("bigint"))
    sinks.overwrite_partitions(typed, store, ["year"], sort=["o_orderkey"])
    changed = typed.where("year = 1997").withColumn("status", F.lit("X"))
    sinks.overwrite_partitions(changed, store, ["year"])
    schema = "o_orderkey bigint, o_custkey bigint, status string, day date, year bigint"
    return files.read_table(spark, store, schema)


@query("""
WITH l AS (SELECT CASE WHEN year(l_shipdate) < 2000 THEN 1999 ELSE 2000 END AS y, l_orderkey, l_linenumber, l_partkey, l_quantity,
  CAST(l_shipdate AS DATE) AS d, l_returnflag FROM lineitem),
n AS (SELECT y, l_orderkey, l_linenumber, count(*) AS n FROM l GROUP BY ALL)
SELECT l_orderkey || '_' || l_linenumber || CASE WHEN n > 1 THEN '_' || l_returnflag ELSE '' END AS canonical_match_key,
  CAST(y AS BIGINT) AS source_year, 'atp' AS tour, 'singles' AS match_type, 'main' AS match_level, d AS tourney_date,
  CAST(l_partkey AS BIGINT) AS winner_rank, CAST(l_quantity AS DOUBLE) AS winner_age
FROM l JOIN n USING (y, l_orderkey, l_linenumber)
""")
def archive_scan(spark, sf):
    """Season drops in the archive layout, the headers in opposite orders."""
    root = scratch_path(spark, "archive")
    rows = table(spark, sf, "lineitem").select(
        F.when(F.year("l_shipdate") < 2000, 1999).otherwise(2000).alias("season"),
        c("l_orderkey").alias("tourney_id"),
        c("l_linenumber").alias("match_num"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("tourney_date"),
        c("l_returnflag").alias("round"),
        F.concat(c("l_partkey"), F.lit(".0")).alias("winner_rank"),
        c("l_quantity").alias("winner_age"),
    )
    full = columns.ensure_columns(rows, dict.fromkeys(archive_contract.layout("singles"), "string"))
    for season, header in (
        (1999, archive_contract.layout("singles")),
        (2000, archive_contract.layout("singles")[::-1]),
    ):
        name = archive_contract.FILES[("atp", "main")].format(year=season)
        part = full.where(c("season") == season).select(*header)
        part.write.option("header", True).csv(f"{root}/{name}")
    out = archive.scan_archive(spark, root, "atp", archive.year_range(1999, 2000))
    return out.select(
        "canonical_match_key", "source_year", "tour", "match_type", "match_level", "tourney_date",
        "winner_rank", "winner_age",
    )


@query("""
SELECT CAST(p_size AS BIGINT) AS year, p_partkey AS official_tournament_id, p_name AS group_name, p_brand AS title,
  CAST('2024-03-01' AS DATE) AS start_date, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_type END AS singles_champion
FROM part WHERE p_type <> 'PROMO'
""")
def catalog_scan(spark, sf):
    """JSON pages of at most a hundred entries, flattened, without one level, typed."""
    path = scratch_path(spark, "catalog")
    winner = F.when(
        c("p_partkey") % 2 == 1,
        F.array(F.struct(F.struct(F.struct(c("p_type").alias("fullName")).alias("player")).alias("singles"))),
    )
    entry = F.struct(
        F.struct(c("p_partkey").alias("id"), c("p_name").alias("name")).alias("tournamentGroup"),
        c("p_type").alias("level"),
        c("p_brand").alias("title"),
        c("p_size").alias("year"),
        F.lit("2024-03-01").alias("startDate"),
        F.lit("2024-03-09").alias("endDate"),
        winner.alias("winners"),
    )
    pages = (
        table(spark, sf, "part")
        .withColumn("page", F.floor(c("p_partkey") / 100))
        .groupBy("page")
        .agg(F.collect_list(entry).alias("content"))
    )
    pages.write.json(path)
    flat = catalog.scan_catalog(spark, path, exclude_levels="PROMO", multi_line=False)
    return catalog.catalog_table(flat).select(
        "year", "official_tournament_id", "group_name", "title", "start_date", "singles_champion"
    )


@query("""
SELECT 'nation' AS origin, CAST(n_nationkey AS BIGINT) AS id FROM nation
""")
def mapping_scan(spark, sf):
    """A lookup table that exists, and one that was never written."""
    schema = "origin string, id bigint"
    root = scratch_path(spark, "lookup")
    rows = table(spark, sf, "nation").select(
        F.lit("nation").alias("origin"), c("n_nationkey").cast("bigint").alias("id")
    )
    sinks.store(rows, root, ["origin"])
    there = sinks.current(spark, root, schema)
    return there.unionByName(files.read_table(spark, f"{root}/never", schema))


_RAW_SQL = """
WITH l AS (SELECT l_orderkey, l_partkey, l_suppkey AS s, l_linenumber AS ln, CAST(l_shipdate AS DATE) AS d, year(l_shipdate) AS y,
    CAST(l_quantity AS BIGINT) AS q, l_returnflag AS f, l_discount AS disc FROM lineitem),
k AS (SELECT y, s, ln, dense_rank() OVER (PARTITION BY y, s ORDER BY ln DESC) AS r FROM (SELECT DISTINCT y, s, ln FROM l WHERE ln <= 5)),
r AS (SELECT l.*, CASE WHEN l.ln = 6 THEN 'QF' WHEN l.ln = 7 THEN 'F' ELSE ['R16', 'R32', 'R64', 'R128', 'R256'][k.r] END AS round
      FROM l LEFT JOIN k ON l.y = k.y AND l.s = k.s AND l.ln = k.ln),
x AS (SELECT *, y || '_' || s || '_city_' || s || '_open_no_' || s AS event FROM r),
z AS (SELECT *, event || '_' || strftime(d, '%Y-%m-%d') || '_' || round || '_p' || l_partkey || '_a_q' || (l_orderkey % 100) || '_b' AS key FROM x)
"""


def _raw_feed(spark, sf, sets=None):
    """Line items under the raw names of the feed; ``sets`` are the sets that the winner won."""
    labels = ["1st Round", "2nd Round", "3rd Round", "4th Round", "5th Round"]
    labels += ["Quarterfinals", "The Final"]
    label = F.array(*[F.lit(x) for x in labels])
    flag = c("l_returnflag")
    q = c("l_quantity").cast("bigint")
    return table(spark, sf, "lineitem").select(
        F.lit("atp").alias("tour"),
        c("l_suppkey").alias("ATP"),
        F.concat(F.lit("City "), c("l_suppkey")).alias("Location"),
        F.concat(F.lit("Open No. "), c("l_suppkey")).alias("Tournament"),
        c("l_shipdate").cast("date").alias("Date"),
        F.year("l_shipdate").cast("bigint").alias("Year"),
        F.when(c("l_suppkey") % 3 == 0, "Masters").otherwise("ATP250").alias("Series"),
        F.lit("Outdoor").alias("Court"),
        F.when(c("l_suppkey") % 10 == 0, "Ice").otherwise("Hard").alias("Surface"),
        F.element_at(label, c("l_linenumber")).alias("Round"),
        F.when(c("l_partkey") % 4 == 0, 5).otherwise(3).cast("bigint").alias("Best of"),
        F.concat(F.lit("P"), c("l_partkey"), F.lit(" A.")).alias("Winner"),
        F.concat(F.lit("Q"), c("l_orderkey") % 100, F.lit(" B.")).alias("Loser"),
        F.lit(6).cast("bigint").alias("W1"),
        F.lit(2).cast("bigint").alias("L1"),
        (F.lit(2).cast("bigint") if sets is None else sets).alias("Wsets"),
        F.when(q > 48, 2).otherwise(0).cast("bigint").alias("Lsets"),
        F.when(flag == "R", "Retired").when(flag == "A", "Completed").otherwise("Odd").alias("Comment"),
        (c("l_discount") * 20 + 0.5).alias("B365W"),
    )


@query(_RAW_SQL + """
SELECT key AS source_match_key, round,
  CAST(CASE round WHEN 'F' THEN 2 WHEN 'QF' THEN 8 ELSE CAST(substr(round, 2) AS INT) END AS BIGINT) AS players_remaining,
  CAST(CASE WHEN s % 3 = 0 AND l_partkey % 4 = 0 THEN 5 ELSE 3 END AS BIGINT) AS best_of,
  CASE WHEN s % 3 = 0 THEN 'Masters' ELSE 'atp_250' END AS series,
  CASE f WHEN 'R' THEN 'retired' WHEN 'A' THEN 'completed' ELSE 'Odd' END AS match_status,
  CASE WHEN s % 10 = 0 THEN 'Ice' ELSE 'hard' END AS surface,
  round(CASE WHEN disc * 20 + 0.5 < 1 THEN NULL ELSE disc * 20 + 0.5 END, 4) AS odds_b365_winner
FROM z
""")
def clean_job(spark, sf):
    """Fixes, keys, round codes, recoding and layout in one plan."""
    raw = _raw_feed(spark, sf)
    out = cleaning.clean(cleaning.fix_raw(raw, "atp"), "atp")
    return out.select(
        "source_match_key", "round", "players_remaining", "best_of", "series", "match_status",
        "surface", F.round("odds_b365_winner", 4).alias("odds_b365_winner"),
    )


@query(_RAW_SQL + """
SELECT CAST(y AS BIGINT) AS year, rule, CAST(n AS BIGINT) AS "rows" FROM (
  SELECT y, 'unexpected_surface' AS rule, count(*) FILTER (s % 10 = 0) AS n FROM z GROUP BY y
  UNION ALL SELECT y, 'unexpected_round', count(*) FILTER (round = 'R256') FROM z GROUP BY y
  UNION ALL SELECT y, 'completed_winner_sets_not_above', count(*) FILTER (f = 'A' AND q > 48) FROM z GROUP BY y
  UNION ALL SELECT y, 'duplicate_key', count(*) - count(DISTINCT key) FROM z GROUP BY y)
WHERE n > 0
""")
def clean_gates(spark, sf):
    raw = _raw_feed(spark, sf)
    cleaned = cleaning.clean(cleaning.fix_raw(raw, "atp"), "atp")
    return cleaning.clean_gates(cleaned, "atp").select("year", "rule", "rows")


@query("""
WITH s AS (SELECT DISTINCT l_suppkey AS s, year(l_shipdate) AS y FROM lineitem)
SELECT CAST(y AS BIGINT) AS year, 'tennis_data_uk' AS source, 'F-' || y || '-' || s AS source_tournament_id,
  CASE WHEN s % 3 <> 0 THEN s END AS official_tournament_id FROM s WHERE s % 5 <> 0
UNION ALL
SELECT y, 'sackmann', y || '-' || s, s FROM s WHERE s % 3 <> 0
""")
def mapping_job(spark, sf):
    """Match events of all seasons, store crosswalk and source links, return the links."""
    events = linkage._events(spark, sf, 0)
    named = events.withColumns(
        {
            "source_event_key": F.concat(F.lit("F-"), c("year"), F.lit("-"), c("l_suppkey")),
            "tourney_id": F.concat(c("year"), F.lit("-"), c("l_suppkey")),
            "location": c("tournament_name"),
            "tourney_level": F.lit("A"),
        }
    )
    done = mapping.map_tournaments(
        spark,
        named.where(c("l_suppkey") % 5 != 0),
        named.where(c("l_suppkey") % 3 != 0),
        scratch_path(spark, "mapping"),
        floor=0.8,
    )
    return done.source_links.drop("tour")


@query(linkage._BASE + """
SELECT year, CAST(count(*) AS BIGINT) AS uk_total_matches,
  CAST(count(*) FILTER (linkage_status = 'linked') AS BIGINT) AS linked_matches,
  CAST(count(*) FILTER (linkage_status = 'unmatched') AS BIGINT) AS unmatched_matches,
  CAST(count(*) FILTER (linkage_status = 'linked') AS BIGINT) AS stored_links,
  CAST(count(*) AS BIGINT) AS stored_rows
FROM st GROUP BY year
""")
def linking_job(spark, sf):
    """Link all seasons, store the five tables, read the summary and two tables back."""
    lines = linkage.records(spark, sf)
    tags = {"feed": "tennis_data_uk", "archive": "sackmann"}
    ids = linkage.bridge(spark, sf).withColumn("source", columns.recode(c("source"), tags))
    feed = lines.where(c("event").startswith("F")).drop("winner_id", "loser_id")
    feed = feed.withColumnsRenamed({"key": "source_match_key", "event": "source_event_key"})
    other = lines.where(c("event").startswith("A"))
    other = other.withColumnsRenamed({"key": "canonical_match_key", "event": "tourney_id"})
    other = other.withColumnRenamed("year", "source_year")
    root = scratch_path(spark, "linked")
    summary = linking_job_plan.link_seasons(spark, feed, other, ids, root)

    def stored(name, out):
        rows = spark.read.parquet(f"{root}/{name}")
        return rows.groupBy("year").agg(F.count("*").alias(out))

    return (
        summary.join(stored("match_links", "stored_links"), "year")
        .join(stored("enriched_matches", "stored_rows"), "year")
        .select(
            c("year").cast("bigint").alias("year"), "uk_total_matches", "linked_matches",
            "unmatched_matches", "stored_links", "stored_rows",
        )
    )


def _job_inputs(spark, sf):
    """Feed, archive and bridge of the linking job; sources carry the names the job expects."""
    lines = linkage.records(spark, sf)
    tags = {"feed": "tennis_data_uk", "archive": "sackmann"}
    ids = linkage.bridge(spark, sf).withColumn("source", columns.recode(c("source"), tags))
    feed = lines.where(c("event").startswith("F")).drop("winner_id", "loser_id")
    feed = feed.withColumnsRenamed({"key": "source_match_key", "event": "source_event_key"})
    other = lines.where(c("event").startswith("A")).withColumnsRenamed(
        {"key": "canonical_match_key", "event": "tourney_id", "year": "source_year"}
    )
    return feed, other, ids


def _twice(df, shift=None):
    """The same rows for two tours; ids of the second are shifted where that is asked for."""
    second = df.withColumn("tour", F.lit("wta"))
    if shift is not None:
        second = second.withColumn(shift, c(shift) + 1_000_000)
    return df.withColumn("tour", F.lit("atp")).unionByName(second)


@query(linkage._BASE + """
SELECT tour, year, CAST(count(*) FILTER (linkage_status = 'linked') AS BIGINT) AS stored_links,
  CAST(count(*) FILTER (linkage_status = 'linked') AS BIGINT) AS exported,
  CAST(sum(CASE WHEN linkage_status = 'linked' THEN oid + CASE tour WHEN 'wta' THEN 1000000 ELSE 0 END END) AS BIGINT) AS id_sum
FROM st, (VALUES ('atp'), ('wta')) t(tour) GROUP BY tour, year
""")
def two_tours_job(spark, sf):
    """Two tours with equal event ids and match keys, linked, stored and exported in one run."""
    feed, other, ids = _job_inputs(spark, sf)
    root = scratch_path(spark, "two-tours")
    linking_job_plan.link_seasons(
        spark, _twice(feed), _twice(other), _twice(ids, "official_tournament_id"), root
    )
    enriched = spark.read.parquet(f"{root}/enriched_matches")
    enriched = columns.ensure_columns(enriched, dict.fromkeys(curated.FEED_COLUMNS, "string"))
    history = _twice(other).withColumns(
        {"score": F.lit("6-1 6-2"), "tourney_date": F.make_date(c("source_year") - 1, F.lit(12), F.lit(31))}
    )
    history = columns.ensure_columns(history, dict.fromkeys(archive_contract.layout("singles"), "string"))
    curated.export(curated.curated_matches(history, enriched), f"{root}/export")
    links = spark.read.parquet(f"{root}/match_links").groupBy("tour", "year")
    out = spark.read.parquet(f"{root}/export").groupBy("tour", "year")
    return (
        links.agg(F.count("*").alias("stored_links"), F.sum("official_tournament_id").alias("id_sum"))
        .join(out.agg(F.count("*").alias("exported")), ["tour", "year"])
        .select("tour", c("year").cast("bigint").alias("year"), "stored_links", "exported", "id_sum")
    )


@query(linkage._BASE + """
SELECT year, CAST(count(*) FILTER (linkage_status = 'linked') AS BIGINT) AS linked,
  CAST(count(*) FILTER (linkage_status = 'ambiguous') AS BIGINT) AS ambiguous,
  CAST(count(*) FILTER (linkage_status = 'unmatched') AS BIGINT) AS unmatched
FROM st GROUP BY year
""")
def linking_rerun(spark, sf):
    """Linked twice: first with a rival of every archive record, then without; nothing stale stays."""
    feed, other, ids = _job_inputs(spark, sf)
    rivals = other.withColumn("canonical_match_key", F.concat("canonical_match_key", F.lit("-rival")))
    root = scratch_path(spark, "relinked")
    linking_job_plan.link_seasons(spark, feed, other.unionByName(rivals), ids, root)
    summary = linking_job_plan.link_seasons(spark, feed, other, ids, root)

    def stored(name, out):
        rows = spark.read.parquet(f"{root}/{name}")
        # The ambiguous table has a row for each pass that found candidates of a record.
        return rows.groupBy("year").agg(F.count_distinct("source_match_key").alias(out))

    seasons = summary.select("year")
    for name, out in (("match_links", "linked"), ("ambiguous", "ambiguous"), ("unmatched", "unmatched")):
        seasons = seasons.join(stored(name, out), "year", "left")
    zero = F.lit(0).cast("bigint")
    return seasons.select(
        c("year").cast("bigint").alias("year"),
        *[F.coalesce(x, zero).alias(x) for x in ("linked", "ambiguous", "unmatched")],
    )


@query("""
WITH o AS (SELECT o_orderkey AS k, CAST(year(CAST(o_orderdate AS DATE) + INTERVAL 10 DAY) AS BIGINT) AS year FROM orders)
SELECT year, CAST(count(*) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS keys FROM o
WHERE year <> 1996 OR k % 2 = 0 GROUP BY year
""")
def export_rerun(spark, sf):
    """Seasons begin in late December; exporting one again leaves the others as they are."""
    day = c("o_orderdate").cast("date")
    rows = table(spark, sf, "orders").select(
        F.lit("atp").alias("tour"),
        F.year(F.date_add(day, 10)).cast("bigint").alias("source_year"),
        day.alias("tourney_date"),
        c("o_orderkey").alias("match_num"),
    )
    path = scratch_path(spark, "export")
    curated.export(rows, path)
    curated.export(rows.where((c("source_year") == 1996) & (c("match_num") % 2 == 0)), path)
    back = spark.read.parquet(path).groupBy(c("year").cast("bigint").alias("year"))
    return back.agg(F.count("*").alias("n"), F.sum("match_num").alias("keys"))


@query("""
SELECT 'x' AS tour, CAST(year(l_shipdate) AS BIGINT) AS year, 'rows' AS metric,
  CAST(CASE WHEN min(year(l_shipdate)) = 1997 THEN -1 ELSE count(*) END AS DOUBLE) AS value FROM lineitem GROUP BY 2
UNION ALL
SELECT 'x', year(l_shipdate), 'returned', CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) FROM lineitem
WHERE year(l_shipdate) <> 1997 GROUP BY 2
""")
def report_update(spark, sf):
    """The report of all seasons, then one season again with fewer metrics."""
    root = scratch_path(spark, "report")
    by_year = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(
        F.count("*").cast("double").alias("rows"),
        F.count_if(c("l_returnflag") == "R").cast("double").alias("returned"),
    )
    long = by_year.withColumn("tour", F.lit("x")).unpivot(["tour", "year"], ["rows", "returned"], "metric", "value")
    cleaning.update_report(long, root)
    again = long.where("year = 1997 and metric = 'rows'").withColumn("value", F.lit(-1.0))
    return cleaning.update_report(again, root)


@query("""
SELECT 'x' AS tour, CAST(year(l_shipdate) AS BIGINT) AS year, l_suppkey AS event,
  CAST(count(*) + CASE WHEN min(year(l_shipdate)) = 1997 AND l_suppkey % 2 = 0 THEN 1000 ELSE 0 END AS BIGINT) AS matches
FROM lineitem GROUP BY 2, 3
""")
def tournaments_update(spark, sf):
    """A keyed table stored season by season; rebuilt rows win, other rows of the season stay."""
    root = scratch_path(spark, "tournaments")
    rows = table(spark, sf, "lineitem").groupBy(
        F.year("l_shipdate").cast("bigint").alias("year"), c("l_suppkey").alias("event")
    )
    rows = rows.agg(F.count("*").alias("matches")).select(F.lit("x").alias("tour"), "year", "event", "matches")
    tournaments.update_tournaments(rows, root, ["tour", "year", "event"])
    rebuilt = rows.where("year = 1997 and event % 2 = 0").withColumn("matches", c("matches") + 1000)
    return tournaments.update_tournaments(rebuilt, root, ["tour", "year", "event"])


@query("""
SELECT c_custkey AS player_id, c_name AS name_last, CAST(150 + c_nationkey AS BIGINT) AS height,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '1990-05-01' END AS DATE) AS dob FROM customer
""")
def people_scan(spark, sf):
    """Biographies with declared types, whatever the order of the columns."""
    root = scratch_path(spark, "people")
    rows = table(spark, sf, "customer").select(
        (c("c_nationkey") + 150).alias("height"),
        F.when(c("c_custkey") % 3 == 0, "").otherwise("19900501").alias("dob"),
        c("c_name").alias("name_last"),
        c("c_custkey").alias("player_id"),
    )
    path = f"{root}/{archive_contract.PEOPLE_FILE.format(tour='atp')}"
    rows.write.option("header", True).csv(path)
    return archive.scan_people(spark, root, "atp").select("player_id", "name_last", "height", "dob")


@query("""
SELECT CAST(year(l_shipdate) AS BIGINT) AS "Year", CAST(l_suppkey AS BIGINT) AS "ATP", 'City ' || l_suppkey AS "Location",
  CAST(l_shipdate AS DATE) AS "Date", CAST(l_linenumber AS BIGINT) AS "Wsets", round(l_discount * 20 + 0.5, 4) AS "B365W"
FROM lineitem
""")
def feed_scan(spark, sf):
    """Season files with two different headers, one scan per header, typed and tagged."""
    root = scratch_path(spark, "feed")
    raw = _raw_feed(spark, sf, F.concat(c("l_linenumber"), F.lit(".0")))
    raw = raw.withColumns({"Location": F.concat(c("Location"), F.lit(" ")), "B365W": F.round("B365W", 4)})
    seasons = [r[0] for r in raw.select("Year").distinct().collect()]
    drops = {}
    for parity in (0, 1):
        header = [x for x in raw.columns if x not in ("tour", "Year")]
        part = raw.where(c("Year") % 2 == parity).withColumn("season", c("Year"))
        path = f"{root}/{parity}"
        part.select("season", *(header if parity else header[::-1])).write.partitionBy("season").option("header", True).csv(path)
        drops |= {("atp", y): f"{path}/season={y}" for y in seasons if y % 2 == parity}
    out = feed.scan_raw(spark, drops)
    return out.select("Year", "ATP", "Location", "Date", "Wsets", F.round("B365W", 4).alias("B365W"))


@query(linkage._BASE + """
, m AS (SELECT uk FROM (SELECT uk, row_number() OVER (PARTITION BY year ORDER BY uk) AS r FROM a1) WHERE r = 1)
SELECT source_match_key, year, linkage_status,
  CASE WHEN source_match_key IN (SELECT uk FROM m) THEN 'manual_override' ELSE match_method END AS match_method
FROM st
""")
def linked_with_manual(spark, sf):
    """All passes, with the first rank link of every year given by hand."""
    feed_side, other = linkage.both_sides(spark, sf)
    links = linking.rank_links(linking.rank_blocks(feed_side, other))
    first = links.groupBy("year").agg(F.min("source_match_key").alias("source_match_key"))
    manual = links.join(first, ["year", "source_match_key"], "left_semi").select(
        "tour", "year", "source_match_key", "canonical_match_key"
    )
    out = linking.link(feed_side, other, stage(manual, "manual"))
    return out.status.select("source_match_key", "year", "linkage_status", "match_method")


@query(linkage._BASE + """
SELECT kk AS canonical_match_key, CAST(k.wr AS BIGINT) AS winner_rank, k.rnd AS round, 'tournament_rank_unique' AS match_method,
  CAST(6 AS BIGINT) AS set1_winner, CAST(k.lr % 5 AS BIGINT) AS set1_loser, round(u.wp, 2) AS odds_avg_winner,
  CASE WHEN k.rnd = 'R' THEN 'retired' ELSE 'completed' END AS match_status
FROM a1 JOIN k ON a1.kk = k.key JOIN u ON a1.uk = u.key
""")
def curated_dataset(spark, sf):
    """Linked matches with score features from the archive and odds from the feed."""
    feed, other = linkage.both_sides(spark, sf)
    links = linking.rank_links(linking.rank_blocks(feed, other))
    priced = feed.withColumn("odds_avg_winner", c("winner_rank_points"))
    enriched = linking.enrich(priced, other, links)
    enriched = columns.ensure_columns(enriched, dict.fromkeys(curated.FEED_COLUMNS, "string"))
    ret = F.when(c("round") == "R", F.lit(" RET")).otherwise(F.lit(""))
    history = other.withColumn(
        "score", F.concat(F.lit("6-"), c("loser_rank") % 5, ret)
    )
    history = history.withColumn("source_year", c("year"))
    history = columns.ensure_columns(history, dict.fromkeys(archive_contract.layout("singles"), "string"))
    out = curated.curated_matches(history.withColumn("tourney_date", F.lit(None).cast("date")), enriched)
    return out.select(
        "canonical_match_key", "winner_rank", "round", "match_method", "set1_winner", "set1_loser",
        F.round("odds_avg_winner", 2).alias("odds_avg_winner"), "match_status",
    )


@query("""
SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT user_id) AS BIGINT) AS users,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events GROUP BY 1
""")
def season_refresh(spark, sf):
    """Two batches land one after the other, the second with late rows for earlier days."""
    landing, target = scratch_path(spark, "events"), scratch_path(spark, "daily")
    checkpoint = scratch_path(spark, "refresh")
    schema = "event_id bigint, user_id bigint, value double, day date"
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", "value", c("ts").cast("date").alias("day")
    )

    def landed():
        return spark.read.schema(schema).parquet(landing)

    def daily(df):
        return df.groupBy("day").agg(
            F.count("*").alias("events"),
            F.count_distinct("user_id").alias("users"),
            F.sum(F.round(c("value") * 100).cast("bigint")).alias("cents"),
        )

    late = (F.dayofmonth("day") > 20) | (c("event_id") % 50 == 0)
    for batch in (rows.where(~late), rows.where(late)):
        batch.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        refresh_rollup(stream, landed, daily, target, checkpoint, ["day"])
    return spark.read.parquet(target).select("day", "events", "users", "cents")
