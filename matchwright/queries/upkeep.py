"""Upserts, priority merges, replacements and place crosswalks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import identity, merge
from .registry import query, table

c = F.col


def _versions(spark, sf):
    """Order totals per customer: an old version, and a new one that overlaps it."""
    orders = table(spark, sf, "orders")
    old = orders.where(F.year("o_orderdate") < 1998)
    new = orders.where((F.year("o_orderdate") >= 1997) & (c("o_custkey") % 3 != 0))
    grouped = [
        df.groupBy("o_custkey").agg(F.max("o_orderkey").alias("newest"), F.count("*").alias(n))
        for df, n in ((old, "num_old"), (new, "num_new"))
    ]
    return grouped[0], grouped[1]


_VERSIONS = """
WITH a AS (SELECT o_custkey, max(o_orderkey) AS newest, count(*) AS n FROM orders WHERE year(o_orderdate) < 1998 GROUP BY 1),
b AS (SELECT o_custkey, max(o_orderkey) AS newest, count(*) AS n FROM orders
      WHERE year(o_orderdate) >= 1997 AND o_custkey % 3 <> 0 GROUP BY 1)
"""


@query(_VERSIONS + """
SELECT coalesce(b.o_custkey, a.o_custkey) AS o_custkey, coalesce(b.newest, a.newest) AS newest,
  CAST(CASE WHEN b.o_custkey IS NULL THEN a.n ELSE 0 END AS BIGINT) AS num_old, CAST(coalesce(b.n, 0) AS BIGINT) AS num_new
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey
""")
def upsert_last(spark, sf):
    return merge.upsert(*_versions(spark, sf), ["o_custkey"], keep="last")


@query(_VERSIONS + """
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.newest, b.newest) AS newest,
  CAST(coalesce(a.n, 0) AS BIGINT) AS num_old, CAST(CASE WHEN a.o_custkey IS NULL THEN b.n ELSE 0 END AS BIGINT) AS num_new
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey
""")
def upsert_first(spark, sf):
    return merge.upsert(*_versions(spark, sf), ["o_custkey"], keep="first")


@query("""
WITH e AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_nationkey END AS v FROM customer WHERE c_custkey % 5 <> 0),
n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_nationkey + 100 END AS v FROM customer WHERE c_custkey % 7 <> 0)
SELECT CAST(coalesce(e.k, n.k) AS BIGINT) AS customer,
  CAST(CASE WHEN n.k IS NOT NULL AND n.k % 10 = 1 THEN n.v WHEN e.k IS NULL THEN n.v WHEN n.k IS NULL THEN e.v
       ELSE coalesce(e.v, n.v) END AS BIGINT) AS official_tournament_id
FROM e FULL JOIN n ON e.k = n.k
""")
def priority_merge(spark, sf):
    customer = table(spark, sf, "customer")

    def links(rows, value):
        return rows.select(
            F.lit("customer").alias("source"),
            F.lit(2024).cast("bigint").alias("year"),
            c("c_custkey").cast("string").alias("source_tournament_id"),
            value.cast("bigint").alias("official_tournament_id"),
        )

    old = links(
        customer.where(c("c_custkey") % 5 != 0), F.when(c("c_custkey") % 4 != 0, c("c_nationkey"))
    )
    new = links(
        customer.where(c("c_custkey") % 7 != 0),
        F.when(c("c_custkey") % 6 != 0, c("c_nationkey") + 100),
    )
    overrides = customer.where(c("c_custkey") % 10 == 1).select(
        F.lit(2024).cast("bigint").alias("year"),
        c("c_custkey").cast("string").alias("uk_source_event_key"),
        F.lit(None).cast("string").alias("sackmann_tourney_id"),
    )
    merged = merge.priority_merge(old, new, merge.forced_keys(overrides, "customer", "other"))
    return merged.select(
        c("source_tournament_id").cast("bigint").alias("customer"), "official_tournament_id"
    )


@query("""
WITH e AS (SELECT p_name AS k, min(p_partkey) AS v FROM part WHERE p_size <= 25 GROUP BY 1),
x AS (SELECT DISTINCT p_name AS k FROM part WHERE p_size <= 25 AND p_brand = 'Brand#7'),
n AS (SELECT p_name AS k, min(p_partkey) AS v FROM part WHERE p_size > 25 GROUP BY 1)
SELECT n.k AS location_key, n.v AS incoming_id, e.v AS existing_id FROM n JOIN e ON n.k = e.k
WHERE n.v <> e.v AND n.k NOT IN (SELECT k FROM x)
""")
def conflict_report(spark, sf):
    part = table(spark, sf, "part")

    def places(rows, key):
        return rows.groupBy(key.alias("location_key")).agg(
            F.min("p_partkey").alias("official_tournament_id")
        )

    early = part.where("p_size <= 25")
    composite = places(
        early.where("p_brand = 'Brand#7'"), F.concat(c("p_name"), F.lit("|"), c("p_brand"))
    )
    existing = places(early, c("p_name")).unionByName(composite)
    incoming = places(part.where("p_size > 25"), c("p_name"))
    return merge.conflict_report(existing, incoming)


@query("""
WITH e AS (SELECT p_partkey, p_brand, p_name, p_size % 4 AS oid FROM part WHERE p_partkey % 7 <> 0),
a AS (SELECT p_brand, p_size8 FROM (SELECT p_brand, oid AS p_size8 FROM e) GROUP BY ALL),
r AS (SELECT lower(replace(p_brand, '#', ' ')) || '-' || p_name AS x, * FROM e),
amb AS (SELECT p_brand FROM e GROUP BY 1 HAVING count(DISTINCT oid) > 1),
k AS (SELECT CASE WHEN p_brand IN (SELECT p_brand FROM amb) THEN lower(replace(p_brand, '#', ' ')) || '|' || p_name
        ELSE lower(replace(p_brand, '#', ' ')) END AS location_key, oid, p_brand,
        row_number() OVER (PARTITION BY CASE WHEN p_brand IN (SELECT p_brand FROM amb) THEN lower(replace(p_brand, '#', ' ')) || '|' || p_name
        ELSE lower(replace(p_brand, '#', ' ')) END ORDER BY lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS r FROM e)
SELECT location_key, CAST(oid AS BIGINT) AS official_tournament_id, p_brand AS location FROM k WHERE r = 1
""")
def location_crosswalk(spark, sf):
    part = table(spark, sf, "part")
    key = F.lpad(c("p_partkey").cast("string"), 9, "0")
    links = part.select(
        key.alias("uk_source_event_key"),
        F.when(c("p_partkey") % 7 != 0, c("p_size") % 4)
        .cast("bigint")
        .alias("official_tournament_id"),
    )
    events = part.select(
        key.alias("source_event_key"),
        c("p_brand").alias("location"),
        c("p_name").alias("tournament_name"),
    )
    return identity.location_crosswalk(links, events)


@query("""
SELECT CAST(2024 AS BIGINT) AS year, 'customer' AS source, 'c' || c_custkey AS source_tournament_id,
  CAST(CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_nationkey END AS BIGINT) AS official_tournament_id FROM customer
UNION ALL
SELECT 2024, 'nation', 'n' || c_nationkey || '-' || c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_nationkey END
FROM customer WHERE c_custkey % 2 = 0
""")
def source_links(spark, sf):
    links = table(spark, sf, "customer").select(
        F.lit(2024).cast("bigint").alias("year"),
        F.concat(F.lit("c"), c("c_custkey")).alias("uk_source_event_key"),
        F.when(
            c("c_custkey") % 2 == 0, F.concat(F.lit("n"), c("c_nationkey"), F.lit("-"), c("c_custkey"))
        ).alias("sackmann_tourney_id"),
        F.when(c("c_nationkey") % 3 != 0, c("c_nationkey"))
        .cast("bigint")
        .alias("official_tournament_id"),
    )
    return identity.source_links(links, feed="customer", archive="nation")


_REPLACE = """
WITH old AS (SELECT o_orderkey AS k, year(o_orderdate) AS y, 'old' AS v FROM orders WHERE o_orderkey % 9 <> 0),
new AS (SELECT o_orderkey AS k, year(o_orderdate) AS y, 'new' AS v FROM orders WHERE year(o_orderdate) = 1998)
"""


def _replace_frames(spark, sf):
    orders = table(spark, sf, "orders").select(
        c("o_orderkey").alias("k"), F.year("o_orderdate").cast("bigint").alias("y")
    )
    old = orders.where(c("k") % 9 != 0).withColumn("v", F.lit("old"))
    return old, orders.where("y = 1998").withColumn("v", F.lit("new"))


@query(_REPLACE + """
SELECT k, CAST(y AS BIGINT) AS y, v FROM old WHERE y <> 1998 UNION ALL SELECT k, y, v FROM new
""")
def replace_period(spark, sf):
    old, new = _replace_frames(spark, sf)
    return merge.replace_period(old, new, c("y") == 1998, ["k", "y"])


@query(_REPLACE + """
SELECT k, CAST(y AS BIGINT) AS y, v FROM old UNION ALL SELECT k, y, v FROM new WHERE k NOT IN (SELECT k FROM old)
""")
def append_new(spark, sf):
    old, new = _replace_frames(spark, sf)
    return merge.append_new(old, new, ["k", "y"])
