"""Scans, projections, scalar functions and simple joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..functions import dates, keys, names, numbers, scores, text
from ..operators import columns, corrections, joins, linking, ordering, profile
from ..sources.catalog import first_champion
from .registry import query, table

c = F.col


@query("""
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE year(o_orderdate) < 1998
UNION ALL
SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE year(o_orderdate) >= 1998
""")
def drift_union(spark, sf):
    orders = table(spark, sf, "orders")
    early = orders.where(F.year("o_orderdate") < 1998)
    late = orders.where(F.year("o_orderdate") >= 1998)
    return columns.union_seasons(
        [
            early.select("o_orderkey", "o_totalprice", "o_orderpriority"),
            late.select("o_orderkey", "o_totalprice"),
        ]
    )


@query("""
SELECT o_orderkey, 'orders' AS source, CAST(year(o_orderdate) AS BIGINT) AS source_year,
       'main' AS match_level
FROM orders
""")
def tag_provenance(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.regexp_extract("_metadata.file_name", r"^([a-z]+)\.", 1).alias("source"),
        F.year("o_orderdate").cast("bigint").alias("source_year"),
        F.lit("main").alias("match_level"),
    )


@query("""
WITH e AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, k, CASE WHEN k % 3 = 0 THEN NULL ELSE event_type END AS champion FROM e
""")
def json_flatten(spark, sf):
    schema = "k bigint, winners array<struct<singles: struct<player: struct<fullName: string>>>>"
    k = F.from_json("props", "k bigint")["k"]
    listed = F.when(k % 3 == 0, F.lit("[]")).otherwise(
        F.concat(
            F.lit('[{"singles":null},{"singles":{"player":{"fullName":"'),
            c("event_type"),
            F.lit('"}}}]'),
        )
    )
    entry = F.concat(F.lit('{"k":'), k.cast("string"), F.lit(',"winners":'), listed, F.lit("}"))
    parsed = table(spark, sf, "events").select("event_id", F.from_json(entry, schema).alias("e"))
    return parsed.select("event_id", "e.k", first_champion(c("e.winners")).alias("champion"))


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer,
       9007199254740993 + o_custkey AS big_id, 9007199254740993 + o_orderkey AS long_id,
       CASE WHEN o_orderkey % 3 = 0 THEN -1.0 ELSE o_totalprice END AS price,
       CAST(o_orderdate AS DATE) AS compact_date
FROM orders
""")
def typed_coercion(spark, sf):
    even = c("o_orderkey") % 2 == 0
    drifted = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(even, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
        .alias("order_date"),
        F.when(c("o_orderkey") % 5 == 0, "NR")
        .otherwise(F.concat(c("o_custkey").cast("string"), F.when(even, ".0").otherwise("")))
        .alias("customer"),
        F.when(c("o_orderkey") % 3 == 0, " ")
        .otherwise(c("o_totalprice").cast("string"))
        .alias("price"),
        F.concat((c("o_custkey") + 9007199254740993).cast("string"), F.when(even, ".0").otherwise("")).alias("big_id"),
        (c("o_orderkey") + 9007199254740993).alias("long_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("compact_date"),
    )
    typed = columns.coerce(
        drifted, longs=["customer", "big_id", "long_id"], days=["order_date"], compact_days=["compact_date"]
    )
    return typed.withColumn("price", numbers.number_or(c("price"), -1))


@query("""
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
            ELSE o_orderpriority END AS priority,
       CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS is_open,
       CAST(NULL AS BIGINT) AS not_in_this_season
FROM orders
""")
def recode(spark, sf):
    df = table(spark, sf, "orders").withColumnsRenamed(
        {"o_orderpriority": "priority", "o_orderstatus": "is_open"}
    )
    df = df.withColumns(
        {
            "priority": columns.recode(c("priority"), {"1-URGENT": "urgent", "2-HIGH": "high"}),
            "is_open": columns.recode(c("is_open"), {"F": False, "O": True}, keep_unmapped=False),
        }
    )
    layout = [
        StructField("o_orderkey", LongType()),
        StructField("priority", StringType()),
        StructField("is_open", BooleanType()),
        StructField("not_in_this_season", LongType()),
    ]
    return columns.conform(df, StructType(layout))


@query("""
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS lines,
       CAST(count(*) FILTER (l_discount >= 0.02) AS BIGINT) AS kept_discounts,
       CAST(count(*) FILTER (l_tax >= 0.02) AS BIGINT) AS kept_taxes
FROM lineitem GROUP BY 1
""")
def null_invalid(spark, sf):
    df = columns.null_invalid(
        table(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_other"], 0.02
    )
    return df.groupBy("l_returnflag").agg(
        F.count("*").alias("lines"),
        F.count("l_discount").alias("kept_discounts"),
        F.count("l_tax").alias("kept_taxes"),
    )


@query("""
SELECT 'l_discount' AS "column", CAST(count(*) FILTER (l_discount < 0.02) AS BIGINT) AS removed
FROM lineitem
UNION ALL SELECT 'l_tax', CAST(count(*) FILTER (l_tax < 0.02) AS BIGINT) FROM lineitem
""")
def count_invalid(spark, sf):
    return columns.count_invalid(table(spark, sf, "lineitem"), ["l_discount", "l_tax"], 0.02)


@query("""
SELECT p_partkey,
       CASE WHEN p_type = 'PROMO' AND p_size > 25 THEN 'LARGE' ELSE p_type END AS p_type,
       CASE WHEN regexp_full_match(p_brand, 'Brand#2[1-4]') THEN 'Brand#20' ELSE p_brand END
         AS p_brand,
       CAST(CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 5
                 WHEN NOT (p_type = 'PROMO' AND p_size > 25) AND p_type <> 'ECONOMY' THEN 3
                 WHEN p_type = 'PROMO' AND p_size > 25 THEN 5
                 ELSE p_size END AS BIGINT) AS p_size
FROM part
""")
def rule_rewrite(spark, sf):
    named = c("p_type").isin("SMALL", "LARGE")
    df = table(spark, sf, "part").select(
        "p_partkey", "p_type", "p_brand", c("p_size").cast("bigint").alias("p_size")
    )
    return columns.rewrite(
        df,
        [
            ("p_type", (c("p_type") == "PROMO") & (c("p_size") > 25), "LARGE"),
            ("p_brand", c("p_brand").rlike("^Brand#2[1-4]$"), "Brand#20"),
            ("p_size", named, 5),
            ("p_size", ~named & columns.not_equal(c("p_type"), "ECONOMY"), 3),
        ],
    )


@query("""
SELECT c_custkey,
       CASE WHEN c_acctbal > 0 AND c_nationkey = 2 THEN 3
            WHEN c_acctbal > 0 AND c_nationkey = 3 THEN 2 ELSE c_nationkey END AS c_nationkey,
       CASE WHEN c_acctbal > 0 AND c_nationkey = 2 THEN 'NATION_3'
            WHEN c_acctbal > 0 AND c_nationkey = 3 THEN 'NATION_2' ELSE n_name END AS n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def block_swap(spark, sf):
    nation = table(spark, sf, "nation").select(c("n_nationkey").alias("c_nationkey"), "n_name")
    df = table(spark, sf, "customer").join(nation, "c_nationkey")
    swapped = columns.swap_blocks(
        df, "c_nationkey", 2, 3, ["c_nationkey", "n_name"], c("c_acctbal") > 0
    )
    return swapped.select("c_custkey", "c_nationkey", "n_name")


def _orders_and_fixes(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.lit("t").alias("tour"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.when(c("o_orderkey") % 2 == 0, c("o_orderdate").cast("date")).alias("day"),
        "o_custkey",
        "o_totalprice",
    )
    picked = orders.where(c("o_totalprice") > 480_000)
    wrong = c("o_orderstatus") == "F"
    fixes = picked.select(
        F.concat(F.lit("fix-"), c("o_orderkey")).alias("fix_id"),
        "tour",
        "year",
        F.when(wrong, -1 - c("o_orderkey")).otherwise(c("o_orderkey")).alias("event_id"),
        c("o_orderstatus").alias("winner"),
        c("o_orderpriority").alias("loser"),
        c("day").alias("match_date"),
        F.create_map(
            F.lit("o_totalprice"), F.lit("1.5"), F.lit("o_custkey"), F.lit("=o_orderkey")
        ).alias("assignments"),
    )
    named = {
        "tour": "tour", "year": "year", "event_id": "o_orderkey",
        "winner": "o_orderstatus", "loser": "o_orderpriority", "match_date": "day",
    }
    return orders, fixes, named


@query("""
SELECT o_orderkey,
       CASE WHEN o_totalprice > 480000 AND o_orderstatus <> 'F' THEN o_orderkey
            ELSE o_custkey END AS o_custkey,
       CASE WHEN o_totalprice > 480000 AND o_orderstatus <> 'F' THEN 1.5
            ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def fix_registry(spark, sf):
    orders, fixes, named = _orders_and_fixes(spark, sf)
    fixed = corrections.apply_corrections(orders, fixes, named)
    return fixed.select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
SELECT 'fix-' || o_orderkey AS fix_id, CAST(0 AS BIGINT) AS hits
FROM orders WHERE o_totalprice > 480000 AND o_orderstatus = 'F'
""")
def fix_hits(spark, sf):
    orders, fixes, named = _orders_and_fixes(spark, sf)
    return corrections.wrong_corrections(orders, fixes, named).select("fix_id", "hits")


@query("""
WITH t AS (
  SELECT o_orderkey, year(o_orderdate) || '-' ||
         CASE WHEN o_orderkey % 4 = 0 THEN 'M0' || o_orderkey ELSE lpad(CAST(o_orderkey AS VARCHAR), 6, '0')
         END AS id
  FROM orders)
SELECT o_orderkey, CAST(split_part(id, '-', 1) AS BIGINT) AS year, split_part(id, '-', 2) AS number,
       TRY_CAST(CASE WHEN regexp_full_match(split_part(id, '-', 2), '[0-9]+')
                THEN split_part(id, '-', 2) END AS BIGINT) AS permanent_id
FROM t
""")
def split_id(spark, sf):
    number = F.when(c("o_orderkey") % 4 == 0, F.concat(F.lit("M0"), c("o_orderkey"))).otherwise(
        F.lpad(c("o_orderkey").cast("string"), 6, "0")
    )
    key = F.concat_ws("-", F.year("o_orderdate"), number)
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", key.alias("id"))
        .select(
            "o_orderkey",
            keys.id_prefix_year(c("id")).alias("year"),
            keys.id_suffix(c("id")).alias("number"),
            keys.permanent_id(c("id")).alias("permanent_id"),
        )
    )


@query("""
WITH a AS (SELECT 'customer' AS kind, c_custkey AS id, c_nationkey AS nation FROM customer
           UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier)
SELECT kind, id, CAST(n_regionkey AS BIGINT) AS official_tournament_id
FROM a LEFT JOIN nation ON nation = n_nationkey AND n_nationkey <> 7
""")
def bridge_lookup(spark, sf):
    nation = table(spark, sf, "nation").where("n_nationkey <> 7")
    bridge = None
    parts = []
    for kind, prefix, id_column in (("customer", "c", "c_custkey"), ("supplier", "s", "s_suppkey")):
        rows = nation.select(
            c("n_regionkey").cast("bigint").alias("official_tournament_id"),
            F.lit(2024).alias("year"),
            F.lit(kind).alias("source"),
            F.concat(F.lit(prefix), c("n_nationkey")).alias("source_tournament_id"),
        )
        bridge = rows if bridge is None else bridge.unionByName(rows)
        own = table(spark, sf, kind).select(
            F.lit(kind).alias("kind"),
            c(id_column).alias("id"),
            F.lit(2024).alias("year"),
            F.concat(F.lit(prefix), c(f"{prefix}_nationkey")).alias("key"),
        )
        parts.append((kind, own))
    out = [
        joins.attach_official_ids(own, bridge, source=kind, id_column="key") for kind, own in parts
    ]
    return out[0].unionByName(out[1]).select("kind", "id", "official_tournament_id")


@query("""
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
                  AND year(o_orderdate) < 1997)
""")
def residual_anti(spark, sf):
    taken = table(spark, sf, "orders").where(
        (c("o_orderstatus") == "F") & (F.year("o_orderdate") < 1997)
    )
    rest = joins.residual(
        table(spark, sf, "customer"), taken.select(c("o_custkey").alias("c_custkey")), "c_custkey"
    )
    return rest.select("c_custkey", "c_name")


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey
FROM lineitem WHERE (l_orderkey, l_linenumber) IN
  (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
""")
def offender_semi(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", c("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey"
    )
    twice = lines.groupBy("l_orderkey", "l_linenumber").count().where("count > 1")
    return joins.rows_of(lines, twice, ["l_orderkey", "l_linenumber"])


@query("""
WITH best AS (SELECT s_nationkey, max(s_acctbal) AS b FROM supplier GROUP BY 1)
SELECT c_custkey, coalesce(CASE WHEN c_acctbal >= 1000 THEN c_acctbal END, b) AS filled,
       coalesce(b, c_acctbal) AS overridden
FROM customer LEFT JOIN best ON c_nationkey = s_nationkey
""")
def fill_or_override(spark, sf):
    best = (
        table(spark, sf, "supplier")
        .groupBy(c("s_nationkey").alias("c_nationkey"))
        .agg(F.max("s_acctbal").alias("b"))
    )
    df = table(spark, sf, "customer").withColumns(
        {"filled": F.when(c("c_acctbal") >= 1000, c("c_acctbal")), "overridden": c("c_acctbal")}
    )
    df = joins.fill_or_override(df, best.withColumnRenamed("b", "filled"), "c_nationkey", "filled")
    df = joins.fill_or_override(
        df, best.withColumnRenamed("b", "overridden"), "c_nationkey", "overridden", override=True
    )
    return df.select("c_custkey", "filled", "overridden")


@query("""
SELECT o.o_orderkey, o.o_totalprice AS price, l.l_quantity AS quantity, l.l_returnflag AS flag
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def preferred_side(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", c("o_totalprice").alias("price"), c("o_orderstatus").alias("flag")
    )
    lines = table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("o_orderkey"),
        c("l_extendedprice").alias("price"),
        c("l_quantity").alias("quantity"),
        c("l_returnflag").alias("flag"),
    )
    sides = {"o_orderkey": "left", "price": "left", "quantity": "right", "flag": "right"}
    return joins.preferred_side(orders, lines, "o_orderkey", sides)


@query("""
SELECT a.event_id AS signup_id, b.event_id AS purchase_id, a.user_id
FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'signup'
 AND b.event_type = 'purchase' AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 2 HOUR
""")
def interval_join(spark, sf):
    events = table(spark, sf, "events").withColumn("t", F.unix_micros(c("ts").cast("timestamp")))
    signup = events.where("event_type = 'signup'").select(
        c("event_id").alias("signup_id"), "user_id", c("t").alias("t0")
    )
    purchase = events.where("event_type = 'purchase'").select(
        c("event_id").alias("purchase_id"), "user_id", c("t").alias("t1")
    )
    pairs = joins.interval_join(
        signup, purchase, ["user_id"], c("t0"), c("t1"), 0, 2 * 3600 * 1_000_000
    )
    return pairs.select("signup_id", "purchase_id", "user_id")


@query("""
WITH y AS (SELECT l_partkey, year(l_shipdate) AS y, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, CAST(a.n AS BIGINT) AS lines_1997,
       CAST(b.n AS BIGINT) AS lines_1998
FROM (SELECT * FROM y WHERE y = 1997) a FULL JOIN (SELECT * FROM y WHERE y = 1998) b
  ON a.l_partkey = b.l_partkey
""")
def full_outer(spark, sf):
    lines = table(spark, sf, "lineitem")

    def of(year):
        mine = lines.where(F.year("l_shipdate") == year)
        return mine.groupBy("l_partkey").agg(F.count("*").alias(f"lines_{year}"))

    return of(1997).join(of(1998), "l_partkey", "full_outer")


@query("""
WITH d AS (SELECT custkey, day, o_orderkey FROM (
  SELECT o_custkey AS custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
  FROM orders) WHERE r = 1)
SELECT custkey, day, o_orderkey FROM d
""")
def dedupe_keep(spark, sf):
    orders = table(spark, sf, "orders").select(
        c("o_custkey").alias("custkey"), c("o_orderdate").cast("date").alias("day"), "o_orderkey"
    )
    return ordering.dedupe(orders, ["custkey"], [c("day"), c("o_orderkey")], "last")


@query("""
WITH p AS (SELECT DISTINCT o_custkey || '-' || month(o_orderdate) AS a,
                  CAST(floor(o_totalprice / 20) AS BIGINT) AS b FROM orders)
SELECT a, b FROM p WHERE a IN (SELECT a FROM p GROUP BY a HAVING count(*) = 1)
  AND b IN (SELECT b FROM p GROUP BY b HAVING count(*) = 1)
""")
def unique_both(spark, sf):
    pairs = table(spark, sf, "orders").select(
        F.concat_ws("-", "o_custkey", F.month("o_orderdate")).alias("a"),
        F.floor(c("o_totalprice") / 20).alias("b"),
    )
    return profile.unique_both(pairs.distinct(), "a", "b")


@query("""
SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 100
""")
def largest_first(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return ordering.top_k(events, [F.desc("value"), c("event_id")], 100)


@query("""
SELECT event_id, event_type, ts FROM events ORDER BY ts, event_type, event_id
""")
def chronological(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return ordering.chronological(events, ["ts", "event_type", "no_such_column", "event_id"])


@query("""
SELECT event_id, value FROM events WHERE value < 1.0 ORDER BY value, event_id
""")
def weakest_first(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return ordering.weakest_first(events, "value", 1.0, ["event_id"])


@query("""
SELECT doc_id, lang, source FROM documents ORDER BY md5(doc_id || '|42'), doc_id LIMIT 50
""")
def seeded_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return ordering.seeded_sample(docs, ["doc_id"], 50, 42)


@query("""
WITH a AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'),
     b AS (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'O')
SELECT 'all' AS op, k, CAST(count(*) AS BIGINT) AS n FROM (SELECT k FROM a UNION ALL SELECT k FROM b) GROUP BY k
UNION ALL SELECT 'minus', k, 1 FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
UNION ALL SELECT 'both', k, 1 FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
""")
def set_ops(spark, sf):
    orders = table(spark, sf, "orders")

    def of(status):
        return orders.where(c("o_orderstatus") == status).select(c("o_custkey").alias("k"))

    a, b = of("F"), of("O")
    one = F.lit(1).cast("bigint").alias("n")
    every = a.unionByName(b).groupBy("k").agg(F.count("*").alias("n"))
    return (
        every.select(F.lit("all").alias("op"), "k", "n")
        .unionByName(a.subtract(b).select(F.lit("minus").alias("op"), "k", one))
        .unionByName(a.intersect(b).select(F.lit("both").alias("op"), "k", one))
    )


@query("""
WITH s AS (SELECT p_partkey,
  trim(regexp_replace(lower(trim(p_brand)), '[^a-z0-9]+', '_', 'g'), '_') AS b,
  trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '_') AS n,
  CASE WHEN p_size > 40 THEN NULL ELSE p_type END AS t FROM part)
SELECT p_partkey, '2024_' || p_partkey || '_' || b || '_' || n AS event_key, b || '_' || n AS place_key,
  '2024_' || p_partkey || '_' || b || '_' || n || '_2024-01-15_' || t || '_' || n || '_' || b AS match_key
FROM s
""")
def slug_keys(spark, sf):
    event = keys.event_key(F.lit(2024), c("p_partkey"), c("p_brand"), c("p_name"))
    stage = F.when(c("p_size") <= 40, c("p_type"))
    day = F.to_date(F.lit("2024-01-15"))
    return table(spark, sf, "part").select(
        "p_partkey",
        event.alias("event_key"),
        keys.place_title_key(c("p_brand"), c("p_name")).alias("place_key"),
        keys.match_key(event, day, stage, c("p_name"), c("p_brand")).alias("match_key"),
    )


@query(r"""
WITH f AS (
  SELECT doc_id,
    lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')) AS title,
    lower(regexp_replace(strip_accents(replace(replace(replace(text, 'ß', 'ss'), 'Æ', 'Ae'), 'æ', 'ae')),
          '[^\x00-\x7F]', '', 'g')) AS name
  FROM documents)
SELECT doc_id, md5(trim(regexp_replace(title, '[^a-z0-9]+', ' ', 'g'))) AS title,
       md5(trim(regexp_replace(regexp_replace(name, '[^a-z0-9 -]', ' ', 'g'), ' +', ' ', 'g'))) AS name
FROM f
""")
def name_fold(spark, sf):
    """Whole texts in four languages through both normalisations."""
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(text.normalize_title(c("text"))).alias("title"),
        F.md5(text.normalize_name(c("text"))).alias("name"),
    )


def _abbreviated():
    """'small ring' as 'Ring S.'."""
    words = F.split("p_name", " ")
    letter = F.upper(F.substring(words[0], 1, 1))
    return F.concat(F.initcap(words[1]), F.lit(" "), letter, F.lit("."))


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_partkey, p_name,
                  split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b
           FROM lineitem JOIN part ON p_partkey = l_suppkey),
q AS (SELECT p_partkey AS k, p_name AS full_name, split_part(p_name, ' ', 1) AS a,
             split_part(p_name, ' ', 2) AS b FROM part)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       p.b = q.b AND left(p.a, 1) = left(q.a, 1) AS compatible
FROM p JOIN q ON l_partkey = k
""")
def name_compatible(spark, sf):
    """Is the abbreviated name of one part compatible with the full name of another?"""
    part = table(spark, sf, "part")
    short = part.select(c("p_partkey").alias("l_suppkey"), _abbreviated().alias("short_name"))
    full = part.select(c("p_partkey").alias("l_partkey"), c("p_name").alias("full_name"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", c("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey"
    )
    joined = lines.join(short, "l_suppkey").join(full, "l_partkey")
    # There are few different name pairs, so each is compared once.
    distinct = joined.select("short_name", "full_name").distinct()
    judged = distinct.withColumn(
        "compatible", names.names_compatible(c("short_name"), c("full_name"))
    )
    return joined.join(judged, ["short_name", "full_name"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "compatible"
    )


@query("""
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_quantity AS BIGINT) AS q, l_returnflag AS f, l_linestatus AS s, year(l_shipdate) + 25 AS y,
    l_partkey % 3 AS third
  FROM lineitem),
u AS (
  SELECT *, CASE WHEN f = 'R' THEN 2 WHEN third = 0 THEN 3 ELSE 2 END AS n,
    CASE WHEN f = 'R' THEN 'retired' WHEN f = 'A' AND third = 1 THEN 'defaulted' ELSE 'completed' END AS st
  FROM t)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  st AS match_status, CAST(n AS BIGINT) AS sets_played,
  CAST(6 AS BIGINT) AS set1_winner, CAST(q % 5 AS BIGINT) AS set1_loser,
  CAST(7 AS BIGINT) AS set2_winner, CAST(6 AS BIGINT) AS set2_loser,
  CAST(greatest(CASE WHEN FALSE THEN 10 ELSE 7 END, q % 11 + 2) AS BIGINT) AS set2_tiebreak_winner,
  CAST(q % 11 AS BIGINT) AS set2_tiebreak_loser,
  CAST(CASE WHEN n = 3 THEN 7 END AS BIGINT) AS set3_winner,
  CAST(CASE WHEN n = 3 THEN greatest(CASE WHEN s = 'O' AND y >= 2022 THEN 10 ELSE 7 END, q % 9 + 2) END AS BIGINT)
    AS set3_tiebreak_winner
FROM u
""")
def score_features(spark, sf):
    """Score text made from every line, then parsed."""
    q = c("l_quantity").cast("bigint")
    third = c("l_partkey") % 3
    head = F.concat(F.lit("6-"), (q % 5).cast("string"), F.lit(" 7-6("), (q % 11).cast("string"))
    tail = (
        F.when(c("l_returnflag") == "R", ") RET 6-0")
        .when(third == 0, F.concat(F.lit(") 7-6("), (q % 9).cast("string"), F.lit(")")))
        .when((c("l_returnflag") == "A") & (third == 1), ") W/O DEF")
        .otherwise(")")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", c("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey",
        F.concat(head, tail).alias("score"),
        F.lit(3).alias("best_of"),
        F.when(c("l_linestatus") == "O", "G").otherwise("A").alias("tourney_level"),
        F.add_months(c("l_shipdate").cast("date"), 300).alias("tourney_date"),
    )
    return scores.with_score_features(lines).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "match_status", "sets_played",
        "set1_winner", "set1_loser", "set2_winner", "set2_loser",
        "set2_tiebreak_winner", "set2_tiebreak_loser", "set3_winner", "set3_tiebreak_winner",
    )


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_discount >= 0.05 THEN l_discount END AS a, CASE WHEN l_tax >= 0.04 THEN l_tax END AS b,
  CASE WHEN l_quantity >= 25 THEN l_quantity END AS c FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  round(coalesce(a, CASE WHEN b IS NOT NULL AND c IS NOT NULL THEN (b + c) / 2 ELSE coalesce(b, c) END, -1.0), 6)
    AS filled
FROM t
""")
def row_mean_fallback(spark, sf):
    a = F.when(c("l_discount") >= 0.05, c("l_discount"))
    b = F.when(c("l_tax") >= 0.04, c("l_tax"))
    q = F.when(c("l_quantity") >= 25, c("l_quantity"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", c("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey",
        F.round(numbers.fill_from_mean(a, [b, q], F.lit(-1.0)), 6).alias("filled"),
    )


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag = 'A' AS f,
  CAST(l_quantity AS BIGINT) % 8 AS a, l_linenumber % 7 AS b, CAST(l_quantity AS BIGINT) % 3 AS c,
  l_partkey % 2 AS d FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  trim(CASE WHEN a = 0 AND b = 0 THEN '' WHEN f THEN a || '-' || b ELSE b || '-' || a END || ' ' ||
       CASE WHEN c = 0 AND d = 0 THEN '' WHEN f THEN c || '-' || d ELSE d || '-' || c END) AS score
FROM t
""")
def oriented_score(spark, sf):
    q = c("l_quantity").cast("bigint")
    sets = [(q % 8, c("l_linenumber") % 7), (q % 3, c("l_partkey") % 2)]
    return table(spark, sf, "lineitem").select(
        "l_orderkey", c("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey",
        scores.oriented_score(sets, c("l_returnflag") == "A").alias("score"),
    )


@query("""
SELECT o_orderkey, least(o_custkey, o_orderkey) AS low, greatest(o_custkey, o_orderkey) AS high
FROM orders
""")
def player_sides(spark, sf):
    """Sides alternate by a hash; whichever is first, the pair stays the same."""
    df = columns.player_sides(
        table(spark, sf, "orders"), c("o_orderkey"), {"player": ("o_custkey", "o_orderkey")}
    )
    return df.select(
        "o_orderkey",
        F.least("player_1", "player_2").alias("low"),
        F.greatest("player_1", "player_2").alias("high"),
    )


@query("""
WITH o AS (SELECT o_orderkey, o_totalprice,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS p, o_orderstatus AS s FROM orders)
SELECT o_orderkey, p AS priority FROM o
WHERE (p IS DISTINCT FROM '2-HIGH' AND s = 'F') OR (p LIKE '%URG%' AND s = 'O')
""")
def null_safe_filters(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(c("o_orderkey") % 5 != 0, c("o_orderpriority")).alias("priority"),
        c("o_orderstatus").alias("status"),
    )
    kept = df.where(columns.not_equal(c("priority"), "2-HIGH") & (c("status") == "F"))
    review = df.where(c("priority").contains("URG") & (c("status") == "O"))
    return kept.unionByName(review).select("o_orderkey", "priority")


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0
""")
def complete_rows(spark, sf):
    df = table(spark, sf, "orders").withColumns(
        {
            "o_orderpriority": F.when(c("o_orderkey") % 5 != 0, c("o_orderpriority")),
            "o_totalprice": F.when(c("o_orderkey") % 7 != 0, c("o_totalprice")),
        }
    )
    rows = columns.complete_rows(df, ["o_orderpriority", "o_totalprice"], "o_orderstatus", "F")
    return rows.select("o_orderkey", "o_totalprice")


@query("""
WITH x AS (SELECT l_orderkey || '-' || l_linenumber AS k, count(*) AS n
           FROM lineitem GROUP BY 1)
SELECT CASE WHEN n > 1 THEN k || '-' || l_partkey ELSE k END AS line_key, l_partkey, l_suppkey, l_quantity
FROM lineitem JOIN x ON k = l_orderkey || '-' || l_linenumber
""")
def collision_key(spark, sf):
    keyed = linking.add_canonical_key(
        table(spark, sf, "lineitem"),
        parts=("l_orderkey", "l_linenumber"),
        suffix="l_partkey",
        out="line_key",
    )
    return keyed.select(
        F.translate("line_key", "_", "-").alias("line_key"), "l_partkey", "l_suppkey", "l_quantity"
    )


@query("""
WITH p AS (SELECT 'x' AS tour, CAST(p_size AS BIGINT) AS year, p_brand AS id, p_name, p_retailprice,
  row_number() OVER (PARTITION BY p_size, p_brand ORDER BY p_name, p_retailprice, p_partkey) AS r FROM part)
SELECT tour, year, id, p_name AS title, p_retailprice AS prize FROM p WHERE r = 1
""")
def api_dedupe(spark, sf):
    df = table(spark, sf, "part").select(
        F.lit("x").alias("tour"),
        c("p_size").cast("bigint").alias("year"),
        c("p_brand").alias("id"),
        c("p_name").alias("title"),
        c("p_retailprice").alias("prize"),
        "p_partkey",
    )
    order = [c("title"), c("prize"), c("p_partkey")]
    kept = ordering.dedupe(df, ["tour", "year", "id"], order)
    return kept.drop("p_partkey").orderBy("tour", "year", "id")


@query("""
SELECT o_orderkey, round(greatest(0, 1 - abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) / 10.0), 6)
  AS closeness, CAST(l_linenumber AS BIGINT) AS line, l_partkey, l_suppkey
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def date_closeness(spark, sf):
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "lineitem"), c("o_orderkey") == c("l_orderkey")
    )
    score = dates.date_closeness(c("o_orderdate").cast("date"), c("l_shipdate").cast("date"))
    return joined.select(
        "o_orderkey", F.round(score, 6).alias("closeness"),
        c("l_linenumber").cast("bigint").alias("line"), "l_partkey", "l_suppkey",
    )


@query("""
WITH old AS (SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
     new AS (SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT CAST(p.n_nationkey AS BIGINT) AS nation, CAST(q.c AS BIGINT) AS customers
FROM nation p JOIN (SELECT c_nationkey, count(*) AS c FROM customer
  WHERE c_custkey IN (SELECT k FROM old) AND c_custkey NOT IN (SELECT k FROM new) GROUP BY 1) q
  ON p.n_nationkey = q.c_nationkey
""")
def only_in_old(spark, sf):
    """Keys of an old version that the new one lacks, counted per nation."""
    orders = table(spark, sf, "orders")
    old = orders.where("o_orderstatus = 'F'").select(c("o_custkey").alias("c_custkey"))
    new = orders.where("o_orderstatus = 'O'").select(c("o_custkey").alias("c_custkey"))
    gone = joins.missing_references(old, new, "c_custkey")
    return (
        joins.rows_of(table(spark, sf, "customer"), gone, ["c_custkey"])
        .groupBy(c("c_nationkey").cast("bigint").alias("nation"))
        .agg(F.count("*").alias("customers"))
    )
