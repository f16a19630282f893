"""Temporal operators over orders, line items and events."""

from pyspark.sql import functions as F

from pitframe.catalog.registry import case, table
from pitframe.operators import temporal as T

ORDERS_SQL = "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, o_orderstatus, o_orderpriority FROM orders"
STINTS_SQL = ("SELECT o_custkey, o_orderpriority, min(CAST(o_orderdate AS DATE)) AS valid_from, "
              "max(CAST(o_orderdate AS DATE)) AS valid_to FROM orders GROUP BY 1, 2")


def orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice", "o_orderstatus", "o_orderpriority")


def stints(spark, sf):
    return orders(spark, sf).groupBy("o_custkey", "o_orderpriority").agg(F.min("day").alias("valid_from"), F.max("day").alias("valid_to"))


def events(spark, sf, kind):
    e = table(spark, sf, "events").filter(F.col("event_type") == kind)
    return e.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")


def by_hour(c):
    return F.date_trunc("hour", c)


@case("asof_latest", f"""
    WITH o AS ({ORDERS_SQL})
    SELECT o_custkey, o_orderkey, day FROM o a WHERE day <= DATE '1998-01-01' AND NOT EXISTS (
      SELECT 1 FROM o b WHERE b.o_custkey = a.o_custkey AND b.day <= DATE '1998-01-01' AND b.day > a.day)""")
def asof_latest(spark, sf):
    return T.asof_latest(orders(spark, sf), ["o_custkey"], "day", "1998-01-01").select("o_custkey", "o_orderkey", "day")


@case("asof_latest_require", f"""
    WITH o AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS m1,
                 CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS m2 FROM ({ORDERS_SQL}))
    SELECT o_custkey, o_orderkey, m1, m2 FROM o a WHERE day <= DATE '1998-01-01' AND m1 IS NOT NULL AND m2 IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM o b WHERE b.o_custkey = a.o_custkey AND b.day <= DATE '1998-01-01' AND b.day > a.day AND b.m1 IS NOT NULL)
      AND NOT EXISTS (SELECT 1 FROM o b WHERE b.o_custkey = a.o_custkey AND b.day <= DATE '1998-01-01' AND b.day > a.day AND b.m2 IS NOT NULL)""")
def asof_latest_require(spark, sf):
    o = orders(spark, sf).withColumn("m1", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))).withColumn(
        "m2", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")))
    return T.asof_latest(o, ["o_custkey"], "day", "1998-01-01", ["m1", "m2"]).select("o_custkey", "o_orderkey", "m1", "m2")


@case("asof_join", """
    WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
         p AS (SELECT event_id AS fact_id, user_id, ts AS fact_ts FROM events WHERE event_type = 'purchase')
    SELECT e.event_id, e.user_id, p.fact_id FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.fact_ts""")
def asof_join(spark, sf):
    facts = events(spark, sf, "purchase").select(F.col("event_id").alias("fact_id"), "user_id", F.col("ts").alias("fact_ts"))
    return T.asof_join(events(spark, sf, "error"), facts, ["user_id"], "ts", "fact_ts", bucket=by_hour).select("event_id", "user_id", "fact_id")


@case("asof_join_ties", f"""
    WITH o AS ({ORDERS_SQL}), e AS (SELECT l_orderkey, l_linenumber, l_suppkey, c.o_custkey, CAST(l_shipdate AS DATE) AS ship FROM lineitem JOIN o c ON c.o_orderkey = l_orderkey),
      f AS (SELECT o_custkey, o_orderkey AS fact_key, day AS fact_day, CASE WHEN o_orderstatus <> 'P' THEN 1 END AS m1, CASE WHEN o_orderkey % 3 <> 0 THEN 1 END AS m2 FROM o)
    SELECT e.l_orderkey, e.l_linenumber, e.l_suppkey, e.ship, x.fact_key FROM e LEFT JOIN LATERAL (
      SELECT fact_key FROM f WHERE f.o_custkey = e.o_custkey AND f.fact_day <= e.ship AND m1 IS NOT NULL AND m2 IS NOT NULL
        AND f.fact_day = (SELECT max(fact_day) FROM f g WHERE g.o_custkey = e.o_custkey AND g.fact_day <= e.ship AND g.m1 IS NOT NULL)
        AND f.fact_day = (SELECT max(fact_day) FROM f g WHERE g.o_custkey = e.o_custkey AND g.fact_day <= e.ship AND g.m2 IS NOT NULL)) x ON true""")
def asof_join_ties(spark, sf):
    o = orders(spark, sf)
    e = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("date").alias("ship"))
    e = e.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    f = o.select("o_custkey", F.col("o_orderkey").alias("fact_key"), F.col("day").alias("fact_day"),
                 F.when(F.col("o_orderstatus") != "P", 1).alias("m1"), F.when(F.col("o_orderkey") % 3 != 0, 1).alias("m2"))
    out = T.asof_join(e, f, ["o_custkey"], "ship", "fact_day", require=["m1", "m2"])
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "ship", "fact_key")


@case("with_previous", f"""
    WITH o AS ({ORDERS_SQL}) SELECT a.o_custkey, a.o_orderkey, a.day, b.o_orderkey AS previous_o_orderkey
    FROM o a LEFT JOIN o b ON b.o_custkey = a.o_custkey AND b.day = (
      SELECT max(day) FROM o c WHERE c.o_custkey = a.o_custkey AND c.day < a.day)""")
def with_previous(spark, sf):
    return T.with_previous(orders(spark, sf), ["o_custkey"], "day", ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "day", "previous_o_orderkey")


@case("later_events", """
    SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, CAST(a.l_shipdate AS DATE) AS ship, CAST(b.l_shipdate AS DATE) AS later_ship, b.l_linenumber AS later_line
    FROM lineitem a LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') b ON b.l_orderkey = a.l_orderkey AND b.l_shipdate > a.l_shipdate
    WHERE a.l_returnflag = 'A'""")
def later_events(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("ship"))
    a = l.filter("l_returnflag = 'A'").drop("l_returnflag")
    b = l.filter("l_returnflag = 'R'").select("l_orderkey", F.col("ship").alias("later_ship"), F.col("l_linenumber").alias("later_line"))
    return T.later_events(a, b, ["l_orderkey"], "ship", "later_ship")


@case("next_event", """
    SELECT event_id, user_id, (SELECT min(ts) FROM events e WHERE e.event_type = 'error' AND e.user_id = s.user_id AND e.ts > s.ts) AS next_ts
    FROM events s WHERE event_type = 'signup'""")
def next_event(spark, sf):
    out = T.next_event(events(spark, sf, "signup"), events(spark, sf, "error"), ["user_id"], "ts", "ts")
    return out.select("event_id", "user_id", F.col("next_ts").cast("timestamp_ntz").alias("next_ts"))


BANDS = [(p, f"{p[0]}-{y}", f"{y}-01-01", f"{y + 2}-01-01") for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED") for y in range(1991, 2003, 2)]


@case("asof_rule", """
    WITH b AS (SELECT p AS o_orderpriority, substr(p, 1, 1) || '-' || y AS rule_iri, make_date(y, 1, 1) AS f, make_date(y + 2, 1, 1) AS t
      FROM (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED']) AS p), (SELECT unnest(range(1991, 2003, 2)) AS y))
    SELECT o_orderkey, b.rule_iri, CASE WHEN b.rule_iri IS NULL THEN 0 ELSE 1 END AS rule_matches FROM orders o LEFT JOIN b
      ON b.o_orderpriority = o.o_orderpriority AND b.f <= CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) < b.t""")
def asof_rule(spark, sf):
    bands = spark.createDataFrame(BANDS, "o_orderpriority string, rule_iri string, f string, t string").select(
        "o_orderpriority", "rule_iri", F.col("f").cast("date").alias("valid_from"), F.col("t").cast("date").alias("valid_to"))
    return T.asof_rule(orders(spark, sf), "day", bands, ["o_orderpriority"]).select("o_orderkey", "rule_iri", "rule_matches")


@case("members_at", f"SELECT * FROM ({STINTS_SQL}) WHERE valid_from <= DATE '1998-01-01' AND valid_to >= DATE '1998-01-01'")
def members_at(spark, sf):
    return T.members_at(stints(spark, sf), "1998-01-01")


@case("members_per_quarter", f"""
    WITH s AS ({STINTS_SQL}), d AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS day FROM orders)
    SELECT d.day, s.o_orderpriority, count(*) AS members FROM d JOIN s ON s.valid_from <= d.day AND s.valid_to >= d.day GROUP BY 1, 2""")
def members_per_quarter(spark, sf):
    days = orders(spark, sf).select(F.trunc("day", "quarter").alias("day")).distinct()
    j = T.interval_join(days, stints(spark, sf), "day", "valid_from", "valid_to")
    return j.groupBy("day", "o_orderpriority").agg(F.count(F.lit(1)).alias("members"))


@case("symbol_at", """
    WITH h AS (SELECT o_custkey, o_orderpriority AS symbol, year(o_orderdate) AS snapshot, min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS t FROM orders GROUP BY 1, 2, 3)
    SELECT snapshot, o_custkey, symbol FROM h WHERE snapshot = (SELECT max(snapshot) FROM h) AND f <= make_date(snapshot, 6, 1) AND t >= make_date(snapshot, 3, 1)""")
def symbol_at(spark, sf):
    o = orders(spark, sf).withColumn("snapshot", F.year("day"))
    h = o.groupBy("o_custkey", F.col("o_orderpriority").alias("symbol"), "snapshot").agg(F.min("day").alias("f"), F.max("day").alias("t"))
    latest = h.filter(F.col("snapshot") == o.agg(F.max("snapshot")).scalar())
    open_by = F.make_date("snapshot", F.lit(6), F.lit(1))
    return latest.filter((F.col("f") <= open_by) & (F.col("t") >= F.make_date("snapshot", F.lit(3), F.lit(1)))).select("snapshot", "o_custkey", "symbol")


@case("overlaps", f"""
    WITH s AS ({STINTS_SQL}) SELECT o_custkey, o_orderpriority, valid_from FROM s a WHERE EXISTS (
      SELECT 1 FROM s b WHERE b.o_custkey = a.o_custkey AND b.valid_from < a.valid_from AND b.valid_to >= a.valid_from)""")
def overlaps(spark, sf):
    return T.overlaps(stints(spark, sf), ["o_custkey"], "valid_from", "valid_to").select("o_custkey", "o_orderpriority", "valid_from")


@case("overlap_join", f"""
    WITH s AS ({STINTS_SQL}), f AS (SELECT l.l_orderkey, o.o_custkey, min(CAST(o_orderdate AS DATE)) AS f, max(CAST(l_shipdate AS DATE)) AS t
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2)
    SELECT f.l_orderkey, f.o_custkey, s.o_orderpriority FROM f JOIN s ON s.o_custkey = f.o_custkey AND f.f <= s.valid_to AND s.valid_from <= f.t AND f.f <= f.t""")
def overlap_join(spark, sf):
    o = orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "day")
    l = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max(F.col("l_shipdate").cast("date")).alias("t"))
    fulfil = l.join(o, "l_orderkey").select("l_orderkey", "o_custkey", F.col("day").alias("f"), "t")
    return T.overlap_join(fulfil, stints(spark, sf), ["o_custkey"], "f", "t", "valid_from", "valid_to").select("l_orderkey", "o_custkey", "o_orderpriority")


@case("latest_per", """
    WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS nav FROM events GROUP BY 1, 2)
    SELECT user_id, day, nav FROM p a WHERE day <= DATE '2024-01-15' AND NOT EXISTS (SELECT 1 FROM p b WHERE b.user_id = a.user_id AND b.day <= DATE '2024-01-15' AND b.day > a.day)""")
def latest_per(spark, sf):
    p = table(spark, sf, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.max("value").alias("nav"))
    return T.latest_per(p, ["user_id"], "day", "day", "2024-01-15")


@case("active_at", """
    WITH r AS (SELECT o.o_orderkey, CAST(o_orderdate AS DATE) AS opened, (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_orderkey = o.o_orderkey) AS cleared FROM orders o)
    SELECT * FROM r WHERE opened <= DATE '1997-06-30' AND (cleared IS NULL OR cleared > DATE '1997-06-30')""")
def active_at(spark, sf):
    ships = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.col("l_shipdate").cast("date")).alias("cleared"))
    r = orders(spark, sf).select("o_orderkey", F.col("day").alias("opened")).join(ships, "o_orderkey", "left")
    return T.active_at(r, "1997-06-30", "opened", "cleared")


@case("keep_open_since", f"SELECT * FROM ({STINTS_SQL}) WHERE valid_to >= DATE '2000-01-01'")
def keep_open_since(spark, sf):
    return T.keep_open_since(stints(spark, sf), "2000-01-01")


@case("append_ok", """
    WITH s AS (SELECT user_id, max(CAST(ts AS DATE)) AS last_stored FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT e.event_id, e.user_id, s.last_stored, CASE WHEN last_stored IS NULL OR CAST(e.ts AS DATE) > last_stored THEN 'later' WHEN CAST(e.ts AS DATE) = last_stored THEN 'repeated' ELSE 'earlier' END AS verdict
    FROM events e LEFT JOIN s ON s.user_id = e.user_id WHERE e.event_type = 'click'""")
def append_ok(spark, sf):
    day = lambda k: events(spark, sf, k).withColumn("day", F.to_date("ts"))
    return T.append_ok(day("click"), day("view").select("user_id", "day"), ["user_id"], "day").select("event_id", "user_id", "last_stored", "verdict")


@case("known_at", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS as_of FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1996-03-31'")
def known_at(spark, sf):
    return T.known_at(orders(spark, sf).select("o_orderkey", F.col("day").alias("as_of")), "1996-03-31")
