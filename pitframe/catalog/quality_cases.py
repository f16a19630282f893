"""Boundary checks over line items, orders, labels and documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.catalog.registry import case, table
from pitframe.functions import scalars as S
from pitframe.operators import quality as Q
from pitframe.operators import visibility as V
from pitframe.sources.scans import contract_diff as diff_contracts
from pitframe.sources.scans import scan_news as news_scan
from pitframe.sources.scans import scan_stints as stint_scan
from pitframe.sources.scans import schema_version as version_of
from pitframe.sources.sinks import late_keys_after


def lines(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", F.col("l_shipdate").cast("date").alias("ship"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("opened"))
    return l.join(o, "l_orderkey", "left")


LINES = Q.Expectation(
    "lines", keys=(("l_orderkey", "l_linenumber"),), types={"l_quantity": "number", "l_returnflag": "integer"},
    ranges=(Q.Range("l_discount", 0.0, 0.08), Q.Range("l_quantity", 5.0, None, {"l_returnflag": ["A"]})),
    pairs=(Q.Pair("ship", ">", "opened"), Q.Pair("ship", "<", "opened", "skip", {"l_returnflag": ["R"]})),
    group_means=(Q.GroupMean("l_quantity", ("l_returnflag",), 26.0, 0.1),), row_count_min=10**9, cap=1.0)

LSQL = """l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag, CAST(l_shipdate AS DATE) AS ship, CAST(o_orderdate AS DATE) AS opened,
    count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)"""


@case("row_failures", f"""
    WITH {LSQL}, f AS (SELECT 'type' AS "check", 'l_returnflag' AS "column", * FROM l UNION ALL SELECT 'range', 'l_discount', * FROM l WHERE l_discount > 0.08 UNION ALL SELECT 'range', 'l_quantity', * FROM l WHERE l_returnflag = 'A' AND l_quantity < 5
      UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber', * FROM l WHERE n > 1 UNION ALL SELECT 'ordered_pair', 'ship', * FROM l WHERE NOT coalesce(ship > opened, false) UNION ALL SELECT 'ordered_pair', 'ship', * FROM l WHERE l_returnflag = 'R' AND NOT ship < opened)
    SELECT "check", "column", l_returnflag, count(*) AS "rows" FROM f GROUP BY 1, 2, 3""")
def row_failures(spark, sf):
    bad = Q.with_row_failures(lines(spark, sf), LINES).select("l_returnflag", F.inline("_failures"))
    return bad.groupBy("check", "column", "l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


@case("check_range", "SELECT l_orderkey, l_partkey, l_suppkey, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08")
def check_range(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.filter(Q.range_fails(l, Q.Range("l_discount", 0.02, 0.08))).select("l_orderkey", "l_partkey", "l_suppkey", "l_discount")


@case("check_pair", f"WITH {LSQL} SELECT CASE WHEN l_returnflag <> 'A' THEN 'ok' WHEN opened IS NULL THEN 'skip' WHEN ship > opened THEN 'ok' ELSE 'fail' END AS state, count(*) AS \"rows\" FROM l GROUP BY 1")
def check_pair(spark, sf):
    state = Q.pair_state(Q.Pair("ship", ">", "opened", "skip", {"l_returnflag": ["A"]}))
    return lines(spark, sf).groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("rows"))


@case("check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, sf):
    exp = Q.Expectation("lines", keys=(("l_orderkey", "l_linenumber"),))
    bad = Q.with_row_failures(lines(spark, sf), exp).filter(F.size("_failures") > 0)
    return bad.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies"))


@case("check_type", """
    SELECT event_id, NOT regexp_full_match(json_extract_string(props, '$.k'), '[+-]?[0-9]+') AS bad_int FROM events WHERE event_id % 3 = 0
    UNION ALL SELECT event_id, true FROM events WHERE event_id % 3 = 1""")
def check_type(spark, sf):
    e = table(spark, sf, "events")
    a = e.filter("event_id % 3 = 0").withColumn("v", F.get_json_object("props", "$.k"))
    b = e.filter("event_id % 3 = 1").withColumn("v", F.col("event_type"))
    u = a.unionByName(b)
    return u.select("event_id", Q.type_fails(u, "v", "integer").alias("bad_int"))


@case("check_format", """
    WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_id % 4 WHEN 0 THEN 'Z' WHEN 1 THEN '+00:00' WHEN 2 THEN '' ELSE '+02:00' END AS at_text FROM events)
    SELECT event_id, at_text, event_id % 4 >= 2 AS bad FROM e""")
def check_format(spark, sf):
    tail = F.when(F.col("event_id") % 4 == 0, "Z").when(F.col("event_id") % 4 == 1, "+00:00").when(F.col("event_id") % 4 == 2, "").otherwise("+02:00")
    e = table(spark, sf, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), tail).alias("at_text"))
    return e.withColumn("bad", Q.format_fails("at_text", "utc_timestamp"))


@case("check_flags", "SELECT event_id, event_id % 3 <> 0 AS bad FROM events")
def check_flags(spark, sf):
    names = Q.FORENSIC_FLAGS
    text = lambda last: "{" + ", ".join(f'"{n}": false' for n in names[:3]) + f", {last}" + "}"
    good, other, quoted = text(f'"{names[3]}": true'), text('"other_flag": true'), text(f'"{names[3]}": "true"')
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, good).when(F.col("event_id") % 3 == 1, other).otherwise(quoted).alias("flags"))
    return e.select("event_id", Q.format_fails("flags", "forensic_flags").alias("bad"))


@case("aggregate_failures", """
    WITH d AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT 'null_rate' AS "check", 'quality' AS "column", 'NULL on ' || (count(*) - count(quality)) || '/' || count(*) || ', expected at most 0.1' AS detail FROM d
    UNION ALL SELECT 'null_rate', 'doc_id', 'NULL on 0/' || count(*) || ', expected NULL on every row' FROM d
    UNION ALL SELECT 'row_count', NULL, count(*) || ' row(s), expected at least 1000000000' FROM d""")
def aggregate_failures(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    exp = Q.Expectation("labels", null_rates=(Q.NullRate("quality", 0.1), Q.NullRate("doc_id", None)), row_count_min=10**9)
    return Q.aggregate_failures(d, exp).select("check", "column", "detail")


@case("group_mean", "SELECT l_suppkey, count(*) AS \"rows\" FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1 HAVING abs(avg(CAST(l_quantity AS DECIMAL(18,2))) - 25.5) > 1.0")
def group_mean(spark, sf):
    return Q.group_mean_failures(table(spark, sf, "lineitem"), Q.GroupMean("l_quantity", ("l_suppkey",), 25.5, 1.0, {"l_returnflag": ["A"]})).select("l_suppkey", "rows")


def _marked(spark, sf) -> dict[str, DataFrame]:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    eo = Q.Expectation("orders", keys=(("o_orderkey",),), ranges=(Q.Range("o_totalprice", None, 480000.0),))
    el = Q.Expectation("lines", ranges=(Q.Range("l_discount", None, 0.09), Q.Range("l_quantity", None, 45.0)))
    return {"orders": Q.with_row_failures(o, eo), "lines": Q.with_row_failures(l, el)}


RULES = {"orders": (("lines", ("o_orderkey",)),), "lines": (("orders", ("o_orderkey",)),)}


@case("cascade", """
    WITH bo AS (SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 480000), bl AS (SELECT l_orderkey AS k FROM lineitem WHERE l_discount > 0.09 OR l_quantity > 45),
      hit AS (SELECT k FROM bo UNION SELECT k FROM bl WHERE k IN (SELECT o_orderkey FROM orders))
    SELECT 'orders' AS "view", o_totalprice <= 480000 AS cascaded, count(*) AS "rows" FROM orders WHERE o_orderkey IN (SELECT k FROM hit) GROUP BY 1, 2
    UNION ALL SELECT 'lines', NOT (l_discount > 0.09 OR l_quantity > 45), count(*) FROM lineitem WHERE l_orderkey IN (SELECT k FROM hit) OR l_discount > 0.09 OR l_quantity > 45 GROUP BY 1, 2""")
def cascade(spark, sf):
    m = _marked(spark, sf)
    out = Q.cascade(m, RULES, {"orders": F.col("o_orderkey").cast("string"), "lines": F.concat_ws("/", F.col("o_orderkey").cast("string"), F.col("l_linenumber").cast("string"))})
    part = lambda v: out[v].groupBy(F.col("cascaded_from").isNotNull().alias("cascaded")).agg(F.count(F.lit(1)).alias("rows")).withColumn("view", F.lit(v))
    return part("orders").unionByName(part("lines"))


@case("boundary", """
    WITH l AS (SELECT l_orderkey, l_linenumber, l_discount, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem), bad AS (SELECT DISTINCT l_orderkey FROM l WHERE n > 1 OR l_discount > 0.09 UNION SELECT o_orderkey FROM orders WHERE o_totalprice > 480000)
    SELECT 'v_lines' AS "view", count(*) AS survivors FROM l WHERE l_orderkey NOT IN (SELECT * FROM bad) UNION ALL SELECT 'v_orders', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT * FROM bad)""")
def boundary(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_discount")
    exps = {"v_orders": Q.Expectation("v_orders", keys=(("k",),), ranges=(Q.Range("o_totalprice", None, 480000.0),), null_rates=(Q.NullRate("k", 0.0),), cap=1.0),
            "v_lines": Q.Expectation("v_lines", keys=(("k", "l_linenumber"),), ranges=(Q.Range("l_discount", None, 0.09),), row_count_min=1, cap=1.0)}
    out = Q.validate({"v_orders": o, "v_lines": l}, exps, {"v_orders": (("v_lines", ("k",)),), "v_lines": (("v_orders", ("k",)),)})
    n = lambda v: out.survivors[v].agg(F.count(F.lit(1)).alias("survivors")).withColumn("view", F.lit(v))
    return n("v_orders").unionByName(n("v_lines"))


@case("check_source", """
    SELECT 'schema_version' AS "check", max(o_orderkey) || ' is below 1000000000' AS detail FROM orders UNION ALL SELECT 'forbidden_kind', count(*) || ' run(s) of type 5-LOW' FROM orders WHERE o_orderpriority = '5-LOW'
    UNION ALL SELECT 'run_status', count(*) || ' run(s) are ' || o_orderstatus FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus""")
def check_source(spark, sf):
    o = table(spark, sf, "orders")
    return Q.check_source(version_of(o.select(F.col("o_orderkey").alias("version"))), 10**9, o, "o_orderpriority", ["5-LOW", "9-NONE"], "o_orderstatus", "F")


@case("classify_quarantine", "SELECT event_type, CASE WHEN event_type IN ('error', 'view') THEN 'late' ELSE 'lost' END AS fate, count(*) AS \"rows\" FROM events WHERE value > 20 GROUP BY 1, 2")
def classify_quarantine(spark, sf):
    late = Q.is_late("events", True, True, {"events": {"event_type": ["error", "view"]}})
    e = table(spark, sf, "events").filter("value > 20").withColumn("fate", F.when(late, "late").otherwise("lost"))
    return e.groupBy("event_type", "fate").agg(F.count(F.lit(1)).alias("rows"))


@case("late_keys", """
    WITH s AS (SELECT event_type AS "view", event_id AS key FROM events WHERE event_id % 4 = 0 AND event_type <> 'view' UNION SELECT event_type, event_id FROM events WHERE event_id % 6 = 0)
    SELECT "view", CAST(key AS VARCHAR) AS key FROM s WHERE key % 5 <> 0""")
def late_keys(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("view"), F.when(F.col("event_type") == "view", "old").otherwise("id").alias("columns"), F.col("event_id").cast("string").alias("key"), "event_id")
    state = e.filter("event_id % 4 = 0").drop("event_id")
    late = e.filter("event_id % 6 = 0").drop("event_id").withColumn("columns", F.lit("id"))
    layouts = e.select("view").distinct().withColumn("columns", F.lit("id"))
    return late_keys_after(state, late, e.filter("event_id % 5 = 0").select("view", "key"), layouts)[0].select("view", "key")


@case("visibility", """
    WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_returnflag WHEN 'A' THEN 'FUNDAMENTAL' WHEN 'R' THEN 'TECHNICAL' ELSE 'SECTOR' END AS lane, CASE WHEN l_partkey % 50 = 0 THEN 'bad ticker' ELSE 'T' || (l_partkey % 1000) END AS ticker,
        CASE WHEN l_quantity > 3 THEN CAST(l_shipdate AS DATE) END AS av, CASE WHEN l_linenumber > 1 THEN l_quantity END AS v FROM lineitem),
      r AS (SELECT year(o_orderdate) AS y, max(year(o_orderdate) * 4 + quarter(o_orderdate)) AS q FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 10000 AND CAST(o_orderdate AS DATE) <= DATE '1998-06-15' GROUP BY 1),
      c AS (SELECT *, year(av) * 4 + quarter(av) AS q FROM p),
      z AS (SELECT lane, CASE WHEN ticker = 'bad ticker' THEN 'bad ticker' WHEN substr(ticker, 2) IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier) THEN NULL ELSE 'not an asset' END AS r0, av, v, c.q, r.q AS rq FROM c LEFT JOIN r ON r.y = year(av)),
      w AS (SELECT lane, CASE WHEN r0 IS NOT NULL THEN r0 WHEN av IS NULL THEN 'no availability' WHEN v IS NULL THEN 'no value' WHEN av > DATE '1998-06-15' THEN 'not available yet'
        WHEN lane = 'FUNDAMENTAL' AND q >= 1998 * 4 + 2 THEN 'quarter open' WHEN lane = 'FUNDAMENTAL' AND (rq IS NULL OR rq <= q) THEN 'quarter not covered' END AS reason FROM z)
    SELECT lane AS score_type, reason, CASE WHEN reason IS NULL THEN 'project' WHEN reason IN ('not available yet', 'quarter open', 'quarter not covered') THEN 'defer' ELSE 'skip' END AS outcome, count(*) AS "rows" FROM w GROUP BY 1, 2, 3""")
def visibility(spark, sf):
    l, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    v = F.when(F.col("l_linenumber") > 1, F.col("l_quantity"))
    s = l.select(F.when(F.col("l_returnflag") == "A", "FUNDAMENTAL").when(F.col("l_returnflag") == "R", "TECHNICAL").otherwise("SECTOR").alias("score_type"),
                 F.when(F.col("l_partkey") % 50 == 0, "bad ticker").otherwise(F.concat(F.lit("T"), (F.col("l_partkey") % 1000).cast("string"))).alias("ticker"),
                 F.when(F.col("l_quantity") > 3, F.col("l_shipdate").cast("date")).alias("available_at"), v.alias("raw_value"), v.alias("normalized_score"))
    assets = table(spark, sf, "supplier").select(F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("ticker"))
    year = F.year("o_orderdate").cast("string")
    runs = o.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").cast("date").alias("as_of"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"),
                    F.when(F.col("o_totalprice") > 10000, 5).otherwise(0).alias("completed_units"),
                    F.concat(F.lit('{"tickers": null, "limit": null, "forms": ["10-K", "10-Q"], "since_year": '), year, F.lit(', "until_year": '), year, F.lit("}")).alias("params_json"))
    out = V.classify_visibility(s, assets, runs, "1998-06-15")
    return out.groupBy("score_type", "outcome", "reason").agg(F.count(F.lit(1)).alias("rows"))


@case("scan_stints", """
    WITH s AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 20 = 0 THEN c_mktsegment WHEN c_custkey % 20 = 1 THEN ' T' || c_custkey || ' | ' ELSE 'T' || c_custkey END AS symbol, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'K' || c_nationkey END AS cik,
        min(CAST(o_orderdate AS DATE)) AS valid_from, CASE WHEN c_custkey % 3 = 0 THEN min(CAST(o_orderdate AS DATE)) - 1 WHEN c_custkey % 3 = 1 THEN min(CAST(o_orderdate AS DATE)) END AS valid_to FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment, c_nationkey)
    SELECT c_custkey, symbol, cik, CASE WHEN length(symbol) > 6 THEN 'not a ticker' WHEN valid_to < valid_from THEN 'ends before it starts' END AS reason FROM (
      SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN c_mktsegment ELSE 'T' || c_custkey END AS symbol, CASE WHEN c_custkey % 4 <> 0 THEN cik END AS cik, valid_from, valid_to FROM s) t""")
def scan_stints(spark, sf):
    first = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.col("o_orderdate").cast("date")).alias("valid_from"))
    k = F.col("c_custkey")
    t = F.concat(F.lit("T"), k.cast("string"))
    c = table(spark, sf, "customer").join(first, "c_custkey").select(
        k, F.when(k % 20 == 0, F.col("c_mktsegment")).when(k % 20 == 1, F.concat(F.lit(" "), t, F.lit(" | "))).otherwise(t).alias("symbol"),
        F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("K"), F.col("c_nationkey").cast("string"))).alias("cik"), "valid_from",
        F.when(k % 3 == 0, F.date_sub("valid_from", 1)).when(k % 3 == 1, F.col("valid_from")).alias("valid_to"))
    good, bad = stint_scan(c)
    cols = ["c_custkey", "symbol", "cik"]
    return good.select(*cols, F.lit(None).cast("string").alias("reason")).unionByName(bad.select(*cols, "reason"))


@case("schema_version", "SELECT coalesce(max(o_orderkey), 0) AS version FROM orders")
def schema_version(spark, sf):
    return version_of(table(spark, sf, "orders").select(F.col("o_orderkey").alias("version")))


@case("contract_diff", """
    WITH a AS (SELECT DISTINCT lang AS "view" FROM documents) SELECT "view", 'drift' AS severity, 'removed: zz' AS detail FROM a WHERE "view" = 'en' UNION ALL SELECT "view", 'note', 'added: c0' FROM a WHERE "view" = 'en'
    UNION ALL SELECT "view", 'note', 'column order changed' FROM a WHERE "view" = 'fr' UNION ALL SELECT "view", 'drift', 'neither pinned nor listed' FROM a WHERE "view" = 'es' UNION ALL SELECT 'ghost', 'drift', 'no longer defined'""")
def contract_diff(spark, sf):
    a = table(spark, sf, "documents").groupBy(F.col("lang").alias("view")).agg(F.array_sort(F.collect_set(F.concat(F.lit("c"), (F.col("doc_id") % 3).cast("string")))).alias("columns"))
    pinned = {"de": ["c0", "c1", "c2"], "en": ["c1", "c2", "zz"], "fr": ["c2", "c1", "c0"], "ghost": ["x"]}
    return diff_contracts(a, pinned, ())


@case("scan_news", "SELECT d.doc_id AS id, d.lang, l.quality, p.url FROM documents d JOIN labels l ON l.doc_id = d.doc_id JOIN pages p ON p.page_id = d.doc_id WHERE d.n_chars > 500")
def scan_news(spark, sf):
    a = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", F.when(F.col("n_chars") > 500, "ok").otherwise("failed").alias("fetch_status"))
    return news_scan(a, table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality"), table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url"))


@case("scalar_functions", """
    SELECT c_custkey, greatest(-1.0, least(1.0, c_acctbal / 5000)) AS clamped, CAST((100 - CAST(c_custkey % 101 AS DECIMAL(20,10))) / 100 AS DECIMAL(22,12)) AS risk, year(d) || '-Q' || quarter(d) AS qtr, strftime(d, '%Y%m%d') AS day_key,
      CASE WHEN c_custkey % 3 = 0 THEN 'cash' WHEN c_custkey % 5 = 0 THEN 'SPY' WHEN c_custkey % 7 = 0 THEN 'no destination' ELSE c_name END AS dest, regexp_extract(c_name, '[^#]*$') AS local_name, 'articles:' || c_custkey AS prov,
      CASE WHEN c_acctbal < 0 THEN 'low ROIC; ' ELSE '' END || CASE WHEN c_acctbal > 5000 THEN 'high debt; ' ELSE '' END || CASE WHEN coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 100 END, 100) < 40 THEN 'low assessment' ELSE '' END AS reason
    FROM (SELECT *, DATE '1995-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS d FROM customer)""")
def scalar_functions(spark, sf):
    k, b = F.col("c_custkey"), F.col("c_acctbal")
    d = F.date_add(F.lit("1995-01-01").cast("date"), (k % 3000).cast("int"))
    score = F.when(k % 4 != 0, k % 100)
    return table(spark, sf, "customer").select(
        k, S.clamp(b / 5000, -1.0, 1.0).alias("clamped"), S.strength_to_risk(k % 101).alias("risk"), S.quarter_label(d).alias("qtr"), S.day_key(d).alias("day_key"),
        S.destination(k % 3 == 0, k % 5 == 0, F.when(k % 7 != 0, F.col("c_name"))).alias("dest"), S.local_name(F.col("c_name")).alias("local_name"), S.provenance("articles", k).alias("prov"),
        S.weak_reasons(b, b, score, 0, 5000, 40).alias("reason"))


@case("published_dates", """
    WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN CAST(DATE '2020-01-31' + CAST(doc_id % 400 AS INTEGER) AS VARCHAR) || CASE WHEN doc_id % 2 = 0 THEN 'T10:00:00Z' ELSE '' END WHEN doc_id % 6 = 0 THEN 'unknown' END AS p, CAST(DATE '2020-02-10' + CAST(doc_id % 100 AS INTEGER) AS VARCHAR) AS f FROM documents)
    SELECT doc_id, coalesce(CASE WHEN doc_id % 3 <> 0 THEN CAST(substr(p, 1, 10) AS DATE) END, CAST(f AS DATE)) AS published, greatest(coalesce(CASE WHEN doc_id % 3 <> 0 THEN CAST(substr(p, 1, 10) AS DATE) END, CAST(f AS DATE)), DATE '2020-06-01') AS available FROM d""")
def published_dates(spark, sf):
    k = F.col("doc_id")
    day = lambda base, n: F.date_add(F.lit(base).cast("date"), (k % n).cast("int")).cast("string")
    p = F.when(k % 3 != 0, F.concat(day("2020-01-31", 400), F.when(k % 2 == 0, "T10:00:00Z").otherwise(""))).when(k % 6 == 0, "unknown")
    pub = S.published_date(p, day("2020-02-10", 100))
    return table(spark, sf, "documents").select(k, pub.alias("published"), S.available_at(pub, F.lit("2020-06-01").cast("date")).alias("available"))


@case("forbidden_keys", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'close' WHEN event_id % 3 = 1 THEN 'price' END AS bad FROM events WHERE event_id % 3 < 2")
def forbidden_keys(spark, sf):
    k = F.col("event_id")
    body = F.when(k % 3 == 0, '{"close": 1, "k": 2}').when(k % 3 == 1, '{"k": 1, "chosen": {"price": 3}}').otherwise('{"k": 1, "chosen": {"rank": 3}}')
    e = table(spark, sf, "events").select(k, S.forbidden_json_keys(body, ["close", "price"], ["chosen"]).alias("found"))
    return e.filter(F.size("found") > 0).select("event_id", F.array_join("found", ",").alias("bad"))
