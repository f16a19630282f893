"""Aggregates, rankings, rules, episodes, controls and reconciliation."""

from pyspark.sql import functions as F

from pitframe.catalog.registry import case, table
from pitframe.functions import scalars as S
from pitframe.operators import controls as C
from pitframe.operators import episodes as E
from pitframe.operators import metrics as M
from pitframe.operators import reconcile as R
from pitframe.operators import rules as U
from pitframe.session import spread

dec = lambda c, s=2: F.col(c).cast(f"decimal(18,{s})")


@case("run_inventory", "SELECT o_orderpriority, year(o_orderdate) AS y, count(*) AS \"rows\", count(DISTINCT o_custkey) AS n_o_custkey FROM orders GROUP BY 1, 2")
def run_inventory(spark, sf):
    return M.run_inventory(table(spark, sf, "orders").withColumn("y", F.year("o_orderdate")), ["o_orderpriority", "y"], ["o_custkey"])


@case("spans", "SELECT o_orderpriority, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1")
def spans(spark, sf):
    return M.spans(table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date")), ["o_orderpriority"], "d", "d")


@case("listagg_nations", "SELECT r_name, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS listed FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
def listagg_nations(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return M.listagg(c, ["r_name"], "n_name")


@case("alerts_by_month", "SELECT l_returnflag, strftime(l_shipdate, '%Y-%m') AS month, count(DISTINCT l_orderkey) AS alerts FROM lineitem GROUP BY 1, 2")
def alerts_by_month(spark, sf):
    return M.alerts_by_month(table(spark, sf, "lineitem"), ["l_returnflag"], "l_shipdate", "l_orderkey")


@case("counts_by", "SELECT l_suppkey, count(DISTINCT l_partkey) AS cuts FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1")
def counts_by(spark, sf):
    return M.counts_by(table(spark, sf, "lineitem").filter("l_returnflag = 'R'"), ["l_suppkey"], "l_partkey")


@case("weighted_profile", """
    WITH w AS (SELECT l_suppkey, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS w, CAST(l_discount AS DECIMAL(18,2)) AS d FROM lineitem)
    SELECT l_suppkey, CAST(CAST(sum(w * d) AS DOUBLE) / CAST(sum(w) AS DOUBLE) AS DECIMAL(18,8)) AS weighted_d, sum(w) AS covered_weight, count(DISTINCT l_partkey) AS positions FROM w GROUP BY 1""")
def weighted_profile(spark, sf):
    w = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", dec("l_extendedprice").alias("w"), dec("l_discount").alias("d"))
    out = M.weighted_profile(w, "w", ["d"], ["l_suppkey"], "l_partkey")
    return out.withColumn("weighted_d", F.col("weighted_d").cast("decimal(18,8)"))


@case("concentration", """
    WITH w AS (SELECT l_suppkey, l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) * 0.0001 AS DECIMAL(12,6)) AS w FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, count(DISTINCT l_partkey) AS positions, sum(w * w) AS hhi, CAST(1.0 / CAST(sum(w * w) AS DOUBLE) AS DECIMAL(18,6)) AS effective_positions FROM w GROUP BY 1""")
def concentration(spark, sf):
    l = spread(table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_quantity"), "l_suppkey", "l_partkey")
    w = l.groupBy("l_suppkey", "l_partkey").agg((F.sum(dec("l_quantity")) * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(12,6)").alias("w"))
    return M.concentration(w, "w", ["l_suppkey"], "l_partkey").withColumn("effective_positions", F.col("effective_positions").cast("decimal(18,6)"))


@case("sector_weights", """
    WITH h AS (SELECT l_suppkey, CASE WHEN l_linenumber = 7 THEN 'CASH' ELSE l_returnflag END AS holding, p_type AS sector, sum(CAST(l_quantity AS DECIMAL(18,2))) AS w FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3),
      c AS (SELECT l_suppkey, max(w) AS cash FROM h WHERE holding = 'CASH' GROUP BY 1)
    SELECT h.l_suppkey, sector, sum(w) AS weight, cash FROM h LEFT JOIN c ON c.l_suppkey = h.l_suppkey WHERE holding <> 'CASH' AND w > 0 GROUP BY 1, 2, 4""")
def sector_weights(spark, sf):
    l = table(spark, sf, "lineitem").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("sector")), "l_partkey")
    h = l.groupBy("l_suppkey", F.when(F.col("l_linenumber") == 7, "CASH").otherwise(F.col("l_returnflag")).alias("holding"), "sector").agg(F.sum(dec("l_quantity")).alias("w"))
    return M.sector_weights(h, "w", ["l_suppkey"], "sector", "holding")


@case("coverage", """
    SELECT c_custkey, (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS filings, (SELECT count(DISTINCT event_id) FROM events WHERE user_id = c_custkey) AS assessments FROM customer""")
def coverage(spark, sf):
    f = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("ident"))
    a = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"), F.col("event_id").alias("ident"))
    return M.coverage(table(spark, sf, "customer"), "c_custkey", {"filings": f, "assessments": a})


@case("veto_concentration", """
    SELECT n_regionkey, o_orderpriority, count(DISTINCT o_orderkey) AS vetoes, CAST(avg(c_acctbal) AS DECIMAL(18,4)) AS average_score, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS flagged
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def veto_concentration(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    o = o.withColumn("score", F.col("c_acctbal")).withColumn("generated", F.col("o_orderstatus") == "P")
    out = M.veto_concentration(o, ["n_regionkey", "o_orderpriority"], "o_orderkey", "score", "generated")
    return out.withColumn("average_score", F.col("average_score").cast("decimal(18,4)"))


@case("exposure", "SELECT CAST(o_orderdate AS DATE) AS day, sum(CAST(l_quantity AS DECIMAL(18,2))) AS weight, count(DISTINCT l_partkey) AS names FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE p_type = 'ECONOMY' GROUP BY 1")
def exposure(spark, sf):
    l = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf, "part").filter("p_type = 'ECONOMY'"), F.col("l_partkey") == F.col("p_partkey"))
    return M.exposure(l.withColumn("w", dec("l_quantity")), [F.col("o_orderdate").cast("date").alias("day")], "w", "l_partkey")


@case("stop_outcomes", "SELECT o_orderpriority, count(*) AS stops, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS cash_stops FROM orders GROUP BY 1")
def stop_outcomes(spark, sf):
    return M.stop_outcomes(table(spark, sf, "orders").withColumn("cash", F.when(F.col("o_orderstatus") == "F", True)), ["o_orderpriority"], "cash")


@case("widen_metrics", """
    SELECT user_id, max(CASE WHEN event_type = 'click' THEN n END) AS click, max(CASE WHEN event_type = 'error' THEN n END) AS error, max(CASE WHEN event_type = 'purchase' THEN n END) AS purchase, strftime(max(last), '%Y-%m-%d') AS computed_at
    FROM (SELECT user_id, event_type, CASE WHEN count(*) > 8 THEN count(*) END AS n, max(CAST(ts AS DATE)) AS last FROM events GROUP BY 1, 2) GROUP BY 1""")
def widen_metrics(spark, sf):
    n = F.count(F.lit(1))
    m = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.when(n > 8, n).alias("value"), F.max(F.col("ts").cast("date")).cast("string").alias("computed_at"))
    return M.widen_metrics(m, ["click", "error", "purchase"], "user_id", "event_type", reserved="view")


@case("metric_stats", """
    SELECT 'metrics_null' AS stat, count(*) - count(CASE WHEN l_discount > 0.02 THEN 1 END) AS value FROM lineitem UNION ALL SELECT 'metrics_non_null', count(CASE WHEN l_discount > 0.02 THEN 1 END) FROM lineitem
    UNION ALL SELECT 'generated', count(*) FROM documents WHERE lang = 'en' UNION ALL SELECT 'by_rule', count(*) FROM documents WHERE lang <> 'en' UNION ALL SELECT 'strengths', sum(len(string_split(text, chr(10)))) FROM documents UNION ALL SELECT 'risks', count(*) FROM documents""")
def metric_stats(spark, sf):
    m = table(spark, sf, "lineitem").select(F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("value"))
    d = table(spark, sf, "documents").select((F.col("lang") == "en").alias("generated"), F.split("text", "\n").alias("strengths"), F.array("source").alias("risks"))
    return M.metric_stats(m, d)


@case("applied_in_range", """
    WITH s AS (SELECT l_suppkey, year(l_shipdate) AS y, min(CAST(l_shipdate AS DATE)) AS f, max(CAST(l_shipdate AS DATE)) AS t FROM lineitem GROUP BY 1, 2)
    SELECT s.l_suppkey, s.y, s.f, s.t, count(a.l_orderkey) AS applied FROM s LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'A') a ON a.l_suppkey = s.l_suppkey AND CAST(a.l_shipdate AS DATE) BETWEEN s.f AND s.t GROUP BY 1, 2, 3, 4""")
def applied_in_range(spark, sf):
    l = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("day"))
    s = l.groupBy("l_suppkey", F.year("day").alias("y")).agg(F.min("day").alias("f"), F.max("day").alias("t"))
    return M.applied_in_range(s, l.filter("l_returnflag = 'A'"), ["l_suppkey"], "f", "t", "day")


@case("unclassified_by_year", """
    SELECT year(o_orderdate) AS year, count(DISTINCT o_custkey) AS unclassified_assets FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 3) GROUP BY 1""")
def unclassified_by_year(spark, sf):
    m = table(spark, sf, "orders").select(F.col("o_custkey").alias("asset"), F.col("o_orderdate").cast("date").alias("valid_to"))
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "asset")
    return M.unclassified_by_year(m, c.filter("c_mktsegment IN ('BUILDING', 'MACHINERY')"), c.filter("c_nationkey < 3"))


@case("one_sample", "SELECT p_type, min(p_name) AS sample FROM part GROUP BY 1")
def one_sample(spark, sf):
    return M.one_sample(table(spark, sf, "part"), ["p_type"], "p_name")


@case("weighted_score", """
    WITH s AS (SELECT user_id, event_type, max(CAST(value AS DECIMAL(10,2))) AS v FROM events GROUP BY 1, 2), n AS (SELECT user_id, event_type, CAST(v * 0.01 AS DECIMAL(10,6)) AS x FROM s)
    SELECT user_id, sum(CASE event_type WHEN 'click' THEN 0.5 * (1 - x) WHEN 'error' THEN 0.3 * ((x + 1) / 2) ELSE 0.2 * (1 - x) END) AS score FROM n WHERE event_type IN ('click', 'error', 'view') GROUP BY 1""".replace("sum(CASE", "CAST(sum(CASE").replace("END) AS score", "END) AS DECIMAL(18,6)) AS score"))
def weighted_score(spark, sf):
    s = table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("metric")).agg(F.max(F.col("value").cast("decimal(10,2)")).alias("v"))
    x = (F.col("v") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,6)")
    w = spark.createDataFrame([("click", "0.5", True), ("error", "0.3", False), ("view", "0.2", True)], "metric string, w string, inverted boolean").select("metric", F.col("w").cast("decimal(3,1)").alias("weight"), "inverted")
    out = M.weighted_score(s.select("user_id", "metric", x.alias("normalized"), x.alias("raw")), w, ["user_id"])
    return out.withColumn("score", F.col("score").cast("decimal(18,6)"))


@case("freshness", """
    WITH s AS (SELECT o_custkey, CASE WHEN o_custkey % 3 <> 0 THEN 'K' END AS cik, min(CAST(o_orderdate AS DATE)) AS f, CASE WHEN o_custkey % 2 = 0 THEN max(CAST(o_orderdate AS DATE)) END AS t FROM orders GROUP BY 1)
    SELECT max(greatest(f, t)) AS latest_change, count(*) - count(t) AS open_stints, count(t) AS closed_stints, count(*) FILTER (t IS NULL AND cik IS NULL) AS open_without_id FROM s""")
def freshness(spark, sf):
    d = F.col("o_orderdate").cast("date")
    s = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min(d).alias("valid_from"), F.max(d).alias("m"))
    s = s.select(F.when(F.col("o_custkey") % 3 != 0, "K").alias("cik"), "valid_from", F.when(F.col("o_custkey") % 2 == 0, F.col("m")).alias("valid_to"))
    return M.freshness(s)


@case("rank_in", "SELECT o_custkey, o_orderkey, position FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders) WHERE position <= 3")
def rank_in(spark, sf):
    return M.rank_in(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).drop("o_totalprice")


@case("top_k", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10")
def top_k(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return M.top_k(l, [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")], 10)


@case("worst_k", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 10")
def worst_k(spark, sf):
    return M.top_k(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), [F.desc(F.abs("c_acctbal")), F.asc("c_custkey")], 10)


SEG = """s AS (SELECT o_orderpriority AS arm, 'P' || year(o_orderdate) AS win, 'P' || year(o_orderdate) || CASE WHEN month(o_orderdate) <= 6 THEN 'a' ELSE 'b' END AS seg, min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS t, count(*) AS n FROM orders GROUP BY 1, 2, 3)"""


@case("segment_identity", f"""
    WITH {SEG}, w AS (SELECT arm, win, min(f) AS f, max(t) AS t, sum(n) + CASE WHEN arm = '5-LOW' THEN 1 ELSE 0 END AS n FROM s GROUP BY 1, 2)
    SELECT a.arm, a.win, 'gap after ' || a.seg AS violation FROM s a JOIN s b ON b.arm = a.arm AND b.win = a.win AND b.seg > a.seg WHERE b.f <> a.t + 1 UNION ALL SELECT arm, win, 'differs: n' FROM w WHERE arm = '5-LOW'""")
def segment_identity(spark, sf):
    d = F.col("o_orderdate").cast("date")
    o = table(spark, sf, "orders").withColumn("win", F.concat(F.lit("P"), F.year("o_orderdate").cast("string"))).withColumn("d", d)
    s = o.groupBy(F.col("o_orderpriority").alias("arm"), "win", F.concat("win", F.when(F.month("d") <= 6, "a").otherwise("b")).alias("seg")).agg(F.min("d").alias("f"), F.max("d").alias("t"), F.count(F.lit(1)).alias("n"))
    w = s.groupBy("arm", "win").agg(F.min("f").alias("f"), F.max("t").alias("t"), F.sum("n").alias("n")).withColumn("seg", F.col("win")).withColumn("n", F.col("n") + (F.col("arm") == "5-LOW").cast("int"))
    return M.segment_identity(s.unionByName(w), ["arm"], "win", "seg", "f", "t", ["n"])


@case("timeline", "SELECT 'order' AS event, o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_totalprice AS weight, NULL AS cause FROM orders UNION ALL SELECT 'ship', l_orderkey, CAST(l_shipdate AS DATE), NULL, l_returnflag FROM lineitem")
def timeline(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").alias("weight"))
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").cast("date").alias("day"), F.col("l_returnflag").alias("cause"))
    return M.timeline({"order": o, "ship": l})


# --- rules and severity ---

TREES = [
    {"rule_id": "BIG_OR_LOW", "priority": 2, "when": {"any": [{"metric": "bal", "op": ">", "value": 8000}, {"all": [{"metric": "bal", "op": "<", "value": 0}, {"attribute": "c_mktsegment", "expected": "BUILDING"}]}]}},
    {"rule_id": "MANY", "priority": 1, "when": {"all": [{"metric": "orders", "op": ">=", "value": 12}, {"predicate": "urgent"}]}},
    {"rule_id": "NONE", "priority": 3, "when": {"metric": "orders", "op": "<", "value": 5}},
]
WIDE = "w AS (SELECT c_custkey, c_acctbal AS bal, c_mktsegment, o.n AS orders, o.u > 0 AS urgent FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS u FROM orders GROUP BY 1) o ON o_custkey = c_custkey)"
FIRED = f"""WITH {WIDE}, f AS (SELECT c_custkey, 'BIG_OR_LOW' AS rule_id, 2 AS priority FROM w WHERE bal > 8000 OR (bal < 0 AND c_mktsegment = 'BUILDING') UNION ALL SELECT c_custkey, 'MANY', 1 FROM w WHERE orders >= 12 AND urgent UNION ALL SELECT c_custkey, 'NONE', 3 FROM w WHERE orders < 5)"""


def _fired(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), (F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)) > 0).alias("urgent"))
    w = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("bal"), "c_mktsegment").join(o, "c_custkey", "left")
    return U.evaluate_rules(w, TREES, ["c_custkey"])


@case("rules_fired", f"{FIRED} SELECT * FROM f")
def rules_fired(spark, sf):
    return _fired(spark, sf)


@case("primary_rule", f"{FIRED} SELECT c_custkey, arg_min(rule_id, priority) AS primary_rule, count(*) AS fired FROM f GROUP BY 1")
def primary_rule(spark, sf):
    return U.primary_rule(_fired(spark, sf), ["c_custkey"])


@case("open_rules", "SELECT p_partkey AS rule_id, p_type AS category FROM part WHERE p_size > 25 AND p_type IN ('ECONOMY', 'STANDARD')")
def open_rules(spark, sf):
    r = table(spark, sf, "part").select(F.col("p_partkey").alias("rule_id"), F.col("p_type").alias("category"), F.when(F.col("p_size") <= 25, "x").alias("valid_to"))
    return U.open_rules(r, ["ECONOMY", "STANDARD"]).drop("valid_to")


@case("rule_problems", "SELECT p_name AS rule_id, 'open more than once' AS problem FROM part WHERE p_size > 25 GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT p_name, 'not exactly one layer' FROM part WHERE p_type = 'ECONOMY' GROUP BY 1 HAVING count(DISTINCT p_size) <> 1")
def rule_problems(spark, sf):
    r = table(spark, sf, "part").select(F.col("p_name").alias("rule_id"), F.when(F.col("p_type") == "ECONOMY", "GUARD").otherwise("X").alias("category"), F.when(F.col("p_size") <= 25, "x").alias("valid_to"), F.col("p_size").alias("guard_layer"))
    return U.rule_problems(r)


LABELS = list(S.CATEGORY_BUCKET) + ["other"]


@case("severity", f"""
    WITH n AS (SELECT doc_id, [{', '.join(f"'{x}'" for x in LABELS)}][1 + doc_id % 10] AS cat_label, CAST(doc_id % 97 AS DOUBLE) / 96 AS negative, CAST(doc_id % 89 AS DOUBLE) / 88 AS cat_score, lower(text) AS t FROM documents),
      c AS (SELECT *, CASE WHEN cat_label = 'legal_regulatory' THEN 'LEGAL' WHEN cat_label IN ('earnings_performance', 'capital_shareholder_returns', 'mergers_acquisitions') THEN 'FINANCIAL'
        WHEN cat_label IN ('market_analyst_sentiment', 'product_innovation', 'partnerships_business_dev') THEN 'MARKET' WHEN cat_label = 'other' THEN NULL ELSE 'NETWORK' END AS category FROM n),
      s AS (SELECT *, CASE WHEN negative >= 0.85 AND cat_score >= 0.80 AND category IN ('LEGAL', 'FINANCIAL') THEN 3 WHEN negative >= 0.70 THEN 2 WHEN negative >= 0.50 THEN 1 ELSE 0 END + CASE WHEN regexp_matches(t, '{'|'.join(S.HARD_KEYWORDS)}') THEN 1 ELSE 0 END AS step
        FROM c WHERE category IS NOT NULL AND (negative >= 0.50 OR cat_score >= 0.70))
    SELECT doc_id, category, ['LOW', 'MODERATE', 'HIGH', 'CRITICAL'][1 + least(step, 3)] AS severity FROM s""")
def severity(spark, sf):
    k = F.col("doc_id")
    d = table(spark, sf, "documents").select(k, F.element_at(F.array(*[F.lit(x) for x in LABELS]), (k % 10 + 1).cast("int")).alias("cat_label"),
                                            ((k % 97).cast("double") / 96).alias("negative"), ((k % 89).cast("double") / 88).alias("cat_score"), F.col("text").alias("body_text"))
    return U.risk_events(d).select("doc_id", "category", "severity")


# --- stop memory: errors stop, clicks block, views reenter, purchases rank ---


def memory_inputs(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("asset_id"), F.col("ts").cast("date").alias("date"), "event_type", "value")
    pick = lambda c: e.filter(c).select("asset_id", "date").distinct()
    return (pick("event_type = 'error' AND value > 8"), pick("event_type = 'click' AND value > 14"), pick("event_type = 'view' AND value > 25"),
            pick("event_type <> 'signup' AND day(date) % 3 = 0"))


MEM = """st AS (SELECT DISTINCT user_id AS a, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'error' AND value > 8), rk AS (SELECT DISTINCT user_id AS a, CAST(ts AS DATE) AS d FROM events WHERE event_type <> 'signup' AND day(ts) % 3 = 0),
    dt AS (SELECT DISTINCT d FROM rk), bl AS (SELECT DISTINCT user_id AS a, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'click' AND value > 14 AND CAST(ts AS DATE) IN (SELECT d FROM dt)),
    re AS (SELECT DISTINCT user_id AS a, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'view' AND value > 25),
    un AS (SELECT u.a, dt.d FROM (SELECT a FROM st UNION SELECT a FROM bl) u, dt WHERE NOT EXISTS (SELECT 1 FROM rk WHERE rk.a = u.a AND rk.d = dt.d) AND NOT EXISTS (SELECT 1 FROM bl WHERE bl.a = u.a AND bl.d = dt.d)),
    fl AS (SELECT a, d, max(s) AS s, max(b) AS b, max(r) AS r, max(u) AS u FROM (SELECT a, d, 1 AS s, 0 AS b, 0 AS r, 0 AS u FROM st UNION ALL SELECT a, d, 0, 1, 0, 0 FROM bl UNION ALL SELECT a, d, 0, 0, 1, 0 FROM re UNION ALL SELECT a, d, 0, 0, 0, 1 FROM un) GROUP BY 1, 2),
    nu AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d) AS i FROM fl),
    fo AS (SELECT a, d, i, CASE WHEN s = 1 THEN 'stop' WHEN b = 1 THEN 'decision_close' END AS started, CASE WHEN s = 1 OR b = 1 THEN d END AS since, CASE WHEN s = 1 OR b = 1 THEN r = 0 ELSE false END AS opened, CASE WHEN (s = 1 OR b = 1) AND r = 1 THEN 'price' END AS closed FROM nu WHERE i = 1
      UNION ALL SELECT n.a, n.d, n.i, CASE WHEN n.s = 1 THEN 'stop' WHEN n.b = 1 AND NOT f.opened THEN 'decision_close' END, CASE WHEN n.s = 1 OR (n.b = 1 AND NOT f.opened) THEN n.d ELSE f.since END,
        CASE WHEN n.s = 1 OR (n.b = 1 AND NOT f.opened) THEN n.r = 0 WHEN f.opened THEN n.r = 0 AND n.u = 0 ELSE false END,
        CASE WHEN n.s = 1 OR (n.b = 1 AND NOT f.opened) THEN CASE WHEN n.r = 1 THEN 'price' END WHEN f.opened AND n.u = 1 THEN 'not_ranked' WHEN f.opened AND n.r = 1 THEN 'price' END
      FROM fo f JOIN nu n ON n.a = f.a AND n.i = f.i + 1)"""


@case("episodes", f"WITH RECURSIVE {MEM} SELECT a AS asset_id, since, max(started) AS start_kind, min(CASE WHEN closed IS NOT NULL THEN d END) AS released, max(closed) AS cause FROM fo WHERE since IS NOT NULL GROUP BY 1, 2")
def episodes(spark, sf):
    return E.episodes(*memory_inputs(spark, sf))


@case("memory_control", f"""
    WITH RECURSIVE {MEM}, ep AS (SELECT a, since, min(CASE WHEN closed IS NOT NULL THEN d END) AS rel, max(closed) AS cause FROM fo WHERE since IS NOT NULL GROUP BY 1, 2),
      ac AS (SELECT DISTINCT a, dt.d FROM ep, dt WHERE since <= dt.d AND (rel IS NULL OR rel >= dt.d)), pa AS (SELECT a, rel AS d, cause AS p FROM ep WHERE rel IN (SELECT d FROM dt) UNION SELECT a, d, 'blocked' FROM bl),
      al AS (SELECT a, d FROM ac UNION SELECT a, d FROM pa), j AS (SELECT a, d, EXISTS (SELECT 1 FROM ac WHERE ac.a = al.a AND ac.d = al.d) AS act, (SELECT count(*) FROM pa WHERE pa.a = al.a AND pa.d = al.d) AS n FROM al)
    SELECT a AS asset_id, d AS date, CASE WHEN n > 1 THEN 'overlap' WHEN act AND n = 0 THEN 'missing' ELSE 'extra' END AS problem FROM j WHERE n > 1 OR (act AND n = 0) OR NOT act""")
def memory_control(spark, sf):
    s, b, r, k = memory_inputs(spark, sf)
    return E.memory_control(E.episodes(s, b, r, k), b, k.select("date").distinct(), [])


@case("orphan_reentries", f"""
    WITH RECURSIVE {MEM}, ep AS (SELECT a, since, min(CASE WHEN closed IS NOT NULL THEN d END) AS rel FROM fo WHERE since IS NOT NULL GROUP BY 1, 2)
    SELECT a AS asset_id, d AS date FROM re WHERE NOT coalesce((SELECT rel IS NULL OR re.d <= rel FROM ep WHERE ep.a = re.a AND since <= re.d ORDER BY since DESC LIMIT 1), false)""")
def orphan_reentries(spark, sf):
    s, b, r, k = memory_inputs(spark, sf)
    return E.orphan_reentries(r, E.episodes(s, b, r, k), ["asset_id"])


@case("overlapping_episodes", f"""
    WITH RECURSIVE {MEM}, ep AS (SELECT a, since, min(CASE WHEN closed IS NOT NULL THEN d END) AS rel FROM fo WHERE since IS NOT NULL GROUP BY 1, 2), n AS (SELECT *, lead(since) OVER (PARTITION BY a ORDER BY since) AS nx FROM ep)
    SELECT a AS asset_id, since, nx AS next_since FROM n WHERE nx IS NOT NULL AND (rel IS NULL OR rel >= nx)""")
def overlapping_episodes(spark, sf):
    return E.overlapping_episodes(E.episodes(*memory_inputs(spark, sf)), ["asset_id"]).select("asset_id", "since", "next_since")


# --- controls and reconciliation ---


@case("zero_filled", """
    SELECT y, 'status' AS key, s.subkey, CAST(count(o_orderkey) AS DOUBLE) AS value FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) JOIN (SELECT unnest(['F', 'O', 'X']) AS subkey) s ON true LEFT JOIN orders ON year(o_orderdate) = y AND o_orderstatus = subkey GROUP BY 1, 2, 3""")
def zero_filled(spark, sf):
    return C.zero_filled(table(spark, sf, "orders").withColumn("y", F.year("o_orderdate")), ["y"], "o_orderstatus", ["F", "O", "X"], "status")


@case("control_group2", f"""
    WITH RECURSIVE {MEM}, ep AS (SELECT a, since, max(started) AS kind, min(CASE WHEN closed IS NOT NULL THEN d END) AS rel, max(closed) AS cause FROM fo WHERE since IS NOT NULL GROUP BY 1, 2),
      s AS (SELECT event_id, user_id % 3 AS g, event_id % 2 = 0 AS cash, event_id % 5 = 0 AS spy, CASE WHEN event_id % 7 = 0 THEN 'FILTER_OFF' WHEN event_id % 7 = 1 THEN 'NO_SIGNAL' END AS cause, event_id % 4 AS opts, event_id % 6 = 0 AS nz FROM events WHERE event_type = 'error')
    SELECT g, 'decision_events' AS key, '' AS subkey, CAST(count(*) AS DOUBLE) AS value FROM (SELECT user_id % 3 AS g FROM events WHERE event_type = 'purchase') GROUP BY 1
    UNION ALL SELECT g, 'stop_events', '', count(*) FROM s GROUP BY 1 UNION ALL SELECT g, 'destination_options', '', sum(opts) FROM s GROUP BY 1 UNION ALL SELECT g, 'stop_rejection_summaries', '', count(*) FILTER (nz) FROM s GROUP BY 1
    UNION ALL SELECT g, 'stops_by_destination', 'cash', count(*) FILTER (cash) FROM s GROUP BY 1 UNION ALL SELECT g, 'stops_by_destination', 'spy', count(*) FILTER (NOT cash AND spy) FROM s GROUP BY 1 UNION ALL SELECT g, 'stops_by_destination', 'stock', count(*) FILTER (NOT cash AND NOT spy) FROM s GROUP BY 1
    UNION ALL SELECT g, 'stops_cash_by_cause', k, count(*) FILTER (cause = k) FROM s, (SELECT unnest(['FILTER_OFF', 'NO_ALLOWED_DESTINATION', 'NO_SIGNAL', 'SCALE_BELOW_ONE']) AS k) GROUP BY 1, 2, 3
    UNION ALL SELECT a % 3, 'memory_episodes', '', count(*) FROM ep GROUP BY 1 UNION ALL SELECT a % 3, 'decision_close_episodes', '', count(*) FILTER (kind = 'decision_close') FROM ep GROUP BY 1
    UNION ALL SELECT a % 3, 'memory_released_price', '', count(*) FILTER (cause = 'price') FROM ep GROUP BY 1 UNION ALL SELECT a % 3, 'memory_released_not_ranked', '', count(*) FILTER (cause = 'not_ranked') FROM ep GROUP BY 1
    UNION ALL SELECT a % 3, 'memory_open_at_end', '', count(*) FILTER (rel IS NULL) FROM ep GROUP BY 1""")
def control_group2(spark, sf):
    e = table(spark, sf, "events").withColumn("g", F.col("user_id") % 3)
    i = F.col("event_id")
    stops = e.filter("event_type = 'error'").select("g", (i % 2 == 0).alias("chosen_cash"), i.alias("chosen_asset"), (i % 5 == 0).alias("chosen_is_spy"),
                                                   F.when(i % 7 == 0, "FILTER_OFF").when(i % 7 == 1, "NO_SIGNAL").alias("cause"), F.when(i % 4 > 0, F.sequence(F.lit(1).cast("bigint"), i % 4)).alias("menu"),
                                                   F.create_map(F.lit("zone_evaluated"), F.lit(9), F.lit("held"), (i % 6 == 0).cast("int")).alias("eligible_counts"))
    eps = E.episodes(*memory_inputs(spark, sf)).withColumn("g", F.col("asset_id") % 3)
    return C.control_group2(e.filter("event_type = 'purchase'"), stops, eps, ["g"])


@case("control_group3", """
    WITH r AS (SELECT o_orderstatus AS g, len(string_split(o_orderpriority, '-')) AS a, o_orderkey % 3 AS n, o_orderkey % 2 AS m FROM orders)
    SELECT g, 'retention_decisions' AS key, '' AS subkey, CAST(count(*) AS DOUBLE) AS value FROM r GROUP BY 1 UNION ALL SELECT g, 'retention_holds', '', sum(n) FROM r GROUP BY 1 UNION ALL SELECT g, 'retention_rejections', '', sum(m) FROM r GROUP BY 1
    UNION ALL SELECT g, 'retention_counter_drops', '', sum(n) FROM r GROUP BY 1 UNION ALL SELECT g, 'retention_rejections_by_cause', 'counter', sum(m) FROM r GROUP BY 1 UNION ALL SELECT g, 'retention_rejections_by_cause', 'memory', 0 FROM r GROUP BY 1""")
def control_group3(spark, sf):
    k = F.col("o_orderkey")
    arr = lambda n: F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), n), lambda x: F.struct(x.alias("asset_id"), F.lit("counter").alias("cause")))).otherwise(F.array().cast("array<struct<asset_id:bigint,cause:string>>"))
    r = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("g"), arr(k % 3).alias("retained"), arr(k % 2).alias("rejected"), arr(k % 3).alias("counter_dropped"))
    return C.control_group3(r, ["g"], ["counter", "memory"])


@case("control_group4", "SELECT user_id % 3 AS g, 'ranking_decisions' AS key, '' AS subkey, CAST(count(DISTINCT CAST(ts AS DATE)) AS DOUBLE) AS value FROM events GROUP BY 1 UNION ALL SELECT user_id % 3, 'ranking_rows', '', count(*) FROM events GROUP BY 1")
def control_group4(spark, sf):
    return C.control_group4(table(spark, sf, "events").select((F.col("user_id") % 3).alias("g"), F.col("ts").cast("date").alias("date")), ["g"])


@case("control_group5", """
    WITH c AS (SELECT *, conv_id % 3 AS g FROM conversations), e AS (SELECT *, user_id % 3 AS g FROM events)
    SELECT g, 'manager_calls' AS key, '' AS subkey, CAST(count(*) AS DOUBLE) AS value FROM c WHERE role = 'assistant' GROUP BY 1 UNION ALL SELECT g, 'manager_fallbacks', '', count(*) FILTER (turn > 1) FROM c WHERE role = 'assistant' GROUP BY 1
    UNION ALL SELECT g, 'manager_repairs', '', count(*) FILTER (turn % 3 = 0) FROM c WHERE role = 'assistant' GROUP BY 1 UNION ALL SELECT g, 'narrator_texts', '', count(*) FROM c WHERE role = 'user' GROUP BY 1
    UNION ALL SELECT g, 'news_pool_actions', 'veto', count(*) FILTER (event_type = 'click') FROM e GROUP BY 1 UNION ALL SELECT g, 'news_pool_actions', 'promotion', count(*) FILTER (event_type = 'view') FROM e GROUP BY 1
    UNION ALL SELECT g, 'news_date_records', '', count(*) FROM e GROUP BY 1 UNION ALL SELECT g, 'news_level_c_decisions', '', count(*) FILTER (event_id % 4 = 0) FROM e GROUP BY 1 UNION ALL SELECT g, 'news_level_d_decisions', '', count(*) FILTER (event_id % 5 = 0) FROM e GROUP BY 1
    UNION ALL SELECT g, 'news_exits', '', count(*) FILTER (event_type = 'error') FROM e GROUP BY 1 UNION ALL SELECT g, 'news_sector_rejections', '', sum(event_id % 3) FROM e GROUP BY 1 UNION ALL SELECT g, 'bull_triggered', '', count(*) FILTER (value > 20) FROM e GROUP BY 1""")
def control_group5(spark, sf):
    c = table(spark, sf, "conversations").withColumn("g", F.col("conv_id") % 3)
    e = table(spark, sf, "events").withColumn("g", F.col("user_id") % 3)
    i = F.col("event_id")
    m = c.filter("role = 'assistant'").select("g", F.when(F.col("turn") > 1, "late").alias("fallback_cause"), (F.col("turn") % 3 == 0).alias("repair_used"))
    a = e.select("g", F.when(F.col("event_type") == "click", "veto").when(F.col("event_type") == "view", "promotion").alias("action"))
    lv = e.select("g", F.when(i % 4 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("c_flagged"), (i % 5 == 0).alias("d_fired"))
    st = e.select("g", F.when(F.col("event_type") == "error", "news_shock").alias("trigger"), F.create_map(F.lit("news_sector"), (i % 3)).alias("eligible_counts"))
    return C.control_group5(m, c.filter("role = 'user'"), a, lv, st, e.select("g", (F.col("value") > 20).alias("triggered")), ["g"])


@case("control_group6", "SELECT year(o_orderdate) AS y, 'series_rows' AS key, '' AS subkey, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1")
def control_group6(spark, sf):
    return C.control_group6(table(spark, sf, "orders").withColumn("y", F.year("o_orderdate")), ["y"])


@case("agent_counts", "SELECT event_type, 'records' AS key, '' AS subkey, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1 UNION ALL SELECT event_type, 'fallbacks', '', count(*) FILTER (event_id % 3 = 0) FROM events GROUP BY 1 UNION ALL SELECT event_type, 'repairs', '', count(*) FILTER (event_id % 3 = 1) FROM events GROUP BY 1 UNION ALL SELECT event_type, 'triggered', '', count(*) FILTER (event_id % 3 = 2) FROM events GROUP BY 1")
def agent_counts(spark, sf):
    i = F.col("event_id")
    j = F.when(i % 3 == 0, '{"fallback": {"cause": "x"}}').when(i % 3 == 1, '{"repair_used": true, "fallback": {"cause": null}}').otherwise('{"triggered": true, "repair_used": false}')
    return C.agent_counts(table(spark, sf, "events").select("event_type", j.alias("json")), ["event_type"])


@case("compare_keyed", """
    WITH e AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_custkey % 5 <> 0 GROUP BY 1), a AS (SELECT o_custkey AS k, count(*) FILTER (o_orderstatus <> 'P') AS v FROM orders WHERE o_custkey % 7 <> 0 GROUP BY 1)
    SELECT coalesce(e.k, a.k) AS k, e.v AS expected, a.v AS actual, CASE WHEN a.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'extra' WHEN e.v = a.v THEN 'pass' ELSE 'differs' END AS status FROM e FULL JOIN a ON e.k = a.k""")
def compare_keyed(spark, sf):
    o = table(spark, sf, "orders").withColumn("k", F.col("o_custkey"))
    e = o.filter("k % 5 <> 0").groupBy("k").agg(F.count(F.lit(1)).alias("value"))
    a = o.filter("k % 7 <> 0").groupBy("k").agg(F.count(F.when(F.col("o_orderstatus") != "P", 1)).alias("value"))
    return R.compare_keyed(e, a, ["k"])


@case("compare_controls", """
    WITH e AS (SELECT o_orderstatus AS c, 'P' || year(o_orderdate) AS w, o_orderpriority AS k, CAST(count(*) AS DOUBLE) + CASE WHEN year(o_orderdate) = 1995 THEN 1e-14 WHEN year(o_orderdate) = 1996 THEN 1 ELSE 0 END AS v FROM orders WHERE year(o_orderdate) <> 1997 GROUP BY 1, 2, 3, year(o_orderdate)),
      a AS (SELECT o_orderstatus AS c, 'P' || year(o_orderdate) AS w, o_orderpriority AS k, CAST(count(*) AS DOUBLE) AS v FROM orders WHERE year(o_orderdate) <> 1998 GROUP BY 1, 2, 3)
    SELECT coalesce(e.c, a.c) AS configuration, coalesce(e.w, a.w) AS "window", coalesce(e.k, a.k) AS key, CASE WHEN e.c IS NULL THEN 'missing from manifest' WHEN coalesce(e.k, a.k) = '5-LOW' THEN 'unknown key' WHEN a.c IS NULL THEN 'missing' WHEN abs(e.v - a.v) <= 1e-12 THEN 'pass' ELSE 'differs' END AS status
    FROM e FULL JOIN a ON e.c = a.c AND e.w = a.w AND e.k = a.k""")
def compare_controls(spark, sf):
    y = F.year("o_orderdate")
    g = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("configuration"), y.alias("y"), F.col("o_orderpriority").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    g = g.withColumn("window", F.concat(F.lit("P"), F.col("y").cast("string"))).withColumn("subkey", F.lit(""))
    e = g.filter("y <> 1997").withColumn("value", F.col("value") + F.when(F.col("y") == 1995, 1e-14).when(F.col("y") == 1996, 1.0).otherwise(0.0))
    return R.compare_controls(e, g.filter("y <> 1998"), ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"], True).select("configuration", "window", "key", "status")


@case("identity_failures", f"""
    WITH RECURSIVE {MEM}, ep AS (SELECT a % 3 AS g, since, min(CASE WHEN closed IS NOT NULL THEN d END) AS rel, max(closed) AS cause FROM fo WHERE since IS NOT NULL GROUP BY a, since)
    SELECT g, 'scale_changes' AS identity FROM ep GROUP BY g HAVING count(*) <> 0 UNION ALL SELECT g, 'retention_counter_drops' FROM ep GROUP BY g HAVING count(*) FILTER (cause = 'price') <> count(*)""")
def identity_failures(spark, sf):
    c = lambda x: F.count(F.when(x, 1))
    w = E.episodes(*memory_inputs(spark, sf)).groupBy((F.col("asset_id") % 3).alias("g")).agg(
        F.count(F.lit(1)).alias("memory_episodes"), c(F.col("cause") == "price").alias("memory_released_price"), c(F.col("cause") == "not_ranked").alias("memory_released_not_ranked"),
        c(F.col("released").isNull()).alias("memory_open_at_end"))
    w = w.withColumn("retention_counter_drops", F.col("memory_episodes")).withColumn("rejections_counter", F.col("memory_released_price")).withColumn("scale_changes", F.col("memory_episodes")).withColumn("alerts_l0", F.lit(0))
    return R.identity_failures(w, R.control_identities(), ["g"])


@case("cash_failures", "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') <> (o_totalprice > 250000)")
def cash_failures(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "below").otherwise("above").alias("state"), F.when(F.col("o_orderpriority") == "1-URGENT", True).alias("risk_off"),
                                         F.when(F.col("o_totalprice") > 250000, 0.5).otherwise(0.0).alias("cash"))
    return R.cash_failures(o, "state", "risk_off", "cash").select("o_orderkey")


@case("compounding_failures", """
    WITH s AS (SELECT l_partkey, max(CASE WHEN l_returnflag = 'N' THEN CAST(l_discount AS DECIMAL(10,4)) END) AS w, max(CASE WHEN l_returnflag = 'A' THEN CAST(l_discount AS DECIMAL(10,4)) END) AS a, max(CASE WHEN l_returnflag = 'R' THEN CAST(l_discount AS DECIMAL(10,4)) END) AS r FROM lineitem GROUP BY 1)
    SELECT l_partkey, w AS whole, CAST((1 + a) * (1 + r) - 1 AS DECIMAL(18,8)) AS compounded FROM s WHERE abs(w - ((1 + a) * (1 + r) - 1)) > 0.09""")
def compounding_failures(spark, sf):
    l = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", F.col("l_discount").cast("decimal(10,4)").alias("v"))
    out = R.compounding_failures(l, ["l_partkey"], "l_returnflag", "v", "N", ["A", "R"], 0.09)
    return out.withColumn("compounded", F.col("compounded").cast("decimal(18,8)"))


@case("compounding", "SELECT l_partkey, CAST(product(1 + l_discount) - 1 AS DECIMAL(18,6)) AS total FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1")
def compounding(spark, sf):
    l = table(spark, sf, "lineitem").filter("l_returnflag = 'A'")
    return l.groupBy("l_partkey").agg(S.compounded(F.col("l_discount")).cast("decimal(18,6)").alias("total"))


@case("check_canonical", """
    WITH h AS (SELECT c_nationkey AS cik, c_mktsegment AS symbol, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'AUTOMOBILE' END AS canonical_symbol, CAST(floor(c_custkey / 40) AS BIGINT) AS valid_from, c_custkey FROM customer), m AS (SELECT cik, max(valid_from) AS m FROM h GROUP BY 1), l AS (SELECT h.* FROM h JOIN m ON m.cik = h.cik AND m.m = h.valid_from)
    SELECT cik, c_custkey FROM l a WHERE NOT EXISTS (SELECT 1 FROM l b WHERE b.cik = a.cik AND b.symbol = a.canonical_symbol)""")
def check_canonical(spark, sf):
    k = F.col("c_custkey")
    h = table(spark, sf, "customer").select(F.col("c_nationkey").alias("cik"), F.col("c_mktsegment").alias("symbol"), F.when(k % 3 == 0, F.col("c_mktsegment")).otherwise("AUTOMOBILE").alias("canonical_symbol"), F.floor(k / 40).alias("valid_from"), k)
    return R.check_canonical(h).select("cik", "c_custkey")


@case("compare_external", """
    WITH x AS (SELECT o_custkey AS k, min(CAST(o_orderdate AS DATE)) AS f, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT o_custkey AS k, min(CAST(o_orderdate AS DATE)) AS f, count(*) FILTER (o_orderkey % 40 <> 0) AS n FROM orders WHERE o_orderkey % 9 <> 0 AND o_custkey % 10 <> 0 GROUP BY 1)
    SELECT x.k, CASE WHEN e.k IS NULL OR e.f <> x.f THEN 'error' ELSE 'warning' END AS severity, CASE WHEN e.k IS NULL THEN 'no engine row' WHEN e.f <> x.f THEN 'differs: f' ELSE 'n' END AS detail FROM x LEFT JOIN e ON e.k = x.k WHERE e.k IS NULL OR e.f <> x.f OR e.n <> x.n""")
def compare_external(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    x = o.groupBy("k").agg(F.min("d").alias("f"), F.count(F.lit(1)).alias("n"))
    e = o.filter("o_orderkey % 9 <> 0 AND k % 10 <> 0").groupBy("k").agg(F.min("d").alias("f"), F.count(F.when(F.col("o_orderkey") % 40 != 0, 1)).alias("n"))
    return R.compare_external(x, e, ["k"], ["f"], "n")


@case("max_abs_diff", "SELECT max(abs(CAST(c_acctbal AS DECIMAL(18,2)) - CAST(s_acctbal AS DECIMAL(18,2)))) AS max_abs_diff, count(*) AS compared FROM customer JOIN supplier ON s_suppkey = c_custkey")
def max_abs_diff(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), dec("c_acctbal").alias("v"))
    return R.max_abs_diff(a, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), dec("s_acctbal").alias("v")), ["k"], "v")


@case("verify_metadata", """
    WITH m AS (SELECT p_partkey AS k, p_name, p_brand FROM part), r AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 6 = 0 THEN 'x' ELSE p_name END AS p_name, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS p_brand FROM part WHERE p_partkey % 8 <> 1)
    SELECT m.k, 'p_name' AS "column", CASE WHEN r.k IS NULL THEN 'missing' WHEN m.p_name IS NOT DISTINCT FROM r.p_name THEN 'pass' ELSE 'differs' END AS status FROM m LEFT JOIN r ON r.k = m.k
    UNION ALL SELECT m.k, 'p_brand', CASE WHEN r.k IS NULL THEN 'missing' WHEN m.p_brand IS NOT DISTINCT FROM r.p_brand THEN 'pass' ELSE 'differs' END FROM m LEFT JOIN r ON r.k = m.k""")
def verify_metadata(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    m = p.select(k.alias("k"), "p_name", "p_brand")
    r = p.filter(k % 8 != 1).select(k.alias("k"), F.when(k % 6 == 0, "x").otherwise(F.col("p_name")).alias("p_name"), F.when(k % 4 != 0, F.col("p_brand")).alias("p_brand"))
    return R.verify_metadata(r, m, ["k"], ["p_name", "p_brand"]).select("k", "column", "status")


@case("verify_counts", "SELECT o_orderpriority, count(*) AS expected, count(*) FILTER (o_orderstatus <> 'P' OR o_orderpriority = '5-LOW') AS actual, CASE WHEN o_orderpriority = '5-LOW' THEN 'pass' ELSE 'differs' END AS status FROM orders GROUP BY 1")
def verify_counts(spark, sf):
    o = table(spark, sf, "orders")
    e = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("value"))
    return R.verify_counts(o.filter("o_orderstatus <> 'P' OR o_orderpriority = '5-LOW'"), e, ["o_orderpriority"])


@case("nested_problems", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'unknown field zz' WHEN 1 THEN 'negative n' WHEN 2 THEN 'cash choice names an asset' END AS problem FROM events WHERE event_id % 4 < 3")
def nested_problems(spark, sf):
    i = F.col("event_id")
    j = F.when(i % 4 == 0, '{"n": 1, "zz": 2}').when(i % 4 == 1, '{"n": -1}').when(i % 4 == 2, '{"cash": true, "asset_id": 7}').otherwise('{"cash": true, "n": 3}')
    return R.nested_problems(table(spark, sf, "events").select("event_id", j.alias("chosen")), "chosen", ["asset_id", "cash", "n"], ["event_id"], ["n"])
