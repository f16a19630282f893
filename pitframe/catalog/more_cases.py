"""Remaining projections and checks: news, agent records, decision index, sizes, vocabularies."""

from pyspark.sql import functions as F

from pitframe.catalog.entity_cases import alert_table, oracle, profile
from pitframe.catalog.graph_cases import QSQL, SCHEMA, batch, quads, stored
from pitframe.catalog.registry import case, table
from pitframe.catalog.stream_cases import scratch
from pitframe.operators import gate as G
from pitframe.operators import integrity as I
from pitframe.operators import metrics as M
from pitframe.operators import reconcile as R
from pitframe.operators.quads import melt
from pitframe.plans import entities as E
from pitframe.plans import projections as P
from pitframe.plans.casebook import check_sql, view
from pitframe.sources import deliveries, scans


@case("scan_view", check_sql("v_book_rebalance", "SELECT rebalance_id, book_id, backtest_run_id, arm_code, decision_date, execution_date, quant_portfolio_id, cycle_run_id, risk_model_id, status, knowledge_date FROM v_book_rebalance"))
def scan_view(spark, sf):
    out = scratch(spark)
    view(spark, sf, "v_book_rebalance").withColumn("added_upstream", F.lit(1)).write.parquet(out)
    return scans.scan_view(spark, "v_book_rebalance", out)


@case("discover_windows", check_sql("v_book", "SELECT DISTINCT window_id AS \"window\" FROM v_book"))
def discover_windows(spark, sf):
    b = view(spark, sf, "v_book")
    files = b.select(F.concat(F.lit("base_"), "window_id", F.lit(".db")).alias("file")).distinct().unionByName(b.select(F.concat(F.lit("other_"), "window_id", F.lit(".db")).alias("file")).distinct())
    known = b.groupBy(F.col("window_id").alias("window")).agg(F.min("d_start").alias("d_start"))
    return deliveries.discover_windows(files, "base", known)[0].select("window")


NEWS = """(SELECT doc_id AS id, 'T' || (doc_id % 150) AS ticker, CASE WHEN doc_id % 3 > 0 THEN DATE '2020-01-31' + CAST(doc_id % 400 AS INTEGER) ELSE DATE '2020-02-10' + CAST(doc_id % 100 AS INTEGER) END AS published, (doc_id % 97) / 96.0::DOUBLE AS negative, (doc_id % 31) / 30.0::DOUBLE AS positive, (doc_id % 89) / 88.0::DOUBLE AS cat_score,
    CASE WHEN doc_id % 2 = 0 THEN 'LEGAL' END AS category, lower(text) AS t FROM documents)"""
HARD = "CASE WHEN regexp_matches(t, 'lawsuit|sec investigation|investigation|restatement|material weakness|class action|subpoena|indictment|fraud|settlement|recall') THEN 1 ELSE 0 END"
NA = "LEFT JOIN (SELECT asset, asset_symbol FROM assets) a ON a.asset_symbol = n.ticker"


def news(spark, sf):
    k = F.col("doc_id")
    day = lambda base, n: F.date_add(F.lit(base).cast("date"), (k % n).cast("int")).cast("string")
    return table(spark, sf, "documents").select(
        k.alias("id"), F.concat(F.lit("T"), (k % 150).cast("string")).alias("ticker"), F.when(k % 3 > 0, day("2020-01-31", 400)).alias("pub_date"), F.concat(day("2020-02-10", 100), F.lit("T08:00:00Z")).alias("fetched_at"), F.col("text").alias("body_text"),
        ((k % 31).cast("double") / 30).alias("positive"), ((k % 97).cast("double") / 96).alias("negative"), F.lit("2020-06-01").alias("sent_processed_at"), F.when(k % 2 == 0, "legal_regulatory").otherwise("other").alias("cat_label"), ((k % 89).cast("double") / 88).alias("cat_score"), F.lit("2020-07-01").alias("cat_processed_at"))


@case("ent_articles", oracle("assets",
      (E.NEWS_ARTICLE, f"SELECT 'g' AS graph, 'articles:' || id AS source_id, n.ticker, published, a.asset, 'Article_' || id AS subject FROM {NEWS} n {NA}"),
      (E.RISK_EVENT, f"SELECT 'g' AS graph, category, ['LOW', 'MODERATE', 'HIGH', 'CRITICAL'][1 + least(3, {HARD} + CASE WHEN negative >= 0.85 AND cat_score >= 0.80 THEN 3 WHEN negative >= 0.7 THEN 2 WHEN negative >= 0.5 THEN 1 ELSE 0 END)] AS severity, published, greatest(published, DATE '2020-07-01') AS available_at, 'Article_' || id AS article, a.asset, 'RiskEvent_' || id AS subject FROM {NEWS} n {NA} WHERE category IS NOT NULL AND (negative >= 0.5 OR cat_score >= 0.7)")))
def ent_articles(spark, sf):
    art, _, ev = P.articles(news(spark, sf), view(spark, sf, "assets"), F.lit("g"))
    return profile(melt(art, E.NEWS_ARTICLE), melt(ev, E.RISK_EVENT))


@case("ent_sentiments", check_sql("assets", f"SELECT 'Sentiment_' || id AS subject, a.asset, greatest(published, DATE '2020-06-01') AS available_at, CAST(greatest(-1.0, least(1.0, positive - negative)) AS DECIMAL(12,8)) AS value FROM {NEWS} n {NA}"))
def ent_sentiments(spark, sf):
    _, s, _ = P.articles(news(spark, sf), view(spark, sf, "assets"), F.lit("g"))
    return s.select("subject", F.col("scoreSnapshotOfAsset").alias("asset"), F.col("availableAt").alias("available_at"), F.col("rawValue").cast("decimal(12,8)").alias("value"))


def agent_tables(spark, sf):
    """Agent records played by conversation turns, nested objects as they are delivered."""
    c = table(spark, sf, "conversations").withColumn("date", F.date_add(F.lit("2021-01-01").cast("date"), (F.col("conv_id") % 300).cast("int"))).withColumn("window_id", F.lit("P1")).withColumn("graph", F.lit("g"))
    key = F.concat_ws("_", "conv_id", "turn")
    calls = c.filter("role = 'assistant'").select(
        "graph", "date", "window_id", F.concat(F.lit("Call_"), key).alias("subject"), F.col("turn").alias("call_index"), F.lit("A").alias("agent_arm"), F.concat(F.lit("Stop_"), F.col("conv_id").cast("string")).alias("stop"), F.col("conv_id").alias("stopped_asset_id"),
        F.struct(F.lit(False).alias("used_rule"), (F.col("turn") > 2).alias("used_cash"), F.when(F.col("turn") > 2, "late").alias("cause")).alias("fallback"), F.struct(F.lit("m").alias("requested"), F.lit("m1").alias("resolved")).alias("model"),
        (F.col("turn") % 3 == 0).alias("repair_used"), F.split("role", "s").alias("tool_order"), F.lit(True).alias("generated_by_language_model"), F.lit("f").alias("source_document"), F.col("turn").alias("source_line_number"), F.sha2("text", 256).alias("record_source_sha256"))
    texts = c.filter("role = 'user'").select("graph", "date", "window_id", F.concat(F.lit("Text_"), key).alias("subject"), F.lit("stop").alias("kind"), "text", F.lit("llm").alias("source"), F.lit("event").alias("source_kind"), F.col("date").alias("source_date"), F.col("turn").alias("line"),
                                               F.concat(F.lit("Stop_"), F.col("conv_id").cast("string")).alias("stop"), F.lit(False).alias("generated_by_language_model"), F.lit("f").alias("source_document"), F.sha2("text", 256).alias("record_source_sha256"))
    return P.flatten_agent(calls, {"fallback": ["used_rule", "used_cash", "cause"], "model": ["requested", "resolved"]}), texts


CV = "(SELECT *, 'g' AS graph, 'P1' AS window_id, DATE '2021-01-01' + CAST(conv_id % 300 AS INTEGER) AS date, conv_id || '_' || turn AS ky FROM conversations)"


def _null(mapping, *have):
    return "".join(f"NULL AS {p.column}, " for p in {p.column: p for p in mapping.props}.values() if p.column not in have and not p.many)


CALL = ("date", "window_id", "call_index", "agent_arm", "stop", "stopped_asset_id", "fallback_used_rule", "fallback_used_cash", "fallback_cause", "repair_used", "model_requested", "model_resolved", "generated_by_language_model", "source_document", "source_line_number", "record_source_sha256")
TEXT = ("date", "window_id", "kind", "text", "source", "source_kind", "source_date", "line", "stop", "generated_by_language_model", "source_document", "record_source_sha256")


@case("ent_agents", check_sql("base", ", q AS (" + oracle("base",
      (E.MANAGER_CALL, f"SELECT {_null(E.MANAGER_CALL, *CALL)}graph, date, window_id, turn AS call_index, 'A' AS agent_arm, 'Stop_' || conv_id AS stop, conv_id AS stopped_asset_id, false AS fallback_used_rule, turn > 2 AS fallback_used_cash, CASE WHEN turn > 2 THEN 'late' END AS fallback_cause, turn % 3 = 0 AS repair_used, 'm' AS model_requested, 'm1' AS model_resolved, string_split(role, 's') AS tool_order, true AS generated_by_language_model, 'f' AS source_document, turn AS source_line_number, sha256(text) AS record_source_sha256, 'Call_' || ky AS subject FROM {CV} WHERE role = 'assistant'"),
      (E.NARRATOR_TEXT, f"SELECT {_null(E.NARRATOR_TEXT, *TEXT)}graph, date, window_id, 'stop' AS kind, text, 'llm' AS source, 'event' AS source_kind, date AS source_date, turn AS line, 'Stop_' || conv_id AS stop, CAST(NULL AS VARCHAR[]) AS omitted, false AS generated_by_language_model, 'f' AS source_document, sha256(text) AS record_source_sha256, 'Text_' || ky AS subject FROM {CV} WHERE role = 'user'"),
      ).split(", q AS (", 1)[1]))
def ent_agents(spark, sf):
    calls, texts = agent_tables(spark, sf)
    out = P.agent_records({"manager_calls": calls, "narrator": texts})
    return profile(melt(out["manager_calls"], E.MANAGER_CALL), melt(out["narrator"], E.NARRATOR_TEXT))


@case("ent_news_actions", oracle("base",
      (E.NEWS_ACTION, "SELECT 'g' AS graph, CAST(ts AS DATE) AS date, 'P1' AS window_id, CASE WHEN event_id % 2 = 0 THEN 'veto' ELSE 'promotion' END AS kind, 'T' || user_id AS asset, 'T' || user_id AS ticker, 'Date_' || CAST(ts AS DATE) AS date_record, 'Run_P1' AS run, 'Ev_' || event_id AS evidence, NULL AS replaces, NULL AS replaced_by, value > 10 AS filled, NULL AS fill_asset, [event_type, 'x'] AS test_rows, 'Act_' || event_id AS subject FROM events WHERE event_type <> 'signup'"),
      (E.NEWS_EVIDENCE, "SELECT 'g' AS graph, 'P1' AS window_id, 'T' || user_id AS asset, 'T' || user_id AS ticker, event_type AS state, event_id % 9 AS n, event_id % 5 AS a, event_id % 4 AS b, event_id % 3 = 0 AS covered, NULL AS conflict, ['NewsItem_' || event_id] AS items, 'Ev_' || event_id AS subject FROM events WHERE event_type <> 'signup'"),
      (E.BULL_DECISION, "SELECT DISTINCT 'g' AS graph, CAST(ts AS DATE) AS date, 'P1' AS window_id, 'Bull_P1' AS record, true AS evaluable, day(ts) % 2 = 0 AS triggered, NULL AS z, NULL AS rung, NULL AS t1, NULL AS n, 'BullDecision_' || CAST(ts AS DATE) AS subject FROM events")))
def ent_news_actions(spark, sf):
    e = table(spark, sf, "events").withColumn("date", F.col("ts").cast("date")).withColumn("graph", F.lit("g")).withColumn("window_id", F.lit("P1"))
    i, t = F.col("event_id"), F.concat(F.lit("T"), F.col("user_id").cast("string"))
    ident = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    a = e.filter("event_type <> 'signup'")
    acts = a.select("graph", "date", "window_id", F.when(i % 2 == 0, "veto").otherwise("promotion").alias("kind"), t.alias("asset"), t.alias("ticker"), ident("Date_", F.col("date")).alias("date_record"), F.lit("Run_P1").alias("run"), ident("Ev_", i).alias("evidence"),
                    (F.col("value") > 10).alias("filled"), F.array("event_type", F.lit("x")).alias("test_rows"), ident("Act_", i).alias("subject"))
    ev = a.select("graph", "window_id", t.alias("asset"), t.alias("ticker"), F.col("event_type").alias("state"), (i % 9).alias("n"), (i % 5).alias("a"), (i % 4).alias("b"), (i % 3 == 0).alias("covered"), F.array(ident("NewsItem_", i)).alias("items"), ident("Ev_", i).alias("subject"))
    bull = e.select("graph", "date", "window_id").distinct().select("*", F.lit("Bull_P1").alias("record"), F.lit(True).alias("evaluable"), (F.dayofmonth("date") % 2 == 0).alias("triggered"), ident("BullDecision_", F.col("date")).alias("subject"))
    out = P.agent_records({"news_actions": acts, "news_evidence": ev, "bull_decisions": bull})
    return profile(melt(out["news_actions"], E.NEWS_ACTION), melt(out["news_evidence"], E.NEWS_EVIDENCE), melt(out["bull_decisions"], E.BULL_DECISION))


@case("ent_news_records", oracle("base",
      (E.DATE_RECORD, "SELECT 'g' AS graph, CAST(ts AS DATE) AS date, 'P1' AS window_id, 'Run_P1' AS run, NULL AS coverage_first, NULL AS coverage_last, true AS has_temporal_coverage, NULL AS admitted_count, count(*) AS pool_size, true AS complete_pool, [min(event_type)] AS dropped, count(*) > 380 AS level_c, NULL AS level_c_flagged_count, max(value) > 90 AS level_d, 'Date_' || CAST(ts AS DATE) AS subject FROM events GROUP BY CAST(ts AS DATE)"),
      (E.NEWS_RUN, "SELECT 'g' AS graph, min(CAST(ts AS DATE)) AS date, 'P1' AS window_id, 'Configuration_x' AS configuration, 'on' AS news_mode, 0.05 AS news_alpha, NULL AS news_exits, NULL AS news_sector_rejections, count(DISTINCT CAST(ts AS DATE)) AS news_date_count, 'r' AS run_id, 'Run_P1' AS subject FROM events")))
def ent_news_records(spark, sf):
    e = table(spark, sf, "events").withColumn("date", F.col("ts").cast("date"))
    common = lambda df: df.withColumn("graph", F.lit("g")).withColumn("window_id", F.lit("P1"))
    n = F.count(F.lit(1))
    d = common(e.groupBy("date").agg(n.alias("pool_size"), F.array(F.min("event_type")).alias("dropped"), (n > 380).alias("level_c"), (F.max("value") > 90).alias("level_d")))
    d = d.withColumn("run", F.lit("Run_P1")).withColumn("has_temporal_coverage", F.lit(True)).withColumn("complete_pool", F.lit(True)).withColumn("subject", F.concat(F.lit("Date_"), F.col("date").cast("string")))
    r = common(e.agg(F.min("date").alias("date"), F.countDistinct("date").alias("news_date_count")))
    r = r.withColumn("configuration", F.lit("Configuration_x")).withColumn("news_mode", F.lit("on")).withColumn("news_alpha", F.lit(0.05)).withColumn("run_id", F.lit("r")).withColumn("subject", F.lit("Run_P1"))
    out = P.agent_records({"date_records": d, "news_runs": r})
    return profile(melt(out["date_records"], E.DATE_RECORD), melt(out["news_runs"], E.NEWS_RUN))


@case("decision_index", check_sql("v_cycle_run v_cycle_ranking", "SELECT as_of AS date, run_id AS cycle_run_id, asset_id FROM v_cycle_run LEFT JOIN v_cycle_ranking ON cycle_run_id = run_id AND selected = 1 WHERE v_cycle_run.status = 'completed'"))
def decision_index(spark, sf):
    c = view(spark, sf, "v_cycle_run").select(F.col("run_id").alias("cycle_run_id"), "as_of", "status")
    return I.decision_index(c.select(F.col("as_of").alias("date")), c, view(spark, sf, "v_cycle_ranking"))[0]


@case("decision_index_gaps", check_sql("v_cycle_run", "SELECT as_of AS date, 0 AS cycles FROM v_cycle_run WHERE status <> 'completed'"))
def decision_index_gaps(spark, sf):
    c = view(spark, sf, "v_cycle_run").select(F.col("run_id").alias("cycle_run_id"), "as_of", "status")
    return I.decision_index(c.select(F.col("as_of").alias("date")), c, view(spark, sf, "v_cycle_ranking"))[1]


@case("sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25")
def sample_rows(spark, sf):
    return M.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 25)


@case("verify_sizes", f"WITH {QSQL}, n AS (SELECT graph, count(*) AS n FROM q GROUP BY 1) SELECT graph, CASE WHEN graph <> 'g:customer:0' THEN CASE WHEN graph = 'g:nation' THEN n + 1 ELSE n END END AS expected, n AS actual, CASE graph WHEN 'g:customer:0' THEN 'extra' WHEN 'g:nation' THEN 'differs' ELSE 'pass' END AS status FROM n UNION ALL SELECT 'g:none', 5, NULL, 'missing'")
def verify_sizes(spark, sf):
    q = quads(spark, sf)
    want = q.filter("graph <> 'g:customer:0'").groupBy("graph").agg(F.count(F.lit(1)).alias("value")).withColumn("value", F.col("value") + (F.col("graph") == "g:nation").cast("bigint"))
    return R.verify_sizes(q, want.unionByName(spark.createDataFrame([("g:none", 5)], "graph string, value bigint")))


@case("check_vocab", "SELECT c_mktsegment AS value, count(*) AS \"rows\" FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 1")
def check_vocab(spark, sf):
    return R.check_vocab(quads(spark, sf), "segment", ["BUILDING", "MACHINERY"])


@case("preflight", "SELECT false AS clear, CAST(0 AS BIGINT) AS to_write, count(DISTINCT date_trunc('quarter', o_orderdate)) AS graphs FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 2 = 0 OR o_orderkey % 5 < 3")
def preflight(spark, sf):
    clear, plan, new = G.preflight(batch(spark, sf), stored(spark, sf), SCHEMA)
    n = plan.agg(F.count(F.lit(1)).alias("graphs"))
    return n.withColumn("clear", F.lit(clear)).withColumn("to_write", F.lit(new.count()))


@case("text_stop_fk", check_sql("stops v_guard_alert", "SELECT k FROM stops WHERE k % 5 = 0"))
def text_stop_fk(spark, sf):
    """Narrator texts of kind stop whose (date, asset) has no stop."""
    s = view(spark, sf, "stops").select("k", "date", "asset_id")
    texts = s.withColumn("date", F.when(F.col("k") % 5 == 0, F.date_add("date", 40000)).otherwise(F.col("date")))
    return I.assert_fk(texts, s.select("date", "asset_id").distinct(), ["date", "asset_id"]).select("k")


@case("profile_alerts", check_sql("v_guard_alert", "SELECT 'alert' AS kind, count(*) AS n FROM v_guard_alert WHERE alert_id % 2 = 0"))
def profile_alerts(spark, sf):
    """Set difference of a re-projected graph against a stored one that lacks half of the alerts."""
    from pitframe.operators.quads import graph_diff
    q = melt(alert_table(spark, sf), E.ALERT).filter("predicate = 'alertId'")
    gone = graph_diff(q, q.filter("CAST(object AS BIGINT) % 2 <> 0"))
    return gone.groupBy(F.lit("alert").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
