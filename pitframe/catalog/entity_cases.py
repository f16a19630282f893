"""Class projections of the derived views: whole graphs, compared by a profile per property.

The checking SQL forms ids and links on its own and melts each class with a generated UNION.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.catalog.registry import case
from pitframe.operators import linking as L
from pitframe.operators.quads import DATATYPES, TYPE, ClassMap, melt
from pitframe.plans import entities as E
from pitframe.plans import projections as P
from pitframe.plans.casebook import check_sql, view
from pitframe.session import spool

LABEL, RUN = "base", 7
PROFILE = "SELECT graph, predicate, object_kind, datatype, count(*) AS n, count(DISTINCT object) AS n_objects, min(subject || ' ' || object) AS lo, max(subject || ' ' || object) AS hi, CAST(sum(CAST('0x' || substr(md5(subject || ' ' || object), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM q GROUP BY 1, 2, 3, 4"


def profile(*quads: DataFrame) -> DataFrame:
    """Per graph and property: triples, distinct objects, first and last pair, and a sum of hashes that every value enters.

    Objects are told apart by 128 bits of hash beside their property's, so that a task holds numbers, not
    texts. ``collect_set`` lets Spark fold the few groups of a task in a hash table, and the filter keeps it in
    the plan; MIN and MAX of texts alone are folded by sorting all quads.
    """
    by = ["graph", "predicate", "object_kind", "datatype"]
    pair = F.concat_ws(" ", "subject", "object")
    q = reduce(DataFrame.unionByName, quads)
    code = F.xxhash64(*by)
    folded = q.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(pair).alias("lo"), F.max(pair).alias("hi"),
        F.sum(F.conv(F.substring(F.md5(pair.cast("binary")), 1, 8), 16, 10).cast("bigint")).alias("digest"), F.collect_set(F.lit(1)).alias("_one")).filter("size(_one) = 1").withColumn("_g", code)
    objects = q.filter("object IS NOT NULL").select(code.alias("_g"), F.xxhash64("object").alias("_a"), F.xxhash64(F.lit("b"), "object").alias("_b")).distinct()
    objects = objects.groupBy("_g").agg(F.count(F.lit(1)).alias("n_objects"))
    return folded.join(objects, "_g", "left").select(*by, "n", F.coalesce("n_objects", F.lit(0).cast("long")).alias("n_objects"), "lo", "hi", "digest")


def _lex(col: str, kind: str) -> str:
    return {
        "integer": f"CAST(CAST({col} AS BIGINT) AS VARCHAR)", "date": f"CAST(CAST({col} AS DATE) AS VARCHAR)", "boolean": f"CAST(CAST({col} AS BOOLEAN) AS VARCHAR)",
        "decimal": f"rtrim(rtrim(CAST(CAST({col} AS DECIMAL(38,18)) AS VARCHAR), '0'), '.')", "dateTime": f"strftime(CAST({col} AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ')",
    }.get(kind, f"CAST({col} AS VARCHAR)")


def melted(mapping: ClassMap, source: str) -> str:
    """SQL melt of a source SELECT holding subject, graph and the mapping's columns."""
    row = "SELECT graph, {s} AS subject, '{p}' AS predicate, {o} AS object, '{k}' AS object_kind, {d} AS datatype FROM ({src})"
    parts = [row.format(s="subject", p=TYPE, o=f"'{mapping.cls}'", k="iri", d="CAST(NULL AS VARCHAR)", src=source)]
    for p in mapping.props:
        src = f'SELECT graph, subject, unnest("{p.column}") AS v FROM ({source})' if p.many else f'SELECT graph, subject, "{p.column}" AS v FROM ({source})'
        iri = p.kind == "iri"
        obj = "CAST(v AS VARCHAR)" if iri else _lex("v", p.kind)
        dt = "CAST(NULL AS VARCHAR)" if iri else f"'{DATATYPES[p.kind]}'"
        parts.append(row.format(s="subject", p=p.name, o=obj, k="iri" if iri else "literal", d=dt, src=src))
        if p.inverse:
            parts.append(row.format(s="CAST(v AS VARCHAR)", p=p.inverse, o="subject", k="iri", d="CAST(NULL AS VARCHAR)", src=src))
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE object IS NOT NULL AND subject IS NOT NULL"


def oracle(names: str, *pairs: tuple[ClassMap, str]) -> str:
    body = " UNION ALL ".join(melted(m, s) for m, s in pairs)
    return check_sql(names, f", q AS ({body}) {PROFILE}")


BK = "(SELECT book_id AS bid, 'Book_base_' || window_id || '_' || arm_code AS book, 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS graph, window_id AS bwin, 'base_' || window_id || '_' || arm_code AS stem FROM v_book)"
AS = "LEFT JOIN (SELECT asset, asset_symbol FROM assets) a ON a.asset_symbol = "
SEL = f"'{LABEL}' AS run_label, 'P7' AS window_id, {RUN} AS backtest_run_id, 'urn:graph:derived:backtest:selection:base:P7:7' AS graph"


def books(spark, sf):
    return P.book_table(view(spark, sf, "v_book"), LABEL)


def assets(spark, sf):
    return view(spark, sf, "assets")


@case("ent_books", oracle("v_book", (E.BOOK, f"SELECT *, NULL AS configuration, '{LABEL}' AS run_label, 'Book_base_' || window_id || '_' || arm_code AS subject, 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS graph FROM v_book")))
def ent_books(spark, sf):
    return profile(melt(P.books(view(spark, sf, "v_book"), LABEL), E.BOOK))


def alert_table(spark, sf):
    return P.alerts(view(spark, sf, "v_guard_alert"), books(spark, sf), view(spark, sf, "rules"), assets(spark, sf), LABEL)


@case("ent_alerts", oracle("v_guard_alert assets v_book", (E.ALERT, f"SELECT v.* EXCLUDE (threshold), CASE WHEN NOT starts_with(rule_id, 'L1_BP_STOP') THEN threshold END AS threshold, 'R_' || rule_id AS rule_iri, a.asset, 'GuardAlert_base_' || window_id || '_' || alert_id AS subject, 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS graph FROM v_guard_alert v {AS} v.ticker")))
def ent_alerts(spark, sf):
    return profile(melt(alert_table(spark, sf), E.ALERT))


@case("ent_rebalances", oracle("v_book_rebalance v_book", (E.REBALANCE, f"SELECT v.*, b.book, b.graph, 'Rebalance_' || stem || '_' || strftime(execution_date, '%Y%m%d') AS subject FROM v_book_rebalance v JOIN {BK} b ON bid = book_id")))
def ent_rebalances(spark, sf):
    return profile(melt(P.rebalances(view(spark, sf, "v_book_rebalance"), books(spark, sf)), E.REBALANCE))


@case("ent_actions", oracle("v_guard_action assets v_book", (E.ACTION, f"SELECT v.*, b.book, b.graph, a.asset, 'GuardAlert_base_' || bwin || '_' || alert_id AS alert, 'GuardAction_' || stem || '_' || action_id AS subject FROM v_guard_action v JOIN {BK} b ON bid = book_id {AS} v.ticker")))
def ent_actions(spark, sf):
    return profile(melt(P.actions(view(spark, sf, "v_guard_action"), books(spark, sf), P.alert_ids(view(spark, sf, "v_guard_alert"), LABEL), assets(spark, sf)), E.ACTION))


@case("ent_weights", oracle("v_book_weight_daily assets v_book", (E.WEIGHT, f"SELECT v.*, b.book, b.graph, a.asset, 'BookWeight_' || stem || '_' || strftime(date, '%Y%m%d') || '_' || holding_key AS subject FROM v_book_weight_daily v JOIN {BK} b ON bid = book_id {AS} v.holding_key")))
def ent_weights(spark, sf):
    return profile(melt(P.weights(view(spark, sf, "v_book_weight_daily"), books(spark, sf), assets(spark, sf)), E.WEIGHT))


@case("ent_performance", oracle("v_book_daily_performance v_book", (E.PERFORMANCE, f"SELECT v.*, b.book, b.graph, 'BookPerf_' || stem || '_' || strftime(date, '%Y%m%d') AS subject FROM v_book_daily_performance v JOIN {BK} b ON bid = book_id")))
def ent_performance(spark, sf):
    return profile(melt(P.performance(view(spark, sf, "v_book_daily_performance"), books(spark, sf)), E.PERFORMANCE))


@case("ent_summaries", oracle("v_portfolio_period_summary v_book", (E.SUMMARY, f"SELECT v.*, b.book, b.graph, 'PeriodSummary_' || stem || '_' || segment AS subject FROM v_portfolio_period_summary v JOIN {BK} b ON bid = book_id")))
def ent_summaries(spark, sf):
    return profile(melt(P.summaries(view(spark, sf, "v_portfolio_period_summary"), books(spark, sf)), E.SUMMARY))


@case("ent_tests", oracle("v_backtest_test", (E.TEST, f"SELECT *, '{LABEL}' AS run_label, 'BacktestTest_base_' || window_id || '_' || backtest_run_id || '_' || segment || '_' || arm_a || '_' || arm_b || '_' || test AS subject, 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS graph FROM v_backtest_test")))
def ent_tests(spark, sf):
    return profile(melt(P.tests(view(spark, sf, "v_backtest_test"), LABEL), E.TEST))


ST = "v.window_id || '_' || substr(v.window_id, 2) || '_'"
SELW = f"'{LABEL}' AS run_label, v.window_id, CAST(substr(v.window_id, 2) AS BIGINT) AS backtest_run_id, 'urn:graph:derived:backtest:selection:base:' || v.window_id || ':' || substr(v.window_id, 2) AS graph"


def every_window():
    """All windows in one call: the window is a column, and the run is its number."""
    return {"window": F.col("window_id"), "run_id": F.expr("CAST(substr(window_id, 2) AS BIGINT)")}


def components(spark, sf, name):
    """Components carry no window of their own; the cycle's number names it."""
    return view(spark, sf, name).withColumn("window_id", F.expr("concat('P', cast(floor(cycle_run_id / 100) - 1990 AS string))"))


@case("ent_cycles", oracle("v_cycle_run", (E.CYCLE, f"SELECT v.* EXCLUDE (window_id), {SELW}, 'cycle_run:' || run_id AS run_text, 'Cycle_base_' || {ST} || run_id AS subject FROM v_cycle_run v")))
def ent_cycles(spark, sf):
    return profile(melt(P.cycles(view(spark, sf, "v_cycle_run"), LABEL, **every_window()), E.CYCLE))


@case("ent_schemes", oracle("v_weight_scheme v_weight_component",
      (E.SCHEME, f"SELECT v.* EXCLUDE (window_id), {SELW}, 'cycle_run:' || cycle_run_id AS run_text, 'Scheme_base_' || {ST} || cycle_run_id AS subject, (SELECT list('Weight_base_' || {ST} || c.cycle_run_id || '_' || score_type) FROM v_weight_component c WHERE c.cycle_run_id = v.cycle_run_id) AS component FROM v_weight_scheme v"),
      (E.CONFIGURED, f"SELECT weight, score_type AS metric, {SELW}, 'Weight_base_' || {ST} || cycle_run_id || '_' || score_type AS subject FROM (SELECT *, 'P' || (cycle_run_id // 100 - 1990) AS window_id FROM v_weight_component) v")))
def ent_schemes(spark, sf):
    s, c = P.schemes(view(spark, sf, "v_weight_scheme"), components(spark, sf, "v_weight_component"), LABEL, **every_window())
    return profile(melt(s, E.SCHEME), melt(c, E.CONFIGURED))


@case("ent_rankings", oracle("v_cycle_ranking v_cycle_ranking_component v_cycle_run assets",
      (E.RANKING, f"SELECT v.* EXCLUDE (window_id), {SELW}, a.asset, r.finished_at, 'Cycle_base_' || {ST} || cycle_run_id AS cycle, 'Scheme_base_' || {ST} || cycle_run_id AS scheme, CAST(blended_score / 100 AS DECIMAL(22,12)) AS score, 'Snap_base_' || {ST} || cycle_run_id || '_' || v.asset_id AS subject, CASE WHEN v.asset_id % 4 > 0 THEN ['RankComp_base_' || {ST} || cycle_run_id || '_' || v.asset_id || '_FUNDAMENTAL', 'RankComp_base_' || {ST} || cycle_run_id || '_' || v.asset_id || '_TECHNICAL'] ELSE ['RankComp_base_' || {ST} || cycle_run_id || '_' || v.asset_id || '_TECHNICAL'] END AS component FROM v_cycle_ranking v JOIN v_cycle_run r ON r.run_id = cycle_run_id AND r.status = 'completed' {AS} v.ticker"),
      (E.EFFECTIVE, f"SELECT v.effective_weight, component_value, score_type AS metric, {SELW}, 'RankComp_base_' || {ST} || cycle_run_id || '_' || asset_id || '_' || score_type AS subject FROM (SELECT *, 'P' || (cycle_run_id // 100 - 1990) AS window_id FROM v_cycle_ranking_component) v JOIN (SELECT run_id, status FROM v_cycle_run) r ON r.run_id = cycle_run_id AND r.status = 'completed'")))
def ent_rankings(spark, sf):
    r, c = P.rankings(view(spark, sf, "v_cycle_ranking"), view(spark, sf, "v_cycle_run"), components(spark, sf, "v_cycle_ranking_component"), assets(spark, sf), LABEL, **every_window())
    return profile(melt(r, E.RANKING), melt(c, E.EFFECTIVE))


@case("ent_vetoes", oracle("v_veto v_cycle_run assets", (E.VETO, f"SELECT v.* EXCLUDE (window_id), {SELW}, a.asset, 'R_' || rule_id AS rule_iri, 'cycle_run:' || v.run_id AS run_text, r.as_of AS run_as_of, 'Veto_base_' || {ST} || id AS subject FROM v_veto v LEFT JOIN v_cycle_run r ON r.run_id = v.run_id {AS} v.ticker")))
def ent_vetoes(spark, sf):
    v = P.vetoes(view(spark, sf, "v_veto"), view(spark, sf, "v_cycle_run"), view(spark, sf, "rules"), assets(spark, sf), "1997-12-31", LABEL, **every_window())
    return profile(melt(v, E.VETO))


@case("ent_scores", oracle("filings", (E.SCORE, "SELECT *, lane AS score_type, CASE lane WHEN 'FUNDAMENTAL' THEN 'ScoreFinanciero' ELSE 'ScoreTecnico' END AS metric_type, CAST(available_at AS TIMESTAMP) AS computed_at, period_end AS event_time, roic AS raw_value, CASE WHEN lane = 'TECHNICAL' THEN CAST((100 - mk % 101) / 100.0 AS DECIMAL(22,12)) END AS risk, ticker AS asset, 'Score_' || lane || '_' || ticker || '_' || filing_id AS subject, CASE lane WHEN 'FUNDAMENTAL' THEN 'urn:graph:ingest:FUNDAMENTAL:' || year(available_at) || '-Q' || quarter(available_at) ELSE 'urn:graph:ingest:TECHNICAL:1999-01-01' END AS graph FROM (SELECT *, CASE WHEN mk % 2 = 0 THEN 'FUNDAMENTAL' ELSE 'TECHNICAL' END AS lane FROM filings)")))
def ent_scores(spark, sf):
    f = view(spark, sf, "filings")
    rows = f.select(F.when(F.col("mk") % 2 == 0, "FUNDAMENTAL").otherwise("TECHNICAL").alias("score_type"), "ticker", F.col("filing_id").alias("id"), F.col("available_at").cast("timestamp").alias("computed_at"),
                    F.col("period_end").alias("event_time"), "available_at", F.col("roic").alias("raw_value"), (F.col("mk") % 101).alias("normalized_score"))
    return profile(melt(P.scores(rows, "1999-01-01"), E.SCORE))


@case("ent_ticker_history", oracle("stints assets", (E.TICKER_HISTORY, "SELECT s.*, upper(symbol) AS canonical_symbol, 'http://e/' || symbol AS evidence_url, CASE WHEN ends_with(symbol, '1') THEN CAST(valid_from AS DATE) END AS evidence_day, 'rename' AS rules, coalesce(a.asset, u.asset) AS asset, 'TickerHistory_base_2001-01-01_' || cik || '_' || symbol || '_' || valid_from AS subject, 'urn:graph:derived:ticker-history:base:2001-01-01' AS graph FROM stints s LEFT JOIN assets a ON a.asset_symbol = s.symbol LEFT JOIN (SELECT asset_cik, min(asset) AS asset FROM assets GROUP BY 1 HAVING count(*) = 1) u ON u.asset_cik = s.cik")))
def ent_ticker_history(spark, sf):
    s = view(spark, sf, "stints").withColumn("canonical_symbol", F.col("symbol")).withColumn("evidence_url", F.concat(F.lit("http://e/"), F.col("symbol"))).withColumn("rules", F.lit("rename"))
    day = F.col("valid_from").cast("string")
    s = s.withColumn("evidence_date", F.when(F.col("symbol").endswith("1"), day).when(F.col("symbol").endswith("2"), F.concat_ws(";", day, day)))
    return profile(melt(P.ticker_history(s, assets(spark, sf), LABEL, "2001-01-01"), E.TICKER_HISTORY))


@case("ent_orchestrator", oracle("v_cycle_run v_cycle_ranking",
      (E.ORCHESTRATOR_RUN, "SELECT *, 'h' || run_id AS handle, cycle_type AS kind, '{}' AS settings_json, NULL AS surface, 'OrchestratorRun_base_' || run_id AS subject, 'urn:graph:derived:orchestrator:base:' || run_id AS graph FROM v_cycle_run"),
      (E.ORCHESTRATOR_STEP, "SELECT 'OrchestratorRun_base_' || cycle_run_id AS run, asset_id AS ordinal, NULL AS handle, ticker AS step, status, 'rank' AS run_kind, veto_rules_json AS reason, NULL AS argv_json, NULL AS output_tail, NULL AS started_at, NULL AS finished_at, vetoed AS exit_code, 'rank:' || rank AS run_text, 'OrchestratorStep_base_' || cycle_run_id || '_' || asset_id AS subject, 'urn:graph:derived:orchestrator:base:' || cycle_run_id AS graph FROM v_cycle_ranking")))
def ent_orchestrator(spark, sf):
    r = view(spark, sf, "v_cycle_run").withColumn("handle", F.concat(F.lit("h"), F.col("run_id").cast("string"))).withColumn("kind", F.col("cycle_type")).withColumn("settings_json", F.lit("{}")).withColumn("surface", F.lit(None).cast("string"))
    none = lambda t="string": F.lit(None).cast(t)
    s = view(spark, sf, "v_cycle_ranking").select(F.col("cycle_run_id").alias("orchestrator_run_id"), none().alias("handle"), F.col("asset_id").alias("ordinal"), F.col("ticker").alias("step"), "status", none("timestamp").alias("started_at"), none("timestamp").alias("finished_at"),
                                                  F.col("vetoed").alias("exit_code"), F.lit("rank").alias("run_kind"), F.col("rank").alias("run_id"), F.col("veto_rules_json").alias("reason"), none().alias("argv_json"), none().alias("output_tail"))
    a, b = P.orchestrator(r, s, LABEL)
    return profile(melt(a, E.ORCHESTRATOR_RUN), melt(b, E.ORCHESTRATOR_STEP))


@case("ent_universe", oracle("stints", (E.MEMBERSHIP, "SELECT symbol AS asset, 'Universe' AS universe, valid_from, valid_to, 'UM_' || symbol || '_' || valid_from AS subject, 'urn:graph:universe:2001-Q2' AS graph FROM stints s")))
def ent_universe(spark, sf):
    s = view(spark, sf, "stints")
    lines = s.select("cik", F.col("symbol").alias("asset_symbol"), F.lit("mixed").alias("pattern")).distinct()
    ind = s.select(F.col("gics_sub_industry").alias("sub_industry")).distinct().withColumn("industry", F.col("sub_industry"))
    _, m = P.universe(s, lines, ind, "2001-05-05")
    return profile(melt(m, E.MEMBERSHIP))


@case("ent_universe_assets", oracle("stints", (E.ASSET, """SELECT s.symbol AS asset_symbol, security AS company_name, cik, gics_sub_industry AS industry, symbol AS subject, 'urn:graph:universe:2001-Q2' AS graph FROM
      (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY valid_from DESC) AS r FROM stints) s WHERE r = 1""")))
def ent_universe_assets(spark, sf):
    s = view(spark, sf, "stints")
    lines = L.resolve_entities(s).filter("pattern <> 'succession'")
    ind = s.select(F.col("gics_sub_industry").alias("sub_industry")).distinct().withColumn("industry", F.col("sub_industry"))
    a, _ = P.universe(s, lines, ind, "2001-05-05")
    return profile(melt(a, E.ASSET))


@case("ent_fundamentals", oracle("filings assessments assets",
      (E.FILING, f"SELECT f.*, a.asset, 'Filing_base_' || filing_id AS subject, 'urn:graph:derived:fundamentals:base' AS graph FROM filings f {AS} f.ticker"),
      (E.METRIC_SET, "SELECT " + ", ".join(f"NULL AS {m}" for m in E.METRICS if m not in ("return_on_invested_capital", "debt_to_equity")) + ", roic AS return_on_invested_capital, debt AS debt_to_equity, 'Filing_base_' || filing_id AS filing, available_at, CAST(filing_date AS TIMESTAMP) + INTERVAL 8 HOUR AS computed_at, 'metrics-1' AS engine_version, 'MetricSet_base_' || filing_id AS subject, 'urn:graph:derived:fundamentals:base' AS graph FROM filings"),
      (E.ASSESSMENT, f"SELECT s.*, a.asset, 'Filing_base_' || filing_id AS filing, ['good', rating] AS strengths, [narrative] AS risks, 'Assessment_base_' || snapshot_id AS subject, 'urn:graph:derived:fundamentals:base' AS graph FROM assessments s {AS} s.ticker")))
def ent_fundamentals(spark, sf):
    a = view(spark, sf, "assessments").withColumn("strengths", F.array(F.lit("good"), F.col("rating"))).withColumn("risks", F.array("narrative"))
    out = P.fundamentals(view(spark, sf, "filings").drop("cik"), view(spark, sf, "metrics"), a, view(spark, sf, "mask"), assets(spark, sf), LABEL, "metrics-1")
    return profile(melt(out["filings"], E.FILING), melt(out["metric_sets"], E.METRIC_SET), melt(out["assessments"], E.ASSESSMENT))


@case("ent_mask", check_sql("mask assets", "SELECT a.asset AS subject, 'pricesNotPublished' AS predicate, 'true' AS object FROM mask JOIN assets a ON a.asset_symbol = ticker"))
def ent_mask(spark, sf):
    a = view(spark, sf, "assessments").withColumn("strengths", F.array("rating")).withColumn("risks", F.array("narrative"))
    out = P.fundamentals(view(spark, sf, "filings").drop("cik"), view(spark, sf, "metrics"), a, view(spark, sf, "mask"), assets(spark, sf), LABEL, "metrics-1")
    return out["mask"].filter("subject IS NOT NULL").select("subject", "predicate", "object")


@case("fundamentals_problems", check_sql("filings metrics assessments mask", """SELECT filing_id, 'metric of no filing' AS problem FROM metrics WHERE filing_id % 10 = 4 UNION ALL SELECT filing_id, 'assessment of no filing' FROM assessments WHERE filing_id % 10 = 4
    UNION ALL SELECT filing_id, 'valuation of a masked asset' FROM filings WHERE filing_id % 10 <> 4 AND ticker IN (SELECT ticker FROM mask)"""))
def fundamentals_problems(spark, sf):
    f = view(spark, sf, "filings").filter("filing_id % 10 <> 4")
    return P.fundamentals_problems(f, view(spark, sf, "metrics"), view(spark, sf, "assessments"), view(spark, sf, "mask"))


@case("ent_news", oracle("filings assets", (E.NEWS_ITEM, f"SELECT 'r1' AS model_revision, CASE WHEN mk % 2 = 0 THEN 'body' ELSE 'sub_news' END AS item_kind, 'i' || mk AS item_id, ticker, asset_id, filing_date AS date, 'pub' AS date_source, accession_number AS title, form AS text, 'body' AS text_source, 'positive' AS sentiment, roic AS sentiment_score, roic AS p_positive, roic AS p_negative, roic AS p_neutral, 's1' AS sentiment_revision, 'legal' AS category, roic AS category_score, 'g' AS group_label, 'c1' AS category_revision, CASE WHEN mk % 2 <> 0 THEN filing_id END AS article_id, CASE WHEN mk % 2 <> 0 THEN 'example.org' END AS source_domain, 'h' || mk AS body_hash, NULL AS url, a.asset, 'NewsItem_' || CASE WHEN mk % 2 = 0 THEN 'body' ELSE 'sub_news' END || '_i' || mk || '_' || ticker AS subject, 'urn:graph:derived:news:base:' || fiscal_year AS graph FROM filings f {AS} f.ticker")))
def ent_news(spark, sf):
    f = view(spark, sf, "filings")
    lit = F.lit
    k = F.col("mk").cast("string")
    n = f.select(lit("r1").alias("model_revision"), F.when(F.col("mk") % 2 == 0, "body").otherwise("sub_news").alias("item_kind"), F.concat(lit("i"), k).alias("item_id"), "ticker", "asset_id", F.col("filing_date").alias("date"), lit("pub").alias("date_source"),
                 F.col("accession_number").alias("title"), F.col("form").alias("text"), lit("body").alias("text_source"), lit("positive").alias("sentiment"), *[F.col("roic").alias(c) for c in ("sentiment_score", "p_positive", "p_negative", "p_neutral", "category_score")],
                 lit("s1").alias("sentiment_revision"), lit("legal").alias("category"), lit("g").alias("group_label"), lit("c1").alias("category_revision"), F.col("filing_id").alias("article_id"), lit("example.org").alias("source_domain"), F.concat(lit("h"), k).alias("body_hash"),
                 lit(None).cast("string").alias("url"), F.col("fiscal_year").cast("string").alias("period"))
    n = P.with_asset(n, assets(spark, sf))
    return profile(melt(P.news_items(n, LABEL), E.NEWS_ITEM))


@case("ent_series", oracle("v_book_daily_performance v_book_weight_daily",
      (E.DAILY_SERIES, "SELECT gross_return, net_return, turnover, cost_return AS cost, cash_weight, CAST(NULL AS DECIMAL(18,8)) AS daily_total_return, CAST(NULL AS DECIMAL(18,8)) AS value, window_id AS \"window\", date, 'Configuration_markowitz_mv' AS configuration, 'DailySeries_base_markowitz_mv_' || window_id || '_' || date AS subject, 'urn:graph:derived:backtest:series:base:markowitz_mv' AS graph FROM v_book_daily_performance WHERE arm_code = 'MARKOWITZ_BASE'"),
      (E.SERIES_WEIGHT, "SELECT 'P' || (book_id // 10) AS \"window\", date AS decision_date, asset_id, final_target_weight AS weight, 'Configuration_markowitz_mv' AS configuration, 'SeriesWeight_base_P' || (book_id // 10) || '_' || date || '_' || asset_id AS subject, 'urn:graph:derived:backtest:series:base:markowitz_mv' AS graph FROM v_book_weight_daily WHERE arm_code = 'MARKOWITZ_BASE' AND asset_id IS NOT NULL")))
def ent_series(spark, sf):
    d = view(spark, sf, "v_book_daily_performance").filter("arm_code = 'MARKOWITZ_BASE'").select(F.col("window_id").alias("window"), "date", "gross_return", "net_return", "turnover", F.col("cost_return").alias("cost"), "cash_weight")
    w = view(spark, sf, "v_book_weight_daily").filter("arm_code = 'MARKOWITZ_BASE' AND asset_id IS NOT NULL").select(
        F.concat(F.lit("P"), F.floor(F.col("book_id") / 10).cast("string")).alias("window"), F.col("date").alias("decision_date"), "asset_id", F.col("final_target_weight").alias("weight"))
    a, b = P.series(d, w, LABEL, "markowitz_mv")
    return profile(melt(a, E.DAILY_SERIES), melt(b, E.SERIES_WEIGHT))


@case("ent_aggregates", oracle("trend reference_returns",
      (E.TREND_STATE, "SELECT *, 'base' AS run_label, spy_vs_sma210 AS state, ['A1', 'A2'] AS arms, 'AggregatesSet_base' AS \"set\", 'TrendFilter_base_' || \"window\" || '_' || decision_date AS subject, 'urn:graph:derived:backtest:aggregates:base' AS graph FROM trend"),
      (E.REFERENCE_RETURN, "SELECT *, 'base' AS run_label, 'AggregatesSet_base' AS \"set\", 'ReferenceReturn_base_' || segment || '_' || reference AS subject, 'urn:graph:derived:backtest:aggregates:base' AS graph FROM reference_returns")))
def ent_aggregates(spark, sf):
    src = view(spark, sf, "trend").limit(1).select(F.lit("f").alias("source_file"), F.lit("s").alias("source_sha256"), F.lit("c").alias("config_id"))
    _, t, r = P.aggregates(view(spark, sf, "trend"), view(spark, sf, "reference_returns"), src, LABEL, ["A1", "A2"])
    return profile(melt(t, E.TREND_STATE), melt(r, E.REFERENCE_RETURN))


@case("ent_external", oracle("v_portfolio_period_summary v_book", (E.SUMMARY, "SELECT s.* EXCLUDE (book_id, arm_code, knowledge_date), e.bid AS book_id, 'MARKOWITZ_MV' AS arm_code, date_to AS knowledge_date, 'Book_base_' || s.window_id || '_MARKOWITZ_MV' AS book, 'PeriodSummary_base_' || s.window_id || '_MARKOWITZ_MV_' || segment AS subject, 'urn:graph:derived:backtest:external:base' AS graph FROM v_portfolio_period_summary s JOIN (SELECT window_id, max(book_id) + 1 AS bid FROM v_book GROUP BY 1) e ON e.window_id = s.window_id WHERE s.arm_code = 'MARKOWITZ_BASE'"),
      (E.BOOK, "SELECT e.bid AS book_id, s.backtest_run_id, 'base' AS run_label, s.window_id, date_from AS d_start, date_to AS d_end, 'completed' AS run_status, 'MARKOWITZ_MV' AS arm_code, 'mv' AS objective, false AS exclude_hard_vetoed, NULL AS guard_layers, NULL AS configuration, NULL AS formation_date, NULL AS code_version, date_to AS knowledge_date, 'Book_base_' || s.window_id || '_MARKOWITZ_MV' AS subject, 'urn:graph:derived:backtest:external:base' AS graph FROM v_portfolio_period_summary s JOIN (SELECT window_id, max(book_id) + 1 AS bid FROM v_book GROUP BY 1) e ON e.window_id = s.window_id WHERE s.arm_code = 'MARKOWITZ_BASE' AND segment = s.window_id")))
def ent_external(spark, sf):
    s = view(spark, sf, "v_portfolio_period_summary").filter("arm_code = 'MARKOWITZ_BASE'").withColumnRenamed("window_id", "window").drop("book_id", "backtest_run_id", "arm_code", "knowledge_date")
    e = view(spark, sf, "v_book").groupBy(F.col("window_id").alias("window")).agg(F.max("book_id").alias("max_book_id"), F.max("backtest_run_id").alias("run_id"))
    b, m = P.external_summary(s, e, LABEL, "MARKOWITZ_MV", "mv")
    return profile(melt(m, E.SUMMARY), melt(b, E.BOOK))


@case("ent_metadata", oracle("v_book", (E.BACKTEST_RUN, "SELECT DISTINCT 'base' AS run_label, window_id, NULL AS configuration, backtest_run_id, 'base_' || window_id || '.db' AS source_file, 'h' || window_id AS source_sha256, DATE '2001-01-01' AS knowledge_date, 'RunConfiguration_base' AS run_configuration, 'BacktestRun_base_' || window_id AS subject, 'urn:graph:derived:backtest:meta:base' AS graph FROM v_book")))
def ent_metadata(spark, sf):
    r = view(spark, sf, "v_book").select("window_id", F.lit(None).cast("string").alias("configuration"), "backtest_run_id").distinct()
    r = r.withColumn("source_file", F.concat(F.lit("base_"), "window_id", F.lit(".db"))).withColumn("source_sha256", F.concat(F.lit("h"), "window_id")).withColumn("knowledge_date", F.lit("2001-01-01").cast("date"))
    c = r.limit(1).select(*[F.lit("x").alias(n) for n in ("code_commit", "pr", "results_doc", "config_id", "status", "body")])
    _, runs = P.run_metadata(r, c, LABEL)
    return profile(melt(runs, E.BACKTEST_RUN))


# --- audit-log events as they arrive: nested lines built from the derived views ---


def event_lines(spark, sf):
    """Stop lines with menu, choice and counts; ``stem`` names label, window and book."""
    s = view(spark, sf, "stops")
    k = F.col("k")
    opt = lambda ident, spy, cash: F.struct(ident.alias("asset_id"), spy.alias("is_spy"), cash.alias("cash"), F.lit(0.1).alias("rho"), F.lit(0.2).alias("r"), F.lit(1.0).alias("beta"), (k % 20).alias("rank"), F.lit(0.5).alias("score"), (k % 11).alias("sector"), F.lit(1.0).alias("size_fraction"), F.col("weight_before").alias("weight"))
    false = F.lit(False)
    menu = F.array(opt(F.col("chosen_id"), F.col("spy"), false), opt(F.lit(None).cast("bigint"), false, F.lit(True)), opt(F.col("chosen_id") + 1000, false, false))
    chosen = F.struct(F.when(~F.col("cash"), F.col("chosen_id")).alias("asset_id"), F.when(F.col("cash"), True).alias("cash"))
    return s.select(
        F.concat(F.lit("base_"), "win", F.lit("_"), "arm").alias("stem"), F.concat(F.lit("Book_base_"), "win", F.lit("_"), "arm").alias("book"), F.concat(F.lit("urn:graph:derived:backtest:base:"), "win", F.lit(":"), F.lower("arm")).alias("graph"),
        "k", "date", "asset_id", "weight_before", (k % 2 == 0).alias("filter"), F.col("date").alias("filter_decision"), F.lit(1).alias("scale"), F.lit(0.5).alias("rho_w0"), F.lit(0.4).alias("rho"), "chooser", F.lit(0).alias("cash_left"),
        F.struct(F.lit(True).alias("passed")).alias("portfolio_check"), "cause", F.lit(3).alias("eligible"), *[F.lit(None).cast("int").alias(c) for c in ("zone_evaluated", "zone_pass")], *[F.lit(None).cast("double").alias(c) for c in ("a_star", "size_fraction", "weight_after_e3")],
        F.struct(*[F.lit(v).alias(n) for n, v in (("min", 0.1), ("median", 0.2), ("max", 0.3))]).alias("rho_delta"), chosen.alias("chosen"), menu.alias("menu"),
        F.create_map(F.lit("held"), (k % 3).cast("int"), F.lit("zone_evaluated"), F.lit(4), F.lit("NO_ALLOWED_DESTINATION"), (k % 2).cast("int")).alias("eligible_counts"))


EV = "(SELECT *, 'base_' || win || '_' || arm AS stem, 'Book_base_' || win || '_' || arm AS book, 'urn:graph:derived:backtest:base:' || win || ':' || lower(arm) AS graph, 'Stop_base_' || win || '_' || arm || '_' || date || '_' || asset_id AS stop, 'StopOption_base_' || win || '_' || arm || '_' || date || '_' || asset_id || '_' AS opt FROM stops)"
IDS = "LEFT JOIN (SELECT asset AS ast, asset_id AS aid FROM assets) i ON i.aid = "


@case("ent_stops", oracle("stops assets",
      (E.STOP, f"SELECT e.*, i.ast AS asset, k % 2 = 0 AS filter, date AS filter_decision, 1 AS scale, 0.5 AS rho_w0, 0.4 AS rho, 0 AS cash_left, true AS check_passed, 3 AS eligible, NULL AS zone_evaluated, NULL AS zone_pass, CAST(NULL AS DOUBLE) AS a_star, CAST(NULL AS DOUBLE) AS size_fraction, CAST(NULL AS DOUBLE) AS weight_after_e3, 0.1 AS rho_delta_min, 0.2 AS rho_delta_median, 0.3 AS rho_delta_max, CASE WHEN cash THEN true END AS chosen_cash, CASE WHEN NOT cash THEN opt || '1' END AS chosen_option, stop AS subject FROM {EV} e {IDS} e.asset_id"),
      (E.OPTION, f"SELECT e.graph, e.stop, i.ast AS asset, CASE WHEN p = 1 THEN spy ELSE false END AS is_spy, 0.1 AS rho, 0.2 AS r, 1.0 AS beta, k % 20 AS rank, 0.5 AS score, k % 11 AS sector, 1.0 AS size_fraction, weight_before AS weight, p AS position, opt || p AS subject FROM {EV} e JOIN (SELECT unnest([1, 2]) AS p) ON true {IDS} e.chosen_id + (p - 1) * 1000"),
      (E.STOP_SUMMARY, f"SELECT graph, stop, " + ", ".join(f"NULL AS rejected_{c}" for c in map(str.lower, E.STOP_CAUSES) if c not in ("held", "no_allowed_destination")) + f", CASE WHEN k % 3 > 0 THEN k % 3 END AS rejected_held, CASE WHEN k % 2 > 0 THEN 1 END AS rejected_no_allowed_destination, 'StopSummary_' || substr(stop, 6) AS subject FROM {EV} e")))
def ent_stops(spark, sf):
    out = P.stops(event_lines(spark, sf), assets(spark, sf))
    return profile(melt(out["stops"], E.STOP), melt(out["options"], E.OPTION), melt(out["summaries"], E.STOP_SUMMARY))


@case("stop_problems", check_sql("stops", "SELECT stem, date, asset_id, 'no alert' AS problem FROM " + EV + " WHERE k % 8 <> 0"))
def stop_problems(spark, sf):
    # an asset's stops of one day are told apart by their order
    s = event_lines(spark, sf).withColumn("asset_id", F.concat_ws("/", F.col("asset_id").cast("string"), F.col("k").cast("string")))
    out = P.stop_problems(s, s.filter("k % 8 = 0").select("stem", "date", "asset_id"))
    return out.withColumn("asset_id", F.substring_index("asset_id", "/", 1).cast("bigint"))


@case("ent_memories", oracle("memories stops assets", (E.MEMORY, f"SELECT m.*, i.ast AS asset, 'Book_base_' || m.win || '_x' AS book, 'g' AS graph, 'StopMemory_base_' || m.win || '_x_' || m.asset_id || '_' || since AS subject FROM memories m {IDS} m.asset_id")))
def ent_memories(spark, sf):
    m = view(spark, sf, "memories").withColumn("stem", F.concat(F.lit("base_"), "win", F.lit("_x"))).withColumn("book", F.concat(F.lit("Book_base_"), "win", F.lit("_x"))).withColumn("graph", F.lit("g"))
    return profile(melt(P.memories(m, assets(spark, sf)), E.MEMORY))


@case("ent_replacements", check_sql("purchases stops", """SELECT 'purchase' AS kind, count(*) AS n, count(DISTINCT p.k) AS matched FROM purchases p
    UNION ALL SELECT 'violation', count(*), 0 FROM (SELECT p.win, p.order_date, p.asset_id FROM purchases p JOIN stops s ON s.win = p.win AND s.date = p.order_date AND s.chosen_id = p.asset_id AND NOT s.cash GROUP BY p.k, p.win, p.order_date, p.asset_id HAVING count(*) <> 1)"""))
def ent_replacements(spark, sf):
    lines = event_lines(spark, sf).withColumn("stem", F.regexp_extract("stem", r"^(base_P\d+)", 1))
    b = view(spark, sf, "purchases").withColumn("stem", F.concat(F.lit("base_"), "win")).withColumn("graph", F.lit("g"))
    b = b.withColumn("machine_entry_session", F.col("execution_date")).withColumn("size_fraction", F.lit(1.0)).withColumn("bucket", F.lit("b")).withColumn("filter", F.lit(True)).withColumn("filter_decision", F.col("order_date"))
    checks = b.select("stem", "graph", "asset_id", F.col("execution_date").alias("date"), F.lit(True).alias("candidate"), F.lit(False).alias("kept")).distinct()
    halts = b.filter("k % 5 = 0").select("stem", "asset_id", F.col("execution_date").alias("date"))
    out = P.replacements(b, checks, halts, lines, assets(spark, sf))
    n = out["purchases"].agg(F.lit("purchase").alias("kind"), F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("matched"))
    return n.unionByName(out["violations"].agg(F.lit("violation").alias("kind"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("matched")))


def retention_lines(spark, sf):
    """One line per decision and block of 20 asset ids, its retained and rejected assets as arrays."""
    block = F.floor(F.col("asset_id") / 20).cast("string")
    r = view(spark, sf, "retained").withColumn("stem", F.concat_ws("_", F.lit("base"), F.col("book_id").cast("string"), block))
    item = F.struct("asset_id", "counter", "cause")
    lines = r.groupBy("stem", "date").agg(F.array_sort(F.collect_list(F.when(F.col("kept"), item))).alias("retained"), F.array_sort(F.collect_list(F.when(~F.col("kept"), item))).alias("rejected"),
                                          F.array_sort(F.collect_list(F.when(~F.col("kept") & (F.col("cause") == "counter"), F.col("asset_id")))).alias("counter_dropped"), F.count(F.lit(1)).alias("pool_size"))
    ids = F.transform("retained", lambda x: x["asset_id"])
    return lines.select("stem", F.concat(F.lit("B_"), "stem").alias("book"), F.lit("g").alias("graph"), "date", F.struct("pool_size", ids.alias("held_outside"), "retained", "rejected", "counter_dropped", ids.alias("kept"), F.lit(0.5).alias("kept_weight"), F.col("pool_size").alias("candidate_size"), F.lit(3).alias("max_decisions"), F.lit(True).alias("enabled")).alias("retention"))


RL = "(SELECT *, 'base_' || book_id || '_' || (asset_id // 20) AS stem FROM retained)"


@case("ent_retentions", oracle("retained assets",
      (E.RETENTION, f"SELECT 'g' AS graph, 'B_' || stem AS book, date, 'Decision_' || stem || '_' || date AS decision, count(*) AS pool_size, count(*) FILTER (kept) AS held_outside_pool_count, count(*) FILTER (kept) AS retained_count, count(*) FILTER (NOT kept) AS rejected_count, count(*) FILTER (NOT kept AND cause = 'counter') AS counter_dropped_count, count(*) FILTER (kept) AS kept_count, 0.5 AS kept_weight, count(*) AS candidate_set_size, 3 AS max_decisions, true AS enabled, list(asset_id) FILTER (NOT kept AND cause = 'counter') AS dropped, 'Retention_' || stem || '_' || date AS subject FROM {RL} GROUP BY stem, date"),
      (E.HOLD, f"SELECT 'g' AS graph, 'Retention_' || stem || '_' || date AS decision, i.ast AS asset, counter, 'Snap_' || stem || '_' || strftime(date, '%Y%m%d') || '_' || asset_id AS snapshot, 'RetentionHold_' || stem || '_' || date || '_' || asset_id AS subject FROM {RL} r {IDS} r.asset_id WHERE kept"),
      (E.REJECTION, f"SELECT 'g' AS graph, 'Retention_' || stem || '_' || date AS decision, i.ast AS asset, counter, cause, 'Snap_' || stem || '_' || strftime(date, '%Y%m%d') || '_' || asset_id AS snapshot, 'RetentionRejection_' || stem || '_' || date || '_' || asset_id AS subject FROM {RL} r {IDS} r.asset_id WHERE NOT kept")))
def ent_retentions(spark, sf):
    out = P.retentions(retention_lines(spark, sf), assets(spark, sf), True)
    return profile(melt(out["retentions"], E.RETENTION), melt(out["holds"], E.HOLD), melt(out["rejections"], E.REJECTION))


@case("ent_decisions", check_sql("retained decisions", f"""SELECT r.stem, r.date, count(*) AS pool, count(*) FILTER (NOT kept) AS refilled, count(*) <> count(*) FILTER (kept) + 1 AS mismatch FROM {RL} r GROUP BY 1, 2"""))
def ent_decisions(spark, sf):
    lines = retention_lines(spark, sf)
    every = F.transform(F.concat("retention.retained", "retention.rejected"), lambda x: x["asset_id"])
    lines = lines.select("stem", "book", "graph", "date", F.lit(True).alias("filter"), F.col("date").alias("filter_decision"), F.lit(0.5).alias("core_weight_in_force"), F.lit(1.0).alias("scale"), every.alias("candidate_ids"), F.array().cast("array<bigint>").alias("blocked"), "retention")
    pools = lines.select("stem", "date", F.lit("C").alias("cycle"), F.lit("R").alias("rebalance"), F.concat(F.transform("retention.retained", lambda x: x["asset_id"]), F.array(F.lit(-1).cast("bigint"))).alias("selected"))
    t, off = P.decisions(lines, pools)
    m = off.withColumn("mismatch", F.lit(True))
    t = t.withColumn("stem", F.regexp_extract("subject", r"Decision_(base_\d+_\d+)_", 1)).select("stem", F.col("decisionDate").alias("date"), F.col("candidateSetSize").alias("pool"), F.size("refilledCandidate").alias("refilled"))
    return t.join(m, ["stem", "date"], "left").withColumn("mismatch", F.coalesce("mismatch", F.lit(False)))


@case("child_problems", check_sql("v_guard_action v_book", "SELECT action_id, CASE WHEN book_id % 10 = 5 THEN 'orphan' ELSE 'disagrees: arm_code' END AS violation FROM v_guard_action WHERE book_id % 10 = 5 OR action_id % 11 = 0"))
def child_problems(spark, sf):
    a = view(spark, sf, "v_guard_action").withColumn("arm_code", F.when(F.col("action_id") % 11 == 0, "OTHER").otherwise(F.col("arm_code")))
    return P.child_problems(a, view(spark, sf, "v_book").filter("book_id % 10 <> 5"), "action_id")


@case("alert_problems", check_sql("v_guard_alert", "SELECT alert_id, 'run or window' AS problem FROM v_guard_alert WHERE window_id = 'P5' UNION ALL SELECT alert_id, CASE WHEN rule_id LIKE '%REENTRY' THEN 'rule: orphan' ELSE 'rule: disagrees: guard_layer' END FROM v_guard_alert WHERE rule_id LIKE '%REENTRY' OR rule_id LIKE '%BLOCKED'"))
def alert_problems(spark, sf):
    r = view(spark, sf, "rules").filter("category = 'GUARD' AND NOT rule_id LIKE '%REENTRY'").withColumn("guard_layer", F.when(F.col("rule_id").endswith("BLOCKED"), 9).otherwise(F.col("guard_layer")))
    return P.alert_problems(view(spark, sf, "v_guard_alert"), view(spark, sf, "v_book").filter("window_id <> 'P5'"), r)


@case("skipped_rankings", check_sql("v_cycle_ranking v_cycle_run v_cycle_ranking_component", "SELECT 'run is not completed' AS reason, count(*) AS \"rows\" FROM v_cycle_ranking JOIN v_cycle_run ON run_id = cycle_run_id WHERE v_cycle_run.status <> 'completed' UNION ALL SELECT 'ranking row not projected', count(*) FROM v_cycle_ranking_component JOIN v_cycle_run ON run_id = cycle_run_id WHERE status <> 'completed'"))
def skipped_rankings(spark, sf):
    return P.skipped_rankings(view(spark, sf, "v_cycle_ranking"), view(spark, sf, "v_cycle_run"), view(spark, sf, "v_cycle_ranking_component"))


@case("control_group1", check_sql("v_guard_alert v_guard_action v_book_rebalance v_book_daily_performance v_book_weight_daily v_portfolio_period_summary v_book", """
    , al AS (SELECT DISTINCT a.backtest_run_id, a.rule_id, a.alert_id FROM v_guard_alert a JOIN v_guard_action x ON x.alert_id = a.alert_id AND x.backtest_run_id = a.backtest_run_id), g AS (SELECT DISTINCT backtest_run_id FROM v_book),
      f AS (SELECT *, row_number() OVER (PARTITION BY backtest_run_id ORDER BY segment, annualized_return) AS r FROM v_portfolio_period_summary WHERE arm_code = 'MARKOWITZ_BASE')
    SELECT g.backtest_run_id, 'alerts_by_rule' AS key, k AS subkey, CAST(count(alert_id) AS DOUBLE) AS value FROM g JOIN (SELECT unnest(['L0_CARTERA_ACTIVATION', 'L0_CARTERA_RECOVERY', 'L0_CARTERA_SCALE_CHANGE', 'L1_BP_REENTRY', 'L1_BP_STOP', 'L1_BP_STOP_BLOCKED']) AS k) ON true LEFT JOIN al ON al.backtest_run_id = g.backtest_run_id AND rule_id = k GROUP BY 1, 2, 3
    UNION ALL SELECT backtest_run_id, 'actions_by_status', k, count(*) FILTER (status = k) FROM v_guard_action, (SELECT unnest(['APPLIED', 'BLOCKED']) AS k) GROUP BY 1, 2, 3 UNION ALL SELECT backtest_run_id, 'rebalances', '', count(*) FROM v_book_rebalance GROUP BY 1 UNION ALL SELECT backtest_run_id, 'daily_rows', '', count(*) FROM v_book_daily_performance GROUP BY 1
    UNION ALL SELECT backtest_run_id, 'weight_daily_rows', '', count(*) FROM v_book_weight_daily GROUP BY 1 UNION ALL SELECT backtest_run_id, 'final_values', 'cumulative_return', cumulative_return FROM f WHERE r = 1 UNION ALL SELECT backtest_run_id, 'final_values', 'annualized_return', annualized_return FROM f WHERE r = 1
    UNION ALL SELECT backtest_run_id, 'final_values', 'annualized_vol', annualized_vol FROM f WHERE r = 1 UNION ALL SELECT backtest_run_id, 'final_values', 'max_drawdown', max_drawdown FROM f WHERE r = 1 UNION ALL SELECT backtest_run_id, 'final_values', 'total_turnover', total_turnover FROM f WHERE r = 1"""))
def control_group1(spark, sf):
    from pitframe.operators import controls as C
    names = ("v_guard_alert", "v_guard_action", "v_book_rebalance", "v_book_daily_performance", "v_book_weight_daily")
    views = {n: view(spark, sf, n) for n in names}
    views["v_portfolio_period_summary"] = view(spark, sf, "v_portfolio_period_summary").filter("arm_code = 'MARKOWITZ_BASE'")
    return C.control_group1(views, ["backtest_run_id"])


@case("filter_run", check_sql("v_book v_guard_alert v_guard_action v_book_daily_performance v_backtest_test", """SELECT 'v_book' AS "view", 'other book' AS reason, count(*) AS "rows" FROM v_book WHERE book_id <> 73 UNION ALL SELECT 'v_guard_action', CASE WHEN book_id <> 73 THEN 'other book' ELSE 'arm disabled' END, count(*) FROM v_guard_action WHERE book_id <> 73 OR status = 'ARM_DISABLED' GROUP BY 2
    UNION ALL SELECT 'v_guard_alert', 'no kept action', count(*) FROM v_guard_alert WHERE alert_id NOT IN (SELECT alert_id FROM v_guard_action WHERE book_id = 73 AND status <> 'ARM_DISABLED') UNION ALL SELECT 'v_book_daily_performance', 'other book', count(*) FROM v_book_daily_performance WHERE book_id <> 73
    UNION ALL SELECT 'v_backtest_test', 'other pair', count(*) FROM v_backtest_test WHERE arm_a <> 'TOPN_MV_GUARD'"""))
def filter_run(spark, sf):
    from pitframe.operators.integrity import filter_run as run
    names = ("v_book", "v_guard_alert", "v_guard_action", "v_book_daily_performance", "v_backtest_test")
    return run({n: view(spark, sf, n) for n in names}, 73, "TOPN_MV_GUARD", "P7")[1]


@case("verify_graph", check_sql("v_guard_alert v_guard_action v_book v_book_daily_performance assets", """SELECT "check", status, count(*) AS "rows" FROM (SELECT 'identity' AS "check", 'differs' AS status, window_id AS key FROM v_guard_alert WHERE alert_id % 50 = 0 GROUP BY window_id
    UNION ALL SELECT 'triples', CASE WHEN window_id IN (SELECT window_id FROM v_guard_alert WHERE alert_id % 50 = 0) THEN 'differs' ELSE 'pass' END, window_id FROM v_book GROUP BY window_id
    UNION ALL SELECT 'class', 'pass', c FROM (VALUES ('b', (SELECT count(*) FROM v_book)), ('a', (SELECT count(*) FROM v_guard_alert)), ('x', (SELECT count(*) FROM v_guard_action)), ('p', (SELECT count(*) FROM v_book_daily_performance))) k(c, n) WHERE n > 0
    UNION ALL SELECT 'link', 'pass', window_id FROM v_guard_alert GROUP BY window_id UNION ALL SELECT 'link', 'pass', 'P' || backtest_run_id FROM v_guard_action GROUP BY 3
    UNION ALL SELECT 'unlinked GuardAlert', 'pass', window_id FROM v_guard_alert WHERE ticker NOT IN (SELECT asset_symbol FROM assets) GROUP BY window_id
    UNION ALL SELECT 'unlinked GuardAction', 'pass', 'P' || backtest_run_id FROM v_guard_action WHERE ticker NOT IN (SELECT asset_symbol FROM assets) GROUP BY 3
    UNION ALL SELECT 'actions by status', 'pass', backtest_run_id || status FROM v_guard_action GROUP BY 3 UNION ALL SELECT 'last NAV', 'pass', window_id || arm_code FROM v_book_daily_performance GROUP BY 3
    UNION ALL SELECT 'alerts by rule, layer and state', CASE WHEN lost = 0 THEN 'pass' WHEN lost = n THEN 'missing' ELSE 'differs' END, key FROM (SELECT window_id || rule_id || layer || state AS key, count(*) AS n, count(*) FILTER (alert_id % 50 = 0) AS lost FROM v_guard_alert GROUP BY 1)
    UNION ALL SELECT DISTINCT 'alerts by rule, layer and state', 'extra', window_id || rule_id || layer FROM v_guard_alert WHERE alert_id % 50 = 0) GROUP BY 1, 2"""))
def verify_graph(spark, sf):
    """Books, alerts, actions and daily rows of all windows against a store that lost the state of some alerts: every check of the proof."""
    from pitframe.plans import delivery as D
    book, ids = books(spark, sf), P.alert_ids(view(spark, sf, "v_guard_alert"), LABEL)
    parts = [(E.BOOK, P.books(view(spark, sf, "v_book"), LABEL)), (E.ALERT, alert_table(spark, sf)), (E.ACTION, P.actions(view(spark, sf, "v_guard_action"), book, ids, assets(spark, sf))),
             (E.PERFORMANCE, P.performance(view(spark, sf, "v_book_daily_performance"), book))]
    q = D.as_quads([(m, spool(t)) for m, t in parts])
    lost = (F.col("predicate") == "alertState") & F.col("subject").rlike("(00|50|_0)$")
    out = D.verify(q.filter(~lost), q)
    return out.groupBy("check", "status").agg(F.count(F.lit(1)).alias("rows"))


@case("verify_delivery", check_sql("v_guard_alert", """SELECT 'graph' AS "check", CASE WHEN window_id = 'P5' THEN 'not-verifiable' WHEN max(CASE WHEN alert_id % 50 = 0 AND window_id > 'P5' THEN 1 ELSE 0 END) = 1 THEN 'fail' ELSE 'pass' END AS status, window_id FROM v_guard_alert GROUP BY window_id
    UNION ALL SELECT DISTINCT 'removed rule', 'fail', window_id FROM v_guard_alert WHERE rule_id = 'L1_BP_REENTRY' AND window_id <> 'P5' """))
def verify_delivery(spark, sf):
    from pitframe.operators.reconcile import verify_delivery as check
    q = melt(alert_table(spark, sf), E.ALERT)
    win = F.regexp_extract("graph", r":(P\d+):", 1)
    lost = F.col("subject").rlike("(00|50)$") & (F.col("predicate") == "alertState") & (win > "P5")
    out = check(q.filter(~lost & (win != "P5")), q, ["R_L1_BP_REENTRY"], ["price"])
    return out.select("check", "status", F.regexp_extract("key", r":(P\d+):", 1).alias("window_id"))
