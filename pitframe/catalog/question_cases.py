"""Named questions over the class tables of the derived views."""

from pyspark.sql import functions as F

from pitframe.catalog.entity_cases import alert_table
from pitframe.catalog.registry import case, table
from pitframe.plans import projections as P
from pitframe.plans import questions as Q
from pitframe.plans.casebook import check_sql, view

L, W, ARM, DAY = "base", "P7", "MARKOWITZ_BASE", "1997-09-07"


class Tables(dict):
    """Class tables built on first use, so a question plans only what it reads."""

    def __init__(self, spark, sf):
        super().__init__()
        self.spark, self.sf = spark, sf

    def v(self, name):
        return view(self.spark, self.sf, name)

    def __missing__(self, key):
        self[key] = BUILD[key](self)
        return self[key]


def _books(t):
    return P.book_table(t.v("v_book"), L)


def _win(df):
    return df.withColumnRenamed("window_id", "windowId").withColumn("runLabel", F.lit(L))


def _book_of(df):
    return df.withColumn("book", F.concat(F.lit("Book_base_"), "win", F.lit("_"), _arm()))


def _arm():
    code = F.col("book_id") % 10
    names = ("MARKOWITZ_BASE", "TOPN_MV_NOGUARD", "TOPN_MV_GUARD", "TOPN_MV_GUARD_NO_NLP", "MARKOWITZ_BASE_GUARD")
    out = F.when(code == 1, names[0])
    for i, n in enumerate(names[1:], 2):
        out = out.when(code == i, n)
    return out


def _linked(t, df, ident="asset_id", out="asset"):
    return df.join(t.v("assets").select(F.col("asset_id").alias(ident), F.col("asset").alias(out)), ident, "left")


c = F.col
BUILD = {
    "StrategyBook": lambda t: P.books(t.v("v_book"), L),
    "GuardAlert": lambda t: alert_table(t.spark, t.sf),
    "GuardAction": lambda t: P.actions(t.v("v_guard_action"), _books(t), P.alert_ids(t.v("v_guard_alert"), L), t.v("assets")),
    "BookRebalance": lambda t: P.rebalances(t.v("v_book_rebalance"), _books(t)),
    "BookWeightDaily": lambda t: P.weights(t.v("v_book_weight_daily"), _books(t), t.v("assets")),
    "BookDailyPerformance": lambda t: P.performance(t.v("v_book_daily_performance"), _books(t)),
    "PortfolioPeriodSummary": lambda t: P.summaries(t.v("v_portfolio_period_summary"), _books(t)),
    "BacktestTest": lambda t: P.tests(t.v("v_backtest_test"), L),
    "SelectionCycle": lambda t: _win(t.v("v_cycle_run")).select(c("run_id").cast("string").alias("subject"), "runLabel", "windowId", c("run_id").alias("cycleRunId"), c("as_of").alias("runAsOf")),
    "AttractivenessSnapshot": lambda t: _linked(t, _win(t.v("v_cycle_ranking"))).select(
        F.concat_ws("_", "cycle_run_id", "asset_id").alias("subject"), "runLabel", "windowId", c("cycle_run_id").cast("string").alias("rankingOfCycle"), c("rank").alias("rankPosition"), c("ticker").alias("rankingTicker"), c("blended_score").alias("attractivenessScore"),
        (c("selected") == 1).alias("selectedForBook"), (c("vetoed") == 1).alias("vetoedAtRanking"), c("veto_rules_json").alias("vetoRulesJson"), c("target_weight").alias("targetWeight"), c("asset").alias("attractivenessOfAsset"),
        F.when(c("asset_id") % 4 > 0, F.array(F.lit("F"), F.lit("T"))).otherwise(F.array(F.lit("T"))).alias("hasEffectiveWeight")),
    "Veto": lambda t: _linked(t, _win(t.v("v_veto"))).select(c("id").cast("string").alias("subject"), "runLabel", "windowId", c("ticker").alias("vetoTicker"), c("asset").alias("vetoOfAsset"), F.concat(F.lit("R_"), "rule_id").alias("appliesRule"),
                                                             c("severity").alias("vetoSeverity"), c("raised_on").alias("raisedOn"), c("cleared_on").alias("clearedOn")),
    "rules": lambda t: t.v("rules").select(c("rule_iri").alias("subject"), c("rule_id").alias("ruleId"), "category", c("guard_layer").alias("guardLayer"), "note", c("valid_to").alias("validTo")),
    "assets": lambda t: t.v("assets").select(c("asset").alias("subject"), c("asset_symbol").alias("tickerSymbol"), c("company_name").alias("companyName"), c("industry").alias("classifiedAs"), c("is_fund").alias("isFund")),
    "industries": lambda t: t.v("industries").select("industry", c("industry").alias("industryLabel"), c("sector").alias("sectorLabel"), F.concat(F.lit("about "), "sector").alias("sectorDefinition")),
    "masked": lambda t: t.v("assets").filter("masked").select(c("asset").alias("subject")),
    "UniverseMembership": lambda t: t.v("stints").select(c("symbol").alias("membershipAsset"), c("valid_from").alias("validFrom"), c("valid_to").alias("validTo")),
    "TickerHistory": lambda t: t.v("stints").filter("cik IS NOT NULL").select(
        F.concat(F.lit("urn:graph:derived:ticker-history:base:200"), (F.length("symbol") % 3).cast("string"), F.lit("-01-01")).alias("graph"), c("cik").alias("tickerHistoryCik"), c("symbol").alias("historicalSymbol"), c("symbol").alias("canonicalSymbol"), c("symbol").alias("tickerHistoryAsset"), c("valid_from").alias("validFrom"), c("valid_to").alias("validTo")),
    "SECFiling": lambda t: _linked(t, t.v("filings")).select(c("filing_id").alias("subject"), c("asset").alias("filingOfAsset"), c("available_at").alias("availableAt"), c("period_end").alias("periodEnd"), c("form").alias("formType")),
    "FundamentalMetricSet": lambda t: t.v("filings").select(c("filing_id").alias("metricSetOfFiling"), c("roic").alias("returnOnInvestedCapital"), c("debt").alias("debtToEquity")),
    "FundamentalAssessment": lambda t: _linked(t, t.v("assessments")).select(c("snapshot_id").alias("subject"), c("asset").alias("assessmentOfAsset"), c("filing_id").alias("assessmentOfFiling"), c("available_at").alias("availableAt"), c("score_raw_0_100").alias("scoreRaw0to100"), "rating", c("generated_by_language_model").alias("generatedByLanguageModel")),
    "StopEvent": lambda t: _book_of(_linked(t, t.v("stops"))).select(c("k").alias("subject"), c("book").alias("stopOfBook"), c("date").alias("stopDate"), c("asset").alias("stoppedAsset"), "chooser", c("cause").alias("stopCashCause"), F.when(c("cash"), True).alias("chosenCash"), F.when(~c("cash"), c("k") * 10 + 1).alias("chosenOption")),
    "DestinationOption": lambda t: _linked(t, t.v("stops").select("k", F.explode(F.array(F.struct(c("chosen_id").alias("asset_id"), c("spy"), F.lit(1).alias("p")), F.struct(c("asset_id"), F.lit(False).alias("spy"), F.lit(2).alias("p")))).alias("o")).select("k", "o.*")).select(
        (c("k") * 10 + c("p")).alias("subject"), c("k").alias("optionOfStop"), c("asset").alias("optionAsset"), c("spy").alias("optionIsSpy"), c("p").alias("menuPosition")),
    "ReplacementPurchase": lambda t: _linked(t, t.v("purchases")).select(c("k").alias("subject"), c("k").alias("purchaseOfStop"), c("asset").alias("replacementAsset"), c("order_date").alias("orderDate"), c("execution_date").alias("replacementExecutionDate"), c("weight").alias("replacementWeight"), c("rank").alias("replacementRank")),
    "ReplacementCheck": lambda t: t.v("purchases").filter("k % 4 = 2").select(c("k").alias("checkOfPurchase"), F.date_add("execution_date", 30).alias("checkDate"), (c("k") % 3 == 0).alias("candidate"), F.lit(True).alias("kept")),
    "StopMemory": lambda t: _book_of(_linked(t, t.v("memories"))).select(c("k").alias("subject"), c("book").alias("memoryOfBook"), c("asset").alias("memoryAsset"), c("since").alias("memorySince"), c("start_kind").alias("memoryStartKind"), c("released").alias("memoryReleasedOn"), c("cause").alias("memoryReleaseCause")),
    "DecisionEvent": lambda t: _book_of(t.v("decisions")).select(c("k").alias("subject"), c("book").alias("decisionOfBook"), c("date").alias("decisionDate"), c("scale").alias("exposureScale")),
    "RetentionDecision": lambda t: _book_of(t.v("retained").select("book_id", "win", "date").distinct()).select(F.concat_ws("_", "book_id", "date").alias("subject"), c("book").alias("retentionOfBook"), c("date").alias("retentionDate")),
    "RetentionHold": lambda t: _linked(t, t.v("retained").filter("kept")).select(F.concat_ws("_", "book_id", "date").alias("holdOfDecision"), c("asset").alias("retainedAsset"), c("counter").alias("retentionCounter")),
    "RetentionRejection": lambda t: _linked(t, t.v("retained").filter("NOT kept")).select(F.concat_ws("_", "book_id", "date").alias("rejectionOfDecision"), c("asset").alias("rejectedAsset"), c("counter").alias("retentionCounter"), c("cause").alias("rejectionCause")),
    "TrendFilterState": lambda t: t.v("trend").select(F.lit(L).alias("runLabel"), c("window").alias("trendWindow"), c("decision_date").alias("trendDecisionDate"), c("spy_vs_sma210").alias("trendState"), c("cash_fraction").alias("cashFraction")),
    "ReferenceReturn": lambda t: t.v("reference_returns").select(F.lit(L).alias("runLabel"), c("window").alias("returnWindow"), c("segment").alias("returnSegment"), c("reference").alias("referenceName"), c("total_return").alias("referenceTotalReturn"), c("max_drawdown").alias("referenceMaxDrawdown")),
}


def ask(name, names, body, fn):
    """Register one question: its views and checking SQL, and the call on the tables."""
    case(name, check_sql(names, body))(lambda spark, sf: fn(Tables(spark, sf)))


# --- glossary, over documents as terms ---


def _terms(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("k"), "text", "lang", "source")
    q = lambda df, p, o, kind="literal": df.select(F.concat(F.col("pre"), F.col("k").cast("string")).alias("subject"), F.lit(p).alias("predicate"), o.alias("object"), "lang")
    own = d.withColumn("pre", F.lit("T_"))
    ext = d.withColumn("pre", F.lit("F_"))
    link = own.filter("k % 2 = 0").select(F.concat(F.lit("T_"), F.col("k").cast("string")).alias("subject"), F.lit("seeAlso").alias("predicate"), F.concat(F.lit("F_"), F.floor(F.col("k") / 2).cast("string")).alias("object"), F.lit(None).cast("string").alias("lang"))
    tbox = q(own, "label", F.col("source")).unionByName(q(own, "definition", F.col("text"))).unionByName(link)
    external = q(ext, "definition", F.col("text")).unionByName(q(ext.filter("k % 3 = 0").withColumn("lang", F.lit("es")), "label", F.col("source")))
    return tbox, external


FIBO = "SELECT 'F_' || doc_id AS external, text AS \"externalDefinition\", CASE WHEN doc_id % 3 = 0 THEN source END AS \"externalLabel\", CAST(NULL AS VARCHAR) AS \"externalDefinitionLocal\" FROM documents WHERE lang <> 'es'"


@case("q_term_definitions", f"SELECT 'T_' || doc_id AS term, source AS label, text AS definition, f.* FROM documents d LEFT JOIN ({FIBO}) f ON doc_id % 2 = 0 AND f.external = 'F_' || (doc_id // 2) WHERE lang = 'es'")
def q_term_definitions(spark, sf):
    return Q.term_definitions(*_terms(spark, sf))


@case("q_term_by_label", f"SELECT external, \"externalDefinition\", \"externalDefinitionLocal\" FROM ({FIBO}) WHERE lower(\"externalLabel\") IN (SELECT lower(min(source)) FROM documents UNION SELECT lower(max(source)) FROM documents)")
def q_term_by_label(spark, sf):
    lo, hi = table(spark, sf, "documents").agg(F.min("source"), F.max("source")).first()  # one row of two labels
    return Q.term_by_label(_terms(spark, sf)[1], [lo, hi])


@case("q_definition_search", "SELECT 'T_' || doc_id AS term, text AS definition FROM documents WHERE lang = 'es' AND contains(lower(text), 'ciónra')")
def q_definition_search(spark, sf):
    return Q.definition_search(_terms(spark, sf)[0], "ciónra")


# --- catalogue ---

B = "(SELECT *, 'Book_base_' || window_id || '_' || arm_code AS book FROM v_book)"
TK = "JOIN (SELECT asset_id AS aid, asset_symbol AS ticker, masked FROM assets) tk ON tk.aid = "
LTK = "LEFT " + TK
ACT = "(SELECT x.*, l.rule_id, l.date AS adate, l.state, l.layer, l.window_id AS \"window\", a.asset FROM v_guard_action x JOIN v_guard_alert l ON l.alert_id = x.alert_id LEFT JOIN (SELECT asset_symbol AS sym, asset FROM assets) a ON a.sym = x.ticker)"
SECT = "LEFT JOIN (SELECT asset AS sa, CASE WHEN is_fund THEN 'core fund' ELSE sector END AS sec FROM assets LEFT JOIN industries i ON i.industry = assets.industry) s ON s.sa = "

ask("q_active_rules", "rules", "SELECT category, rule_id AS \"ruleId\", rule_iri AS rule FROM rules WHERE valid_to IS NULL AND category IN ('DATA_QUALITY', 'FINANCIAL', 'MARKET', 'GUARD')", lambda t: Q.active_rules(t))
ask("q_universe_members", "stints assets", "SELECT symbol AS asset, symbol AS ticker, valid_from AS \"validFrom\", valid_to AS \"validTo\" FROM stints JOIN assets ON asset = symbol WHERE valid_from <= DATE '1997-09-07' AND (valid_to IS NULL OR valid_to >= DATE '1997-09-07')", lambda t: Q.universe_members(t, DAY))
ask("q_ticker_on_date", "stints", "SELECT 'urn:graph:derived:ticker-history:base:2002-01-01' AS snapshot, cik, symbol, symbol AS canonical, symbol AS asset FROM stints WHERE cik IS NOT NULL AND length(symbol) % 3 = 2 AND symbol = 'T8' AND valid_from <= DATE '1997-09-07' AND (valid_to IS NULL OR valid_to >= DATE '1997-09-07')", lambda t: Q.ticker_on_date(t, "T8", DAY))
ask("q_run_labels", "v_book", "SELECT 'base' AS label, count(DISTINCT window_id) AS windows, count(*) AS books FROM v_book", Q.run_labels)
ask("q_windows_present", "v_portfolio_period_summary", "SELECT 'base' AS label, window_id AS \"window\", min(date_from) AS \"dateFrom\", max(date_to) AS \"dateTo\" FROM v_portfolio_period_summary GROUP BY 2", Q.windows_present)
ask("q_arms_present", "v_book", "SELECT 'base' AS label, window_id AS \"window\", arm_code AS arm, count(*) AS books FROM v_book GROUP BY 2, 3", Q.arms_present)
ask("q_runs_available", "v_book", "SELECT 'base' AS label, window_id AS \"window\", count(*) AS books FROM v_book GROUP BY 2", Q.runs_available)
ask("q_rebalance_dates", "v_book_rebalance", "SELECT 'base' AS label, 'P7' AS \"window\", arm_code AS arm, decision_date AS decision, execution_date AS execution, cycle_run_id AS \"cycleRunId\" FROM v_book_rebalance WHERE backtest_run_id = 7", lambda t: Q.rebalance_dates(t, L, W))
ask("q_decision_cycles", "v_book_rebalance v_cycle_run", "SELECT 'base' AS label, 'P7' AS \"window\", cycle_run_id AS \"cycleRunId\", as_of AS \"cycleDate\", string_agg(DISTINCT arm_code, ', ' ORDER BY arm_code) AS arms FROM v_book_rebalance JOIN v_cycle_run ON run_id = cycle_run_id WHERE backtest_run_id = 7 GROUP BY 3, 4", lambda t: Q.decision_cycles(t, L, W))
ask("q_warm_up_cycles", "v_book_rebalance v_cycle_run", "SELECT 'base' AS label, 'P7' AS \"window\", run_id AS \"cycleRunId\", as_of AS \"cycleDate\" FROM v_cycle_run WHERE window_id = 'P7' AND run_id NOT IN (SELECT cycle_run_id FROM v_book_rebalance WHERE cycle_run_id IS NOT NULL)", lambda t: Q.warm_up_cycles(t, L, W))
ask("q_performance", "v_portfolio_period_summary", "SELECT 'base' AS label, 'P7' AS \"window\", arm_code AS arm, segment, 'PeriodSummary_base_P7_' || arm_code || '_' || segment AS summary, cumulative_return AS \"cumulativeReturn\", annualized_return AS \"annualizedReturn\", ex_post_sharpe AS \"exPostSharpe\" FROM v_portfolio_period_summary WHERE window_id = 'P7'", lambda t: Q.performance_by_segment(t, L, W))
ask("q_alerts_by_month", "v_guard_alert v_guard_action assets", f"SELECT 'base' AS label, 'P7' AS \"window\", rule_id AS \"ruleId\", strftime(adate, '%Y-%m') AS month, count(DISTINCT alert_id) AS alerts FROM {ACT} WHERE \"window\" = 'P7' GROUP BY 3, 4", lambda t: Q.alerts_by_month(t, L, W))
ask("q_latest_nav", "v_book_daily_performance", "SELECT 'base' AS label, arm_code AS arm, date, nav FROM v_book_daily_performance p WHERE window_id = 'P7' AND knowledge_date <= DATE '1997-09-07' AND NOT EXISTS (SELECT 1 FROM v_book_daily_performance q WHERE q.book_id = p.book_id AND q.knowledge_date <= DATE '1997-09-07' AND q.date > p.date)", lambda t: Q.latest_nav(t, L, W, DAY))
ask("q_equities_last_day", "v_book_daily_performance", "SELECT 'base' AS label, 'P7' AS \"window\", arm_code AS arm, date, n_equity AS \"nEquity\" FROM v_book_daily_performance p WHERE window_id = 'P7' AND date = (SELECT max(date) FROM v_book_daily_performance q WHERE q.book_id = p.book_id)", lambda t: Q.equities_on_last_day(t, L, W))
ask("q_cut_tickers", "v_guard_alert v_guard_action assets", f"SELECT 'base' AS label, 'P7' AS \"window\", arm_code AS arm, ticker, count(*) AS cuts FROM {ACT} WHERE \"window\" = 'P7' AND status = 'APPLIED' AND layer = 1 GROUP BY 3, 4", lambda t: Q.cut_tickers(t, L, W))
ask("q_cut_explanation", "v_guard_alert v_guard_action", "SELECT CASE WHEN x.action_id IS NOT NULL THEN 'base' END AS label, 'GuardAlert_base_P7_' || l.alert_id AS alert, rule_id AS \"ruleId\", 'note of ' || rule_id AS \"ruleNote\", arm_code AS arm, status FROM v_guard_alert l LEFT JOIN v_guard_action x ON x.alert_id = l.alert_id WHERE l.alert_id = 10 AND window_id = 'P7'", lambda t: Q.cut_explanation(t, 10, L, W))
ask("q_knowledge_dates", "v_book", "SELECT 'base' AS label, 'P7' AS \"window\", arm_code AS arm, min(knowledge_date) AS \"firstKnown\", max(knowledge_date) AS \"lastKnown\" FROM v_book WHERE window_id = 'P7' GROUP BY 3", lambda t: Q.knowledge_dates(t, L, W))
ask("q_weight_scale", "v_book_weight_daily", "SELECT 'base' AS label, 'P7' AS \"window\", arm_code AS arm, count(*) AS weights FROM v_book_weight_daily WHERE backtest_run_id = 7 GROUP BY 3", lambda t: Q.weight_scale(t, L, W))
RK = "(SELECT r.*, y.as_of FROM v_cycle_ranking r JOIN v_cycle_run y ON y.run_id = r.cycle_run_id WHERE r.window_id = 'P7')"
ask("q_ranking_at", "v_cycle_ranking v_cycle_run", f"SELECT rank, ticker, blended_score AS score, selected = 1 AS selected, target_weight AS \"cycleTarget\", vetoed = 1 AS vetoed, veto_rules_json AS rules FROM {RK} WHERE as_of = DATE '1997-06-01'", lambda t: Q.ranking_at(t, L, W, "1997-06-01"))
ask("q_vetoes_in_force", "v_veto", "SELECT ticker, rule_id AS \"ruleId\", severity, raised_on AS raised, cleared_on AS cleared FROM v_veto WHERE window_id = 'P7' AND raised_on <= DATE '1997-09-07' AND (cleared_on IS NULL OR cleared_on > DATE '1997-09-07')", lambda t: Q.vetoes_in_force(t, L, W, DAY))
ask("q_why_not_selected", "v_cycle_ranking v_cycle_run", f"SELECT ticker, rank, selected = 1 AS selected, vetoed = 1 AS vetoed, veto_rules_json AS rules, blended_score AS score, CASE WHEN asset_id % 4 > 0 THEN 2 ELSE 1 END AS components FROM {RK} WHERE as_of = DATE '1997-02-01' AND ticker = 'T1'", lambda t: Q.why_not_selected(t, L, W, "1997-02-01", "T1"))
ask("q_trend_cash", "trend", "SELECT decision_date AS date, cash_fraction AS \"cashFraction\" FROM trend WHERE \"window\" = 'P7' AND spy_vs_sma210 = 'below'", lambda t: Q.trend_cash(t, L, W))
ask("q_reference_returns", "reference_returns v_portfolio_period_summary", "SELECT reference, total_return AS \"totalReturn\", r.max_drawdown AS \"maxDrawdown\", arm_code AS arm, cumulative_return AS \"armReturn\" FROM reference_returns r JOIN v_portfolio_period_summary s ON s.segment = r.segment AND s.window_id = 'P7' WHERE r.\"window\" = 'P7' AND r.segment = 'P7'", lambda t: Q.reference_returns(t, L, W, W))
ask("q_sector_cuts", "v_guard_alert v_guard_action assets industries", f"SELECT 'base' AS label, 'P7' AS \"window\", arm_code AS arm, coalesce(sec, 'unclassified') AS sector, count(DISTINCT action_id) AS cuts FROM {ACT} x {SECT} x.asset WHERE \"window\" = 'P7' AND status = 'APPLIED' AND state = 'ENTER' AND layer = 1 GROUP BY 3, 4", lambda t: Q.sector_cuts(t, L, W))
HOLD = "(SELECT w.*, a.asset FROM v_book_weight_daily w LEFT JOIN assets a ON a.asset_symbol = holding_key WHERE backtest_run_id = 7)"
ask("q_sector_composition", "v_book_weight_daily v_book_rebalance assets industries", f"""SELECT 'base' AS label, 'P7' AS "window", 'MARKOWITZ_BASE' AS arm, r.decision_date AS decision, r.execution_date AS "weightDate", coalesce(sec, 'unclassified') AS sector, sum(h.final_target_weight) AS weight, k.cash FROM v_book_rebalance r
    JOIN {HOLD} h ON h.book_id = r.book_id AND h.date = r.execution_date JOIN (SELECT book_id, date, max(final_target_weight) AS cash FROM v_book_weight_daily WHERE holding_key = 'CASH' GROUP BY 1, 2) k ON k.book_id = r.book_id AND k.date = r.execution_date {SECT} h.asset
    WHERE r.book_id = 71 AND r.decision_date = DATE '1997-06-01' AND h.holding_key <> 'CASH' AND h.final_target_weight > 0 GROUP BY 4, 5, 6, 8""", lambda t: Q.sector_composition(t, L, W, ARM, "1997-06-01"))
ask("q_held_by_industry", "v_book_weight_daily assets", f"SELECT 'base' AS label, 'P7' AS \"window\", arm_code AS arm, industry, count(DISTINCT holding_key) AS tickers, string_agg(DISTINCT holding_key, ', ' ORDER BY holding_key) AS \"tickerList\" FROM {HOLD} h JOIN (SELECT asset AS x, industry FROM assets) a ON a.x = h.asset WHERE final_target_weight > 0 AND industry IN ('BUILDING', 'MACHINERY') GROUP BY 3, 4", lambda t: Q.held_by_industry(t, L, W, ["BUILDING", "MACHINERY"]))
ask("q_holding_coverage", "v_book_weight_daily assets industries", f"SELECT 'base' AS label, 'P7' AS \"window\", count(DISTINCT holding_key) AS \"heldTickers\", count(DISTINCT asset) AS \"withAsset\", count(DISTINCT CASE WHEN sec IS NOT NULL THEN asset END) AS \"withSector\", count(DISTINCT CASE WHEN sec = 'core fund' THEN asset END) AS \"etfTickers\" FROM {HOLD} h {SECT} h.asset WHERE holding_key <> 'CASH' AND final_target_weight > 0", lambda t: Q.holding_coverage(t, L, W))
ask("q_unclassified_by_year", "stints assets", "SELECT year(valid_to) AS year, count(DISTINCT symbol) AS unclassified_assets FROM stints JOIN assets ON asset = symbol WHERE valid_to IS NOT NULL AND industry IS NULL AND NOT is_fund GROUP BY 1", Q.unclassified_by_year)
ask("q_sector_of", "assets industries", "SELECT asset_symbol AS ticker, company_name AS \"companyName\", a.industry AS \"industryLabel\", sector AS \"sectorLabel\", 'about ' || sector AS \"sectorDefinition\" FROM assets a JOIN industries i ON i.industry = a.industry WHERE asset_symbol = 'T10'", lambda t: Q.sector_of(t, "T10"))


@case("q_property_list", check_sql("v_book_weight_daily v_book_daily_performance", """SELECT 'BookDailyPerformance' AS cls, 'nav' AS predicate, count(nav) AS triples FROM v_book_daily_performance UNION ALL SELECT 'BookDailyPerformance', 'performanceOfBook', count(*) FROM v_book_daily_performance
    UNION ALL SELECT 'BookWeightDaily', 'markowitzTargetWeight', count(markowitz_target_weight) FROM v_book_weight_daily UNION ALL SELECT 'BookWeightDaily', 'holdingName', count(holding_name) FROM v_book_weight_daily"""))
def q_property_list(spark, sf):
    from pitframe.operators.quads import melt, property_frequency
    from pitframe.plans import entities as E
    t = Tables(spark, sf)
    q = melt(t["BookWeightDaily"], E.WEIGHT).unionByName(melt(t["BookDailyPerformance"], E.PERFORMANCE))
    return property_frequency(q, ["BookWeightDaily", "BookDailyPerformance"]).filter(F.col("predicate").isin("nav", "performanceOfBook", "markowitzTargetWeight", "holdingName"))


# --- analyst questions ---

MET = "(SELECT 'T' || asset_id AS asset, available_at AS av, roic, debt FROM filings WHERE asset_id IN (SELECT asset_id FROM assets))"
ASM = "(SELECT 'T' || asset_id AS asset, available_at AS av, score_raw_0_100 AS score, rating, generated_by_language_model AS generated FROM assessments WHERE asset_id IN (SELECT asset_id FROM assets))"
ST = "(SELECT s.*, ticker, masked, 'T' || asset_id AS asset FROM stops s " + TK + "s.asset_id WHERE win = 'P7')"


def latest(src, key, day, *need):
    """Rows of a fact table that are the latest of their key on a day, by each needed column."""
    conds = " AND ".join(f"m.{n} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {src} z WHERE z.asset = m.asset AND z.av <= {day} AND z.av > m.av AND z.{n} IS NOT NULL)" for n in need) if need else f"NOT EXISTS (SELECT 1 FROM {src} z WHERE z.asset = m.asset AND z.av <= {day} AND z.av > m.av)"
    return f"(SELECT * FROM {src} m WHERE m.asset = {key} AND m.av <= {day} AND {conds})"


ask("c1_quality_at_stop", "stops assets filings assessments", f"SELECT date AS \"stopDate\", ticker, roic, debt, score, rating, generated, masked AS \"pricesNotPublished\" FROM {ST} s LEFT JOIN LATERAL {latest(MET, 's.asset', 's.date', 'roic', 'debt')} m ON true LEFT JOIN LATERAL {latest(ASM, 's.asset', 's.date')} a ON true WHERE date <= DATE '1997-09-07'", lambda t: Q.quality_at_stop(t, L, W, DAY))
PU = "(SELECT p.*, 'T' || sold_id AS sold, 'T' || p.asset_id AS bought, x.masked OR y.masked AS masked, x.industry AS i1, y.industry AS i2, order_date AS \"stopDate\" FROM purchases p JOIN assets x ON x.asset_id = sold_id JOIN assets y ON y.asset_id = p.asset_id WHERE win = 'P7')"
ask("c2a_replacement_sectors", "purchases assets industries", f"SELECT \"stopDate\", sold AS \"soldTicker\", bought AS \"replacementTicker\", order_date AS \"orderDate\", execution_date AS \"executionDate\", a.sector AS \"soldSector\", b.sector AS \"replacementSector\", a.sector = b.sector AS \"sameSector\", masked AS \"pricesNotPublished\" FROM {PU} p JOIN industries a ON a.industry = i1 JOIN industries b ON b.industry = i2", lambda t: Q.replacement_sectors(t, L, W))
ask("c2b_replacement_quality", "purchases assets filings assessments", f"""SELECT "stopDate", sold AS "soldTicker", bought AS "replacementTicker", m1.roic AS "soldRoic", m2.roic AS "replacementRoic", m1.debt AS "soldDebt", m2.debt AS "replacementDebt", a1.score AS "soldScore", a2.score AS "replacementScore", a1.generated AS "oldGenerated", a2.generated AS "newGenerated", masked AS "pricesNotPublished"
    FROM {PU} p LEFT JOIN LATERAL {latest(MET, 'p.sold', 'p.order_date', 'roic')} m1 ON m1.debt IS NOT NULL LEFT JOIN LATERAL {latest(MET, 'p.bought', 'p.order_date', 'roic')} m2 ON m2.debt IS NOT NULL
    LEFT JOIN {ASM} a1 ON a1.asset = p.sold AND a1.av <= p.order_date LEFT JOIN {ASM} a2 ON a2.asset = p.bought AND a2.av <= p.order_date""", lambda t: Q.replacement_quality(t, L, W))
HD = "(SELECT w.arm_code AS arm, a.asset, final_target_weight AS weight, asset_symbol AS ticker, masked, industry FROM v_book_weight_daily w JOIN assets a ON a.asset_symbol = holding_key WHERE backtest_run_id = 7 AND date = DATE '1997-09-07' AND final_target_weight > 0)"
D = "DATE '1997-09-07'"
ask("c3_weighted_quality", "v_book_weight_daily assets filings", f"SELECT arm, CAST(CAST(sum(weight * roic) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) AS DECIMAL(18,8)) AS \"weightedRoic\", CAST(CAST(sum(weight * debt) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) AS DECIMAL(18,8)) AS \"weightedDebt\", sum(weight) AS \"coveredWeight\", count(DISTINCT h.asset) AS positions FROM {HD} h JOIN LATERAL {latest(MET, 'h.asset', D, 'roic', 'debt')} m ON true WHERE arm IN ('MARKOWITZ_BASE', 'TOPN_MV_GUARD') GROUP BY 1",
    lambda t: Q.weighted_quality(t, L, W, [ARM, "TOPN_MV_GUARD"], DAY).withColumn("weightedRoic", c("weightedRoic").cast("decimal(18,8)")).withColumn("weightedDebt", c("weightedDebt").cast("decimal(18,8)")))
ask("c4a_vetoed_but_strong", "v_veto assets assessments", f"SELECT tk.ticker, rule_id AS \"ruleId\", score, rating, generated, masked AS \"pricesNotPublished\" FROM v_veto v {TK} v.asset_id JOIN LATERAL {latest(ASM, 'v.ticker', D)} a ON true WHERE window_id = 'P7' AND raised_on <= {D} AND (cleared_on IS NULL OR cleared_on > {D}) AND score >= 70", lambda t: Q.vetoed_but_strong(t, L, W, DAY, 70))
ask("c4b_selected_but_weak", "v_cycle_ranking v_cycle_run assets assessments", f"SELECT r.ticker, score, rating, generated, masked AS \"pricesNotPublished\" FROM {RK} r {TK} r.asset_id JOIN LATERAL {latest(ASM, 'r.ticker', chr(68) + 'ATE ' + chr(39) + '1997-06-01' + chr(39))} a ON true WHERE as_of = DATE '1997-06-01' AND selected = 1 AND score < 40", lambda t: Q.selected_but_weak(t, L, W, "1997-06-01", 40))
ask("c5_veto_concentration", "v_veto assets industries assessments", f"SELECT sector AS \"sectorLabel\", rule_id AS \"ruleId\", count(DISTINCT id) AS vetoes, CAST(CAST(sum(score) AS DOUBLE) / count(score) AS DECIMAL(18,4)) AS \"averageAssessment\", sum(CASE WHEN generated THEN 1 ELSE 0 END) AS \"generatedAssessments\" FROM v_veto v JOIN assets x ON x.asset_id = v.asset_id JOIN industries i ON i.industry = x.industry LEFT JOIN LATERAL {latest(ASM, 'v.ticker', D)} a ON true WHERE window_id = 'P7' AND raised_on BETWEEN DATE '1997-01-05' AND {D} GROUP BY 1, 2",
    lambda t: Q.veto_concentration(t, L, W, "1997-01-05", DAY).withColumn("averageAssessment", c("averageAssessment").cast("double").cast("decimal(18,4)")))
ask("c6a_industry_exposure", "decisions v_book_weight_daily assets", f"SELECT d.date, scale AS \"exposureScale\", sum(final_target_weight) AS weight, count(DISTINCT h.asset) AS names FROM decisions d JOIN {HOLD} h ON h.book_id = d.book_id AND h.date = d.date JOIN (SELECT asset AS x, industry FROM assets) a ON a.x = h.asset WHERE d.win = 'P7' AND final_target_weight > 0 AND industry = 'BUILDING' GROUP BY 1, 2", lambda t: Q.industry_exposure(t, L, W, "BUILDING"))
CH = "LEFT JOIN (SELECT asset_id AS oid, asset_symbol AS otick FROM assets) o ON o.oid = CASE WHEN NOT s.cash THEN s.chosen_id END"
DEST = "CASE WHEN s.cash THEN 'cash' WHEN s.spy AND otick IS NOT NULL THEN 'SPY' ELSE coalesce(otick, 'no destination') END"
ask("c6b_industry_stops", "stops purchases assets", f"SELECT s.date, s.ticker, s.cause AS \"cashCause\", s.chooser, {DEST} AS destination, s.masked AS \"pricesNotPublished\", r.asset_symbol AS \"replacementTicker\" FROM {ST} s JOIN assets x ON x.asset = s.asset AND x.industry = 'BUILDING' {CH} LEFT JOIN purchases p ON p.k = s.k LEFT JOIN assets r ON r.asset_id = p.asset_id", lambda t: Q.industry_stops(t, L, W, "BUILDING"))
ask("c7a_tail_risk", "v_guard_alert v_guard_action v_book_daily_performance assets", f"SELECT adate AS date, rule_id AS \"ruleId\", status, CASE WHEN weight_after IS NOT NULL THEN weight_before END AS \"weightBefore\", CASE WHEN weight_before IS NOT NULL THEN weight_after END AS \"weightAfter\", p.cash_weight AS \"cashWeight\" FROM {ACT} x LEFT JOIN v_book_daily_performance p ON p.book_id = x.book_id AND p.date = x.effective_date WHERE \"window\" = 'P7' AND status = 'APPLIED' AND layer = 0", lambda t: Q.tail_risk(t, L, W))
ask("c7b_nav_with_without", "v_book_daily_performance", "SELECT a.date, a.nav AS \"navWith\", b.nav AS \"navWithout\", CAST(CAST(a.nav AS DOUBLE) / CAST(b.nav AS DOUBLE) AS DECIMAL(18,10)) AS \"navRatio\" FROM v_book_daily_performance a JOIN v_book_daily_performance b ON b.date = a.date WHERE a.book_id = 71 AND b.book_id = 73 AND a.date BETWEEN DATE '1997-01-05' AND DATE '1997-10-12'",
    lambda t: Q.nav_with_without(t, L, W, ARM, "TOPN_MV_GUARD", "1997-01-05", "1997-10-12").withColumn("navRatio", c("navRatio").cast("decimal(18,10)")))
ask("c8a_performance_compare", "v_portfolio_period_summary", "SELECT arm_code AS arm, segment, cumulative_return AS \"cumulativeReturn\", annualized_return AS \"annualizedReturn\", ex_post_sharpe AS \"exPostSharpe\", max_drawdown AS \"maxDrawdown\", n_guard_actions AS \"nGuardActions\" FROM v_portfolio_period_summary WHERE window_id = 'P7' AND arm_code IN ('MARKOWITZ_BASE', 'TOPN_MV_GUARD')", lambda t: Q.performance_compare(t, L, W, [ARM, "TOPN_MV_GUARD"]))
ask("c8b_paired_tests", "v_backtest_test", "SELECT test AS \"testName\", arm_a AS \"armA\", arm_b AS \"armB\", segment, window_id AS \"windowId\", statistic, p_value AS \"pValue\", n_obs AS \"nObs\" FROM v_backtest_test WHERE window_id = 'P7'", lambda t: Q.paired_tests(t, L, W))
ask("c9a_top_weights", "v_book_weight_daily assets", f"SELECT ticker, weight, masked AS \"pricesNotPublished\" FROM {HD} WHERE arm = 'MARKOWITZ_BASE' ORDER BY weight DESC, ticker LIMIT 10", lambda t: Q.top_weights(t, L, W, ARM, DAY))
ask("c9b_concentration", "v_book_weight_daily assets", f"SELECT count(DISTINCT asset) AS positions, sum(weight * weight) AS hhi, CAST(1.0 / CAST(sum(weight * weight) AS DOUBLE) AS DECIMAL(24,6)) AS \"effectivePositions\" FROM {HD} WHERE arm = 'MARKOWITZ_BASE' HAVING count(*) > 0", lambda t: Q.concentration(t, L, W, ARM, DAY).withColumn("effectivePositions", c("effectivePositions").cast("decimal(24,6)")))
ask("c9c_largest_sectors", "v_book_weight_daily assets industries", f"SELECT coalesce(sector, 'unclassified') AS bucket, sum(weight) AS \"sectorWeight\" FROM {HD} h LEFT JOIN industries i ON i.industry = h.industry WHERE arm = 'MARKOWITZ_BASE' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", lambda t: Q.largest_sectors(t, L, W, ARM, DAY))
ask("c9d_worst_drawdowns", "v_book_daily_performance", "SELECT date, drawdown FROM v_book_daily_performance WHERE book_id = 71 ORDER BY abs(drawdown) DESC, date LIMIT 10", lambda t: Q.worst_drawdowns(t, L, W, ARM))
ask("c10_stop_causes", "stops", "SELECT 'P7' AS \"window\", cause, count(*) AS stops, count(*) FILTER (cash) AS \"cashStops\" FROM stops WHERE win = 'P7' AND cause IS NOT NULL GROUP BY 2", lambda t: Q.stop_causes(t, L, W))
ask("c11a_decision_menu", "stops v_guard_alert assets", f"""SELECT s.date AS "stopDate", s.ticker AS "stoppedTicker", l.rule_id AS "ruleId", s.chooser, p AS "menuPosition", q.asset_symbol AS "optionTicker", CASE WHEN p = 1 THEN s.spy ELSE false END AS "optionIsSpy", CASE WHEN s.cash THEN true END AS "chosenCash",
    NOT s.cash AND q.asset IS NOT NULL AND q.asset_id = s.chosen_id AS chosen, s.masked AS "pricesNotPublished" FROM {ST} s JOIN v_guard_alert l ON l.date = s.date AND l.asset_id = s.asset_id AND l.rule_id = 'L1_BP_STOP' JOIN (SELECT unnest([1, 2]) AS p) ON true LEFT JOIN assets q ON q.asset_id = CASE WHEN p = 1 THEN s.chosen_id ELSE s.asset_id END""", lambda t: Q.decision_menu(t, L, W))
ask("c11b_replacement_trail", "purchases assets", f"SELECT \"stopDate\", sold AS \"soldTicker\", bought AS \"replacementTicker\", order_date AS \"orderDate\", execution_date AS \"executionDate\", weight AS \"replacementWeight\", rank AS \"replacementRank\", CASE WHEN k % 4 = 2 THEN execution_date + 30 END AS \"checkDate\", CASE WHEN k % 4 = 2 THEN k % 3 = 0 END AS candidate, CASE WHEN k % 4 = 2 THEN true END AS kept, masked AS \"pricesNotPublished\" FROM {PU}", lambda t: Q.replacement_trail(t, L, W))
ask("c12a_company_profile", "assets industries filings assessments", f"SELECT asset_symbol AS ticker, company_name AS \"companyName\", sector AS \"sectorLabel\", m.roic, m.debt, a.score, a.rating, a.generated, masked AS \"pricesNotPublished\" FROM assets x LEFT JOIN industries i ON i.industry = x.industry LEFT JOIN LATERAL {latest(MET, 'x.asset', D, 'roic')} m ON m.debt IS NOT NULL LEFT JOIN LATERAL {latest(ASM, 'x.asset', D)} a ON true WHERE asset_symbol = 'T10'", lambda t: Q.company_profile(t, "T10", DAY))
ask("c12b_company_timeline", "v_book_weight_daily stops memories assets", f"""SELECT 'holding' AS event, date, final_target_weight AS weight, '' AS cause, '' AS destination, masked AS "pricesNotPublished" FROM v_book_weight_daily JOIN assets ON asset_symbol = holding_key WHERE backtest_run_id = 7 AND holding_key = 'T10'
    UNION ALL SELECT 'stop', date, NULL, cause, CASE WHEN cash THEN 'cash' ELSE coalesce(cause, 'asset') END, masked FROM {ST} WHERE ticker = 'T10' UNION ALL SELECT 'memory', since, NULL, cause, '', masked FROM memories m {TK} m.asset_id WHERE win = 'P7' AND ticker = 'T10'""", lambda t: Q.company_timeline(t, "T10", L, W))
ask("c12c_company_rankings", "v_cycle_ranking v_cycle_run assets", f"SELECT as_of AS date, 'P7' AS \"window\", rank, blended_score AS score, selected = 1 AS selected, vetoed = 1 AS vetoed, veto_rules_json AS rules, coalesce(masked, false) AS \"pricesNotPublished\" FROM {RK} r {LTK} r.asset_id WHERE r.ticker = 'T10'", lambda t: Q.company_rankings(t, "T10", L, W))
ask("c12d_company_vetoes", "v_veto assets", f"SELECT raised_on AS raised, cleared_on AS cleared, rule_id AS \"ruleId\", severity FROM v_veto v {TK} v.asset_id WHERE window_id = 'P7' AND tk.ticker = 'T10'", lambda t: Q.company_vetoes(t, "T10", L, W))
ask("c13_known_on", "filings assessments assets", f"SELECT form AS \"formType\", f.period_end AS \"periodEnd\", f.available_at AS \"availableAt\", CASE WHEN debt IS NOT NULL THEN roic END AS roic, CASE WHEN roic IS NOT NULL THEN debt END AS debt, score_raw_0_100 AS score, rating, generated_by_language_model AS generated, masked AS \"pricesNotPublished\" FROM filings f {TK} f.asset_id LEFT JOIN assessments a ON a.filing_id = f.filing_id WHERE f.ticker = 'T10' AND f.available_at <= {D} AND (a.available_at IS NULL OR a.available_at <= {D})", lambda t: Q.known_on(t, "T10", DAY))
ask("c14_retained_names", "retained stops assets", f"SELECT r.date AS \"decisionDate\", tk.ticker, CASE WHEN kept THEN 'retained' ELSE 'rejected' END AS outcome, counter AS \"retentionCounter\", CASE WHEN kept THEN '' ELSE r.cause END AS \"rejectionCause\", s.date AS \"laterStopDate\", masked AS \"pricesNotPublished\" FROM retained r {TK} r.asset_id LEFT JOIN stops s ON s.book_id = r.book_id AND s.asset_id = r.asset_id AND s.date > r.date WHERE r.win = 'P7'", lambda t: Q.retained_names(t, L, W))
ask("c15_time_to_return", "memories stops assets", f"SELECT tk.ticker, start_kind AS \"startKind\", since, released, m.cause AS \"releaseCause\", s.date AS \"nextStopDate\", masked AS \"pricesNotPublished\" FROM memories m {TK} m.asset_id LEFT JOIN stops s ON s.book_id = m.book_id AND s.asset_id = m.asset_id AND (m.released IS NULL OR s.date > m.released) WHERE m.win = 'P7'", lambda t: Q.time_to_return(t, L, W))
ask("c16_chooser_destination", "stops assets", f"SELECT chooser, {DEST} AS destination, count(*) AS stops FROM stops s {CH} WHERE win = 'P7' GROUP BY 1, 2", lambda t: Q.chooser_destination(t, L, W))
ask("c17a_composition", "v_book_weight_daily assets industries", f"SELECT arm, ticker, weight, sector AS \"sectorLabel\", masked AS \"pricesNotPublished\" FROM {HD} h LEFT JOIN industries i ON i.industry = h.industry WHERE arm IN ('MARKOWITZ_BASE', 'TOPN_MV_GUARD')", lambda t: Q.composition(t, L, W, [ARM, "TOPN_MV_GUARD"], DAY))
ask("c17b_common_names", "v_book_weight_daily assets", f"SELECT a.ticker, a.weight AS \"weightA\", b.weight AS \"weightB\", a.masked AS \"pricesNotPublished\" FROM {HD} a JOIN {HD} b ON b.asset = a.asset WHERE a.arm = 'MARKOWITZ_BASE' AND b.arm = 'TOPN_MV_GUARD'", lambda t: Q.common_names(t, L, W, ARM, "TOPN_MV_GUARD", DAY))
ask("c17c_invested", "v_book_weight_daily assets", f"SELECT arm, count(DISTINCT asset) AS positions, sum(weight) AS \"investedWeight\" FROM {HD} WHERE arm IN ('MARKOWITZ_BASE', 'TOPN_MV_GUARD') GROUP BY 1", lambda t: Q.invested(t, L, W, [ARM, "TOPN_MV_GUARD"], DAY))
ask("c18_weak_holdings", "v_book_weight_daily assets filings assessments", f"""SELECT h.ticker, m.roic, m.debt, a.score, a.rating, a.generated, masked AS "pricesNotPublished", CASE WHEN m.roic < 0.18 THEN 'low ROIC; ' ELSE '' END || CASE WHEN m.debt > 1.5 THEN 'high debt; ' ELSE '' END || CASE WHEN coalesce(a.score, 100) < 40 THEN 'low assessment' ELSE '' END AS reason
    FROM {HD} h JOIN LATERAL {latest(MET, 'h.asset', D, 'roic', 'debt')} m ON true LEFT JOIN LATERAL {latest(ASM, 'h.asset', D)} a ON true WHERE arm = 'MARKOWITZ_BASE' AND (a.asset IS NOT NULL OR NOT EXISTS (SELECT 1 FROM {ASM} z WHERE z.asset = h.asset)) AND (m.roic < 0.18 OR m.debt > 1.5 OR coalesce(a.score, 100) < 40)""", lambda t: Q.weak_holdings(t, L, W, ARM, DAY, 0.18, 1.5, 40))
ask("c19_assessment_changes", "assessments filings stops assets", f"""SELECT tk.ticker, f.period_end AS "periodEnd", a.available_at AS "availableAt", a.score_raw_0_100 AS score, a.rating, a.generated_by_language_model AS generated, b.score_raw_0_100 AS "previousScore", s.date AS "stopDate", masked AS "pricesNotPublished" FROM assessments a {TK} a.asset_id JOIN filings f ON f.filing_id = a.filing_id
    LEFT JOIN assessments b ON b.asset_id = a.asset_id AND b.available_at = (SELECT max(available_at) FROM assessments z WHERE z.asset_id = a.asset_id AND z.available_at < a.available_at) LEFT JOIN stops s ON s.asset_id = a.asset_id AND s.win = 'P7' AND s.date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
    WHERE a.ticker = 'T10' AND a.available_at BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""", lambda t: Q.assessment_changes(t, "T10", L, W, "1996-01-01", "1998-12-31"))
ask("c20_filing_coverage", "v_book_weight_daily assets filings assessments", f"""SELECT DISTINCT h.ticker, (SELECT count(DISTINCT filing_id) FROM filings f WHERE f.ticker = h.ticker AND f.available_at <= {D}) AS filings, (SELECT count(DISTINCT snapshot_id) FROM assessments a WHERE a.ticker = h.ticker AND a.available_at <= {D}) AS assessments, masked AS "pricesNotPublished" FROM {HD} h WHERE arm = 'MARKOWITZ_BASE'
    AND (NOT EXISTS (SELECT 1 FROM filings f WHERE f.ticker = h.ticker) OR EXISTS (SELECT 1 FROM filings f WHERE f.ticker = h.ticker AND f.available_at <= {D})) AND (NOT EXISTS (SELECT 1 FROM assessments f WHERE f.ticker = h.ticker) OR EXISTS (SELECT 1 FROM assessments f WHERE f.ticker = h.ticker AND f.available_at <= {D}))""", lambda t: Q.filing_coverage(t, L, W, ARM, DAY))
