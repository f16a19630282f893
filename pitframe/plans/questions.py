"""Named questions over class tables; each is a composition of the operators with typed parameters.

``t`` maps a class to its table (see ``entities``), plus ``assets`` (subject, tickerSymbol,
companyName, classifiedAs, isFund), ``industries`` (industry, industryLabel, sectorLabel,
sectorDefinition), ``rules`` (subject, ruleId, category, guardLayer, note, validTo) and ``masked``
(subject). A book is chosen by run label, window and, where a question names one, arm.
Ordering is left to the caller; ``limit`` bounds an answer after its own order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.functions import scalars as S
from pitframe.operators import metrics as M
from pitframe.operators import temporal as T

Tables = Mapping[str, DataFrame]
FUND = "core fund"


def _day(value) -> Column:
    return F.lit(value).cast("date")


def bounded(df: DataFrame, order: Sequence[Column], limit: int | None) -> DataFrame:
    """An answer in its order, cut only where a limit is asked for."""
    return df if limit is None else df.orderBy(*order).limit(limit)


def _book(t: Tables, label: str | None = None, window: str | None = None, arm: str | None = None) -> DataFrame:
    b = t["StrategyBook"].select(F.col("subject").alias("book"), F.col("runLabel").alias("label"), F.col("windowId").alias("window"), F.col("armCode").alias("arm"))
    for column, value in (("label", label), ("window", window), ("arm", arm)):
        if value is not None:
            b = b.filter(F.col(column) == value)
    return b


def _of(t: Tables, cls: str, link: str, book: DataFrame, *columns: str) -> DataFrame:
    """Rows of a class that belong to the chosen books, the wanted columns only."""
    rows = t[cls].select("subject", F.col(link).alias("book"), *columns)
    return rows.join(book, "book")


def _asset(t: Tables, *columns: str) -> DataFrame:
    return t["assets"].select(F.col("subject").alias("asset"), *columns)


def _ticker(t: Tables, df: DataFrame, asset: str = "asset", out: str = "ticker", how: str = "inner") -> DataFrame:
    return df.join(t["assets"].select(F.col("subject").alias(asset), F.col("tickerSymbol").alias(out)), asset, how)


def _masked(t: Tables, df: DataFrame, *assets: str) -> DataFrame:
    """Add ``pricesNotPublished``: whether any of the row's assets is masked."""
    flag = F.lit(False)
    for i, a in enumerate(assets):
        df = df.join(t["masked"].select(F.col("subject").alias(a), F.lit(True).alias(f"_m{i}")), a, "left")
        flag = flag | F.coalesce(F.col(f"_m{i}"), F.lit(False))
    return df.withColumn("pricesNotPublished", flag).drop(*[f"_m{i}" for i in range(len(assets))])


def _sector(t: Tables, df: DataFrame, asset: str = "asset") -> DataFrame:
    """Add ``sector``: the asset's sector, the fund bucket, or unclassified; NULL assets join nothing."""
    a = t["assets"].select(F.col("subject").alias(asset), F.col("classifiedAs").alias("industry"), "isFund").join(
        t["industries"].select("industry", "sectorLabel"), "industry", "left").drop("industry")
    label = F.coalesce(F.when(F.col("isFund"), F.lit(FUND)), F.col("sectorLabel"), F.lit("unclassified"))
    return df.join(a, asset, "left").withColumn("sector", label).drop("isFund", "sectorLabel")


def _plain_sector(t: Tables, df: DataFrame, asset: str, out: str, how: str = "inner") -> DataFrame:
    a = t["assets"].select(F.col("subject").alias(asset), F.col("classifiedAs").alias("industry")).join(
        t["industries"].select("industry", F.col("sectorLabel").alias(out)), "industry", how).drop("industry")
    return df.join(a, asset, how)


def filing_metrics(t: Tables) -> DataFrame:
    """(asset, available, roic, debt): metric sets with their filing's asset and availability."""
    f = t["SECFiling"].select(F.col("subject").alias("filing"), F.col("filingOfAsset").alias("asset"), F.col("availableAt").alias("available"))
    m = t["FundamentalMetricSet"].select(F.col("metricSetOfFiling").alias("filing"), F.col("returnOnInvestedCapital").alias("roic"), F.col("debtToEquity").alias("debt"))
    return f.join(m, "filing").drop("filing")


def assessments(t: Tables) -> DataFrame:
    """(asset, assessed, score, rating, generated)."""
    return t["FundamentalAssessment"].select(F.col("assessmentOfAsset").alias("asset"), F.col("availableAt").alias("assessed"),
                                             F.col("scoreRaw0to100").alias("score"), "rating", F.col("generatedByLanguageModel").alias("generated"))


def holdings(t: Tables, as_of, book: DataFrame) -> DataFrame:
    """Positive holdings of the chosen books on a day: (book, label, window, arm, asset, weight)."""
    w = t["BookWeightDaily"].filter((F.col("weightDate") == _day(as_of)) & (F.col("finalTargetWeight") > 0) & F.col("holdingAsset").isNotNull())
    return w.select(F.col("weightOfBook").alias("book"), F.col("holdingAsset").alias("asset"), F.col("finalTargetWeight").alias("weight")).join(book, "book")


# --- glossary ---


def _texts(quads: DataFrame, predicate: str, out: str) -> DataFrame:
    return quads.filter(F.col("predicate") == predicate).select(F.col("subject").alias("term"), F.col("object").alias(out), "lang")


def term_definitions(tbox: DataFrame, external: DataFrame, terms: Sequence[str] | None = None, lang: str = "es") -> DataFrame:
    """A1: our terms with label and definition in a language; link and external definition as one optional unit."""
    own = _texts(tbox, "label", "label").filter(F.col("lang") == lang).drop("lang").join(_texts(tbox, "definition", "definition").filter(F.col("lang") == lang).drop("lang"), "term")
    if terms is not None:
        own = own.filter(F.col("term").isin(*terms))
    ext = external_definitions(external, lang)
    link = tbox.filter(F.col("predicate") == "seeAlso").select(F.col("subject").alias("term"), F.col("object").alias("external"))
    return own.join(link.join(ext, "external"), "term", "left")


def external_definitions(external: DataFrame, lang: str = "es") -> DataFrame:
    """External terms with a definition in another language and, optionally, texts in the wanted one."""
    d = _texts(external, "definition", "externalDefinition")
    base = d.filter(~S.lang_matches(F.col("lang"), lang)).drop("lang")
    label = _texts(external, "label", "externalLabel").filter(F.col("lang") == lang).drop("lang")
    own = d.filter(F.col("lang") == lang).drop("lang").withColumnRenamed("externalDefinition", "externalDefinitionLocal")
    return base.join(label, "term", "left").join(own, "term", "left").withColumnRenamed("term", "external")


def term_by_label(external: DataFrame, labels: Sequence[str], lang: str = "es") -> DataFrame:
    """A2: external terms whose label in a language is one of the given, compared in lower case."""
    hit = _texts(external, "label", "label").filter((F.col("lang") == lang) & F.lower("label").isin(*[x.lower() for x in labels])).select("term").distinct()
    return external_definitions(external, lang).join(hit.withColumnRenamed("term", "external"), "external").select("external", "externalDefinition", "externalDefinitionLocal")


def definition_search(tbox: DataFrame, word: str, lang: str = "es") -> DataFrame:
    """Q-3: definitions in a language that contain a word."""
    return _texts(tbox, "definition", "definition").filter((F.col("lang") == lang) & F.lower("definition").contains(word.lower())).select("term", "definition")


# --- catalogue ---


def active_rules(t: Tables, categories: Sequence[str] = ("DATA_QUALITY", "FINANCIAL", "MARKET", "GUARD")) -> DataFrame:
    return t["rules"].filter(F.col("validTo").isNull() & F.col("category").isin(*categories)).select("category", "ruleId", F.col("subject").alias("rule"))


def universe_members(t: Tables, day) -> DataFrame:
    m = t["UniverseMembership"].select(F.col("membershipAsset").alias("asset"), "validFrom", "validTo")
    return _ticker(t, T.members_at(m, _day(day), "validFrom", "validTo"))


def ticker_on_date(t: Tables, symbol: str, day) -> DataFrame:
    """Q-4.2: the latest ticker-history snapshot, then the rows of a symbol holding on a day."""
    h = t["TickerHistory"]
    latest = h.filter(F.col("graph") == h.agg(F.max("graph")).scalar()).filter(F.col("historicalSymbol") == symbol)
    return T.members_at(latest, _day(day), "validFrom", "validTo").select(
        F.col("graph").alias("snapshot"), F.col("tickerHistoryCik").alias("cik"), F.col("historicalSymbol").alias("symbol"), F.col("canonicalSymbol").alias("canonical"), F.col("tickerHistoryAsset").alias("asset"))


def run_labels(t: Tables) -> DataFrame:
    return _book(t).groupBy("label").agg(F.countDistinct("window").alias("windows"), F.countDistinct("book").alias("books"))


def windows_present(t: Tables) -> DataFrame:
    s = _of(t, "PortfolioPeriodSummary", "summaryOfBook", _book(t), "dateFrom", "dateTo")
    return s.groupBy("label", "window").agg(F.min("dateFrom").alias("dateFrom"), F.max("dateTo").alias("dateTo"))


def arms_present(t: Tables) -> DataFrame:
    return _book(t).groupBy("label", "window", "arm").agg(F.count(F.lit(1)).alias("books"))


def runs_available(t: Tables) -> DataFrame:
    return _book(t).groupBy("label", "window").agg(F.countDistinct("book").alias("books"))


def rebalance_dates(t: Tables, label: str, window: str) -> DataFrame:
    return _of(t, "BookRebalance", "rebalanceOfBook", _book(t, label, window), F.col("decisionDate").alias("decision"), F.col("executionDate").alias("execution"), "cycleRunId").select(
        "label", "window", "arm", "decision", "execution", "cycleRunId")


def _cycles(t: Tables, label: str, window: str) -> DataFrame:
    return t["SelectionCycle"].filter((F.col("runLabel") == label) & (F.col("windowId") == window)).select(
        F.col("subject").alias("cycle"), F.col("runLabel").alias("label"), F.col("windowId").alias("window"), "cycleRunId", F.col("runAsOf").alias("cycleDate"))


def decision_cycles(t: Tables, label: str, window: str) -> DataFrame:
    r = rebalance_dates(t, label, window).select("label", "window", "cycleRunId", "arm").join(_cycles(t, label, window), ["label", "window", "cycleRunId"])
    return M.listagg(r, ["label", "window", "cycleRunId", "cycleDate"], "arm", "arms")


def warm_up_cycles(t: Tables, label: str, window: str) -> DataFrame:
    used = rebalance_dates(t, label, window).select("cycleRunId")
    return _cycles(t, label, window).join(used, "cycleRunId", "left_anti").select("label", "window", "cycleRunId", "cycleDate")


def performance_by_segment(t: Tables, label: str, window: str) -> DataFrame:
    return _of(t, "PortfolioPeriodSummary", "summaryOfBook", _book(t, label, window), "segment", "cumulativeReturn", "annualizedReturn", "exPostSharpe").select(
        "label", "window", "arm", "segment", F.col("subject").alias("summary"), "cumulativeReturn", "annualizedReturn", "exPostSharpe")


def _acted_alerts(t: Tables, book: DataFrame) -> DataFrame:
    a = t["GuardAction"].select(F.col("actionAlert").alias("alert"), F.col("actionOfBook").alias("book"), F.col("subject").alias("action"), "status", F.col("guardTicker").alias("ticker"), F.col("guardAsset").alias("asset"), "effectiveDate", "weightBefore", "weightAfter")
    r = t["rules"].select(F.col("subject").alias("alertRule"), "ruleId", "guardLayer", "note")
    al = t["GuardAlert"].select(F.col("subject").alias("alert"), "alertId", "alertDate", "alertRule", "alertState").join(r, "alertRule")
    return a.join(book, "book").join(al, "alert")


def alerts_by_month(t: Tables, label: str, window: str, month: str | None = None) -> DataFrame:
    rows = M.alerts_by_month(_acted_alerts(t, _book(t, label, window)), ["label", "window", "ruleId"], "alertDate", "alert")
    return rows if month is None else rows.filter(F.col("month") == month)


def latest_nav(t: Tables, label: str, window: str, known) -> DataFrame:
    """Q-5.3: latest NAV per arm among the rows known on a date; ties kept."""
    p = _of(t, "BookDailyPerformance", "performanceOfBook", _book(t, label, window), F.col("performanceDate").alias("date"), "nav", "knowledgeDate")
    return T.latest_per(p, ["label", "window", "arm"], "date", "knowledgeDate", _day(known)).select("label", "arm", "date", "nav")


def equities_on_last_day(t: Tables, label: str, window: str) -> DataFrame:
    p = _of(t, "BookDailyPerformance", "performanceOfBook", _book(t, label, window), F.col("performanceDate").alias("date"), "nEquity")
    return T.latest_per(p, ["label", "window", "arm"], "date").select("label", "window", "arm", "date", "nEquity")


def cut_tickers(t: Tables, label: str, window: str) -> DataFrame:
    rows = _acted_alerts(t, _book(t, label, window)).filter("status = 'APPLIED' AND guardLayer = 1 AND ticker IS NOT NULL")
    return M.counts_by(rows, ["label", "window", "arm", "ticker"])


def cut_explanation(t: Tables, alert_id: int, label: str, window: str) -> DataFrame:
    """Q-5.5: one alert with its rule and, optionally, the actions it led to."""
    r = t["rules"].select(F.col("subject").alias("alertRule"), "ruleId", F.col("note").alias("ruleNote"))
    a = t["GuardAlert"].filter((F.col("alertId") == alert_id) & (F.col("windowId") == window)).select(F.col("subject").alias("alert"), "alertRule").join(r, "alertRule")
    acts = t["GuardAction"].select(F.col("actionAlert").alias("alert"), F.col("actionOfBook").alias("book"), "status").join(_book(t, label, window), "book")
    return a.join(acts, "alert", "left").filter(F.col("label").isNull() | (F.col("label") == label)).select("label", "alert", "ruleId", "ruleNote", "arm", "status")


def knowledge_dates(t: Tables, label: str, window: str) -> DataFrame:
    b = t["StrategyBook"].filter((F.col("runLabel") == label) & (F.col("windowId") == window))
    return b.groupBy(F.col("runLabel").alias("label"), F.col("windowId").alias("window"), F.col("armCode").alias("arm")).agg(F.min("knowledgeDate").alias("firstKnown"), F.max("knowledgeDate").alias("lastKnown"))


def weight_scale(t: Tables, label: str, window: str) -> DataFrame:
    w = _of(t, "BookWeightDaily", "weightOfBook", _book(t, label, window))
    return w.groupBy("label", "window", "arm").agg(F.count(F.lit(1)).alias("weights"))


def _snapshots(t: Tables, label: str, window: str) -> DataFrame:
    s = t["AttractivenessSnapshot"].filter((F.col("runLabel") == label) & (F.col("windowId") == window))
    s = s.select("subject", F.col("rankingOfCycle").alias("cycle"), F.col("rankPosition").alias("rank"), F.col("rankingTicker").alias("ticker"), F.col("attractivenessScore").alias("score"), F.col("selectedForBook").alias("selected"),
                 F.col("vetoedAtRanking").alias("vetoed"), F.col("vetoRulesJson").alias("rules"), F.col("targetWeight").alias("cycleTarget"), F.col("attractivenessOfAsset").alias("asset"), F.col("hasEffectiveWeight").alias("components"))
    return s.join(_cycles(t, label, window).select("cycle", F.col("cycleDate").alias("date")), "cycle")


def ranking_at(t: Tables, label: str, window: str, day) -> DataFrame:
    return _snapshots(t, label, window).filter(F.col("date") == _day(day)).select("rank", "ticker", "score", "selected", "cycleTarget", "vetoed", "rules")


def vetoes_in_force(t: Tables, label: str, window: str, day) -> DataFrame:
    v = t["Veto"].filter((F.col("runLabel") == label) & (F.col("windowId") == window))
    v = T.active_at(v, _day(day), "raisedOn", "clearedOn").withColumnRenamed("appliesRule", "rule")
    return v.join(t["rules"].select(F.col("subject").alias("rule"), "ruleId"), "rule").select(F.col("vetoTicker").alias("ticker"), "ruleId", F.col("vetoSeverity").alias("severity"), F.col("raisedOn").alias("raised"), F.col("clearedOn").alias("cleared"))


def why_not_selected(t: Tables, label: str, window: str, day, ticker: str) -> DataFrame:
    s = _snapshots(t, label, window).filter((F.col("date") == _day(day)) & (F.col("ticker") == ticker))
    return s.select("ticker", "rank", "selected", "vetoed", "rules", "score", F.coalesce(F.size("components"), F.lit(0)).alias("components"))


def trend_cash(t: Tables, label: str, window: str) -> DataFrame:
    s = t["TrendFilterState"]
    return s.filter((F.col("runLabel") == label) & (F.col("trendWindow") == window) & (F.col("trendState") == "below")).select(F.col("trendDecisionDate").alias("date"), "cashFraction")


def reference_returns(t: Tables, label: str, window: str, segment: str) -> DataFrame:
    r = t["ReferenceReturn"].filter((F.col("runLabel") == label) & (F.col("returnWindow") == window) & (F.col("returnSegment") == segment)).select(
        F.col("returnSegment").alias("segment"), F.col("referenceName").alias("reference"), F.col("referenceTotalReturn").alias("totalReturn"), F.col("referenceMaxDrawdown").alias("maxDrawdown"))
    s = _of(t, "PortfolioPeriodSummary", "summaryOfBook", _book(t, label, window), "segment", F.col("cumulativeReturn").alias("armReturn")).select("segment", "arm", "armReturn")
    return r.join(s, "segment").drop("segment")


def sector_cuts(t: Tables, label: str, window: str) -> DataFrame:
    a = _acted_alerts(t, _book(t, label, window)).filter("status = 'APPLIED' AND alertState = 'ENTER' AND guardLayer = 1")
    return M.counts_by(_sector(t, a), ["label", "window", "arm", "sector"], "action")


def sector_composition(t: Tables, label: str, window: str, arm: str, decision) -> DataFrame:
    """Q-6.2: sector weights on the execution day of a decision, the cash weight as a column."""
    r = _of(t, "BookRebalance", "rebalanceOfBook", _book(t, label, window, arm), F.col("decisionDate").alias("decision"), F.col("executionDate").alias("weightDate")).filter(F.col("decision") == _day(decision)).drop("subject")
    w = t["BookWeightDaily"].select(F.col("weightOfBook").alias("book"), "weightDate", "holdingKey", F.col("holdingAsset").alias("asset"), F.col("finalTargetWeight").alias("w")).join(r, ["book", "weightDate"])
    out = M.sector_weights(_sector(t, w), "w", ["label", "window", "arm", "decision", "weightDate"], "sector", "holdingKey")
    return out.filter(F.col("cash").isNotNull())


def held_by_industry(t: Tables, label: str, window: str, industries: Sequence[str]) -> DataFrame:
    w = _of(t, "BookWeightDaily", "weightOfBook", _book(t, label, window), F.col("holdingKey").alias("ticker"), F.col("holdingAsset").alias("asset"), "finalTargetWeight").filter("ticker <> 'CASH' AND finalTargetWeight > 0")
    a = _asset(t, F.col("classifiedAs").alias("industry")).join(t["industries"].select("industry", "industryLabel"), "industry").filter(F.col("industryLabel").isin(*industries)).drop("industry")
    once = w.join(a, "asset").select("label", "window", "arm", F.col("industryLabel").alias("industry"), "ticker").distinct()
    return once.groupBy("label", "window", "arm", "industry").agg(F.count(F.lit(1)).alias("tickers"), F.array_join(F.array_sort(F.collect_list("ticker")), ", ").alias("tickerList"))


def holding_coverage(t: Tables, label: str, window: str) -> DataFrame:
    w = _of(t, "BookWeightDaily", "weightOfBook", _book(t, label, window), F.col("holdingKey").alias("ticker"), F.col("holdingAsset").alias("asset"), "finalTargetWeight").filter("ticker <> 'CASH' AND finalTargetWeight > 0")
    s = _sector(t, w.select("label", "window", "ticker", "asset").distinct())
    return s.groupBy("label", "window").agg(F.countDistinct("ticker").alias("heldTickers"), F.countDistinct("asset").alias("withAsset"),
                                            F.countDistinct(F.when(F.col("sector") != "unclassified", F.col("asset"))).alias("withSector"), F.countDistinct(F.when(F.col("sector") == FUND, F.col("asset"))).alias("etfTickers"))


def unclassified_by_year(t: Tables) -> DataFrame:
    m = t["UniverseMembership"].select(F.col("membershipAsset").alias("asset"), F.col("validTo").alias("valid_to"))
    known = m.join(_asset(t), "asset", "left_semi")
    return M.unclassified_by_year(known, _asset(t, "classifiedAs").filter("classifiedAs IS NOT NULL"), _asset(t, "isFund").filter("isFund"))


def sector_of(t: Tables, ticker: str) -> DataFrame:
    a = t["assets"].filter(F.col("tickerSymbol") == ticker).select("tickerSymbol", "companyName", F.col("classifiedAs").alias("industry"), "isFund")
    row = a.join(t["industries"], "industry", "left").filter(F.col("isFund") | F.col("sectorLabel").isNotNull())
    sector = F.when(F.col("isFund"), F.lit(FUND)).otherwise(F.col("sectorLabel"))
    return row.select(F.col("tickerSymbol").alias("ticker"), "companyName", F.when(~F.col("isFund"), F.col("industryLabel")).alias("industryLabel"), sector.alias("sectorLabel"), F.when(~F.col("isFund"), F.col("sectorDefinition")).alias("sectorDefinition")).distinct()


# --- analyst questions ---


def _stops(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    return _of(t, "StopEvent", "stopOfBook", _book(t, label, window, arm), F.col("stoppedAsset").alias("asset"), F.col("stopDate").alias("date"), "chooser", "stopCashCause", "chosenCash", "chosenOption").withColumnRenamed("subject", "stop")


def quality_at_stop(t: Tables, label: str, window: str, as_of, limit: int | None = None, arm: str | None = None) -> DataFrame:
    """Latest complete metrics and latest assessment known on each stop's day."""
    s = _ticker(t, _stops(t, label, window, arm).filter(F.col("date") <= _day(as_of)).select("stop", "asset", F.col("date").alias("stopDate")))
    m = filing_metrics(t)
    s = T.asof_join(s, m, ["asset"], "stopDate", "available", require=["roic", "debt"])
    s = _masked(t, T.asof_join(s, assessments(t), ["asset"], "stopDate", "assessed"), "asset")
    out = s.select("stopDate", "ticker", "roic", "debt", "score", "rating", "generated", "pricesNotPublished")
    return bounded(out, [F.asc("stopDate"), F.asc("ticker")], limit)


def _purchases(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    s = _stops(t, label, window, arm).select("stop", F.col("asset").alias("sold"), F.col("date").alias("stopDate"))
    p = t["ReplacementPurchase"].select(F.col("subject").alias("purchase"), F.col("purchaseOfStop").alias("stop"), F.col("replacementAsset").alias("bought"), "orderDate", F.col("replacementExecutionDate").alias("executionDate"), "replacementWeight", "replacementRank")
    p = p.join(s, "stop")
    return _ticker(t, _ticker(t, p, "sold", "soldTicker"), "bought", "replacementTicker")


def replacement_sectors(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    """Sectors of a sold asset and its replacement."""
    p = _plain_sector(t, _plain_sector(t, _purchases(t, label, window, arm), "sold", "soldSector"), "bought", "replacementSector")
    p = _masked(t, p.withColumn("sameSector", F.col("soldSector") == F.col("replacementSector")), "sold", "bought")
    return p.select("stopDate", "soldTicker", "replacementTicker", "orderDate", "executionDate", "soldSector", "replacementSector", "sameSector", "pricesNotPublished")


def replacement_quality(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    """Metrics as of the order; assessments are all those known by then, so rows multiply."""
    p = _purchases(t, label, window, arm)
    m, a = filing_metrics(t).filter("roic IS NOT NULL"), assessments(t).drop("rating")
    for side, key in (("sold", "sold"), ("replacement", "bought")):
        ms = m.select(F.col("asset").alias(key), F.col("available").alias(f"_{side}At"), F.col("roic").alias(f"{side}Roic"), F.col("debt").alias(f"{side}Debt"))
        # only the ROIC decides which filing is the latest; the filing must hold a debt value too
        rows = T.asof_join(p.select("purchase", key, "orderDate"), ms, [key], "orderDate", f"_{side}At", how="inner").filter(F.col(f"{side}Debt").isNotNull())
        p = p.join(rows.select("purchase", f"{side}Roic", f"{side}Debt"), "purchase", "left")
    for side, key in (("sold", "sold"), ("replacement", "bought")):
        gen = "oldGenerated" if side == "sold" else "newGenerated"
        s = a.select(F.col("asset").alias("_k"), F.col("assessed").alias("_at"), F.col("score").alias(f"{side}Score"), F.col("generated").alias(gen))
        p = p.join(s, (F.col(key) == F.col("_k")) & (F.col("_at") <= F.col("orderDate")), "left").drop("_k", "_at")
    p = _masked(t, p, "sold", "bought")
    return p.select("stopDate", "soldTicker", "replacementTicker", "soldRoic", "replacementRoic", "soldDebt", "replacementDebt", "soldScore", "replacementScore", "oldGenerated", "newGenerated", "pricesNotPublished")


def weighted_quality(t: Tables, label: str, window: str, arms: Sequence[str], as_of) -> DataFrame:
    """Weighted metrics per arm of its holdings with complete latest filings."""
    h = holdings(t, as_of, _book(t, label, window).filter(F.col("arm").isin(*arms)))
    m = T.asof_latest(filing_metrics(t), ["asset"], "available", _day(as_of), ["roic", "debt"])
    out = M.weighted_profile(h.join(m, "asset"), "weight", ["roic", "debt"], ["arm"], "asset")
    return out.select("arm", F.col("weighted_roic").alias("weightedRoic"), F.col("weighted_debt").alias("weightedDebt"), F.col("covered_weight").alias("coveredWeight"), "positions")


def vetoed_but_strong(t: Tables, label: str, window: str, as_of, min_score, limit: int | None = None) -> DataFrame:
    """Vetoes in force on a day whose asset's latest assessment is high."""
    v = t["Veto"].filter((F.col("runLabel") == label) & (F.col("windowId") == window))
    v = T.active_at(v, _day(as_of), "raisedOn", "clearedOn").select(F.col("vetoOfAsset").alias("asset"), F.col("appliesRule").alias("rule"))
    v = _ticker(t, v.join(t["rules"].select(F.col("subject").alias("rule"), "ruleId"), "rule"))
    a = T.asof_latest(assessments(t), ["asset"], "assessed", _day(as_of))
    out = _masked(t, v.join(a, "asset").filter(F.col("score") >= min_score), "asset").select("ticker", "ruleId", "score", "rating", "generated", "pricesNotPublished")
    return bounded(out, [F.desc("score"), F.asc("ticker"), F.asc("ruleId")], limit)


def selected_but_weak(t: Tables, label: str, window: str, as_of, max_score) -> DataFrame:
    """Names selected on a day whose latest assessment is low."""
    s = _snapshots(t, label, window).filter((F.col("date") == _day(as_of)) & F.col("selected")).select("asset", "ticker")
    a = T.asof_latest(assessments(t), ["asset"], "assessed", _day(as_of))
    return _masked(t, s.join(a, "asset").filter(F.col("score") < max_score), "asset").select("ticker", "score", "rating", "generated", "pricesNotPublished")


def veto_concentration(t: Tables, label: str, window: str, start, end) -> DataFrame:
    """Vetoes per sector and rule with the mean latest assessment."""
    v = t["Veto"].filter((F.col("runLabel") == label) & (F.col("windowId") == window) & F.col("raisedOn").between(_day(start), _day(end)))
    v = v.select(F.col("subject").alias("veto"), F.col("vetoOfAsset").alias("asset"), F.col("appliesRule").alias("rule")).join(t["rules"].select(F.col("subject").alias("rule"), "ruleId"), "rule")
    a = T.asof_latest(assessments(t), ["asset"], "assessed", _day(end))
    rows = _plain_sector(t, v, "asset", "sectorLabel").join(a, "asset", "left")
    return M.veto_concentration(rows, ["sectorLabel", "ruleId"], "veto", "score", "generated").select("sectorLabel", "ruleId", "vetoes", F.col("average_score").alias("averageAssessment"), F.col("flagged").alias("generatedAssessments"))


def industry_exposure(t: Tables, label: str, window: str, industry: str, arm: str | None = None) -> DataFrame:
    """Weight and names of one industry on every decision day."""
    d = _of(t, "DecisionEvent", "decisionOfBook", _book(t, label, window, arm), F.col("decisionDate").alias("date"), "exposureScale").drop("subject")
    w = t["BookWeightDaily"].filter("finalTargetWeight > 0").select(F.col("weightOfBook").alias("book"), F.col("weightDate").alias("date"), F.col("holdingAsset").alias("asset"), F.col("finalTargetWeight").alias("w"))
    a = _in_industry(t, industry)
    return M.exposure(w.join(d, ["book", "date"]).join(a, "asset"), ["date", "exposureScale"], "w", "asset")


def _in_industry(t: Tables, industry: str, *columns: str) -> DataFrame:
    a = _asset(t, F.col("classifiedAs").alias("industry"), *columns)
    return a.join(t["industries"].filter(F.col("industryLabel") == industry).select("industry"), "industry", "left_semi").drop("industry")


def _choices(t: Tables, stops: DataFrame) -> DataFrame:
    """Stops with the chosen option's asset, fund flag and ticker."""
    o = t["DestinationOption"].select(F.col("subject").alias("chosenOption"), F.col("optionAsset").alias("chosenAsset"), F.col("optionIsSpy").alias("isSpy"))
    # an option without a linked asset is no chosen option
    return _ticker(t, stops.join(o.filter("chosenAsset IS NOT NULL"), "chosenOption", "left"), "chosenAsset", "chosenTicker", "left").withColumn(
        "destination", S.destination(F.col("chosenCash"), F.col("isSpy"), F.col("chosenTicker")))


def industry_stops(t: Tables, label: str, window: str, industry: str, arm: str | None = None) -> DataFrame:
    """Stops of one industry with their cause, chooser, destination and replacement."""
    s = _choices(t, _stops(t, label, window, arm)).join(_in_industry(t, industry, F.col("tickerSymbol").alias("ticker")), "asset")
    p = t["ReplacementPurchase"].select(F.col("purchaseOfStop").alias("stop"), F.col("replacementAsset").alias("replacement"))
    s = _ticker(t, s.join(p, "stop", "left"), "replacement", "replacementTicker", "left")
    return _masked(t, s, "asset").select("date", "ticker", F.col("stopCashCause").alias("cashCause"), "chooser", "destination", "pricesNotPublished", "replacementTicker")


def tail_risk(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    """Applied layer-0 actions with the weights and the cash of their effective day."""
    a = _acted_alerts(t, _book(t, label, window, arm)).filter("status = 'APPLIED' AND guardLayer = 0")
    p = t["BookDailyPerformance"].select(F.col("performanceOfBook").alias("book"), F.col("performanceDate").alias("effectiveDate"), "cashWeight")
    both = F.col("weightBefore").isNotNull() & F.col("weightAfter").isNotNull()
    return a.join(p, ["book", "effectiveDate"], "left").select(F.col("alertDate").alias("date"), "ruleId", "status", F.when(both, F.col("weightBefore")).alias("weightBefore"), F.when(both, F.col("weightAfter")).alias("weightAfter"), "cashWeight")


def nav_with_without(t: Tables, label: str, window: str, with_arm: str, without_arm: str, start, end) -> DataFrame:
    """NAV of two configurations on shared days and their ratio."""
    def nav(arm, out):
        p = _of(t, "BookDailyPerformance", "performanceOfBook", _book(t, label, window, arm), F.col("performanceDate").alias("date"), "nav")
        return p.filter(F.col("date").between(_day(start), _day(end))).select("date", F.col("nav").alias(out))
    both = nav(with_arm, "navWith").join(nav(without_arm, "navWithout"), "date")
    return both.withColumn("navRatio", F.try_divide(F.col("navWith").cast("double"), F.col("navWithout").cast("double")))


def performance_compare(t: Tables, label: str, window: str, arms: Sequence[str]) -> DataFrame:
    """Period summaries of the compared configurations."""
    return _of(t, "PortfolioPeriodSummary", "summaryOfBook", _book(t, label, window).filter(F.col("arm").isin(*arms)), "segment", "cumulativeReturn", "annualizedReturn", "exPostSharpe", "maxDrawdown", "nGuardActions").select(
        "arm", "segment", "cumulativeReturn", "annualizedReturn", "exPostSharpe", "maxDrawdown", "nGuardActions")


def paired_tests(t: Tables, label: str, window: str) -> DataFrame:
    """Paired tests of a window."""
    x = t["BacktestTest"]
    return x.filter((F.col("runLabel") == label) & (F.col("windowId") == window)).select("testName", "armA", "armB", "segment", "windowId", "statistic", "pValue", "nObs")


def top_weights(t: Tables, label: str, window: str, arm: str, as_of, k: int = 10) -> DataFrame:
    """The k largest holdings of a day."""
    h = _masked(t, _ticker(t, holdings(t, as_of, _book(t, label, window, arm))), "asset").select("ticker", "weight", "pricesNotPublished")
    return M.top_k(h, [F.desc("weight"), F.asc("ticker")], k)


def concentration(t: Tables, label: str, window: str, arm: str, as_of) -> DataFrame:
    """Positions, Herfindahl index and effective positions."""
    return M.concentration(holdings(t, as_of, _book(t, label, window, arm)), "weight", ["label", "window", "arm"], "asset").select("positions", "hhi", F.col("effective_positions").alias("effectivePositions"))


def largest_sectors(t: Tables, label: str, window: str, arm: str, as_of, k: int = 5) -> DataFrame:
    """The k largest sector weights."""
    h = _plain_sector(t, holdings(t, as_of, _book(t, label, window, arm)), "asset", "sectorLabel", "left")
    w = h.groupBy(F.coalesce("sectorLabel", F.lit("unclassified")).alias("bucket")).agg(F.sum("weight").alias("sectorWeight"))
    return M.top_k(w, [F.desc("sectorWeight"), F.asc("bucket")], k)


def worst_drawdowns(t: Tables, label: str, window: str, arm: str, k: int = 10) -> DataFrame:
    """C9d: the k largest drawdowns by size."""
    p = _of(t, "BookDailyPerformance", "performanceOfBook", _book(t, label, window, arm), F.col("performanceDate").alias("date"), "drawdown").select("date", "drawdown")
    return M.top_k(p, [F.desc(F.abs("drawdown")), F.asc("date")], k)


def stop_causes(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    """Stops and cash stops per cash cause."""
    s = _stops(t, label, window, arm).filter("stopCashCause IS NOT NULL").withColumnRenamed("stopCashCause", "cause")
    return M.stop_outcomes(s, ["window", "cause"], "chosenCash").withColumnRenamed("cash_stops", "cashStops")


def decision_menu(t: Tables, label: str, window: str, rule: str = "L1_BP_STOP", arm: str | None = None) -> DataFrame:
    """Each stop with its alert's rule and every option of its menu, the chosen one marked."""
    r = t["rules"].filter(F.col("ruleId") == rule).select(F.col("subject").alias("alertRule"), "ruleId")
    al = t["GuardAlert"].select(F.col("alertDate").alias("date"), F.col("guardAsset").alias("asset"), "alertRule").join(r, "alertRule").drop("alertRule")
    s = _ticker(t, _stops(t, label, window, arm), "asset", "stoppedTicker").join(al, ["date", "asset"])
    o = t["DestinationOption"].select(F.col("optionOfStop").alias("stop"), "menuPosition", "optionAsset", "optionIsSpy")
    c = t["DestinationOption"].select(F.col("subject").alias("chosenOption"), F.col("optionAsset").alias("chosenAsset"))
    s = s.join(o, "stop").join(c, "chosenOption", "left").withColumn("chosen", F.coalesce(F.col("chosenAsset") == F.col("optionAsset"), F.lit(False)))
    s = _masked(t, _ticker(t, s, "optionAsset", "optionTicker", "left"), "asset")
    return s.select(F.col("date").alias("stopDate"), "stoppedTicker", "ruleId", "chooser", "menuPosition", "optionTicker", "optionIsSpy", "chosenCash", "chosen", "pricesNotPublished")


def replacement_trail(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    """Purchases with their later checks."""
    c = t["ReplacementCheck"].select(F.col("checkOfPurchase").alias("purchase"), "checkDate", "candidate", "kept")
    p = _masked(t, _purchases(t, label, window, arm).join(c, "purchase", "left"), "sold", "bought")
    return p.select("stopDate", "soldTicker", "replacementTicker", "orderDate", "executionDate", "replacementWeight", "replacementRank", "checkDate", "candidate", "kept", "pricesNotPublished")


def company_profile(t: Tables, ticker: str, as_of) -> DataFrame:
    """Name, sector, latest metrics (the latest by ROIC) and latest assessment of one company."""
    a = t["assets"].filter(F.col("tickerSymbol") == ticker).select(F.col("subject").alias("asset"), F.col("tickerSymbol").alias("ticker"), "companyName")
    m = T.asof_latest(filing_metrics(t).join(a.select("asset"), "asset", "left_semi"), ["asset"], "available", _day(as_of), ["roic"]).filter("debt IS NOT NULL")
    x = T.asof_latest(assessments(t).join(a.select("asset"), "asset", "left_semi"), ["asset"], "assessed", _day(as_of))
    out = _plain_sector(t, a, "asset", "sectorLabel", "left").join(m, "asset", "left").join(x, "asset", "left")
    return _masked(t, out, "asset").select("ticker", "companyName", "sectorLabel", "roic", "debt", "score", "rating", "generated", "pricesNotPublished")


def company_timeline(t: Tables, ticker: str, label: str, window: str, arm: str | None = None) -> DataFrame:
    """Holdings, stops and memory starts of one company in one table."""
    a = t["assets"].filter(F.col("tickerSymbol") == ticker).select(F.col("subject").alias("asset"))
    b = _book(t, label, window, arm)
    mine = lambda df: df.join(a, "asset", "left_semi")
    h = mine(_of(t, "BookWeightDaily", "weightOfBook", b, F.col("holdingAsset").alias("asset"), F.col("weightDate").alias("date"), F.col("finalTargetWeight").alias("weight"))).select("asset", "date", "weight", F.lit("").alias("cause"), F.lit("").alias("destination"))
    s = mine(_stops(t, label, window, arm)).select("asset", "date", F.col("stopCashCause").alias("cause"), F.when(F.coalesce("chosenCash", F.lit(False)), "cash").otherwise(F.coalesce("stopCashCause", F.lit("asset"))).alias("destination"))
    m = mine(_of(t, "StopMemory", "memoryOfBook", b, F.col("memoryAsset").alias("asset"), F.col("memorySince").alias("date"), F.col("memoryReleaseCause").alias("cause"))).select("asset", "date", "cause", F.lit("").alias("destination"))
    return _masked(t, M.timeline({"holding": h, "stop": s, "memory": m}), "asset").select("event", "date", "weight", "cause", "destination", "pricesNotPublished")


def company_rankings(t: Tables, ticker: str, label: str, window: str) -> DataFrame:
    """Every ranking of one company."""
    return _masked(t, _snapshots(t, label, window).filter(F.col("ticker") == ticker), "asset").select("date", F.lit(window).alias("window"), "rank", "score", "selected", "vetoed", "rules", "pricesNotPublished")


def company_vetoes(t: Tables, ticker: str, label: str, window: str) -> DataFrame:
    """C12d: every veto stint of one company."""
    a = t["assets"].filter(F.col("tickerSymbol") == ticker).select(F.col("subject").alias("asset"))
    v = t["Veto"].filter((F.col("runLabel") == label) & (F.col("windowId") == window)).select(F.col("vetoOfAsset").alias("asset"), F.col("appliesRule").alias("rule"), F.col("raisedOn").alias("raised"), F.col("clearedOn").alias("cleared"), F.col("vetoSeverity").alias("severity"))
    return v.join(a, "asset", "left_semi").join(t["rules"].select(F.col("subject").alias("rule"), "ruleId"), "rule").select("raised", "cleared", "ruleId", "severity")


def known_on(t: Tables, ticker: str, as_of, limit: int | None = None) -> DataFrame:
    """Every filing of a company known on a day, with the metrics and assessments known by then.

    The outer filter is not part of the optional join: a filing whose only assessment came later
    does not appear without it.
    """
    a = t["assets"].filter(F.col("tickerSymbol") == ticker).select(F.col("subject").alias("asset"))
    f = t["SECFiling"].select(F.col("subject").alias("filing"), F.col("filingOfAsset").alias("asset"), "availableAt", "periodEnd", "formType").join(a, "asset", "left_semi").filter(F.col("availableAt") <= _day(as_of))
    m = t["FundamentalMetricSet"].filter("returnOnInvestedCapital IS NOT NULL AND debtToEquity IS NOT NULL").select(F.col("metricSetOfFiling").alias("filing"), F.col("returnOnInvestedCapital").alias("roic"), F.col("debtToEquity").alias("debt"))
    x = t["FundamentalAssessment"].select(F.col("assessmentOfFiling").alias("filing"), F.col("availableAt").alias("_at"), F.col("scoreRaw0to100").alias("score"), "rating", F.col("generatedByLanguageModel").alias("generated"))
    out = f.join(m, "filing", "left").join(x, "filing", "left").filter(F.col("_at").isNull() | (F.col("_at") <= _day(as_of)))
    out = _masked(t, out, "asset").select("formType", "periodEnd", "availableAt", "roic", "debt", "score", "rating", "generated", "pricesNotPublished")
    return bounded(out, [F.desc("availableAt"), F.asc("periodEnd")], limit)


def retained_names(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    """C14: retained and rejected names of each decision with every later stop of the asset."""
    d = _of(t, "RetentionDecision", "retentionOfBook", _book(t, label, window, arm), F.col("retentionDate").alias("decisionDate")).select("book", F.col("subject").alias("decision"), "decisionDate")
    h = t["RetentionHold"].select(F.col("holdOfDecision").alias("decision"), F.col("retainedAsset").alias("asset"), "retentionCounter", F.lit("").alias("rejectionCause"))
    r = t["RetentionRejection"].select(F.col("rejectionOfDecision").alias("decision"), F.col("rejectedAsset").alias("asset"), "retentionCounter", "rejectionCause")
    rows = _ticker(t, M.timeline({"retained": h, "rejected": r}, "outcome").join(d, "decision"))
    s = t["StopEvent"].select(F.col("stopOfBook").alias("book"), F.col("stoppedAsset").alias("asset"), F.col("stopDate").alias("laterStopDate"))
    rows = T.later_events(rows, s, ["book", "asset"], "decisionDate", "laterStopDate")
    return _masked(t, rows, "asset").select("decisionDate", "ticker", "outcome", "retentionCounter", "rejectionCause", "laterStopDate", "pricesNotPublished")


def time_to_return(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    """Memory episodes with the stops after their release; an open one matches any stop."""
    m = _of(t, "StopMemory", "memoryOfBook", _book(t, label, window, arm), F.col("memoryAsset").alias("asset"), F.col("memorySince").alias("since"), F.col("memoryStartKind").alias("startKind"), F.col("memoryReleasedOn").alias("released"), F.col("memoryReleaseCause").alias("releaseCause"))
    s = t["StopEvent"].select(F.col("stopOfBook").alias("book"), F.col("stoppedAsset").alias("asset"), F.col("stopDate").alias("nextStopDate"))
    rows = T.later_events(_ticker(t, m), s, ["book", "asset"], "released", "nextStopDate", open_ok=True)
    return _masked(t, rows, "asset").select("ticker", "startKind", "since", "released", "releaseCause", "nextStopDate", "pricesNotPublished")


def chooser_destination(t: Tables, label: str, window: str, arm: str | None = None) -> DataFrame:
    """Stops per chooser and destination."""
    return M.counts_by(_choices(t, _stops(t, label, window, arm)), ["chooser", "destination"], out="stops")


def composition(t: Tables, label: str, window: str, arms: Sequence[str], as_of) -> DataFrame:
    """Holdings of two configurations with their sectors."""
    h = _ticker(t, holdings(t, as_of, _book(t, label, window).filter(F.col("arm").isin(*arms))))
    return _masked(t, _plain_sector(t, h, "asset", "sectorLabel", "left"), "asset").select("arm", "ticker", "weight", "sectorLabel", "pricesNotPublished")


def common_names(t: Tables, label: str, window: str, arm_a: str, arm_b: str, as_of) -> DataFrame:
    """Names both configurations hold, their weights side by side."""
    h = lambda arm, out: holdings(t, as_of, _book(t, label, window, arm)).select("asset", F.col("weight").alias(out))
    return _masked(t, _ticker(t, h(arm_a, "weightA").join(h(arm_b, "weightB"), "asset")), "asset").select("ticker", "weightA", "weightB", "pricesNotPublished")


def invested(t: Tables, label: str, window: str, arms: Sequence[str], as_of) -> DataFrame:
    """Positions and invested weight per configuration."""
    h = holdings(t, as_of, _book(t, label, window).filter(F.col("arm").isin(*arms)))
    return h.groupBy("arm").agg(F.countDistinct("asset").alias("positions"), F.sum("weight").alias("investedWeight"))


def weak_holdings(t: Tables, label: str, window: str, arm: str, as_of, min_roic, max_debt, min_score) -> DataFrame:
    """Holdings weak by metrics or assessment, the reasons joined.

    The latest assessment is hidden as a whole if all of the asset's assessments came later: such a
    holding drops out, one without any assessment stays.
    """
    h = _ticker(t, holdings(t, as_of, _book(t, label, window, arm)))
    m = T.asof_latest(filing_metrics(t), ["asset"], "available", _day(as_of), ["roic", "debt"])
    every = assessments(t)
    a = T.asof_latest(every, ["asset"], "assessed", _day(as_of))
    late = every.select("asset").distinct().join(a.select("asset"), "asset", "left_anti")
    rows = h.join(m, "asset").join(a, "asset", "left").join(late, "asset", "left_anti")
    reason = S.weak_reasons(F.col("roic"), F.col("debt"), F.col("score"), F.lit(min_roic), F.lit(max_debt), F.lit(min_score))
    return _masked(t, rows.withColumn("reason", reason).filter("reason <> ''"), "asset").select("ticker", "roic", "debt", "score", "rating", "generated", "pricesNotPublished", "reason")


def assessment_changes(t: Tables, ticker: str, label: str, window: str, start, end, arm: str | None = None) -> DataFrame:
    """Assessments of a company in a period with the previous score and the stops of the period."""
    a = t["assets"].filter(F.col("tickerSymbol") == ticker).select(F.col("subject").alias("asset"), F.col("tickerSymbol").alias("ticker"))
    x = t["FundamentalAssessment"].select(F.col("assessmentOfAsset").alias("asset"), F.col("assessmentOfFiling").alias("filing"), "availableAt", F.col("scoreRaw0to100").alias("score"), "rating", F.col("generatedByLanguageModel").alias("generated")).join(a, "asset")
    x = x.join(t["SECFiling"].select(F.col("subject").alias("filing"), "periodEnd"), "filing")
    p = T.with_previous(x, ["asset"], "availableAt", ["score"], "previous_").filter(F.col("availableAt").between(_day(start), _day(end)))
    s = _stops(t, label, window, arm).filter(F.col("date").between(_day(start), _day(end))).select("asset", F.col("date").alias("stopDate"))
    return _masked(t, p.join(s, "asset", "left"), "asset").select("ticker", "periodEnd", "availableAt", "score", "rating", "generated", F.col("previous_score").alias("previousScore"), "stopDate", "pricesNotPublished")


def filing_coverage(t: Tables, label: str, window: str, arm: str, as_of) -> DataFrame:
    """C20: filings and assessments known per holder.

    The date filters stand outside the optional joins, so a holder whose only filings (or only
    assessments) came later vanishes instead of showing zero.
    """
    h = _ticker(t, holdings(t, as_of, _book(t, label, window, arm))).select("asset", "ticker").distinct()

    def counted(cls, link, out):
        known = F.col("availableAt") <= _day(as_of)
        return t[cls].groupBy(F.col(link).alias("asset")).agg(F.countDistinct(F.when(known, F.col("subject"))).alias(out)).withColumn(f"_has_{out}", F.lit(True))

    rows = h.join(counted("SECFiling", "filingOfAsset", "filings"), "asset", "left").join(counted("FundamentalAssessment", "assessmentOfAsset", "assessments"), "asset", "left")
    for c in ("filings", "assessments"):
        rows = rows.filter(F.col(f"_has_{c}").isNull() | (F.col(c) > 0)).withColumn(c, F.coalesce(c, F.lit(0)))
    return _masked(t, rows, "asset").select("ticker", "filings", "assessments", "pricesNotPublished")
