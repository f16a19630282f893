"""Source rows to class tables: ids, links to parents and assets, derived columns.

Each function is narrow except for its links, which are equi joins to the parent's class table or
catalogue; parents carry only the linked id, so Catalyst can broadcast the small ones. A row whose
parent is missing stays, with a NULL id; the load refuses it by name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.functions import scalars as S
from pitframe.operators.integrity import assert_fk, orphans
from pitframe.operators.linking import link_entity
from pitframe.operators.quads import graph_name, mint_id, project
from pitframe.operators.rules import risk_events
from pitframe.operators.temporal import asof_rule
from pitframe.operators.visibility import LANES
from pitframe.plans import entities as E
from pitframe.session import spread

KEYED = "backtest_run_id"


def book_table(v_book: DataFrame, label: str, slug: str | None = None) -> DataFrame:
    """ENT-01: one StrategyBook per row; the id stem is the configuration slug, else the arm."""
    stem = F.lit(slug) if slug else F.col("arm_code")
    df = v_book.withColumn("run_label", F.lit(label)).withColumn("stem", stem)
    df = df.withColumn("subject", mint_id("Book", F.lit(label), "window_id", "stem"))
    df = df.withColumn("configuration", F.lit(f"Configuration_{slug}" if slug else None).cast("string"))
    tail = F.lit(slug) if slug else F.col(KEYED)
    return df.withColumn("graph", graph_name("backtest", label=F.lit(label), window=F.col("window_id"), slug=tail))


def _books_of(books: DataFrame) -> DataFrame:
    return books.select("book_id", F.col("subject").alias("book"), F.col("graph").alias("graph"), "run_label",
                        F.col("window_id").alias("book_window"), "stem")


def with_asset(df: DataFrame, assets: DataFrame, symbol: str = "ticker", ciks: DataFrame | None = None) -> DataFrame:
    """Add ``asset`` and ``how`` by exact symbol, or by the symbol's CIK when a CIK map is given."""
    if ciks is not None:
        df = df.join(ciks.select(F.col("key").alias(symbol), F.col("cik").alias("_cik")), symbol, "left")
    else:
        df = df.withColumn("_cik", F.lit(None).cast("string"))
    return link_entity(df, symbol, "_cik", assets).drop("_cik")


def books(v_book: DataFrame, label: str, slug: str | None = None) -> DataFrame:
    return project(book_table(v_book, label, slug), E.BOOK)


def _alert_id(label: str, slug: str | None) -> Column:
    return mint_id("GuardAlert", F.lit(label), "window_id", *([F.lit(slug)] if slug else []), "alert_id")


def alert_ids(v_alert: DataFrame, label: str, slug: str | None = None) -> DataFrame:
    """Ids of alerts without their other links; all an action needs to point at its alert."""
    return v_alert.select(_alert_id(label, slug).alias("subject"), F.col("alert_id").alias("alertId"), F.col("window_id").alias("windowId"))


def alerts(v_alert: DataFrame, book: DataFrame, rules: DataFrame, assets: DataFrame, label: str, slug: str | None = None) -> DataFrame:
    """ENT-02: rule resolved by id, stop rules lose their price threshold."""
    runs = book.select(KEYED, "window_id", "graph").distinct()
    r = rules.select("rule_id", "rule_iri")
    df = v_alert.join(runs, [KEYED, "window_id"], "left").join(r, "rule_id", "left")
    df = with_asset(df, assets)
    df = df.withColumn("subject", _alert_id(label, slug)).withColumn("threshold", S.suppress(F.col("threshold"), F.col("rule_id").startswith("L1_BP_STOP")))
    return project(df, E.ALERT)


def alert_problems(v_alert: DataFrame, v_book: DataFrame, rules: DataFrame) -> DataFrame:
    """Alerts whose run and window name no book, whose rule is unknown, or whose layer is not the rule's."""
    a = orphans(v_alert, v_book, [KEYED, "window_id"]).select("alert_id", F.lit("run or window").alias("problem"))
    r = assert_fk(v_alert.withColumn("guard_layer", F.col("layer")), rules.select("rule_id", F.col("guard_layer").cast("bigint").alias("guard_layer")), ["rule_id"], ["guard_layer"])
    return a.unionByName(r.select("alert_id", F.concat(F.lit("rule: "), F.col("violation")).alias("problem")))


def child_problems(child: DataFrame, v_book: DataFrame, *key: str) -> DataFrame:
    """Children of no book, or that disagree with their book's run or arm."""
    return assert_fk(child, v_book.select("book_id", KEYED, "arm_code"), ["book_id"], [KEYED, "arm_code"]).select(*key, "violation")


def rebalances(v: DataFrame, book: DataFrame) -> DataFrame:
    df = v.join(_books_of(book), "book_id", "left")
    df = df.withColumn("subject", mint_id("Rebalance", "run_label", "book_window", "stem", S.day_key(F.col("execution_date").cast("date"))))
    return project(df, E.REBALANCE)


def actions(v: DataFrame, book: DataFrame, alert: DataFrame, assets: DataFrame) -> DataFrame:
    """ENT-04: linked to its book, and to the alert of its window with its alert id."""
    a = alert.select(F.col("alertId").alias("alert_id"), F.col("windowId").alias("book_window"), F.col("subject").alias("alert"))
    df = v.join(_books_of(book), "book_id", "left").join(a, ["alert_id", "book_window"], "left")
    df = with_asset(df, assets).withColumn("subject", mint_id("GuardAction", "run_label", "book_window", "stem", "action_id"))
    return project(df, E.ACTION)


def weights(v: DataFrame, book: DataFrame, assets: DataFrame) -> DataFrame:
    """ENT-05: the cash row has no asset; other rows link by their holding key."""
    df = v.drop("asset_id").join(_books_of(book), "book_id", "left")
    df = with_asset(df.withColumn("ticker", F.when(F.col("holding_key") != "CASH", F.col("holding_key"))), assets)
    df = df.withColumn("subject", mint_id("BookWeight", "run_label", "book_window", "stem", S.day_key(F.col("date").cast("date")), "holding_key"))
    return project(df, E.WEIGHT)


def performance(v: DataFrame, book: DataFrame) -> DataFrame:
    df = v.join(_books_of(book), "book_id", "left")
    df = df.withColumn("subject", mint_id("BookPerf", "run_label", "book_window", "stem", S.day_key(F.col("date").cast("date"))))
    return project(df, E.PERFORMANCE)


def summaries(v: DataFrame, book: DataFrame) -> DataFrame:
    df = v.join(_books_of(book), "book_id", "left").withColumn("subject", mint_id("PeriodSummary", "run_label", "book_window", "stem", "segment"))
    return project(df, E.SUMMARY)


def segment_problems(v: DataFrame) -> DataFrame:
    """Segments outside the grammar window + lower-case letter, or of another window."""
    ok = F.col("segment").rlike(r"^([PH][0-9]+|C[0-9]+|LIVE)[a-z]?$") & F.col("segment").startswith(F.col("window_id"))
    return v.filter(~ok).select("book_id", "segment")


def tests(v: DataFrame, label: str, slug: str | None = None) -> DataFrame:
    tail = F.lit(slug) if slug else F.col(KEYED)
    df = v.withColumn("run_label", F.lit(label)).withColumn("subject", mint_id("BacktestTest", F.lit(label), "window_id", tail, "segment", "arm_a", "arm_b", "test"))
    return project(df.withColumn("graph", graph_name("backtest", label=F.lit(label), window=F.col("window_id"), slug=tail)), E.TEST)


def _value(x: str | int | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def selection_graph(df: DataFrame, label: str, window: str | Column, run_id: int | Column, slug: str | None = None) -> DataFrame:
    """Label, window, run and graph columns of the selection side; window and run may be columns, so one call takes all windows."""
    df = df.withColumn("run_label", F.lit(label)).withColumn("window_id", _value(window)).withColumn(KEYED, _value(run_id))
    tail = F.lit(slug) if slug else F.col(KEYED).cast("string")
    return (df.withColumn("graph", F.concat_ws(":", F.lit(f"urn:graph:derived:backtest:selection:{label}"), "window_id", tail))
            .withColumn("_stem", F.concat_ws("_", F.lit(label), "window_id", tail)))


def cycles(v: DataFrame, label: str, window: str | Column, run_id: int | Column, slug: str | None = None) -> DataFrame:
    df = selection_graph(v, label, window, run_id, slug).withColumn("run_text", F.concat(F.lit("cycle_run:"), F.col("run_id").cast("string")))
    return project(df.withColumn("subject", mint_id("Cycle", "_stem", "run_id")), E.CYCLE)


def schemes(scheme: DataFrame, component: DataFrame, label: str, window: str | Column, run_id: int | Column, slug: str | None = None) -> tuple[DataFrame, DataFrame]:
    """ENT-10: weight schemes with their configured components. A scheme has one component per metric."""
    c = selection_graph(component, label, window, run_id, slug).withColumn("metric", F.col("score_type"))
    c = c.withColumn("subject", mint_id("Weight", "_stem", "cycle_run_id", "metric"))
    of = c.groupBy("window_id", "cycle_run_id").agg(F.array_sort(F.collect_set("subject")).alias("component"))
    s = selection_graph(scheme, label, window, run_id, slug).join(of, ["window_id", "cycle_run_id"], "left")
    s = s.withColumn("run_text", F.concat(F.lit("cycle_run:"), F.col("cycle_run_id").cast("string"))).withColumn("subject", mint_id("Scheme", "_stem", "cycle_run_id"))
    return project(s, E.SCHEME), project(c, E.CONFIGURED)


def scheme_problems(scheme: DataFrame, component: DataFrame, cycle: DataFrame) -> DataFrame:
    """Schemes of no cycle, schemes without a component, components of no scheme."""
    runs = cycle.select(F.col("run_id").alias("cycle_run_id"))
    tag = lambda df, t: df.select("cycle_run_id", F.lit(t).alias("problem"))
    return tag(orphans(scheme, runs, ["cycle_run_id"]), "no cycle").unionByName(
        tag(orphans(scheme, component, ["cycle_run_id"]), "no component")).unionByName(tag(orphans(component, scheme, ["cycle_run_id"]), "no scheme"))


def rankings(v: DataFrame, cycle: DataFrame, component: DataFrame, assets: DataFrame, label: str, window: str | Column, run_id: int | Column,
             slug: str | None = None, ciks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """ENT-11 and ENT-12: snapshots of completed cycles (score / 100) and their effective components."""
    done = cycle.filter("status = 'completed'").select(_value(window).alias("window_id"), F.col("run_id").alias("cycle_run_id"), "finished_at")
    df = selection_graph(v.drop("status"), label, window, run_id, slug).join(done, ["window_id", "cycle_run_id"])
    df = with_asset(df, assets, "ticker", ciks)
    df = df.withColumn("subject", mint_id("Snap", "_stem", "cycle_run_id", "asset_id")).withColumn("cycle", mint_id("Cycle", "_stem", "cycle_run_id")).withColumn("scheme", mint_id("Scheme", "_stem", "cycle_run_id"))
    df = df.withColumn("score", (F.col("blended_score").cast("decimal(20,10)") / F.lit(100)).cast("decimal(22,12)"))
    comp = selection_graph(component, label, window, run_id, slug).withColumn("metric", F.col("score_type"))
    comp = comp.join(df.select("window_id", "cycle_run_id", "asset_id"), ["window_id", "cycle_run_id", "asset_id"], "left_semi")
    comp = comp.withColumn("subject", mint_id("RankComp", "_stem", "cycle_run_id", "asset_id", "metric"))
    of = comp.groupBy("window_id", "cycle_run_id", "asset_id").agg(F.array_sort(F.collect_set("subject")).alias("component"))
    df = df.join(of, ["window_id", "cycle_run_id", "asset_id"], "left")
    return project(df, E.RANKING), project(comp, E.EFFECTIVE)


def skipped_rankings(v: DataFrame, cycle: DataFrame, component: DataFrame) -> DataFrame:
    """Rows left out by design: rankings of a run not completed, components of no projected ranking."""
    done = cycle.filter("status = 'completed'").select(F.col("run_id").alias("cycle_run_id"))
    kept = v.join(done, "cycle_run_id", "left_semi")
    n = F.count(F.lit(1)).alias("rows")
    return v.join(done, "cycle_run_id", "left_anti").agg(n).select(F.lit("run is not completed").alias("reason"), "rows").unionByName(
        component.join(kept, ["cycle_run_id", "asset_id"], "left_anti").agg(n).select(F.lit("ranking row not projected").alias("reason"), "rows"))


def vetoes(v: DataFrame, cycle: DataFrame, rules: DataFrame, assets: DataFrame, rule_date: str, label: str, window: str | Column, run_id: int | Column,
           slug: str | None = None, ciks: DataFrame | None = None) -> DataFrame:
    """ENT-13: stints with the rule definition in force on the rule date."""
    df = selection_graph(v, label, window, run_id, slug).withColumn("_d", F.lit(rule_date).cast("date"))
    df = asof_rule(df, "_d", rules, ["rule_id"])
    asof = cycle.select(_value(window).alias("window_id"), "run_id", F.col("as_of").alias("run_as_of"))
    df = with_asset(df.join(asof, ["window_id", "run_id"], "left"), assets, "ticker", ciks)
    df = df.withColumn("run_text", F.concat(F.lit("cycle_run:"), F.col("run_id").cast("string"))).withColumn("subject", mint_id("Veto", "_stem", "id"))
    return project(df, E.VETO)


def scores(rows: DataFrame, run_day: str) -> DataFrame:
    """ENT-14: projectable rows (see ``classify_visibility``) as score snapshots routed to their graphs."""
    lane = F.col("score_type")
    metric = F.element_at(F.create_map(*[F.lit(x) for kv in LANES.items() for x in kv]), lane)
    risk = F.when(lane != "FUNDAMENTAL", S.strength_to_risk(F.col("normalized_score")))
    df = rows.withColumn("metric_type", metric).withColumn("risk", risk).withColumn("asset", F.col("ticker"))
    df = df.withColumn("subject", mint_id("Score", lane, "ticker", "id"))
    df = df.withColumn("graph", graph_name("ingest", lane=lane, day=F.col("available_at").cast("date"), run_day=F.lit(run_day)))
    return project(df, E.SCORE)


def ticker_history(v: DataFrame, assets: DataFrame, label: str, snapshot: str) -> DataFrame:
    """ENT-15: linked by canonical symbol, else CIK; an evidence cell with several dates is left out."""
    df = link_entity(v.withColumn("_c", F.col("cik")), "canonical_symbol", "_c", assets)
    df = df.withColumn("evidence_day", F.when(~F.col("evidence_date").contains(";"), F.col("evidence_date").try_cast("date")))
    df = df.withColumn("subject", mint_id("TickerHistory", F.lit(label), F.lit(snapshot), "cik", "symbol", F.col("valid_from").cast("string")))
    return project(df.withColumn("graph", F.lit(f"urn:graph:derived:ticker-history:{label}:{snapshot}")), E.TICKER_HISTORY)


def orchestrator(runs: DataFrame, steps: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """ENT-16: runs and their steps, one graph per run."""
    graph = lambda c: graph_name("orchestrator", label=F.lit(label), slug=F.col(c))
    r = runs.withColumn("subject", mint_id("OrchestratorRun", F.lit(label), "run_id")).withColumn("graph", graph("run_id"))
    s = steps.join(r.select(F.col("run_id").alias("orchestrator_run_id"), F.col("subject").alias("run")), "orchestrator_run_id")
    text = F.when(F.col("run_id").isNotNull(), F.concat_ws(":", "run_kind", F.col("run_id").cast("string")))
    s = s.withColumn("run_text", text).withColumn("subject", mint_id("OrchestratorStep", F.lit(label), "orchestrator_run_id", "ordinal"))
    return project(r, E.ORCHESTRATOR_RUN), project(s.withColumn("graph", graph("orchestrator_run_id")), E.ORCHESTRATOR_STEP)


def universe(stints: DataFrame, lines: DataFrame, industries: DataFrame, day: str, reference: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """ENT-17: assets of the resolved company lines and one membership per stint.

    ``lines`` comes from ``resolve_entities``; ``industries`` maps a sub-industry to an industry id.
    Assets another catalogue declares (``reference``) keep their memberships but are not written.
    """
    graph = F.concat(F.lit("urn:graph:universe:"), S.quarter_label(F.lit(day).cast("date")))
    line = lines.select(F.col("cik").alias("_lc"), F.col("asset_symbol"), "pattern")
    succession = line.filter("pattern = 'succession'").select(F.col("_lc").alias("cik"), F.col("asset_symbol").alias("_succ"))
    s = stints.join(succession, "cik", "left").withColumn("asset_symbol", F.coalesce("_succ", "symbol")).drop("_succ")
    latest = s.groupBy("asset_symbol").agg(F.max(F.struct("valid_from", "symbol", F.struct("security", "gics_sub_industry", "cik").alias("d"))).alias("m"))
    a = latest.select("asset_symbol", F.col("m.d.security").alias("company_name"), F.col("m.d.cik").alias("cik"), F.col("m.d.gics_sub_industry").alias("sub_industry"))
    a = a.join(industries, "sub_industry", "left").withColumn("subject", F.col("asset_symbol")).withColumn("graph", graph)
    if reference is not None:
        a = a.join(reference.select("subject"), "subject", "left_anti")
    m = s.withColumn("asset", F.col("asset_symbol")).withColumn("universe", F.lit("Universe")).withColumn("subject", mint_id("UM", "symbol", F.col("valid_from").cast("string")))
    return project(a, E.ASSET), project(m.withColumn("graph", graph), E.MEMBERSHIP)


def news_items(rows: DataFrame, label: str, period: str = "period") -> DataFrame:
    """ENT-18: keyed by (kind, id, ticker); the graph period comes from ``split_graphs``."""
    df = rows.withColumn("subject", mint_id("NewsItem", "item_kind", "item_id", "ticker"))
    sub = F.col("item_kind") == "sub_news"
    df = df.withColumn("article_id", F.when(sub, F.col("article_id"))).withColumn("source_domain", F.when(sub, F.col("source_domain")))
    return project(df.withColumn("graph", F.concat_ws(":", F.lit("urn:graph:derived:news"), F.lit(label), F.col(period))), E.NEWS_ITEM)


def news_problems(rows: DataFrame) -> DataFrame:
    """Keys delivered twice or under two model revisions."""
    n = rows.groupBy("item_kind", "item_id", "ticker").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("model_revision").alias("revisions"))
    return n.filter("rows > 1 OR revisions > 1")


def articles(news: DataFrame, assets: DataFrame, graph: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """ENT-19: articles, sentiment snapshots and, through the severity gate, risk events."""
    df = with_asset(news, assets).withColumn("published", S.published_date(F.col("pub_date"), F.col("fetched_at"))).withColumn("graph", graph)
    day = lambda c: S.strict_day(F.substring(c, 1, 10))
    df = df.withColumn("source_id", S.provenance("articles", F.col("id"))).withColumn("article", mint_id("Article", "id"))
    df = df.withColumn("available_at", S.available_at(F.col("published"), day("sent_processed_at")))
    art = project(df.withColumn("subject", F.col("article")), E.NEWS_ARTICLE)
    sent = df.withColumn("score_type", F.lit("SEMANTIC")).withColumn("metric_type", F.lit("Sentiment"))
    sent = sent.withColumn("raw_value", S.net_polarity(F.col("positive"), F.col("negative"))).withColumn("subject", mint_id("Sentiment", "id"))
    ev = risk_events(df).withColumn("available_at", S.available_at(F.col("published"), day("sent_processed_at"), day("cat_processed_at")))
    return art, project(sent, E.SENTIMENT), project(ev.withColumn("subject", mint_id("RiskEvent", "id")), E.RISK_EVENT)


def fundamentals(filings: DataFrame, metrics: DataFrame, assessments: DataFrame, mask: DataFrame, assets: DataFrame, label: str, engine: str) -> dict[str, DataFrame]:
    """ENT-20: filings, one wide metric set per filing, assessments, and the masked assets."""
    from pitframe.operators.metrics import widen_metrics
    graph = F.lit(f"urn:graph:derived:fundamentals:{label}")
    link = lambda df: with_asset(df, assets).drop("how").withColumn("graph", graph)
    f = link(filings).withColumn("subject", mint_id("Filing", F.lit(label), "filing_id"))
    wide = widen_metrics(metrics, E.METRICS)
    m = wide.join(f.select("filing_id", F.col("subject").alias("filing"), "available_at", "graph"), "filing_id")
    m = m.withColumn("engine_version", F.lit(engine)).withColumn("subject", mint_id("MetricSet", F.lit(label), "filing_id"))
    a = link(assessments).withColumn("filing", mint_id("Filing", F.lit(label), "filing_id")).withColumn("subject", mint_id("Assessment", F.lit(label), "snapshot_id"))
    masked = link(mask).select("graph", F.col("asset").alias("subject"), F.lit("pricesNotPublished").alias("predicate"), F.lit("true").alias("object"),
                               F.lit("literal").alias("object_kind"), F.lit("xsd:boolean").alias("datatype"), F.lit(None).cast("string").alias("lang"))
    return {"filings": project(f, E.FILING), "metric_sets": project(m, E.METRIC_SET), "assessments": project(a, E.ASSESSMENT), "mask": masked}


def fundamentals_problems(filings: DataFrame, metrics: DataFrame, assessments: DataFrame, mask: DataFrame) -> DataFrame:
    """Filings without metrics, metrics or assessments of no filing, valuation rows of masked assets."""
    # rows are counted by filing, so that each table is read and moved once and no row of it is held
    one, no = F.lit(1), F.lit(0)
    hidden = mask.select(F.col("ticker").alias("_masked")).filter("_masked IS NOT NULL").distinct()
    own = filings.join(hidden, F.col("ticker") == F.col("_masked"), "left")
    side = lambda df, f, h, m, v, a: df.select("filing_id", f.alias("f"), h.alias("h"), m.alias("m"), v.alias("v"), a.alias("a"))
    priced = F.when(F.col("metric_group") == "valuation", 1).otherwise(0)
    rows = (side(own, one, F.when(F.col("_masked").isNotNull(), 1).otherwise(0), no, no, no)
            .unionByName(side(metrics, no, no, one, priced, no)).unionByName(side(assessments, no, no, no, no, one)))
    # a row without an id belongs to nothing: kept as it is, not counted into one group
    bare = rows.filter("filing_id IS NULL").select("filing_id", F.when(F.col("f") == 1, "no metrics").when(F.col("m") == 1, "metric of no filing").otherwise("assessment of no filing").alias("problem"))
    n = spread(rows.filter("filing_id IS NOT NULL"), "filing_id").groupBy("filing_id").agg(*[F.sum(c).alias(c) for c in "fhmva"])
    found = [("no metrics", F.when(F.col("m") == 0, F.col("f"))), ("metric of no filing", F.when(F.col("f") == 0, F.col("m"))),
             ("assessment of no filing", F.when(F.col("f") == 0, F.col("a"))), ("valuation of a masked asset", F.when(F.col("v") > 0, F.col("h")))]
    cells = n.select("filing_id", F.inline(F.array(*[F.struct(F.lit(t).alias("problem"), F.coalesce(c, no).cast("long").alias("n")) for t, c in found]))).filter("n > 0")
    # n copies of the row, by a thousand
    cells = cells.select("filing_id", "problem", "n", F.explode(F.sequence(F.lit(0), F.expr("(n - 1) DIV 1000"))).alias("k"))
    cells = cells.select("filing_id", "problem", F.explode(F.sequence(F.lit(1), F.least(F.lit(1000), F.col("n") - 1000 * F.col("k")).cast("int"))).alias("_"))
    return cells.select("filing_id", "problem").unionByName(bare)


def series(daily: DataFrame, weights_: DataFrame, label: str, slug: str) -> tuple[DataFrame, DataFrame]:
    """ENT-21: daily points and decision weights of one configuration; absent measures are NULL."""
    for c in ("gross_return", "net_return", "turnover", "cost", "cash_weight", "daily_total_return", "value"):
        if c not in daily.columns:
            daily = daily.withColumn(c, F.lit(None).cast("decimal(38,18)"))
    common = lambda df: df.withColumn("configuration", F.lit(f"Configuration_{slug}")).withColumn("graph", F.lit(f"urn:graph:derived:backtest:series:{label}:{slug}"))
    d = common(daily).withColumn("subject", mint_id("DailySeries", F.lit(label), F.lit(slug), "window", F.col("date").cast("string")))
    w = common(weights_).withColumn("subject", mint_id("SeriesWeight", F.lit(label), "window", F.col("decision_date").cast("string"), "asset_id"))
    return project(d, E.DAILY_SERIES), project(w, E.SERIES_WEIGHT)


def aggregates(trend: DataFrame, reference: DataFrame, source: DataFrame, label: str, arms: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """ENT-22: the aggregates set, its trend-filter states and reference returns."""
    common = lambda df: df.withColumn("run_label", F.lit(label)).withColumn("graph", F.lit(f"urn:graph:derived:backtest:aggregates:{label}")).withColumn("set", F.lit(f"AggregatesSet_{label}"))
    state = F.when(F.col("spy_vs_sma210") == "below", "below").otherwise(F.col("spy_vs_sma210"))
    t = common(trend).withColumn("state", state).withColumn("arms", F.array(*[F.lit(a) for a in arms]))
    t = t.withColumn("subject", mint_id("TrendFilter", F.lit(label), "window", F.col("decision_date").cast("string")))
    r = common(reference).withColumn("subject", mint_id("ReferenceReturn", F.lit(label), "segment", "reference"))
    s = common(source).withColumn("subject", F.col("set"))
    return project(s, E.AGGREGATES_SET), project(t, E.TREND_STATE), project(r, E.REFERENCE_RETURN)


def external_summary(rows: DataFrame, engine: DataFrame, label: str, arm: str, objective: str) -> tuple[DataFrame, DataFrame]:
    """ENT-23: one book per window (the row whose segment is its window) and every segment's summary.

    ``engine``: (window, max_book_id, run_id); the external book takes the next id.
    """
    e = engine.select("window", (F.col("max_book_id") + 1).alias("book_id"), F.col("run_id").alias(KEYED))
    df = rows.join(e, "window").withColumn("run_label", F.lit(label)).withColumn("arm_code", F.lit(arm)).withColumn("window_id", F.col("window"))
    df = df.withColumn("graph", F.lit(f"urn:graph:derived:backtest:external:{label}")).withColumn("book", mint_id("Book", F.lit(label), "window", F.lit(arm))).withColumn("knowledge_date", F.col("date_to"))
    b = df.filter("segment = window").withColumn("subject", F.col("book")).withColumn("d_start", F.col("date_from")).withColumn("d_end", F.col("date_to"))
    b = b.withColumn("run_status", F.lit("completed")).withColumn("objective", F.lit(objective)).withColumn("exclude_hard_vetoed", F.lit(False))
    for c in ("guard_layers", "configuration", "code_version"):
        b = b.withColumn(c, F.lit(None).cast("string"))
    b = b.withColumn("formation_date", F.lit(None).cast("date"))
    s = df.withColumn("subject", mint_id("PeriodSummary", F.lit(label), "window", F.lit(arm), "segment"))
    return project(b, E.BOOK), project(s, E.SUMMARY)


def run_metadata(runs: DataFrame, config: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """ENT-24: one BacktestRun per (configuration, window) and the run configuration."""
    graph = F.lit(f"urn:graph:derived:backtest:meta:{label}")
    r = runs.withColumn("run_label", F.lit(label)).withColumn("graph", graph).withColumn("run_configuration", F.lit(f"RunConfiguration_{label}"))
    named = F.col("configuration").isNotNull()
    r = r.withColumn("subject", F.when(named, mint_id("Run", F.lit(label), "window_id", "configuration")).otherwise(mint_id("BacktestRun", F.lit(label), "window_id")))
    c = config.withColumn("run_label", F.lit(label)).withColumn("graph", graph).withColumn("subject", F.lit(f"RunConfiguration_{label}"))
    return project(c, E.RUN_CONFIGURATION), project(r, E.BACKTEST_RUN)


# --- event audit log ---------------------------------------------------------------------------
# The event tables carry ``stem`` (label_window_slug), ``book``, ``graph`` and engine asset ids; the
# ``asset`` of an id comes from ``assets``: (asset_id, asset).


def _asset(df: DataFrame, assets: DataFrame, ident: str = "asset_id", out: str = "asset") -> DataFrame:
    return df.join(assets.select(F.col("asset_id").alias(ident), F.col("asset").alias(out)), ident, "left")


def decisions(lines: DataFrame, pools: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ENT-25: decision events; ``pools`` (stem, date, cycle, rebalance, selected) is the decision index.

    Second result: dates whose stated pool size is not the selection pool's.
    """
    df = lines.join(pools, ["stem", "date"], "left")
    retained = F.coalesce(F.transform("retention.retained", lambda x: x["asset_id"]), F.array().cast("array<bigint>"))
    df = df.withColumn("refilled", F.array_except(F.array_except("candidate_ids", "selected"), retained).cast("array<string>"))
    df = df.withColumn("candidate_pool_size", F.size("selected")).withColumn("candidate_set_size", F.size("candidate_ids")).withColumn("blocked_count", F.size("blocked")).withColumn("retained_count", F.size(retained))
    df = df.withColumn("subject", mint_id("Decision", "stem", F.col("date").cast("string")))
    off = df.filter(F.col("selected").isNull() | (F.coalesce(F.col("retention.pool_size"), F.size("selected").cast("bigint")) != F.size("selected")))
    return project(df, E.DECISION), off.select("stem", "date")


def formation(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """Formation targets of each book's first decision."""
    first = lines.groupBy("stem").agg(F.min("date").alias("date"))
    df = lines.join(first, ["stem", "date"], "left_semi").select("stem", "date", "graph", F.explode("target").alias("asset_id", "weight"))
    df = _asset(df.withColumn("asset_id", F.col("asset_id").cast("bigint")), assets)
    d = F.col("date").cast("string")
    return project(df.withColumn("decision", mint_id("Decision", "stem", d)).withColumn("subject", mint_id("FormationTarget", "stem", d, "asset_id")), E.FORMATION)


def retentions(lines: DataFrame, assets: DataFrame, from_decisions: bool) -> dict[str, DataFrame]:
    """ENT-26: retention decisions, holds and rejections, from decision lines or from their own lines."""
    df = lines.filter("retention IS NOT NULL").select("stem", "book", "graph", "date", "retention.*") if from_decisions else lines
    d = F.col("date").cast("string")
    df = df.withColumn("subject", mint_id("Retention", "stem", d)).withColumn("decision", mint_id("Decision", "stem", d) if from_decisions else F.lit(None).cast("string"))
    counted = df
    for name, arr in (("held_outside_pool_count", "held_outside"), ("retained_count", "retained"), ("rejected_count", "rejected"), ("counter_dropped_count", "counter_dropped"), ("kept_count", "kept")):
        counted = counted.withColumn(name, F.size(arr))
    counted = counted.withColumn("candidate_set_size", F.col("candidate_size")).withColumn("dropped", F.col("counter_dropped").cast("array<string>"))
    counted = counted.withColumn("max_decisions", F.coalesce("max_decisions", F.lit(3))).withColumn("enabled", F.coalesce("enabled", F.lit(True)))
    def items(arr, kind):
        x = df.select("stem", "graph", "date", F.col("subject").alias("decision"), F.inline(arr))
        x = _asset(x, assets).withColumn("snapshot", mint_id("Snap", "stem", F.date_format("date", "yyyyMMdd"), "asset_id"))
        return x.withColumn("subject", mint_id(kind, "stem", F.col("date").cast("string"), "asset_id"))
    return {"retentions": project(counted, E.RETENTION), "holds": project(items("retained", "RetentionHold"), E.HOLD),
            "rejections": project(items("rejected", "RetentionRejection"), E.REJECTION)}


def stops(lines: DataFrame, assets: DataFrame) -> dict[str, DataFrame]:
    """ENT-27: stops, their menu options (cash left out, position from 1) and rejection summaries."""
    d = F.col("date").cast("string")
    df = _asset(lines, assets).withColumn("subject", mint_id("Stop", "stem", d, "asset_id"))
    df = df.withColumn("menu", F.filter(F.coalesce("menu", F.array().cast(dict(lines.dtypes)["menu"])), lambda o: ~F.coalesce(o["cash"], F.lit(False))))
    position = F.array_position(F.transform("menu", lambda o: o["asset_id"]), F.col("chosen.asset_id"))
    cash = F.coalesce(F.col("chosen.cash"), F.lit(False))
    df = df.withColumn("chosen_cash", F.when(cash, True)).withColumn("check_passed", F.col("portfolio_check.passed"))
    df = df.withColumn("chosen_option", F.when(~cash & (position > 0), mint_id("StopOption", "stem", d, "asset_id", position)))
    for k in ("min", "median", "max"):
        df = df.withColumn(f"rho_delta_{k}", F.col(f"rho_delta.{k}"))
    opt = df.select("stem", "graph", "date", F.col("asset_id").alias("stopped"), F.col("subject").alias("stop"), F.posexplode("menu").alias("_p", "_o")).select("*", "_o.*").withColumn("position", F.col("_p") + 1)
    opt = _asset(opt, assets).withColumn("subject", mint_id("StopOption", "stem", F.col("date").cast("string"), "stopped", "position"))
    counts = df.filter("eligible_counts IS NOT NULL").withColumn("stop", F.col("subject"))
    for c in E.STOP_CAUSES:
        v = F.try_element_at("eligible_counts", F.lit(c))
        counts = counts.withColumn(f"rejected_{c.lower()}", F.when(v != 0, v))
    counts = counts.withColumn("subject", mint_id("StopSummary", "stem", d, "asset_id"))
    return {"stops": project(df, E.STOP), "options": project(opt, E.OPTION), "summaries": project(counts, E.STOP_SUMMARY)}


def stop_problems(lines: DataFrame, alert_keys: DataFrame) -> DataFrame:
    """Stops without their alert (stem, date, asset_id), and chosen assets that are not on the menu."""
    a = orphans(lines, alert_keys, ["stem", "date", "asset_id"]).select("stem", "date", "asset_id", F.lit("no alert").alias("problem"))
    on_menu = F.array_contains(F.transform("menu", lambda o: o["asset_id"]), F.col("chosen.asset_id"))
    off = lines.filter(~F.coalesce(F.col("chosen.cash"), F.lit(False)) & ~F.coalesce(on_menu, F.lit(False)))
    return a.unionByName(off.select("stem", "date", "asset_id", F.lit("chosen asset not on the menu").alias("problem")))


def replacements(bought: DataFrame, checks: DataFrame, stopped: DataFrame, stop_lines: DataFrame, assets: DataFrame) -> dict[str, DataFrame]:
    """ENT-28: purchases matched to the one stop that chose their asset that day, and their checks."""
    chose = stop_lines.filter(~F.coalesce(F.col("chosen.cash"), F.lit(False))).select(
        "stem", F.col("date").alias("order_date"), F.col("chosen.asset_id").alias("asset_id"), F.col("asset_id").alias("stopped_id"))
    n = chose.groupBy("stem", "order_date", "asset_id").agg(F.count(F.lit(1)).alias("matches"), F.min("stopped_id").alias("stopped_id"))
    b = bought.join(n, ["stem", "order_date", "asset_id"], "left")
    od = F.col("order_date").cast("string")
    b = b.withColumn("stop", F.when(F.col("matches") == 1, mint_id("Stop", "stem", od, "stopped_id"))).withColumn("subject", mint_id("Replacement", "stem", od, "asset_id"))
    halts = stopped.groupBy("stem", "asset_id").agg(F.min("date").alias("_sd"))
    rows = _asset(b.join(halts, ["stem", "asset_id"], "left"), assets).withColumn("stopped_by", mint_id("Stop", "stem", F.col("_sd").cast("string"), "asset_id"))
    latest = b.groupBy("stem", "asset_id").agg(F.max_by("subject", F.col("order_date")).alias("purchase"))
    c = checks.join(latest, ["stem", "asset_id"], "left").withColumn("subject", mint_id("ReplacementCheck", "stem", F.col("date").cast("string"), "asset_id"))
    bad = b.filter(~F.coalesce(F.col("matches") == 1, F.lit(False))).select("stem", "order_date", "asset_id", F.coalesce("matches", F.lit(0)).alias("matches"))
    return {"purchases": project(rows, E.PURCHASE), "checks": project(c, E.CHECK), "violations": bad}


def memories(episodes: DataFrame, assets: DataFrame) -> DataFrame:
    """ENT-29: one StopMemory per episode."""
    df = _asset(episodes, assets).withColumn("subject", mint_id("StopMemory", "stem", "asset_id", F.col("since").cast("string")))
    return project(df, E.MEMORY)


def agent_records(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """ENT-30 to ENT-33: flattened agent rows (subject and graph already set) as class tables.

    Columns a delivery does not carry are NULL; nested objects are read as ``<object>_<field>``.
    """
    maps = {"manager_calls": E.MANAGER_CALL, "narrator": E.NARRATOR_TEXT, "news_runs": E.NEWS_RUN, "date_records": E.DATE_RECORD,
            "news_actions": E.NEWS_ACTION, "news_evidence": E.NEWS_EVIDENCE, "bull_records": E.BULL_RECORD, "bull_decisions": E.BULL_DECISION}
    out = {}
    for name, df in tables.items():
        m = maps[name]
        for p in m.props:
            if p.column not in df.columns:
                df = df.withColumn(p.column, F.lit(None).cast("array<string>" if p.many else "string"))
        out[name] = project(df, m)
    return out


def flatten_agent(df: DataFrame, objects: Mapping[str, Sequence[str]]) -> DataFrame:
    """Nested objects of an agent record to ``<object>_<field>`` columns."""
    flat = [F.col(f"{o}.{f}").alias(f"{o}_{f}") for o, fs in objects.items() for f in fs]
    return df.select(*[c for c in df.columns if c not in objects], *flat)
