"""Classes that links and sets add to a delivery, and the refusing branches of boundary, sinks and reports."""

from pyspark.sql import functions as F

from pitframe.catalog.entity_cases import AS, IDS, LABEL, alert_table, assets, event_lines, melted, oracle, profile
from pitframe.catalog.registry import case, table
from pitframe.catalog.stream_cases import scratch
from pitframe.operators import quality as Q
from pitframe.operators.quads import melt
from pitframe.plans import entities as E
from pitframe.plans import projections as P
from pitframe.plans.casebook import check_sql, view
from pitframe.sources import sinks

STEM = "'base_' || win"
CHOSE = "(SELECT win AS cw, date AS cd, chosen_id AS ca, count(*) AS matches, min(asset_id) AS stopped FROM stops WHERE NOT cash GROUP BY 1, 2, 3)"


@case("ent_purchases", oracle("purchases stops assets",
      (E.PURCHASE, f"""SELECT 'g' AS graph, 'Replacement_' || {STEM} || '_' || order_date || '_' || p.asset_id AS subject, CASE WHEN matches = 1 THEN 'Stop_' || {STEM} || '_' || order_date || '_' || stopped END AS stop, i.ast AS asset,
        order_date, execution_date, execution_date AS machine_entry_session, weight, 1 AS size_fraction, rank, 'b' AS bucket, true AS filter, order_date AS filter_decision, 'Stop_' || {STEM} || '_' || sd || '_' || p.asset_id AS stopped_by
        FROM purchases p LEFT JOIN {CHOSE} c ON cw = win AND cd = order_date AND ca = p.asset_id LEFT JOIN (SELECT win AS hw, asset_id AS ha, min(execution_date) AS sd FROM purchases WHERE k % 5 = 0 GROUP BY 1, 2) h ON hw = win AND ha = p.asset_id {IDS} p.asset_id"""),
      (E.CHECK, f"""SELECT DISTINCT 'g' AS graph, 'ReplacementCheck_' || {STEM} || '_' || execution_date || '_' || p.asset_id AS subject, 'Replacement_' || {STEM} || '_' || last || '_' || p.asset_id AS purchase, execution_date AS date, true AS candidate, false AS kept
        FROM purchases p JOIN (SELECT win AS lw, asset_id AS la, max(order_date) AS last FROM purchases GROUP BY 1, 2) l ON lw = win AND la = p.asset_id""")))
def ent_purchases(spark, sf):
    """Purchases with the stop that chose them and the one that ended them, and the checks of each, as quads."""
    lines = event_lines(spark, sf).withColumn("stem", F.regexp_extract("stem", r"^(base_P\d+)", 1))
    b = view(spark, sf, "purchases").withColumn("stem", F.concat(F.lit("base_"), "win")).withColumn("graph", F.lit("g"))
    b = b.withColumn("machine_entry_session", F.col("execution_date")).withColumn("size_fraction", F.lit(1.0)).withColumn("bucket", F.lit("b")).withColumn("filter", F.lit(True)).withColumn("filter_decision", F.col("order_date"))
    checks = b.select("stem", "graph", "asset_id", F.col("execution_date").alias("date"), F.lit(True).alias("candidate"), F.lit(False).alias("kept")).distinct()
    out = P.replacements(b, checks, b.filter("k % 5 = 0").select("stem", "asset_id", F.col("execution_date").alias("date")), lines, assets(spark, sf))
    return profile(melt(out["purchases"], E.PURCHASE), melt(out["checks"], E.CHECK))


@case("ent_formation", oracle("retained assets", (E.FORMATION, f"""
    SELECT 'g' AS graph, 'Decision_' || stem || '_' || date AS decision, i.ast AS asset, weight, 'FormationTarget_' || stem || '_' || date || '_' || asset_id AS subject
    FROM (SELECT 'base_' || win || '_' || book_id AS stem, date, asset_id, CAST(counter * 0.1 AS DECIMAL(18,8)) AS weight, min(date) OVER (PARTITION BY win, book_id) AS first FROM retained) r {IDS} r.asset_id WHERE date = first""")))
def ent_formation(spark, sf):
    """Targets of each book's first decision, from maps of weights."""
    r = view(spark, sf, "retained").withColumn("stem", F.concat_ws("_", F.lit("base"), "win", F.col("book_id").cast("string")))
    entry = F.struct(F.col("asset_id").cast("string").alias("key"), (F.col("counter") * F.lit(0.1).cast("decimal(2,1)")).cast("decimal(18,8)").alias("value"))
    lines = r.groupBy("stem", "date").agg(F.map_from_entries(F.collect_list(entry)).alias("target")).withColumn("graph", F.lit("g"))  # one day's pool of one book
    return profile(melt(P.formation(lines, assets(spark, sf)), E.FORMATION))


@case("ent_sets", oracle("trend reference_returns v_book",
      (E.AGGREGATES_SET, "SELECT 'base' AS run_label, 'aggregates.json' AS source_file, 'h' || count(*) AS source_sha256, 'c' || count(DISTINCT \"window\") AS config_id, 'AggregatesSet_base' AS subject, 'urn:graph:derived:backtest:aggregates:base' AS graph FROM trend"),
      (E.RUN_CONFIGURATION, "SELECT 'base' AS run_label, max(code_version) AS code_commit, 'pr' || count(*) AS pr, NULL AS results_doc, 'x' AS config_id, max(run_status) AS status, min(arm_code) || ' to ' || max(arm_code) AS body, 'RunConfiguration_base' AS subject, 'urn:graph:derived:backtest:meta:base' AS graph FROM v_book")))
def ent_sets(spark, sf):
    """The aggregates set and the run configuration that other classes link to."""
    trend, book = view(spark, sf, "trend"), view(spark, sf, "v_book")
    src = trend.agg(F.lit("aggregates.json").alias("source_file"), F.concat(F.lit("h"), F.count(F.lit(1)).cast("string")).alias("source_sha256"), F.concat(F.lit("c"), F.countDistinct("window").cast("string")).alias("config_id"))
    conf = book.agg(F.max("code_version").alias("code_commit"), F.concat(F.lit("pr"), F.count(F.lit(1)).cast("string")).alias("pr"), F.lit(None).cast("string").alias("results_doc"), F.lit("x").alias("config_id"),
                    F.max("run_status").alias("status"), F.concat(F.min("arm_code"), F.lit(" to "), F.max("arm_code")).alias("body"))
    made, _, _ = P.aggregates(trend, view(spark, sf, "reference_returns"), src, LABEL, ["A1"])
    runs = book.select("window_id", F.lit(None).cast("string").alias("configuration"), "backtest_run_id", F.lit("f").alias("source_file"), F.lit("h").alias("source_sha256"), F.col("knowledge_date")).distinct()
    return profile(melt(made, E.AGGREGATES_SET), melt(P.run_metadata(runs, conf, LABEL)[0], E.RUN_CONFIGURATION))


@case("ent_bull_records", oracle("decisions", (E.BULL_RECORD, """
    SELECT min(date) AS date, win AS window_id, 'Configuration_bull' AS configuration, 'bull' AS bull_mode, CAST(1.2 AS DECIMAL(4,2)) AS bull_beta_target, CAST(0.5 AS DECIMAL(4,2)) AS bull_z_star, count(*) FILTER (k % 3 = 0) AS bull_triggered_count,
      list(DISTINCT 'BullDecision_' || win || '_' || date) AS decisions, 'BullModeRecord_' || win AS subject, 'urn:graph:derived:backtest:agents:base:' || win || ':bull_mode' AS graph FROM decisions GROUP BY win""")))
def ent_bull_records(spark, sf):
    """A record a window with the decisions it made; its list holds a day's decision once."""
    d = view(spark, sf, "decisions")
    named = F.concat_ws("_", F.lit("BullDecision"), "win", F.col("date").cast("string"))
    r = d.groupBy("win").agg(F.min("date").alias("date"), F.count(F.when(F.col("k") % 3 == 0, 1)).alias("bull_triggered_count"), F.collect_set(named).alias("decisions"))  # at most a day each
    r = r.select("date", F.col("win").alias("window_id"), F.lit("Configuration_bull").alias("configuration"), F.lit("bull").alias("bull_mode"), F.lit(1.2).alias("bull_beta_target"), F.lit(0.5).alias("bull_z_star"), "bull_triggered_count", "decisions",
                 F.concat(F.lit("BullModeRecord_"), "win").alias("subject"), F.concat(F.lit("urn:graph:derived:backtest:agents:base:"), "win", F.lit(":bull_mode")).alias("graph"))
    return profile(melt(P.agent_records({"bull_records": r})["bull_records"], E.BULL_RECORD))


@case("boundary_cap", """
    WITH n AS (SELECT count(*) FILTER (l_discount > 0.09) AS bad FROM lineitem)
    SELECT c AS run, c = 'over' AS stopped, CASE WHEN c = 'over' THEN 1 ELSE 0 END AS reasons, bad AS dropped FROM n, (VALUES ('over'), ('at')) v(c)""")
def boundary_cap(spark, sf):
    """A view one row over its quarantine cap stops the run; the same view at its cap passes."""
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    n = l.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_discount") > 0.09, 1)).alias("bad")).first()
    out = None
    for run, most in (("over", n["bad"] - 1), ("at", n["bad"])):
        e = Q.Expectation("v_lines", ranges=(Q.Range("l_discount", None, 0.09),), cap=most / n["n"])
        b = Q.validate({"v_lines": l}, {"v_lines": e}, {})
        row = b.failures.filter("check = 'range'").agg(F.count(F.lit(1)).alias("dropped")).select(F.lit(run).alias("run"), F.lit(b.stopped).alias("stopped"), F.lit(len(b.reasons)).alias("reasons"), "dropped")
        out = row if out is None else out.unionByName(row)
    return out


@case("boundary_stopped", """
    SELECT 'aggregate' AS part, "check", n FROM (VALUES ('missing_column', 1), ('row_count', 1)) v("check", n)
    UNION ALL SELECT 'reported', 'range', count(*) FROM orders WHERE o_totalprice > 480000 HAVING count(*) > 0 UNION ALL SELECT 'survivors', 'v_orders', count(*) FROM orders""")
def boundary_stopped(spark, sf):
    """A column that checks name is missing and a view is too short: the run stops, row evidence is reported, no row is dropped."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    e = Q.Expectation("v_orders", keys=(("k",),), ranges=(Q.Range("o_totalprice", None, 480000.0), Q.Range("o_missing", 0.0, None)), row_count_min=1 << 40, cap=1.0)
    b = Q.validate({"v_orders": o}, {"v_orders": e}, {})
    n = F.count(F.lit(1)).cast("int").alias("n")
    kept = b.survivors["v_orders"].agg(n).select(F.lit("survivors").alias("part"), F.lit("v_orders").alias("check"), "n")
    return b.aggregates.groupBy("check").agg(n).select(F.lit("aggregate").alias("part"), "check", "n").unionByName(b.failures.filter("fate = 'reported'").groupBy("check").agg(n).select(F.lit("reported").alias("part"), "check", "n")).unionByName(kept)


@case("replace_day_refused", check_sql("v_guard_alert", """
    SELECT version, switched, reason, live FROM (SELECT count(*) AS live FROM v_guard_alert WHERE window_id = 'P5'),
      (SELECT '1' AS version, true AS switched, CAST(NULL AS VARCHAR) AS reason UNION ALL SELECT '2', false, count(DISTINCT window_id) || ' graph(s) differ in size' FROM v_guard_alert)"""))
def replace_day_refused(spark, sf):
    """A day whose staged graphs aren't of the expected sizes isn't switched to; the day before stays live."""
    out = scratch(spark)
    q = melt(alert_table(spark, sf), E.ALERT)
    sizes = lambda x, off: x.groupBy("graph").agg((F.count(F.lit(1)) + off).alias("triples"))
    day = q.filter(F.col("graph").rlike(":P5:"))
    done = sinks.replace_graphs(day, out, sizes(day, 0), "1").unionByName(sinks.replace_graphs(q, out, sizes(q, 1), "2"))
    live = sinks.current_graphs(spark, out).filter("predicate = 'alertId'").agg(F.count(F.lit(1)).alias("live"))
    return done.crossJoin(live)  # two rows and one


ALERTS = melted(E.ALERT, f"SELECT v.* EXCLUDE (threshold), CASE WHEN NOT starts_with(rule_id, 'L1_BP_STOP') THEN threshold END AS threshold, 'R_' || rule_id AS rule_iri, a.asset, 'GuardAlert_base_' || window_id || '_' || alert_id AS subject, 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS graph FROM v_guard_alert v {AS} v.ticker")


@case("append_whole", check_sql("v_guard_alert assets", f", q AS ({ALERTS}) SELECT graph, predicate, count(*) AS triples FROM q GROUP BY 1, 2"))
def append_whole(spark, sf):
    """Every property of every alert appended, in chunks, and read back from the store."""
    out = scratch(spark)
    sinks.append_graph(melt(alert_table(spark, sf), E.ALERT), out, max_records=sinks.CHUNK)
    return spark.read.parquet(out).groupBy("graph", "predicate").agg(F.count(F.lit(1)).alias("triples"))


@case("report_whole", check_sql("v_guard_alert assets", f", q AS ({ALERTS}) SELECT 'graph' AS section, graph AS key, count(*) AS \"rows\" FROM q GROUP BY 2 UNION ALL SELECT 'failure', 'lineitem/range/lost', count(*) FROM lineitem WHERE l_discount > 0.09"))
def report_whole(spark, sf):
    """The run report over all quads."""
    f = table(spark, sf, "lineitem").filter("l_discount > 0.09").select(F.lit("lineitem").alias("view"), F.lit("range").alias("check"), F.lit("lost").alias("fate"))
    return sinks.run_report(f, melt(alert_table(spark, sf), E.ALERT))


@case("export_whole", check_sql("v_guard_alert assets", f""", q AS ({ALERTS}), l AS (SELECT DISTINCT '<' || subject || '> <' || predicate || '> ' || CASE WHEN object_kind = 'iri' THEN '<' || object || '>' WHEN datatype = 'xsd:string' THEN '"' || object || '"' ELSE '"' || object || '"^^<' || datatype || '>' END || ' .' AS line FROM q)
    SELECT count(*) AS lines, min(line) AS first_line, max(line) AS last_line, CAST(sum(CAST('0x' || substr(md5(line), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM l"""))
def export_whole(spark, sf):
    """All quads as sorted N-Triples, read back: the number of lines, the first, the last, and a sum of hashes."""
    out = scratch(spark)
    sinks.export_ntriples(melt(alert_table(spark, sf), E.ALERT), out)
    return spark.read.text(out).agg(F.count(F.lit(1)).alias("lines"), F.min("value").alias("first_line"), F.max("value").alias("last_line"), F.sum(F.conv(F.substring(F.md5(F.col("value").cast("binary")), 1, 8), 16, 10).cast("bigint")).alias("digest"))
