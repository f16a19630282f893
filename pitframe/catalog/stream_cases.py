"""Streams over the event files, and scans and sinks over files Spark writes from the tables."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitframe.catalog.entity_cases import alert_table
from pitframe.catalog.measure_cases import MEM
from pitframe.catalog.registry import case, table
from pitframe.operators.quads import melt
from pitframe.plans import entities as E
from pitframe.plans.casebook import check_sql
from pitframe.session import shared_root
from pitframe.sources import deliveries, scans, sinks
from pitframe.streaming import jobs as J


def scratch(spark) -> str:
    """A new folder in the cluster's shared space."""
    return f"{shared_root(spark)}/run-{uuid.uuid4().hex}"


def events(spark, sf):
    schema = table(spark, sf, "events").schema
    s = J.file_stream(spark, sf, schema, "events*.parquet")
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def in_starts(spark, df, out, parts, start):
    """Add one part after another to a folder of files; ``start(stream)`` runs what is new each time, from where the last start ended."""
    for part in parts:
        df.filter(part).write.mode("append").parquet(f"{out}/in")
        start(J.file_stream(spark, f"{out}/in", df.schema))


@case("stream_tumbling_counts", """
    WITH b AS (SELECT *, CASE WHEN event_id % 50 = 0 AND CAST(ts AS DATE) < DATE '2024-01-10' THEN 1 ELSE 0 END AS back FROM events),
      h AS (SELECT max(ts) AS high FROM b WHERE back = 0)
    SELECT date_trunc('day', ts) AS window_start, event_type, count(*) FILTER (WHERE back = 0 OR date_trunc('day', ts) + INTERVAL 1 DAY > high - INTERVAL 10 MINUTE) AS n,
      count(*) FILTER (WHERE back = 1 AND date_trunc('day', ts) + INTERVAL 1 DAY <= high - INTERVAL 10 MINUTE) AS late FROM b, h GROUP BY 1, 2""")
def stream_tumbling_counts(spark, sf):
    """Two batches: the second brings rows whose windows have closed."""
    out = scratch(spark)
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    back = (F.col("event_id") % 50 == 0) & (F.col("ts") < "2024-01-10")
    in_starts(spark, e, out, [~back, back], lambda s: J.run_available(s, f"{out}/cp", J.tumbling_counts(f"{out}/rows", "ts", ["event_type"])))
    return J.window_counts(spark, f"{out}/rows", "event_type string").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@case("stream_members", """
    WITH s AS (SELECT user_id, event_type AS kind, min(CAST(ts AS DATE)) + 3 AS f, max(CAST(ts AS DATE)) - 3 AS t FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY 1, 2)
    SELECT e.event_id, s.kind FROM events e JOIN s ON s.user_id = e.user_id AND CAST(e.ts AS DATE) >= f AND CAST(e.ts AS DATE) <= t WHERE e.event_type = 'error'""")
def stream_members(spark, sf):
    out, d = scratch(spark), F.col("ts").cast("date")
    stints = table(spark, sf, "events").filter("event_type IN ('signup', 'purchase')").groupBy("user_id", F.col("event_type").alias("kind")).agg(F.date_add(F.min(d), 3).alias("f"), F.date_sub(F.max(d), 3).alias("t"))
    j = J.members_at_event(events(spark, sf).filter("event_type = 'error'"), stints, ["user_id"], "ts", "f", "t").select("event_id", "kind")
    J.run_available(j, f"{out}/cp", J.write_batch(f"{out}/rows"))
    return J.written(spark, f"{out}/rows", "event_id bigint, kind string")


@case("stream_checks", "SELECT event_id, CASE WHEN value > 30 AND event_type = 'error' THEN 'range,kind' WHEN value > 30 THEN 'range' ELSE 'kind' END AS failed FROM events WHERE value > 30 OR event_type = 'error'")
def stream_checks(spark, sf):
    out = scratch(spark)
    s = J.checked_rows(events(spark, sf), {"range": F.col("value") > 30, "kind": F.col("event_type") == "error"})
    J.run_available(s.filter(F.size("failed") > 0).select("event_id", F.array_join("failed", ",").alias("failed")), f"{out}/cp", J.write_batch(f"{out}/rows"))
    return J.written(spark, f"{out}/rows", "event_id bigint, failed string")


@case("stream_ingest", "SELECT user_id, 1 AS times FROM (SELECT DISTINCT user_id FROM events)")
def stream_ingest(spark, sf):
    """Three batches, the last one older than the others, then all of them again into the same folder."""
    out = scratch(spark)
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    late, middle = F.col("ts") < "2024-01-05", F.col("user_id") % 2 == 0
    in_starts(spark, e, out, [~late & middle, ~late & ~middle, late], lambda s: J.run_available(s.select("user_id"), f"{out}/cp", J.ingest_new(f"{out}/rows", "user_id")))
    again = J.ingest_new(f"{out}/rows", "user_id")
    for batch in (10, 11):  # what a second run of the job would bring
        again(e.select("user_id"), batch)
    return J.written(spark, f"{out}/rows", "user_id bigint").groupBy("user_id").agg(F.count(F.lit(1)).alias("times"))


@case("stream_late", """
    WITH b AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS back FROM events), h AS (SELECT max(ts) AS high FROM b WHERE back = 0)
    SELECT CASE WHEN back = 0 OR ts >= high THEN 'on time' WHEN ts < high - INTERVAL 3 DAY THEN 'lost' ELSE 'late' END AS fate, count(*) AS "rows" FROM b, h GROUP BY 1""")
def stream_late(spark, sf):
    """Two batches; rows of the second are on time, late or lost by the highest time of the first."""
    out = scratch(spark)
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    back = F.col("event_id") % 3 == 0
    in_starts(spark, e, out, [~back, back], lambda s: J.run_available(s, f"{out}/cp", J.settle_late(out, "ts", 3 * 86_400)))
    rows = J.written(spark, f"{out}/rows", "event_id bigint, fate string")
    return rows.groupBy("fate").agg(F.count(F.lit(1)).alias("rows"))


@case("stream_gate", "SELECT CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-10' THEN 'projected' ELSE 'deferred' END AS outcome, count(*) AS \"rows\" FROM events WHERE event_type = 'view' GROUP BY 1")
def stream_gate(spark, sf):
    out = scratch(spark)
    s = events(spark, sf).filter("event_type = 'view'").select(F.lit("TECHNICAL").alias("score_type"), F.concat(F.lit("T"), (F.col("user_id") % 1000).cast("string")).alias("ticker"), F.col("ts").cast("date").alias("available_at"), F.col("value").alias("raw_value"), F.col("value").alias("normalized_score"))
    assets = table(spark, sf, "events").select(F.concat(F.lit("T"), (F.col("user_id") % 1000).cast("string")).alias("ticker")).distinct()
    runs = spark.createDataFrame([], "run_id bigint, as_of date, status string, completed_units bigint, params_json string")
    J.run_available(s, f"{out}/cp", J.gate_scores(out, assets, runs, "2024-01-10"))
    n = lambda p: J.written(spark, f"{out}/{p}", "ticker string").agg(F.count(F.lit(1)).alias("rows")).withColumn("outcome", F.lit(p))
    return n("projected").unionByName(n("deferred"))


@case("stream_episodes", f"WITH RECURSIVE {MEM} SELECT a AS asset_id, since, max(started) AS start_kind, min(CASE WHEN closed IS NOT NULL THEN d END) AS released, max(closed) AS cause FROM fo WHERE since IS NOT NULL GROUP BY 1, 2")
def stream_episodes(spark, sf):
    out = scratch(spark)
    kinds = F.array(F.when((F.col("event_type") == "error") & (F.col("value") > 8), "stop"), F.when((F.col("event_type") == "click") & (F.col("value") > 14), "blocked"),
                    F.when((F.col("event_type") == "view") & (F.col("value") > 25), "reentry"), F.when((F.col("event_type") != "signup") & (F.dayofmonth("ts") % 3 == 0), "ranked"))
    s = events(spark, sf).select(F.col("user_id").alias("asset_id"), F.col("ts").cast("date").alias("date"), F.explode(kinds).alias("kind")).filter("kind IS NOT NULL")
    J.run_available(s, f"{out}/cp", J.fold_episodes(out))
    return J.episodes_so_far(spark, out)


@case("stream_replace_day", check_sql("v_guard_alert", "SELECT 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS graph, count(*) AS alerts FROM v_guard_alert GROUP BY 1"))
def stream_replace_day(spark, sf):
    out = scratch(spark)
    melt(alert_table(spark, sf), E.ALERT).write.parquet(f"{out}/in")
    s = J.file_stream(spark, f"{out}/in", spark.read.parquet(f"{out}/in").schema)
    J.run_available(s, f"{out}/cp", J.replace_day(f"{out}/live", lambda df: df.groupBy("graph").agg(F.count(F.lit(1)).alias("triples"))))
    q = sinks.current_graphs(spark, f"{out}/live")
    return q.filter("predicate = 'alertId'").groupBy("graph").agg(F.count(F.lit(1)).alias("alerts"))


# --- scans and sinks over written files ---


@case("scan_jsonl", "SELECT o_orderkey AS k, o_orderstatus AS s, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 7 > 1")
def scan_jsonl(spark, sf):
    out = scratch(spark)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderdate").cast("date").alias("d"))
    line = F.when(F.col("k") % 7 == 0, F.lit("")).when(F.col("k") % 7 == 1, F.to_json(F.struct("s", "k", "d"))).otherwise(F.to_json(F.struct("k", "s", "d")))
    o.select(line.alias("value")).write.text(out)
    return scans.scan_jsonl(spark, out, T.StructType.fromDDL("k bigint, s string, d date"), ["k"])[0]


@case("scan_jsonl_problems", "SELECT CASE o_orderkey % 7 WHEN 0 THEN 'blank line' ELSE 'keys differ' END AS reason, count(*) AS \"rows\" FROM orders WHERE o_orderkey % 7 < 2 GROUP BY 1 UNION ALL SELECT 'row count', 1")
def scan_jsonl_problems(spark, sf):
    out = scratch(spark)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    line = F.when(F.col("k") % 7 == 0, F.lit("")).when(F.col("k") % 7 == 1, F.to_json(F.struct("s", "k"))).otherwise(F.to_json(F.struct("k", "s")))
    o.select(line.alias("value")).write.text(out)
    bad = scans.scan_jsonl(spark, out, T.StructType.fromDDL("k bigint, s string"), ["k"], 1)[1]
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@case("scan_csv", "SELECT l_orderkey AS k, CAST(l_discount AS DECIMAL(10,4)) AS v, CAST(l_shipdate AS DATE) AS d, 'row' AS part FROM lineitem WHERE l_orderkey % 9 > 0 UNION ALL SELECT count(*), NULL, NULL, 'unreadable: v' FROM lineitem WHERE l_orderkey % 9 = 0")
def scan_csv(spark, sf):
    out = scratch(spark)
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.when(F.col("l_orderkey") % 9 == 0, "n/a").otherwise(F.col("l_discount").cast("decimal(10,4)").cast("string")).alias("v"), F.col("l_shipdate").cast("date").alias("d"))
    l.write.csv(out, header=True)
    good, bad = scans.scan_csv(spark, out, T.StructType.fromDDL("k bigint NOT NULL, v decimal(10,4), d date"))
    n = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("k"))
    none = lambda t: F.lit(None).cast(t)
    return good.withColumn("part", F.lit("row")).unionByName(n.select("k", none("decimal(10,4)").alias("v"), none("date").alias("d"), F.col("reason").alias("part")))


@case("scan_json_doc", "SELECT o_orderkey AS k, o_orderstatus AS s FROM orders UNION ALL SELECT count(DISTINCT o_orderkey // 500), 'spare' FROM orders")
def scan_json_doc(spark, sf):
    out = scratch(spark)
    o = table(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 500).alias("doc"), F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s")).alias("r"))
    docs = o.groupBy("doc").agg(F.collect_list("r").alias("rows"))  # at most 500 rows per document
    docs.select(F.to_json(F.struct("doc", "rows", F.lit(1).alias("spare"))).alias("value")).write.option("maxRecordsPerFile", 1).text(out)  # a file a document
    rows, extra = scans.scan_json_doc(spark, out, T.StructType.fromDDL("doc bigint, rows array<struct<k:bigint,s:string>>"), "rows")
    lacking = extra.groupBy("key").agg(F.count(F.lit(1)).alias("k")).select("k", F.col("key").alias("s"))
    return rows.select("k", "s").unionByName(lacking)


@case("scan_rankings", "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, user_id AS asset_id FROM events WHERE event_type = 'purchase'")
def scan_rankings(spark, sf):
    e = table(spark, sf, "events").filter("event_type = 'purchase'").select(F.col("ts").cast("date").cast("string").alias("date"), "user_id", F.floor(F.col("event_id") / 200).alias("block"))
    lists = e.groupBy("date", "block").agg(F.collect_list(F.struct(F.col("user_id").alias("asset_id"))).alias("rows"))  # blocks of ids bound each list
    body = F.when(F.col("block") % 2 == 0, F.to_json(F.struct("rows"))).otherwise(F.to_json("rows"))
    docs = lists.select(F.concat(F.lit('{"'), "date", F.lit('": '), body, F.lit("}")).alias("value"))
    return scans.scan_rankings(docs)


@case("scan_run_manifest", "SELECT 'base' AS label, n_name AS configuration, 'P' || r_regionkey AS \"window\", n_nationkey AS book_id FROM nation JOIN region ON r_regionkey = n_regionkey")
def scan_run_manifest(spark, sf):
    n = table(spark, sf, "nation")
    run = F.struct(F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("window"), F.lit("d.db").alias("database"), F.col("n_nationkey").cast("bigint").alias("book_id"), F.lit("B").alias("book_code"),
                   F.create_map(F.lit("a"), F.lit("f")).alias("files"), F.create_map(F.lit("a"), F.lit("h")).alias("files_sha256"))
    doc = n.select(F.to_json(F.struct(F.lit("base").alias("label"), F.array(F.struct(F.col("n_name").alias("configuration"), F.array(run).alias("runs"))).alias("configurations"))).alias("value"))
    rows, _ = scans.scan_run_manifest(doc)
    return rows.select("label", "configuration", "window", "book_id")


@case("verify_manifest", "SELECT status, count(*) AS files FROM (SELECT DISTINCT CASE o_orderpriority WHEN '5-LOW' THEN 'unlisted' WHEN '4-NOT SPECIFIED' THEN 'changed' ELSE 'ok' END AS status, o_orderpriority FROM orders UNION ALL SELECT 'missing', 'x') GROUP BY 1")
def verify_manifest(spark, sf):
    out = scratch(spark)
    o = table(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).alias("part"), F.col("o_orderkey").cast("string").alias("value"))
    for part in "12345":  # one folder per delivered file of the sample delivery
        o.filter(F.col("part") == part).select("value").coalesce(1).write.text(f"{out}/d{part}")
    actual = deliveries.file_hashes(spark, f"{out}/d*").filter(F.col("file").endswith(".txt"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{out}/d*").filter(F.col("path").endswith(".txt"))
    part = files.select(F.substring_index("path", "/", -1).alias("file"), F.regexp_extract("path", "/d([1-5])/", 1).alias("part"))
    listed = actual.join(part, "file").filter("part <> '5'")
    digest = F.when(F.col("part") == "4", F.repeat(F.lit("0"), 64)).otherwise(F.col("actual"))
    ghost = listed.limit(1).select(F.concat(F.repeat(F.lit("1"), 64), F.lit("  ghost.txt")).alias("value"))
    lines = listed.select(F.concat(digest, F.lit("  "), F.col("file")).alias("value")).unionByName(ghost)
    expected, _ = deliveries.parse_manifest(lines)
    return deliveries.compare_hashes(expected, actual).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@case("append_graph", check_sql("v_guard_alert", """SELECT 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS graph, CASE WHEN window_id IN ('P5', 'P6') THEN 'already-in-the-store' ELSE 'written' END AS status, count(*) AS alerts FROM v_guard_alert GROUP BY 1, 2"""))
def append_graph(spark, sf):
    out = scratch(spark)
    q = melt(alert_table(spark, sf), E.ALERT).filter("predicate = 'alertId'")
    sinks.append_graph(q.filter(F.col("graph").rlike(":P[56]:")), out)
    report = sinks.append_graph(q, out, max_records=sinks.CHUNK)
    stored = scans.scan_quads(spark, out, prefix="urn:graph:derived:backtest:", family="backtest").groupBy("graph").agg(F.count(F.lit(1)).alias("alerts"))
    return report.join(stored, "graph").select("graph", "status", "alerts")


@case("export_ntriples", "SELECT count(*) AS lines, min('<C_' || c_custkey || '> <name> \"' || c_name || '\" .') AS first_line FROM customer")
def export_ntriples(spark, sf):
    from pitframe.catalog.graph_cases import quads
    out = scratch(spark)
    sinks.export_ntriples(quads(spark, sf).filter("predicate = 'name' AND startswith(subject, 'C')"), out)
    return spark.read.text(out).agg(F.count(F.lit(1)).alias("lines"), F.min("value").alias("first_line"))


@case("run_report", check_sql("v_guard_alert", "SELECT 'graph' AS section, 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS key, count(*) AS \"rows\" FROM v_guard_alert GROUP BY 2 UNION ALL SELECT 'failure', 'lineitem/range/lost', count(*) FROM lineitem WHERE l_discount > 0.09"))
def run_report(spark, sf):
    q = melt(alert_table(spark, sf), E.ALERT).filter("predicate = 'alertId'")
    f = table(spark, sf, "lineitem").filter("l_discount > 0.09").select(F.lit("lineitem").alias("view"), F.lit("range").alias("check"), F.lit("lost").alias("fate"))
    return sinks.run_report(f, q)
