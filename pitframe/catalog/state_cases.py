"""Streams over several batches, each a new start from the same checkpoint, with state between them."""

from pyspark.sql import functions as F

from pitframe.catalog.entity_cases import alert_table
from pitframe.catalog.measure_cases import MEM
from pitframe.catalog.registry import case, table
from pitframe.catalog.stream_cases import in_starts, scratch
from pitframe.operators import gate as G
from pitframe.operators import temporal as T
from pitframe.operators.quads import melt
from pitframe.plans import entities as E
from pitframe.plans.casebook import check_sql
from pitframe.session import cut_lineage, spool
from pitframe.sources import sinks
from pitframe.sources.catalogue import Catalogue
from pitframe.streaming import jobs as J
from pitframe.streaming import state as S


def timed(spark, sf, *columns):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(*columns) if columns else e


@case("stream_ids", "SELECT user_id, 1 AS times FROM (SELECT DISTINCT user_id FROM events)")
def stream_ids(spark, sf):
    """Four starts, the third older than the others and the last all rows again: each id once."""
    out = scratch(spark)
    e = timed(spark, sf, "user_id", "ts").withColumn("again", F.explode(F.array(F.lit(False), F.lit(True))))
    late, even, again = F.col("ts") < "2024-01-05", F.col("user_id") % 2 == 0, F.col("again")
    in_starts(spark, e, out, [~again & ~late & even, ~again & ~late & ~even, ~again & late, again], lambda s: J.run_available(s.select("user_id"), f"{out}/cp", S.ingest_ids(out, "user_id")))
    return J.written(spark, f"{out}/rows", "user_id bigint").groupBy("user_id").agg(F.count(F.lit(1)).alias("times"))


@case("stream_lost", """
    WITH e AS (SELECT event_id AS k, CAST(CAST(ts AS DATE) AS VARCHAR) AS g, CAST(ts AS DATE) <= DATE '2024-01-10' AS early, event_id % 2 AS odd, event_id % 5 > 0 AS ok FROM events),
      w AS (SELECT DISTINCT g FROM e WHERE early AND odd = 0 AND ok),
      f AS (SELECT 0 AS batch, CASE WHEN ok THEN 'written' ELSE 'late' END AS fate FROM e WHERE early AND odd = 0
        UNION ALL SELECT 1, CASE WHEN early AND g IN (SELECT g FROM w) THEN 'lost' WHEN early AND ok THEN 'written' ELSE 'late' END FROM e WHERE NOT early OR odd = 1
        UNION ALL SELECT 2, CASE WHEN NOT early THEN 'written' WHEN g NOT IN (SELECT g FROM w) THEN NULL WHEN odd = 1 THEN 'lost before' WHEN ok THEN 'stored' ELSE 'lost' END FROM e)
    SELECT batch, fate, count(*) AS "rows" FROM f GROUP BY 1, 2""")
def stream_lost(spark, sf):
    """Graphs are days. A late row is written once it is sound; a row of a written graph is lost, listed once and known afterwards."""
    out = scratch(spark)
    e = timed(spark, sf, F.col("event_id").alias("k"), F.col("ts").cast("date").cast("string").alias("g")).withColumn("round", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    early, odd, last = F.col("g") <= "2024-01-10", F.col("k") % 2 == 1, F.col("round") == 2
    e = e.withColumn("ok", F.when(last, True).when(~early, False).otherwise(F.col("k") % 5 > 0))
    in_starts(spark, e, out, [(F.col("round") == 0) & early & ~odd, (F.col("round") == 1) & (~early | odd), last], lambda s: J.run_available(s.select("k", "g", "ok"), f"{out}/cp", S.settle_rows(out, "k", "g", "ok")))
    return spark.read.parquet(f"{out}/fates").select(F.col("batch").cast("int").alias("batch"), "fate", "rows")


@case("stream_running_checks", """
    WITH b AS (SELECT event_id % 4 AS batch, count(*) AS n, count(*) FILTER (event_id % 4 = 2 AND value < 20) AS nulls FROM events GROUP BY 1),
      c AS (SELECT batch, sum(n) OVER (ORDER BY batch) AS n, sum(nulls) OVER (ORDER BY batch) AS nulls FROM b)
    SELECT batch, CAST(n AS BIGINT) AS seen, 0 AS twice, CASE WHEN nulls > 0.1 * n THEN 'NULL rate of value' ELSE '' END AS reasons FROM c WHERE batch <= (SELECT min(batch) FROM c WHERE nulls > 0.1 * n)
    UNION ALL SELECT -1, count(*), 0, 'written' FROM events WHERE event_id % 4 < (SELECT min(batch) FROM c WHERE nulls > 0.1 * n)""")
def stream_running_checks(spark, sf):
    """A NULL rate over all rows that crosses its bound in the third batch; the stream ends there, and that batch isn't written."""
    from pyspark.errors import StreamingQueryException
    out = scratch(spark)
    e = timed(spark, sf, "event_id", "value").withColumn("value", F.when((F.col("event_id") % 4 == 2) & (F.col("value") < 20), None).otherwise(F.col("value")))
    try:
        in_starts(spark, e, out, [F.col("event_id") % 4 == i for i in range(4)], lambda s: J.run_available(s, f"{out}/cp", S.running_checks(out, "event_id", {"value": 0.1})))
    except StreamingQueryException as stopped:
        if "StreamStopped" not in str(stopped):
            raise
    seen = spark.read.parquet(f"{out}/verdicts").select(F.col("batch").cast("int").alias("batch"), F.col("rows").alias("seen"), "twice", "reasons")
    kept = J.written(spark, f"{out}/rows", "event_id bigint").agg(F.lit(-1).alias("batch"), F.count(F.lit(1)).alias("seen"), F.lit(0).cast("long").alias("twice"), F.lit("written").alias("reasons"))
    return seen.unionByName(kept)


@case("stream_repeated_keys", """
    SELECT batch, CAST(sum(n) OVER (ORDER BY batch) AS BIGINT) AS seen, CAST(sum(twice) OVER (ORDER BY batch) AS BIGINT) AS twice FROM (
      SELECT event_id % 3 AS batch, count(*) AS n, count(*) - count(DISTINCT user_id) FILTER (NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_id % 3 < e.event_id % 3)) AS twice FROM events e GROUP BY 1)""")
def stream_repeated_keys(spark, sf):
    """Rows whose key came before, within a batch and over batches, counted as the batches come."""
    out = scratch(spark)
    e = timed(spark, sf, "event_id", "user_id")
    in_starts(spark, e, out, [F.col("event_id") % 3 == i for i in range(3)], lambda s: J.run_available(s.select("user_id"), f"{out}/cp", S.running_checks(out, "user_id", {}, most_repeated=1 << 60)))
    return spark.read.parquet(f"{out}/verdicts").select(F.col("batch").cast("int").alias("batch"), F.col("rows").alias("seen"), "twice")


RUN_DAYS = ("2024-02-10", "2024-04-02", "2024-04-10", "2024-07-15", "2024-07-16")


@case("stream_release", """
    WITH s AS (SELECT event_id, event_id % 2 AS fundamental, event_id % 3 AS arrives, CAST(CAST(ts AS DATE) + CAST(70 * (user_id % 3) AS INTEGER) AS DATE) AS av FROM events),
      q AS (SELECT *, CAST(date_trunc('quarter', av) + INTERVAL 3 MONTH AS DATE) AS closes FROM s),
      d AS (SELECT * FROM (VALUES (0, DATE '2024-02-10'), (1, DATE '2024-04-02'), (2, DATE '2024-04-10'), (3, DATE '2024-07-15'), (4, DATE '2024-07-16')) v(batch, run_day)),
      r AS (SELECT * FROM (VALUES (DATE '2024-04-05'), (DATE '2024-07-16')) v(as_of)),
      o AS (SELECT event_id, fundamental, quarter(av) AS quarter, (SELECT min(batch) FROM d WHERE batch >= arrives AND CASE WHEN fundamental = 0 THEN av <= run_day
              ELSE closes <= run_day AND EXISTS (SELECT 1 FROM r WHERE as_of <= run_day AND as_of >= closes) END) AS batch FROM q)
    SELECT coalesce(batch, -1) AS batch, fundamental, quarter, count(*) AS "rows" FROM o GROUP BY 1, 2, 3""")
def stream_release(spark, sf):
    """Five run days: rows wait for their day, their quarter's end, and a full run as of a later quarter; each is released once."""
    out = scratch(spark)
    available = F.date_add(F.col("ts").cast("date"), (70 * (F.col("user_id") % 3)).cast("int"))
    s = timed(spark, sf, "event_id", F.when(F.col("event_id") % 2 == 1, "FUNDAMENTAL").otherwise("TECHNICAL").alias("score_type"), F.concat(F.lit("T"), (F.col("user_id") % 1000).cast("string")).alias("ticker"), available.alias("available_at"), F.lit(1.0).alias("raw_value"), F.lit(1.0).alias("normalized_score"))
    assets = s.select("ticker").distinct()
    params = '{"forms": ["10-K", "10-Q"], "limit": null, "since_year": null, "tickers": null, "until_year": null}'
    runs = spark.createDataFrame([(1, "2024-04-05", "completed", 5, params), (2, "2024-07-16", "completed", 5, params), (3, "2024-04-01", "failed", 5, params)], "run_id bigint, as_of string, status string, completed_units bigint, params_json string").withColumn("as_of", F.col("as_of").cast("date"))
    sink = S.release_scores(out, assets, runs, lambda batch: RUN_DAYS[batch])
    in_starts(spark, s, out, [F.col("event_id") % 3 == i for i in range(3)], lambda x: J.run_available(x, f"{out}/cp", sink))
    for batch in (3, 4):  # run days on which nothing arrives
        sink(s.limit(0), batch)
    ddl = "event_id bigint, score_type string, available_at date"
    done = spark.read.schema(ddl + ", batch int").parquet(f"{out}/projected")
    rows = done.unionByName(S.still_waiting(spark, out, ddl).withColumn("batch", F.lit(-1)))
    return rows.groupBy("batch", (F.col("score_type") == "FUNDAMENTAL").cast("int").alias("fundamental"), F.quarter("available_at").alias("quarter")).agg(F.count(F.lit(1)).alias("rows"))


@case("stream_episodes_keyed", f"WITH RECURSIVE {MEM} SELECT a AS asset_id, since, max(started) AS start_kind, min(CASE WHEN closed IS NOT NULL THEN d END) AS released, max(closed) AS cause FROM fo WHERE since IS NOT NULL GROUP BY 1, 2")
def stream_episodes_keyed(spark, sf):
    """Open episodes in the state store over four starts of whole days in order; the batch form is its check."""
    out = scratch(spark)
    kinds = F.array(F.when((F.col("event_type") == "error") & (F.col("value") > 8), "stop"), F.when((F.col("event_type") == "click") & (F.col("value") > 14), "blocked"),
                    F.when((F.col("event_type") == "view") & (F.col("value") > 25), "reentry"), F.when((F.col("event_type") != "signup") & (F.dayofmonth("ts") % 3 == 0), "ranked"))
    e = timed(spark, sf).select(F.col("user_id").alias("asset_id"), F.col("ts").cast("date").alias("date"), F.explode(kinds).alias("kind")).filter("kind IS NOT NULL").distinct()
    ranking = e.filter("kind = 'ranked'").select("date").distinct()
    days = [r["date"] for r in ranking.collect()]  # a calendar: a day each
    cut = ["2024-01-08", "2024-01-15", "2024-01-22"]
    parts = [F.col("date") < cut[0], (F.col("date") >= cut[0]) & (F.col("date") < cut[1]), (F.col("date") >= cut[1]) & (F.col("date") < cut[2]), F.col("date") >= cut[2]]
    with S.rocksdb(spark):
        in_starts(spark, e, out, parts, lambda s: J.run_available(S.keyed_episodes(s, days), f"{out}/cp", J.write_batch(f"{out}/rows")))
    return S.episodes_of(J.written(spark, f"{out}/rows", S.EPISODE), ranking)


# --- the store's catalogue, and later events ---


@case("append_catalogue", check_sql("v_guard_alert", """
    SELECT 'urn:graph:derived:backtest:base:' || window_id || ':' || backtest_run_id AS graph, CASE WHEN window_id IN ('P5', 'P6') THEN 1 ELSE 2 END AS load, count(*) AS declared, 'already-in-the-store' AS status FROM v_guard_alert GROUP BY 1, 2"""))
def append_catalogue(spark, sf):
    """Two loads, then a batch planned against the catalogue: which load wrote a graph, what the index declares of it, what a third load would do."""
    out = scratch(spark)
    q = spool(melt(alert_table(spark, sf), E.ALERT))
    sinks.append_graph(q.filter(F.col("graph").rlike(":P[56]:")), out)
    first = Catalogue(spark, out).graphs().select(F.collect_set("version").alias("v")).first()["v"]
    sinks.append_graph(q, out)
    c = Catalogue(spark, out)
    graphs = c.graphs().select("graph", F.when(F.col("version").isin(first), 1).otherwise(2).alias("load"))
    schema = G.GateSchema(leaf_classes=("GuardAlert",), relations=("alertRule", "guardAsset"))
    plan = G.plan_batch(q, q.limit(0), schema, catalogue=c).select("graph", "status")
    declared = c.subjects().groupBy("graph").agg(F.count(F.lit(1)).alias("declared"))
    return graphs.join(declared, "graph").join(plan, "graph")


@case("taken_ids_indexed", check_sql("v_guard_alert", "SELECT 'GuardAlert_base_' || window_id || '_' || alert_id || ': id-stored' AS reason FROM v_guard_alert WHERE alert_id % 3 = 0"))
def taken_ids_indexed(spark, sf):
    """Individuals declared again in another graph, found by the index alone."""
    out = scratch(spark)
    q = cut_lineage(melt(alert_table(spark, sf), E.ALERT))
    sinks.append_graph(q, out)
    again = q.filter((F.col("predicate") == "rdf:type") & (F.regexp_extract("subject", r"_(\d+)$", 1).cast("long") % 3 == 0)).withColumn("graph", F.lit("urn:graph:ingest:SECTOR:2001-01-01"))
    return G.taken_ids(again, q.limit(0), Catalogue(spark, out).subjects()).select("reason")


@case("later_summary", """
    SELECT e.event_id, (SELECT count(*) FROM events l WHERE l.user_id = e.user_id AND l.event_type = 'view' AND l.ts > e.ts) AS n_later,
      (SELECT min(ts) FROM events l WHERE l.user_id = e.user_id AND l.event_type = 'view' AND l.ts > e.ts) AS first_later, (SELECT max(ts) FROM events l WHERE l.user_id = e.user_id AND l.event_type = 'view' AND l.ts > e.ts) AS last_later
    FROM events e WHERE e.event_type = 'error'""")
def later_summary(spark, sf):
    """How many views a user has after each error, the first and the last of them; days are the blocks."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    day = lambda t: F.datediff(t.cast("date"), F.lit("2024-01-01").cast("date"))
    x = T.later_summary(e.filter("event_type = 'error'"), e.filter("event_type = 'view'").select("user_id", F.col("ts").alias("at")), ["user_id"], "ts", "at", day)
    return x.select("event_id", "n_later", "first_later", "last_later")
