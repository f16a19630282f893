"""Text, collection and catalogue rules, each over a whole table."""

from pyspark.sql import functions as F

from pitframe.catalog.registry import case, table
from pitframe.catalog.stream_cases import scratch
from pitframe.functions import scalars as S
from pitframe.operators import controls, delta, reconcile, visibility
from pitframe.plans import projections as P
from pitframe.sources import sinks


@case("text_rules", r"""
    SELECT doc_id, regexp_full_match(source || CASE doc_id % 3 WHEN 0 THEN '/' ELSE '-a' END, '[A-Za-z0-9][A-Za-z0-9._-]*') AS safe, doc_id % 2 = 0 AS iri,
      md5(replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t')) AS escaped, doc_id % 5 > 0 AS digest FROM documents""")
def text_rules(spark, sf):
    d, i = table(spark, sf, "documents"), F.col("doc_id")
    return d.select(
        "doc_id", S.safe_part(F.concat("source", F.when(i % 3 == 0, "/").otherwise("-a"))).alias("safe"), S.legal_iri(F.concat(F.when(i % 2 == 0, "urn:x:").otherwise("urn: x"), "source")).alias("iri"),
        F.md5(S.turtle_escape(F.col("text")).cast("binary")).alias("escaped"), S.is_sha256(F.concat(F.when(i % 5 == 0, " ").otherwise(""), F.sha2("text", 256))).alias("digest"))


@case("collection_rules", """
    SELECT doc_id, doc_id % 4 > 0 AS list_ok, doc_id % 5 > 1 AS map_ok, doc_id % 3 = 0 AS keys_ok,
      CASE WHEN doc_id % 7 = 0 THEN 'unknown lane' WHEN doc_id % 130 < 10 OR doc_id % 130 > 110 THEN 'outside range' END AS strength FROM documents""")
def collection_rules(spark, sf):
    d, i = table(spark, sf, "documents"), F.col("doc_id")
    number = F.when(i % 5 == 0, F.lit(float("nan"))).when(i % 5 == 1, F.lit(float("inf"))).otherwise(i.cast("double"))
    doc = F.when(i % 3 == 0, F.to_json(F.struct(i.alias("b"), i.alias("a")))).when(i % 3 == 1, F.to_json(F.struct(i.alias("a")))).otherwise("no object")
    lane = F.when(i % 7 == 0, "SEMANTIC").otherwise("SECTOR")
    return d.select("doc_id", S.text_list_ok(F.array("lang", F.when(i % 4 == 0, " ").otherwise(F.col("source")))).alias("list_ok"), S.number_map_ok(F.create_map(F.lit("x"), number)).alias("map_ok"),
                    S.json_keys_are(doc, ["a", "b"]).alias("keys_ok"), S.strength_violation(lane, (i % 130 - 10).cast("double")).alias("strength"))


@case("published_counts", """SELECT o_orderstatus AS outcome, o_orderpriority AS reason, count(*) AS "rows" FROM orders GROUP BY 1, 2""")
def published_counts(spark, sf):
    return visibility.published_counts(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("outcome"), F.col("o_orderpriority").alias("reason")))


@case("nonzero_group2", "SELECT o_custkey AS k, CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS value FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus = 'P') > 0")
def nonzero_group2(spark, sf):
    totals = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.sum(F.when(F.col("o_orderstatus") == "P", 1.0)).alias("value"))
    return controls.nonzero_group2(totals, ["k"])


@case("date_sets", "SELECT CAST(o_orderdate AS DATE) AS day FROM orders EXCEPT SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_linenumber = 1")
def date_sets(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    b = table(spark, sf, "lineitem").filter("l_linenumber = 1").select(F.col("l_shipdate").cast("date").alias("day"))
    return reconcile.date_sets(a, b, ["day"]).filter("only_in = 'left'").select("day")


@case("scheme_problems", """
    WITH s AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0), c AS (SELECT l_orderkey AS k FROM lineitem WHERE l_linenumber = 2), r AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 > 0)
    SELECT k AS cycle_run_id, 'no cycle' AS problem FROM s WHERE k NOT IN (SELECT k FROM r) UNION ALL SELECT k, 'no component' FROM s WHERE k NOT IN (SELECT k FROM c) UNION ALL SELECT k, 'no scheme' FROM c WHERE k NOT IN (SELECT k FROM s)""")
def scheme_problems(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("cycle_run_id"))
    c = table(spark, sf, "lineitem").filter("l_linenumber = 2").select(F.col("l_orderkey").alias("cycle_run_id"))
    return P.scheme_problems(o.filter("cycle_run_id % 2 = 0"), c, o.filter("cycle_run_id % 3 > 0").withColumnRenamed("cycle_run_id", "run_id"))


@case("news_problems", """
    SELECT l_returnflag AS item_kind, l_orderkey AS item_id, l_linestatus AS ticker, count(*) AS "rows", count(DISTINCT l_suppkey % 2) AS revisions FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def news_problems(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("item_kind"), F.col("l_orderkey").alias("item_id"), F.col("l_linestatus").alias("ticker"), (F.col("l_suppkey") % 2).alias("model_revision"))
    return P.news_problems(rows)


@case("late_key_state", """
    SELECT 'v' AS "view", CASE WHEN o_orderkey % 3 = 1 THEN 'a,b' ELSE 'a' END AS columns, CAST(o_orderkey AS VARCHAR) AS key, 2 AS version FROM orders WHERE o_orderkey % 3 > 0 AND NOT (o_orderkey % 3 = 2 AND o_orderkey % 2 = 0)
      AND o_orderkey % 3 <> 1""")
def late_key_state(spark, sf):
    """State over two runs: keys of the first run under other columns go stale, settled ones leave."""
    root = scratch(spark)
    o = table(spark, sf, "orders").select(F.lit("v").alias("view"), F.when(F.col("o_orderkey") % 3 == 1, "a,b").otherwise("a").alias("columns"), F.col("o_orderkey").cast("string").alias("key"), (F.col("o_orderkey") % 3).alias("m"), (F.col("o_orderkey") % 2).alias("h"))
    ddl = "view string, columns string, key string"
    keep = lambda df: df.select("view", "columns", "key")
    sinks.write_state(keep(o.filter("m = 1")), root, 1)
    state, number = sinks.read_state(spark, root, ddl)
    layouts = spark.createDataFrame([("v", "a")], "view string, columns string")
    new, _ = sinks.late_keys_after(state, keep(o.filter("m = 2")), o.filter("m = 2 AND h = 0").select("view", "key"), layouts)
    sinks.write_state(new, root, number + 1)
    state, number = sinks.read_state(spark, root, ddl)
    return state.withColumn("version", F.lit(number))


@case("delta_batch", """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'membership' ELSE 'closure' END AS part, count(*) AS "rows" FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1
    UNION ALL SELECT 'asset', count(*) FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'clean', 1""")
def delta_batch(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "F", "new").when(F.col("o_orderstatus") == "O", "closure").otherwise("same")
    m = table(spark, sf, "orders").select("o_orderkey", kind.alias("outcome"), F.col("o_orderdate").alias("closes_on"))
    a = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "new").otherwise("same").alias("outcome"), F.lit("x").alias("column"))
    clean, assets, memberships, closures = delta.delta_batch(m, a)
    n = lambda df, part: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(part).alias("part"), "rows")
    out = n(assets, "asset").unionByName(n(memberships, "membership")).unionByName(n(closures, "closure"))
    return out.unionByName(spark.createDataFrame([("clean", int(clean))], "part string, rows bigint"))
