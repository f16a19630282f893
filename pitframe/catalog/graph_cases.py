"""Quads, class tables, hierarchies, deltas, shapes and the gate over customers, nations and orders."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.catalog.registry import case, table
from pitframe.operators import delta as D
from pitframe.operators import gate as G
from pitframe.operators import hierarchy as H
from pitframe.operators import quads as Q
from pitframe.operators import shapes as S
from pitframe.sources.sinks import split_graphs as split

REGION = Q.class_map("Region", "r_name string as=name")
NATION = Q.class_map("Nation", "n_name string as=name\nregion iri as=inRegion inverse=hasNation")
CUSTOMER = Q.class_map("Customer", "c_name string as=name\nbalance decimal\nc_mktsegment string as=segment\nnation iri as=ofNation inverse=hasCustomer\nsince date")


def class_tables(spark, sf):
    r = table(spark, sf, "region").withColumn("subject", F.concat(F.lit("R_"), F.col("r_regionkey").cast("string"))).withColumn("graph", F.lit("g:nation"))
    n = table(spark, sf, "nation").withColumn("subject", F.concat(F.lit("N_"), F.col("n_nationkey").cast("string"))).withColumn("graph", F.lit("g:nation"))
    n = n.withColumn("region", F.concat(F.lit("R_"), F.col("n_regionkey").cast("string")))
    first = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.col("o_orderdate").cast("date")).alias("since"))
    c = table(spark, sf, "customer").join(first, "c_custkey", "left").withColumn("subject", F.concat(F.lit("C_"), F.col("c_custkey").cast("string")))
    c = c.withColumn("graph", F.concat(F.lit("g:customer:"), (F.col("c_nationkey") % 5).cast("string"))).withColumn("nation", F.concat(F.lit("N_"), F.col("c_nationkey").cast("string")))
    c = c.withColumn("balance", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("decimal(18,2)")))
    return Q.project(r, REGION), Q.project(n, NATION), Q.project(c, CUSTOMER)


def quads(spark, sf) -> DataFrame:
    r, n, c = class_tables(spark, sf)
    return Q.melt(r, REGION).unionByName(Q.melt(n, NATION)).unionByName(Q.melt(c, CUSTOMER))


def _lit(g, s, p, o, dt, src):
    return f"SELECT {g} AS graph, {s} AS subject, '{p}' AS predicate, {o} AS object, 'literal' AS object_kind, '{dt}' AS datatype, CAST(NULL AS VARCHAR) AS lang FROM {src}"


def _iri(g, s, p, o, src):
    return f"SELECT {g} AS graph, {s} AS subject, '{p}' AS predicate, {o} AS object, 'iri' AS object_kind, CAST(NULL AS VARCHAR) AS datatype, CAST(NULL AS VARCHAR) AS lang FROM {src}"


CSRC = "(SELECT c.*, 'C_' || c_custkey AS s, 'N_' || c_nationkey AS n, 'g:customer:' || (c_nationkey % 5) AS g, (SELECT min(CAST(o_orderdate AS DATE)) FROM orders WHERE o_custkey = c_custkey) AS since FROM customer c)"
NSRC = "(SELECT *, 'N_' || n_nationkey AS s, 'R_' || n_regionkey AS r FROM nation)"
QSQL = "q AS (" + " UNION ALL ".join([
    _iri("'g:nation'", "'R_' || r_regionkey", "rdf:type", "'Region'", "region"),
    _lit("'g:nation'", "'R_' || r_regionkey", "name", "r_name", "xsd:string", "region"),
    _iri("'g:nation'", "s", "rdf:type", "'Nation'", NSRC), _lit("'g:nation'", "s", "name", "n_name", "xsd:string", NSRC),
    _iri("'g:nation'", "s", "inRegion", "r", NSRC), _iri("'g:nation'", "r", "hasNation", "s", NSRC),
    _iri("g", "s", "rdf:type", "'Customer'", CSRC), _lit("g", "s", "name", "c_name", "xsd:string", CSRC),
    _lit("g", "s", "balance", "rtrim(rtrim(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '0'), '.')", "xsd:decimal", CSRC) + " WHERE c_acctbal > 0",
    _lit("g", "s", "segment", "c_mktsegment", "xsd:string", CSRC), _iri("g", "s", "ofNation", "n", CSRC), _iri("g", "n", "hasCustomer", "s", CSRC),
    _lit("g", "s", "since", "CAST(since AS VARCHAR)", "xsd:date", CSRC) + " WHERE since IS NOT NULL",
]) + ")"


@case("melt", f"WITH {QSQL} SELECT * FROM q")
def melt(spark, sf):
    return quads(spark, sf)


@case("pivot_class", f"SELECT g AS graph, s AS subject, c_name AS name, CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS balance, c_mktsegment AS segment, n AS \"ofNation\", since FROM {CSRC}")
def pivot_class(spark, sf):
    props = {"name": "string", "balance": "decimal(18,2)", "segment": "string", "ofNation": "string", "since": "date"}
    return Q.pivot_class(quads(spark, sf), "Customer", props)


@case("pivot_class_many", f"SELECT 'g:nation' AS graph, 'R_' || r_regionkey AS subject, r_name AS name, string_agg('N_' || n_nationkey, ' ' ORDER BY 'N_' || n_nationkey) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2, 3")
def pivot_class_many(spark, sf):
    out = Q.pivot_class(quads(spark, sf), "Region", {"name": "string", "hasNation": "string"}, many=["hasNation"])
    return out.select("graph", "subject", "name", F.array_join("hasNation", " ").alias("nations")).filter("nations <> ''")


@case("graph_diff", f"""
    WITH {QSQL}, a AS (SELECT * FROM q WHERE NOT (predicate = 'segment' AND object = 'BUILDING')), b AS (SELECT * FROM q WHERE NOT (predicate = 'name' AND subject LIKE 'N%'))
    SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def graph_diff(spark, sf):
    q = quads(spark, sf)
    a = q.filter(~((F.col("predicate") == "segment") & (F.col("object") == "BUILDING")))
    return Q.graph_diff(a, q.filter(~((F.col("predicate") == "name") & F.col("subject").startswith("N"))))


@case("graph_sizes", f"WITH {QSQL} SELECT graph, count(*) AS triples FROM q GROUP BY 1")
def graph_sizes(spark, sf):
    return Q.graph_sizes(quads(spark, sf))


@case("class_sizes", f"WITH {QSQL} SELECT t.object AS cls, count(DISTINCT (t.graph, t.subject)) AS individuals, count(*) AS triples FROM q t JOIN q x ON x.graph = t.graph AND x.subject = t.subject WHERE t.predicate = 'rdf:type' GROUP BY 1")
def class_sizes(spark, sf):
    return Q.class_sizes(quads(spark, sf))


@case("property_frequency", f"WITH {QSQL} SELECT t.object AS cls, x.predicate, count(*) AS triples FROM q t JOIN q x ON x.graph = t.graph AND x.subject = t.subject WHERE t.predicate = 'rdf:type' AND t.object IN ('Customer', 'Nation') AND x.predicate <> 'rdf:type' GROUP BY 1, 2")
def property_frequency(spark, sf):
    return Q.property_frequency(quads(spark, sf), ["Customer", "Nation"])


@case("bgp", """
    SELECT 'C_' || c_custkey AS c, c_name AS cname, n_name AS nname, r_name AS rname, CASE WHEN c_acctbal > 0 THEN rtrim(rtrim(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '0'), '.') END AS balance
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE c_mktsegment = 'BUILDING'""")
def bgp(spark, sf):
    q = quads(spark, sf)
    out = Q.bgp(q, [("?c", "segment", "BUILDING"), ("?c", "name", "?cname"), ("?c", "ofNation", "?n"), ("?n", "name", "?nname"), ("?n", "inRegion", "?r"), ("?r", "name", "?rname")],
                optional=[[("?c", "balance", "?balance")]])
    return out.select("c", "cname", "nname", "rname", "balance")


@case("mint_id", """
    SELECT p_partkey, CASE WHEN p_name SIMILAR TO '[A-Za-z0-9][A-Za-z0-9._-]*' THEN 'Part_' || p_name || '_' || p_partkey END AS id_name,
      'Part_' || p_type || '_' || p_partkey AS id_type FROM part""")
def mint_id(spark, sf):
    return table(spark, sf, "part").select("p_partkey", Q.mint_id("Part", "p_name", "p_partkey").alias("id_name"), Q.mint_id("Part", "p_type", "p_partkey").alias("id_type"))


@case("graph_grammar", """
    WITH g AS (SELECT DISTINCT 'urn:graph:ingest:' || CASE o_orderpriority WHEN '1-URGENT' THEN 'TECHNICAL' WHEN '2-HIGH' THEN 'SECTOR' ELSE 'OTHER' END || ':' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS graph, o_orderpriority IN ('1-URGENT', '2-HIGH') AS ok FROM orders
      UNION SELECT 'urn:graph:derived:backtest:base:P' || (o_custkey % 90) || ':' || (o_custkey % 4), o_custkey % 4 > 0 FROM orders
      UNION SELECT 'urn:graph:ingest:TECHNICAL:' || year(o_orderdate) || '-02-' || (28 + o_custkey % 4), o_custkey % 4 = 0 OR (o_custkey % 4 = 1 AND year(o_orderdate) % 4 = 0) FROM orders
      UNION SELECT 'urn:graph:universe:' || year(o_orderdate) || '-Q' || (o_custkey % 6), o_custkey % 6 BETWEEN 1 AND 4 FROM orders
      UNION SELECT 'urn:graph:portfolio:current', true FROM orders)
    SELECT graph, ok, CASE WHEN graph = 'urn:graph:portfolio:current' THEN 'mutable' WHEN ok THEN 'append' END AS mode FROM g""")
def graph_grammar(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    k = lambda n: (F.col("o_custkey") % n).cast("string")
    lane = F.when(F.col("o_orderpriority") == "1-URGENT", "TECHNICAL").when(F.col("o_orderpriority") == "2-HIGH", "SECTOR").otherwise("OTHER")
    y = F.year("day").cast("string")
    names = F.array(
        F.concat_ws(":", F.lit("urn:graph:ingest"), lane, F.col("day").cast("string")), F.concat(F.lit("urn:graph:derived:backtest:base:P"), k(90), F.lit(":"), k(4)),
        F.concat(F.lit("urn:graph:ingest:TECHNICAL:"), y, F.lit("-02-"), (F.col("o_custkey") % 4 + 28).cast("string")),
        F.concat(F.lit("urn:graph:universe:"), y, F.lit("-Q"), k(6)), F.lit("urn:graph:portfolio:current"))
    g = o.select(F.explode(names).alias("graph")).distinct()
    return g.select("graph", Q.valid_graph(F.col("graph")).alias("ok"), Q.graph_mode(F.col("graph")).alias("mode"))


@case("ntriples", f"""
    WITH {QSQL} SELECT DISTINCT graph, '<' || subject || '> <' || predicate || '> ' || CASE WHEN object_kind = 'iri' THEN '<' || object || '>' WHEN datatype <> 'xsd:string' THEN '"' || object || '"^^<' || datatype || '>' ELSE '"' || object || '"' END || ' .' AS line FROM q
    UNION ALL SELECT DISTINCT 'g:doc', '<D_' || doc_id || '> <text> "' || replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't') || '"@' || lang || ' .' FROM documents""")
def ntriples(spark, sf):
    d = table(spark, sf, "documents").select(F.lit("g:doc").alias("graph"), F.concat(F.lit("D_"), F.col("doc_id").cast("string")).alias("subject"), F.lit("text").alias("predicate"),
                                            F.col("text").alias("object"), F.lit("literal").alias("object_kind"), F.lit(None).cast("string").alias("datatype"), "lang")
    return Q.ntriples(quads(spark, sf).unionByName(d))


# --- hierarchies ---


def edges(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("C_"), F.col("c_custkey").cast("string")).alias("child"), F.concat(F.lit("N_"), F.col("c_nationkey").cast("string")).alias("parent"))
    n = table(spark, sf, "nation").select(F.concat(F.lit("N_"), F.col("n_nationkey").cast("string")).alias("child"), F.concat(F.lit("R_"), F.col("n_regionkey").cast("string")).alias("parent"))
    r = table(spark, sf, "region").select(F.concat(F.lit("R_"), F.col("r_regionkey").cast("string")).alias("child"), F.lit("WORLD").alias("parent"))
    return c.unionByName(n).unionByName(r)


ESQL = "e AS (SELECT 'C_' || c_custkey AS child, 'N_' || c_nationkey AS parent FROM customer UNION ALL SELECT 'N_' || n_nationkey, 'R_' || n_regionkey FROM nation UNION ALL SELECT 'R_' || r_regionkey, 'WORLD' FROM region)"


@case("closure", f"WITH RECURSIVE {ESQL}, r AS (SELECT child AS descendant, child AS ancestor FROM e UNION SELECT parent, parent FROM e UNION SELECT r.descendant, e.parent FROM r JOIN e ON e.child = r.ancestor) SELECT DISTINCT * FROM r")
def closure(spark, sf):
    return H.closure(edges(spark, sf))


@case("entail", f"""
    WITH RECURSIVE {ESQL}, r AS (SELECT child AS d, child AS a FROM e UNION SELECT parent, parent FROM e UNION SELECT r.d, e.parent FROM r JOIN e ON e.child = r.a)
    SELECT DISTINCT o_orderkey, r.a AS cls FROM orders JOIN r ON r.d = 'C_' || o_custkey WHERE o_orderpriority = '1-URGENT'""")
def entail(spark, sf):
    t = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.concat(F.lit("C_"), F.col("o_custkey").cast("string")).alias("cls"))
    return H.entail(t, H.closure(edges(spark, sf)))


@case("cycles", """
    WITH RECURSIVE x AS (SELECT o_orderkey AS s, CAST(floor(o_orderkey / 7) AS BIGINT) * 7 + (o_orderkey * o_orderkey + 3 * CAST(floor(o_orderkey / 7) AS BIGINT)) % 7 AS t FROM orders), e AS (SELECT * FROM x WHERE s <> t),
      w AS (SELECT s, t AS cur, 1 AS n, least(s, t) AS low FROM e UNION ALL SELECT w.s, e.t, n + 1, least(low, e.t) FROM w JOIN e ON e.s = w.cur WHERE n < 8 AND w.cur <> w.s)
    SELECT s AS smallest, min(n) AS length FROM w WHERE cur = s AND low = s GROUP BY 1""")
def cycles(spark, sf):
    k, block = F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 7)
    e = table(spark, sf, "orders").select(k.alias("start"), (block * 7 + (k * k + block * 3) % 7).alias("end"))
    return H.cycles(e)


@case("slice_terms", f"""
    WITH RECURSIVE {ESQL}, d AS (SELECT DISTINCT parent FROM e WHERE parent <> 'R_2' AND parent NOT LIKE '%3'), s AS (SELECT 'C_' || c_custkey AS term FROM customer WHERE c_acctbal > 9000),
      r AS (SELECT term FROM s UNION SELECT e.parent FROM r JOIN e ON e.child = r.term WHERE e.parent IN (SELECT parent FROM d))
    SELECT DISTINCT term, term IN (SELECT term FROM s) AS seed FROM r""")
def slice_terms(spark, sf):
    e = edges(spark, sf)
    described = e.select(F.col("parent").alias("term")).filter("term <> 'R_2' AND NOT endswith(term, '3')")
    seeds = table(spark, sf, "customer").filter("c_acctbal > 9000").select(F.concat(F.lit("C_"), F.col("c_custkey").cast("string")).alias("term"))
    return H.slice_terms(seeds, e, described)


@case("references", f"WITH {QSQL} SELECT DISTINCT graph, object AS subject FROM q a WHERE object_kind = 'iri' AND predicate <> 'rdf:type' AND NOT EXISTS (SELECT 1 FROM q b WHERE b.graph = a.graph AND b.subject = a.object AND b.predicate = 'rdf:type')")
def references(spark, sf):
    return H.references(quads(spark, sf))


@case("fetch_context", f"""
    WITH {QSQL}, n AS (SELECT DISTINCT object AS s FROM q WHERE graph LIKE 'g:customer%' AND predicate = 'ofNation'), m AS (SELECT s FROM n UNION SELECT object FROM q WHERE predicate = 'inRegion' AND subject IN (SELECT s FROM n))
    SELECT subject, predicate, object FROM q WHERE graph = 'g:nation' AND predicate IN ('rdf:type', 'name', 'inRegion') AND subject IN (SELECT s FROM m)""")
def fetch_context(spark, sf):
    q = quads(spark, sf)
    refs = H.references(q.filter(F.col("graph").startswith("g:customer"))).filter(F.col("subject").startswith("N"))
    return H.fetch_context(refs, q.filter("graph = 'g:nation'"), ["name", "inRegion"], ["inRegion"]).select("subject", "predicate", "object")


@case("check_edges", """
    WITH p AS (SELECT c_custkey % 40 AS a, c_nationkey AS b, count(*) AS n, CASE WHEN sum(c_acctbal) > 0 THEN 1 END AS w FROM customer GROUP BY 1, 2),
      k AS (SELECT least(a, b) AS lo, greatest(a, b) AS hi, count(*) AS c FROM p GROUP BY 1, 2)
    SELECT a, b, CASE WHEN a = b THEN 'same ends' WHEN w IS NULL THEN 'no weight' WHEN n < 1 THEN 'count below one' WHEN c > 1 THEN 'repeated pair' END AS violation
    FROM p JOIN k ON k.lo = least(a, b) AND k.hi = greatest(a, b) WHERE a = b OR w IS NULL OR n < 1 OR c > 1""")
def check_edges(spark, sf):
    c = table(spark, sf, "customer").groupBy((F.col("c_custkey") % 40).alias("a"), F.col("c_nationkey").cast("bigint").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.when(F.sum(F.col("c_acctbal").cast("decimal(18,2)")) > 0, 1).alias("w")).withColumn("method", F.lit("m"))
    return H.check_edges(c, "a", "b", "w", "n", "method").select("a", "b", "violation")


@case("curated_schema", f"WITH {QSQL} SELECT DISTINCT subject, predicate, object FROM q WHERE predicate IN ('name', 'inRegion') AND (object_kind = 'iri' OR length(object) <= 12)")
def curated_schema(spark, sf):
    return H.curated_schema(quads(spark, sf), ["name", "inRegion"], 12).select("subject", "predicate", "object")


# --- deltas ---


@case("classify_memberships", """
    WITH s AS (SELECT o_orderkey AS membership, o_custkey AS asset, CAST(o_orderdate AS DATE) AS valid_from, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 30 END AS valid_to FROM orders WHERE o_orderkey % 13 <> 0),
      t AS (SELECT o_orderkey AS membership, CASE WHEN o_orderkey % 17 = 0 THEN 0 ELSE o_custkey END AS asset, CASE WHEN o_orderkey % 19 = 0 THEN DATE '1990-01-01' ELSE CAST(o_orderdate AS DATE) END AS valid_from,
        CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + 30 END AS valid_to FROM orders WHERE o_orderkey % 11 <> 0),
      j AS (SELECT coalesce(s.membership, t.membership) AS membership, s.membership AS sm, t.membership AS tm, s.asset AS sa, t.asset AS ta, s.valid_from AS sf, t.valid_from AS tf, s.valid_to AS st, t.valid_to AS tt FROM s FULL JOIN t ON s.membership = t.membership)
    SELECT membership, CASE WHEN tm IS NULL THEN 'new' WHEN sm IS NULL THEN 'drift: absent from the source' WHEN sa <> ta THEN 'drift: other asset' WHEN sf <> tf THEN 'drift: other start'
      WHEN st IS NOT DISTINCT FROM tt THEN 'same' WHEN tt IS NULL THEN 'closure' WHEN st IS NULL THEN 'drift: reopened' ELSE 'drift: other end' END AS outcome,
      CASE WHEN tm IS NOT NULL AND sm IS NOT NULL AND sa = ta AND sf = tf AND tt IS NULL THEN st END AS closes_on FROM j""")
def classify_memberships(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderstatus")
    k = F.col("o_orderkey")
    s = o.filter(k % 13 != 0).select(k.alias("membership"), F.col("o_custkey").alias("asset"), F.col("d").alias("valid_from"), F.when(F.col("o_orderstatus") == "F", F.date_add("d", 30)).alias("valid_to"))
    t = o.filter(k % 11 != 0).select(k.alias("membership"), F.when(k % 17 == 0, 0).otherwise(F.col("o_custkey")).alias("asset"),
                                     F.when(k % 19 == 0, F.lit("1990-01-01").cast("date")).otherwise(F.col("d")).alias("valid_from"), F.when(k % 3 == 0, F.date_add("d", 30)).alias("valid_to"))
    return D.classify_memberships(s, t)


@case("classify_assets", """
    WITH s AS (SELECT p_partkey AS k, p_name, p_brand FROM part WHERE p_partkey % 7 <> 0), t AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE p_name END AS p_name, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS p_brand FROM part WHERE p_partkey % 9 <> 0),
      j AS (SELECT coalesce(s.k, t.k) AS k, s.k AS sk, t.k AS tk, s.p_name IS DISTINCT FROM t.p_name AS c1, s.p_brand IS DISTINCT FROM t.p_brand AS c2 FROM s FULL JOIN t ON s.k = t.k)
    SELECT k, 'new' AS outcome, CAST(NULL AS VARCHAR) AS "column" FROM j WHERE tk IS NULL UNION ALL SELECT k, 'drift: absent from the source', NULL FROM j WHERE sk IS NULL
    UNION ALL SELECT k, 'same', NULL FROM j WHERE sk IS NOT NULL AND tk IS NOT NULL AND NOT c1 AND NOT c2
    UNION ALL SELECT k, 'drift: changed', 'p_name' FROM j WHERE sk IS NOT NULL AND tk IS NOT NULL AND c1 UNION ALL SELECT k, 'drift: changed', 'p_brand' FROM j WHERE sk IS NOT NULL AND tk IS NOT NULL AND c2""")
def classify_assets(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    s = p.filter(k % 7 != 0).select(k.alias("k"), "p_name", "p_brand")
    t = p.filter(k % 9 != 0).select(k.alias("k"), F.when(k % 5 == 0, "x").otherwise(F.col("p_name")).alias("p_name"), F.when(k % 4 != 0, F.col("p_brand")).alias("p_brand"))
    return D.classify_assets(s, t, "k", ["p_name", "p_brand"])


@case("next_delta", "SELECT 'urn:graph:universe:1997-Q2:delta:' || (max(month(o_orderdate)) + 1) AS graph, max(month(o_orderdate)) + 1 AS n FROM orders WHERE year(o_orderdate) = 1997 AND quarter(o_orderdate) = 2")
def next_delta(spark, sf):
    d = F.col("o_orderdate").cast("date")
    g = table(spark, sf, "orders").select(F.concat(F.lit("urn:graph:universe:"), Q.quarter_label(d), F.lit(":delta:"), F.month(d).cast("string")).alias("graph")).distinct()
    return D.next_delta(g, "1997-05-05")


@case("split_graphs", """
    WITH y AS (SELECT year(o_orderdate) AS y, count(*) AS n, count(*) FILTER (month(o_orderdate) <= 6) AS h FROM orders GROUP BY 1), lim AS (SELECT count(*) // 8 AS m FROM orders)
    SELECT CASE WHEN n <= m THEN CAST(y AS VARCHAR) WHEN month(o_orderdate) <= 6 THEN y || ':01-06' ELSE y || ':07-12' END AS period, n > m AND (h = 0 OR h = n) AS split_error, count(*) AS "rows" FROM orders JOIN y ON y.y = year(o_orderdate), lim GROUP BY 1, 2""")
def split_graphs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    bound = o.count() // 8
    return split(o, "day", bound, 1).groupBy("period", "split_error").agg(F.count(F.lit(1)).alias("rows"))


# --- shapes ---

RULES = [
    S.Constraint("CustomerShape", "Customer", "name", "minCount", "1"),
    S.Constraint("CustomerShape", "Customer", "balance", "minCount", "1"),
    S.Constraint("CustomerShape", "Customer", "balance", "maxInclusive", "9000"),
    S.Constraint("CustomerShape", "Customer", "balance", "datatype", "xsd:decimal"),
    S.Constraint("CustomerShape", "Customer", "since", "datatype", "xsd:dateTime"),
    S.Constraint("CustomerShape", "Customer", "segment", "in", values=("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")),
    S.Constraint("CustomerShape", "Customer", "name", "pattern", "[02468]$"),
    S.Constraint("CustomerShape", "Customer", "ofNation", "class", "Nation"),
    S.Constraint("CustomerShape", "Customer", "segment", "hasValue", "BUILDING"),
    S.Constraint("NationShape", "Nation", "hasCustomer", "maxCount", "0"),
    S.Constraint("NationShape", "Nation", "name", "maxLength", "8"),
    S.Constraint("RegionShape", "Region", "hasNation", "maxCount", "4"),
]


@case("validate_shapes", f"""
    WITH {QSQL}, t AS (SELECT DISTINCT graph, subject, object AS cls FROM q WHERE predicate = 'rdf:type'), c AS (SELECT * FROM t WHERE cls = 'Customer'), v AS (SELECT q.*, t.cls FROM q JOIN t ON t.graph = q.graph AND t.subject = q.subject)
    SELECT graph, 'CustomerShape' AS shape, subject AS focus, 'balance' AS path, 'minCount' AS "constraint", '0' AS value FROM c WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.graph = c.graph AND q.subject = c.subject AND predicate = 'balance')
    UNION ALL SELECT graph, 'CustomerShape', subject, 'balance', 'maxInclusive', object FROM v WHERE cls = 'Customer' AND predicate = 'balance' AND CAST(object AS DOUBLE) > 9000
    UNION ALL SELECT graph, 'CustomerShape', subject, 'since', 'datatype', object FROM v WHERE cls = 'Customer' AND predicate = 'since'
    UNION ALL SELECT graph, 'CustomerShape', subject, 'segment', 'in', object FROM v WHERE cls = 'Customer' AND predicate = 'segment' AND object NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')
    UNION ALL SELECT graph, 'CustomerShape', subject, 'name', 'pattern', object FROM v WHERE cls = 'Customer' AND predicate = 'name' AND NOT regexp_matches(object, '[02468]$')
    UNION ALL SELECT graph, 'CustomerShape', subject, 'ofNation', 'class', object FROM v WHERE cls = 'Customer' AND predicate = 'ofNation' AND object IN ('N_7', 'N_21')
    UNION ALL SELECT graph, 'CustomerShape', subject, 'segment', 'hasValue', '1' FROM v WHERE cls = 'Customer' AND predicate = 'segment' AND object <> 'BUILDING'
    UNION ALL SELECT graph, 'NationShape', subject, 'name', 'maxLength', object FROM v WHERE cls = 'Nation' AND predicate = 'name' AND length(object) > 8
    UNION ALL SELECT graph, 'RegionShape', subject, 'hasNation', 'maxCount', CAST(count(*) AS VARCHAR) FROM v WHERE cls = 'Region' AND predicate = 'hasNation' GROUP BY graph, subject HAVING count(*) > 4""")
def validate_shapes(spark, sf):
    q = quads(spark, sf)
    context = q.filter((F.col("graph") == "g:nation") & ~F.col("subject").isin("N_7", "N_21"))
    customers = q.filter(F.col("graph") != "g:nation")
    links = [r for r in RULES if r.kind == "class"]
    rest = S.validate_shapes(q, [r for r in RULES if r.kind != "class"])
    return rest.unionByName(S.validate_shapes(customers, links, context=context))


@case("shape_pairs", f"""
    WITH d AS (SELECT l_orderkey, CAST(o_orderdate AS DATE) AS opened, CAST(l_shipdate AS DATE) AS ship FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
      g AS (SELECT l_orderkey, CAST(opened AS VARCHAR) AS opened, CAST(min(ship) AS VARCHAR) AS lo, CAST(max(ship) AS VARCHAR) AS hi FROM d GROUP BY 1, 2)
    SELECT 'O_' || l_orderkey AS focus, 'lessThan' AS "constraint", opened AS value FROM g WHERE opened >= lo UNION ALL SELECT 'O_' || l_orderkey, 'lessThanOrEquals', hi FROM g WHERE hi > opened
    UNION ALL SELECT DISTINCT 'O_' || l_orderkey, 'equals', CAST(ship AS VARCHAR) FROM d WHERE ship <> opened
    UNION ALL SELECT DISTINCT 'O_' || l_orderkey, 'equals', CAST(opened AS VARCHAR) FROM d x WHERE opened NOT IN (SELECT ship FROM d y WHERE y.l_orderkey = x.l_orderkey)""")
def shape_pairs(spark, sf):
    q = order_quads(spark, sf)
    rules = [S.Constraint("P", "Order", "opened", "lessThan", "ship"), S.Constraint("P", "Order", "ship", "lessThanOrEquals", "opened"), S.Constraint("P", "Order", "opened", "equals", "ship")]
    return S.validate_shapes(q, rules).select("focus", "constraint", "value")


def _q(df, s, p, o, kind="literal", dt="xsd:date", graph="g:order"):
    return df.select(F.lit(graph).alias("graph") if isinstance(graph, str) else graph.alias("graph"), s.alias("subject"), F.lit(p).alias("predicate"), o.cast("string").alias("object"),
                     F.lit(kind).alias("object_kind"), F.lit(dt if kind == "literal" else None).cast("string").alias("datatype"), F.lit(None).cast("string").alias("lang"))


def order_quads(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_semi")
    s = F.concat(F.lit("O_"), F.col("o_orderkey").cast("string"))
    l = table(spark, sf, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    ls = F.concat(F.lit("O_"), F.col("l_orderkey").cast("string"))
    return _q(o, s, "rdf:type", F.lit("Order"), "iri").unionByName(_q(o, s, "opened", F.col("o_orderdate").cast("date"))).unionByName(_q(l, ls, "ship", F.col("l_shipdate").cast("date")))


@case("shape_closed", f"WITH {QSQL} SELECT DISTINCT graph, subject AS focus, predicate AS value FROM q a WHERE predicate NOT IN ('rdf:type', 'name', 'segment') AND EXISTS (SELECT 1 FROM q b WHERE b.graph = a.graph AND b.subject = a.subject AND b.predicate = 'rdf:type' AND b.object = 'Customer')")
def shape_closed(spark, sf):
    q = quads(spark, sf)
    return S.check_closed(q, "C", "Customer", ["name", "segment"], S.type_table(q)).select("graph", "focus", "value")


@case("shape_logical", f"""
    WITH c AS (SELECT s, c_acctbal > 5000 AS a, c_mktsegment = 'BUILDING' AS b, coalesce(since < DATE '1994-01-01', false) AS d FROM {CSRC})
    SELECT s AS focus, 'or' AS "constraint" FROM c WHERE NOT (a OR b OR d) UNION ALL SELECT s, 'and' FROM c WHERE NOT (a AND b AND d) UNION ALL SELECT s, 'not' FROM c WHERE a
    UNION ALL SELECT s, 'xone' FROM c WHERE CAST(a AS INT) + CAST(b AS INT) + CAST(d AS INT) <> 1""")
def shape_logical(spark, sf):
    _, _, c = class_tables(spark, sf)
    conds = [F.col("balance") > 5000, F.col("segment") == "BUILDING", F.col("since") < F.lit("1994-01-01").cast("date")]
    parts = [S.check_logical(c, "L", k, conds) for k in ("or", "and", "xone")] + [S.check_logical(c, "L", "not", conds[:1])]
    return reduce(DataFrame.unionByName, parts).select("focus", "constraint")


@case("shape_custom", "SELECT 'C_' || c_custkey AS focus, c_mktsegment AS value FROM customer WHERE c_mktsegment = 'MACHINERY' AND (c_acctbal <= 0 OR c_acctbal > 9500)")
def shape_custom(spark, sf):
    _, _, c = class_tables(spark, sf)
    return S.check_custom(c, "X", "segment = 'MACHINERY' AND (balance IS NULL OR balance > 9500)", value=F.col("segment")).select("focus", "value")


@case("shape_qualified", """
    WITH d AS (SELECT 'S_' || source AS focus, lang, count(*) AS n FROM documents WHERE n_chars < 120 GROUP BY 1, 2), l AS (SELECT unnest(['en', 'es']) AS value)
    SELECT f.focus, l.value FROM (SELECT DISTINCT 'S_' || source AS focus FROM documents) f, l LEFT JOIN d ON d.focus = f.focus AND d.lang = l.value WHERE coalesce(d.n, 0) <> 1""")
def shape_qualified(spark, sf):
    d = table(spark, sf, "documents")
    s = F.concat(F.lit("S_"), F.col("source"))
    q = _q(d.select("source").distinct(), s, "rdf:type", F.lit("Source"), "iri").unionByName(_q(d.filter("n_chars < 120").withColumn("l", F.col("lang")), s, "label", F.col("doc_id")))
    labelled = d.filter("n_chars < 120").select(F.lit("g:order").alias("graph"), s.alias("subject"), F.lit("label").alias("predicate"), F.col("text").alias("object"), F.lit("literal").alias("object_kind"),
                                                F.lit(None).cast("string").alias("datatype"), "lang")
    q = q.filter("predicate = 'rdf:type'").unionByName(labelled)
    return S.check_qualified(q, "Q", "Source", "label", ["en", "es"], S.type_table(q)).select("focus", "value")


@case("shape_node", f"WITH {QSQL} SELECT graph, subject AS focus, 'name' AS value FROM q WHERE predicate = 'inRegion' AND object IN (SELECT 'R_' || r_regionkey FROM region WHERE r_name LIKE 'A%')")
def shape_node(spark, sf):
    q = quads(spark, sf)
    return S.check_node(q, "N", "inRegion", [S.Constraint("R", "Region", "name", "pattern", "^[^A]")]).select("graph", "focus", "value")


@case("shape_targets", f"WITH {QSQL} SELECT 'subjects' AS kind, graph, subject AS focus FROM q WHERE predicate = 'balance' UNION SELECT 'objects', graph, object FROM q WHERE predicate = 'ofNation'")
def shape_targets(spark, sf):
    q = quads(spark, sf)
    return S.targets(q, "subjects_of", "balance").withColumn("kind", F.lit("subjects")).unionByName(S.targets(q, "objects_of", "ofNation").withColumn("kind", F.lit("objects")))


# --- gate: vetoes stored per order, closed and seen again by a batch per quarter ---

SCHEMA = G.GateSchema(leaf_classes=("SECFilingSection", "Veto"), relations=("aboutAsset",))


def _orders(spark, sf):
    ship = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.col("l_shipdate").cast("date")).alias("ship"), F.min(F.col("l_shipdate").cast("date")).alias("first"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day")).join(ship, "o_orderkey", "left")
    return o.withColumn("s", F.concat(F.lit("V_"), F.col("o_orderkey").cast("string"))).withColumn("g", F.concat(F.lit("urn:graph:ingest:SECTOR:"), F.trunc("day", "quarter").cast("string")))


def stored(spark, sf):
    o = _orders(spark, sf).filter(F.col("o_orderkey") % 10 != 9)
    g = F.concat(F.lit("urn:graph:ingest:SECTOR:"), F.date_add(F.trunc("day", "quarter"), 1).cast("string"))
    s = F.col("s")
    cls = F.when(F.col("o_orderkey") % 10 == 8, "SECFilingSection").otherwise("Veto")
    return (_q(o, s, "rdf:type", cls, "iri", graph=g).unionByName(_q(o, s, "raisedOn", F.col("day"), graph=g))
            .unionByName(_q(o.filter("o_orderkey % 10 = 7"), s, "clearedOn", F.date_add("day", 5), graph=g))
            .unionByName(_q(o.filter("o_orderkey % 3 = 0 AND first IS NOT NULL"), s, "lastSeenOn", F.col("first"), graph=g)))


def batch(spark, sf):
    o = _orders(spark, sf).filter("ship IS NOT NULL")
    s, g = F.col("s"), F.col("g")
    return _q(o.filter("o_orderkey % 2 = 0"), s, "clearedOn", F.col("ship"), graph=g).unionByName(
        _q(o.filter("o_orderkey % 5 < 3"), s, "lastSeenOn", F.col("ship"), graph=g))


OSQL = """o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, 'urn:graph:ingest:SECTOR:' || CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS graph, l.* FROM orders JOIN
    (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS ship, min(CAST(l_shipdate AS DATE)) AS first FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey),
    c AS (SELECT *, 'clearedOn' AS p, CASE WHEN k % 10 = 9 THEN 'not-stored' WHEN k % 10 = 8 THEN 'wrong-record' WHEN k % 10 = 7 THEN 'closed-before'
        WHEN ship <= day THEN 'not-after-opening' WHEN k % 3 = 0 AND ship < first THEN 'before-last-sighting' END AS w FROM o WHERE k % 2 = 0
      UNION ALL SELECT *, 'lastSeenOn', CASE WHEN k % 10 = 9 THEN 'not-stored' WHEN k % 10 = 8 THEN 'wrong-record' WHEN k % 10 = 7 THEN 'closed-before'
        WHEN ship < day THEN 'before-opening' WHEN k % 3 = 0 AND ship = first THEN 'sighting-stored' END FROM o WHERE k % 5 < 3)"""


@case("refused_closures", f"WITH {OSQL} SELECT graph, 'closings' AS \"check\", 'V_' || k || ' ' || p || ' : ' || CAST(ship AS VARCHAR) || ' ' || w AS reason FROM c WHERE w IS NOT NULL")
def refused_closures(spark, sf):
    return G.refused_closures(batch(spark, sf), stored(spark, sf), SCHEMA)


@case("gate_unreadable_dates", """
    WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day FROM orders),
      b AS (SELECT k, day + 9 AS d, 'clearedOn' AS p, CASE WHEN k % 6 IN (0, 1, 2) THEN 'unreadable-date' END AS w FROM o WHERE k % 2 = 0
        UNION ALL SELECT k, day + 9, 'lastSeenOn', CASE WHEN k % 6 IN (0, 1, 2) THEN 'unreadable-date' WHEN k % 2 = 0 AND k % 6 = 4 THEN 'unreadable-date' END FROM o)
    SELECT 'V_' || k || ' ' || p || ' : ' || CASE WHEN p = 'clearedOn' AND k % 6 = 4 THEN 'soon' ELSE CAST(d AS VARCHAR) END || ' ' || w AS reason
    FROM (SELECT k, d, p, CASE WHEN p = 'clearedOn' AND k % 6 = 4 THEN 'unreadable-date' ELSE w END AS w FROM b) WHERE w IS NOT NULL""")
def gate_unreadable_dates(spark, sf):
    """Stored openings (k % 6 = 0), all sightings (1) and one of two sightings (2) unreadable; given closings (4)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")).withColumn("s", F.concat(F.lit("V_"), F.col("o_orderkey").cast("string")))
    s, kind, day = F.col("s"), F.col("o_orderkey") % 6, F.col("day").cast("string")
    later = F.date_add("day", 9).cast("string")
    held = (_q(o, s, "rdf:type", F.lit("Veto"), "iri").unionByName(_q(o, s, "raisedOn", F.when(kind == 0, "not-a-date").otherwise(day)))
            .unionByName(_q(o.filter(kind == 1), s, "lastSeenOn", F.lit("yesterday"))).unionByName(_q(o.filter(kind == 2), s, "lastSeenOn", F.lit("2024-13-01")))
            .unionByName(_q(o.filter(kind == 2), s, "lastSeenOn", F.date_add("day", 1).cast("string"))))
    given = _q(o.filter("o_orderkey % 2 = 0"), s, "clearedOn", F.when(kind == 4, "soon").otherwise(later)).unionByName(_q(o, s, "lastSeenOn", later))
    return G.refused_closures(given, held, SCHEMA).select("reason")


@case("plan_batch", f"""
    WITH {OSQL}, n AS (SELECT graph, count(*) AS triples, count(w) AS problems, min('V_' || k || ' ' || p || ' : ' || CAST(ship AS VARCHAR) || ' ' || w) FILTER (w IS NOT NULL) AS reason FROM c GROUP BY 1)
    SELECT graph, triples, CASE WHEN problems > 0 THEN 'refused' ELSE 'would-be-written' END AS status, CASE WHEN problems > 0 THEN 'closings' END AS "check", CASE WHEN problems > 0 THEN problems END AS problems, reason FROM n""")
def plan_batch(spark, sf):
    return G.plan_batch(batch(spark, sf), stored(spark, sf), SCHEMA)


@case("untyped_writes", """
    SELECT 'urn:graph:ingest:SECTOR:1996-01-01' AS graph, 'C_' || c_custkey || ' ' || 'balance : undeclared subject' AS reason FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT 'urn:graph:ingest:SECTOR:1996-01-01', 'C_' || c_custkey || ' clearedOn : must be a date literal' FROM customer WHERE c_custkey % 3 = 1
    UNION ALL SELECT 'urn:graph:ingest:SECTOR:1996-01-01', 'C_' || c_custkey || ' aboutAsset : a relation needs an individual' FROM customer WHERE c_custkey % 3 = 2""")
def untyped_writes(spark, sf):
    c = table(spark, sf, "customer").withColumn("s", F.concat(F.lit("C_"), F.col("c_custkey").cast("string")))
    g = "urn:graph:ingest:SECTOR:1996-01-01"
    pick = lambda i: c.filter(F.col("c_custkey") % 3 == i)
    q = (_q(pick(0), F.col("s"), "balance", F.col("c_acctbal"), dt="xsd:decimal", graph=g).unionByName(_q(pick(1), F.col("s"), "clearedOn", F.col("c_name"), graph=g))
         .unionByName(_q(pick(2), F.col("s"), "aboutAsset", F.col("c_name"), graph=g)).unionByName(_q(pick(2), F.col("s"), "aboutAsset", F.col("s"), "iri", graph=g)))
    return G.untyped_writes(q, SCHEMA).select("graph", "reason")


@case("unknown_types", "SELECT DISTINCT 'unknown type ' || p_type AS reason FROM part")
def unknown_types(spark, sf):
    p = table(spark, sf, "part").withColumn("s", F.col("p_partkey").cast("string"))
    q = _q(p, F.col("s"), "rdf:type", F.col("p_type"), "iri").unionByName(_q(p, F.col("s"), "rdf:type", F.lit("Veto"), "iri"))
    return G.unknown_types(q, SCHEMA).select("reason")


@case("restatement_problems", """
    WITH e AS (SELECT o_orderkey AS k, CAST(floor(o_orderkey / 7) AS BIGINT) * 7 + (o_orderkey * o_orderkey + 3 * CAST(floor(o_orderkey / 7) AS BIGINT)) % 7 AS t, o_custkey % 2 AS lab FROM orders),
      j AS (SELECT e.*, n.k AS nk, n.lab AS nlab FROM e LEFT JOIN e n ON n.k = e.t),
      w AS (SELECT *, CASE WHEN k = t THEN 'replaces-itself' WHEN nk IS NULL THEN 'undeclared-replacement' WHEN lab <> nlab THEN 'other-label' END AS w FROM j)
    SELECT 'S_' || k || ' : ' || w AS reason FROM w WHERE w IS NOT NULL
    UNION ALL SELECT 'S_' || t || ': replaces-several' FROM w WHERE w IS NULL GROUP BY t HAVING count(*) > 1""")
def restatement_problems(spark, sf):
    k, block = F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 7)
    name = lambda c: F.concat(F.lit("S_"), c.cast("string"))
    o = table(spark, sf, "orders")
    q = (_q(o, name(k), "rdf:type", F.lit("SECFilingSection"), "iri").unionByName(_q(o, name(k), "supersededBy", name(block * 7 + (k * k + block * 3) % 7), "iri"))
         .unionByName(_q(o, name(k), "itemLabel", F.col("o_custkey") % 2)))
    return G.restatement_problems(q, SCHEMA).filter(~F.col("reason").startswith("loop: ")).select("reason")


@case("restatement_loops", """
    WITH RECURSIVE x AS (SELECT o_orderkey AS s, CAST(floor(o_orderkey / 7) AS BIGINT) * 7 + (o_orderkey * o_orderkey + 3 * CAST(floor(o_orderkey / 7) AS BIGINT)) % 7 AS t FROM orders), e AS (SELECT 'S_' || s AS s, 'S_' || t AS t FROM x WHERE s <> t),
      w AS (SELECT s, t AS cur, 1 AS n, least(s, t) AS low FROM e UNION ALL SELECT w.s, e.t, n + 1, least(low, e.t) FROM w JOIN e ON e.s = w.cur WHERE n < 8 AND w.cur <> w.s)
    SELECT DISTINCT 'loop: ' || s AS reason FROM w WHERE cur = s AND low = s""")
def restatement_loops(spark, sf):
    k, block = F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 7)
    name = lambda c: F.concat(F.lit("S_"), c.cast("string"))
    o = table(spark, sf, "orders")
    q = _q(o, name(k), "rdf:type", F.lit("SECFilingSection"), "iri").unionByName(_q(o, name(k), "supersededBy", name(block * 7 + (k * k + block * 3) % 7), "iri"))
    return G.restatement_problems(q, SCHEMA).filter(F.col("reason").startswith("loop: ")).select("reason")


@case("refused_supersessions", """
    SELECT 'S_' || o_orderkey || ' : ' || CASE o_orderkey % 5 WHEN 0 THEN 'not-stored' WHEN 1 THEN 'not-a-section' WHEN 2 THEN 'superseded-before' WHEN 3 THEN 'other-label' END AS reason FROM orders WHERE o_orderkey % 5 < 4""")
def refused_supersessions(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    old, new = F.concat(F.lit("S_"), k.cast("string")), F.concat(F.lit("T_"), k.cast("string"))
    b = _q(o, new, "rdf:type", F.lit("SECFilingSection"), "iri").unionByName(_q(o, new, "itemLabel", F.lit("x"))).unionByName(_q(o, old, "supersededBy", new, "iri"))
    held = o.filter(k % 5 != 0)
    st = (_q(held, old, "rdf:type", F.when(k % 5 == 1, "Veto").otherwise("SECFilingSection"), "iri").unionByName(_q(held.filter(k % 5 == 2), old, "supersededBy", F.lit("Z"), "iri"))
          .unionByName(_q(held, old, "itemLabel", F.when(k % 5 == 3, "y").otherwise("x"))))
    return G.refused_supersessions(b, st, SCHEMA).select("reason")


@case("current_sections", "SELECT 'S_' || o_orderkey AS subject FROM orders WHERE o_orderkey % 4 <> 1")
def current_sections(spark, sf):
    o = table(spark, sf, "orders")
    s = F.concat(F.lit("S_"), F.col("o_orderkey").cast("string"))
    q = _q(o, s, "rdf:type", F.lit("SECFilingSection"), "iri").unionByName(_q(o.filter("o_orderkey % 4 = 1"), s, "supersededBy", F.lit("Z"), "iri"))
    return G.current_sections(q, SCHEMA)


@case("taken_ids", "SELECT 'V_' || o_orderkey || ': id-stored' AS reason FROM orders WHERE o_orderkey % 10 <> 9 AND o_orderkey % 4 = 0")
def taken_ids(spark, sf):
    o = _orders(spark, sf).filter("o_orderkey % 4 = 0")
    return G.taken_ids(_q(o, F.col("s"), "rdf:type", F.lit("Veto"), "iri", graph=F.col("g")), stored(spark, sf)).select("reason")


@case("masked_prices", f"""
    WITH {QSQL} SELECT graph, subject, predicate, 'asset' AS via FROM q WHERE predicate = 'balance' AND subject IN (SELECT 'C_' || c_custkey FROM customer WHERE c_custkey % 9 = 0)
    UNION ALL SELECT graph, subject, predicate, 'link' FROM q WHERE predicate = 'balance' AND subject IN (SELECT 'C_' || c_custkey FROM customer WHERE c_nationkey IN (3, 4))""")
def masked_prices(spark, sf):
    m = table(spark, sf, "customer").filter("c_custkey % 9 = 0").select(F.concat(F.lit("C_"), F.col("c_custkey").cast("string")).alias("asset"))
    n = table(spark, sf, "nation").filter("n_nationkey IN (3, 4)").select(F.concat(F.lit("N_"), F.col("n_nationkey").cast("string")).alias("asset"))
    return G.masked_prices(quads(spark, sf), m.unionByName(n), ["balance"], ["ofNation"])
