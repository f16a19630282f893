"""Entity links, company lines and referential checks."""

from pyspark.sql import functions as F

from pitframe.catalog.registry import case, table
from pitframe.operators import integrity as I
from pitframe.operators import linking as L

# CIK = customer block of two, symbol = market segment, stints = first to last order day per symbol
LINES_SQL = """
    SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey || '-' || CAST(floor(c_custkey / 4) AS BIGINT) END AS cik,
      c_mktsegment || '.' || (c_custkey % 50) AS symbol, min(CAST(o_orderdate AS DATE)) AS valid_from,
      CASE WHEN max(CAST(o_orderdate AS DATE)) < DATE '2000-06-01' THEN max(CAST(o_orderdate AS DATE)) END AS valid_to
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, year(o_orderdate) % 3"""


def stints(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("day"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").join(o, "c_custkey")
    block = F.floor(F.col("c_custkey") / 4).cast("string")
    c = c.withColumn("cik", F.when(F.col("c_custkey") % 11 != 0, F.concat_ws("-", F.col("c_nationkey").cast("string"), block)))
    c = c.withColumn("symbol", F.concat_ws(".", "c_mktsegment", (F.col("c_custkey") % 50).cast("string")))
    last = F.max("day")
    return c.groupBy("cik", "symbol", (F.year("day") % 3).alias("_y")).agg(
        F.min("day").alias("valid_from"), F.when(last < F.lit("2000-06-01").cast("date"), last).alias("valid_to")).drop("_y")


PATTERN_SQL = f"""s AS ({LINES_SQL}),
    n AS (SELECT cik, count(DISTINCT symbol) AS n_symbols FROM s WHERE cik IS NOT NULL GROUP BY 1),
    p AS (SELECT DISTINCT a.cik, a.symbol AS x, b.symbol AS y FROM s a JOIN s b ON a.cik = b.cik AND a.symbol < b.symbol
      AND a.valid_from <= coalesce(b.valid_to, DATE '9999-12-31') AND b.valid_from <= coalesce(a.valid_to, DATE '9999-12-31')),
    pat AS (SELECT n.cik, n.n_symbols, CASE WHEN n_symbols = 1 THEN 'single' WHEN count(p.x) = 0 THEN 'succession'
      WHEN count(p.x) * 2 = n_symbols * (n_symbols - 1) THEN 'concurrent' ELSE 'mixed' END AS pattern
      FROM n LEFT JOIN p ON p.cik = n.cik GROUP BY 1, 2)"""


@case("classify_lines", f"WITH {PATTERN_SQL} SELECT cik, n_symbols, pattern FROM pat")
def classify_lines(spark, sf):
    return L.classify_lines(stints(spark, sf))


@case("resolve_entities", f"""
    WITH {PATTERN_SQL},
    latest AS (SELECT cik, symbol AS latest FROM (SELECT cik, symbol, row_number() OVER (PARTITION BY cik ORDER BY valid_from DESC, symbol DESC) AS r FROM s WHERE cik IS NOT NULL) WHERE r = 1),
    kept AS (SELECT s.*, pat.pattern, CASE WHEN pat.pattern = 'succession' THEN latest ELSE symbol END AS asset_symbol FROM s JOIN pat ON pat.cik = s.cik JOIN latest ON latest.cik = s.cik),
    own AS (SELECT asset_symbol, count(DISTINCT cik) AS n, min(cik) AS owner, min(pattern) AS op FROM kept GROUP BY 1),
    loose AS (SELECT CASE WHEN own.n = 1 THEN owner END AS cik, s.symbol, valid_from, valid_to, CASE WHEN own.n = 1 THEN op ELSE 'symbol' END AS pattern, s.symbol AS asset_symbol
      FROM s LEFT JOIN own ON own.asset_symbol = s.symbol WHERE s.cik IS NULL),
    al AS (SELECT cik, pattern, asset_symbol, valid_from, valid_to FROM kept UNION ALL SELECT cik, pattern, asset_symbol, valid_from, valid_to FROM loose),
    g AS (SELECT cik, pattern, asset_symbol, count(*) AS n_stints, min(valid_from) AS first_from, max(valid_to) AS last_to, count(*) - count(valid_to) AS open_stints FROM al GROUP BY 1, 2, 3)
    SELECT g.*, count(*) OVER (PARTITION BY asset_symbol) AS claims FROM g""")
def resolve_entities(spark, sf):
    return L.resolve_entities(stints(spark, sf))


@case("link_entity", """
    WITH a AS (SELECT s_name AS asset, 'Customer#' || lpad(CAST(s_suppkey * 7 AS STRING), 9, '0') AS sym, 'N' || s_nationkey || '-' || (s_suppkey % 4) AS ck FROM supplier),
      u AS (SELECT ck, min(asset) AS asset FROM a GROUP BY 1 HAVING count(*) = 1)
    SELECT c_custkey, coalesce(a.asset, u.asset) AS asset, CASE WHEN a.asset IS NOT NULL THEN 'symbol' WHEN u.asset IS NOT NULL THEN 'cik' ELSE 'none' END AS how
    FROM customer LEFT JOIN a ON a.sym = c_name LEFT JOIN u ON u.ck = 'N' || c_nationkey || '-' || (c_custkey % 4)""")
def link_entity(spark, sf):
    text = lambda c: F.col(c).cast("string")
    a = table(spark, sf, "supplier").select(
        F.col("s_name").alias("asset"), F.concat(F.lit("Customer#"), F.lpad((F.col("s_suppkey") * 7).cast("string"), 9, "0")).alias("asset_symbol"),
        F.concat(F.lit("N"), text("s_nationkey"), F.lit("-"), (F.col("s_suppkey") % 4).cast("string")).alias("asset_cik"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("symbol"),
                                            F.concat(F.lit("N"), text("c_nationkey"), F.lit("-"), (F.col("c_custkey") % 4).cast("string")).alias("cik"))
    return L.link_entity(c, "symbol", "cik", a).select("c_custkey", "asset", "how")


@case("link_by_cohort", """
    WITH r AS (SELECT l_orderkey, l_partkey, l_quantity, l_suppkey, CASE WHEN l_returnflag = 'A' THEN CAST(l_suppkey % 3 AS BIGINT) END AS asset FROM lineitem),
      o AS (SELECT l_partkey, min(asset) AS one FROM r WHERE asset IS NOT NULL GROUP BY 1 HAVING min(asset) = max(asset))
    SELECT l_orderkey, r.l_partkey, l_quantity, coalesce(asset, one) AS asset, CASE WHEN asset IS NOT NULL THEN 'own' WHEN one IS NOT NULL THEN 'cohort' ELSE 'none' END AS cohort_how
    FROM r LEFT JOIN o ON o.l_partkey = r.l_partkey""")
def link_by_cohort(spark, sf):
    r = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", F.when(F.col("l_returnflag") == "A", F.col("l_suppkey") % 3).alias("asset"))
    return L.link_by_cohort(r, "l_partkey", "asset").select("l_orderkey", "l_partkey", "l_quantity", "asset", "cohort_how")


@case("unambiguous_map", """
    WITH k AS (SELECT p_name AS key, p_brand FROM part UNION ALL SELECT p_type || p_size, p_brand FROM part)
    SELECT key, min(p_brand) AS p_brand FROM k WHERE key <> '' GROUP BY 1 HAVING count(DISTINCT p_brand) = 1""")
def unambiguous_map(spark, sf):
    p = table(spark, sf, "part").select("p_name", F.concat("p_type", F.col("p_size").cast("string")).alias("alt"), "p_brand")
    return L.unambiguous_map(p, ["p_name", "alt"], "p_brand")


@case("id_to_entity", """
    WITH t AS (SELECT o_custkey AS ident, min(o_orderpriority) AS ticker, count(DISTINCT o_orderpriority) AS n FROM orders WHERE o_totalprice > 400000 GROUP BY 1)
    SELECT c_custkey AS ident, CASE WHEN n = 1 THEN ticker END AS ticker, n AS n_tickers, CASE WHEN n = 1 THEN 'A' || substr(ticker, 1, 1) END AS asset FROM customer LEFT JOIN t ON t.ident = c_custkey""")
def id_to_entity(spark, sf):
    t = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("ident"), F.col("o_orderpriority").alias("ticker"))
    a = t.select("ticker", F.concat(F.lit("A"), F.substring("ticker", 1, 1)).alias("asset")).distinct()
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("ident"))
    return L.id_to_entity(c, "ident", t, "ticker", a, "asset").select("ident", "ticker", "n_tickers", "asset")


@case("merge_catalogues", """
    WITH a AS (SELECT p_partkey AS k, p_name AS name, NULL AS kind FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT p_partkey AS k, p_brand AS name, p_type AS kind FROM part WHERE p_partkey % 2 = 0)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.name, b.name) AS name, b.kind FROM a FULL JOIN b ON a.k = b.k""")
def merge_catalogues(spark, sf):
    p = table(spark, sf, "part")
    a = p.filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))
    b = p.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("name"), F.col("p_type").alias("kind"))
    return L.merge_catalogues(a, b, "k")


@case("rollup_sector", """
    SELECT s_suppkey, s_nationkey, r_name AS rolled_sector, n_name AS industry, r_name <> (CASE WHEN s_suppkey % 2 = 0 THEN 'ASIA' ELSE 'EUROPE' END) AS sector_mismatch
    FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
def rollup_sector(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    m = n.select(F.col("n_nationkey").alias("sub_industry"), F.col("n_name").alias("industry"), F.col("r_name").alias("sector"))
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 2 == 0, "ASIA").otherwise("EUROPE").alias("stated"))
    return L.rollup_sector(s, m, "s_nationkey", "stated").select("s_suppkey", "s_nationkey", "rolled_sector", "industry", "sector_mismatch")


@case("with_sector", """
    SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN p_brand = 'Brand#1' THEN 'fund' WHEN p_size > 5 THEN upper(substr(p_type, 1, 3)) ELSE 'unclassified' END AS sector
    FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS asset FROM lineitem) l LEFT JOIN part ON p_partkey = asset""")
def with_sector(spark, sf):
    p = table(spark, sf, "part")
    assets = p.select(F.col("p_partkey").alias("asset"), F.when(F.col("p_size") > 5, F.col("p_type")).alias("industry"), (F.col("p_brand") == "Brand#1").alias("is_fund"))
    industries = p.select(F.col("p_type").alias("industry"), F.upper(F.substring("p_type", 1, 3)).alias("sector")).distinct()
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("asset"))
    return L.with_sector(l, "asset", assets, industries).select("l_orderkey", "l_linenumber", "l_quantity", "sector")


# --- referential integrity ---


@case("assert_fk", """
    SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN o_orderkey IS NULL THEN 'orphan' ELSE 'disagrees: status' END AS violation
    FROM (SELECT *, CASE WHEN l_returnflag = 'N' THEN 'O' ELSE 'F' END AS status FROM lineitem) l LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 10 <> 3) o ON o_orderkey = l_orderkey
    WHERE o_orderkey IS NULL OR status <> o_orderstatus""")
def assert_fk(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.when(F.col("l_returnflag") == "N", "O").otherwise("F").alias("status"))
    o = table(spark, sf, "orders").filter("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status"))
    return I.assert_fk(l, o, ["l_orderkey"], ["status"]).drop("status")


@case("match_one", "SELECT o_orderkey, count(l_orderkey) AS matches FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 1 GROUP BY 1 HAVING count(l_orderkey) <> 1")
def match_one(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    l = table(spark, sf, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return I.match_one(o, l, ["o_orderkey"])


@case("anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def anti(spark, sf):
    return I.anti(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@case("existing", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def existing(spark, sf):
    return I.existing(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@case("assert_subset", """
    WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '5-LOW')
    SELECT k, 'right' AS missing_in FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'left' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def assert_subset(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderpriority")
    return I.assert_subset(o.filter("o_orderpriority = '1-URGENT'"), o.filter("o_orderpriority = '5-LOW'"), ["k"])


@case("array_fk", """
    SELECT user_id, p_partkey FROM (SELECT user_id, unnest([(event_id * 3) % 4000, (event_id * 3 + 1) % 4000, (event_id * 3 + 2) % 4000]) AS p_partkey
      FROM events WHERE event_type = 'purchase') WHERE p_partkey NOT IN (SELECT p_partkey FROM part)""")
def array_fk(spark, sf):
    e = table(spark, sf, "events").filter("event_type = 'purchase'")
    refs = F.array(*[F.struct(((F.col("event_id") * 3 + i) % 4000).alias("p_partkey")) for i in range(3)])
    return I.array_fk(e.select("user_id", refs.alias("tests")), "tests", table(spark, sf, "part").select("p_partkey"), ["p_partkey"])


@case("ambiguous_keys", "SELECT l_orderkey, l_linenumber, count(DISTINCT l_returnflag) AS n_values FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) > 1")
def ambiguous_keys(spark, sf):
    return I.ambiguous_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_returnflag")


@case("match_fills", """
    WITH a AS (SELECT o_orderkey AS k, o_custkey % 5 AS buyer FROM orders WHERE o_orderkey % 7 <> 1)
    SELECT l_orderkey AS k, l_suppkey % 5 AS buyer, l_linenumber, CASE WHEN a.k IS NULL THEN 'orphan' ELSE 'disagrees: buyer' END AS violation FROM lineitem LEFT JOIN a ON a.k = l_orderkey
    WHERE a.k IS NULL OR a.buyer <> l_suppkey % 5""")
def match_fills(spark, sf):
    a = table(spark, sf, "orders").filter("o_orderkey % 7 <> 1").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 5).alias("buyer"))
    f = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") % 5).alias("buyer"), "l_linenumber")
    return I.match_fills(f, a, ["k"], "buyer")


@case("count_agreement", """
    SELECT coalesce(c_custkey, o_custkey) AS k, coalesce(n, 0) AS counted, coalesce(stated, 0) AS stated FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) FULL JOIN (SELECT c_custkey, c_custkey % 20 AS stated FROM customer) ON c_custkey = o_custkey
    WHERE coalesce(n, 0) <> coalesce(stated, 0)""")
def count_agreement(spark, sf):
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 20).alias("stated"))
    return I.count_agreement(table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), t, ["k"], "stated")


@case("dup_keys", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, copies FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies > 1""")
def dup_keys(spark, sf):
    return I.dup_keys(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"])


@case("single_valued", """
    SELECT 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) AS n_values, count(DISTINCT o_orderstatus) = 1 AS ok FROM orders
    UNION ALL SELECT 'kind', count(DISTINCT 'x'), true FROM orders""")
def single_valued(spark, sf):
    return I.single_valued(table(spark, sf, "orders").withColumn("kind", F.lit("x")), ["o_orderstatus", "kind"])


@case("set_diff", """
    WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), b AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)
    SELECT day, 'left' AS only_in FROM a WHERE day NOT IN (SELECT day FROM b) UNION ALL SELECT day, 'right' FROM b WHERE day NOT IN (SELECT day FROM a)""")
def set_diff(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return I.set_diff(a, table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")), ["day"])


@case("set_equal", """
    WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier)
    SELECT (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS only_left, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS only_right,
      (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) = 0 AND (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) = 0 AS equal""")
def set_equal(spark, sf):
    return I.set_equal(table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")), ["k"])


@case("bag_diff", """
    WITH a AS (SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R')
    SELECT coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right
    FROM (SELECT l_suppkey, l_linenumber, count(*) AS n FROM a GROUP BY 1, 2) a FULL JOIN (SELECT l_suppkey, l_linenumber, count(*) AS n FROM b GROUP BY 1, 2) b
      ON a.l_suppkey = b.l_suppkey AND a.l_linenumber = b.l_linenumber WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def bag_diff(spark, sf):
    l = table(spark, sf, "lineitem")
    return I.bag_diff(l.filter("l_returnflag = 'A'"), l.filter("l_returnflag = 'R'"), ["l_suppkey", "l_linenumber"])


@case("dup_targets", "SELECT p_name, count(DISTINCT p_brand) AS n_values FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def dup_targets(spark, sf):
    return I.dup_targets(table(spark, sf, "part"), "p_name", "p_brand")


@case("compare_runs", """
    WITH n AS (SELECT o_orderpriority AS arm, CAST(o_orderdate AS DATE) AS day, max(CAST(o_totalprice AS DECIMAL(18,2))) AS nav FROM orders GROUP BY 1, 2)
    SELECT a.day, a.nav AS nav_with, b.nav AS nav_without, CAST(CAST(a.nav AS DOUBLE) / CAST(b.nav AS DOUBLE) AS DECIMAL(18,6)) AS ratio FROM n a JOIN n b ON a.day = b.day WHERE a.arm = '1-URGENT' AND b.arm = '5-LOW'""")
def compare_runs(spark, sf):
    n = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("arm"), F.col("o_orderdate").cast("date").alias("day")).agg(F.max(F.col("o_totalprice").cast("decimal(18,2)")).alias("nav"))
    out = I.compare_runs(n.filter("arm = '1-URGENT'"), n.filter("arm = '5-LOW'"), ["day"], "nav", ("with", "without"))
    return out.withColumn("ratio", (F.col("nav_with").cast("double") / F.col("nav_without").cast("double")).cast("decimal(18,6)"))


@case("describe_diff", """
    WITH a AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS k, a.v AS left_value, b.v AS right_value FROM a FULL JOIN b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v""")
def describe_diff(spark, sf):
    o = table(spark, sf, "orders").withColumn("k", F.col("o_custkey"))
    n = lambda s: o.filter(F.col("o_orderstatus") == s).groupBy("k").agg(F.count(F.lit(1)).alias("v"))
    return I.describe_diff(n("F"), n("O"), ["k"], "v")
