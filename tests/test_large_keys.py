"""Queries against their SQL on keys larger than the given tables have, and rules those keys bring out."""

import datetime

import duckdb
import pytest

from pitframe.catalog import load
from pitframe.operators import linking as L
from pitframe.operators import shapes as S
from pitframe.operators.quads import QUAD_DDL
from pitframe.plans import delivery as D
from pitframe.plans import entities as E
from pitframe.session import spool

QUERIES, SQL = load()
D_ = datetime.date.fromisoformat


@pytest.fixture(scope="module")
def large(tmp_path_factory):
    """Customers and orders of the smallest tables under keys of seven digits and more."""
    root, con = tmp_path_factory.mktemp("large"), duckdb.connect()
    sf = "/root/testdata/sf0.001"
    changed = {"customer": "c_custkey + 123456 AS c_custkey", "orders": "o_orderkey + 7654321 AS o_orderkey, o_custkey + 123456 AS o_custkey", "lineitem": "l_orderkey + 7654321 AS l_orderkey"}
    for t in ("customer", "orders", "lineitem", "supplier", "part", "nation", "region", "events", "documents"):
        keys = f"* REPLACE ({changed[t]})" if t in changed else "*"
        con.execute(f"COPY (SELECT {keys} FROM '{sf}/{t}.parquet') TO '{root}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return str(root), con


def same(spark, large, name):
    root, con = large
    df, rel = QUERIES[name](spark, root), con.sql(SQL[name])
    order = list(rel.columns)
    assert sorted(df.columns) == sorted(order)
    text = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    got, want = text(df.select(*order).collect()), text(rel.fetchall())
    assert got == want and want


def test_symbols_of_seven_letters_are_no_tickers(spark, large):
    same(spark, large, "scan_stints")


def test_stops_of_large_orders_keep_their_asset(spark, large):
    same(spark, large, "stop_problems")


def test_three_symbols_one_in_two_pieces_are_mixed(spark):
    data = [("A", "2010-01-01", "2010-02-01"), ("A", "2012-01-01", "2012-02-01"), ("B", "2010-06-01", "2010-07-01"), ("C", "2010-06-15", "2012-01-15")]
    s = spark.createDataFrame([("1", x, D_(f), D_(t)) for x, f, t in data], "cik string, symbol string, valid_from date, valid_to date")
    assert [r.pattern for r in L.classify_lines(s).collect()] == ["mixed"]
    assert {r.pattern for r in L.resolve_entities(s).collect()} == {"mixed"}


def test_a_class_of_two_mappings_requires_what_both_require():
    rules = D.shape_rules([(E.CONFIGURED, None), (E.EFFECTIVE, None)])
    least = {c.path for c in rules if c.kind == "minCount"}
    assert least == {"weightMetricName", "weightValue"} and len(rules) == len(set(rules))


def test_selection_is_loaded(spark, large):
    same(spark, large, "load_selection")


def test_shapes_of_many_properties_find_every_kind(spark):
    """More keys than one long holds; minimum, maximum, wanted value, datatype; a clean subject and an unknown class."""
    names = [f"p{i:03d}" for i in range(150)]
    rules = [S.Constraint("Shape", "C", n, "minCount", "1") for n in names] + [S.Constraint("Shape", "C", n, "maxCount", "1") for n in names]
    rules += [S.Constraint("Shape", "C", "p000", "hasValue", "v"), S.Constraint("Shape", "C", "p001", "datatype", "xsd:string"), S.Constraint("Two", "T", "p002", "minCount", "2")]
    quad = lambda s, p, o, t="xsd:string": ("g", s, p, o, "literal", t, None)
    whole = lambda s: [("g", s, "rdf:type", "C", "iri", None, None), *[quad(s, n, "v") for n in names]]
    data = whole("good") + [q for q in whole("few") if q[2] not in ("p070", "p149")] + whole("many") + [quad("many", "p140", "w")]
    data += [quad(*q[1:3], "w") if q[2] == "p000" else quad(*q[1:4], "xsd:date") if q[2] == "p001" else q for q in whole("wrong")]
    data += [("g", "one", "rdf:type", "T", "iri", None, None), quad("one", "p002", "v"), ("g", "other", "rdf:type", "X", "iri", None, None)]
    q = spark.createDataFrame(data, QUAD_DDL)
    got = sorted((r.focus, r.path, r.constraint) for r in S.validate_shapes(q, rules, is_set=True).collect())
    assert got == [("few", "p070", "minCount"), ("few", "p149", "minCount"), ("many", "p140", "maxCount"), ("one", "p002", "minCount"), ("wrong", "p000", "hasValue"), ("wrong", "p001", "datatype")]


def test_spooled_rows_come_back(spark):
    from pyspark.sql import functions as F
    g = F.concat(F.lit("urn:graph:derived:backtest:base:P"), F.col("id") % 7)
    df = spark.range(50_000).select(g.alias("graph"), F.col("id").cast("string").alias("subject"), F.lit("rdf:type").alias("predicate"), F.lit(None).cast("string").alias("lang"))
    kept = spool(df)
    assert kept.schema.simpleString() == df.schema.simpleString()
    assert kept.exceptAll(df).isEmpty() and kept.count() == 50_000


def test_profile_sorts_no_quads(spark):
    from pitframe.catalog.entity_cases import profile

    rows = [("g", f"s{i % 7}", "p", None if i == 3 else f"o{i % 5}", "literal", None) for i in range(20)] + [("g", "s", "q", "x", "iri", "d")]
    out = profile(spark.createDataFrame(rows, "graph string, subject string, predicate string, object string, object_kind string, datatype string"))
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r["predicate"], r["datatype"], r["n"], r["n_objects"], r["lo"], r["hi"]) for r in out.collect()} == {("p", None, 20, 5, "s0 o0", "s6 o3"), ("q", "d", 1, 1, "s x", "s x")}


def test_rows_without_asset_stay_out_of_the_sector_join(spark):
    from pitframe.operators.linking import with_sector

    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "f"), (4, "x")], "id int, asset string")
    assets = spark.createDataFrame([("a", "i", False), ("f", None, True)], "asset string, industry string, is_fund boolean")
    out = with_sector(rows, "asset", assets, spark.createDataFrame([("i", "S")], "industry string, sector string"))
    assert {tuple(r) for r in out.select("id", "sector").collect()} == {(1, "S"), (2, "unclassified"), (3, "fund"), (4, "unclassified")}
    assert out.columns == ["asset", "id", "sector"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "isnotnull(asset" in plan
