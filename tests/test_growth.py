"""What keeps a task's share from growing: rows dealt by size, sums of fixed width, identities by 128 bits."""

from pyspark.sql import functions as F

from pitframe.catalog.measure_cases import concentration
from pitframe.llm import simhash
from pitframe.operators import gate as G
from pitframe.operators import quads as Q
from pitframe.operators import reconcile as R
from pitframe.operators import shapes as S
from pitframe.plans import projections as P
from pitframe.session import tasks_for

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def quads(spark, *rows):
    return spark.createDataFrame(rows, Q.QUAD_DDL)


def test_tasks_follow_the_size_of_the_tables(spark, tmp_path):
    spark.range(2_500_000).select(F.xxhash64("id").alias("x")).coalesce(1).write.parquet(f"{tmp_path}/t")
    large = spark.read.parquet(f"{tmp_path}/t")
    assert tasks_for(large) > tasks_for(spark.createDataFrame([(1,)], "x int")) == 4
    assert tasks_for(large.unionByName(large)) >= 2 * tasks_for(large) - 1


def test_stored_facts_are_summed_in_fixed_width(spark):
    schema = G.GateSchema(leaf_classes=("Veto",))
    held = quads(spark, *[("g", "V_1", p, o, "literal", None, None) for p, o in [("rdf:type", "Veto"), ("raisedOn", "2024-01-01"), ("raisedOn", "x"), ("lastSeenOn", "2024-02-01")]])
    state = G.stored_state(held.select("subject"), held, schema)
    assert "SortAggregate" not in plan(state)
    row = state.first()
    assert row.held and row.openings_clearedOn and row.bad_raisedOn and not row.given_clearedOn and str(row.last_lastSeenOn) == "2024-02-01"


def test_pairs_and_concentration_are_dealt_by_size(spark):
    q = quads(spark, ("g", "O", "rdf:type", "Order", "iri", None, None), ("g", "O", "a", "2", "literal", None, None), ("g", "O", "b", "1", "literal", None, None))
    out = S.validate_shapes(q, [S.Constraint("P", "Order", "a", "lessThan", "b"), S.Constraint("P", "Order", "a", "equals", "b")])
    assert "REPARTITION_BY_NUM" in plan(out)
    assert {(r["constraint"], r["value"]) for r in out.collect()} == {("lessThan", "2"), ("equals", "2"), ("equals", "1")}
    assert "REPARTITION_BY_NUM" in plan(concentration(spark, SF))


def test_problems_of_filings_hold_no_row_and_keep_every_row(spark):
    f = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B"), (None, "A")], "filing_id long, ticker string")
    m = spark.createDataFrame([(1, "valuation"), (3, "x"), (3, "x"), (None, "valuation")], "filing_id long, metric_group string")
    a = spark.range(2500).select(F.lit(7).cast("long").alias("filing_id")).unionByName(spark.createDataFrame([(None,)], "filing_id long"))
    out = P.fundamentals_problems(f, m, a, spark.createDataFrame([("A",), ("A",), (None,)], "ticker string"))
    assert "LeftAnti" not in plan(out)
    got = {(r["filing_id"], r["problem"]): r["n"] for r in out.groupBy("filing_id", "problem").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, "valuation of a masked asset"): 2, (2, "no metrics"): 1, (None, "no metrics"): 1, (3, "metric of no filing"): 2, (None, "metric of no filing"): 1,
                   (7, "assessment of no filing"): 2500, (None, "assessment of no filing"): 1}


def test_graphs_are_compared_by_bits(spark):
    a = quads(spark, ("g", "s", "p", "o", "literal", None, "x"), ("g", "s", "p", "o", "literal", None, "x"), ("g", "s", "rdf:type", "C", "iri", None, None))
    b = quads(spark, ("g", "s", "p", "o", "literal", "x", None), ("g", "s", "rdf:type", "C", "iri", None, None))
    assert {tuple(r) for r in Q.diff_sizes(a, b).collect()} == {("g", "left", 1), ("g", "right", 1)}
    out = {(r["check"], r["key"]): (r["expected"], r["actual"], r["status"]) for r in R.verify_graph(a, b, ["p"]).collect()}
    assert out["triples", "g"] == ("2", "3", "differs") and out["class", "C"] == ("1", "1", "pass") and out["undated", "g"] == ("1", "1", "pass")
    assert [tuple(r) for r in Q.property_frequency(a, ["C"]).collect()] == [("C", "p", 2)]


def test_texts_of_kept_documents_move_once(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "x y z"), (None, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = simhash.one_of_each(docs)
        assert plan(kept).count("Exchange hashpartitioning") == 2  # the texts, and the keys they meet
        assert sorted(map(tuple, kept.collect()), key=str) == [(1, "a b c d"), (None, "x y z")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
