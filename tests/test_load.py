"""A load reads a delivery once, counts repeated keys without moving rows, and checks no whole view twice."""

import os

from pyspark.sql import functions as F

from pitframe.catalog import delivery_cases as C
from pitframe.operators import gate as G
from pitframe.operators import quality as Q
from pitframe.operators.quads import QUAD_COLUMNS, class_map, graph_sizes, inverse_quads, melt, table_sizes, type_quads
from pitframe.plans import delivery as D
from pitframe.plans.casebook import view
from pitframe.sources import scans, sinks

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_load_reads_each_delivered_row_once(spark):
    v = C.delivered(spark, SF)
    books, seen = v["v_book"], spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    actions = v["v_guard_action"].withColumn("alert_id", F.col("alert_id") + 100_000_000)
    done = C.run_load(spark, SF, **v | {"v_book": books.mapInArrow(count, books.schema), "v_guard_action": actions})
    assert done.stopped and {r["problem"] for r in done.report.select("problem").distinct().collect()} == {"alert: none in its window"}
    assert done.report.count() == actions.count() and seen.value == books.count()


def test_repeated_keys_are_counted_by_bits_and_then_by_value(spark):
    v = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (None, "a", 4), (None, "a", 5), (2, "a", 6)], "k int, t string, x int")
    exps = {"v": Q.Expectation("v", keys=(("k", "t"), ("x",)), cap=1.0), "w": Q.Expectation("w", keys=(("x",),))}
    views = {"v": v, "w": v.select("x")}
    found = Q.repeated_keys(views, exps)
    assert {n: {i: [tuple(r) for r in df.collect()] for i, df in x.items()} for n, x in found.items()} == {"v": {0: [(1, "a", 2)]}, "w": {}}
    assert "Join" not in plan(Q.with_row_failures(views["w"], exps["w"], found["w"]))
    out = Q.validate(views, exps, {})
    assert not out.stopped and sorted(r["x"] for r in out.survivors["v"].collect()) == [3, 4, 5, 6]
    assert [(r["key"], r["check"]) for r in out.failures.collect()] == [('{"k":1,"t":"a"}', "unique")] * 2
    assert "Join" not in plan(out.survivors["w"]) and "_failures" not in plan(out.survivors["w"])


def test_a_view_linked_to_a_dropped_row_is_not_whole(spark):
    rank = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "run int, asset int")
    part = spark.createDataFrame([(1, 1), (2, 2)], "run int, asset int")
    exps = {"r": Q.Expectation("r", keys=(("run", "asset"),), cap=1.0), "p": Q.Expectation("p", cap=1.0)}
    out = Q.validate({"r": rank, "p": part}, exps, {"r": (("p", ("run", "asset")),)})
    assert [tuple(r) for r in out.survivors["p"].collect()] == [(2, 2)] == [tuple(r) for r in out.survivors["r"].collect()]


def test_a_view_reads_what_is_given(spark):
    held = view(spark, SF, "held")
    whole, given = view(spark, SF, "v_book_weight_daily"), view(spark, SF, "v_book_weight_daily", {"held": held.filter("l_suppkey = 1")})
    assert whole.columns == given.columns and given.filter("asset_id <> 1").isEmpty()
    assert given.filter("asset_id = 1").count() == whole.filter("asset_id = 1").count() > 0


def test_a_proof_without_a_difference_says_none(spark, tmp_path):
    """Every asset of a book on one day: no day has one equity, so nothing is taken out of the store."""
    for name in os.listdir(SF):
        if name != "orders.parquet":
            os.symlink(f"{SF}/{name}", tmp_path / name)
    spark.read.parquet(f"{SF}/orders.parquet").withColumn("o_orderdate", F.date_trunc("year", "o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    assert view(spark, str(tmp_path), "v_book_daily_performance").filter("n_equity = 1").isEmpty()
    assert [tuple(r) for r in C.load_verified(spark, str(tmp_path)).collect()] == [("identity", 0)]


A = class_map("A", """
    x integer !
    y decimal
    b iri as=ofB inverse=hasA
    c iri as=toC inverse=fromA many
""")
B = class_map("B", "z string")


def tables(spark, graph="urn:graph:derived:backtest:base:P1:%d"):
    a = [(f"A_{i}", graph % (i % 3), i, None if i % 2 else i / 4, None if i % 5 == 0 else f"B_{i % 4}", [f"C_{i}", None, f"C_{i + 1}"] if i % 3 else None) for i in range(1, 40)]
    a.append((None, graph % 1, 1, 1.0, "B_1", None))
    b = [(f"B_{i}", graph % g, f"z{i}") for i in range(4) for g in range(3)]
    return [(A, spark.createDataFrame(a, "subject string, graph string, x int, y double, ofB string, toC array<string>")), (B, spark.createDataFrame(b, "subject string, graph string, z string"))]


def test_tables_are_written_as_their_quads(spark, tmp_path):
    t, q = tables(spark), D.as_quads(tables(spark))
    rows = lambda df: sorted(map(str, df.select(*QUAD_COLUMNS).collect()))
    assert sorted(map(tuple, table_sizes(t).collect())) == sorted(map(tuple, graph_sizes(q).collect()))
    assert rows(type_quads(t)) == rows(q.filter("predicate = 'rdf:type'")) and rows(inverse_quads(t)) == rows(q.filter("predicate IN ('hasA', 'fromA')"))
    first = [(m, df.filter("graph LIKE '%:1'")) for m, df in t]
    sinks.append_tables(first, str(tmp_path / "s"))
    report = sinks.append_tables(t, str(tmp_path / "s"))
    assert sorted((r["graph"][-1], r["status"]) for r in report.collect()) == [("0", "written"), ("1", "already-in-the-store"), ("2", "written")]
    assert rows(scans.scan_quads(spark, str(tmp_path / "s"))) == rows(q)


def test_parts_of_a_batch_find_what_its_quads_find(spark):
    t = tables(spark, "urn:graph:%d")
    q, schema = D.as_quads(t), G.GateSchema(leaf_classes=("B",), relations=("ofB", "toC", "fromA"))
    parts = G.Parts(table_sizes(t), type_quads(t), inverse_quads(t), frozenset(["x", "y", "ofB", "toC", "hasA", "fromA", "z"]), frozenset(["hasA", "fromA"]))
    stored = melt(t[1][1].withColumn("graph", F.lit("urn:graph:ingest:SECTOR:2001-01-01")), B)
    found = lambda p: sorted(map(str, G.violations(q, stored, schema, parts=p).distinct().collect()))
    assert found(parts) == found(None) and len(found(parts)) > 6
    some = G.Parts(parts.sizes, parts.types.filter("subject <> 'B_2'"), parts.others, parts.properties, parts.about_others)
    assert any("B_2 hasA : undeclared subject" in x for x in found(some))
    plans = [sorted(map(str, G.plan_batch(q, stored, schema, parts=p).collect())) for p in (parts, None)]
    assert plans[0] == plans[1]


def test_a_load_stores_rows_and_no_quads(spark, monkeypatch, tmp_path):
    kept = []
    for module in (D, G):
        monkeypatch.setattr(module, "spool", lambda df, real=module.spool: kept.append(df.columns) or real(df))
    done = C.run_load(spark, SF, str(tmp_path / "store"))
    assert not done.stopped and len(kept) > 16 and not [c for c in kept if "predicate" in c and "check" not in c]
    assert done.report.agg(F.sum("triples")).first()[0] == done.quads.count() == scans.scan_quads(spark, str(tmp_path / "store")).count()


def test_dates_of_declared_rows_read_no_store(spark):
    veto = class_map("Veto", "raised_on date !\n cleared_on date")
    t = [(veto, spark.createDataFrame([("V_1", "urn:graph:derived:backtest:selection:base:P1:1", "2024-01-01", "2024-02-01")], "subject string, graph string, raisedOn string, clearedOn string"))]
    q, schema = D.as_quads(t), G.GateSchema(leaf_classes=("Veto",))
    parts = G.Parts(table_sizes(t), type_quads(t), inverse_quads(t), frozenset(["raisedOn", "clearedOn"]), frozenset())
    with_parts, without = (G.plan_batch(q, q.limit(0), schema, parts=p) for p in (parts, None))
    assert "last_lastSeenOn" in without._jdf.queryExecution().logical().toString() and "last_lastSeenOn" not in with_parts._jdf.queryExecution().logical().toString()
    assert with_parts.collect() == without.collect() and with_parts.first()["status"] == "would-be-written"
