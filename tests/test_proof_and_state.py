"""Catalogue plans, digests, compiled shapes, id buckets, large files and later events on small fixtures."""

import hashlib
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from pitframe.operators import gate as G
from pitframe.operators import reconcile as R
from pitframe.operators import shapes as SH
from pitframe.operators import temporal as T
from pitframe.operators.quads import QUAD_DDL, class_map, graph_diff, melt
from pitframe.plans import selection as S_
from pitframe.plans.delivery import PROOF
from pitframe.sources import deliveries, sinks
from pitframe.sources.catalogue import Catalogue
from pitframe.streaming import state as S

D = date.fromisoformat
GRAPH = "urn:graph:ingest:SECTOR:2001-01-0%d"


def quads(spark, rows):
    return spark.createDataFrame([(g, s, p, o, "iri" if p == "rdf:type" else "literal", None if p == "rdf:type" else "xsd:string", None) for g, s, p, o in rows], QUAD_DDL)


@pytest.fixture(scope="module")
def store(spark):
    return quads(spark, [(GRAPH % (i % 3 + 1), f"Veto_{i}", p, o) for i in range(30) for p, o in (("rdf:type", "Veto"), ("note", f"n{i}"))])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_catalogue_answers_without_the_data(spark, store, tmp_path):
    path = str(tmp_path / "store")
    sinks.append_graph(store.filter(F.col("graph") != GRAPH % 3), path)
    c = Catalogue(spark, path)
    assert {(r["graph"], r["triples"]) for r in c.graphs().collect()} == {(GRAPH % 1, 20), (GRAPH % 2, 20)}
    assert all("/_catalogue/" in f for f in c.graphs().inputFiles()) and c.graphs().inputFiles()
    report = {r["graph"]: r["status"] for r in sinks.append_graph(store, path).collect()}
    assert report == {GRAPH % 1: "already-in-the-store", GRAPH % 2: "already-in-the-store", GRAPH % 3: "written"}
    assert c.subjects().count() == 30 and spark.read.parquet(path).count() == 60
    again = quads(spark, [(GRAPH % 9, f"Veto_{i}", "rdf:type", "Veto") for i in (4, 77)])
    found = G.taken_ids(again, store.limit(0), c.subjects().hint("merge"))
    assert [r["reason"] for r in found.collect()] == ["Veto_4: id-stored"]
    plan = plan_of(found)
    scan = plan[plan.index("FileScan parquet"):] if "FileScan parquet" in plan else ""
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in scan
    G.plan_batch(again, store.limit(0), G.GateSchema(leaf_classes=("Veto",)), catalogue=c).collect()


def test_catalogue_is_made_again_from_the_data(spark, store, tmp_path):
    path = str(tmp_path / "old")
    store.withColumn("graph_family", F.lit("ingest")).write.partitionBy("graph_family").parquet(path)  # a store from before the catalogue
    c = Catalogue(spark, path)
    assert c.graphs().agg(F.sum("triples")).first()[0] == 60 and c.subjects().count() == 30
    c.rebuild()
    assert c.graphs().count() == 3 and c.subjects().count() == 30


def test_digests_tell_differing_graphs(spark, store):
    same = R.differing_graphs(R.quad_digests(store.repartition(5)), R.quad_digests(store)).collect()
    assert all(r["same"] for r in same) and len(same) == 3
    swapped = store.withColumn("object", F.when(F.col("object") == "n4", "n7").when(F.col("object") == "n7", "n4").otherwise(F.col("object")))  # same values, other subjects
    twice = store.unionByName(store.filter("object = 'n5'"))
    off = lambda x: {r["graph"] for r in R.differing_graphs(R.quad_digests(x), R.quad_digests(store)).collect() if not r["same"]}
    assert off(swapped) == {GRAPH % 2} and off(twice) == {GRAPH % 3}
    assert R.delivery_differences(store, store).isEmpty()
    assert {tuple(r) for r in R.delivery_differences(swapped, store).collect()} == {tuple(r) for r in graph_diff(swapped, store).collect()}
    assert R.quad_digests(store.limit(0)).count() == 0


def test_compiled_shapes_equal_the_joined_form(spark):
    r = random.Random(2)
    rows = [(GRAPH % (i % 2 + 1), f"S_{i}", "rdf:type", cls) for i in range(60) for cls in (["A"], ["B"], ["A", "B"], [])[i % 4]]
    rows += [(GRAPH % (i % 2 + 1), f"S_{i}", p, str(r.randrange(4))) for i in range(60) for p in ("x", "y", "z") for _ in range(r.randrange(4))]
    q = quads(spark, sorted(set(rows)))
    c = [SH.Constraint("AS", "A", "x", "minCount", "1"), SH.Constraint("AS", "A", "x", "maxCount", "1"), SH.Constraint("AS", "A", "y", "hasValue", "2"), SH.Constraint("AS", "A", "z", "in", None, ("1", "2")),
         SH.Constraint("BS", "B", "x", "maxCount", "2"), SH.Constraint("BS", "B", "y", "maxInclusive", "2"), SH.Constraint("BS", "B", "w", "minCount", "1"), SH.Constraint("BS", "B", "x", "datatype", "xsd:integer")]
    types = SH.type_table(q)
    cards, vals = [x for x in c if x.kind in SH.CARDINALITY], [x for x in c if x.kind in SH.VALUE_KINDS]
    want = SH.check_values(q, vals, types).unionByName(SH.check_cardinality(q, cards, types))
    for is_set in (True, False):
        got = SH.validate_shapes(q if is_set else q.unionByName(q), c, is_set=is_set)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 40
    moved = plan_of(SH.check_compiled(q, c, True))
    assert moved.count("Exchange hashpartitioning") == 1
    assert SH.validate_shapes(q.limit(0), c).count() == 0


def test_shapes_move_a_row_a_subject(spark):
    q = quads(spark, [(GRAPH % 1, f"S_{i}", p, str(i)) for i in range(200) for p in ("x", "y")] + [(GRAPH % 1, f"S_{i}", "rdf:type", "A") for i in range(200)] + [(GRAPH % 1, "S_7", "x", "again")])
    c = [SH.Constraint("AS", "A", p, kind, "1") for p in ("x", "y") for kind in ("minCount", "maxCount")] + [SH.Constraint("AS", "A", "y", "datatype", "xsd:string")]
    named = SH.suspects(q.coalesce(1), [x for x in c if x.kind == "datatype"], [x for x in c if x.kind != "datatype"])
    assert named.columns == ["_node"] and named.count() == 1
    assert "SortAggregate" not in plan_of(named) and "Window" not in plan_of(named)
    assert [(r["focus"], r["path"], r["value"]) for r in SH.validate_shapes(q, c, is_set=True).collect()] == [("S_7", "x", "2")]
    twice = q.unionByName(q.filter("subject = 'S_9'"))
    assert SH.validate_shapes(twice, c).count() == 1 and SH.validate_shapes(twice, c, is_set=True).count() == 3


def test_a_selection_is_proved_by_rows_of_fixed_width(spark):
    g, c = "urn:graph:derived:backtest:selection:base:P%d:%d", "iri"
    veto = class_map("Veto", "ticker string as=vetoTicker !\n rule_iri iri as=appliesRule !\n asset iri as=vetoOfAsset")
    cyc = class_map("SelectionCycle", "run_label string !\n window_id string !\n run integer as=backtestRunId !\n k integer as=cycleRunId !")
    v = spark.createDataFrame([(f"Veto_{i}", g % (i % 2 + 1, i % 2 + 1), f"T{i}", f"R_{i % 3}", f"A{i % 5}" if i % 4 else None) for i in range(40)], "subject string, graph string, vetoTicker string, appliesRule string, vetoOfAsset string")
    r = spark.createDataFrame([(f"Cycle_{n}", g % (n, n), "base", f"P{n}", n, n) for n in (1, 2)], "subject string, graph string, runLabel string, windowId string, backtestRunId int, cycleRunId int")
    tables = [(veto, v.unionByName(v.filter("subject = 'Veto_9'"))), (cyc, r)]  # a row comes twice: its quads count once
    sides = S_.digests(melt(v, veto))
    assert "SortAggregate" not in plan_of(sides) and "string" not in {t for _, t in sides.dtypes}
    q = melt(v, veto).unionByName(melt(r, cyc))
    moves = spark.createDataFrame([(f"urn:graph:derived:backtest:base:P{n}:{n}", s, p, o, k, None, None) for n in (1, 2) for s, p, o, k in (
        ("Book", "rdf:type", "StrategyBook", c), ("Book", "armCode", "TOPN", "literal"), ("Move", "rdf:type", "BookRebalance", c), ("Move", "cycleRunId", str(n), "literal"), ("Move", "rebalanceOfBook", "Book", c))], QUAD_DDL)
    proof = lambda x: {(row["graph"][-1], row["check"], row["key"]): (row["expected"], row["actual"], row["status"]) for row in S_.verify_selection(x.unionByName(moves), tables, "base").collect()}
    whole = proof(q.unionByName(q.filter("subject IN ('Veto_9', 'Veto_10')")))  # repeated quads are one quad
    assert {x[2] for x in whole.values()} == {"pass"} and whole["2", "individuals", "Veto"] == (20, 20, "pass") and whole["1", "links", "veto links"] == (5, 5, "pass")
    changed = q.filter("NOT (subject = 'Veto_3' AND predicate = 'rdf:type')").withColumn("object", F.when((F.col("subject") == "Veto_4") & (F.col("predicate") == "appliesRule"), "R_9").otherwise(F.col("object")))
    off = {k: x for k, x in proof(changed).items() if x[2] == "fail"}
    assert off == {("2", "individuals", "Veto"): (20, 19, "fail"), ("2", "triples", ""): (whole["2", "triples", ""][0],) + (whole["2", "triples", ""][0] - 1, "fail"), ("2", "vetoes by rule", "R_0"): (7, 6, "fail"),
                   ("1", "vetoes by rule", "R_1"): (6, 5, "fail"), ("1", "vetoes by rule", "R_9"): (0, 1, "fail")}


def test_id_filters_only_prune(spark, tmp_path):
    path = str(tmp_path / "ids")
    r = random.Random(3)
    batches = [[r.randrange(10**6) for _ in range(300)] for _ in range(4)]
    seen = set()
    for b, ids in enumerate(batches):
        df = spark.createDataFrame([(i,) for i in {*ids, *r.sample(sorted(seen), min(len(seen), 20))}] + [(None,)], "id long")
        known = {x["id"] for x in S.known_ids(df, path, "id", b, buckets=5).collect()}
        mine = {x["id"] for x in df.collect()} - {None}
        assert known == mine & seen
        S.add_ids(df.filter(F.col("id").isNotNull() & ~F.col("id").isin(*known)) if known else df, path, "id", b, buckets=5)
        seen |= mine
    asked = spark.createDataFrame([(next(iter(seen)),)], "id long")
    assert 1 <= len(S.touched_parts(asked, path, "id", 4, buckets=5)) < 20
    assert S.touched_parts(spark.createDataFrame([(-5,)], "id long"), path, "id", 4, buckets=5) == []


def test_files_beyond_a_binary_column(spark, tmp_path):
    big = tmp_path / "big.bin"
    with big.open("wb") as f:
        f.truncate(2_500_000_000)
    (tmp_path / "small.bin").write_bytes(b"abc")
    h = hashlib.sha256()
    for _ in range(2500):
        h.update(bytes(1_000_000))
    got = {r["file"]: r["actual"] for r in deliveries.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {"big.bin": h.hexdigest(), "small.bin": hashlib.sha256(b"abc").hexdigest()}
    assert {r["file"]: r["actual"] for r in deliveries.file_hashes(spark, str(tmp_path / "small.bin"), large=1).collect()} == {"small.bin": hashlib.sha256(b"abc").hexdigest()}


def test_later_summary_of_a_hot_key(spark):
    r = random.Random(4)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), r.choice([None, *range(40)])) for _ in range(400)]
    marks = [(r.choice(["hot", "hot", "c", None]), r.choice([None, *range(40)])) for _ in range(400)]
    a, b = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, k string, t int"), spark.createDataFrame(marks, "k string, at int")
    for width in (1, 7, 1000):
        got = {x["i"]: tuple(x)[3:] for x in T.later_summary(a, b, ["k"], "t", "at", lambda c: F.floor(c / width)).select("i", "k", "t", "n_later", "first_later", "last_later").collect()}
        for i, (k, t) in enumerate(rows):
            later = [m for n, m in marks if k is not None and n == k and t is not None and m is not None and m > t]
            assert got[i] == (len(later), min(later, default=None), max(later, default=None))


def test_a_batch_that_runs_again_leaves_the_same_state(spark, tmp_path):
    path = str(tmp_path / "settle")
    each = S.settle_rows(path, "k", "g", "ok")
    first = spark.createDataFrame([(1, "a", True), (2, "a", False), (3, None, True), (None, "a", True)], "k long, g string, ok boolean")
    second = spark.createDataFrame([(2, "a", True), (1, "a", True), (4, "b", True), (4, "b", False)], "k long, g string, ok boolean")
    for batch, df in ((0, first), (0, first), (1, second), (1, second), (2, second)):
        each(df, batch)
    got = {(r["batch"], r["fate"]): r["rows"] for r in spark.read.parquet(f"{path}/fates").collect()}
    assert got == {(0, "written"): 1, (0, "late"): 3, (1, "lost"): 1, (1, "stored"): 1, (1, "written"): 1, (2, "lost before"): 1, (2, "stored"): 2}


def test_differences_compare_bits_before_texts(spark):
    kinds = "graph string, subject string, predicate string, object string, object_kind string, datatype string, lang string"
    same = [("g", f"s{i}", "p", "o", "literal", None, None) for i in range(50)]
    a = spark.createDataFrame([*same, ("g", "s", "p", "o", "literal", "x", None), ("g", "s", "p", "o", "literal", None, "")], kinds)
    b = spark.createDataFrame([*same, ("g", "s", "p", "o", "literal", None, "x"), ("g", "s", "p", "o", "literal", None, None)], kinds)
    found = R.delivery_differences(a, b)
    assert sorted((r["side"], str(r["datatype"]), str(r["lang"])) for r in found.collect()) == [("left", "None", ""), ("left", "x", "None"), ("right", "None", "None"), ("right", "None", "x")]
    assert "_a" in found._jdf.queryExecution().optimizedPlan().toString()


def test_differing_subjects_are_found_by_sums(spark, monkeypatch):
    q = quads(spark, [(GRAPH % 1, f"S_{i}", p, str(i * i)) for i in range(300) for p in ("x", "y", "z")])
    other = q.withColumn("object", F.when((F.col("subject") == "S_7") & (F.col("predicate") == "y"), "no").otherwise(F.col("object"))).filter("subject <> 'S_9' OR predicate <> 'z'")
    kept = []
    monkeypatch.setattr(R, "spool", lambda df, real=R.spool: kept.append(real(df)) or kept[-1])
    assert {tuple(r) for r in R.delivery_differences(other, q).collect()} == {tuple(r) for r in graph_diff(other, q).collect()}
    assert [df.count() for df in kept] == [1, 2, 3]  # a graph, its subjects that differ, their quads of one side
    assert {t for df in kept[1:] for _, t in df.dtypes} == {"bigint"}


def test_a_graph_is_proved_whole(spark):
    rows = [("Book_1", "StrategyBook", {"runLabel": "base"}), ("W_1", "BookWeightDaily", {"holdingKey": "CASH", "weightOfBook": "Book_1"}), ("W_2", "BookWeightDaily", {"holdingKey": "T1", "holdingAsset": "A1", "weightOfBook": "Book_1"}),
            ("W_3", "BookWeightDaily", {"holdingKey": "T2", "weightOfBook": "Book_1"}), ("W_4", "BookWeightDaily", {"holdingKey": "CASH", "weightOfBook": "Book_9"}), ("X_1", "GuardAction", {"status": "APPLIED", "actionOfBook": "Book_1", "guardTicker": "T1"}),
            ("L_1", "GuardAlert", {"alertRule": "R_1", "guardLayer": "0", "alertState": "ENTER"}), ("L_2", "GuardAlert", {"alertRule": "R_1", "guardLayer": "0", "alertState": "EXIT"}), ("L_3", "GuardAlert", {"alertRule": "R_1", "guardLayer": "0", "alertState": "EXIT"}),
            *[(f"N_{d}", "BookDailyPerformance", {"armCode": "ARM", "performanceDate": f"2024-01-0{d}", "nav": f"1.{d}", "performanceOfBook": "Book_1"}) for d in (1, 2, 3)]]
    q = quads(spark, [("g", s, p, o) for s, cls, props in rows for p, o in {"rdf:type": cls, "knowledgeDate": "2024-01-01", **props}.items()])
    of = lambda x: {(r["check"], r["key"]): r["value"] for r in R.graph_profile(x, ["holdingAsset"], proof=PROOF).collect()}
    whole = of(q.repartition(3))
    want = {("unlinked BookWeightDaily", "g"): "1", ("unlinked GuardAction", "g"): "1", ("alerts by rule, layer and state", "g/R_1/0/ENTER"): "1", ("alerts by rule, layer and state", "g/R_1/0/EXIT"): "2",
            ("actions by status", "g/APPLIED"): "1", ("cash rows", "g"): "2", ("last NAV", "g/ARM"): "2024-01-03 1.300000000000000000", ("unlabelled", "g"): "1"}
    assert {k: v for k, v in whole.items() if k[0] not in ("triples", "class", "link", "undated")} == want and ("undated", "g") not in whole
    two = of(q.unionByName(quads(spark, [("g", "L_1", "alertState", "EXIT")])).filter("subject <> 'Book_1' OR predicate <> 'runLabel'").filter("subject <> 'N_3' OR predicate <> 'nav'"))
    assert two["alerts by rule, layer and state", "g/R_1/0/several values"] == "1" and two["unlabelled", "g"] == "9" and two["last NAV", "g/ARM"] == "2024-01-02 1.200000000000000000"
    bare = q.withColumn("graph", F.when(F.col("subject") != "W_1", F.col("graph")))  # a graph without a name counts too
    assert {k: v for k, v in of(bare).items() if k[0] == "class"} == {k: v for k, v in whole.items() if k[0] == "class"}
