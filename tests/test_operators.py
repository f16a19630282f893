"""Edge cases on small fixtures: intervals, links, boundary, gate, shapes, sinks and streams."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pitframe.functions import scalars as S
from pitframe.operators import gate as G
from pitframe.operators import linking as L
from pitframe.operators import quality as Q
from pitframe.operators import quads as QD
from pitframe.operators import shapes as SH
from pitframe.operators import temporal as T
from pitframe.plans.contracts import CONTRACTS, EXPECTATIONS, VIEW_COLUMNS
from pitframe.sources import deliveries, scans, sinks
from pitframe.streaming import jobs

D = date.fromisoformat


def rows(df, *cols):
    return {tuple(r) for r in (df.select(*cols) if cols else df).collect()}


def stints(spark, data):
    return spark.createDataFrame([(c, s, D(f), D(t) if t else None) for c, s, f, t in data], "cik string, symbol string, valid_from date, valid_to date")


def test_company_line_patterns(spark):
    s = stints(spark, [
        ("1", "FB", "2010-01-01", "2022-06-08"), ("1", "META", "2022-06-09", None),  # rename
        ("2", "GOOG", "2014-01-01", None), ("2", "GOOGL", "2004-01-01", None),  # share classes
        ("3", "A", "2010-01-01", "2012-01-01"), ("3", "B", "2011-01-01", "2013-01-01"), ("3", "C", "2014-01-01", None),  # mixed
        ("4", "D", "2010-01-01", "2010-01-01"),  # one day
        ("5", "E", "2010-01-01", "2011-01-01"), ("5", "E", "2010-06-01", "2012-01-01"), ("5", "F", "2012-01-02", None),  # overlap inside one symbol
        ("6", "G", "2010-01-01", "2010-02-01"), ("6", "H", "2010-02-01", None),  # shared day
        ("7", "I", "2010-01-01", "2010-02-01"), ("7", "I", "2012-01-01", "2012-02-01"), ("7", "J", "2010-01-15", "2010-01-20"), ("7", "K", "2012-01-15", "2012-01-20"),  # islands
        (None, "META", "2009-01-01", "2009-06-01"), (None, "ZZZ", "2009-01-01", None)])
    got = dict(rows(L.classify_lines(s), "cik", "pattern"))
    assert got == {"1": "succession", "2": "concurrent", "3": "mixed", "4": "single", "5": "succession", "6": "concurrent", "7": "mixed"}
    assets = {r.asset_symbol: r for r in L.resolve_entities(s).collect()}
    assert (assets["META"].cik, assets["META"].n_stints, assets["META"].claims) == ("1", 3, 1)
    assert assets["ZZZ"].pattern == "symbol" and "FB" not in assets


def test_link_kinds(spark):
    a = spark.createDataFrame([("X", "X", "1"), ("Y", "Y", "2"), ("Z", "Z", "2")], "asset string, asset_symbol string, asset_cik string")
    d = spark.createDataFrame([("X", None), ("OLD", "1"), ("AMB", "2"), ("ZZZ", None)], "symbol string, cik string")
    assert rows(L.link_entity(d, "symbol", "cik", a)) == {("X", None, "X", "symbol"), ("OLD", "1", "X", "cik"), ("AMB", "2", None, "none"), ("ZZZ", None, None, "none")}


def test_interval_kinds(spark):
    s = stints(spark, [("1", "A", "2020-01-01", "2020-01-31"), ("1", "B", "2020-01-31", None)])
    assert rows(T.members_at(s, "2020-01-31"), "symbol") == {("A",), ("B",)}
    assert rows(T.active_at(s, "2020-01-31", "valid_from", "valid_to"), "symbol") == {("B",)}
    with pytest.raises(ValueError):
        T.in_interval(F.lit(1), F.lit(1), F.lit(1), "right")


def test_later_partial_fact_hides_older_complete_one(spark):
    f = spark.createDataFrame([("a", 1, 1.0, 1.0), ("a", 2, 2.0, None), ("b", 1, 1.0, 1.0), ("b", 2, None, None)], "k string, t int, x double, y double")
    assert rows(T.asof_latest(f, ["k"], "t", 5, ["x", "y"]), "k", "t") == {("b", 1)}
    e = spark.createDataFrame([("a", 1), ("a", 3), ("b", 3)], "k string, at int")
    assert rows(T.asof_join(e, f, ["k"], "at", "t", ["x", "y"]), "k", "at", "t") == {("a", 1, 1), ("a", 3, None), ("b", 3, 1)}


def test_bucketed_scan_equals_plain(spark):
    f = spark.createDataFrame([("hot", i * 7 % 101) for i in range(60)] + [("b", 3)], "k string, t int").distinct()
    e = spark.createDataFrame([("hot", i) for i in range(100)] + [("b", 2), ("c", 5)], "k string, at int")
    plain = T.asof_join(e, f, ["k"], "at", "t")
    split = T.asof_join(e, f, ["k"], "at", "t", bucket=lambda c: F.floor(c / 10))
    assert rows(plain, "k", "at", "t") == rows(split, "k", "at", "t")


def test_sheet_gives_contracts_and_checks():
    assert len(CONTRACTS) == 43 and VIEW_COLUMNS["v_weight_component"] == ("cycle_run_id", "cycle_type", "cycle_date", "score_type", "weight")
    e = EXPECTATIONS["v_score_snapshot"]
    assert e.keys == (("id",),) and e.row_count_min == 1 and e.pairs[0].where == {"score_type": ["FUNDAMENTAL"]}


def test_expectations_report_all_problems():
    with pytest.raises(ValueError, match="not a pinned view"):
        Q.load_expectations({"view": "v_none"}, VIEW_COLUMNS)
    with pytest.raises(ValueError, match="not pinned"):
        Q.load_expectations({"view": "v_book", "types": {"zz": "integer"}}, VIEW_COLUMNS)


def test_boundary_quarantines_and_cascades(spark):
    rank = spark.createDataFrame([(1, 10, 1), (1, 11, 0), (2, 10, 1)], "cycle_run_id bigint, asset_id bigint, rank bigint")
    comp = spark.createDataFrame([(1, 10, "A"), (1, 11, "A"), (2, 10, "A")], "cycle_run_id bigint, asset_id bigint, score_type string")
    exps = {"v_cycle_ranking": Q.Expectation("v_cycle_ranking", keys=(("cycle_run_id", "asset_id"),), ranges=(Q.Range("rank", 1),), cap=0.5),
            "v_cycle_ranking_component": Q.Expectation("v_cycle_ranking_component", keys=(("cycle_run_id", "asset_id", "score_type"),), cap=0.5)}
    out = Q.validate({"v_cycle_ranking": rank, "v_cycle_ranking_component": comp}, exps)
    assert not out.stopped and rows(out.survivors["v_cycle_ranking_component"], "cycle_run_id", "asset_id") == {(1, 10), (2, 10)}
    taken = {r.view: r for r in out.failures.collect()}
    assert taken["v_cycle_ranking_component"].check == "cascade" and taken["v_cycle_ranking_component"].cascaded_from.startswith("v_cycle_ranking ")
    tight = {n: Q.Expectation(e.view, e.keys, ranges=e.ranges, cap=0.0) for n, e in exps.items()}
    assert Q.validate({"v_cycle_ranking": rank, "v_cycle_ranking_component": comp}, tight).stopped


def test_boundary_stops_on_aggregates_and_keeps_row_evidence(spark):
    v = spark.createDataFrame([(1, 5.0), (1, None)], "id bigint, x double")
    out = Q.validate({"v": v}, {"v": Q.Expectation("v", keys=(("id",),), null_rates=(Q.NullRate("x", 0.1),), cap=1.0)})
    assert out.stopped and rows(out.aggregates, "check") == {("null_rate",)}
    assert {r.check for r in out.failures.collect()} == {"unique"} and out.survivors["v"].count() == 2


@pytest.mark.parametrize("text,bad", [("2024-01-01T00:00:00Z", False), ("2024-01-01T00:00:00.5+00:00", False), ("2024-01-01 00:00:00Z", True), ("2024-02-30T00:00:00Z", True), (None, False)])
def test_utc_timestamp_format(spark, text, bad):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(Q.format_fails("t", "utc_timestamp").alias("b")).first().b in ((bad,) if text else (False,))


def test_severity_ladder(spark):
    df = spark.createDataFrame([(0.9, 0.9, "LEGAL", ""), (0.9, 0.9, "MARKET", ""), (0.5, 0.1, "LEGAL", "a Lawsuit"), (0.1, 0.9, "LEGAL", None), (0.9, 0.9, "LEGAL", "fraud")], "n double, s double, c string, b string")
    got = [r.v for r in df.select(S.severity(F.col("n"), F.col("s"), F.col("c"), F.col("b")).alias("v")).collect()]
    assert got == ["CRITICAL", "HIGH", "HIGH", "LOW", "CRITICAL"]


def test_exact_scores_and_decimal_text(spark):
    df = spark.createDataFrame([("33.3",), ("0",), (None,)], "x string").select(F.col("x").cast("decimal(10,4)").alias("x"))
    got = [r.t for r in df.select(QD.decimal_text(S.strength_to_risk(F.col("x"))).alias("t")).collect()]
    assert got == ["0.667", "1", None]


def quads(spark, data):
    return spark.createDataFrame([(g, s, p, o, "iri" if p == "rdf:type" else "literal", None if p == "rdf:type" else "xsd:date", None) for g, s, p, o in data], QD.QUAD_DDL)


def test_closing_rules(spark):
    schema = G.GateSchema(leaf_classes=("Veto", "UniverseMembership", "PortfolioPosition"))
    g = "urn:graph:ingest:SECTOR:2024-01-01"
    st = quads(spark, [("s", "M", "rdf:type", "UniverseMembership"), ("s", "M", "validFrom", "2024-01-05"), ("s", "P", "rdf:type", "PortfolioPosition"), ("s", "P", "validFrom", "2024-01-05"),
                       ("s", "V", "rdf:type", "Veto"), ("s", "V", "raisedOn", "2024-01-01"), ("s", "V", "lastSeenOn", "2024-01-20"), ("s", "W", "rdf:type", "Veto"), ("s", "W", "raisedOn", "2024-01-01")])
    b = quads(spark, [(g, "M", "validTo", "2024-01-05"), (g, "P", "validTo", "2024-01-05"), (g, "V", "clearedOn", "2024-01-10"), (g, "W", "clearedOn", "2024-01-10"), (g, "W", "lastSeenOn", "2024-01-11"), (g, "N", "clearedOn", "2024-01-10")])
    got = {r.reason.split(" ")[0] + "/" + r.reason.split(" ")[1]: r.reason for r in G.refused_closures(b, st, schema).collect()}
    assert set(got) == {"P/validTo", "V/clearedOn", "W/lastSeenOn", "N/clearedOn"}
    assert got["V/clearedOn"].endswith("before-last-sighting") and got["W/lastSeenOn"].endswith("after-its-end")


def test_plan_order_and_preflight(spark):
    schema = G.GateSchema(leaf_classes=("Veto",))
    ok, old, bad = (f"urn:graph:ingest:SECTOR:2024-01-0{i}" for i in (1, 2, 3))
    b = quads(spark, [(ok, "A", "rdf:type", "Veto"), (old, "B", "rdf:type", "Veto"), (bad, "C", "rdf:type", "Oops"), ("urn:other", "D", "rdf:type", "Veto")])
    st = quads(spark, [(old, "B", "rdf:type", "Veto")])
    plan = {r.graph: (r.status, r.check) for r in G.plan_batch(b, st, schema).collect()}
    assert plan == {ok: ("would-be-written", None), old: ("already-in-the-store", None), bad: ("refused", "types"), "urn:other": ("refused", "target")}
    clear, _, new = G.preflight(b, st, schema)
    assert not clear and new.count() == 0


def test_empty_values_make_no_triples(spark):
    m = QD.class_map("C", "a string\nb decimal\nlink iri inverse=back\ntags string many")
    t = QD.project(spark.createDataFrame([("s", "g", None, None, None, None), ("r", "g", "x", 1.50, "s", ["u", "v"])], "subject string, graph string, a string, b double, link string, tags array<string>"), m)
    got = rows(QD.melt(t, m), "subject", "predicate", "object")
    assert got == {("s", "rdf:type", "C"), ("r", "rdf:type", "C"), ("r", "a", "x"), ("r", "b", "1.5"), ("r", "link", "s"), ("s", "back", "r"), ("r", "tags", "u"), ("r", "tags", "v")}
    assert QD.missing_required(t, QD.class_map("C", "a string !")).count() == 1


def test_bgp_refuses_a_product(spark):
    with pytest.raises(ValueError, match="shares no variable"):
        QD.bgp(quads(spark, [("g", "a", "p", "b")]), [("?x", "p", "?y"), ("?u", "p", "?v")])


def test_shape_context_counts_for_class(spark):
    q = spark.createDataFrame([("g", "a", "rdf:type", "A", "iri", None, None), ("g", "a", "to", "x", "iri", None, None), ("g", "a", "to", "y", "iri", None, None)], QD.QUAD_DDL)
    ctx = spark.createDataFrame([("s", "x", "rdf:type", "X", "iri", None, None)], QD.QUAD_DDL)
    out = SH.validate_shapes(q, [SH.Constraint("S", "A", "to", "class", "X")], context=ctx)
    assert rows(out, "focus", "value") == {("a", "y")}


def test_append_and_replace(spark, tmp_path):
    q = quads(spark, [("urn:graph:ingest:SECTOR:2024-01-01", "A", "rdf:type", "Veto"), ("urn:graph:ingest:SECTOR:2024-01-02", "B", "rdf:type", "Veto")])
    sinks.append_graph(q.filter("subject = 'A'"), str(tmp_path / "store"))
    report = {r.graph[-2:]: r.status for r in sinks.append_graph(q, str(tmp_path / "store")).collect()}
    assert report == {"01": "already-in-the-store", "02": "written"}
    assert scans.scan_quads(spark, str(tmp_path / "store"), family="ingest").count() == 2
    live, right = str(tmp_path / "live"), QD.graph_sizes(q)
    assert sinks.replace_graphs(q, live, right, "0001").first().switched
    assert not sinks.replace_graphs(q.limit(1), live, right, "0002").first().switched
    assert sinks.current_graphs(spark, live).count() == 2


def test_split_by_year_and_half(spark):
    days = ["2020-01-01", "2020-07-01", "2021-03-01", "2022-01-01", "2022-02-01"]
    df = spark.createDataFrame([(D(d),) for d in days], "d date")
    got = {(str(r.d), r.period, r.split_error) for r in sinks.split_graphs(df, "d", 26, 26).collect()}
    assert ("2020-01-01", "2020:01-06", False) in got and ("2021-03-01", "2021", False) in got and ("2022-01-01", "2022:01-06", True) in got


def test_delivery_hashes(spark, tmp_path):
    import hashlib
    (tmp_path / "a.csv").write_text("x\n")
    (tmp_path / "b.csv").write_text("y\n")
    (tmp_path / "c.csv").write_text("z\n")
    line = lambda name, text: f"{hashlib.sha256(text.encode()).hexdigest()}  {name}"
    (tmp_path / "SHA256SUMS").write_text("\n".join([line("a.csv", "x\n"), line("b.csv", "other"), line("d.csv", "q"), line("e.csv", "")]) + "\n")
    want = {("a.csv", "ok"), ("b.csv", "changed"), ("c.csv", "unlisted"), ("d.csv", "missing"), ("e.csv", "empty")}
    assert rows(deliveries.verify_manifest(spark, str(tmp_path)), "file", "status") == want
    assert dict(rows(deliveries.file_hashes(spark, str(tmp_path))))["a.csv"] == hashlib.sha256(b"x\n").hexdigest()


def test_windows_from_file_names(spark, tmp_path):
    for n in ("base_P1.db", "base_P2.db", "base_P9.db", "other_P1.db"):
        (tmp_path / n).write_text("x")
    known = spark.createDataFrame([("P1", D("2021-01-01")), ("P2", D("2020-01-01"))], "window string, d_start date")
    found, stray = deliveries.discover_windows(deliveries.list_files(spark, str(tmp_path)), "base", known)
    assert [r.window for r in found.collect()] == ["P2", "P1"] and rows(stray, "window") == {("P9",)}


def test_csv_header_must_match(spark, tmp_path):
    from pyspark.sql import types as ST
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    schema = ST.StructType.fromDDL("a bigint, b bigint")
    with pytest.raises(Exception, match="(?i)header|schema"):
        scans.scan_csv(spark, str(tmp_path / "x.csv"), schema)[0].collect()


def test_json_document(spark, tmp_path):
    from pyspark.sql import types as ST
    (tmp_path / "d.json").write_text('{"rows": [{"k": 1}, {"k": 2}],\n "extra": 1}')
    got, extra = scans.scan_json_doc(spark, str(tmp_path / "d.json"), ST.StructType.fromDDL("rows array<struct<k:bigint>>"), "rows")
    assert rows(got, "k") == {(1,), (2,)} and rows(extra, "key") == {("extra",)}


def test_late_and_lost_over_batches(spark, tmp_path):
    each = jobs.settle_late(str(tmp_path), "ts", 3600)
    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    make = lambda data: spark.createDataFrame(data, "id bigint, ts timestamp")
    each(make([(1, at(10))]), 0)
    each(make([(2, at(9, 30)), (3, at(5)), (4, at(11))]), 1)
    each(make([(2, at(9, 30)), (3, at(5)), (4, at(11))]), 1)  # repeated
    assert dict(rows(jobs.written(spark, f"{tmp_path}/rows", "id bigint, fate string"))) == {1: "on time", 2: "late", 3: "lost", 4: "on time"}


def test_waiting_scores_are_written_once_available(spark, tmp_path):
    ddl = "ticker string, score_type string, available_at date, raw_value double, normalized_score double"
    assets = spark.createDataFrame([("A",)], "ticker string")
    runs = spark.createDataFrame([], "run_id bigint, as_of date, status string, completed_units bigint, params_json string")
    each = jobs.gate_scores(str(tmp_path), assets, runs, lambda batch: f"2024-01-1{batch}")
    each(spark.createDataFrame([("A", "TECHNICAL", D("2024-01-11"), 1.0, 1.0)], ddl), 0)
    each(spark.createDataFrame([], ddl), 1)
    assert jobs.written(spark, f"{tmp_path}/projected", "ticker string").count() == 1
    assert jobs.last_batch(spark, f"{tmp_path}/deferred", "ticker string", 9).count() == 0


def test_plans_push_down_and_stay_partial(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.lit("x").alias("wide"))
    df.write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = T.asof_latest(t, ["k"], "d", "2024-02-01").select("k", "d")._jdf.queryExecution().toString()
    assert "LessThanOrEqual(d,2024-02-01)" in plan and "wide" not in plan.split("ReadSchema")[-1]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
