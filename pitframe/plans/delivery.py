"""A whole delivery load: views, boundary, projection, shapes, gate, append, verification.

All windows go through one job set; the window is a column, never a loop.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.operators import gate, quality, reconcile, shapes
from pitframe.operators.quads import DATATYPES, ClassMap, id_collisions, inverse_quads, melt, missing_required, table_sizes, type_quads
from pitframe.operators.rules import rule_problems
from pitframe.plans import entities as E
from pitframe.plans import projections as P
from pitframe.plans.contracts import EXPECTATIONS
from pitframe.session import cut_lineage, spool
from pitframe.sources.catalogue import Catalogue
from pitframe.sources.sinks import append_tables

BACKTEST_VIEWS = ("v_book", "v_book_rebalance", "v_guard_alert", "v_guard_action", "v_book_weight_daily",
                  "v_book_daily_performance", "v_portfolio_period_summary", "v_backtest_test")


def class_tables(views: Mapping[str, DataFrame], rules: DataFrame, assets: DataFrame, label: str, slug: str | None = None) -> list[tuple[ClassMap, DataFrame]]:
    """The eight backtest classes of a delivery."""
    book = P.book_table(views["v_book"], label, slug)
    alert = P.alerts(views["v_guard_alert"], book, rules, assets, label, slug)
    alert_ids = P.alert_ids(views["v_guard_alert"], label, slug)
    return [
        (E.BOOK, P.books(views["v_book"], label, slug)), (E.ALERT, alert), (E.REBALANCE, P.rebalances(views["v_book_rebalance"], book)),
        (E.ACTION, P.actions(views["v_guard_action"], book, alert_ids, assets)), (E.WEIGHT, P.weights(views["v_book_weight_daily"], book, assets)),
        (E.PERFORMANCE, P.performance(views["v_book_daily_performance"], book)), (E.SUMMARY, P.summaries(views["v_portfolio_period_summary"], book)),
        (E.TEST, P.tests(views["v_backtest_test"], label, slug)),
    ]


def as_quads(tables: Sequence[tuple[ClassMap, DataFrame]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [melt(t, m) for m, t in tables])


def shape_rules(tables: Sequence[tuple[ClassMap, DataFrame]]) -> list[shapes.Constraint]:
    """Constraints every mapping implies: datatype, node kind and cardinality of each property.

    Several mappings may fill one class: a property is required of it only if all of them require it,
    and single only if all of them hold it single. What one mapping requires, :func:`class_problems` checks on its own table.
    """
    by_cls: dict[str, list[ClassMap]] = {}
    for m, _ in tables:
        by_cls.setdefault(m.cls, []).append(m)
    out = []
    for cls, maps in by_cls.items():
        shape, props = f"{cls}Shape", [p for m in maps for p in m.props]
        for name in dict.fromkeys(p.name for p in props):
            own = [p for p in props if p.name == name]
            for kind in dict.fromkeys(p.kind for p in own):
                if kind == "iri":
                    out.append(shapes.Constraint(shape, cls, name, "nodekind", "iri"))
                else:
                    out.append(shapes.Constraint(shape, cls, name, "datatype", DATATYPES[kind]))
            if all(name in m.required for m in maps):
                out.append(shapes.Constraint(shape, cls, name, "minCount", "1"))
            if not any(p.many for p in own):
                out.append(shapes.Constraint(shape, cls, name, "maxCount", "1"))
    return out


# Child views of a book and the columns that name their rows.
CHILDREN = {
    "v_book_rebalance": ("rebalance_id",), "v_guard_action": ("action_id",), "v_book_weight_daily": ("book_id", "date", "holding_key"),
    "v_book_daily_performance": ("book_id", "date"), "v_portfolio_period_summary": ("book_id", "segment"),
}


def _named(view: str, df: DataFrame, key: Sequence[str], problem: str | Column) -> DataFrame:
    why = F.lit(problem) if isinstance(problem, str) else problem
    return df.select(F.lit(view).alias("view"), F.concat_ws("/", *[F.col(c).cast("string") for c in key]).alias("key"), why.alias("problem"))


def open_rules(rules: DataFrame) -> DataFrame:
    """The version of each rule that is in force; :func:`rule_problems` reports an id open twice."""
    return rules.filter("valid_to IS NULL")


def link_problems(views: Mapping[str, DataFrame], rules: DataFrame) -> DataFrame:
    """(view, key, problem) of every row that links to nothing, or to something that disagrees with it."""
    books, alerts, actions = views["v_book"], views["v_guard_alert"], views["v_guard_action"]
    parts = [_named("rules", rule_problems(rules), ["rule_id"], F.col("problem")),
             _named("v_guard_alert", P.alert_problems(alerts, books, open_rules(rules).dropDuplicates(["rule_id"])), ["alert_id"], F.col("problem"))]
    for view, key in CHILDREN.items():
        parts.append(_named(view, P.child_problems(views[view], books, *key), key, F.concat(F.lit("book: "), F.col("violation"))))
    window = books.select("book_id", "window_id")
    lost = actions.filter("alert_id IS NOT NULL").join(window, "book_id").join(alerts.select("alert_id", "window_id"), ["alert_id", "window_id"], "left_anti")
    parts.append(_named("v_guard_action", lost, ["action_id"], "alert: none in its window"))
    parts.append(_named("v_portfolio_period_summary", P.segment_problems(views["v_portfolio_period_summary"]), ["book_id", "segment"], "segment: not of its window"))
    return reduce(DataFrame.unionByName, parts)


def class_problems(tables: Sequence[tuple[ClassMap, DataFrame]]) -> DataFrame:
    """(view, key, problem) of class tables: ids shared or missing, required properties missing."""
    parts = []
    for m, t in tables:
        parts.append(_named(m.cls, id_collisions(t, "subject"), ["subject"], F.when(F.col("subject").isNull(), "id: none").otherwise("id: shared")))
        if m.required:
            parts.append(_named(m.cls, missing_required(t, m), ["subject"], F.concat(F.lit("missing: "), F.col("property"))))
    return reduce(DataFrame.unionByName, parts)


@dataclass
class Load:
    stopped: bool
    reasons: list[str]
    quads: DataFrame | None
    plan: DataFrame | None
    report: DataFrame | None


def load(views: Mapping[str, DataFrame], rules: DataFrame, assets: DataFrame, stored: DataFrame, label: str, slug: str | None = None, path: str | None = None,
         expectations: Mapping[str, quality.Expectation] = EXPECTATIONS, spooled: bool = False) -> Load:
    """Check, project, validate and plan a delivery; write it if ``path`` is given and nothing refuses it.

    ``spooled``: the views are read from stored tables, which need no copy.
    """
    wanted = {v: expectations[v] for v in views}
    # read once; boundary, links and projection read what was stored
    views, rules = views if spooled else {v: spool(df) for v, df in views.items()}, spool(rules)
    boundary = quality.validate(views, wanted)
    if boundary.stopped:
        return Load(True, boundary.reasons, None, None, boundary.failures)
    survivors = boundary.survivors
    return load_tables(link_problems(survivors, rules), lambda: class_tables(survivors, open_rules(rules), assets, label, slug), stored, path)


def load_tables(problems: DataFrame, project: Callable[[], list[tuple[ClassMap, DataFrame]]], stored: DataFrame, path: str | None = None) -> Load:
    """Refuse on ``problems``, else project, check ids and shapes, plan, and write if ``path`` is given."""
    broken = cut_lineage(problems)
    if not broken.isEmpty():
        return Load(True, ["rows link to nothing"], None, None, broken)
    # projected once; checks, shapes, gate and write read what was stored
    tables = [(m, spool(t)) for m, t in project()]
    broken = cut_lineage(class_problems(tables))
    if not broken.isEmpty():
        return Load(True, ["ids or required properties"], None, None, broken)
    # quads are made of the stored rows where they are read: they would take several times their disk
    quads, sizes = as_quads(tables), spool(table_sizes(tables))
    results = shapes.validate_shapes(quads, shape_rules(tables), is_set=True)
    links = [x for m, _ in tables for p in m.props if p.kind == "iri" for x in (p.name, p.inverse) if x]
    schema = gate.GateSchema(leaf_classes=tuple(m.cls for m, _ in tables), relations=tuple(links))
    parts = gate.Parts(sizes, type_quads(tables), inverse_quads(tables), frozenset([p.name for m, _ in tables for p in m.props] + links),
                       frozenset(p.inverse for m, _ in tables for p in m.props if p.inverse))
    clear, plan, _ = gate.preflight(quads, stored, schema, results, Catalogue(quads.sparkSession, path) if path else None, parts)
    if not clear:
        return Load(True, ["a graph is refused"], quads, plan, results)
    report = append_tables(tables, path, sizes) if path else None
    return Load(False, [], quads, plan, report)


# What the proof of a backtest graph counts (VER-01).
PROOF = reconcile.Proof(
    unlinked=(("BookWeightDaily", "holdingKey", "holdingAsset", "CASH"), ("GuardAlert", "guardTicker", "guardAsset", None), ("GuardAction", "guardTicker", "guardAsset", None)),
    groups=(("alerts by rule, layer and state", "GuardAlert", ("alertRule", "guardLayer", "alertState")), ("actions by status", "GuardAction", ("status",))),
    valued=(("cash rows", "BookWeightDaily", "holdingKey", "CASH"),),
    last=(("last NAV", "BookDailyPerformance", "armCode", "performanceDate", "nav"),),
    labelled=("runLabel", ("StrategyBook", "BookRebalance", "GuardAction", "BookWeightDaily", "BookDailyPerformance", "PortfolioPeriodSummary", "BacktestTest"),
              ("rebalanceOfBook", "actionOfBook", "weightOfBook", "performanceOfBook", "summaryOfBook")))


def verify(stored: DataFrame, projected: DataFrame) -> DataFrame:
    """Stored against re-projected graphs: their links, and all that :data:`PROOF` counts."""
    return reconcile.verify_graph(stored, projected, ["alertRule", "actionAlert", "holdingAsset"], PROOF)
