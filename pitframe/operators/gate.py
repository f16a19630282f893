"""Lifecycle rules of an append-only graph store, checked set-wise for many graphs at once.

``batch`` and ``stored`` are quad tables. Each check returns (graph, check, reason) rows; ``graph``
is a column, so a whole delivery is planned by one job and refused or written as one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.operators.hierarchy import cycles
from pitframe.operators.quads import TYPE, valid_graph
from pitframe.session import cut_lineage, small_side, spool, spread, tasks_for
from pitframe.sources.catalogue import Catalogue

IRI = r"^[^\x00-\x20<>\"{}|^`\\]+$"
DAY = r"^\d{4}-\d{2}-\d{2}$"


@dataclass(frozen=True)
class Closable:
    """What a closing property closes."""

    classes: tuple[str, ...]
    opened: str
    last_seen: str | None = None
    inclusive: tuple[str, ...] = ()


@dataclass(frozen=True)
class Appendable:
    """What a sighting property is appended to."""

    classes: tuple[str, ...]
    opened: str
    ended: str


@dataclass(frozen=True)
class GateSchema:
    """Closed lists of the ontology the gate needs; schema-sized."""

    leaf_classes: tuple[str, ...]
    relations: tuple[str, ...] = ()
    # Closing, sighting, flag and restatement properties.
    closable: Mapping[str, Closable] = field(default_factory=lambda: {
        "validTo": Closable(
            ("AttractivenessWeightScheme", "PortfolioPosition", "RuleDefinition", "TickerHistory", "UniverseMembership"),
            "validFrom", None, ("TickerHistory", "UniverseMembership")),
        "clearedOn": Closable(("Veto",), "raisedOn", "lastSeenOn"),
    })
    appendable: Mapping[str, Appendable] = field(default_factory=lambda: {
        "lastSeenOn": Appendable(("Veto",), "raisedOn", "clearedOn")})
    flag: str = "pricesNotPublished"
    superseded_by: str = "supersededBy"
    section: str = "SECFilingSection"
    item_label: str = "itemLabel"
    per_run_marker: str = "cycleDate"

    @property
    def dated(self) -> tuple[str, ...]:
        return (*self.closable, *self.appendable)


def typed(quads: DataFrame) -> DataFrame:
    return quads.filter(F.col("predicate") == TYPE).select("graph", "subject").distinct()


def day_of(text: Column) -> Column:
    """A strict calendar date, else NULL."""
    return F.when(text.rlike(DAY), text.try_cast("date"))


@dataclass(frozen=True)
class Parts:
    """What is known of a batch made of class tables, so that no check has to look at all its quads for it.

    ``sizes`` (graph, triples); ``types``, its type quads; ``others``, its quads that aren't about the subject
    of their own row, or None; ``properties`` it may state, ``about_others`` those of ``others``.
    """

    sizes: DataFrame
    types: DataFrame
    others: DataFrame | None
    properties: frozenset[str]
    about_others: frozenset[str]


def bad_targets(batch: DataFrame) -> DataFrame:
    """Graph names that are no ingest target."""
    return _bad_names(cut_lineage(batch.select("graph").distinct()))  # or the filter would be moved below the distinct, to every quad


def _bad_names(names: DataFrame) -> DataFrame:
    return names.filter(~valid_graph(F.col("graph"))).select(
        "graph", F.lit("target").alias("check"), F.concat(F.col("graph"), F.lit(" is not an ingest target")).alias("reason"))


def unknown_types(batch: DataFrame, schema: GateSchema) -> DataFrame:
    """Types that are neither a leaf class nor a subclass of one."""
    bad = batch.filter((F.col("predicate") == TYPE) & ~F.col("object").isin(*schema.leaf_classes))
    return bad.select("graph", "object").distinct().select(
        "graph", F.lit("types").alias("check"), F.concat(F.lit("unknown type "), F.col("object")).alias("reason"))


def untyped_writes(batch: DataFrame, schema: GateSchema, declares: bool = True) -> DataFrame:
    """Triples about undeclared subjects other than relations, closings, sightings or the mask flag.

    Undeclared subjects are found first; few or none of a batch, they are sent to the triples, which then don't move.
    ``declares`` is false for a batch known to declare nothing: all its subjects are undeclared.
    """
    loose = batch
    if declares:
        none = batch.groupBy("graph", "subject").agg(F.max(F.col("predicate") == TYPE).alias("_t")).filter("NOT _t")
        none = small_side(spool(none.select(F.col("graph").alias("_g"), F.col("subject").alias("_s"))))
        loose = batch.join(none, F.col("graph").eqNullSafe(F.col("_g")) & F.col("subject").eqNullSafe(F.col("_s")), "left_semi")
    return _untyped(loose, schema)


def _untyped(loose: DataFrame, schema: GateSchema, *keep: str) -> DataFrame:
    p, iri = F.col("predicate"), F.col("subject").rlike(IRI) & ~F.col("subject").startswith("_:")
    why = (
        F.when(p.isin(*(schema.relations or ("",))), F.when(F.col("object_kind") == "literal", "a relation needs an individual"))
        .when(p == schema.flag, F.when(~(iri & F.col("datatype").eqNullSafe(F.lit("xsd:boolean"))), "the flag needs an IRI and a boolean"))
        .when(p.isin(*schema.dated), F.when(~iri, "needs the IRI of a stored record").when(
            ~(F.col("datatype").eqNullSafe(F.lit("xsd:date")) & day_of(F.col("object")).isNotNull()), "must be a date literal"))
        .otherwise("undeclared subject"))
    return loose.withColumn("_w", why).filter("_w IS NOT NULL").select(
        "graph", *keep, F.lit("untyped").alias("check"), F.concat_ws(" ", "subject", "predicate", F.lit(":"), "_w").alias("reason"))


def _untyped_of(parts: Parts, schema: GateSchema) -> DataFrame:
    """:func:`untyped_writes` of class tables: only quads about other subjects can be undeclared, and few or none of them matter."""
    if parts.others is None:
        return _untyped(parts.types.limit(0), schema)
    found = spool(_untyped(parts.others, schema, "subject"))
    if found.isEmpty():
        return found.drop("subject")
    return found.join(typed(parts.types), ["graph", "subject"], "left_anti").select("graph", "check", "reason")


def closing_values(batch: DataFrame, schema: GateSchema) -> DataFrame:
    """(graph, subject, property, several, day) of closings and sightings about undeclared subjects; lies by subject."""
    return _closing_values(batch, schema, tasks_for(batch))


def _closing_values(batch: DataFrame, schema: GateSchema, tasks: int) -> DataFrame:
    p = F.col("predicate")
    own = Window.partitionBy("subject", "graph").orderBy("predicate").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # the order that all below need
    rows = batch.filter(p.isin(TYPE, *schema.dated)).select("graph", "subject", "predicate", F.when(p != TYPE, F.col("object")).alias("object"))
    loose = spread(rows, "subject", tasks=tasks).withColumn("_t", F.max(p == TYPE).over(own)).filter(~F.col("_t") | F.col("graph").isNull() | F.col("subject").isNull()).filter(p != TYPE)
    # several: differing texts, without holding them
    return loose.groupBy("subject", "graph", "predicate").agg((F.min("object") < F.max("object")).alias("several"), F.min("object").alias("day")).select(
        "graph", "subject", p.alias("property"), F.coalesce("several", F.lit(False)).alias("several"), "day")


def stored_state(subjects: DataFrame, stored: DataFrame, schema: GateSchema) -> DataFrame:
    """One row per stored subject: the facts that decide whether it may be closed or appended to; lies by subject."""
    return _stored_state(subjects, stored, schema, tasks_for(subjects, stored))


def _stored_state(subjects: DataFrame, stored: DataFrame, schema: GateSchema, tasks: int) -> DataFrame:
    """Facts are flags of one long, days, and hashes of openings, whose least and largest differ if two texts do:
    an aggregate of fixed width, which neither sorts nor holds a text. Days are compared only where every text of the property is one.
    """
    read = {TYPE, schema.per_run_marker, *schema.dated}
    read |= {x.opened for x in (*schema.closable.values(), *schema.appendable.values())}
    p, o, day = F.col("predicate"), F.col("object"), F.col("_day")
    every = (*schema.closable.items(), *schema.appendable.items())
    opened = sorted({c.opened for _, c in every})
    lasts = sorted({c.last_seen for c in schema.closable.values() if c.last_seen} | set(schema.appendable))
    is_cls = lambda names: (p == TYPE) & o.isin(*(names or ("",)))
    flags = {"held": p == TYPE, "per_run": p == schema.per_run_marker}
    for name in sorted({*schema.dated, *opened}):  # a date that can't be read can't be compared, and isn't hidden by one that can
        flags[f"bad_{name}"] = (p == name) & o.isNotNull() & day_of(o).isNull()
    for prop in schema.dated:
        flags[f"given_{prop}"] = (p == prop) & o.isNotNull()
    for prop, c in every:
        flags[f"cls_{prop}"] = flags.get(f"cls_{prop}", F.lit(False)) | is_cls(c.classes)
        flags[f"incl_{prop}"] = flags.get(f"incl_{prop}", F.lit(False)) | is_cls(getattr(c, "inclusive", ()))
    mask = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(flags.values())])
    rows = stored.filter(p.isin(*read)).select(
        "subject", mask.alias("_flags"), F.when(p.isin(*opened, *lasts), p).alias("_dated"), F.when(p.isin(*opened), F.xxhash64(o)).alias("_text"), F.when(p.isin(*opened, *lasts), day_of(o)).alias("_day"))
    rows = spread(rows, "subject", tasks=tasks).join(spread(subjects.select("subject"), "subject", tasks=tasks), "subject", "left_semi")
    aggs, of = [F.bit_or("_flags").alias("_flags")], lambda name, c: F.when(F.col("_dated") == name, c)
    for name in opened:
        text = of(name, F.col("_text"))
        aggs += [F.min(text).alias(f"_lo_{name}"), F.max(text).alias(f"_hi_{name}"), F.min(of(name, day)).alias(f"_open_{name}")]
    aggs += [F.max(of(name, day)).alias(f"last_{name}") for name in lasts]
    out = [F.col("_flags").bitwiseAND(1 << i).cast("boolean").alias(name) for i, name in enumerate(flags)]
    for prop, c in every:
        out += [F.coalesce(F.col(f"_lo_{c.opened}") < F.col(f"_hi_{c.opened}"), F.lit(False)).alias(f"openings_{prop}"), F.col(f"_open_{c.opened}").alias(f"open_{prop}")]
    return rows.groupBy("subject").agg(*aggs).select("subject", *out, *[f"last_{name}" for name in lasts])


def why_not_closed(prop: str, c: Closable) -> Column:
    day, opened = day_of(F.col("day")), F.col(f"open_{prop}")
    last = F.col(f"last_{c.last_seen}") if c.last_seen else F.lit(None).cast("date")
    unread = day.isNull() | F.col(f"bad_{c.opened}")
    if c.last_seen:
        unread = unread | F.col(f"bad_{c.last_seen}")
    return (
        F.when(F.col("several"), "several-dates")
        .when(~F.coalesce("held", F.lit(False)), "not-stored")
        .when(~F.col(f"cls_{prop}") | F.col("per_run"), "wrong-record")
        .when(F.col(f"given_{prop}"), "closed-before")
        .when(F.col(f"openings_{prop}"), "several-openings")
        .when(unread, "unreadable-date")
        .when((day < opened) | ((day == opened) & ~F.col(f"incl_{prop}")), "not-after-opening")
        .when(last.isNotNull() & (day < last), "before-last-sighting"))


def why_not_added(prop: str, a: Appendable) -> Column:
    day, opened, last = day_of(F.col("day")), F.col(f"open_{prop}"), F.col(f"last_{prop}")
    ends = day_of(F.col("_ends"))
    unread = day.isNull() | F.col(f"bad_{a.opened}") | F.col(f"bad_{prop}") | (F.col("_ends").isNotNull() & ends.isNull())
    return (
        F.when(F.col("several"), "several-dates")
        .when(~F.coalesce("held", F.lit(False)), "not-stored")
        .when(~F.col(f"cls_{prop}"), "wrong-record")
        .when(F.col(f"given_{a.ended}"), "closed-before")
        .when(F.col(f"openings_{prop}"), "several-openings")
        .when(unread, "unreadable-date")
        .when(day < opened, "before-opening")
        .when(day < last, "before-last-sighting")
        .when(day == last, "sighting-stored")
        .when(day > ends, "after-its-end"))


def refused_closures(batch: DataFrame, stored: DataFrame, schema: GateSchema) -> DataFrame:
    """Closings and sightings the store's state does not allow. All of a subject meets in one task; each side moves once."""
    tasks = tasks_for(batch, stored)
    values = _closing_values(batch, schema, tasks)
    state = _stored_state(batch.filter(F.col("predicate").isin(*schema.dated)), stored, schema, tasks)
    ended = sorted({a.ended for a in schema.appendable.values()})
    ends = F.min(F.when(F.col("property").isin(*ended), F.col("day"))).over(Window.partitionBy("subject", "graph"))
    rows = values.withColumn("_ends", ends).join(state, "subject", "left")
    why = None
    for prop, c in schema.closable.items():
        why = F.when(F.col("property") == prop, why_not_closed(prop, c)) if why is None else why.when(F.col("property") == prop, why_not_closed(prop, c))
    for prop, a in schema.appendable.items():
        why = why.when(F.col("property") == prop, why_not_added(prop, a))
    return rows.withColumn("_w", why).filter("_w IS NOT NULL").select(
        "graph", F.lit("closings").alias("check"), F.concat_ws(" ", "subject", "property", F.lit(":"), "day", "_w").alias("reason"))


def restatements(batch: DataFrame, schema: GateSchema) -> DataFrame:
    """(graph, old, n_targets, new) of the batch's replacement links."""
    links = batch.filter(F.col("predicate") == schema.superseded_by)
    return links.groupBy("graph", F.col("subject").alias("old")).agg(
        F.countDistinct("object").alias("n_targets"), F.min("object").alias("new"))


def _labels(quads: DataFrame, schema: GateSchema, by: Sequence[str]) -> DataFrame:
    p = F.col("predicate")
    return quads.filter(p.isin(TYPE, schema.item_label, schema.superseded_by)).groupBy(*by).agg(
        F.max(p == TYPE).alias("typed"), F.max((p == TYPE) & (F.col("object") == schema.section)).alias("section"),
        F.countDistinct(F.when(p == schema.item_label, F.col("object"))).alias("n_labels"),
        F.min(F.when(p == schema.item_label, F.col("object"))).alias("label"),
        F.min(F.when(p == schema.superseded_by, F.col("object"))).alias("superseded"))


def restatement_problems(batch: DataFrame, schema: GateSchema) -> DataFrame:
    """What the batch alone decides: one declared replacement each way, no self, no loop, same label."""
    r = restatements(batch, schema)
    info = _labels(batch, schema, ["graph", "subject"])
    new = info.select("graph", F.col("subject").alias("new"), F.col("section").alias("new_section"), F.col("label").alias("new_label"))
    old = info.select("graph", F.col("subject").alias("old"), F.col("typed").alias("old_typed"), F.col("section").alias("old_section"), F.col("label").alias("old_label"))
    rows = r.join(new, ["graph", "new"], "left").join(old, ["graph", "old"], "left")
    fine = lambda c: F.coalesce(F.col(c), F.lit(False))
    why = (
        F.when(F.col("n_targets") > 1, "several-replacements")
        .when(F.col("old") == F.col("new"), "replaces-itself")
        .when(~fine("new_section"), "undeclared-replacement")
        .when(fine("old_typed") & ~fine("old_section"), "not-a-section")
        .when(fine("old_typed") & (F.col("old_label") != F.col("new_label")), "other-label"))
    rows = rows.withColumn("_w", why)
    first = rows.filter("_w IS NOT NULL").select("graph", F.concat_ws(" ", "old", F.lit(":"), "_w").alias("reason"))
    shared = rows.filter("_w IS NULL").groupBy("graph", "new").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "graph", F.concat(F.col("new"), F.lit(": replaces-several")).alias("reason"))
    edges = r.filter("n_targets = 1 AND old <> new").select(
        F.concat_ws("\x1f", "graph", "old").alias("start"), F.concat_ws("\x1f", "graph", "new").alias("end"))
    loops = cycles(edges).select(F.split("smallest", "\x1f").alias("_p")).select(
        F.col("_p")[0].alias("graph"), F.concat(F.lit("loop: "), F.col("_p")[1]).alias("reason"))
    return first.unionByName(shared).unionByName(loops).select("graph", F.lit("restatements").alias("check"), "reason")


def refused_supersessions(batch: DataFrame, stored: DataFrame, schema: GateSchema) -> DataFrame:
    """What the store decides about the sections a batch restates without declaring them."""
    r = restatements(batch, schema).join(typed(batch).withColumnRenamed("subject", "old"), ["graph", "old"], "left_anti")
    held = _labels(stored.join(r.select(F.col("old").alias("subject")).distinct(), "subject", "left_semi"), schema, ["subject"])
    held = held.withColumnRenamed("subject", "old")
    new = _labels(batch, schema, ["graph", "subject"]).select("graph", F.col("subject").alias("new"), F.col("label").alias("new_label"))
    rows = r.join(held, "old", "left").join(new, ["graph", "new"], "left")
    why = (
        F.when(~F.coalesce("typed", F.lit(False)), "not-stored")
        .when(~F.col("section"), "not-a-section")
        .when(F.col("superseded").isNotNull(), "superseded-before")
        .when(F.col("n_labels") > 1, "several-labels")
        .when(F.col("label") != F.col("new_label"), "other-label"))
    return rows.withColumn("_w", why).filter("_w IS NOT NULL").select(
        "graph", F.lit("supersessions").alias("check"), F.concat_ws(" ", "old", F.lit(":"), "_w").alias("reason"))


def current_sections(stored: DataFrame, schema: GateSchema) -> DataFrame:
    """Sections no other section has replaced."""
    sections = stored.filter((F.col("predicate") == TYPE) & (F.col("object") == schema.section)).select("subject").distinct()
    return sections.join(stored.filter(F.col("predicate") == schema.superseded_by).select("subject"), "subject", "left_anti")


def taken_ids(batch: DataFrame, stored: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Declared individuals another stored graph already declares; an observation is never rewritten.

    ``index`` is the store's (graph, subject) of declared individuals; bucketed by subject it isn't moved.
    """
    mine = batch.filter(F.col("predicate") == TYPE).select("graph", "subject")  # hits are made distinct, few as they are
    theirs = (typed(stored) if index is None else index).select("subject", F.col("graph").alias("_g"))
    hits = mine.join(theirs, "subject").filter(F.col("graph") != F.col("_g")).select("graph", "subject").distinct()
    return hits.select("graph", F.lit("ids").alias("check"), F.concat(F.col("subject"), F.lit(": id-stored")).alias("reason"))


ORDER = ("target", "types", "untyped", "restatements", "shapes", "closings", "supersessions", "ids")


def violations(batch: DataFrame, stored: DataFrame, schema: GateSchema, shape_results: DataFrame | None = None, index: DataFrame | None = None,
               parts: Parts | None = None) -> DataFrame:
    """All problems of a batch, with the position of their check. ``parts``: what is known of a batch of class tables.

    One look at the batch tells which kinds of statements it holds; checks of kinds it lacks find nothing
    and are left out, with their reads of the store.
    """
    p = F.col("predicate")
    kinds = {"dated": p.isin(*schema.dated), "restated": p == schema.superseded_by, "typed": p == TYPE}
    if parts is None:
        said = batch.agg(*[F.coalesce(F.max(c), F.lit(False)).alias(n) for n, c in kinds.items()]).first()
        found, types = [bad_targets(batch), untyped_writes(batch, schema, said["typed"])], batch
    else:
        # closings and sightings are statements about subjects that the batch doesn't declare: no row's own
        said = {"dated": bool(parts.about_others & {*schema.dated}), "restated": schema.superseded_by in parts.properties, "typed": True}
        found, types = [_bad_names(parts.sizes.select("graph")), _untyped_of(parts, schema)], parts.types
    if said["typed"]:
        found += [unknown_types(types, schema), taken_ids(types, stored, index)]
    if said["restated"]:
        found += [restatement_problems(batch, schema), refused_supersessions(batch, stored, schema)]
    if said["dated"]:
        found.append(refused_closures(batch, stored, schema))
    if shape_results is not None:
        found.append(shape_results.select("graph", F.lit("shapes").alias("check"), F.concat_ws(" ", "shape", "focus", "path", "constraint").alias("reason")))
    rank = F.element_at(F.create_map(*[x for i, n in enumerate(ORDER) for x in (F.lit(n), F.lit(i))]), F.col("check"))
    return reduce(DataFrame.unionByName, found).withColumn("position", rank)


def plan_batch(batch: DataFrame, stored: DataFrame, schema: GateSchema, shape_results: DataFrame | None = None, catalogue: Catalogue | None = None,
               parts: Parts | None = None) -> DataFrame:
    """One row per graph: would-be-written, already-in-the-store or refused, with the deciding check.

    A stored graph is settled before the checks that read the store; the first check that finds
    anything decides. With the store's ``catalogue``, stored graphs and ids are read from it.
    """
    graphs = batch.groupBy("graph").agg(F.count(F.lit(1)).alias("triples")) if parts is None else parts.sizes
    there = (stored if catalogue is None else catalogue.graphs()).select("graph").distinct().withColumn("_there", F.lit(True))
    per_check = violations(batch, stored, schema, shape_results, None if catalogue is None else catalogue.subjects(), parts).groupBy("graph", "check", "position").agg(
        F.count(F.lit(1)).alias("problems"), F.min("reason").alias("reason"))
    first = per_check.groupBy("graph").agg(F.min(F.struct("position", "check", "problems", "reason")).alias("f"))
    batch_only = ORDER.index("shapes")
    rows = graphs.join(there, "graph", "left").join(first, "graph", "left")
    status = (F.when(F.col("f.position") <= batch_only, "refused")
              .when(F.coalesce("_there", F.lit(False)), "already-in-the-store")
              .when(F.col("f.position").isNotNull(), "refused").otherwise("would-be-written"))
    refused = F.col("status") == "refused"
    return rows.withColumn("status", status).select(
        "graph", "triples", "status", F.when(refused, F.col("f.check")).alias("check"),
        F.when(refused, F.col("f.problems")).alias("problems"), F.when(refused, F.col("f.reason")).alias("reason"))


def preflight(batch: DataFrame, stored: DataFrame, schema: GateSchema, shape_results: DataFrame | None = None, catalogue: Catalogue | None = None,
              parts: Parts | None = None) -> tuple[bool, DataFrame, DataFrame]:
    """Plan every graph before writing any: (all clear, plan, quads to write); a refusal writes nothing."""
    plan = spool(plan_batch(batch, stored, schema, shape_results, catalogue, parts))  # its few rows are sized, so that quads meet them where they lie
    clear = plan.filter("status = 'refused'").isEmpty()
    new = plan.filter("status = 'would-be-written'").select("graph")
    return clear, plan, batch.join(small_side(new), "graph", "left_semi") if clear else batch.limit(0)


def masked_prices(quads: DataFrame, mask: DataFrame, price_properties: Sequence[str], links: Sequence[str]) -> DataFrame:
    """Price properties on a masked asset, or on a node linked to one."""
    priced = quads.filter(F.col("predicate").isin(*price_properties)).select("graph", "subject", "predicate")
    m = mask.select(F.col("asset").alias("subject")).distinct()
    direct = priced.join(m, "subject", "left_semi").withColumn("via", F.lit("asset"))
    linked = quads.filter(F.col("predicate").isin(*links)).join(
        m.withColumnRenamed("subject", "object"), "object", "left_semi").select("graph", "subject").distinct()
    return direct.unionByName(priced.join(linked, ["graph", "subject"], "left_semi").withColumn("via", F.lit("link"))).distinct()
