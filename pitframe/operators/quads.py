"""Quads (graph, subject, predicate, object, object_kind, datatype, lang) and class tables.

A class table is one typed wide DataFrame per class, with ``subject`` and ``graph`` columns and one
column per property. ``melt`` and ``pivot_class`` turn one form into the other without loss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUAD_COLUMNS = ("graph", "subject", "predicate", "object", "object_kind", "datatype", "lang")
QUAD_DDL = ", ".join(f"{c} string" for c in QUAD_COLUMNS)
TYPE = "rdf:type"
# Property kind -> literal datatype.
DATATYPES = {
    "string": "xsd:string", "integer": "xsd:integer", "decimal": "xsd:decimal", "date": "xsd:date",
    "dateTime": "xsd:dateTime", "boolean": "xsd:boolean", "anyURI": "xsd:anyURI",
}
SAFE_PART = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"


@dataclass(frozen=True)
class Prop:
    """One property of a class: its source column, its kind and, for a link, its inverse."""

    name: str
    column: str
    kind: str = "string"
    inverse: str | None = None
    many: bool = False
    lang: str | None = None


@dataclass(frozen=True)
class ClassMap:
    """A class, its properties, and the columns naming the subject and the graph."""

    cls: str
    props: tuple[Prop, ...]
    subject: str = "subject"
    graph: str = "graph"
    required: tuple[str, ...] = field(default=())


def camel(name: str) -> str:
    """``cash_weight`` to ``cashWeight``."""
    head, *tail = name.split("_")
    return head + "".join(x[:1].upper() + x[1:] for x in tail)


def class_map(cls: str, spec: str) -> ClassMap:
    """Read a mapping table: ``column kind [as=property] [inverse=property] [many] [lang=xx] [!]`` per line.

    A property is named after its column in camel case unless ``as`` says otherwise; ``!`` marks a
    property every row must have.
    """
    props, required = [], []
    for line in filter(None, (x.strip() for x in spec.splitlines())):
        column, kind, *flags = line.split()
        opts = dict(f.split("=") for f in flags if "=" in f)
        name = opts.get("as", camel(column))
        props.append(Prop(name, column, kind, opts.get("inverse"), "many" in flags, opts.get("lang")))
        if "!" in flags:
            required.append(name)
    return ClassMap(cls, tuple(props), required=tuple(required))


def decimal_text(col: Column) -> Column:
    """Plain decimal text: never an exponent, no trailing zeros."""
    text = col.cast("decimal(38,18)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def literal_text(col: Column, kind: str) -> Column:
    """Lexical form of a value of the given kind."""
    if kind == "decimal":
        return decimal_text(col)
    if kind == "boolean":
        return col.cast("boolean").cast("string")
    if kind == "integer":
        return col.cast("bigint").cast("string")
    if kind == "date":
        return col.cast("date").cast("string")
    if kind == "dateTime":
        return F.date_format(col.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return col.cast("string")


def mint_id(kind: str, *parts: Column | str) -> Column:
    """Deterministic id ``Kind_part_part``; NULL if any part is missing or unsafe in an IRI."""
    cols = [F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]
    safe = reduce(lambda a, b: a & b, [c.rlike(SAFE_PART) for c in cols])
    return F.when(safe, F.concat_ws("_", F.lit(kind), *cols))


def id_collisions(df: DataFrame, ident: str) -> DataFrame:
    """Ids shared by several rows, and rows whose id could not be formed."""
    return df.groupBy(ident).agg(F.count(F.lit(1)).alias("rows")).filter(F.col(ident).isNull() | (F.col("rows") > 1))


def project(df: DataFrame, mapping: ClassMap) -> DataFrame:
    """Class table: subject, graph and one column per property, straight from the source columns."""
    return df.select(mapping.subject, mapping.graph, *[F.col(p.column).alias(p.name) for p in mapping.props])


def missing_required(table: DataFrame, mapping: ClassMap) -> DataFrame:
    """(subject, property) of every required property that is NULL in a class table."""
    gaps = F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in mapping.required])
    return table.select("subject", F.explode(gaps).alias("property")).filter("property IS NOT NULL")


def _triple(graph: Column, s: Column, p: str, o: Column, kind: str, datatype: str | None, lang: str | None) -> Column:
    return F.struct(
        graph.alias("graph"), s.alias("subject"), F.lit(p).alias("predicate"), o.alias("object"),
        F.lit(kind).alias("object_kind"), F.lit(datatype).cast("string").alias("datatype"),
        F.lit(lang).cast("string").alias("lang"))


def _value_triple(graph: Column, s: Column, p: Prop, value: Column) -> Column:
    if p.kind == "iri":
        return _triple(graph, s, p.name, value.cast("string"), "iri", None, None)
    return _triple(graph, s, p.name, literal_text(value, p.kind), "literal", None if p.lang else DATATYPES[p.kind], p.lang)


def _many_triples(graph: Column, s: Column, p: Prop) -> list[Column]:
    """Arrays of triples of a multi-valued property, and of its inverse."""
    values = F.coalesce(F.col(p.name), F.array().cast("array<string>"))
    out = [F.transform(values, lambda x: _value_triple(graph, s, p, x))]
    if p.inverse:
        out.append(F.transform(values, lambda x: _triple(graph, x, p.inverse, s, "iri", None, None)))
    return out


def melt(table: DataFrame, mapping: ClassMap, dedupe: bool = False) -> DataFrame:
    """Class table to quads in one narrow pass; an absent value is an absent triple.

    Links may write the inverse property too. ``dedupe`` gives the set semantics of a graph; it is
    the only part that shuffles, and class tables with unique subjects do not need it.
    """
    g, s = F.col("graph"), F.col("subject")
    one = [_triple(g, s, TYPE, F.lit(mapping.cls), "iri", None, None)]
    arrays = []
    for p in mapping.props:
        if p.many:
            arrays += _many_triples(g, s, p)
            continue
        one.append(_value_triple(g, s, p, F.col(p.name)))
        if p.inverse:
            one.append(_triple(g, F.col(p.name), p.inverse, F.when(F.col(p.name).isNotNull(), s), "iri", None, None))
    cells = F.concat(F.array(*one), *arrays) if arrays else F.array(*one)
    quads = table.select(F.inline(cells)).filter("object IS NOT NULL AND subject IS NOT NULL")
    return quads.distinct() if dedupe else quads


def type_quads(tables: Sequence[tuple[ClassMap, DataFrame]]) -> DataFrame:
    """The type quads of class tables."""
    return reduce(DataFrame.unionByName, [melt(t, ClassMap(m.cls, ())) for m, t in tables])


def inverse_quads(tables: Sequence[tuple[ClassMap, DataFrame]]) -> DataFrame | None:
    """The inverse links of class tables: their only quads that aren't about the row's own subject."""
    parts = []
    for m, t in tables:
        links = {p.inverse for p in m.props if p.inverse}
        if links:
            own = ClassMap(m.cls, tuple(p for p in m.props if p.inverse))
            parts.append(melt(t, own).filter(F.col("predicate").isin(*links)))
    return reduce(DataFrame.unionByName, parts) if parts else None


def table_sizes(tables: Sequence[tuple[ClassMap, DataFrame]]) -> DataFrame:
    """Triples per graph of class tables, counted by row without making a quad."""
    parts = []
    for m, t in tables:
        n = F.lit(1)
        for p in m.props:
            if p.many:
                values = F.size(F.filter(F.coalesce(F.col(p.name), F.array().cast("array<string>")), lambda x: x.isNotNull()))
                n = n + values * F.lit(2 if p.inverse else 1)
            else:
                n = n + F.when(F.col(p.name).isNotNull() if p.kind == "iri" else literal_text(F.col(p.name), p.kind).isNotNull(), 2 if p.inverse else 1).otherwise(0)
        parts.append(t.filter("subject IS NOT NULL").select("graph", n.cast("long").alias("n")).groupBy("graph").agg(F.sum("n").alias("n")))
    return reduce(DataFrame.unionByName, parts).groupBy("graph").agg(F.sum("n").alias("triples"))


def pivot_class(quads: DataFrame, cls: str, properties: Mapping[str, str], many: Sequence[str] = ()) -> DataFrame:
    """Class table from quads: one filtered scan and one aggregate for all properties.

    ``properties`` maps a property to the Spark type its text is cast to; ``many`` lists the ones
    returned as sorted arrays.
    """
    wanted = quads.filter(F.col("predicate").isin(TYPE, *properties))
    picks = []
    for name, kind in properties.items():
        value = F.when(F.col("predicate") == name, F.col("object"))
        if name in many:
            picks.append(F.array_sort(F.collect_set(value)).cast(f"array<{kind}>").alias(name))
        else:
            picks.append(F.max(value).cast(kind).alias(name))
    is_cls = F.max((F.col("predicate") == TYPE) & (F.col("object") == cls)).alias("_is")
    return wanted.groupBy("graph", "subject").agg(is_cls, *picks).filter("_is").drop("_is")


def bits(*cols: str) -> list[Column]:
    """128 bits of a row of texts as ``_h1`` and ``_h2``; a NULL differs from every text and from a NULL elsewhere."""
    one = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(n), *one).alias(f"_h{n}") for n in (1, 2)]


def diff_sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    """(graph, side, n): how many rows of :func:`graph_diff` each graph has; quads are told apart by 128 bits."""
    side = lambda df, s: df.select("graph", *bits(*QUAD_COLUMNS[1:]), F.lit(s).alias("_s"))
    sides = side(a, 1).unionByName(side(b, 2)).groupBy("graph", "_h1", "_h2").agg(F.bit_or("_s").alias("_s")).filter("_s <> 3")
    return sides.groupBy("graph", F.when(F.col("_s") == 1, "left").otherwise("right").alias("side")).agg(F.count(F.lit(1)).alias("n"))


def graph_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Quads found on one side only (set semantics), by one aggregate over the tagged union."""
    cols = list(QUAD_COLUMNS)
    tagged = a.select(*cols).withColumn("_s", F.lit(1)).unionByName(b.select(*cols).withColumn("_s", F.lit(2)))
    sides = tagged.groupBy(*cols).agg(F.bit_or("_s").alias("_s")).filter("_s <> 3")
    return sides.withColumn("side", F.when(F.col("_s") == 1, "left").otherwise("right")).drop("_s")


def graph_sizes(quads: DataFrame) -> DataFrame:
    """Triples per graph."""
    return quads.groupBy("graph").agg(F.count(F.lit(1)).alias("triples"))


def class_sizes(quads: DataFrame) -> DataFrame:
    """Individuals and triples per class."""
    types = quads.filter(F.col("predicate") == TYPE).select("graph", "subject", F.col("object").alias("cls")).distinct()
    # triples are counted per subject first, so the join carries one row per subject
    per = quads.groupBy("graph", "subject").agg(F.count(F.lit(1)).alias("n"))
    return types.join(per, ["graph", "subject"]).groupBy("cls").agg(
        F.count(F.lit(1)).alias("individuals"), F.sum("n").alias("triples"))


def property_frequency(quads: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Triples per (class, property), the type triple left out.

    A quad meets its subject's classes by 128 bits of (graph, subject). Most subjects have one quad of a
    property, so counting before the join would only hold them all; Spark splits a hot subject's rows.
    """
    named = quads.filter("graph IS NOT NULL AND subject IS NOT NULL")
    types = named.filter((F.col("predicate") == TYPE) & F.col("object").isin(*classes)).select(
        *bits("graph", "subject"), F.col("object").alias("cls")).distinct()
    rows = named.filter(F.col("predicate") != TYPE).select(*bits("graph", "subject"), "predicate")
    return rows.join(types, ["_h1", "_h2"]).groupBy("cls", "predicate").agg(F.count(F.lit(1)).alias("triples"))


def _scan(quads: DataFrame, pattern: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = ("subject", "predicate", "object", "graph")
    df, picks, seen = quads, [], {}
    for name, term in zip(names, pattern):
        if not term.startswith("?"):
            df = df.filter(F.col(name) == term)
        elif term[1:] in seen:
            df = df.filter(F.col(name) == F.col(seen[term[1:]]))
        else:
            seen[term[1:]] = name
            picks.append(F.col(name).alias(term[1:]))
    return df.select(*picks), list(seen)


def bgp(quads: DataFrame, patterns: Sequence[Sequence[str]],
        optional: Sequence[Sequence[Sequence[str]]] = (), where: Column | None = None) -> DataFrame:
    """Triple patterns joined on their shared variables, then optional groups as left joins.

    A pattern is (subject, predicate, object[, graph]); ``?x`` is a variable. A pattern that shares
    no variable with the others is refused, since it could only be a product.
    """
    def join_all(group):
        out, bound = None, []
        for pattern in group:
            part, names = _scan(quads, pattern)
            if out is None:
                out, bound = part, names
                continue
            shared = [n for n in names if n in bound]
            if not shared:
                raise ValueError(f"pattern {tuple(pattern)} shares no variable with the ones before it")
            out = out.join(part, shared)
            bound += [n for n in names if n not in bound]
        return out, bound

    out, bound = join_all(patterns)
    for group in optional:
        part, names = join_all(group)
        shared = [n for n in names if n in bound]
        if not shared:
            raise ValueError("an optional group shares no variable with the pattern")
        out = out.join(part, shared, "left")
        bound += [n for n in names if n not in bound]
    return out if where is None else out.filter(where)


# The graph-name grammar, family -> (pattern, date group to check on the calendar).
_LABEL, _SLUG, _WIN = r"[a-z][a-z0-9_]{1,31}", r"[a-z][a-z0-9_]{1,31}", r"(?:[PH][0-9]+|C[0-9]+|LIVE)"
_DAY, _QTR = r"\d{4}-\d{2}-\d{2}", r"\d{4}-Q[1-4]"
GRAPH_GRAMMAR = {
    "ingest": rf"^urn:graph:ingest:(?:SEMANTIC|VALORIZATION|TECHNICAL|SECTOR|ORCHESTRATOR):({_DAY})$",
    "ingest_fundamental": rf"^urn:graph:ingest:FUNDAMENTAL:{_QTR}$",
    "ingest_edgar": rf"^urn:graph:ingest:EDGAR:(?:({_DAY})|{_QTR})$",
    "entity_resolution": rf"^urn:graph:derived:entity-resolution:(?:({_DAY})|{_QTR})$",
    "quant": rf"^urn:graph:derived:quant:({_DAY})$",
    "backtest_selection": rf"^urn:graph:derived:backtest:selection:{_LABEL}:{_WIN}:(?:{_SLUG}|[1-9][0-9]*)$",
    "backtest_meta": rf"^urn:graph:derived:backtest:meta:{_LABEL}$",
    "backtest_aggregates": rf"^urn:graph:derived:backtest:aggregates:{_LABEL}(?::{_SLUG})?$",
    "backtest_external": rf"^urn:graph:derived:backtest:external:{_LABEL}$",
    "backtest_series": rf"^urn:graph:derived:backtest:series:{_LABEL}:{_SLUG}$",
    "backtest_agents": rf"^urn:graph:derived:backtest:agents:{_LABEL}:(?:[PH][0-9]+|C[0-9]+):(?:manager_calls|narrator|news|bull_mode)$",
    "backtest": rf"^urn:graph:derived:backtest:{_LABEL}:{_WIN}:(?:{_SLUG}|[1-9][0-9]*)$",
    "fundamentals": rf"^urn:graph:derived:fundamentals:{_LABEL}$",
    "news": rf"^urn:graph:derived:news:{_LABEL}:[12][0-9]{{3}}(?::(?:01-06|07-12))?$",
    "ticker_history": rf"^urn:graph:derived:ticker-history:{_LABEL}:({_DAY})$",
    "orchestrator": rf"^urn:graph:derived:orchestrator:{_LABEL}:[1-9][0-9]*$",
    "universe": rf"^urn:graph:universe:{_QTR}$",
    "universe_delta": rf"^urn:graph:universe:{_QTR}:delta:[1-9][0-9]*$",
}
MUTABLE_GRAPHS = ("urn:graph:portfolio:current",)
_DATED = {k for k, v in GRAPH_GRAMMAR.items() if f"({_DAY})" in v}


def graph_family(graph: Column) -> Column:
    """The family of a legal graph name, NULL for any other name or an impossible date."""
    out = F.when(graph.isin(*MUTABLE_GRAPHS), F.lit("mutable"))
    for name, pattern in GRAPH_GRAMMAR.items():
        hit = graph.rlike(pattern)
        if name in _DATED:
            text = F.regexp_extract(graph, pattern, 1)
            hit = hit & ((text == "") | F.expr("true") & text.try_cast("date").isNotNull())
        out = out.when(hit, F.lit(name))
    return out


def valid_graph(graph: Column) -> Column:
    """Whether a name is an ingest target."""
    return graph_family(graph).isNotNull()


def graph_mode(graph: Column) -> Column:
    """``append`` or ``mutable``; NULL for a name that is no target."""
    family = graph_family(graph)
    return F.when(family == "mutable", "mutable").when(family.isNotNull(), "append")


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))


def graph_name(family: str, **parts: Column) -> Column:
    """Graph IRI of a row: ``label``, ``window``, ``slug``, ``lane``, ``day``, ``year`` or ``run_day``."""
    c = {k: v.cast("string") for k, v in parts.items()}
    join = lambda *xs: F.concat_ws(":", *[F.lit(x) if isinstance(x, str) else x for x in xs])
    if family == "ingest":  # data-dated lanes go by the quarter of availability, others by run day
        return F.when(c["lane"] == "FUNDAMENTAL", join("urn:graph:ingest", c["lane"], quarter_label(parts["day"]))).otherwise(
            join("urn:graph:ingest", c["lane"], c["run_day"]))
    shapes = {
        "backtest": ("urn:graph:derived:backtest", "label", "window", "slug"),
        "backtest_selection": ("urn:graph:derived:backtest:selection", "label", "window", "slug"),
        "backtest_meta": ("urn:graph:derived:backtest:meta", "label"),
        "backtest_aggregates": ("urn:graph:derived:backtest:aggregates", "label"),
        "backtest_external": ("urn:graph:derived:backtest:external", "label"),
        "backtest_series": ("urn:graph:derived:backtest:series", "label", "slug"),
        "backtest_agents": ("urn:graph:derived:backtest:agents", "label", "window", "slug"),
        "fundamentals": ("urn:graph:derived:fundamentals", "label"),
        "news": ("urn:graph:derived:news", "label", "year"),
        "ticker_history": ("urn:graph:derived:ticker-history", "label", "day"),
        "orchestrator": ("urn:graph:derived:orchestrator", "label", "slug"),
    }
    if family == "universe":
        return join("urn:graph:universe", quarter_label(parts["day"]))
    prefix, *names = shapes[family]
    return join(prefix, *[c[n] for n in names])


def ntriple_line(subject: Column, predicate: Column, obj: Column, kind: Column, datatype: Column, lang: Column) -> Column:
    """One N-Triples line; backslash, quote and line breaks of a literal are escaped."""
    esc = obj
    for raw, out in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        esc = F.replace(esc, F.lit(raw), F.lit(out))
    quoted = F.concat(F.lit('"'), esc, F.lit('"'))
    iri = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    literal = F.when(lang.isNotNull(), F.concat(quoted, F.lit("@"), lang)).when(
        datatype.isNotNull() & (datatype != "xsd:string"), F.concat(quoted, F.lit("^^"), iri(datatype))).otherwise(quoted)
    return F.concat_ws(" ", iri(subject), iri(predicate), F.when(kind == "iri", iri(obj)).otherwise(literal), F.lit("."))


def ntriples(quads: DataFrame) -> DataFrame:
    """(graph, line) for export; distinct, unordered."""
    line = ntriple_line(*[F.col(c) for c in QUAD_COLUMNS[1:]])
    return quads.select("graph", line.alias("line")).distinct()
