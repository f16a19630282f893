"""Shape constraints over quads, set-based: all constraints of one kind share one scan.

A constraint is one row (shape, cls, path, kind, value, number). The list is schema-sized and fixed
by the caller, so it may be broadcast; the data never is. Every result row is
(graph, shape, focus, path, constraint, value).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.operators.hierarchy import entail
from pitframe.operators.quads import TYPE
from pitframe.session import small_side, spool, spread

RESULT = ("graph", "shape", "focus", "path", "constraint", "value")


@dataclass(frozen=True)
class Constraint:
    """``kind`` is one of the keys used below; ``value`` is text, ``values`` a closed list."""

    shape: str
    cls: str
    path: str
    kind: str
    value: str | None = None
    values: tuple[str, ...] = ()


VALUE_KINDS = ("datatype", "nodekind", "in", "pattern", "maxLength", "minInclusive", "maxInclusive")
CARDINALITY = ("minCount", "maxCount", "hasValue")
PAIRS = ("lessThan", "lessThanOrEquals", "equals")


def constraint_table(spark, constraints: Sequence[Constraint]) -> DataFrame:
    rows = [(c.shape, c.cls, c.path, c.kind, c.value, list(c.values)) for c in constraints]
    return spark.createDataFrame(rows, "shape string, cls string, path string, kind string, arg string, args array<string>")


def type_table(quads: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(graph, focus, cls) with superclass types when a closure is given."""
    types = quads.filter(F.col("predicate") == TYPE).select("graph", F.col("subject").alias("focus"), F.col("object").alias("cls"))
    return entail(types, pairs) if pairs is not None else types.distinct()


def targets(quads: DataFrame, kind: str, term: str, pairs: DataFrame | None = None) -> DataFrame:
    """Focus nodes of a shape: instances of a class, subjects of a property, or its objects."""
    if kind == "class":
        return type_table(quads, pairs).filter(F.col("cls") == term).select("graph", "focus").distinct()
    side = {"subjects_of": "subject", "objects_of": "object"}[kind]
    return quads.filter(F.col("predicate") == term).select("graph", F.col(side).alias("focus")).distinct()


def _of(constraints: Sequence[Constraint], kinds: Sequence[str]) -> list[Constraint]:
    return [c for c in constraints if c.kind in kinds]


def _out(df: DataFrame) -> DataFrame:
    return df.select(*RESULT)


def wrong_value() -> Column:
    """Whether a quad breaks the value constraint (kind, arg, args) it was joined to."""
    number, limit = F.col("object").try_cast("decimal(38,18)"), F.col("arg").try_cast("decimal(38,18)")
    return (
        F.when(F.col("kind") == "datatype", ~F.col("datatype").eqNullSafe(F.col("arg")))
        .when(F.col("kind") == "nodekind", F.col("object_kind") != F.col("arg"))
        .when(F.col("kind") == "in", ~F.array_contains("args", F.col("object")))
        .when(F.col("kind") == "pattern", ~F.expr("object rlike arg"))
        .when(F.col("kind") == "maxLength", F.length("object") > F.col("arg").try_cast("int"))
        .when(F.col("kind") == "minInclusive", number.isNull() | (number < limit))
        .when(F.col("kind") == "maxInclusive", number.isNull() | (number > limit))
    )


def check_values(quads: DataFrame, constraints: Sequence[Constraint], types: DataFrame) -> DataFrame:
    """Datatype, node kind, closed list, pattern, length and bounds: wrong values are found first,
    by constraints joined on the property, and only those are joined to their class."""
    table = F.broadcast(constraint_table(quads.sparkSession, constraints))
    hits = quads.join(table, F.col("predicate") == F.col("path")).filter(wrong_value())
    hits = hits.withColumnRenamed("subject", "focus").join(types, ["graph", "focus", "cls"], "left_semi")
    return _out(hits.select("graph", "shape", "focus", "path", F.col("kind").alias("constraint"), F.col("object").alias("value")))


def check_cardinality(quads: DataFrame, constraints: Sequence[Constraint], types: DataFrame, is_set: bool = False) -> DataFrame:
    """minCount, maxCount and hasValue: distinct values counted once per (focus, property).

    ``is_set`` says no quad is repeated; the counts then need no distinct before them.
    """
    spark = quads.sparkSession
    table = constraint_table(spark, constraints)
    paths = sorted({c.path for c in constraints})
    wanted = sorted({c.value for c in constraints if c.kind == "hasValue" and c.value is not None})
    values = quads.filter(F.col("predicate").isin(*paths)).select(
        "graph", F.col("subject").alias("focus"), F.col("predicate").alias("path"), "object", "datatype", "lang")
    values = values if is_set else values.distinct()
    held = F.collect_set(F.when(F.col("object").isin(*wanted), F.col("object"))) if wanted else F.array().cast("array<string>")
    counts = values.groupBy("graph", "focus", "path").agg(F.count(F.lit(1)).alias("n"), *([held.alias("held")] if wanted else []))
    counts = counts if wanted else counts.withColumn("held", held)
    need = types.join(F.broadcast(table), "cls")
    rows = need.join(counts, ["graph", "focus", "path"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bad = (
        F.when(F.col("kind") == "minCount", F.col("n") < F.col("arg").try_cast("int"))
        .when(F.col("kind") == "maxCount", F.col("n") > F.col("arg").try_cast("int"))
        .when(F.col("kind") == "hasValue", ~F.coalesce(F.array_contains("held", F.col("arg")), F.lit(False)))
    )
    return _out(rows.filter(bad).select("graph", "shape", "focus", "path", F.col("kind").alias("constraint"), F.col("n").cast("string").alias("value")))


NODE = "\x01"  # parts a property from a class or value in the keys below


WORD = 60  # keys whose presence one long holds


def _own_keys(cards: Sequence[Constraint]) -> Column:
    """The keys a quad counts for: its property, or its type, and each wanted value it has."""
    p, o = F.col("predicate"), F.col("object")
    keys = [F.when(p == TYPE, F.concat(F.lit(TYPE + NODE), o)).otherwise(p)]
    for path, value in sorted({(c.path, c.value) for c in cards if c.kind == "hasValue"}):
        keys.append(F.when((p == path) & (o == value), F.lit(path + NODE + value)))
    return keys[0] if len(keys) == 1 else F.explode(F.array_compact(F.array(*keys)))


def _node_bits() -> Column:
    return F.xxhash64(F.col("graph").isNull(), F.col("graph"), F.col("subject").isNull(), F.col("subject"))


def suspects(quads: DataFrame, vals: Sequence[Constraint], cards: Sequence[Constraint]) -> DataFrame:
    """The 64 bits (``_node``) of every subject that may break a constraint, and of few others.

    One aggregate of fixed width: the keys a subject has are or-ed into longs, and rows of bounded keys are
    counted, so partial rows leave a task, never a quad. A class whose needed keys aren't all there, more rows of
    bounded keys than distinct ones, and a wrong value make a suspect. Types count as bounded: two declared
    subjects that shared their bits would be suspects too.
    """
    held = lambda c: c.path + NODE + (c.value or "") if c.kind == "hasValue" else c.path
    cls_key = lambda cls: TYPE + NODE + cls
    classes = sorted({c.cls for c in (*vals, *cards)})
    keys = sorted({held(c) for c in cards} | {cls_key(c) for c in classes})
    at = {k: divmod(i, WORD) for i, k in enumerate(keys)}
    words = range((len(keys) + WORD - 1) // WORD)
    bounded = {c.path for c in cards if c.kind == "maxCount"} | {cls_key(c) for c in classes}
    mask = lambda names, w: sum(1 << at[k][1] for k in names if at[k][0] == w)
    spark, p = quads.sparkSession, F.col("predicate")
    rows = [(k, int(k in bounded), *[mask([k], w) for w in words]) for k in keys]
    ddl = "key string, once int" + "".join(f", w{w} long" for w in words)
    paths = sorted({c.path for c in (*vals, *cards)})
    seen = quads.filter(p.isin(TYPE, *paths))
    wrong = F.lit(False)
    if vals:
        numbered, n = [], {}
        for c in vals:  # a quad counts once, however many constraints its property has
            n[c.path] = n.get(c.path, -1) + 1
            numbered.append((c.path, n[c.path], c.kind, c.value, list(c.values)))
        table = spark.createDataFrame(numbered, "path string, nth int, kind string, arg string, args array<string>")
        seen = seen.join(F.broadcast(table), p == F.col("path"), "left")
        wrong = F.coalesce(wrong_value(), F.lit(False))
    first = F.coalesce(F.col("nth") == 0, F.lit(True)) if vals else F.lit(True)
    seen = seen.select(_node_bits().alias("_node"), _own_keys(cards).alias("key"), wrong.alias("wrong"), first.alias("first"))
    seen = seen.join(F.broadcast(spark.createDataFrame(rows, ddl)), "key", "left")
    per = seen.groupBy("_node").agg(F.bool_or("wrong").alias("wrong"), F.sum(F.when(F.col("first"), F.coalesce("once", F.lit(0))).otherwise(0)).alias("once"),
                                    *[F.bit_or(F.coalesce(f"w{w}", F.lit(0))).alias(f"w{w}") for w in words])
    distinct = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"w{w}").bitwiseAND(mask(bounded, w))) for w in words])
    off = F.col("wrong") | (F.col("once") > distinct)
    declared = reduce(lambda a, b: a | b, [F.col(f"w{w}").bitwiseAND(mask(map(cls_key, classes), w)) != 0 for w in words])
    for cls in classes:
        own = [c for c in cards if c.cls == cls]
        at_cls = at[cls_key(cls)]
        mine, need = F.col(f"w{at_cls[0]}").bitwiseAND(1 << at_cls[1]) != 0, {held(c) for c in own if c.kind == "hasValue" or c.kind == "minCount" and int(c.value) > 0}
        lacks = [F.col(f"w{w}").bitwiseAND(mask(need, w)) != mask(need, w) for w in words if mask(need, w)]
        if any(c.kind == "minCount" and int(c.value) > 1 or c.kind == "maxCount" and int(c.value) < 1 for c in own):
            lacks = [F.lit(True)]
        if lacks:
            off = off | (mine & reduce(lambda a, b: a | b, lacks))
    return per.filter(off & declared).select("_node")


def check_compiled(quads: DataFrame, constraints: Sequence[Constraint], is_set: bool = False) -> DataFrame:
    """Values and cardinalities of all classes: one scan names the :func:`suspects`, and only their quads are moved.

    A suspect's quads are counted by property, type and wanted value, the counts become one map, and every
    constraint of its classes is a test on that map; only violations leave the row, never a row per individual
    and constraint. A wrong value stated twice is one violation.
    """
    vals, cards = _of(constraints, VALUE_KINDS), _of(constraints, CARDINALITY)
    p, o = F.col("predicate"), F.col("object")
    hit_type = "struct<shape:string,cls:string,path:string,kind:string,value:string>"
    paths = sorted({c.path for c in (*vals, *cards)})
    named = small_side(spool(suspects(quads, vals, cards)))
    quads = quads.filter(p.isin(TYPE, *paths)).withColumn("_node", _node_bits()).join(named, "_node", "left_semi").drop("_node")
    quads = quads if is_set else quads.dropDuplicates()
    rows = quads.filter(p.isin(TYPE, *[c.path for c in cards])).select("graph", "subject", _own_keys(cards).alias("key")).withColumn("hit", F.lit(None).cast(hit_type))
    if vals:
        table = F.broadcast(constraint_table(quads.sparkSession, vals))
        bad = quads.join(table, p == F.col("path")).filter(wrong_value())
        hit = F.struct("shape", "cls", "path", "kind", o.alias("value"))
        rows = rows.unionByName(bad.select("graph", "subject", F.lit(None).cast("string").alias("key"), hit.cast(hit_type).alias("hit")))
    per = rows.repartition("graph", "subject").groupBy("graph", "subject", "key", "hit").agg(F.count(F.lit(1)).cast("int").alias("n"))
    node = per.groupBy("graph", "subject").agg(F.map_from_entries(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "n")))).alias("m"), F.collect_list("hit").alias("hits"))
    by_cls: dict[str, list[Constraint]] = {}
    for c in cards:
        by_cls.setdefault(c.cls, []).append(c)
    rule = lambda c: F.struct(F.lit(c.shape).alias("shape"), F.lit(c.path).alias("path"), F.lit(c.kind).alias("kind"), F.lit(int(c.value) if c.kind != "hasValue" else 0).alias("most"), F.lit(c.path + NODE + (c.value or "")).alias("held"))
    none = F.array().cast("array<struct<shape:string,path:string,kind:string,most:int,held:string>>")
    rules = F.create_map(*[x for cls, cs in by_cls.items() for x in (F.lit(cls), F.array(*[rule(c) for c in cs]))]) if by_cls else None
    mine = F.transform(F.filter(F.map_keys("m"), lambda k: k.startswith(TYPE + NODE)), lambda k: F.substring_index(k, NODE, -1))
    node = node.withColumn("classes", mine)
    result = lambda shape, path, kind, value: F.struct(shape.alias("shape"), path.alias("path"), kind.alias("constraint"), value.alias("value"))
    found = F.transform(F.filter("hits", lambda h: F.array_contains("classes", h["cls"])), lambda h: result(h["shape"], h["path"], h["kind"], h["value"]))
    if rules is not None:
        n = lambda c: F.coalesce(F.try_element_at("m", c["path"]), F.lit(0))
        broken = lambda c: F.when(c["kind"] == "minCount", n(c) < c["most"]).when(c["kind"] == "maxCount", n(c) > c["most"]).otherwise(~F.map_contains_key("m", c["held"]))
        per_class = lambda cls: F.transform(F.filter(F.coalesce(F.try_element_at(rules, cls), none), broken), lambda c: result(c["shape"], c["path"], c["kind"], n(c).cast("string")))
        found = F.concat(found, F.flatten(F.transform("classes", per_class)))
    return _out(node.select("graph", F.col("subject").alias("focus"), F.inline(found)))


def check_class(quads: DataFrame, constraints: Sequence[Constraint], types: DataFrame, known: DataFrame) -> DataFrame:
    """Linked nodes that are not of the required class, in the batch or in its context."""
    table = F.broadcast(constraint_table(quads.sparkSession, constraints))
    links = quads.join(table, F.col("predicate") == F.col("path")).select(
        "graph", F.col("subject").alias("focus"), "path", "cls", "shape", F.col("arg").alias("need"), F.col("object").alias("value"))
    links = links.join(types, ["graph", "focus", "cls"], "left_semi")
    have = known.select(F.col("focus").alias("value"), F.col("cls").alias("need")).distinct()
    return _out(links.join(have, ["value", "need"], "left_anti").withColumn("constraint", F.lit("class")))


def check_pairs(quads: DataFrame, constraints: Sequence[Constraint], types: DataFrame) -> DataFrame:
    """Order of two properties of one node; for several values the extreme pair decides.

    ``value`` of a constraint names the other property. ``equals`` compares the value sets. A quad goes to
    its node with the constraint's number and its side, 1 or 2, and the node's task sees all of it.
    """
    spark = quads.sparkSession
    rules = spark.createDataFrame([(i, c.shape, c.cls, c.path, c.kind, c.value) for i, c in enumerate(constraints)], "rule int, shape string, cls string, path string, kind string, arg string")
    keys = ["graph", "focus", "cls", "shape", "path", "kind", "arg"]

    def sides(same: bool) -> DataFrame:
        rows = [(p, i, s) for i, c in enumerate(constraints) if (c.kind == "equals") == same for p, s in ((c.path, 1), (c.value, 2))]
        own = F.broadcast(spark.createDataFrame(rows, "predicate string, rule int, side int"))
        return spread(quads.select("graph", F.col("subject").alias("focus"), "predicate", "object").join(own, "predicate").drop("predicate"), "graph", "focus")
    as_key = F.struct(F.col("object").try_cast("decimal(38,18)").alias("n"), F.col("object").alias("t"))
    order = sides(False).groupBy("graph", "focus", "rule").agg(
        F.max(F.when(F.col("side") == 1, as_key)).alias("l"), F.min(F.when(F.col("side") == 2, as_key)).alias("r"))
    order = order.filter("l IS NOT NULL AND r IS NOT NULL").join(F.broadcast(rules), "rule")
    bad = F.when(F.col("kind") == "lessThan", F.col("l") >= F.col("r")).otherwise(F.col("l") > F.col("r"))
    order = order.filter(bad).withColumn("value", F.col("l.t"))
    sets = sides(True).groupBy("graph", "focus", "rule", "object").agg(F.bit_or("side").alias("n")).filter("n < 3").join(F.broadcast(rules), "rule").withColumnRenamed("object", "value")
    found = order.select(*keys, "value").unionByName(sets.select(*keys, "value"))
    found = found.join(types, ["graph", "focus", "cls"], "left_semi")
    return _out(found.withColumnRenamed("kind", "constraint"))


def check_qualified(quads: DataFrame, shape: str, cls: str, path: str, langs: Sequence[str], types: DataFrame, exactly: int = 1) -> DataFrame:
    """Exactly n values of a property per language."""
    counts = quads.filter((F.col("predicate") == path) & F.col("lang").isin(*langs)).groupBy(
        "graph", F.col("subject").alias("focus")).agg(*[F.count(F.when(F.col("lang") == l, 1)).alias(f"n_{l}") for l in langs])
    nodes = types.filter(F.col("cls") == cls).join(counts, ["graph", "focus"], "left")
    cells = F.array(*[F.struct(F.lit(l).alias("value"), F.coalesce(f"n_{l}", F.lit(0)).alias("n")) for l in langs])
    rows = nodes.select("graph", "focus", F.inline(cells)).filter(F.col("n") != exactly)
    return _out(rows.select("graph", F.lit(shape).alias("shape"), "focus", F.lit(path).alias("path"), F.lit("qualified").alias("constraint"), "value"))


def check_closed(quads: DataFrame, shape: str, cls: str, allowed: Sequence[str], types: DataFrame) -> DataFrame:
    """Properties a closed shape does not declare."""
    extra = quads.filter(~F.col("predicate").isin(TYPE, *allowed)).withColumnRenamed("subject", "focus")
    nodes = types.filter(F.col("cls") == cls)
    rows = extra.join(nodes, ["graph", "focus"], "left_semi").select("graph", "focus", F.col("predicate").alias("path")).distinct()
    return _out(rows.withColumn("shape", F.lit(shape)).withColumn("constraint", F.lit("closed")).withColumn("value", F.col("path")))


def check_logical(table: DataFrame, shape: str, kind: str, conditions: Sequence[Column], path: str = "") -> DataFrame:
    """or / and / not / xone of sub-shapes, each a Column on a class table; NULL counts as false."""
    flags = [F.coalesce(c, F.lit(False)) for c in conditions]
    held = reduce(lambda a, b: a + b, [f.cast("int") for f in flags])
    ok = {"or": held > 0, "and": held == len(flags), "not": held == 0, "xone": held == 1}[kind]
    return _out(table.filter(~ok).select("graph", F.lit(shape).alias("shape"), F.col("subject").alias("focus"),
                                         F.lit(path).alias("path"), F.lit(kind).alias("constraint"), held.cast("string").alias("value")))


def check_custom(table: DataFrame, shape: str, violates: Column | str, path: str = "", value: Column | None = None) -> DataFrame:
    """A condition (Column or SQL text) that must hold on no row of a class table."""
    cond = F.expr(violates) if isinstance(violates, str) else violates
    shown = value.cast("string") if value is not None else F.lit(None).cast("string")
    return _out(table.filter(cond).select("graph", F.lit(shape).alias("shape"), F.col("subject").alias("focus"),
                                          F.lit(path).alias("path"), F.lit("custom").alias("constraint"), shown.alias("value")))


def check_node(quads: DataFrame, shape: str, path: str, constraints: Sequence[Constraint]) -> DataFrame:
    """Constraints on the nodes a property links to, reported on the linking node."""
    links = quads.filter(F.col("predicate") == path).select("graph", F.col("subject").alias("owner"), F.col("object").alias("focus"))
    linked = links.select("graph", "focus").distinct()
    classes = sorted({c.cls for c in constraints})
    types = linked.withColumn("cls", F.explode(F.array(*[F.lit(c) for c in classes])))
    inner = validate_shapes(quads, constraints, types=types).select("graph", "focus", F.col("path").alias("value")).distinct()
    rows = links.join(inner, ["graph", "focus"]).select("graph", F.col("owner").alias("focus"), "value")
    return _out(rows.withColumn("shape", F.lit(shape)).withColumn("path", F.lit(path)).withColumn("constraint", F.lit("node")))


def validate_shapes(
    quads: DataFrame, constraints: Sequence[Constraint], pairs: DataFrame | None = None,
    context: DataFrame | None = None, types: DataFrame | None = None,
    extra: Sequence[Callable[[DataFrame, DataFrame], DataFrame]] = (), is_set: bool = False,
) -> DataFrame:
    """All violations of a batch; ``graph`` is a column, so many batches are validated in one job.

    ``pairs`` is the subclass closure, ``context`` the stored quads about referenced nodes (their
    types count for ``class``), ``extra`` further checks taking (quads, types).
    """
    plain = types is None and pairs is None  # each node's classes are its own quads
    types = type_table(quads, pairs) if types is None else types
    parts = []
    if plain and (chosen := _of(constraints, (*VALUE_KINDS, *CARDINALITY))):
        parts.append(check_compiled(quads, chosen, is_set))
    elif not plain:
        if chosen := _of(constraints, VALUE_KINDS):
            parts.append(check_values(quads, chosen, types))
        if chosen := _of(constraints, CARDINALITY):
            parts.append(check_cardinality(quads, chosen, types, is_set))
    if chosen := _of(constraints, ("class",)):
        known = types.select("focus", "cls")
        if context is not None:
            known = known.unionByName(type_table(context, pairs).select("focus", "cls"))
        parts.append(check_class(quads, chosen, types, known))
    if chosen := _of(constraints, PAIRS):
        parts.append(check_pairs(quads, chosen, types))
    parts += [check(quads, types) for check in extra]
    if not parts:
        raise ValueError("no constraint to check")
    return reduce(DataFrame.unionByName, parts)
