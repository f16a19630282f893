"""Proof that what is stored equals its source: keyed comparisons, identities, control totals.

Both sides are reduced by aggregates before they meet: to (check, key, value) rows, or to digests of
whole graphs that also hold the control totals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.operators.integrity import set_diff
from pitframe.operators.quads import QUAD_COLUMNS, TYPE, bits, diff_sizes, graph_diff, graph_sizes
from pitframe.session import cut_lineage, small_side, spool

TOLERANCE = 1e-12


def compare_keyed(expected: DataFrame, actual: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """(keys, expected, actual, status): pass, differs, missing (only expected) or extra."""
    keys = list(keys)
    e = expected.select(*keys, F.col(value).alias("expected")).withColumn("_e", F.lit(True))
    a = actual.select(*keys, F.col(value).alias("actual")).withColumn("_a", F.lit(True))
    both = e.join(a, keys, "full_outer")
    status = (F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra")
              .when(F.col("expected").eqNullSafe(F.col("actual")), "pass").otherwise("differs"))
    return both.withColumn("status", status).drop("_e", "_a")


def check_rows(name: str, df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """A reduced side: (check, key, value) as text."""
    key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    return df.select(F.lit(name).alias("check"), key.alias("key"), value.cast("string").alias("value"))


@dataclass(frozen=True)
class Proof:
    """What the proof of a graph counts beside its triples, classes, links and dates.

    ``unlinked``: (class, property that names something, link, name that needs no link). ``groups``: (check, class, properties),
    individuals by their values. ``valued``: (check, class, property, value), individuals with that value. ``last``: (check, class,
    by, day, value), the last value of each ``by``. ``labelled``: (label, classes, links to a parent), individuals without a label,
    their own or their parent's.
    """

    unlinked: tuple[tuple[str, str, str, str | None], ...] = ()
    groups: tuple[tuple[str, str, tuple[str, ...]], ...] = ()
    valued: tuple[tuple[str, str, str, str], ...] = ()
    last: tuple[tuple[str, str, str, str, str], ...] = ()
    labelled: tuple[str, tuple[str, ...], tuple[str, ...]] | None = None


def proof_rows(quads: DataFrame, proof: Proof) -> list[DataFrame]:
    """(check, key, value) of a :class:`Proof`: one row of fixed width a subject, in which a text is 64 bits; names are given back to groups."""
    p, o, code = F.col("predicate"), F.col("object"), F.xxhash64("object")
    label, classes, parents = proof.labelled or ("", (), ())
    cls = sorted({x[0] for x in proof.unlinked} | {x[1] for x in (*proof.groups, *proof.valued, *proof.last)} | {*classes})
    named = sorted({n for _, _, ns in proof.groups for n in ns} | {x[2] for x in proof.last})
    coded = sorted({*named, *[x[1] for x in proof.unlinked], *[x[2] for x in proof.valued]})
    there = sorted({x[2] for x in proof.unlinked} | ({label} if label else set()))
    is_cls = lambda df, c: df.filter(F.col("_types").bitwiseAND(1 << cls.index(c)) != 0)
    of = lambda prop, c: F.when(p == prop, c)
    types = reduce(lambda x, y: x.bitwiseOR(y), [F.when((p == TYPE) & (o == c), 1 << i).otherwise(0) for i, c in enumerate(cls)])
    aggs = [F.bit_or(types).alias("_types"), F.max(F.when(p.isin(*(parents or ("",))), code)).alias("_parent"), F.min(F.when(p.isin(*(parents or ("",))), code)).alias("_parent2")]
    aggs += [f(of(n, code)).alias(f"{side}_{n}") for n in coded for side, f in (("lo", F.min), ("hi", F.max))]
    aggs += [F.max(p == n).alias(f"has_{n}") for n in there]
    for i, (_, _, _, day, value) in enumerate(proof.last):
        aggs += [F.max(of(day, F.unix_date(o.try_cast("date")))).alias(f"day_{i}"), F.max(of(value, o.try_cast("decimal(38,18)"))).alias(f"value_{i}")]
    read = {TYPE, *coded, *there, *parents, *[x for _, _, _, d, v in proof.last for x in (d, v)]}
    rows = quads.filter(p.isin(*read))
    per = spool(rows.groupBy("graph", F.xxhash64("subject").alias("_s"), F.xxhash64(F.lit("b"), "subject").alias("_t")).agg(*aggs))
    parts, n, bits_of = [], F.count(F.lit(1)).alias("n"), lambda text: F.xxhash64(F.lit(text))
    names = spool(rows.filter(p.isin(*(named or ("",)))).select("predicate", code.alias("_c"), "object").distinct())
    name = lambda df, prop: df.join(small_side(names.filter(p == prop).select(F.col("_c").alias(f"_{prop}"), o.alias(prop))), f"_{prop}", "left").withColumn(
        prop, F.when(F.col(f"_{prop}") == 0, "several values").otherwise(F.col(prop)))
    single = lambda prop: F.when(F.col(f"lo_{prop}") != F.col(f"hi_{prop}"), F.lit(0).cast("long")).otherwise(F.col(f"lo_{prop}")).alias(f"_{prop}")
    for c, prop, link, apart in proof.unlinked:
        bad = is_cls(per, c).filter(F.col(f"lo_{prop}").isNotNull() & ~F.coalesce(F.col(f"has_{link}"), F.lit(False)))
        bad = bad if apart is None else bad.filter((F.col(f"lo_{prop}") != bits_of(apart)) | (F.col(f"hi_{prop}") != bits_of(apart)))
        parts.append(check_rows(f"unlinked {c}", bad.groupBy("graph").agg(n), ["graph"], F.col("n")))
    for check, c, props in proof.groups:
        found = is_cls(per, c).select("graph", *[single(x) for x in props]).groupBy("graph", *[f"_{x}" for x in props]).agg(n)
        for x in props:
            found = name(found, x)
        parts.append(check_rows(check, found.fillna("none", list(props)), ["graph", *props], F.col("n")))
    for check, c, prop, value in proof.valued:
        hit = is_cls(per, c).filter((F.col(f"lo_{prop}") == bits_of(value)) | (F.col(f"hi_{prop}") == bits_of(value)))
        parts.append(check_rows(check, hit.groupBy("graph").agg(n), ["graph"], F.col("n")))
    for i, (check, c, by, _, _) in enumerate(proof.last):
        last = is_cls(per, c).filter(F.col(f"day_{i}").isNotNull() & F.col(f"value_{i}").isNotNull()).select("graph", single(by), F.struct(f"day_{i}", f"value_{i}").alias("x"))
        last = name(last.groupBy("graph", f"_{by}").agg(F.max("x").alias("x")), by)
        parts.append(check_rows(check, last, ["graph", by], F.concat_ws(" ", F.date_from_unix_date(F.col(f"x.day_{i}")).cast("string"), F.col(f"x.value_{i}").cast("string"))))
    if label:
        known = per.filter(f"`has_{label}`").select("graph", F.col("_s").alias("_parent"), F.lit(True).alias("_known"))
        mine = reduce(lambda x, y: x | y, [F.col("_types").bitwiseAND(1 << cls.index(c)) != 0 for c in classes])
        bare = per.filter(mine & ~F.coalesce(F.col(f"has_{label}"), F.lit(False))).select("graph", "_s", "_parent", "_parent2")
        lost = bare.join(known, ["graph", "_parent"], "left_anti")
        lost = lost.join(known.withColumnRenamed("_parent", "_parent2"), ["graph", "_parent2"], "left_anti")
        parts.append(check_rows("unlabelled", lost.groupBy("graph").agg(n), ["graph"], F.col("n")))
    return parts


def graph_profile(quads: DataFrame, links: Sequence[str] = (), dated: str | None = "knowledgeDate", proof: Proof | None = None) -> DataFrame:
    """The reduced form of a graph: triples, individuals per class, links, undated individuals, and what ``proof`` asks.

    Triples and links are counted in one pass, classes and dates in another that keeps a row for each
    subject and class; subjects are told apart by 128 bits. A graph without a name is one like others.
    """
    p = F.col("predicate")
    counts = cut_lineage(quads.groupBy("graph", "predicate").agg(F.count(F.lit(1)).alias("n")))  # a row a graph and property
    said = quads.filter(p.isin(TYPE, dated) if dated else p == TYPE).select(
        "graph", F.col("subject").isNull().alias("nameless"), *bits("subject"), (p == TYPE).alias("typed"), F.when(p == TYPE, F.col("object")).alias("cls")).distinct()
    individuals = said.filter("typed").groupBy("cls").agg(F.count(F.lit(1)).alias("individuals"))
    parts = [
        check_rows("triples", counts.groupBy("graph").agg(F.sum("n").alias("triples")), ["graph"], F.col("triples")),
        check_rows("class", individuals, ["cls"], F.col("individuals")),
    ]
    if links:
        parts.append(check_rows("link", counts.filter(p.isin(*links)), ["graph", "predicate"], F.col("n")))
    if dated:
        per = said.groupBy("graph", "_h1", "_h2").agg(F.max("typed").alias("typed"), F.max(~F.col("typed")).alias("dated"))
        bad = per.filter("typed AND NOT dated").groupBy("graph").agg(F.count(F.lit(1)).alias("n"))
        parts.append(check_rows("undated", bad, ["graph"], F.col("n")))
    if proof:
        parts += proof_rows(quads, proof)
    return reduce(DataFrame.unionByName, parts)


def verify_graph(stored: DataFrame, projected: DataFrame, links: Sequence[str] = (), proof: Proof | None = None) -> DataFrame:
    """Stored against re-projected graph: identity first (count of differing quads), then each count."""
    profile = compare_keyed(graph_profile(projected, links, proof=proof), graph_profile(stored, links, proof=proof), ["check", "key"])
    off = diff_sizes(stored, projected)
    identity = off.select(F.lit("identity").alias("check"), F.concat_ws("/", "graph", "side").alias("key"),
                          F.lit("0").alias("expected"), F.col("n").cast("string").alias("actual"), F.lit("differs").alias("status"))
    return profile.unionByName(identity)


def verify_counts(stored: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows per key against expected totals (column ``value``)."""
    n = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("value"))
    return compare_keyed(expected, n, keys)


def verify_sizes(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """Graph sizes against expected ones; a graph nobody expects is ``extra``."""
    return compare_keyed(expected, graph_sizes(stored).withColumnRenamed("triples", "value"), ["graph"])


def check_vocab(quads: DataFrame, predicate: str, allowed: Sequence[str]) -> DataFrame:
    """Stored values of a property outside its closed list, with their counts."""
    return quads.filter((F.col("predicate") == predicate) & ~F.col("object").isin(*allowed)).groupBy(
        F.col("object").alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def compare_controls(expected: DataFrame, actual: DataFrame, known: Sequence[str], final: bool, tolerance: float = TOLERANCE) -> DataFrame:
    """Control totals per (configuration, window, key, subkey), numbers within a tolerance.

    Unknown keys always fail; a key missing from ``expected`` fails only for a final delivery.
    """
    keys = ["configuration", "window", "key", "subkey"]
    both = compare_keyed(expected, actual, keys)
    near = F.abs(F.col("expected").try_cast("double") - F.col("actual").try_cast("double")) <= tolerance
    status = (
        F.when((F.col("status") != "extra") & ~F.col("key").isin(*known), "unknown key")
        .when(F.col("status") == "extra", F.lit("missing from manifest" if final else "not compared"))
        .when((F.col("status") == "differs") & F.coalesce(near, F.lit(False)), "pass").otherwise(F.col("status")))
    return both.withColumn("status", status)


def identity_failures(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """Rows on which a named identity does not hold; NULL counts as holding (nothing to compare)."""
    cells = [F.when(~F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules.items()]
    return df.select(*keys, F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("identity"))


def control_identities() -> dict[str, Column]:
    """Identities of a wide control row: memory parts, counter drops, scale changes."""
    c = F.col
    return {
        "memory_episodes": c("memory_episodes") == c("memory_released_price") + c("memory_released_not_ranked") + c("memory_open_at_end"),
        "retention_counter_drops": c("retention_counter_drops") == c("rejections_counter"),
        "scale_changes": (c("scale_changes") == 0) | (c("scale_changes") == c("alerts_l0")),
    }


def cash_failures(df: DataFrame, state: str, risk_off: str, cash: str) -> DataFrame:
    """Cash must be positive exactly when below trend or news risk-off."""
    on = (F.col(state) == "below") | F.coalesce(F.col(risk_off), F.lit(False))
    return df.filter((on & ~(F.col(cash) > 0)) | (~on & (F.col(cash) != 0)))


def compounding_failures(df: DataFrame, keys: Sequence[str], segment: str, value: str, whole: str, parts: Sequence[str], tolerance: float = TOLERANCE) -> DataFrame:
    """Groups whose whole return differs from the compounded parts by more than the tolerance."""
    at = lambda s: F.max(F.when(F.col(segment) == s, F.col(value)))
    wide = df.groupBy(*keys).agg(at(whole).alias("whole"), *[at(p).alias(f"_p{i}") for i, p in enumerate(parts)])
    made = reduce(lambda a, b: a * b, [1 + F.col(f"_p{i}") for i in range(len(parts))]) - 1
    wide = wide.withColumn("compounded", made).drop(*[f"_p{i}" for i in range(len(parts))])
    return wide.filter(F.abs(F.col("whole") - F.col("compounded")) > tolerance)


def check_canonical(history: DataFrame, cik: str = "cik", symbol: str = "symbol", canonical: str = "canonical_symbol", start: str = "valid_from") -> DataFrame:
    """Latest history rows whose canonical symbol is not among their line's latest symbols."""
    top = history.groupBy(cik).agg(F.max(start).alias(start))
    latest = history.join(top, [cik, start], "left_semi")
    names = latest.select(cik, F.col(symbol).alias(canonical)).distinct()
    return latest.join(names, [cik, canonical], "left_anti")


def compare_external(ext: DataFrame, engine: DataFrame, keys: Sequence[str], dates: Sequence[str], count: str) -> DataFrame:
    """External summary against the engine's: absent rows and other dates are errors, counts only warn."""
    keys = list(keys)
    e = engine.select(*keys, *[F.col(d).alias(f"_{d}") for d in dates], F.col(count).alias("_count")).withColumn("_hit", F.lit(True))
    rows = ext.join(e, keys, "left")
    off = F.concat_ws(",", *[F.when(~F.col(d).eqNullSafe(F.col(f"_{d}")), F.lit(d)) for d in dates])
    severity = (F.when(F.col("_hit").isNull(), "error").when(off != "", "error")
                .when(~F.col(count).eqNullSafe(F.col("_count")), "warning"))
    detail = F.when(F.col("_hit").isNull(), "no engine row").when(off != "", F.concat(F.lit("differs: "), off)).otherwise(F.lit(count))
    return rows.withColumn("severity", severity).withColumn("detail", detail).filter("severity IS NOT NULL").select(*keys, "severity", "detail")


def max_abs_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Largest absolute difference of a value over shared keys."""
    pair = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), list(keys))
    return pair.agg(F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_abs_diff"), F.count(F.lit(1)).alias("compared"))


def verify_metadata(runs: DataFrame, manifest: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Run metadata against manifest hashes and configuration, one row per compared column."""
    def long(df):
        return df.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
    return compare_keyed(long(manifest), long(runs), [*keys, "column"])


# Properties whose values control totals count.
COUNTED = (TYPE, "alertRule", "status", "windowId", "repairUsed")


def quad_digests(quads: DataFrame, counted: Sequence[str] = COUNTED) -> DataFrame:
    """(graph, kind, predicate, value, n, h1, h2): additive digests of a multiset of quads, from one scan.

    Each quad has a 128-bit digest, two hashes of 64 bits; ``h1`` sums one
    modulo 2^64 and ``h2`` xors the other, so parts add up and order doesn't matter. ``kind`` is the
    head of the subject's id, ``value`` the object of a counted property, else null: the counts that
    control totals ask for are among the rows. Sums are formed before the exchange, so no graph is one
    group; every property of every kind is one short row.
    """
    h1, h2 = bits(*QUAD_COLUMNS)
    value = F.when(F.col("predicate").isin(*counted), F.col("object"))
    # 32-bit halves keep the sum from leaving a long; it is taken modulo 2^64 when halves are joined
    low, high = h1.bitwiseAND(0xFFFFFFFF), F.shiftright(h1, 32)
    return quads.groupBy("graph", F.substring_index("subject", "_", 1).alias("kind"), "predicate", value.alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(low.cast("decimal(20,0)")).alias("low"), F.sum(high.cast("decimal(20,0)")).alias("high"), F.bit_xor(h2).alias("h2"),
    ).withColumn("h1", (F.col("low") + F.col("high") * F.lit(4294967296).cast("decimal(20,0)")).cast("string")).drop("low", "high")


def differing_graphs(stored: DataFrame, projected: DataFrame) -> DataFrame:
    """(graph, expected, actual, same) from two digest tables: triples of each side and whether all digests agree."""
    keys = ["graph", "kind", "predicate", "value"]
    side = lambda d, n: d.select(*keys, F.lit(n).alias("_side"), F.struct("n", "h1", "h2").alias("_d"))
    one = lambda n: F.max(F.when(F.col("_side") == n, F.col("_d"))).alias(n)
    row = side(projected, "e").unionByName(side(stored, "a")).groupBy(*keys).agg(one("e"), one("a"))
    return row.groupBy("graph").agg(F.sum("e.n").alias("expected"), F.sum("a.n").alias("actual"), F.min(F.col("e").eqNullSafe(F.col("a"))).alias("same"))


def digest_controls(digests: DataFrame, controls: Mapping[str, tuple[str, str, bool]]) -> DataFrame:
    """(graph, key, subkey, value) of control totals named as key: (kind, property, by value)."""
    parts = []
    for key, (kind, predicate, by_value) in controls.items():
        hit = digests.filter((F.col("kind") == kind) & (F.col("predicate") == predicate))
        parts.append(hit.select("graph", F.lit(key).alias("key"), F.coalesce(F.col("value"), F.lit("")).alias("subkey") if by_value else F.lit("").alias("subkey"), "n"))
    return reduce(DataFrame.unionByName, parts).groupBy("graph", "key", "subkey").agg(F.sum("n").alias("value"))


def control_rows(digests: DataFrame, expected: DataFrame, controls: Mapping[str, tuple[str, str, bool]]) -> DataFrame:
    """(check, key, status) of control totals ``expected`` (graph, key, subkey, value) against stored ones.

    A total of zero may be absent in the store; a key that isn't among ``controls`` can't be read from the
    store; a graph of which nothing is stored can't be verified.
    """
    keys = ["graph", "key", "subkey"]
    have = digest_controls(digests, controls).withColumnRenamed("value", "actual")
    there = digests.select("graph").distinct().withColumn("_stored", F.lit(True))
    x = expected.select(*keys, F.col("value").cast("long").alias("expected")).join(have, keys, "left").join(there, "graph", "left")
    status = F.when(~F.col("key").isin(*controls), "not-verifiable").when(F.col("_stored").isNull(), "not-verifiable")
    status = status.when(F.col("expected") == F.coalesce("actual", F.lit(0)), "pass").otherwise("fail")
    return x.select(F.lit("control").alias("check"), F.concat_ws("/", F.col("graph"), F.col("key"), F.when(F.col("subkey") != "", F.col("subkey"))).alias("key"), status.alias("status"))


def verify_delivery(stored: DataFrame, projected: DataFrame, removed_rules: Sequence[str] = (), price_properties: Sequence[str] = (),
                    expected: DataFrame | None = None, controls: Mapping[str, tuple[str, str, bool]] | None = None, counted: Sequence[str] = COUNTED) -> DataFrame:
    """(check, key, status) per projected graph: pass, fail, or not-verifiable where nothing is stored; plus what may not be there.

    Both sides are reduced to digests first (:func:`quad_digests`), in one scan each; every other check
    reads those. ``expected`` holds control totals (graph, key, subkey, value) of all runs, agents and
    series, ``controls`` says what each counts. Graphs that the delivery doesn't project are left alone;
    the quads that differ are told by :func:`delivery_differences`.
    """
    counted = tuple(dict.fromkeys((*counted, *([p for _, p, by in (controls or {}).values() if by]))))
    have, want = cut_lineage(quad_digests(stored, counted)), cut_lineage(quad_digests(projected, counted))
    graphs = differing_graphs(have, want).filter("expected IS NOT NULL")
    status = F.when(F.col("actual").isNull(), "not-verifiable").when(F.col("same"), "pass").otherwise("fail")
    out = graphs.select(F.lit("graph").alias("check"), F.col("graph").alias("key"), status.alias("status"))
    for name, cond in (("removed rule", F.col("value").isin(*(removed_rules or ("",)))), ("price property", F.col("predicate").isin(*(price_properties or ("",))))):
        bad = have.filter(cond).groupBy("graph").agg(F.sum("n").alias("n"))
        out = out.unionByName(bad.select(F.lit(name).alias("check"), F.col("graph").alias("key"), F.lit("fail").alias("status")))
    return out if expected is None else out.unionByName(control_rows(have, expected, controls or {}))


def delivery_differences(stored: DataFrame, projected: DataFrame, counted: Sequence[str] = COUNTED) -> DataFrame:
    """Quads found on one side only, of the stored graphs whose digests differ; equal graphs are read once, for their digest.

    In those graphs the digests of subjects are compared, a row of fixed width each, then the 128 bits of each
    quad of subjects that differ; only quads whose bits lie on one side are compared as texts.
    """
    have, want = cut_lineage(quad_digests(stored, counted)), cut_lineage(quad_digests(projected, counted))
    off = spool(differing_graphs(have, want).filter("expected IS NOT NULL AND actual IS NOT NULL AND NOT same").select("graph"))
    if off.isEmpty():
        return projected.sparkSession.createDataFrame([], graph_diff(stored.limit(0), projected.limit(0)).schema)
    named = small_side(off)  # stored, so that its size is known and quads meet it where they lie
    cols = [F.coalesce(F.col(c), F.lit("\u0000")) for c in QUAD_COLUMNS]
    a, b = (d.join(named, "graph", "left_semi").withColumns({"_n": F.xxhash64("graph", "subject"), "_a": F.xxhash64(*cols), "_b": F.xxhash64(F.lit("b"), *cols)}) for d in (stored, projected))
    moved = small_side(spool(differing_subjects(a, b)))
    a, b = (d.join(moved, "_n", "left_semi").drop("_n") for d in (a, b))
    both = a.select("_a", "_b", F.lit(1).alias("_s")).unionByName(b.select("_a", "_b", F.lit(2).alias("_s")))
    odd = small_side(spool(both.groupBy("_a", "_b").agg(F.bit_or("_s").alias("_s")).filter("_s <> 3").select("_a", "_b")))
    return graph_diff(a.join(odd, ["_a", "_b"], "left_semi"), b.join(odd, ["_a", "_b"], "left_semi"))


def differing_subjects(a: DataFrame, b: DataFrame) -> DataFrame:
    """The ``_n`` of subjects whose quads, by number and digest of their bits ``_a`` and ``_b``, differ between two sides.

    Both sides are added up, the second with the other sign, so what is equal leaves nothing and one row a subject moves.
    """
    low, high = lambda c: F.col(c).bitwiseAND(0xFFFFFFFF), lambda c: F.shiftright(c, 32)
    side = lambda d, s: d.select("_n", F.lit(s).alias("n"), (low("_a") * s).alias("l"), (high("_a") * s).alias("h"), "_b")
    sums = side(a, 1).unionByName(side(b, -1)).groupBy("_n").agg(*[F.sum(c).alias(c) for c in ("n", "l", "h")], F.bit_xor("_b").alias("x"))
    return sums.filter("n <> 0 OR l <> 0 OR h <> 0 OR x <> 0").select("_n")


def date_sets(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dates of one side missing on the other."""
    return set_diff(a, b, keys)


def nested_problems(df: DataFrame, column: str, allowed: Sequence[str], keys: Sequence[str], counters: Sequence[str] = ()) -> DataFrame:
    """Audit-log objects with unknown fields, negative counters, or a cash choice that names an asset."""
    ok = F.array(*[F.lit(x) for x in sorted(allowed)])
    unknown = F.transform(F.array_except(F.json_object_keys(column), ok), lambda k: F.concat(F.lit("unknown field "), k))
    raw = lambda k: F.get_json_object(column, f"$.{k}")
    negative = [F.when(raw(k).try_cast("double") < 0, F.lit(f"negative {k}")) for k in counters]
    cash = F.when((raw("cash") == "true") & raw("asset_id").isNotNull(), F.lit("cash choice names an asset"))
    found = F.filter(F.concat(F.coalesce(unknown, F.array().cast("array<string>")), F.array(cash, *negative)), lambda x: x.isNotNull())
    return df.select(*keys, F.explode(found).alias("problem"))
