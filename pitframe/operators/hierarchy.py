"""Subclass closure, loops, reachable slices and the context of a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.operators.quads import TYPE
from pitframe.session import cut_lineage


def closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """Every (descendant, ancestor) pair, each node its own ancestor too.

    Path lengths double per round, so a hierarchy of depth d takes log2(d) rounds; lineage is cut
    each round and the loop stops when nothing new appears.
    """
    e = edges.select(F.col(child).alias("descendant"), F.col(parent).alias("ancestor")).distinct()
    nodes = e.select("descendant").union(e.select("ancestor")).distinct()
    known = cut_lineage(e.unionByName(nodes.select("descendant", F.col("descendant").alias("ancestor"))).distinct())
    size = known.count()
    while True:
        hop = known.select(F.col("descendant").alias("_m"), F.col("ancestor").alias("_a"))
        step = known.join(hop, known.ancestor == hop["_m"]).select("descendant", F.col("_a").alias("ancestor"))
        known = cut_lineage(step.distinct())  # reflexive pairs keep the shorter paths
        grown = known.count()
        if grown == size:
            return known
        size = grown


def entail(types: DataFrame, pairs: DataFrame, cls: str = "cls") -> DataFrame:
    """Types with those of all superclasses; a class outside the hierarchy keeps itself."""
    up = types.join(pairs.select(F.col("descendant").alias(cls), "ancestor"), cls, "left")
    return up.withColumn(cls, F.coalesce("ancestor", cls)).drop("ancestor").distinct()


def cycles(edges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Loops of a functional edge set (one edge per start): (smallest member, length).

    Pointer jumping: the jump table doubles its stride each round and drops chains that end, so a
    round is one equi join of at most one row per edge, and the rounds grow with the logarithm of
    the longest chain.
    """
    nxt = edges.filter(F.col(start) != F.col(end)).select(F.col(start).alias("n"), F.col(end).alias("j"))
    table, image = cut_lineage(nxt), -1
    while True:  # the image shrinks until it is the set of loop nodes, then keeps its size
        now = table.select("j").distinct().count()
        if now == image or now == 0:
            break
        image = now
        hop = table.select(F.col("n").alias("_n"), F.col("j").alias("_j"))
        table = cut_lineage(table.join(hop, table.j == hop["_n"]).select("n", F.col("_j").alias("j")))
    on_loop = table.select(F.col("j").alias("n")).distinct()
    ring = nxt.join(on_loop, "n", "left_semi").select("n", "j", F.col("n").alias("low"), F.lit(True).alias("moved"))
    ring = cut_lineage(ring)
    while not ring.filter("moved").isEmpty():  # labels settle once a doubled stride lowers none
        hop = ring.select(F.col("n").alias("_n"), F.col("j").alias("_j"), F.col("low").alias("_low"))
        ring = cut_lineage(ring.join(hop, ring.j == hop["_n"]).select(
            "n", F.col("_j").alias("j"), F.least("low", "_low").alias("low"), (F.col("_low") < F.col("low")).alias("moved")))
    return ring.groupBy(F.col("low").alias("smallest")).agg(F.count(F.lit(1)).alias("length"))


def slice_terms(seeds: DataFrame, edges: DataFrame, described: DataFrame) -> DataFrame:
    """Seeds plus their ancestors, expanded only through described parents: (term, seed)."""
    ok = edges.join(described.select(F.col("term").alias("parent")).distinct(), "parent", "left_semi")
    ok = ok.select(F.col("child"), F.col("parent")).distinct()
    found = cut_lineage(seeds.select("term").distinct())
    frontier = found
    while True:  # one level a round, until none is new
        up = frontier.join(ok, frontier.term == ok.child).select(F.col("parent").alias("term")).distinct()
        fresh = cut_lineage(up.join(found, "term", "left_anti"))
        if fresh.isEmpty():
            flag = seeds.select("term").distinct().withColumn("seed", F.lit(True))
            return found.join(flag, "term", "left").withColumn("seed", F.coalesce("seed", F.lit(False)))
        found, frontier = cut_lineage(found.unionByName(fresh)), fresh


def references(batch: DataFrame) -> DataFrame:
    """Linked nodes a batch does not declare, classes left out."""
    linked = batch.filter((F.col("object_kind") == "iri") & (F.col("predicate") != TYPE)).select(
        "graph", F.col("object").alias("subject")).distinct()
    typed = batch.filter(F.col("predicate") == TYPE).select("graph", "subject").distinct()
    return linked.join(typed, ["graph", "subject"], "left_anti")


def fetch_context(refs: DataFrame, store: DataFrame, predicates: Sequence[str], links: Sequence[str]) -> DataFrame:
    """Stored quads about referenced nodes, limited to the predicates the shapes read.

    Nodes linked by the class-checked properties are followed until no new node appears.
    """
    wanted = store.filter(F.col("predicate").isin(TYPE, *predicates))
    seen = cut_lineage(refs.select("subject").distinct())
    frontier = seen
    while True:
        hop = wanted.filter(F.col("predicate").isin(*links)).join(frontier, "subject", "left_semi")
        fresh = cut_lineage(hop.select(F.col("object").alias("subject")).distinct().join(seen, "subject", "left_anti"))
        if fresh.isEmpty():
            return wanted.join(seen, "subject", "left_semi")
        seen, frontier = cut_lineage(seen.unionByName(fresh)), fresh


def curated_schema(quads: DataFrame, predicates: Sequence[str], max_length: int = 400) -> DataFrame:
    """Schema triples worth showing: named classes and properties, short texts, no blank nodes."""
    named = ~F.col("subject").startswith("_:") & ~F.col("object").startswith("_:")
    short = (F.col("object_kind") == "iri") | (F.length("object") <= max_length)
    return quads.filter(F.col("predicate").isin(*predicates) & named & short).select(
        "subject", "predicate", "object", "object_kind", "datatype", "lang").distinct()


def check_edges(df: DataFrame, a: str, b: str, weight: str, count: str, method: str) -> DataFrame:
    """Co-occurrence edges that break a rule: same ends, no weight, count below one, repeated pair."""
    pair = df.withColumn("_lo", F.least(a, b)).withColumn("_hi", F.greatest(a, b))
    again = pair.groupBy("_lo", "_hi", method).agg(F.count(F.lit(1)).alias("_n"))
    rows = pair.join(again, ["_lo", "_hi", method], "left")
    why = (F.when(F.col(a) == F.col(b), "same ends").when(F.col(weight).isNull(), "no weight")
           .when(F.col(count) < 1, "count below one").when(F.col(method).isNull(), "no method")
           .when(F.col("_n") > 1, "repeated pair"))
    return rows.withColumn("violation", why).filter("violation IS NOT NULL").drop("_lo", "_hi", "_n")
