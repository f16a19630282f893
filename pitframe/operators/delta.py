"""Difference between a source catalogue and the stored one, and the batch that closes it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.functions.scalars import quarter_label


def classify_memberships(source: DataFrame, stored: DataFrame, key: str = "membership", owner: str = "asset",
                         start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """(key, outcome, closes_on): new, closure, same, or the drift that stops a delta.

    Stored open and closed in the source is a closure; every other difference is drift.
    """
    s = source.select(key, *[F.col(c).alias(f"s_{c}") for c in (owner, start, end)]).withColumn("_s", F.lit(True))
    t = stored.select(key, *[F.col(c).alias(f"t_{c}") for c in (owner, start, end)]).withColumn("_t", F.lit(True))
    r = s.join(t, key, "full_outer")
    outcome = (
        F.when(F.col("_t").isNull(), "new").when(F.col("_s").isNull(), "drift: absent from the source")
        .when(F.col(f"s_{owner}") != F.col(f"t_{owner}"), "drift: other asset")
        .when(F.col(f"s_{start}") != F.col(f"t_{start}"), "drift: other start")
        .when(F.col(f"s_{end}").eqNullSafe(F.col(f"t_{end}")), "same")
        .when(F.col(f"t_{end}").isNull(), "closure").when(F.col(f"s_{end}").isNull(), "drift: reopened")
        .otherwise("drift: other end"))
    r = r.withColumn("outcome", outcome)
    return r.select(key, "outcome", F.when(F.col("outcome") == "closure", F.col(f"s_{end}")).alias("closes_on"))


def classify_assets(source: DataFrame, stored: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, outcome, column): new, same, absent, or one row per changed column."""
    s = source.select(key, *[F.col(c).alias(f"s_{c}") for c in columns]).withColumn("_s", F.lit(True))
    t = stored.select(key, *[F.col(c).alias(f"t_{c}") for c in columns]).withColumn("_t", F.lit(True))
    r = s.join(t, key, "full_outer")
    changed = F.filter(F.array(*[F.when(~F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}")), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    outcome = F.when(F.col("_t").isNull(), "new").when(F.col("_s").isNull(), "drift: absent from the source").when(
        F.size(changed) > 0, "drift: changed").otherwise("same")
    shown = F.when(F.col("_s") & F.col("_t") & (F.size(changed) > 0), changed)
    return r.select(key, outcome.alias("outcome"), F.explode_outer(shown).alias("column"))


def next_delta(graphs: DataFrame, day) -> DataFrame:
    """One row: the next free delta graph of a day's quarter."""
    quarter = quarter_label(F.lit(day).cast("date"))
    n = F.regexp_extract("graph", r"^urn:graph:universe:(\d{4}-Q[1-4]):delta:([1-9][0-9]*)$", 2).try_cast("int")
    q = F.regexp_extract("graph", r"^urn:graph:universe:(\d{4}-Q[1-4]):delta:", 1)
    top = graphs.filter(q == quarter).agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("n"))
    return top.select(F.concat(F.lit("urn:graph:universe:"), quarter, F.lit(":delta:"), F.col("n").cast("string")).alias("graph"), "n")


def delta_batch(memberships: DataFrame, assets: DataFrame) -> tuple[bool, DataFrame, DataFrame, DataFrame]:
    """(clean, new assets, new memberships, closures); drift anywhere makes the delta unclean."""
    drift = reduce(DataFrame.unionByName, [x.filter(F.col("outcome").startswith("drift")).select("outcome") for x in (memberships, assets)])
    return (drift.isEmpty(), assets.filter("outcome = 'new'").drop("outcome", "column"),
            memberships.filter("outcome = 'new'").drop("outcome", "closes_on"), memberships.filter("outcome = 'closure'").drop("outcome"))
