"""Stop-memory episodes: opened by a stop or a block, released by a reentry or by leaving the ranking.

The fold over an asset's days has a closed form. Every day with an event leaves the asset open or
closed whatever it was before: a stop opens it (a reentry the same day closes it again), a reentry
or an unranked day closes it, a block alone leaves it open. So the state before a day is a ``lag``
over the asset's event days, and no Python fold is needed. Events are first reduced to one row per
(run, asset, day); a window group then holds at most one row per calendar day, however skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_unranked(events: DataFrame, covered: DataFrame, dates: DataFrame, run: Sequence[str], asset: str, day: str) -> DataFrame:
    """(run, asset, day): the event days that are ranking days without the asset, and the first such day after each.

    Ranking days are numbered per run and an asset's days are cut into stretches of successive
    numbers, so the first day without it is the one after a stretch: one row per event, never one
    per asset and ranking day. ``covered`` holds the asset's days on which it counts as ranked.
    """
    run = list(run)
    numbers = dates.withColumn("_n", F.row_number().over(Window.partitionBy(*run).orderBy(day)))
    days = numbers.select(*run, day, F.lit(1).alias("_c")).unionByName(events.select(*run, day).distinct().withColumn("_c", F.lit(0)))
    days = days.groupBy(*run, day).agg(F.max("_c").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*run).orderBy(day))
    days = days.withColumn("_next", upto + 1)
    own = covered.join(numbers, [*run, day]).withColumn("_island", F.col("_n") - F.row_number().over(Window.partitionBy(*run, asset).orderBy("_n")))
    own = own.withColumn("_end", F.max("_n").over(Window.partitionBy(*run, asset, "_island")))
    e = events.select(*run, asset, day).distinct().join(days, [*run, day])
    after = e.join(own.select(*run, asset, F.col("_n").alias("_next"), "_end"), [*run, asset, "_next"], "left")
    after = after.select(*run, asset, F.coalesce(F.col("_end") + 1, "_next").alias("_n")).join(numbers, [*run, "_n"]).select(*run, asset, day)
    same = e.filter("_c = 1").select(*run, asset, day).join(covered, [*run, asset, day], "left_anti")
    return after.unionByName(same).distinct()


def day_flags(stops: DataFrame, blocked: DataFrame, reentry: DataFrame, rankings: DataFrame,
              run: Sequence[str] = (), asset: str = "asset_id", day: str = "date", opened: DataFrame | None = None) -> DataFrame:
    """(run, asset, day, s, b, r, u): stop, block, reentry, and ranking day without the asset.

    Of the ranking days without an asset only those are given that can close an episode: event days,
    and the first one after each. ``opened`` names assets that were open before these events, and since when.
    """
    keys = [*run, asset, day]
    ranked = rankings.select(*keys).distinct()
    dates = rankings.select(*run, day).distinct()
    blocks = blocked.select(*keys).distinct().join(dates, [*run, day], "left_semi")
    events = stops.select(*keys).unionByName(blocks).unionByName(reentry.select(*keys))
    if opened is not None:
        events = events.unionByName(opened.select(*run, asset, F.col("since").alias(day)))
    unranked = first_unranked(events, ranked.unionByName(blocks).distinct(), dates, run, asset, day)

    def mark(df, flag):
        return df.select(*keys).withColumn("_f", F.lit(flag))

    flags = mark(stops, "s").unionByName(mark(blocks, "b")).unionByName(mark(reentry, "r")).unionByName(mark(unranked, "u"))
    has = lambda f: F.max(F.col("_f") == f).alias(f)
    return flags.groupBy(*keys).agg(has("s"), has("b"), has("r"), has("u"))


def episodes(stops: DataFrame, blocked: DataFrame, reentry: DataFrame, rankings: DataFrame,
             run: Sequence[str] = (), asset: str = "asset_id", day: str = "date") -> DataFrame:
    """One row per episode: since, start_kind, released (NULL if still open) and cause.

    A reentry counts from the start day on, an unranked day only after it, both before the next
    start; a tie goes to ``not_ranked``.
    """
    return fold(day_flags(stops, blocked, reentry, rankings, run, asset, day), [*run, asset], day)


def fold(flags: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """Episodes of day flags (one row per keys and day)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(day)
    state = F.when(F.col("s"), ~F.col("r")).when(F.col("r") | F.col("u"), False).otherwise(True)
    rows = flags.withColumn("_open", state)
    rows = rows.withColumn("_before", F.coalesce(F.lag("_open").over(w), F.lit(False)))
    kind = F.when(F.col("s"), "stop").when(F.col("b") & ~F.col("_before"), "decision_close")
    rows = rows.withColumn("_kind", kind)
    rows = rows.withColumn("_since", F.last(F.when(F.col("_kind").isNotNull(), F.col(day)), ignorenulls=True).over(w))
    cause = F.when(F.col("u") & (F.col(day) > F.col("_since")), "not_ranked").when(F.col("r"), "price")
    hit = F.when(cause.isNotNull(), F.struct(F.col(day).alias("released"), cause.alias("cause")))
    out = rows.filter("_since IS NOT NULL").groupBy(*keys, F.col("_since").alias("since")).agg(
        F.max("_kind").alias("start_kind"), F.min(hit).alias("_hit"))
    return out.select(*keys, "since", "start_kind", F.col("_hit.released").alias("released"), F.col("_hit.cause").alias("cause"))


def overlapping_episodes(eps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Episodes still open, or released on or after the start, when the next one starts."""
    w = Window.partitionBy(*keys).orderBy("since")
    nxt = eps.withColumn("next_since", F.lead("since").over(w))
    return nxt.filter(F.col("next_since").isNotNull() & (F.col("released").isNull() | (F.col("released") >= F.col("next_since"))))


def orphan_reentries(reentry: DataFrame, eps: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """Reentries that fall in no episode; each is looked up in the latest episode starting by then."""
    from pitframe.operators.temporal import asof_join
    e = eps.select(*keys, F.col("since").alias("_s"), F.col("released").alias("_r"))
    rows = asof_join(reentry.select(*keys, day).distinct(), e, keys, day, "_s")
    return rows.filter(F.col("_s").isNull() | (F.col("_r") < F.col(day))).select(*keys, day)


def memory_control(eps: DataFrame, blocked: DataFrame, dates: DataFrame, run: Sequence[str], asset: str = "asset_id", day: str = "date") -> DataFrame:
    """Per decision day, memory must split exactly into price releases, ranking releases and blocks.

    Returns the (run, asset, day) rows that are missing, extra or in two parts.
    """
    from pitframe.operators.temporal import interval_join
    keys = [*run, asset]
    days = dates.select(*run, day).distinct()
    spans = eps.select(*keys, "since", "released", "cause")
    active = interval_join(days, spans, day, "since", "released", on=run).select(*keys, day).distinct().withColumn("part", F.lit("active"))
    release = spans.filter("released IS NOT NULL").select(*keys, F.col("released").alias(day), F.col("cause").alias("part")).join(days, [*run, day], "left_semi")
    block = blocked.select(*keys, day).distinct().join(days, [*run, day], "left_semi").withColumn("part", F.lit("blocked"))
    every = active.unionByName(release.select(*keys, day, "part").distinct()).unionByName(block.select(*keys, day, "part"))
    held = every.groupBy(*keys, day).agg(F.max(F.col("part") == "active").alias("_a"), F.count(F.when(F.col("part") != "active", 1)).alias("_n"))
    why = F.when(F.col("_n") > 1, "overlap").when(F.col("_a") & (F.col("_n") == 0), "missing").when(~F.col("_a"), "extra")
    return held.withColumn("problem", why).filter("problem IS NOT NULL").drop("_a", "_n")
