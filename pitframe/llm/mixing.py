"""Mixing sources to target weights by subset-sum budget fitting.

Counts of documents by exact length decide how many documents of each length a source gives; a
bounded-knapsack dynamic programme fits what is left of the budget; seeded hashes then choose the
documents. Texts are never moved: the choice is made on (id, hash, source, size).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitframe.llm.common import WORD, row_key, stored, text_hash

SHARE = 1.5  # the mix is this share of all words
REPEATS = 2  # no document, and so no source, gives more than this many times its size
WEIGHTS = (5, 2, 1)
BUDGET = 1 << 15  # words that the dynamic programme fits; whole documents go before it
CHUNK = 512  # documents of one source and length that are ranked together


def word_count(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): water filling in closed form.

    Sources by code point, null last, take the weights in turn. With sources ordered by cap / weight,
    those below the level are full; the level is what remains over the remaining weight at the first
    source it doesn't fill. One row per source; a total of zero gives targets of zero.
    """
    every = F.array(*[F.lit(float(w)) for w in weights])
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    x = sizes.withColumn("w", F.element_at(every, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    x = x.withColumn("cap", repeats * F.col("source_size").cast("double"))
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    x = x.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    x = x.withColumn("rest", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    x = x.withColumn("level", (F.lit(share) * F.sum("source_size").over(whole) - F.col("full")) / F.col("rest"))
    fits = F.col("level") * F.col("w") <= F.col("cap")
    level = F.min(F.when(fits, F.struct((F.col("cap") / F.col("w")).alias("r"), F.col("source").isNull().alias("s0"), F.col("source").alias("s1"), F.col("level").alias("level")))).over(whole)
    return x.select("source", "source_size", F.least(F.col("cap"), F.coalesce(level["level"], F.lit(0.0)) * F.col("w")).alias("target"))


def reachable(lengths: Sequence[int], counts: Sequence[int], budget: int) -> dict[int, int]:
    """Documents by length whose sizes sum as near as possible to ``budget``; of two equal, the smaller sum.

    Bounded knapsack: a bit set holds the sums that can be reached, counts are split into powers of
    two, and the sets before each item lead back from the best sum to the items. Sums beyond twice
    the budget are no nearer than none.
    """
    mask, sums, steps = (1 << (2 * budget + 1)) - 1, 1, []
    for n, c in zip(lengths, counts, strict=True):
        c, k = min(c, 2 * budget // n), 1
        while c > 0 and not sums >> budget & 1:
            k = min(k, c)
            steps.append((n, k, sums))
            sums |= (sums << (n * k)) & mask
            c, k = c - k, 2 * k
    under = (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1
    over = sums >> (budget + 1)
    above = budget + (over & -over).bit_length()
    best, taken = above if over and above - budget < budget - under else under, {}
    for n, k, had in reversed(steps):
        if not had >> best & 1:
            taken[n] = taken.get(n, 0) + k
            best -= n * k
    return taken


def plan_source(lengths: np.ndarray, counts: np.ndarray, budget: int, fit: int = BUDGET) -> np.ndarray:
    """Documents to take of each length (ascending, positive) so that words come near the budget.

    First the same share of every length, rounded down; then single documents, longest first, while
    more than ``fit`` words are left; then the dynamic programme over what is left of each length.
    """
    total = int((lengths * counts).sum())
    budget = min(budget, total)
    take = counts * budget // max(total, 1) if total < 1 << 31 else np.array([int(c) * budget // total for c in counts.tolist()])
    left = budget - int((lengths * take).sum())
    for i in range(len(lengths) - 1, -1, -1):
        if left <= fit:
            break
        more = min(int(counts[i] - take[i]), (left - fit // 2) // int(lengths[i]))
        if more > 0:
            take[i] += more
            left -= more * int(lengths[i])
    spare = counts - take
    ok = (spare > 0) & (lengths <= 2 * left)
    at = {int(n): i for i, n in enumerate(lengths)}
    for n, k in reachable(lengths[ok].tolist(), spare[ok].tolist(), left).items():
        take[at[n]] += k
    return take


def picks(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[float], share: float, repeats: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, goals by source, chosen rows): what ``mix`` and ``mixed_rows`` put together."""
    u = F.pmod(F.xxhash64(F.lit(seed), id_col, text_hash(text_col)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = stored(docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), u.alias("u")))
    hist = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    goal = targets(hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, repeats)
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("base", base).withColumn("budget", F.round(F.col("target") - F.col("base") * F.col("source_size")).cast("long"))
    goal = stored(goal.select(F.col("source").alias("goal_source"), "source_size", "target", "base", "budget"))
    to_plan = hist.filter("size > 0").join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).select("source", "size", "n", "budget")

    def plan(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("size")
        x["pick"] = plan_source(x["size"].to_numpy(np.int64), x["n"].to_numpy(np.int64), int(x["budget"].iloc[0]))
        return x[["source", "size", "n", "pick"]]
    kind = docs.schema[source_col].dataType.simpleString()
    # a group is one source's distinct lengths: bounded by the longest document, not by the rows
    quota = stored(to_plan.groupBy("source").applyInPandas(plan, f"source {kind}, size long, n long, pick long").filter("pick > 0"))
    quota = quota.select(F.col("source").alias("s"), F.col("size").alias("z"), "pick", F.ceil(F.col("n") / CHUNK).alias("bins"))

    # each length's rows are ranked in bins of about CHUNK, cut by the seeded hash
    binned = rows.join(quota, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).select("id", "th", "source", "size", "u", "pick", F.floor(F.col("u") * F.col("bins")).alias("bin"))
    binned = stored(binned)
    per_bin = binned.groupBy("source", "size", "bin", "pick").agg(F.count("*").alias("c"))
    upto = F.coalesce(F.sum("c").over(W.partitionBy("source", "size").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    room = stored(per_bin.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("bin").alias("k"), F.least(F.col("pick") - upto, F.col("c")).alias("room")).filter("room > 0"))
    r = binned.join(room, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("bin") == F.col("k")))
    r = r.withColumn("rank", F.row_number().over(W.partitionBy("source", "size", "bin").orderBy("u", "id", "th")))
    chosen = r.filter("rank <= room").groupBy("id", "th", "source").agg(F.count("*").alias("picked"))
    return rows, goal, stored(chosen.select(F.col("id").alias("pick_id"), F.col("th").alias("pick_th"), F.col("source").alias("pick_source"), "picked"))


def with_times(rows: DataFrame, goal: DataFrame, chosen: DataFrame, id_col: str, th_col: str, source_col: str, size: Column) -> DataFrame:
    """``rows`` with the columns of ``goal`` and ``times``; of equal rows the first ``picked`` are the chosen ones."""
    some = F.broadcast(goal) if goal.count() <= 10_000 else goal  # one short row a source
    x = rows.join(some, rows[source_col].eqNullSafe(F.col("goal_source")))
    picked = chosen.select(*row_key(F.col("pick_id"), F.col("pick_th"), F.col("pick_source")), "picked")
    keys = [k for k in picked.columns if k != "picked"]
    x = x.select("*", *row_key(F.col(id_col), F.col(th_col), F.col(source_col))).join(picked, keys, "left")
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(keys[-1]))
    times = F.when(size == 0, 1).otherwise(F.col("base") + F.when(nth <= F.coalesce("picked", F.lit(0)), 1).otherwise(0))
    return x.withColumn("times", times.cast("long")).drop(*keys)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 42) -> DataFrame:
    """(id, th, source, size, source_size, target, times): how often the mix repeats each row.

    ``times`` is floor(target / source size) for all rows of a source and one more for the chosen
    ones, at most ``repeats``. A null source is a source; null texts have size zero; rows of size
    zero add no words and get ``times`` one. Repeated rows are chosen one by one and are alike, so
    which of them is chosen shows nowhere. An empty table gives no rows. Reruns agree.
    """
    rows, goal, chosen = picks(docs, id_col, text_col, source_col, weights, share, repeats, seed)
    return with_times(rows, goal, chosen, "id", "th", "source", F.col("size")).select("id", "th", "source", "size", "source_size", "target", "times")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 42) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix`` says, all columns as they were."""
    _, goal, chosen = picks(docs, id_col, text_col, source_col, weights, share, repeats, seed)
    own = {c: F.col(f"_own{i}").alias(c) for i, c in enumerate(docs.columns)}  # the caller's names can't clash
    kept = docs.select(*[F.col(f"`{c}`").alias(f"_own{i}") for i, c in enumerate(docs.columns)], text_hash(f"`{text_col}`").alias("_th"), word_count(text_col).alias("_size"))
    at = {c: f"_own{docs.columns.index(c)}" for c in (id_col, source_col)}
    x = with_times(kept, goal, chosen, at[id_col], "_th", at[source_col], F.col("_size")).filter("times > 0")
    return x.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(*own.values())
