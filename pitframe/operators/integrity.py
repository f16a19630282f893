"""Referential checks, exactly-one matches and set comparison; each returns its violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows with no parent row."""
    return child.join(parent.select(*on).distinct(), list(on), "left_anti")


def assert_fk(
    child: DataFrame, parent: DataFrame, on: Sequence[str], agree: Sequence[str] = ()
) -> DataFrame:
    """Orphan children, and children whose ``agree`` columns differ from their parent's.

    The parent is keyed by ``on``. Result: the child's columns plus ``violation``.
    """
    on, agree = list(on), list(agree)
    p = parent.select(*on, *[F.col(c).alias(f"_p_{c}") for c in agree]).withColumn("_hit", F.lit(True))
    joined = child.join(p, on, "left")
    differs = [F.when(~_same(c, f"_p_{c}"), F.lit(c)) for c in agree]
    named = F.concat_ws(",", *differs) if differs else F.lit("")
    found = F.when(F.col("_hit").isNull(), "orphan").when(named != "", F.concat(F.lit("disagrees: "), named))
    return joined.withColumn("violation", found).filter(F.col("violation").isNotNull()).select(
        *child.columns, "violation"
    )


def match_one(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows matched by a number of ``other`` rows that is not one, with that number."""
    on = list(on)
    counts = other.groupBy(*on).agg(F.count(F.lit(1)).alias("matches"))
    return df.join(counts, on, "left").withColumn("matches", F.coalesce("matches", F.lit(0))).filter("matches <> 1")


def anti(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with no partner."""
    return df.join(other.select(*on), list(on), "left_anti")


def existing(df: DataFrame, stored: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key the store already holds."""
    return df.join(stored.select(*on), list(on), "left_semi")


def assert_subset(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of one side missing on the other, with the side that lacks them."""
    on = list(on)
    left, right = a.select(*on).distinct(), b.select(*on).distinct()
    return left.join(right, on, "left_anti").withColumn("missing_in", F.lit("right")).unionByName(
        right.join(left, on, "left_anti").withColumn("missing_in", F.lit("left"))
    )


def array_fk(df: DataFrame, arr: str, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Elements of an array of structs that have no parent row."""
    rows = df.withColumn("_e", F.explode(arr))
    flat = rows.select(*[c for c in df.columns if c != arr], *[F.col(f"_e.{c}").alias(c) for c in on])
    return orphans(flat, parent, on)


def ambiguous_keys(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys carrying more than one distinct value."""
    distinct = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    return distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values")).filter("n_values > 1")


def match_fills(fills: DataFrame, actions: DataFrame, on: Sequence[str], buyer: str) -> DataFrame:
    """Fills without an action, or whose buyer is not the action's."""
    return assert_fk(fills, actions, on, [buyer])


def count_agreement(details: DataFrame, totals: DataFrame, on: Sequence[str], total: str) -> DataFrame:
    """Keys whose number of detail rows differs from the stated total."""
    on = list(on)
    n = details.groupBy(*on).agg(F.count(F.lit(1)).alias("counted"))
    both = n.join(totals.select(*on, F.col(total).alias("stated")), on, "full_outer")
    both = both.fillna(0, ["counted", "stated"])
    return both.filter("counted <> stated")


def dup_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row of a repeated key (keys with a NULL part are exempt), with its number of copies.

    Counted by a partial aggregate and joined back, so copies of one key stay spread over tasks.
    """
    columns = list(columns)
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    again = keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return keyed.join(again, columns, "inner")


def single_valued(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its number of distinct values and whether that is one."""
    wide = df.agg(*[F.countDistinct(c).alias(c) for c in columns])
    stacked = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values")) for c in columns])
    return wide.select(F.inline(stacked)).withColumn("ok", F.col("n_values") == 1)


def set_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys found on one side only."""
    keys = list(keys)
    tagged = a.select(*keys).withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        b.select(*keys).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    )
    sides = tagged.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b")).filter("_a <> _b")
    return sides.select(*keys, F.when(F.col("_a") == 1, "left").otherwise("right").alias("only_in"))


def set_equal(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: whether both sides hold the same distinct keys, with the counts of each excess."""
    return set_diff(a, b, keys).agg(
        F.count(F.when(F.col("only_in") == "left", 1)).alias("only_left"),
        F.count(F.when(F.col("only_in") == "right", 1)).alias("only_right"),
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def bag_diff(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose number of copies differs between two tables: (row, n_left, n_right)."""
    columns = list(columns)
    tagged = a.select(*columns).withColumn("_s", F.lit(1)).unionByName(b.select(*columns).withColumn("_s", F.lit(0)))
    counts = tagged.groupBy(*columns).agg(
        F.sum("_s").alias("n_left"), F.sum(F.lit(1) - F.col("_s")).alias("n_right")
    )
    return counts.filter("n_left <> n_right")


def dup_targets(df: DataFrame, target: str, source: str) -> DataFrame:
    """Targets claimed by more than one source."""
    return ambiguous_keys(df, [target], source)


def compare_runs(a: DataFrame, b: DataFrame, on: Sequence[str], value: str,
                 names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Two configurations side by side on shared keys, with the ratio of their values."""
    left, right = (f"{value}_{n}" for n in names)
    pair = a.select(*on, F.col(value).alias(left)).join(b.select(*on, F.col(value).alias(right)), list(on))
    return pair.withColumn("ratio", F.try_divide(F.col(left), F.col(right)))


def describe_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys whose values differ between two keyed tables, both values shown."""
    keys = list(keys)
    left = a.select(*keys, F.col(value).alias("left_value"))
    right = b.select(*keys, F.col(value).alias("right_value"))
    return left.join(right, keys, "full_outer").filter(~_same("left_value", "right_value"))


def filter_run(views: dict[str, DataFrame], book_id: int, book_code: str, window: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rows of one book of a run database, and the removals counted per view and reason.

    Kept: the book, its actions except disabled ones, the alerts with a kept action, its daily
    rows, and the tests that pair the book's arm with the base arm.
    """
    b, kept, tagged = F.lit(book_id), {}, {}
    book = views["v_book"]
    tagged["v_book"] = book.withColumn("removed", F.when(
        ~((F.col("book_id") == b) & (F.col("arm_code") == book_code) & (F.col("window_id") == window)), "other book"))
    actions = views["v_guard_action"]
    tagged["v_guard_action"] = actions.withColumn(
        "removed", F.when(F.col("book_id") != b, "other book").when(F.col("status") == "ARM_DISABLED", "arm disabled"))
    live = tagged["v_guard_action"].filter("removed IS NULL").select("alert_id").distinct().withColumn("_live", F.lit(True))
    tagged["v_guard_alert"] = views["v_guard_alert"].join(live, "alert_id", "left").withColumn(
        "removed", F.when(F.col("_live").isNull(), "no kept action")).drop("_live")
    for name in ("v_book_rebalance", "v_book_weight_daily", "v_book_daily_performance", "v_portfolio_period_summary"):
        if name in views:
            tagged[name] = views[name].withColumn("removed", F.when(F.col("book_id") != b, "other book"))
    if "v_backtest_test" in views:
        pair = F.array_sort(F.array("arm_a", "arm_b"))
        want = F.array(*[F.lit(x) for x in sorted((book_code, "MARKOWITZ_BASE"))])
        tagged["v_backtest_test"] = views["v_backtest_test"].withColumn("removed", F.when(pair != want, "other pair"))
    removals = None
    for name, df in tagged.items():
        kept[name] = df.filter("removed IS NULL").drop("removed")
        part = df.filter("removed IS NOT NULL").groupBy("removed").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("view"), F.col("removed").alias("reason"), "rows")
        removals = part if removals is None else removals.unionByName(part)
    return kept, removals


def decision_index(dates: DataFrame, cycles: DataFrame, rankings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each decision date with its one completed cycle and the ids selected there, one row per id.

    ``dates``: (date); ``cycles``: (cycle_run_id, as_of, status); ``rankings``: (cycle_run_id,
    asset_id, selected). Second result: dates with no completed cycle or several.
    """
    done = cycles.filter("status = 'completed'").select("cycle_run_id", F.col("as_of").alias("date"))
    per = dates.select("date").distinct().join(done, "date", "left").groupBy("date").agg(
        F.count("cycle_run_id").alias("cycles"), F.min("cycle_run_id").alias("cycle_run_id"))
    one = per.filter("cycles = 1").select("date", "cycle_run_id")
    picked = rankings.filter(F.col("selected").cast("boolean")).select("cycle_run_id", "asset_id").distinct()
    return one.join(picked, "cycle_run_id", "left"), per.filter("cycles <> 1").select("date", "cycles")
