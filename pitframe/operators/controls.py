"""Control totals of a run as long rows (configuration, window, key, subkey, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Closed vocabularies counted with zero fill.
ALERT_RULES = ("L0_CARTERA_ACTIVATION", "L0_CARTERA_RECOVERY", "L0_CARTERA_SCALE_CHANGE", "L1_BP_REENTRY", "L1_BP_STOP", "L1_BP_STOP_BLOCKED")
ACTION_STATUSES = ("APPLIED", "BLOCKED")
FINAL_VALUES = ("cumulative_return", "annualized_return", "annualized_vol", "max_drawdown", "total_turnover")
DESTINATIONS = ("cash", "spy", "stock")
CASH_CAUSES = ("FILTER_OFF", "NO_ALLOWED_DESTINATION", "NO_SIGNAL", "SCALE_BELOW_ONE")
NEWS_ACTIONS = ("promotion", "veto")


def zero_filled(df: DataFrame, keys: Sequence[str], column: str, vocabulary: Sequence[str], key: str, ident: str | None = None) -> DataFrame:
    """Counts of a closed vocabulary per run; an absent word counts zero.

    One conditional aggregate per word, so the words never need to be joined in.
    """
    def n(word):
        hit = F.col(column) == word
        return F.count(F.when(hit, 1)) if ident is None else F.countDistinct(F.when(hit, F.col(ident)))
    wide = df.groupBy(*keys).agg(*[n(w).alias(f"_{i}") for i, w in enumerate(vocabulary)])
    cells = [F.struct(F.lit(w).alias("subkey"), F.col(f"_{i}").cast("double").alias("value")) for i, w in enumerate(vocabulary)]
    return wide.select(*keys, F.lit(key).alias("key"), F.inline(F.array(*cells))).select(*keys, "key", "subkey", "value")


def scalars(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Named aggregates of one scan per run, as long rows with an empty subkey."""
    wide = df.groupBy(*keys).agg(*[v.cast("double").alias(n) for n, v in values.items()])
    cells = [F.struct(F.lit(n).alias("key"), F.lit("").alias("subkey"), F.col(n).alias("value")) for n in values]
    return wide.select(*keys, F.inline(F.array(*cells)))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def control_group1(views: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Alerts by rule through actions, actions by status, row counts, final values."""
    n = F.count(F.lit(1))
    acted = views["v_guard_action"].select(*keys, "alert_id").filter("alert_id IS NOT NULL").distinct()
    hit = views["v_guard_alert"].join(acted, [*keys, "alert_id"], "left_semi")
    parts = [
        zero_filled(hit, keys, "rule_id", ALERT_RULES, "alerts_by_rule", "alert_id"),
        zero_filled(views["v_guard_action"], keys, "status", ACTION_STATUSES, "actions_by_status"),
        scalars(views["v_book_rebalance"], keys, {"rebalances": n}),
        scalars(views["v_book_daily_performance"], keys, {"daily_rows": n}),
        scalars(views["v_book_weight_daily"], keys, {"weight_daily_rows": n}),
    ]
    s = views["v_portfolio_period_summary"]
    cells = [F.struct(F.lit("final_values").alias("key"), F.lit(c).alias("subkey"), F.col(c).cast("double").alias("value")) for c in FINAL_VALUES if c in s.columns]
    first = s.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in FINAL_VALUES if c in s.columns]), "segment").alias("_f"))
    parts.append(first.select(*keys, "_f.*").select(*keys, F.inline(F.array(*cells))))
    return _union(parts)


def destination_kind(chosen_cash: Column, chosen_asset: Column, is_spy: Column) -> Column:
    no = F.lit(False)
    return F.when(F.coalesce(chosen_cash, no) | chosen_asset.isNull(), "cash").when(F.coalesce(is_spy, no), "spy").otherwise("stock")


def control_group2(decisions: DataFrame, stops: DataFrame, episodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Decisions, stops by destination, cash by cause, menu options and summaries, memory episodes.

    ``stops`` carries chosen_cash, chosen_asset, chosen_is_spy, cause, menu (array) and
    eligible_counts (map).
    """
    n = F.count(F.lit(1))
    st = stops.withColumn("_dest", destination_kind(F.col("chosen_cash"), F.col("chosen_asset"), F.col("chosen_is_spy")))
    nonzero = F.exists(F.map_entries("eligible_counts"), lambda e: (e["key"] != "zone_evaluated") & (e["value"] != 0))
    return _union([
        scalars(decisions, keys, {"decision_events": n}),
        scalars(st, keys, {"stop_events": n, "destination_options": F.sum(F.coalesce(F.size("menu"), F.lit(0))),
                           "stop_rejection_summaries": F.count(F.when(F.coalesce(nonzero, F.lit(False)), 1))}),
        zero_filled(st, keys, "_dest", DESTINATIONS, "stops_by_destination"),
        zero_filled(st, keys, "cause", CASH_CAUSES, "stops_cash_by_cause"),
        scalars(episodes, keys, {"memory_episodes": n, "decision_close_episodes": F.count(F.when(F.col("start_kind") == "decision_close", 1)),
                                 "memory_released_price": F.count(F.when(F.col("cause") == "price", 1)),
                                 "memory_released_not_ranked": F.count(F.when(F.col("cause") == "not_ranked", 1)),
                                 "memory_open_at_end": F.count(F.when(F.col("released").isNull(), 1))}),
    ])


def nonzero_group2(group2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals that must be zero for the run without a hierarchy."""
    return group2.filter(F.coalesce("value", F.lit(0.0)) != 0)


def control_group3(retentions: DataFrame, keys: Sequence[str], causes: Sequence[str]) -> DataFrame:
    """Retention decisions, holds, rejections, drops, and rejections by cause (arrays per decision)."""
    size = lambda c: F.sum(F.coalesce(F.size(c), F.lit(0)))
    head = scalars(retentions, keys, {"retention_decisions": F.count(F.lit(1)), "retention_holds": size("retained"),
                                      "retention_rejections": size("rejected"), "retention_counter_drops": size("counter_dropped")})
    flat = retentions.select(*keys, F.explode_outer("rejected.cause").alias("cause"))
    return head.unionByName(zero_filled(flat, keys, "cause", causes, "retention_rejections_by_cause"))


def control_group4(rankings: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """Ranking decision dates and rows."""
    return scalars(rankings, keys, {"ranking_decisions": F.countDistinct(day), "ranking_rows": F.count(F.lit(1))})


def control_group5(manager: DataFrame, narrator: DataFrame, actions: DataFrame, levels: DataFrame, stops: DataFrame, bull: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Agent counters: calls, fallbacks, repairs, texts, news actions, levels, exits, rejections, bull."""
    n = F.count(F.lit(1))
    when = lambda c: F.count(F.when(F.coalesce(c, F.lit(False)), 1))
    return _union([
        scalars(manager, keys, {"manager_calls": n, "manager_fallbacks": F.count("fallback_cause"), "manager_repairs": when(F.col("repair_used"))}),
        scalars(narrator, keys, {"narrator_texts": n}),
        zero_filled(actions, keys, "action", NEWS_ACTIONS, "news_pool_actions"),
        scalars(levels, keys, {"news_date_records": n, "news_level_c_decisions": when(F.size("c_flagged") > 0), "news_level_d_decisions": when(F.col("d_fired"))}),
        scalars(stops, keys, {"news_exits": when(F.col("trigger") == "news_shock"),
                              "news_sector_rejections": F.sum(F.coalesce(F.try_element_at("eligible_counts", F.lit("news_sector")), F.lit(0)))}),
        scalars(bull, keys, {"bull_triggered": when(F.col("triggered"))}),
    ])


def control_group6(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Series rows per run and window."""
    return scalars(series, keys, {"series_rows": F.count(F.lit(1))})


def agent_counts(records: DataFrame, keys: Sequence[str], column: str = "json") -> DataFrame:
    """Fallbacks, repairs and triggers counted from raw JSON objects of different shapes."""
    raw = lambda p: F.get_json_object(column, f"$.{p}")
    return scalars(records, keys, {
        "records": F.count(F.lit(1)), "fallbacks": F.count(raw("fallback.cause")),
        "repairs": F.count(F.when(raw("repair_used") == "true", 1)), "triggered": F.count(F.when(raw("triggered") == "true", 1))})
