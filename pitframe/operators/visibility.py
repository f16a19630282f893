"""Which score rows may be written on a run day, and why the others wait or are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.functions.scalars import TICKER, quarter_label

# Lanes written by quarter of availability; lanes that need a raw value.
DATA_DATED = ("FUNDAMENTAL",)
RAW_REQUIRED = ("FUNDAMENTAL", "SECTOR")
# Score lane -> metric type.
LANES = {
    "FUNDAMENTAL": "ScoreFinanciero",
    "VALORIZATION": "ScoreCuantitativo",
    "TECHNICAL": "ScoreTecnico",
    "SECTOR": "SectorRelativeMomentum",
}
FULL_FORMS = ("10-K", "10-Q")
SCOPE_KEYS = ("forms", "limit", "since_year", "tickers", "until_year")


def parsed_runs(runs: DataFrame) -> DataFrame:
    """Runs with their scope read from ``params_json`` and ``full`` = read every filing of its years."""
    raw = lambda k: F.get_json_object("params_json", f"$.{k}")
    keys = F.json_object_keys("params_json")
    has_all = F.size(F.array_intersect(keys, F.array(*[F.lit(k) for k in SCOPE_KEYS]))) == len(SCOPE_KEYS)
    forms = F.from_json(raw("forms"), "array<string>")
    full = (
        (F.col("status") == "completed") & has_all & raw("tickers").isNull() & raw("limit").isNull()
        & (F.col("completed_units").isNull() | (F.col("completed_units") > 0))
        & F.coalesce(F.size(F.array_intersect(forms, F.array(*[F.lit(x) for x in FULL_FORMS]))) == len(FULL_FORMS), F.lit(False)))
    bound = lambda k: F.when(raw(k).isNull() | raw(k).rlike(r"^-?\d+$"), raw(k).try_cast("int"))
    readable = lambda k: raw(k).isNull() | raw(k).rlike(r"^-?\d+$")
    return runs.select("run_id", F.col("as_of").cast("date").alias("as_of"), F.coalesce(full & readable("since_year") & readable("until_year"), F.lit(False)).alias("full"),
                       bound("since_year").alias("since_year"), bound("until_year").alias("until_year"))


def covered_quarters(quarters: DataFrame, runs: DataFrame, run_day) -> DataFrame:
    """Quarters (``year``, ``quarter``) some full run as of a later quarter, no later than the run day, read.

    Runs are reduced to the latest one per (since, until) scope before the join, and quarters are
    joined to scopes on the years each scope spans, so neither side is compared row by row.
    """
    index = lambda d: F.year(d) * 4 + F.quarter(d)
    full = parsed_runs(runs).filter(F.col("full") & (F.col("as_of") <= F.lit(run_day).cast("date")))
    scopes = full.groupBy("since_year", "until_year").agg(F.max(index(F.col("as_of"))).alias("latest"))
    lo, hi = quarters.agg(F.min("year")).scalar(), quarters.agg(F.max("year")).scalar()
    spans = scopes.select("latest", F.greatest(F.coalesce("since_year", lo), lo).alias("a"), F.least(F.coalesce("until_year", hi), hi).alias("b"))
    years = spans.filter("a <= b").select("latest", F.explode(F.sequence("a", "b")).alias("year")).groupBy("year").agg(F.max("latest").alias("latest"))
    return quarters.select("year", "quarter").distinct().join(years, "year").filter(
        F.col("latest") > F.col("year") * 4 + F.col("quarter")).select("year", "quarter")


def classify_visibility(scores: DataFrame, assets: DataFrame, runs: DataFrame, run_day) -> DataFrame:
    """Each row with ``outcome`` (project, skip, defer) and the first ``reason`` that applies."""
    day = F.lit(run_day).cast("date")
    known = assets.select(F.col("ticker")).distinct().withColumn("_asset", F.lit(True))
    rows = scores.withColumn("_av", F.col("available_at").cast("date"))
    rows = rows.withColumn("year", F.year("_av")).withColumn("quarter", F.quarter("_av"))
    dated = rows.filter(F.col("score_type").isin(*DATA_DATED) & F.col("_av").isNotNull())
    covered = covered_quarters(dated, runs, run_day).withColumn("_cov", F.lit(True))
    rows = rows.join(known, "ticker", "left").join(covered, ["year", "quarter"], "left")
    needed = F.when(F.col("score_type").isin(*RAW_REQUIRED), F.col("raw_value")).otherwise(F.col("normalized_score"))
    data_dated = F.col("score_type").isin(*DATA_DATED)
    reason = (
        F.when(~F.col("score_type").isin(*LANES), "unknown lane")
        .when(~F.col("ticker").rlike(TICKER), "bad ticker")
        .when(F.col("_asset").isNull(), "not an asset")
        .when(F.col("_av").isNull(), "no availability")
        .when(needed.isNull(), "no value")
        .when(F.col("_av") > day, "not available yet")
        .when(data_dated & (quarter_label(F.col("_av")) >= quarter_label(day)), "quarter open")
        .when(data_dated & F.col("_cov").isNull(), "quarter not covered"))
    waits = ("not available yet", "quarter open", "quarter not covered")
    outcome = F.when(F.col("reason").isNull(), "project").when(F.col("reason").isin(*waits), "defer").when(
        F.col("reason") == "unknown lane", "stop").otherwise("skip")
    return rows.withColumn("reason", reason).withColumn("outcome", outcome).select(*scores.columns, "outcome", "reason")


def published_counts(rows: DataFrame) -> DataFrame:
    """Rows per outcome and reason."""
    return rows.groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("rows"))
