"""Aggregates of books and holdings. Every one is a plain partial + final aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.operators.temporal import interval_join


def run_inventory(df: DataFrame, keys: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """Rows and distinct values per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[F.countDistinct(c).alias(f"n_{c}") for c in distinct])


def spans(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Earliest start and latest end per group."""
    return df.groupBy(*keys).agg(F.min(start).alias("first_day"), F.max(end).alias("last_day"))


def listagg(df: DataFrame, keys: Sequence[str], column: str, out: str = "listed", sep: str = ", ") -> DataFrame:
    """Distinct values of a group as one sorted text; values are made distinct before they meet."""
    once = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
    return once.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(column)), sep).alias(out))


def alerts_by_month(df: DataFrame, keys: Sequence[str], day: str, ident: str) -> DataFrame:
    """Distinct ids per group and calendar month."""
    month = F.date_format(F.col(day), "yyyy-MM").alias("month")
    return df.groupBy(*keys, month).agg(F.countDistinct(ident).alias("alerts"))


def counts_by(df: DataFrame, keys: Sequence[str], distinct: str | None = None, out: str = "cuts") -> DataFrame:
    """Rows, or distinct ids, per group."""
    n = F.count(F.lit(1)) if distinct is None else F.countDistinct(distinct)
    return df.groupBy(*keys).agg(n.alias(out))


def weighted_profile(df: DataFrame, weight: str, values: Sequence[str], keys: Sequence[str], ident: str) -> DataFrame:
    """Weighted means, covered weight and distinct positions per group."""
    w = F.col(weight)
    total = F.sum(w).cast("double")  # sums stay exact; only the mean is a double
    means = [F.try_divide(F.sum(w * F.col(v)).cast("double"), total).alias(f"weighted_{v}") for v in values]
    return df.groupBy(*keys).agg(*means, F.sum(w).alias("covered_weight"), F.countDistinct(ident).alias("positions"))


def concentration(df: DataFrame, weight: str, keys: Sequence[str], ident: str) -> DataFrame:
    """Herfindahl index and effective number of positions per group."""
    square = F.col(weight) * F.col(weight)
    kind = df.select(F.sum(square).alias("x")).schema["x"].dataType
    per = df.groupBy(*keys, ident).agg(F.sum(square).alias("_hhi"))  # what countDistinct does, without holding the groups twice more
    return per.groupBy(*keys).agg(F.count(ident).alias("positions"), F.sum("_hhi").cast(kind).alias("hhi")).withColumn(
        "effective_positions", F.try_divide(F.lit(1.0), F.col("hhi").cast("double")))


def sector_weights(df: DataFrame, weight: str, keys: Sequence[str], bucket: str, holding: str, cash: str = "CASH") -> DataFrame:
    """Weight per bucket, the group's cash weight as a column; the cash row is in no bucket."""
    cash_of = df.filter(F.col(holding) == cash).groupBy(*keys).agg(F.max(weight).alias("cash"))
    held = df.filter((F.col(holding) != cash) & (F.col(weight) > 0)).groupBy(*keys, bucket).agg(F.sum(weight).alias("weight"))
    return held.join(cash_of, list(keys), "left")


def coverage(holders: DataFrame, key: str, parts: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct ids of each related table per holder; each side is counted before it is joined."""
    out = holders.select(key).distinct()
    for name, df in parts.items():
        n = df.groupBy(key).agg(F.countDistinct("ident").alias(name))
        out = out.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def veto_concentration(df: DataFrame, keys: Sequence[str], ident: str, score: str, flag: str) -> DataFrame:
    """Distinct vetoes, mean score and flagged scores per group."""
    return df.groupBy(*keys).agg(F.countDistinct(ident).alias("vetoes"), F.avg(score).alias("average_score"),
                                 F.sum(F.when(F.coalesce(F.col(flag), F.lit(False)), 1).otherwise(0)).alias("flagged"))


def exposure(df: DataFrame, keys: Sequence[str], weight: str, ident: str) -> DataFrame:
    """Total weight and distinct names per group."""
    return df.groupBy(*keys).agg(F.sum(weight).alias("weight"), F.countDistinct(ident).alias("names"))


def stop_outcomes(df: DataFrame, keys: Sequence[str], cash: str) -> DataFrame:
    """Stops and cash stops per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("stops"), F.sum(F.coalesce(F.col(cash), F.lit(False)).cast("int")).alias("cash_stops"))


def widen_metrics(metrics: DataFrame, names: Sequence[str], ident: str = "filing_id", name: str = "metric_name",
                  value: str = "value", computed: str = "computed_at", reserved: str = "value_inputs") -> DataFrame:
    """One row per id with a column per metric and the latest computation time.

    Conditional aggregates instead of a pivot: the names are known, so one aggregate does it.
    """
    usable = F.col(value).isNotNull() & (F.col(name) != reserved)
    picks = [F.max(F.when(usable & (F.col(name) == n), F.col(value))).alias(n) for n in names]
    text = F.col(computed).cast("string")
    latest = F.max_by(text, F.struct(text.try_cast("timestamp"), text)).alias(computed)
    return metrics.groupBy(ident).agg(latest, *picks)


def metric_stats(metrics: DataFrame, assessments: DataFrame) -> DataFrame:
    """Null and non-null metric rows, generated and rule assessments, texts held: (stat, value)."""
    m = metrics.agg(F.count(F.when(F.col("value").isNull(), 1)).alias("metrics_null"), F.count("value").alias("metrics_non_null"))
    a = assessments.agg(F.count(F.when(F.col("generated"), 1)).alias("generated"), F.count(F.when(~F.col("generated"), 1)).alias("by_rule"),
                        F.sum(F.size("strengths")).alias("strengths"), F.sum(F.size("risks")).alias("risks"))
    def long(df):
        return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).cast("bigint").alias("value")) for c in df.columns])))
    return long(m).unionByName(long(a))


def applied_in_range(summaries: DataFrame, actions: DataFrame, on: Sequence[str], start: str, end: str, day: str) -> DataFrame:
    """Actions decided inside each summary's inclusive date range.

    Actions are counted per (key, day) first, so a hot key carries at most one row per day.
    """
    per_day = actions.groupBy(*on, F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    ranges = summaries.select(*on, F.col(start).alias("_f"), F.col(end).alias("_t")).distinct()
    hit = interval_join(per_day, ranges, "_day", "_f", "_t", on=on).groupBy(*on, "_f", "_t").agg(F.sum("_n").alias("applied"))
    hit = hit.withColumnRenamed("_f", start).withColumnRenamed("_t", end)
    return summaries.join(hit, [*on, start, end], "left").withColumn("applied", F.coalesce("applied", F.lit(0)))


def unclassified_by_year(members: DataFrame, classified: DataFrame, funds: DataFrame, asset: str = "asset", end: str = "valid_to") -> DataFrame:
    """Distinct assets without industry that are no fund, by the year they left."""
    left = members.filter(F.col(end).isNotNull()).join(classified.select(asset), asset, "left_anti").join(funds.select(asset), asset, "left_anti")
    return left.groupBy(F.year(end).alias("year")).agg(F.countDistinct(asset).alias("unclassified_assets"))


def one_sample(df: DataFrame, keys: Sequence[str], value: str, out: str = "sample") -> DataFrame:
    """One value per group, always the smallest."""
    return df.groupBy(*keys).agg(F.min(value).alias(out))


def weighted_score(scores: DataFrame, weights: DataFrame, keys: Sequence[str], metric: str = "metric") -> DataFrame:
    """Sum of weights times components; an inverted metric counts ``1 - n``, another ``(raw + 1) / 2``."""
    part = F.when(F.col("inverted"), F.lit(1) - F.col("normalized")).otherwise((F.col("raw") + 1) / 2)
    return scores.join(weights, metric).groupBy(*keys).agg(F.sum(F.col("weight") * part).alias("score"))


def freshness(stints: DataFrame, cik: str = "cik", start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Latest recorded change, open and closed stints, open stints without an id."""
    is_open = F.col(end).isNull()
    return stints.agg(F.max(F.greatest(start, end)).alias("latest_change"), F.count(F.when(is_open, 1)).alias("open_stints"),
                      F.count(F.when(~is_open, 1)).alias("closed_stints"),
                      F.count(F.when(is_open & F.col(cik).isNull(), 1)).alias("open_without_id"))


def rank_in(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None = None, out: str = "position") -> DataFrame:
    """Position in a group under a full tie-break; with ``n`` only the first n.

    Spark prunes each task to n rows per group before the shuffle when n is given.
    """
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked if n is None else ranked.filter(F.col(out) <= n)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of a total order."""
    return df.orderBy(*order).limit(k)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first n rows by key: a validation sample that is the same on every run."""
    return df.orderBy(*keys).limit(n)


def segment_identity(df: DataFrame, keys: Sequence[str], parent: str, segment: str, start: str, end: str, sums: Sequence[str]) -> DataFrame:
    """Segments of a parent must follow each other day by day and add up to it: violations.

    A parent's own row is the one whose segment equals the parent. Segments per parent are few by
    definition, so the window groups are bounded.
    """
    parts = df.filter(F.col(segment) != F.col(parent))
    w = Window.partitionBy(*keys, parent).orderBy(start)
    gaps = parts.withColumn("_next", F.lead(start).over(w)).filter(F.col("_next").isNotNull() & (F.col("_next") != F.date_add(end, 1)))
    gaps = gaps.select(*keys, parent, F.concat(F.lit("gap after "), F.col(segment)).alias("violation"))
    total = parts.groupBy(*keys, parent).agg(F.min(start).alias("_s"), F.max(end).alias("_e"), *[F.sum(c).alias(f"_{c}") for c in sums])
    whole = df.filter(F.col(segment) == F.col(parent)).join(total, [*keys, parent])
    off = F.concat_ws(",", F.when(F.col(start) != F.col("_s"), F.lit(start)), F.when(F.col(end) != F.col("_e"), F.lit(end)),
                      *[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in sums])
    wrong = whole.withColumn("_off", off).filter("_off <> ''").select(*keys, parent, F.concat(F.lit("differs: "), F.col("_off")).alias("violation"))
    return gaps.unionByName(wrong)


def timeline(parts: Mapping[str, DataFrame], kind: str = "event") -> DataFrame:
    """Union of event tables, each tagged with its kind; missing columns are NULL."""
    tagged = [df.withColumn(kind, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
