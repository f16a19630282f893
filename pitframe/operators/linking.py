"""Entity links: exact and fallback keys, unambiguous maps, company lines from stints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitframe.operators.temporal import overlap_join
from pitframe.session import cut_lineage

FAR = "9999-12-31"


def link_entity(
    df: DataFrame, symbol: str, cik: str, assets: DataFrame,
    asset: str = "asset", asset_symbol: str = "asset_symbol", asset_cik: str = "asset_cik",
) -> DataFrame:
    """Exact symbol wins, else the only asset with the row's CIK, else unlinked (``how`` says which)."""
    by_symbol = assets.filter(F.col(asset_symbol).isNotNull()).groupBy(F.col(asset_symbol).alias(symbol)).agg(
        F.min(asset).alias("_by_symbol"))
    by_cik = assets.filter(F.col(asset_cik).isNotNull()).groupBy(F.col(asset_cik).alias(cik)).agg(
        F.min(asset).alias("_by_cik"), F.count(F.lit(1)).alias("_owners")).filter("_owners = 1").drop("_owners")
    out = df.join(by_symbol, symbol, "left").join(by_cik, cik, "left")
    how = F.when(F.col("_by_symbol").isNotNull(), "symbol").when(F.col("_by_cik").isNotNull(), "cik").otherwise("none")
    return out.withColumn("how", how).withColumn(asset, F.coalesce("_by_symbol", "_by_cik")).select(*df.columns, asset, "how")


def unambiguous_map(df: DataFrame, keys: Sequence[str], value: str, key_out: str = "key") -> DataFrame:
    """Key to value over several key columns; a key seen with two values is left out."""
    arr = F.array(*[F.col(k).cast("string") for k in keys])
    flat = df.filter(F.col(value).isNotNull()).select(F.explode(arr).alias(key_out), F.col(value))
    flat = flat.filter(F.col(key_out).isNotNull() & (F.col(key_out) != ""))
    return flat.groupBy(key_out).agg(F.min(value).alias(value), F.max(value).alias("_hi")).filter(
        F.col(value) == F.col("_hi")).drop("_hi")


def link_by_cohort(df: DataFrame, ident: str, asset: str) -> DataFrame:
    """A row with no asset takes the one other rows of its id resolve to, if that is a single one."""
    one = df.filter(F.col(asset).isNotNull()).groupBy(ident).agg(
        F.min(asset).alias("_lo"), F.max(asset).alias("_hi")).filter("_lo = _hi").select(ident, F.col("_lo").alias("_one"))
    out = df.join(one, ident, "left")
    how = F.when(F.col(asset).isNotNull(), "own").when(F.col("_one").isNotNull(), "cohort").otherwise("none")
    return out.withColumn("cohort_how", how).withColumn(asset, F.coalesce(asset, "_one")).drop("_one")


def id_to_entity(df: DataFrame, ident: str, tickers: DataFrame, ticker: str, assets: DataFrame, asset: str) -> DataFrame:
    """Engine id to ticker to asset; an id with two tickers stays unlinked and is marked."""
    per = tickers.groupBy(ident).agg(F.min(ticker).alias(ticker), F.countDistinct(ticker).alias("n_tickers"))
    one = per.withColumn(ticker, F.when(F.col("n_tickers") == 1, F.col(ticker)))
    return df.join(one, ident, "left").join(assets.select(ticker, asset), ticker, "left")


def merge_catalogues(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer merge in which the first catalogue's values win."""
    cols = [c for c in dict.fromkeys([*a.columns, *b.columns]) if c != key]
    l = a.select(key, *[F.col(c).alias(f"_a_{c}") for c in a.columns if c != key])
    r = b.select(key, *[F.col(c).alias(f"_b_{c}") for c in b.columns if c != key])
    def pick(c):
        have = [f"_{s}_{c}" for s, df in (("a", a), ("b", b)) if c in df.columns]
        return F.coalesce(*[F.col(h) for h in have]).alias(c)
    return l.join(r, key, "full_outer").select(key, *[pick(c) for c in cols])


def rollup_sector(df: DataFrame, mapping: DataFrame, sub: str, sector: str | None = None) -> DataFrame:
    """Sub-industry to industry and sector; ``sector_mismatch`` if the row states another sector."""
    m = mapping.select(F.col("sub_industry").alias(sub), F.col("industry").alias("industry"),
                       F.col("sector").alias("rolled_sector"))
    out = df.join(m, sub, "left")
    if sector is None:
        return out
    return out.withColumn("sector_mismatch", F.col("rolled_sector").isNotNull() & (F.col("rolled_sector") != F.col(sector)))


def with_sector(df: DataFrame, asset: str, assets: DataFrame, industries: DataFrame,
                bucket: str = "sector", unclassified: str = "unclassified", fund: str = "fund") -> DataFrame:
    """Sector of each row's asset; no asset or no industry is "unclassified", a fund its own bucket.

    ``assets``: (asset, industry, is_fund); ``industries``: (industry, sector). A NULL asset joins
    nothing, and its rows stay out of the join, where they would be one group.
    """
    a = assets.select(F.col("asset").alias(asset), "industry", "is_fund").join(industries, "industry", "left")
    label = F.coalesce(F.when(F.col("is_fund"), F.lit(fund)), F.col("_sector"), F.lit(unclassified))
    named = df.filter(F.col(asset).isNotNull()).join(a.withColumnRenamed("sector", "_sector"), asset, "left")
    named = named.withColumn(bucket, label).drop("_sector", "industry", "is_fund")
    return named.unionByName(df.filter(F.col(asset).isNull()).withColumn(bucket, F.lit(unclassified)))


def classify_lines(stints: DataFrame, cik: str = "cik", symbol: str = "symbol",
                   start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Each CIK with its pattern: single, succession, concurrent or mixed.

    Overlaps inside one symbol do not count. The intervals of a symbol are first merged into
    islands. No overlap between islands of a CIK means succession. If every symbol is one island,
    all pairs overlap exactly when the latest start is not after the earliest end. Only the CIKs
    left over by both tests compare their islands, by an overlap join on time buckets.
    """
    far = F.lit(FAR).cast("date")
    rows = stints.filter(F.col(cik).isNotNull() & (F.col(cik) != "")).select(
        F.col(cik).alias("cik"), F.col(symbol).alias("symbol"), F.col(start).alias("f"),
        F.coalesce(F.col(end), far).alias("t")).groupBy("cik", "symbol", "f").agg(F.max("t").alias("t"))
    # one row per start day and symbol: at most one row per calendar day in each window group
    w = Window.partitionBy("cik", "symbol").orderBy("f")
    seen = F.max("t").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("new", F.when(seen.isNull() | (seen < F.col("f")), F.col("f")))
    marked = marked.withColumn("island", F.max("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    islands = marked.groupBy("cik", "symbol", "island").agg(F.min("f").alias("f"), F.max("t").alias("t")).drop("island")
    islands = cut_lineage(islands)
    per_symbol = islands.groupBy("cik", "symbol").agg(
        F.count(F.lit(1)).alias("k"), F.min("f").alias("f"), F.max("t").alias("t"))
    per_cik = per_symbol.groupBy("cik").agg(
        F.count(F.lit(1)).alias("n_symbols"), F.max("k").alias("max_islands"),
        F.max("f").alias("latest_start"), F.min("t").alias("earliest_end"))
    # islands of one symbol never overlap, so an overlap inside a CIK is one between symbols
    clash = overlaps_between(islands).withColumn("any_overlap", F.lit(True))
    c = per_cik.join(clash, "cik", "left").withColumn("any_overlap", F.coalesce("any_overlap", F.lit(False)))
    helly = F.col("latest_start") <= F.col("earliest_end")
    c = c.withColumn("pattern", F.when(F.col("n_symbols") == 1, "single")
                     .when(~F.col("any_overlap"), "succession")
                     .when(F.col("max_islands") == 1, F.when(helly, "concurrent").otherwise("mixed")))
    open_ciks = c.filter("pattern IS NULL").select("cik", "n_symbols")
    some = islands.join(open_ciks, "cik", "left_semi")
    left = some.select("cik", F.col("symbol").alias("s1"), F.col("f").alias("f1"), F.col("t").alias("t1"))
    right = some.select("cik", F.col("symbol").alias("s2"), F.col("f").alias("f2"), F.col("t").alias("t2"))
    pairs = overlap_join(left, right, ["cik"], "f1", "t1", "f2", "t2", 3660).filter("s1 < s2")
    n = pairs.select("cik", "s1", "s2").distinct().groupBy("cik").agg(F.count(F.lit(1)).alias("n_pairs"))
    settled = open_ciks.join(n, "cik", "left").select("cik", F.when(
        F.coalesce("n_pairs", F.lit(0)) * 2 == F.col("n_symbols") * (F.col("n_symbols") - 1), "concurrent"
    ).otherwise("mixed").alias("_p"))
    return c.join(settled, "cik", "left").select(
        "cik", "n_symbols", F.coalesce("pattern", "_p").alias("pattern"))


def overlaps_between(islands: DataFrame) -> DataFrame:
    """CIKs with two islands that share a day, or two symbols that start on one day."""
    per_day = islands.groupBy("cik", "f").agg(F.max("t").alias("t"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cik").orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    hit = per_day.withColumn("_p", F.max("t").over(w)).filter(F.col("_p") >= F.col("f")).select("cik")
    return hit.unionByName(per_day.filter("n > 1").select("cik")).distinct()


def resolve_entities(stints: DataFrame, cik: str = "cik", symbol: str = "symbol",
                     start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Company lines: one row per asset with its pattern, symbol, CIK, stint count and span.

    A succession is one asset named by its latest symbol; other patterns stay one asset per
    symbol; stints without a CIK join the one asset that owns their symbol, else stand alone.
    ``claims`` over 1 marks a symbol claimed by two assets, which must stop a load.
    """
    pattern = cut_lineage(classify_lines(stints, cik, symbol, start, end).select("cik", "pattern"))
    base = stints.select(F.when(F.col(cik) != "", F.col(cik)).alias("cik"), F.col(symbol).alias("symbol"),
                         F.col(start).alias("f"), F.col(end).alias("t"))
    with_cik = base.filter("cik IS NOT NULL").join(pattern, "cik")
    latest = with_cik.groupBy("cik").agg(F.max(F.struct("f", "symbol")).alias("m")).select(
        "cik", F.col("m.symbol").alias("latest"))
    named = with_cik.join(latest, "cik").withColumn(
        "asset_symbol", F.when(F.col("pattern") == "succession", F.col("latest")).otherwise(F.col("symbol")))
    assets = _asset_rows(named.groupBy("cik", "pattern", "asset_symbol"))
    owners = assets.groupBy("asset_symbol").agg(F.count(F.lit(1)).alias("n"), F.min("cik").alias("owner"),
                                                F.min("pattern").alias("owner_pattern"))
    loose = _asset_rows(base.filter("cik IS NULL").groupBy(F.col("symbol").alias("asset_symbol"))).join(
        owners, "asset_symbol", "left")
    joins = F.col("n") == 1
    loose = loose.select(F.when(joins, F.col("owner")).alias("cik"),
                         F.when(joins, F.col("owner_pattern")).otherwise("symbol").alias("pattern"),
                         "asset_symbol", "n_stints", "first_from", "last_to", "open_stints")
    out = assets.unionByName(loose).groupBy("cik", "pattern", "asset_symbol").agg(
        F.sum("n_stints").alias("n_stints"), F.min("first_from").alias("first_from"),
        F.max("last_to").alias("last_to"), F.sum("open_stints").alias("open_stints"))
    claims = out.groupBy("asset_symbol").agg(F.count(F.lit(1)).alias("claims"))
    return out.join(claims, "asset_symbol")


def _asset_rows(grouped) -> DataFrame:
    return grouped.agg(F.count(F.lit(1)).alias("n_stints"), F.min("f").alias("first_from"),
                       F.max("t").alias("last_to"), F.count(F.when(F.col("t").isNull(), 1)).alias("open_stints"))
