"""Point-in-time operators: as-of joins, interval joins, latest-known rows, overlaps.

No operator here sorts all rows of one key in one task. A per-key running value is computed over
one pre-aggregated row per (key, time): with day-grained times a window group holds at most one row
per calendar day, however many rows the key has. Finer times take a ``bucket``, and the scan then
runs in two levels: inside (key, bucket) groups, plus a carry over one summary row per bucket.
"Latest per key" is a partial aggregate plus an equality semi join, which keeps ties and which AQE
can split.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAR_FUTURE = "9999-12-31"


def in_interval(point: Column, start: Column, end: Column, closed: str = "both") -> Column:
    """``start <= point <= end`` (``both``) or ``start <= point < end`` (``left``); open end = NULL."""
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    upper = point <= end if closed == "both" else point < end
    return (start <= point) & (end.isNull() | upper)


def active_at(df: DataFrame, cutoff, start: str, end: str) -> DataFrame:
    """Records raised at or before the cutoff and not cleared at or before it."""
    return df.filter(in_interval(F.lit(cutoff), F.col(start), F.col(end), "left"))


def members_at(stints: DataFrame, day, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Stints holding on a day; both ends inclusive, NULL end still open."""
    return stints.filter(in_interval(F.lit(day), F.col(start), F.col(end), "both"))


def keep_open_since(stints: DataFrame, since, end: str = "valid_to") -> DataFrame:
    """Stints still open on or after a date."""
    return stints.filter(F.col(end).isNull() | (F.col(end) >= F.lit(since)))


def known_at(df: DataFrame, as_of, column: str = "as_of") -> DataFrame:
    """Only what had been ingested by a date; a pure partition filter on a quad table."""
    return df.filter(F.col(column) <= F.lit(as_of))


def _nonnull(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def asof_latest(
    facts: DataFrame, key: Sequence[str], ts: str, as_of, require: Sequence[str] = ()
) -> DataFrame:
    """Latest facts per key with ``ts <= as_of``; ties are all kept.

    ``require`` names columns a fact must hold. One cut-off is taken per required column, and a
    row qualifies only if no later row holds any of them: a later fact with one of two metrics
    hides an older complete fact without qualifying itself.
    """
    known = facts.filter(F.col(ts) <= F.lit(as_of))
    return _latest(known, list(key), ts, list(require))


def latest_per(
    df: DataFrame, keys: Sequence[str], order: str, known: str | None = None, known_at=None
) -> DataFrame:
    """Latest rows per key by ``order`` among the rows known at a date; ties kept."""
    seen = df if known is None else df.filter(F.col(known) <= F.lit(known_at))
    return _latest(seen, list(keys), order, [])


def _latest(df: DataFrame, keys: list[str], ts: str, require: list[str]) -> DataFrame:
    rows = df.filter(_nonnull([*keys, ts]))
    if require:
        tops = rows.groupBy(*keys).agg(
            *[F.max(F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_t{i}") for i, c in enumerate(require)]
        )
        # a row holding every column is the latest only if all cut-offs are its own time
        tops = tops.filter(reduce(lambda a, b: a & b, [F.col("_t0") == F.col(f"_t{i}") for i in range(len(require))]))
        tops = tops.select(*keys, F.col("_t0").alias(ts))
        rows = rows.filter(_nonnull(require))
    else:
        tops = rows.groupBy(*keys).agg(F.max(ts).alias(ts))
    return rows.join(tops, [*keys, ts], "left_semi")


def _running(times: DataFrame, keys: list[str], ts: str, out: str, bucket: Column | None, strict: bool) -> DataFrame:
    """``out``: largest ``_tv`` of the key up to each time. ``times`` holds one row per (keys, ts)."""
    end = -1 if strict else Window.currentRow
    upto = Window.orderBy(ts).rowsBetween(Window.unboundedPreceding, end)
    if bucket is None:
        return times.withColumn(out, F.max("_tv").over(upto.partitionBy(*keys)))
    rows = times.withColumn("_b", bucket)
    per_bucket = rows.groupBy(*keys, "_b").agg(F.max("_tv").alias("_m"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*keys, "_b", F.max("_m").over(before).alias("_carry"))
    inside = rows.withColumn("_in", F.max("_tv").over(upto.partitionBy(*keys, "_b")))
    return inside.join(carry, [*keys, "_b"], "left").withColumn(out, F.greatest("_in", "_carry")).drop("_b", "_in", "_carry")


def running_last(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: Column,
    out: str,
    bucket: Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """Largest ``value`` per key over rows with ``ts`` at or before (``strict``: before) the row's own.

    ``bucket`` is a monotone function of ``ts`` that splits the keys whose times are finer than days.
    """
    keys = list(keys)
    rows = df.withColumn("_v", value)
    times = rows.groupBy(*keys, ts).agg(F.max("_v").alias("_tv"))
    at = _running(times, keys, ts, out, bucket, strict).drop("_tv")
    return rows.drop("_v").join(at, [*keys, ts], "left")


def asof_times(
    events: DataFrame,
    facts: DataFrame,
    key: Sequence[str],
    event_ts: str,
    fact_ts: str,
    out: str,
    bucket=None,
    strict: bool = False,
) -> DataFrame:
    """Distinct (key, event time) pairs with the latest fact time at or before each of them."""
    key = list(key)
    marks = events.filter(_nonnull([*key, event_ts])).select(*key, F.col(event_ts).alias("_ts"))
    known = facts.filter(_nonnull([*key, fact_ts])).select(*key, F.col(fact_ts).alias("_ts"))
    times = (
        marks.withColumn("_e", F.lit(True)).withColumn("_f", F.lit(False))
        .unionByName(known.withColumn("_e", F.lit(False)).withColumn("_f", F.lit(True)))
        .groupBy(*key, "_ts")
        .agg(F.max("_e").alias("_e"), F.max(F.when(F.col("_f"), F.col("_ts"))).alias("_tv"))
    )
    b = bucket(F.col("_ts")) if bucket is not None else None
    run = _running(times, key, "_ts", out, b, strict)
    return run.filter("_e").select(*key, F.col("_ts").alias(event_ts), out)


def asof_join(
    events: DataFrame,
    facts: DataFrame,
    key: Sequence[str],
    event_ts: str,
    fact_ts: str,
    require: Sequence[str] = (),
    bucket=None,
    strict: bool = False,
    how: str = "left",
) -> DataFrame:
    """Each event with the latest facts of its key at or before it; tied facts are all returned.

    ``facts`` must not repeat the events' column names other than ``key``. ``require`` works as in
    :func:`asof_latest`: one as-of time per required column, all equal to the fact's own time.
    """
    key = list(key)
    require = list(require)
    names = ["_asof0"] if not require else [f"_asof{i}" for i in range(len(require))]
    times = None
    for i, name in enumerate(names):
        some = facts if not require else facts.filter(F.col(require[i]).isNotNull())
        part = asof_times(events, some, key, event_ts, fact_ts, name, bucket, strict)
        times = part if times is None else times.join(part, [*key, event_ts], "left")
    if len(names) > 1:
        same = reduce(lambda a, b: a & b, [F.col(names[0]) == F.col(n) for n in names])
        times = times.withColumn(names[0], F.when(same, F.col(names[0]))).drop(*names[1:])
    rows = facts.filter(_nonnull([*key, fact_ts, *require])).withColumn("_asof0", F.col(fact_ts))
    linked = times.filter(F.col("_asof0").isNotNull()).join(rows, [*key, "_asof0"], "inner").drop("_asof0")
    return events.join(linked, [*key, event_ts], how)


def with_previous(
    df: DataFrame, key: Sequence[str], order: str, columns: Sequence[str], prefix: str = "previous_",
    bucket=None,
) -> DataFrame:
    """Each row with the values of its key's latest strictly earlier rows (tied ones all returned)."""
    key = list(key)
    earlier = df.select(*key, F.col(order).alias(f"{prefix}{order}"), *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return asof_join(df, earlier, key, order, f"{prefix}{order}", bucket=bucket, strict=True)


def next_event(
    df: DataFrame, events: DataFrame, key: Sequence[str], ts: str, event_ts: str, out: str = "next_ts",
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Each row with the time of its key's first strictly later event; NULL if there is none.

    The as-of scan run on reversed time, so a hot key is spread over its buckets here too.
    """
    key = list(key)
    back = lambda c: -F.unix_micros(F.col(c).cast("timestamp"))
    rows = df.select(*key, F.col(ts), back(ts).alias("_neg"))
    marks = events.select(*key, back(event_ts).alias("_eneg"))
    width = F.lit(bucket_seconds * 1_000_000)
    found = asof_times(rows, marks, key, "_neg", "_eneg", "_hit", lambda c: F.floor(c / width), strict=True)
    when = rows.distinct().join(found, [*key, "_neg"]).select(
        *key, ts, F.timestamp_micros(-F.col("_hit")).cast(dict(df.dtypes)[ts]).alias(out))
    return df.join(when, [*key, ts], "left")


def later_events(
    df: DataFrame, events: DataFrame, key: Sequence[str], ts: str, event_ts: str, open_ok: bool = False
) -> DataFrame:
    """Every row with all strictly later events of its key; ``open_ok`` lets a NULL ``ts`` match any."""
    key = list(key)
    right = events.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)],
                          *[c for c in events.columns if c not in key])
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(key)])
    later = F.col(event_ts) > F.col(ts)
    on = on & ((F.col(ts).isNull() | later) if open_ok else later)
    return df.join(right, on, "left").drop(*[f"_k{i}" for i in range(len(key))])


def later_summary(df: DataFrame, events: DataFrame, key: Sequence[str], ts: str, event_ts: str, block: Callable[[Column], Column]) -> DataFrame:
    """Each row with ``n_later``, ``first_later`` and ``last_later``: its key's strictly later events, without pairs.

    ``block`` maps a time to a number that never falls as time grows. Events are counted per (key, time)
    and summed per (key, block); whole later blocks are read from those sums, and only the row's own block
    is looked into. A group holds the times of one block of a key, or the blocks of a key, so a hot key is
    spread. A null time or key part has no later events: 0, null, null.
    """
    key = list(key)
    usable = F.lit(True)
    for c in key:
        usable = usable & F.col(c).isNotNull()
    e = events.filter(usable & F.col(event_ts).isNotNull()).groupBy(*key, F.col(event_ts).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    r = df.filter(usable & F.col(ts).isNotNull()).select(*key, F.col(ts).alias("_t")).distinct()
    both = e.unionByName(r.withColumn("_n", F.lit(0).cast("long"))).groupBy(*key, "_t").agg(F.sum("_n").alias("_n")).withColumn("_b", block(F.col("_t")))
    met = F.when(F.col("_n") > 0, F.col("_t"))
    sums = both.groupBy(*key, "_b").agg(F.sum("_n").alias("_n"), F.min(met).alias("_low"), F.max(met).alias("_high"))
    later = Window.partitionBy(*key).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*key, "_b", F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_n2"), F.min("_low").over(later).alias("_first2"), F.max("_high").over(later).alias("_last2"))
    own = Window.partitionBy(*key, "_b").orderBy(F.col("_t").desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = both.select(*key, "_b", "_t", F.coalesce(F.sum("_n").over(own), F.lit(0)).alias("_n1"), F.min(met).over(own).alias("_first1"), F.max(met).over(own).alias("_last1"))
    found = inside.join(sums, [*key, "_b"]).select(*key, F.col("_t").alias(ts), (F.col("_n1") + F.col("_n2")).alias("n_later"), F.coalesce("_first1", "_first2").alias("first_later"), F.coalesce("_last2", "_last1").alias("last_later"))
    return df.join(found, [*key, ts], "left").withColumn("n_later", F.coalesce("n_later", F.lit(0)))


def asof_rule(
    df: DataFrame, date: str, rules: DataFrame, on: Sequence[str], rule: str = "rule_iri",
    start: str = "valid_from", end: str = "valid_to",
) -> DataFrame:
    """Rule in force at each row's date, ``[from, to)``; ``rule_matches`` must be 1 on every row."""
    on = list(on)
    points = df.select(*on, date).distinct()
    r = rules.select(*[F.col(c).alias(f"_r_{c}") for c in on], F.col(rule).alias("_rule"),
                     F.col(start).alias("_rf"), F.col(end).alias("_rt"))
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_r_{c}") for c in on])
    cond = cond & in_interval(F.col(date), F.col("_rf"), F.col("_rt"), "left")
    found = points.join(r, cond, "left").groupBy(*on, date).agg(
        F.count("_rule").alias("rule_matches"), F.min("_rule").alias(rule)
    )
    found = found.withColumn(rule, F.when(F.col("rule_matches") == 1, F.col(rule)))
    return df.join(found, [*on, date], "left")


def _day_bucket(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / F.lit(days))


def interval_join(
    points: DataFrame, intervals: DataFrame, point: str, start: str, end: str,
    on: Sequence[str] = (), closed: str = "both", bucket_days: int = 366,
) -> DataFrame:
    """Points joined to the intervals holding on them, as an equi join on time buckets.

    Each interval is repeated once per bucket it touches and each point lives in one bucket, so no
    pair is found twice and no side is compared with all of the other.
    """
    on = list(on)
    p = points.withColumn("_b", _day_bucket(F.col(point), bucket_days))
    last = points.agg(F.max(point)).scalar()  # the last point clips open ends
    spans = intervals.withColumn("_upto", F.least(F.coalesce(F.col(end), last), last))
    spans = spans.filter(F.col("_upto") >= F.col(start)).withColumn("_b", F.explode(F.sequence(
        _day_bucket(F.col(start), bucket_days), _day_bucket(F.col("_upto"), bucket_days)))).drop("_upto")
    return p.join(spans, ["_b", *on], "inner").filter(
        in_interval(F.col(point), F.col(start), F.col(end), closed)
    ).drop("_b")


def overlap_join(
    a: DataFrame, b: DataFrame, key: Sequence[str], a_from: str, a_to: str, b_from: str, b_to: str,
    bucket_days: int = 366,
) -> DataFrame:
    """Pairs of rows of two tables whose inclusive intervals share a day (column names must differ).

    The shared days of a pair start in exactly one bucket, and only that bucket returns the pair.
    """
    key = list(key)
    far = F.lit(FAR_FUTURE).cast("date")
    bound = a.select(F.col(a_from).alias("f"), F.col(a_to).alias("t")).unionByName(
        b.select(F.col(b_from).alias("f"), F.col(b_to).alias("t"))
    ).agg(F.greatest(F.max("f"), F.max("t"))).scalar()

    def spread(df: DataFrame, f: str, t: str) -> DataFrame:
        clipped = df.withColumn("_upto", F.least(F.coalesce(F.col(t), bound), bound))
        return clipped.filter(F.col("_upto") >= F.col(f)).withColumn("_b", F.explode(F.sequence(
            _day_bucket(F.col(f), bucket_days), _day_bucket(F.col("_upto"), bucket_days)))).drop("_upto")

    left, right = spread(a, a_from, a_to), spread(b, b_from, b_to)
    pairs = left.join(right, [*key, "_b"], "inner").filter(
        (F.col(a_from) <= F.coalesce(F.col(b_to), far)) & (F.col(b_from) <= F.coalesce(F.col(a_to), far))
    )
    first = _day_bucket(F.greatest(F.col(a_from), F.col(b_from)), bucket_days)
    return pairs.filter(F.col("_b") == first).drop("_b")


def overlaps(df: DataFrame, key: Sequence[str], start: str, end: str, bucket=None) -> DataFrame:
    """Intervals that begin on or before the end of an earlier-starting interval of their key."""
    far = F.lit(FAR_FUTURE).cast("date")
    rows = df.withColumn("_end", F.coalesce(F.col(end), far))
    b = bucket(F.col(start)) if bucket is not None else None
    prev = running_last(rows, key, start, F.col("_end"), "previous_end", b, strict=True)
    return prev.filter(F.col("previous_end") >= F.col(start)).drop("_end")


def append_ok(new: DataFrame, stored: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """New sightings with the verdict against the latest stored one: later, repeated or earlier."""
    key = list(key)
    last = stored.groupBy(*key).agg(F.max(ts).alias("last_stored"))
    verdict = (
        F.when(F.col("last_stored").isNull() | (F.col(ts) > F.col("last_stored")), "later")
        .when(F.col(ts) == F.col("last_stored"), "repeated")
        .otherwise("earlier")
    )
    return new.join(last, key, "left").withColumn("verdict", verdict)
