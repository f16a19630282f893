"""State that streams keep: ids, losses, running checks, waiting rows and open episodes.

A micro-batch reads what it may need of the state, not all of it. Ids lie in buckets by hash; a filter
for each bucket tells which ids may be known, and only the parts those may lie in are read. The filter
prunes, an exact join decides. Every write is keyed by the batch, and a batch reads what earlier ones
wrote, so one that runs again leaves the same state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pitframe.operators.visibility import DATA_DATED, classify_visibility
from pitframe.session import cut_lineage
from pitframe.sources.sinks import read_or_empty
from pitframe.streaming.jobs import last_batch, write_batch, written

BUCKETS = 64
BITS = 32_768  # bits that one of Spark's bitmaps holds
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- stored ids ---


def _bucket(ident: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(ident), F.lit(buckets)).cast("int")


def _bits(ident: str) -> list[Column]:
    """Two places of an id in its bucket's bitmaps, from hashes other than the bucket's."""
    return [F.pmod(F.xxhash64(F.lit(salt), F.col(ident)), F.lit(BITS)) for salt in (1, 2)]


def _set(bitmap: str, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1


def _may_hold(ident: str, alias: str) -> Column:
    one, two = _bits(ident)
    return (F.col(ident) >= F.col(f"{alias}.low")) & (F.col(ident) <= F.col(f"{alias}.high")) & _set(f"{alias}.b1", one) & _set(f"{alias}.b2", two)


def _filters(ids: DataFrame, ident: str) -> DataFrame:
    one, two = _bits(ident)
    return ids.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("low"), F.max(ident).alias("high"),
                                     F.bitmap_construct_agg(one).alias("b1"), F.bitmap_construct_agg(two).alias("b2"))


def _filter_ddl(kind: str) -> str:
    return f"bucket int, n bigint, low {kind}, high {kind}, b1 binary, b2 binary"


def touched_parts(ids: DataFrame, path: str, ident: str, batch: int, buckets: int = BUCKETS) -> list[tuple[int, int]]:
    """(batch, bucket) of the stored parts in which some of ``ids`` may lie.

    The filters of whole buckets, as the preceding batch left them, are asked first; the filters of single
    parts only for ids that may be known. The list has at most a pair for each part.
    """
    spark, kind = ids.sparkSession, ids.schema[ident].dataType.simpleString()
    whole = last_batch(spark, f"{path}/whole", _filter_ddl(kind), batch).alias("w")
    x = ids.select(ident).filter(F.col(ident).isNotNull()).withColumn("bucket", _bucket(ident, buckets))
    maybe = cut_lineage(x.join(whole, "bucket").filter(_may_hold(ident, "w")).select(ident, "bucket"))
    if maybe.isEmpty():
        return []
    parts = read_or_empty(spark, f"{path}/parts", _filter_ddl(kind) + ", batch bigint").filter(F.col("batch") < batch).alias("p")
    hit = maybe.join(parts, "bucket").filter(_may_hold(ident, "p")).select("batch", "bucket").distinct()
    return sorted((int(r["batch"]), int(r["bucket"])) for r in hit.collect())


def known_ids(ids: DataFrame, path: str, ident: str, batch: int, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``ids`` (distinct values) that batches before ``batch`` stored; reads touched parts alone. Null is never known."""
    spark, kind = ids.sparkSession, ids.schema[ident].dataType.simpleString()
    parts = touched_parts(ids, path, ident, batch, buckets)
    if not parts:
        return ids.select(ident).limit(0)
    stored = spark.read.schema(f"{ident} {kind}").parquet(*[f"{path}/ids/batch={b}/bucket={k}" for b, k in parts])
    return ids.select(ident).distinct().join(stored.distinct(), ident, "left_semi")


def add_ids(ids: DataFrame, path: str, ident: str, batch: int, buckets: int = BUCKETS) -> None:
    """Store new, distinct ids of a batch: the ids by bucket, the filters of these parts, and of whole buckets."""
    spark, kind = ids.sparkSession, ids.schema[ident].dataType.simpleString()
    x = ids.select(ident).filter(F.col(ident).isNotNull()).withColumn("bucket", _bucket(ident, buckets))
    x.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/ids/batch={batch}")
    write_batch(f"{path}/parts")(_filters(x, ident), batch)
    own = spark.read.schema(_filter_ddl(kind)).parquet(f"{path}/parts/batch={batch}")
    both = last_batch(spark, f"{path}/whole", _filter_ddl(kind), batch).unionByName(own)
    merged = both.groupBy("bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.bitmap_or_agg("b1").alias("b1"), F.bitmap_or_agg("b2").alias("b2"))
    write_batch(f"{path}/whole")(merged, batch)


def ingest_ids(path: str, ident: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """STR-03 sink: rows whose id no earlier batch stored, one an id; null ids aren't ids and are left out.

    Costs the batch and the parts its ids may lie in, however long the history and however late the row.
    """
    def each(df: DataFrame, batch: int) -> None:
        rows = cut_lineage(df.filter(F.col(ident).isNotNull()).dropDuplicates([ident]))
        new = cut_lineage(rows.join(known_ids(rows, path, ident, batch, buckets), ident, "left_anti"))
        write_batch(f"{path}/rows")(new, batch)
        add_ids(new, path, ident, batch, buckets)
    return each


# --- late and lost rows ---


def settle_rows(path: str, key: str, graph: str, ok: str) -> Callable[[DataFrame, int], None]:
    """STR-02 sink: what becomes of each row, by whether its graph was written by an earlier batch.

    Of a graph not yet written, a sound row is ``written`` and a quarantined one ``late``: a later batch
    brings it again. Once the graph is written a row that isn't in it is ``lost``; the ledger keeps its key,
    and later batches count it as ``lost before``. A row that is in it is ``stored``. Rows of one key
    count once, as sound if one of them is; null keys or graphs make a row late.
    """
    def each(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        rows = cut_lineage(df.groupBy(key).agg(F.min(graph).alias(graph), F.max(ok).alias(ok)))
        there = written(spark, f"{path}/graphs", f"{graph} string", before=batch).distinct().withColumn("_there", F.lit(True))
        held = known_ids(rows, f"{path}/stored", key, batch).withColumn("_held", F.lit(True))
        gone = known_ids(rows, f"{path}/ledger", key, batch).withColumn("_gone", F.lit(True))
        sure = F.coalesce(F.col(ok), F.lit(False)) & F.col(key).isNotNull() & F.col(graph).isNotNull()
        fate = (F.when(F.col("_held"), "stored").when(F.col("_there") & F.col("_gone"), "lost before").when(F.col("_there") & F.col(key).isNotNull(), "lost")
                .when(sure, "written").otherwise("late"))
        out = cut_lineage(rows.join(there, graph, "left").join(held, key, "left").join(gone, key, "left").select(key, graph, fate.alias("fate")))
        write_batch(f"{path}/graphs")(out.filter("fate = 'written'").select(graph).distinct(), batch)
        add_ids(out.filter("fate = 'written'"), f"{path}/stored", key, batch)
        add_ids(out.filter("fate = 'lost'"), f"{path}/ledger", key, batch)
        write_batch(f"{path}/fates")(out.groupBy("fate").agg(F.count(F.lit(1)).alias("rows")), batch)
        write_batch(f"{path}/losses")(out.filter("fate = 'lost'").select(key, graph), batch)
    return each


# --- aggregate checks ---


class StreamStopped(RuntimeError):
    """Merged checks refuse a batch; the stream ends before its rows are written."""


TOTALS = "rows bigint, twice bigint"


def running_checks(path: str, key: str, null_rates: Mapping[str, float], most_repeated: int = 0, least_rows: int = 1) -> Callable[[DataFrame, int], None]:
    """STR-07 sink: NULL rates, and keys met more than once, over all rows so far.

    The state is what each batch counted, one row, and the keys met; both add up, so the verdict is that
    of the batch form over the rows so far. A batch that a rule refuses has its verdict written, its rows
    not, and ends the stream with :class:`StreamStopped`. ``twice`` counts rows whose key came before
    them. Null keys aren't keys. Rates count from ``least_rows`` rows on.
    """
    ddl = TOTALS + "".join(f", null_{c} bigint" for c in null_rates)

    def each(df: DataFrame, batch: int) -> None:
        rows = cut_lineage(df)
        keys = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        keys = cut_lineage(keys)
        known = cut_lineage(known_ids(keys, f"{path}/keys", key, batch))
        new = keys.join(known, key, "left_anti")
        own = keys.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_all")).crossJoin(new.agg(F.count(F.lit(1)).alias("_new")))
        counts = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"null_{c}") for c in null_rates])
        total = counts.crossJoin(own).select("rows", (F.col("_all") - F.col("_new")).alias("twice"), *[f"null_{c}" for c in null_rates])  # one row each
        write_batch(f"{path}/totals")(total, batch)
        add_ids(new, f"{path}/keys", key, batch)
        merged = written(rows.sparkSession, f"{path}/totals", ddl, before=batch + 1)
        merged = merged.agg(*[F.sum(c).alias(c) for c in merged.columns])
        why = [F.when((F.col("rows") >= least_rows) & (F.col(f"null_{c}") > most * F.col("rows")), F.lit(f"NULL rate of {c}")) for c, most in null_rates.items()]
        why.append(F.when(F.col("twice") > most_repeated, F.lit("repeated keys")))
        verdict = cut_lineage(merged.select(F.col("rows"), F.col("twice"), F.array_join(F.array_compact(F.array(*why)), "; ").alias("reasons")))
        write_batch(f"{path}/verdicts")(verdict, batch)
        reasons = verdict.first()["reasons"]
        if reasons:
            raise StreamStopped(reasons)
        write_batch(f"{path}/rows")(rows, batch)
    return each


# --- waiting rows ---


def next_quarter(day: Column) -> Column:
    return F.add_months(F.trunc(day, "quarter"), 3).cast("date")


def release_scores(path: str, assets: DataFrame, runs: DataFrame | Callable[[int], DataFrame], run_day: Callable[[int], str]) -> Callable[[DataFrame, int], None]:
    """STR-01 sink: a score waits in a queue until its day has come, its quarter has closed and a full run has read it.

    A waiting row lies in the queue under the first day on which it could be written, so a batch takes
    only the parts of the queue that are due on its run day. What was taken is written down; a row
    that must wait on (its quarter isn't covered yet) is queued again for the day after.
    """
    def each(df: DataFrame, batch: int) -> None:
        spark, day = df.sparkSession, run_day(batch)
        known = runs(batch) if callable(runs) else runs
        parts = read_or_empty(spark, f"{path}/parts", "part bigint, due date, batch bigint").filter((F.col("batch") < batch) & (F.col("due") <= F.lit(day).cast("date")))
        taken = written(spark, f"{path}/taken", "part bigint, due date", before=batch)
        due = cut_lineage(parts.select("part", "due").join(taken, ["part", "due"], "left_anti"))
        folders = [f"{path}/queue/part={r['part']}/due={r['due']}" for r in due.collect()]  # days that waited, not rows
        back = spark.read.schema(df.schema).parquet(*folders) if folders else df.limit(0)
        rows = cut_lineage(classify_visibility(df.unionByName(back), assets, known, day))
        available, after = F.col("available_at").cast("date"), F.date_add(F.lit(day).cast("date"), 1)
        first = F.when(F.col("score_type").isin(*DATA_DATED), F.greatest(next_quarter(available), after)).otherwise(F.greatest(available, after))
        wait = cut_lineage(rows.filter("outcome = 'defer'").select(*df.columns, first.alias("due")))
        write_batch(f"{path}/projected")(rows.filter("outcome = 'project'").drop("outcome", "reason"), batch)
        wait.repartition("due").write.mode("overwrite").partitionBy("due").parquet(f"{path}/queue/part={batch}")
        write_batch(f"{path}/parts")(wait.groupBy("due").agg(F.count(F.lit(1)).alias("n")).select(F.lit(batch).cast("long").alias("part"), "due"), batch)
        write_batch(f"{path}/taken")(due, batch)
    return each


def still_waiting(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows in the parts of the queue that no batch took."""
    every = read_or_empty(spark, f"{path}/queue", f"{ddl}, part bigint, due date")
    return every.join(written(spark, f"{path}/taken", "part bigint, due date"), ["part", "due"], "left_anti").drop("part", "due")


# --- episodes as keyed state ---


EPISODE = "asset_id bigint, since date, start_kind string, released date, cause string, final boolean, seen date"


class OpenEpisode(StatefulProcessor):
    """One asset's open episode, held in the state store between batches of its (date, kind) rows.

    ``ranking_days`` is the calendar of ranking days, a day each. Of an open episode the days up to
    the asset's last row are settled; the ranking days after it are read when the asset's next row comes, or
    by :func:`episodes_of`.
    """

    def __init__(self, ranking_days: Sequence[date]):
        self.days = sorted(ranking_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "since date, kind string, seen date")

    def _unranked(self, after: date, before: date | None, there: set[date]) -> date | None:
        from bisect import bisect_right
        for d in self.days[bisect_right(self.days, after):]:
            if before is not None and d >= before:
                return None
            if d not in there:
                return d
        return None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        kinds: dict[date, set[str]] = {}
        for part in rows:
            for d, k in zip(part["date"], part["kind"], strict=True):
                kinds.setdefault(d, set()).add(k)
        calendar, out = set(self.days), []
        since = kind = seen = None
        if self.open.exists():
            since, kind, seen = self.open.get()
        for d in sorted(kinds):
            if since is not None and (left := self._unranked(seen, d, set())) is not None:
                out.append((key[0], since, kind, left, "not_ranked", True, None))
                since = None
            now, ranking = kinds[d], d in calendar
            stop, block, back = "stop" in now, "blocked" in now and ranking, "reentry" in now
            gone = ranking and not block and "ranked" not in now
            if stop:
                if since is not None:  # a new stop begins anew; if the asset leaves today, that ends nothing of the old
                    out.append((key[0], since, kind, None, None, True, None))
                since, kind = d, "stop"
            elif since is None and block:
                since, kind = d, "decision_close"
            if since is not None and (back or gone and d > since):
                out.append((key[0], since, kind, d, "not_ranked" if gone and d > since else "price", True, None))
                since = None
            seen = d
        if since is None:
            self.open.clear()
        else:
            self.open.update((since, kind, seen))
            out.append((key[0], since, kind, None, None, False, seen))
        if out:
            yield pd.DataFrame(out, columns=["asset_id", "since", "start_kind", "released", "cause", "final", "seen"])

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Keyed state in RocksDB, for the queries started inside."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def keyed_episodes(stream: DataFrame, ranking_days: Sequence[date]) -> DataFrame:
    """STR-04: (asset_id, date, kind) rows, whole days in order, to episode rows; see :class:`OpenEpisode`."""
    return stream.select("asset_id", "date", "kind").groupBy("asset_id").transformWithStateInPandas(OpenEpisode(ranking_days), EPISODE, "append", "none")


def episodes_of(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Episodes from what the stream wrote; of the open ones, those that a later ranking day (column date) ended."""
    final = rows.filter("final").select("asset_id", "since", "start_kind", "released", "cause")
    last = rows.filter("NOT final").groupBy("asset_id").agg(F.max_by(F.struct("since", "start_kind", "seen"), "seen").alias("o")).select("asset_id", "o.*")
    last = last.join(final.select("asset_id", "since"), ["asset_id", "since"], "left_anti")
    seen = last.select("seen").distinct()
    after = seen.join(days.select("date").distinct(), F.col("date") > F.col("seen")).groupBy("seen").agg(F.min("date").alias("released"))  # days against days
    still = last.join(after, "seen", "left").select("asset_id", "since", "start_kind", "released", F.when(F.col("released").isNotNull(), "not_ranked").alias("cause"))
    return final.unionByName(still)
