"""Structured Streaming forms of the batch rules. Each has a batch twin it must agree with.

Side effects happen in ``foreachBatch`` and are keyed by the batch id: a repeated batch overwrites
its own folder and reads only state written by earlier batches, so a lost driver or executor
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitframe.operators.episodes import day_flags, fold
from pitframe.operators.temporal import in_interval
from pitframe.operators.visibility import classify_visibility
from pitframe.session import cut_lineage, spool
from pitframe.sources.sinks import read_or_empty, replace_graphs


def file_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder whose names match a pattern."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_available(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything available through ``foreachBatch`` and stop."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
    query.awaitTermination()


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Sink: each batch overwrites its own ``batch=<id>`` folder."""
    return lambda df, batch: df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _ddl(schema: StructType | str) -> str:
    return schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def last_batch(spark: SparkSession, path: str, schema: StructType | str, before: int) -> DataFrame:
    """State the preceding batch has left; batch ids are consecutive, and an empty state is one too."""
    return read_or_empty(spark, path, _ddl(schema) + ", batch bigint").filter(F.col("batch") == before - 1).drop("batch")


def written(spark: SparkSession, path: str, schema: StructType | str, before: int | None = None) -> DataFrame:
    """What batches (optionally only those before one) have written."""
    df = read_or_empty(spark, path, _ddl(schema) + ", batch bigint")
    return (df if before is None else df.filter(F.col("batch") < before)).drop("batch")


def tumbling_counts(path: str, ts: str, keys: Sequence[str], width: str = "1 day", delay_seconds: int = 600) -> Callable[[DataFrame, int], None]:
    """STR-06 sink: each batch writes its rows per window and key, split into those in time and late ones.

    A row is late if its window ended before the highest time of earlier batches minus the delay. The
    state is one row per batch and what was counted; :func:`window_counts` sums it, so the last
    window is there after the last batch and no row goes uncounted.
    """
    def each(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        high = written(spark, f"{path}/high", "high timestamp", before=batch).agg(F.max("high").alias("high")).scalar()
        w = df.withColumn("_w", F.window(ts, width))
        late = F.coalesce(F.unix_micros("_w.end") <= F.unix_micros(high) - delay_seconds * 1_000_000, F.lit(False))
        counts = w.groupBy(F.col("_w.start").alias("window_start"), *keys, late.alias("late")).agg(F.count(F.lit(1)).alias("n"))
        write_batch(f"{path}/counts")(counts, batch)
        write_batch(f"{path}/high")(df.agg(F.max(ts).alias("high")), batch)
    return each


def window_counts(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """(window_start, keys, n, late): counts over all batches; ``late`` rows came after their window had closed."""
    rows = written(spark, f"{path}/counts", f"window_start timestamp, {keys}, late boolean, n bigint")
    names = [c for c in rows.columns if c not in ("late", "n")]
    return rows.groupBy(*names).agg(F.sum(F.when(~F.col("late"), F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("late"))


def members_at_event(stream: DataFrame, stints: DataFrame, key: Sequence[str], ts: str, start: str, end: str) -> DataFrame:
    """STR-08: stream-static join of events to the stints of their key that hold at event time."""
    s = stints.select(*[F.col(k).alias(f"_s_{k}") for k in key], *[c for c in stints.columns if c not in key])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in key])
    return stream.join(s, on & in_interval(F.to_date(ts), F.col(start), F.col(end))).drop(*[f"_s_{k}" for k in key])


def checked_rows(stream: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """STR-07: each row with the names of the row checks it fails."""
    cells = [F.when(c, F.lit(n)) for n, c in checks.items()]
    return stream.withColumn("failed", F.filter(F.array(*cells), lambda x: x.isNotNull()))


def ingest_new(path: str, ident: str) -> Callable[[DataFrame, int], None]:
    """STR-03 sink: only ids an earlier batch stored are skipped, however late a row is; a re-run adds nothing.

    Ids of a batch are written where they are first met: with the time of no matter which row.
    """
    def each(df: DataFrame, batch: int) -> None:
        stored = written(df.sparkSession, path, df.schema, before=batch).select(ident)
        write_batch(path)(df.dropDuplicates([ident]).join(stored, ident, "left_anti"), batch)
    return each


def gate_scores(path: str, assets: DataFrame, runs: DataFrame, run_day) -> Callable[[DataFrame, int], None]:
    """STR-01 sink: projectable rows are written, rows that must wait are carried to the next batch."""
    def each(df: DataFrame, batch: int) -> None:
        waiting = last_batch(df.sparkSession, f"{path}/deferred", df.schema, batch)
        rows = cut_lineage(classify_visibility(df.unionByName(waiting), assets, runs, run_day(batch) if callable(run_day) else run_day))
        write_batch(f"{path}/projected")(rows.filter("outcome = 'project'"), batch)
        write_batch(f"{path}/deferred")(rows.filter("outcome = 'defer'").select(*df.columns), batch)
    return each


def settle_late(path: str, ts: str, delay_seconds: int) -> Callable[[DataFrame, int], None]:
    """STR-02 sink: a row older than the highest time of earlier batches minus the delay is lost.

    A row behind that highest time but within the delay is late and kept. The highest time is one
    row per batch.
    """
    def each(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        seen = written(spark, f"{path}/high", "high timestamp", before=batch).agg(F.max("high").alias("high"))
        limit = seen.select("high").scalar()
        lag = F.unix_micros(limit) - F.unix_micros(F.col(ts))
        fate = F.when(lag > delay_seconds * 1_000_000, "lost").when(lag > 0, "late").otherwise("on time")
        write_batch(f"{path}/rows")(df.withColumn("fate", F.coalesce(fate, F.lit("on time"))), batch)
        write_batch(f"{path}/high")(df.agg(F.max(ts).alias("high")), batch)
    return each


EPISODE_DDL = "asset_id bigint, since date, start_kind string, released date, cause string"


def fold_episodes(path: str) -> Callable[[DataFrame, int], None]:
    """STR-04 sink: stop-memory episodes carried over batches of (asset_id, date, kind).

    Batches hold whole days in order. State is one row per open asset; it re-enters the fold as the
    event that opened it, so a batch costs its own events plus the open assets.
    """
    def each(df: DataFrame, batch: int) -> None:
        pick = lambda k: df.filter(F.col("kind") == k).select("asset_id", "date")
        opened = last_batch(df.sparkSession, f"{path}/open", EPISODE_DDL, batch)
        flags = day_flags(pick("stop"), pick("blocked"), pick("reentry"), pick("ranked"), opened=opened)
        no = F.lit(False)
        seed = opened.select("asset_id", F.col("since").alias("date"), (F.col("start_kind") == "stop").alias("s"), (F.col("start_kind") != "stop").alias("b"), no.alias("r"), no.alias("u"))
        eps = cut_lineage(fold(flags.unionByName(seed), ["asset_id"]))
        last = eps.groupBy("asset_id").agg(F.max("since").alias("since"))
        still = eps.filter("released IS NULL").join(last, ["asset_id", "since"], "left_semi")
        write_batch(f"{path}/done")(eps.join(still.select("asset_id", "since"), ["asset_id", "since"], "left_anti"), batch)
        write_batch(f"{path}/open")(still, batch)
        write_batch(f"{path}/mark")(df.sparkSession.range(1), batch)
    return each


def episodes_so_far(spark: SparkSession, path: str) -> DataFrame:
    """Released episodes of all batches and the ones still open after the last."""
    top = read_or_empty(spark, f"{path}/mark", "id bigint, batch bigint").agg(F.max("batch")).scalar()
    still = read_or_empty(spark, f"{path}/open", EPISODE_DDL + ", batch bigint").filter(F.col("batch") == top).drop("batch")
    return written(spark, f"{path}/done", EPISODE_DDL).unionByName(still)


def replace_day(root: str, expected: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """STR-05 sink: a batch of quads becomes the live version if its counts agree, else the old stays."""
    def each(df: DataFrame, batch: int) -> None:
        day = spool(df)  # read from the stream once; counts read the graph alone
        replace_graphs(day, root, cut_lineage(expected(day)), f"{batch:010d}")
    return each
