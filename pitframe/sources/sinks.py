"""Append-only and versioned writes. Every write is a plain Spark job a retried task can repeat."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitframe.operators.quads import QUAD_COLUMNS, ClassMap, graph_family, graph_sizes, melt, ntriples, table_sizes, type_quads
from pitframe.session import cut_lineage, small_side, spool, tasks_of
from pitframe.sources.catalogue import Catalogue

CHUNK = 20_000
GRAPH_ROWS = 400_000


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A Parquet table, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], ddl)


def append_graph(quads: DataFrame, path: str, max_records: int | None = None) -> DataFrame:
    """Append the graphs the store does not hold; returns (graph, status, triples).

    The catalogue says which graphs there are, so no stored quad is read. Names are looked at once a graph,
    and new quads meet the few new names where they lie. Rows are ranged by (graph,
    subject), so big graphs span files, small ones share one, and the row-group statistics of ``graph``
    let readers skip. ``max_records`` bounds the file chunks.
    """
    report, sizes, named, catalogue = _new_graphs(cut_lineage(graph_sizes(quads)), path)
    new = _of_graphs(quads, named)
    ranged = new.repartitionByRange("graph_family", "graph", "subject").sortWithinPartitions("graph", "subject", "predicate")
    _write(ranged, path, max_records)
    catalogue.register(new, sizes, uuid.uuid4().hex)
    return report


def append_tables(tables: Sequence[tuple[ClassMap, DataFrame]], path: str, sizes: DataFrame | None = None, max_records: int | None = None) -> DataFrame:
    """:func:`append_graph` of the quads of class tables: rows are ranged by (graph, subject) before they become quads.

    A row is a tenth of its quads, so that little is moved and sorted. A row's inverse links lie beside it, in the files of its graph.
    ``sizes``: triples per graph, where they are known.
    """
    report, sizes, named, catalogue = _new_graphs(cut_lineage(table_sizes(tables)) if sizes is None else sizes, path)
    new = [(m, _of_graphs(t, named)) for m, t in tables]
    ranged = [(m, t.repartitionByRange(max(1, tasks_of(own)), "graph_family", "graph", "subject").sortWithinPartitions("graph", "subject")) for (m, t), (_, own) in zip(new, tables)]
    families = small_side(sizes.select("graph", "graph_family"))
    quads = reduce(DataFrame.unionByName, [melt(t, m) for m, t in ranged])
    _write(quads.join(families, "graph"), path, max_records)
    catalogue.register(type_quads(new), sizes, uuid.uuid4().hex)
    return report


def _new_graphs(sizes: DataFrame, path: str) -> tuple[DataFrame, DataFrame, DataFrame, Catalogue]:
    """Report, sizes and names with families of the graphs the store lacks, and its catalogue."""
    catalogue = Catalogue(sizes.sparkSession, path)
    have = cut_lineage(catalogue.graphs().select("graph").distinct())
    report = cut_lineage(sizes.join(have.withColumn("_h", F.lit(True)), "graph", "left").select(
        "graph", F.when(F.col("_h"), "already-in-the-store").otherwise("written").alias("status"), "triples"))
    sizes = spool(report.filter("status = 'written'").withColumn("graph_family", F.coalesce(graph_family(F.col("graph")), F.lit("other"))))
    return report, sizes, small_side(sizes.select(F.col("graph").alias("_graph"), "graph_family")), catalogue


def _of_graphs(rows: DataFrame, named: DataFrame) -> DataFrame:
    return rows.join(named, F.col("graph").eqNullSafe(F.col("_graph"))).drop("_graph")


def _write(quads: DataFrame, path: str, max_records: int | None) -> None:
    writer = quads.write.mode("append").partitionBy("graph_family")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def split_graphs(df: DataFrame, date: str, max_rows: int = GRAPH_ROWS, per_row: int = 26) -> DataFrame:
    """Each row with its graph period: the year, or its half where the year would exceed the bound.

    ``split_error`` marks the rows of a year over the bound that has one half only. Years are few,
    so the counts come back by a broadcast Catalyst sizes itself.
    """
    year, first = F.year(date), F.month(date) <= 6
    n = df.groupBy(year.alias("_y")).agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(first, 1)).alias("_h1"))
    rows = df.withColumn("_y", year).join(n, "_y")
    fits = F.col("_n") * per_row <= max_rows
    half = F.when(first, "01-06").otherwise("07-12")
    period = F.when(fits, F.col("_y").cast("string")).otherwise(F.concat_ws(":", F.col("_y").cast("string"), half))
    lone = ~fits & ((F.col("_h1") == 0) | (F.col("_h1") == F.col("_n")))
    return rows.withColumn("period", period).withColumn("split_error", lone).drop("_y", "_n", "_h1")


def replace_graphs(staged: DataFrame, root: str, expected: DataFrame, version: str) -> DataFrame:
    """Stage a new version, check its counts, then switch a one-row pointer, and check what is live; else the old one stays.

    Returns the pointer row (version, switched, reason). A failed run leaves an unread folder only.
    """
    spark = staged.sparkSession
    target = f"{root}/version={version}"
    staged.select(*QUAD_COLUMNS).repartitionByRange("graph", "subject").write.mode("overwrite").parquet(target)
    written = graph_sizes(spark.read.parquet(target))
    off = written.join(expected.select("graph", F.col("triples").alias("want")), "graph", "full_outer").filter(
        ~F.col("triples").eqNullSafe(F.col("want")))
    bad = off.count()
    if bad == 0:
        spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").json(f"{root}/pointer")
        live = graph_sizes(current_graphs(spark, root)).join(expected.select("graph", F.col("triples").alias("want")), "graph", "full_outer")
        if not live.filter(~F.col("triples").eqNullSafe(F.col("want"))).isEmpty():  # another version was switched to meanwhile
            return spark.createDataFrame([(version, False, "the live graphs aren't this version's")], "version string, switched boolean, reason string")
    return spark.createDataFrame([(version, bad == 0, None if bad == 0 else f"{bad} graph(s) differ in size")],
                                 "version string, switched boolean, reason string")


def current_graphs(spark: SparkSession, root: str) -> DataFrame:
    """Quads of the version the pointer names last; pointer rows are only ever appended."""
    pointer = spark.read.schema("version string").json(f"{root}/pointer")
    latest = pointer.agg(F.max_by("version", F.col("version"))).first()[0]  # one row
    return spark.read.parquet(f"{root}/version={latest}")


def export_ntriples(quads: DataFrame, path: str) -> None:
    """Sorted, distinct N-Triples text, ranged over files by line."""
    lines = ntriples(quads).select(F.col("line").alias("value")).distinct()
    lines.repartitionByRange("value").sortWithinPartitions("value").write.mode("overwrite").text(path)


def late_keys_after(state: DataFrame, late: DataFrame, settled: DataFrame, layouts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Next late-key state and the stale keys dropped from it.

    ``state`` and ``late``: (view, columns, key); ``settled``: (view, key); ``layouts``: (view,
    columns) in use now. A key stored under other key columns can never match again.
    """
    l = layouts.select("view", F.col("columns").alias("_now"))
    known = state.join(l, "view", "left")
    stale = known.filter(F.col("_now").isNotNull() & (F.col("columns") != F.col("_now"))).drop("_now")
    live = known.filter(F.col("_now").isNull() | (F.col("columns") == F.col("_now"))).drop("_now")
    merged = live.unionByName(late.select(*live.columns)).dropDuplicates(["view", "key"])
    return merged.join(settled.select("view", "key"), ["view", "key"], "left_anti"), stale


def write_state(df: DataFrame, root: str, version: int) -> None:
    """A new version of a small state table; the one read before is never overwritten."""
    df.write.mode("overwrite").parquet(f"{root}/version={version:010d}")


def read_state(spark: SparkSession, root: str, ddl: str) -> tuple[DataFrame, int]:
    """Latest version of a state table and its number, (empty, 0) at first."""
    every = read_or_empty(spark, root, ddl + ", version int")
    last = every.agg(F.max("version")).first()[0]
    if last is None:
        return spark.createDataFrame([], ddl), 0
    return every.filter(F.col("version") == last).drop("version"), int(last)


def run_report(failures: DataFrame, quads: DataFrame) -> DataFrame:
    """Counts of one run as (section, key, rows): failures by view, check and fate; triples by graph."""
    a = failures.groupBy("view", "check", "fate").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("failure").alias("section"), F.concat_ws("/", "view", "check", "fate").alias("key"), "rows")
    b = graph_sizes(quads).select(F.lit("graph").alias("section"), F.col("graph").alias("key"), F.col("triples").alias("rows"))
    return a.unionByName(b)
