"""Shared helpers: stored tables, row identity, connected components and row-wise Arrow maps."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitframe.session import shared_root

AT_ONCE = 1024  # rows of a batch held as Python texts
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give every executor this package once per session, for functions that run in its Python workers."""
    sc = spark.sparkContext
    if getattr(sc, "_pitframe_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    where = Path(tempfile.mkdtemp(prefix="spark-")) / f"{top.name}.zip"
    with zipfile.ZipFile(where, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(where))
    sc._pitframe_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one the cluster shares."""
    return f"{shared_root(spark)}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends in files every executor sees."""
    where = shared_folder(df.sparkSession)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_hash(text: str = "text") -> Column:
    """With doc_id it names a row; rows that share both are repeated rows with equal results."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def row_key(ident: Column, th: Column, *more: Column) -> list[Column]:
    """Columns that are never null and equal exactly where (ident, th, *more) are null-safe equal.

    Equality on them leaves a join dealt and sorted by its keys, so that a group of the same keys
    moves no row again; a null-safe equality doesn't.
    """
    parts = [x for c in (ident, *more) for x in (c.isNull(), F.coalesce(c.cast("string"), F.lit("")))]
    return [x.alias(f"_key{i}") for i, x in enumerate([*parts, th])]


def give_back() -> None:
    """Give a worker's freed memory back: a worker outlives its task, and the next stage shares its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def parts(batch: pa.RecordBatch, rows: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """A batch in slices, without copies, so that few of its texts are Python objects at a time."""
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the caller's table doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(df: DataFrame, keep: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[bool]]]]) -> DataFrame:
    """Rows for which the mask is true, all columns untouched (types, nulls and names)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, mask in keep(batches):
            yield batch.filter(pa.array(mask, pa.bool_()))
    return df.mapInArrow(run, df.schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node of an edge list of longs a representative of its component.

    Contraction: every node takes the smallest hashed label among itself and its neighbours, edges
    are rewritten to labels, loops and repeats go. The edge list shrinks by a factor each round, so
    the rounds grow with the logarithm of the longest chain; there is no round limit. Minima are
    partial aggregates, so a node with many neighbours is no hot group; both sides of each join are
    stored tables, so AQE can split a large key. No edges give no rows.
    """
    mixed = lambda c: F.struct(F.xxhash64(c).alias("h"), c.alias("n"))
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    pairs = stored(pairs.union(pairs.select("b", "a")).distinct())
    total = None
    while not pairs.isEmpty():
        low = pairs.groupBy("a").agg(F.min(mixed(F.col("b"))).alias("m"))
        step = stored(low.select("a", F.least("m", mixed(F.col("a")))["n"].alias("r")))
        if total is None:
            total = step.select(F.col("a").alias("node"), F.col("r").alias("root"))
        else:
            total = total.join(step, total.root == step.a, "left").select("node", F.coalesce("r", "root").alias("root"))
        total = stored(total)
        one = pairs.join(step, "a").select("b", F.col("r").alias("x"))
        step2 = step.select(F.col("a").alias("b"), F.col("r").alias("y"))
        pairs = stored(one.join(step2, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if total is None:
        return edges.sparkSession.createDataFrame([], "node long, root long")
    return total
