"""Session settings, lineage cutting and size checks shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE does the run-time work the library relies on: it coalesces small shuffle partitions, splits
# skewed join partitions (also when that costs one more exchange) and turns a join into a
# broadcast only after it has measured the side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# A side is broadcast by hint only below this many bytes of Catalyst's size estimate.
BROADCAST_BYTES = 32 * 1024 * 1024
# Of input, to a task of an aggregate that holds or sorts its rows.
TASK_BYTES = 4 * 1024 * 1024
MOST_TASKS = 4096


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    builder = SparkSession.builder.master(master).appName("pitframe")
    conf = dict(SETTINGS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.driver.memory"] = "8g"
    conf["spark.checkpoint.compress"] = "true"
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster shares (spark.checkpoint.dir). A local session without one gets a folder of its own; a cluster must name one."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
    sc._pitframe_folder = getattr(sc, "_pitframe_folder", None) or tempfile.mkdtemp(prefix="spark-")
    return sc._pitframe_folder


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Checkpoint to the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager)


def spool(df: DataFrame) -> DataFrame:
    """Write a large table once to the shared folder and read it back.

    As :func:`cut_lineage`, but columnar: quads repeat their graph, predicate and subject and take a
    fraction of a checkpoint's disk, and readers take the columns and predicates they need.
    """
    path = f"{shared_root(df.sparkSession)}/spool-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, without running it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def tasks_of(df: DataFrame) -> int:
    """Tasks that a stored table asks for, at ``TASK_BYTES`` each; one for a small one."""
    return min(-(-estimated_bytes(df) // TASK_BYTES), MOST_TASKS)


def tasks_for(*dfs: DataFrame) -> int:
    """Tasks that the tables below these plans ask for, at ``TASK_BYTES`` of Catalyst's size estimate each."""
    leaves = [x for df in dfs for x in _leaves(df)]
    spark = dfs[0].sparkSession
    return max(spark.sparkContext.defaultParallelism, min(-(-sum(leaves) // TASK_BYTES), MOST_TASKS))


def _leaves(df: DataFrame) -> list[int]:
    found = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(found.apply(i).stats().sizeInBytes())) for i in range(found.size())]
    return [n for n in sizes if n < 1 << 50]  # Spark gives rows of the driver, and others it can't size, more than any disk holds


def spread(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """Deal rows out by keys over as many tasks as the input asks for, so that a task's share stays the same however large it is.

    AQE joins small partitions up to 64 MB of compressed bytes, and quads and ids compress by ten and
    more; it leaves a number that is named as it is. What groups or joins by these keys next moves nothing again.
    """
    return df.repartition(tasks or tasks_for(df), *keys)


def small_side(df: DataFrame, bound: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only while the size estimate is under the bound; else leave it to AQE."""
    return df.hint("broadcast") if estimated_bytes(df) <= bound else df
