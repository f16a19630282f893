"""Delivered folders: file hashes against their manifest, windows from file names."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = r"^([0-9a-f]{64})  (.+)$"


def parse_manifest(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``SHA256SUMS`` lines to (file, expected), and the lines that do not read."""
    good = lines.filter(F.col("value").rlike(LINE)).select(
        F.regexp_extract("value", LINE, 2).alias("file"), F.regexp_extract("value", LINE, 1).alias("expected"))
    return good, lines.filter(~F.col("value").rlike(LINE) & (F.trim("value") != ""))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, path, length) of a folder; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    return listed.withColumn("file", F.substring_index("path", "/", -1))


LARGE = 1 << 30  # bytes from which a file is streamed; a binary column holds less than 2 GB


def file_hashes(spark: SparkSession, folder: str, large: int = LARGE) -> DataFrame:
    """(file, actual): every file hashed in the JVM, from any file system Spark reads.

    Files of ``large`` bytes or more are read as streams by the driver's JVM, several at a time, each
    through one buffer; the others are hashed by Spark's tasks. Only paths and digests are held.
    """
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    small = binary.filter(F.col("length") < large).select(F.substring_index("path", "/", -1).alias("file"), F.sha2("content", 256).alias("actual"))
    paths = [r["path"] for r in binary.filter(F.col("length") >= large).select("path").collect()]
    if not paths:
        return small
    with ThreadPoolExecutor(4) as pool:
        digests = list(pool.map(lambda path: streamed_sha256(spark, path), paths))
    return small.unionByName(spark.createDataFrame([(p.rsplit("/", 1)[-1], d) for p, d in zip(paths, digests, strict=True)], "file string, actual string"))


def streamed_sha256(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file of any length, read in order through its Hadoop file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        return spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def compare_hashes(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(file, expected, actual, status): ok, changed, missing, unlisted, or empty.

    Spark lists no file of zero bytes, so one whose expected hash is that of no bytes is ``empty``
    whether it is there or not.
    """
    both = expected.withColumn("file", F.substring_index("file", "/", -1)).join(actual, "file", "full_outer")
    no_bytes = F.col("expected") == F.sha2(F.lit("").cast("binary"), 256)
    status = (F.when(F.col("actual").isNull() & no_bytes, "empty").when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "unlisted")
              .when(F.col("actual") == F.col("expected"), "ok").otherwise("changed"))
    return both.withColumn("status", status)


def verify_manifest(spark: SparkSession, folder: str, manifest: str = "SHA256SUMS") -> DataFrame:
    """Every file of a folder against the manifest it carries."""
    expected, _ = parse_manifest(spark.read.text(f"{folder}/{manifest}"))
    return compare_hashes(expected, file_hashes(spark, folder).filter(F.col("file") != manifest))


def discover_windows(files: DataFrame, label: str, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows named by ``<label>_<window>.db`` files in date order, and the unknown ones."""
    pattern = rf"^{label}_([PH][0-9]+|C[0-9]+|LIVE)\.db$"
    found = files.filter(F.col("file").rlike(pattern)).select("file", F.regexp_extract("file", pattern, 1).alias("window"))
    stray = found.join(known.select("window"), "window", "left_anti")
    return found.join(known, "window").orderBy("d_start", "window"), stray
