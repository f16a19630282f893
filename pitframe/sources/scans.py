"""Scans with pinned columns and declared types; bad rows are reported, never guessed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitframe.functions.scalars import clean_symbol, is_ticker
from pitframe.operators.integrity import dup_keys
from pitframe.operators.quads import QUAD_DDL
from pitframe.plans.contracts import VIEW_COLUMNS, NOT_READ


def scan_view(spark: SparkSession, view: str, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Only the pinned columns of a view, in pinned order; the scan prunes the rest.

    ``fmt="jdbc"`` reads the same columns from a database with the given options.
    """
    reader = spark.read.format(fmt).options(**options)
    df = reader.load(path) if fmt != "jdbc" else reader.option("dbtable", view).load()
    return df.select(*VIEW_COLUMNS[view])


def schema_version(df: DataFrame, column: str = "version") -> DataFrame:
    """Highest version of a version table, 0 if it is empty."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("version"))


def contract_diff(actual: DataFrame, pinned: Mapping[str, Sequence[str]] = VIEW_COLUMNS, not_read: Sequence[str] = NOT_READ) -> DataFrame:
    """Pinned against actual columns (``view``, ``columns`` array): (view, severity, detail).

    A lost column or view and an unknown view are drift; added or reordered columns are notes.
    """
    spark = actual.sparkSession
    pin = spark.createDataFrame([(v, list(c)) for v, c in pinned.items()], "view string, pinned array<string>")
    rows = actual.select("view", "columns").join(pin, "view", "full_outer")
    gone, new = F.array_except("pinned", "columns"), F.array_except("columns", "pinned")
    kept = F.filter("columns", lambda c: F.array_contains("pinned", c))
    text = lambda label, arr: F.concat(F.lit(label), F.array_join(F.array_sort(arr), ", "))
    cell = lambda cond, severity, detail: F.when(cond, F.struct(F.lit(severity).alias("severity"), detail.alias("detail")))
    skip = F.col("view").isin(*(not_read or ("",)))
    both = F.col("pinned").isNotNull() & F.col("columns").isNotNull() & (F.size("columns") > 0)
    cells = F.array(
        cell(F.col("columns").isNull(), "drift", F.lit("no longer defined")),
        cell(F.col("pinned").isNotNull() & (F.size("columns") == 0), "drift", F.lit("did not build")),
        cell(both & (F.size(gone) > 0), "drift", text("removed: ", gone)),
        cell(both & (F.size(new) > 0), "note", text("added: ", new)),
        cell(both & (F.size(gone) == 0) & (kept != F.col("pinned")), "note", F.lit("column order changed")),
        cell(F.col("pinned").isNull() & ~skip, "drift", F.lit("neither pinned nor listed")))
    return rows.select("view", F.inline(F.filter(cells, lambda x: x.isNotNull())))


def scan_stints(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Membership stints with cleaned symbols, and the rejected rows with their reason.

    Rejected: a symbol that is no ticker, an interval that ends before it starts. A one-day stint
    is kept; an empty CIK is NULL.
    """
    rows = df.withColumn("raw_symbol", F.col("symbol")).withColumn("symbol", clean_symbol(F.col("symbol")))
    rows = rows.withColumn("cik", F.when(F.col("cik") != "", F.col("cik")))
    why = F.when(~is_ticker(F.col("symbol")) | F.col("symbol").isNull(), "not a ticker").when(
        F.col("valid_to") < F.col("valid_from"), "ends before it starts")
    rows = rows.withColumn("reason", why)
    return rows.filter("reason IS NULL").drop("reason", "raw_symbol"), rows.filter("reason IS NOT NULL")


def _reject(df: DataFrame, why: Column) -> DataFrame:
    return df.withColumn("reason", why)


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str] = (), expected_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """JSON lines with the schema's exact key list, in order: (rows, problems).

    Problems: blank line, not an object, other keys, unreadable field, repeated key, row count.
    """
    names = [f.name for f in schema.fields]
    lines = spark.read.text(path).withColumn("file", F.col("_metadata.file_path"))
    corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("value", corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.withColumn("_keys", F.json_object_keys("value")).withColumn("_row", parsed)
    want = F.array(*[F.lit(n) for n in names])
    why = (F.when(F.trim("value") == "", "blank line").when(F.col("_keys").isNull(), "not an object")
           .when(F.col("_keys") != want, "keys differ").when(F.col("_row._corrupt").isNotNull(), "unreadable field"))
    rows = _reject(rows, why)
    good = rows.filter("reason IS NULL").select(*[F.col(f"_row.{n}").alias(n) for n in names])
    problems = rows.filter("reason IS NOT NULL").select("reason", F.col("value").alias("detail"))
    if key:
        problems = problems.unionByName(dup_keys(good, key).select(F.lit("repeated key").alias("reason"), F.concat_ws("/", *key).alias("detail")).distinct())
    if expected_rows is not None:
        n = lines.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") != expected_rows)
        problems = problems.unionByName(n.select(F.lit("row count").alias("reason"), F.col("n").cast("string").alias("detail")))
    return good, problems


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """CSV with the schema's exact header, read as text and cast: (rows, problems).

    ``enforceSchema=False`` makes Spark compare every file's header with the schema. An empty cell
    is NULL; a cell that does not cast is a problem, and its row is left out.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    text = spark.read.csv(path, header=True, schema=raw, enforceSchema=False, emptyValue="", mode="FAILFAST")
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    bad = [F.when(F.col(n).isNotNull() & (F.col(n) != "") & c.isNull(), F.lit(n)) for n, c in cast.items()]
    need = [F.when(F.coalesce(F.col(f.name), F.lit("")) == "", F.lit(f.name)) for f in schema.fields if not f.nullable]
    rows = text.withColumn("_bad", F.concat_ws(",", *bad)).withColumn("_need", F.concat_ws(",", *need) if need else F.lit(""))
    good = rows.filter("_bad = '' AND _need = ''").select(*[c.alias(n) for n, c in cast.items()])
    shown = F.to_json(F.struct(*raw.names))
    problems = rows.filter("_bad <> ''").select(F.concat(F.lit("unreadable: "), "_bad").alias("reason"), shown.alias("detail")).unionByName(
        rows.filter("_bad = '' AND _need <> ''").select(F.concat(F.lit("missing: "), "_need").alias("reason"), shown.alias("detail")))
    if key:
        problems = problems.unionByName(dup_keys(good, key).select(F.lit("repeated key").alias("reason"), F.concat_ws("/", *key).alias("detail")).distinct())
    return good, problems


def scan_json_doc(spark: SparkSession, path: str, schema: T.StructType, array: str) -> tuple[DataFrame, DataFrame]:
    """One JSON document per file: the rows of one of its arrays, and the keys its schema lacks."""
    docs = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    extra = docs.select("file", F.explode(F.array_except(F.json_object_keys("value"), names)).alias("key"))
    rows = docs.select("file", F.from_json("value", schema).alias("d")).select("file", F.inline(f"d.{array}"))
    return rows, extra


def scan_rankings(df: DataFrame, column: str = "value") -> DataFrame:
    """(date, asset_id) of a map from decision date to ranked rows; ``{rows: [...]}`` or a bare list."""
    entries = df.select(F.explode(F.from_json(column, "map<string,string>")).alias("date", "body"))
    inner = F.coalesce(F.get_json_object("body", "$.rows"), F.col("body"))
    items = F.from_json(inner, "array<string>")
    ident = lambda x: F.coalesce(F.get_json_object(x, "$.asset_id"), x).try_cast("bigint")
    return entries.select("date", F.explode(F.transform(items, ident)).alias("asset_id")).filter("asset_id IS NOT NULL").distinct()


def scan_news(articles: DataFrame, sentiment: DataFrame, category: DataFrame, key: str = "id", ok: str = "fetch_status") -> DataFrame:
    """Fetched articles with their sentiment and category."""
    return articles.filter(F.col(ok) == "ok").drop(ok).join(sentiment, key).join(category, key)


def scan_run_manifest(docs: DataFrame, column: str = "value", configurations: Sequence[str] = (), books: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One row per (label, configuration, window) of run manifests, and the rows outside the vocabularies."""
    shape = ("label string, configurations array<struct<configuration:string, runs:array<struct<window:string, database:string, "
             "book_id:bigint, book_code:string, files:map<string,string>, files_sha256:map<string,string>>>>>")
    d = docs.select(F.from_json(column, shape).alias("d")).select("d.label", F.explode("d.configurations").alias("c"))
    rows = d.select("label", F.col("c.configuration").alias("configuration"), F.explode("c.runs").alias("r")).select("label", "configuration", "r.*")
    why = F.when(~F.col("configuration").isin(*configurations), "unknown configuration") if configurations else F.lit(None).cast("string")
    if books:
        why = F.coalesce(why, F.when(~F.col("book_code").isin(*books), "unknown book"))
    why = F.coalesce(why, F.when(F.size(F.array_except(F.map_keys("files"), F.map_keys("files_sha256"))) > 0, "a file has no hash"))
    return rows, rows.withColumn("reason", why).filter("reason IS NOT NULL")


def scan_quads(spark: SparkSession, path: str, graphs: Sequence[str] = (), prefix: str | None = None, family: str | None = None) -> DataFrame:
    """The quad table limited to named graphs or a prefix; ``family`` prunes partitions.

    Files are sorted by graph, so graph filters also skip row groups by their statistics.
    """
    df = spark.read.schema(QUAD_DDL + ", graph_family string").parquet(path)
    if family is not None:
        df = df.filter(F.col("graph_family") == family)
    if graphs:
        df = df.filter(F.col("graph").isin(*graphs))
    if prefix is not None:
        df = df.filter(F.col("graph").startswith(prefix))
    return df.drop("graph_family")
