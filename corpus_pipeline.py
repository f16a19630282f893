"""From raw documents to packed token ids: toxicity, near-duplicates, benchmark leaks, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns documents, the last one the digest of its token
files. Every stage works on all that the one before it kept, and is written before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitframe.llm import decontaminate, mixing, simhash, token_store, toxicity
from pitframe.llm.common import ship, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject at their language's threshold."""
    ship(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    ship(spark)
    return simhash.one_of_each(docs).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ship(spark)
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as their source's target asks for."""
    ship(spark)
    return mixing.mixed_rows(docs).select(*COLUMNS)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, read back from the token files."""
    ship(spark)
    return token_store.token_digest(docs).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


STAGES = [("toxicity", without_toxic), ("simhash", near_dedup), ("decontamination", decontaminated), ("mixing", mixed), ("tokens", tokenised)]

# a trained classifier, chained links and a tokenizer are not SQL; tests compare each stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
