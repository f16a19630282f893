"""SimHash near-duplicates: one-wildcard segment variants, equality join, verification.

Two 64-bit fingerprints with at most two differing bits, cut into two segments of 32 bits, have a
segment that differs by at most one bit. A variant names a segment, a wildcard bit and the other 31
bits; fingerprints that share no variant can't link. Exact copies share a fingerprint and are
collapsed before any variant is made.

Buckets of up to ``PAIR_BUCKET`` fingerprints are self-joined on the variant and verified. Members of
larger buckets link through midpoints: two values differ in at most two bits exactly if some 64-bit
value is within one bit of both, and at most 65 distinct values lie within one bit of a value. So a
hot bucket gives 65 rows a member and groups of at most 65, with no loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.common import components, fresh, give_back, row_key, stored, text_hash

SEED = 42
SHINGLE = 3
PAIR_BUCKET = 32
SENT_KEYS = 1 << 20
SLICE = 1 << 16


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash; ASCII lower case, ASCII white space, repeats counted, no words: zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, SLICE):
        part = words[i:min(i + SLICE, n) + SHINGLE - 1]
        grams = map(b" ".join, zip(part, part[1:], part[2:], strict=False)) if len(part) >= SHINGLE else [b" ".join(part)]
        h = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, fp) per row of any table with an id and a text; null texts count as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame({"id": x["id"], "th": x["th"], "fp": np.array([fingerprint(t) for t in x["text"]], np.int64)})
        give_back()
    return docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, th long, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): 64 one-wildcard segment variants of each fingerprint."""
    seg = "shiftrightunsigned(fp, IF(i < 32, 0, 32)) & 4294967295L"
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a fingerprint is a few bytes and makes 64 rows
    return fps.select("fp").repartition(parts, "fp").select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i")).select(
        F.expr(f"(({seg}) & ~shiftleft(1L, i % 32)) | shiftleft(cast(i AS bigint), 32)").alias("key"), "fp")


def links(fps: DataFrame) -> DataFrame:
    """(a, b) of distinct fingerprints at two bits or fewer; the pairs have the components of all such pairs."""
    close = F.expr("bit_count(a ^ b) <= 2")
    by_key = stored(variants(fps).groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"))
    twos = by_key.filter("n = 2").select("a", "b").filter(close)
    large = by_key.filter("n > 2").select("key", "n")
    few = large.count() <= SENT_KEYS  # 16 MB; else both sides are shuffled on the key
    members = stored(variants(fps).join(F.broadcast(large) if few else large, "key"))
    some = members.filter(F.col("n") <= PAIR_BUCKET)
    joined = some.select("key", F.col("fp").alias("a")).join(some.select("key", F.col("fp").alias("b")), "key").filter("a < b").select("a", "b").filter(close)
    hot = members.filter(F.col("n") > PAIR_BUCKET).select("fp").distinct()
    near = hot.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i")).select("fp", F.expr("if(i = 64, fp, fp ^ shiftleft(1L, i))").alias("mid"))
    mids = near.groupBy("mid").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
    star = mids.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b")
    return twos.union(joined).union(star).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, fp, root, component): every row with the smallest id reachable over links of two bits or fewer.

    Null texts and texts without words have fingerprint zero and link like any other. Null ids are
    kept and never name a component unless all its ids are null. Repeated rows come out repeated; an
    empty table gives no rows.
    """
    rows = stored(fingerprints(docs, id_col, text_col))
    own = stored(rows.groupBy("fp").agg(F.min("id").alias("least")))
    comp = components(links(own.select("fp"))).withColumnRenamed("node", "fp")
    linked = stored(own.join(comp, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = stored(linked.groupBy("root").agg(F.min("least").alias("component")))
    named = stored(linked.join(least, "root").select("fp", "root", "component"))
    return rows.join(named, "fp").select("id", "th", "fp", "root", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row kept of each group: smallest id (null last), then smallest text hash.

    All columns are kept. The choice is made on ids and hashes alone; texts move once, to meet it.
    """
    rows = near_duplicates(docs, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    best = stored(rows.groupBy("root").agg(F.min(order).alias("o")).select(*row_key(F.col("o.id"), F.col("o.th"))))
    keys = [fresh(docs, k) for k in best.columns]
    own = [k.alias(n) for k, n in zip(row_key(F.col(id_col), text_hash(text_col)), keys, strict=True)]
    kept = docs.select("*", *own).join(best.toDF(*keys), keys, "left_semi")
    return kept.dropDuplicates(keys).drop(*keys)
