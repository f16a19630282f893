"""Target-distribution importance resampling: documents that look like a target set, drawn by weighted noise.

A document's features are hashed into buckets; a bucket's gain is the log ratio of its share in the
target and in all documents, rounded down to thousandths, and a document's weight is the sum of the
gains of its features, read from one array. Adding Gumbel noise that depends on seed and id alone and
keeping the highest scores is a draw without replacement in proportion to exp(weight).

The order comes from a least-significant-digit radix sort that Spark distributes. Score, id and number
of features are packed into integers and cut into digits. In each pass rows lie in blocks of
consecutive positions; rows are counted by (digit, block), a prefix sum over digits and blocks gives
where each such group starts, and a row's place in its group, by its earlier position, gives its
destination. No group is larger than a block, so a digit that all rows share is no hot group.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitframe.llm.common import discard, stored

BUCKETS = 10000
LONGEST_RUN = 1  # words in a feature
FEWEST = 20  # words of a document that may be drawn
PERCENT = 10
SEED = 2024
DIGIT = 12  # bits of a radix digit
BLOCK = 1 << 16  # positions that a counting pass ranks together
SEGMENT = 1 << 20  # bytes of text that are cut into words at a time

# words are digits, lower-case letters and everything beyond ASCII; A-Z is lowered, the rest divides
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Buckets(dict):
    """Bucket of a feature; forgets what it knows once it holds a million features."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % self.buckets
        return value


def feature_buckets(text: bytes | None, known: Buckets, longest_run: int = LONGEST_RUN) -> Iterator[np.ndarray]:
    """Buckets of all features of one text, a segment at a time; runs may cross segments."""
    raw, at, tail = (text or b"").translate(_LOWER), 0, []
    while at < len(raw):
        end = raw.find(b" ", at + SEGMENT) if at + SEGMENT < len(raw) else -1
        end = len(raw) if end < 0 else end
        words = raw[at:end].split()
        at = end
        yield np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        for n in range(2, longest_run + 1):
            line = tail[len(tail) - min(n - 1, len(tail)):] + words
            runs = [b" ".join(line[i:i + n]) for i in range(len(line) - n + 1)]
            yield np.fromiter(map(known.__getitem__, runs), np.int64, len(runs))
        tail = (tail + words)[-(longest_run - 1):] if longest_run > 1 else []


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest_run: int = LONGEST_RUN) -> np.ndarray:
    """Features of all rows by bucket: each task sums its own rows, Spark sums the tasks. Null texts have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for part in feature_buckets(text.as_py(), known, longest_run):
                    np.add.at(total, part, 1)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])
    rows = texts.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of the B buckets."""
    b, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000.0 * math.log((float(t) + 1.0) * (all_s + b) / ((float(s) + 1.0) * (all_t + b)))) for s, t in zip(source, target, strict=True)], np.int64)


def noise(id_col: str | Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256("seed:id"); a null id counts as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weighed(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest_run: int = LONGEST_RUN) -> DataFrame:
    """(id, words, n_features, weight) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(len(gains))
        for batch in batches:
            words, features, weights = [], [], []
            for text in batch.column("text"):
                parts = list(feature_buckets(text.as_py(), known, longest_run))
                words.append(sum(len(p) for p in parts[::longest_run]))
                features.append(sum(len(p) for p in parts))
                weights.append(int(sum(gains[p].sum() for p in parts)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.int64()) for x in (words, features, weights))], ["id", "words", "n_features", "weight"])
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, words long, n_features long, weight long")


def packed(rows: DataFrame, fields: list[Column]) -> tuple[DataFrame, list[tuple[str, int]]]:
    """(rows with integers k0, k1, ..., their bits from the least significant on): the composite sort key.

    ``fields`` are long columns without nulls, most significant first, each spanning less than 2^62;
    bits follow from each field's smallest and largest value.
    """
    named = rows.select("*", *[f.alias(f"f{i}") for i, f in enumerate(fields)])
    ends = named.agg(*[g(f"f{i}").alias(f"{n}{i}") for i in range(len(fields)) for n, g in (("lo", F.min), ("hi", F.max))]).first()
    limbs: list[tuple[Column, int]] = []
    for i in reversed(range(len(fields))):
        low, high = ends[f"lo{i}"] or 0, ends[f"hi{i}"] or 0
        bits, value = (high - low).bit_length(), F.col(f"f{i}") - F.lit(low)
        if limbs and limbs[-1][1] + bits <= 62:
            limbs[-1] = (limbs[-1][0] + F.shiftleft(value, limbs[-1][1]), limbs[-1][1] + bits)
        else:
            limbs.append((value, bits))
    out = named.select(*rows.columns, *[v.cast("long").alias(f"k{j}") for j, (v, _) in enumerate(limbs)])
    return out, [(f"k{j}", bits) for j, (_, bits) in enumerate(limbs)]


def radix_ranks(rows: DataFrame, fields: list[Column], uid: str = "uid", digit: int = DIGIT, block: int = BLOCK) -> DataFrame:
    """(uid, rank from 1) of stored rows in ascending order of ``fields``, ties in order of blocks and uid.

    ``uid`` is a unique long that doesn't change when a task runs again. Rows of each pass are written,
    so a lost executor costs the running pass alone. Memory holds one block of a digit; the tables of
    counts have a row for each digit of each block.
    """
    keyed, limbs = packed(rows, fields)
    state = stored(keyed.select(F.col(uid).alias("uid"), *[k for k, _ in limbs]))
    n = state.count()
    spread = F.pmod(F.xxhash64("uid"), F.lit(max(1, -(-n // block))))  # the first pass may meet rows in any order
    place, order, first = spread, "uid", True
    for name, bits in limbs:
        passes = max(-(-bits // digit), 1 if first and (name, bits) == limbs[-1] else 0)
        width = -(-bits // passes) if passes else 0
        for p in range(passes):
            now = state.withColumn("digit", F.shiftright(name, p * width).bitwiseAND((1 << width) - 1)).withColumn("block", place)
            counts = now.groupBy("digit", "block").agg(F.count("*").alias("n"))
            whole = counts.groupBy("digit").agg(F.sum("n").alias("n"))
            upto = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
            starts = whole.select("digit", upto(W.orderBy("digit")).alias("start"))  # at most 2^digit rows
            groups = counts.select("digit", "block", upto(W.partitionBy("digit").orderBy("block")).alias("before")).join(F.broadcast(starts), "digit")
            ranked = now.withColumn("nth", F.row_number().over(W.partitionBy("digit", "block").orderBy(order)) - 1)
            moved = ranked.join(groups, ["digit", "block"]).select("uid", *[k for k, _ in limbs], (F.col("start") + F.col("before") + F.col("nth")).alias("pos"))
            before, state = state, stored(moved)
            discard(before)
            place, order, first = F.floor(F.col("pos") / block), "pos", False
    return state.select("uid", (F.col("pos") + 1).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS, longest_run: int = LONGEST_RUN, fewest: int = FEWEST, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of ``docs``; rank is null for rows not drawn.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered, features all runs of
    1 to ``longest_run`` words. Of the rows with at least ``fewest`` words ``percent`` in a hundred are
    drawn, highest score first, ties to the smaller id, null ids last, then to fewer features. Null
    and empty texts have no features and weight 0. Rows that repeat an id are rows like others; equal
    rows get ranks next to each other. An empty table gives no rows, an empty target weights of all
    documents against nothing. Ids are integers; other columns of either table are not read.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, longest_run), bucket_counts(target, target_text, buckets, longest_run))
    rows = weighed(docs, gains, id_col, text_col, longest_run)
    rows = stored(rows.select(F.monotonically_increasing_id().alias("uid"), "*", (F.col("weight") + noise("id", seed)).alias("score")))
    able = rows.filter(F.col("words") >= fewest)
    wanted = able.count() * percent // 100
    whole = F.col("id").cast("long")
    last = F.lit(1 << 32)  # above the upper half of any id
    fields = [-F.col("score"), F.coalesce(F.shiftright(whole, 32), last), F.coalesce(whole.bitwiseAND(0xFFFFFFFF), F.lit(0)), F.col("n_features")]
    drawn = radix_ranks(able, fields).filter(F.col("rank") <= wanted)
    return rows.join(drawn, "uid", "left").select("id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
