"""Token ids as directly addressable codes: any token can be read without decoding a block.

Ids are cut into 8-bit chunks, lowest first. Level 0 holds one chunk of every id; a bitmap says which
ids go on, and only those have a chunk on the next level. A rank directory (ones before every 512
bits) finds an id's place on the next level with one lookup and a few bit counts.

A file is a Parquet row per shard: shard number, document ids and lengths, and the code bytes. The
code bytes describe themselves:

    "DAC1", levels u32, ids u64, then per level: entries u64, chunks u8 each, and, but for the last
    level, bitmap u64 words and the rank directory u32 (one per 8 words); all little-endian.

Documents are dealt out by range of id, so shards in order hold the ids in order. A shard closes at
``SHARD`` ids; a longer document has a shard of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitframe.llm.common import give_back, parts, shared_folder, text_hash
from pitframe.llm.tokens import PieceCache, library

SHARD = 1 << 20
END_ID = 2
WORDS = 8  # 64-bit bitmap words to a directory entry
MAGIC = b"DAC1"


def encode(ids: np.ndarray) -> bytes:
    """Code bytes of unsigned 32-bit ids; no ids give a single empty level."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = (rest >> 8) > 0
        levels.append(((rest & 255).astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> 8
    out = [MAGIC, np.array([len(levels)], "<u4").tobytes(), np.array([len(ids)], "<u8").tobytes()]
    for k, (chunks, more) in enumerate(levels):
        out += [np.array([len(chunks)], "<u8").tobytes(), chunks.tobytes()]
        if k + 1 < len(levels):
            bits = np.packbits(more, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view("<u8")
            ones = np.bitwise_count(bits).astype(np.int64)
            before = np.concatenate([[0], np.cumsum(ones)])[:-1][::WORDS]
            out += [bits.tobytes(), before.astype("<u4").tobytes()]
    return b"".join(out)


class Codes:
    """Code bytes opened for access; arrays are views of the bytes."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token code file")
        n_levels, self.n = int(np.frombuffer(raw, "<u4", 1, 4)[0]), int(np.frombuffer(raw, "<u8", 1, 8)[0])
        at, self.levels = 16, []
        for k in range(n_levels):
            n = int(np.frombuffer(raw, "<u8", 1, at)[0])
            chunks = np.frombuffer(raw, np.uint8, n, at + 8)
            at += 8 + n
            bits = before = None
            if k + 1 < n_levels:
                words = (n + 63) // 64
                bits = np.frombuffer(raw, "<u8", words, at)
                before = np.frombuffer(raw, "<u4", (words + WORDS - 1) // WORDS, at + 8 * words)
                at += 8 * words + 4 * len(before)
            self.levels.append((chunks, bits, before))

    def get(self, i: int) -> int:
        """The id at place ``i``, read from one chunk of each of its levels."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, before in self.levels:
            value |= int(chunks[i]) << shift
            if bits is None:
                break
            word, bit = divmod(i, 64)
            own = int(bits[word])
            if not own >> bit & 1:
                break
            start = word - word % WORDS
            i = int(before[word // WORDS]) + int(np.bitwise_count(bits[start:word]).sum()) + (own & ((1 << bit) - 1)).bit_count()
            shift += 8
        return value

    def all(self) -> np.ndarray:
        value = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            here = chunks.astype(np.uint32)
            if bits is not None:
                more = np.unpackbits(bits.view(np.uint8), bitorder="little", count=len(chunks)).astype(bool)
                here[more] |= value << np.uint32(8)
            value = here
        return value


@lru_cache(maxsize=2)
def encoder(name: str) -> PieceCache:
    """One per worker process: ids as packed 32-bit bytes, pre-tokens by the library's model, other words by all of it."""
    tok = library(name)
    give_back()  # the parsed file
    model = tok.model
    pack = lambda ids: np.array(ids, "<u4").tobytes()
    return PieceCache(lambda p: pack([t.id for t in model.tokenize(p)]), lambda w: pack(tok.encode(w, add_special_tokens=False).ids))


def write_tokens(docs: DataFrame, path: str, name: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard: int = SHARD) -> None:
    """Encode every row and write the shards. Null texts are empty and hold the end id alone.

    Null ids come last; equal ids are ordered by text hash. An empty table writes no shard.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc_nulls_last(), F.col("th")]
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(F.spark_partition_id().cast("long").alias("part"), "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, stop = encoder(name), np.array([end_id], "<u4").tobytes()
        part, seq, ids, lengths, codes, held, id_type = 0, 0, [], [], [], 0, None

        def close() -> pa.RecordBatch:
            raw = encode(np.frombuffer(b"".join(codes), "<u4"))
            row = [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([held], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([lengths], pa.list_(pa.int64())), pa.array([raw], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["part", "seq", "n_ids", "ids", "lengths", "codes"])
        for x in (p for b in batches for p in parts(b)):
            part, id_type = x.column("part")[0].as_py(), x.column("id").type
            for doc, text in zip(x.column("id").to_pylist(), x.column("text").to_pylist(), strict=True):
                raw = b"".join(ids_of.values(text)) + stop
                if held and held + len(raw) // 4 > shard:
                    yield close()
                    seq, ids, lengths, codes, held = seq + 1, [], [], [], 0
                ids.append(doc)
                lengths.append(len(raw) // 4)
                codes.append(raw)
                held += len(raw) // 4
        if ids:
            yield close()
        give_back()
    rows.mapInArrow(run, f"part long, seq long, n_ids long, ids array<{kind}>, lengths array<long>, codes binary").write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    shards = spark.read.parquet(path)
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    before = F.sum("n_ids").over(W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1))
    starts = shards.select("part", "seq", F.coalesce(before, F.lit(0)).alias("first"))  # one short row a shard

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for part, seq, ids, lengths, codes in zip(x["part"], x["seq"], x["ids"], x["lengths"], x["codes"], strict=True):
                values = Codes(bytes(codes)).all().astype("<u4")
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(values[e - n:e].tobytes()) for e, n in zip(ends, lengths, strict=True)]
                yield pd.DataFrame({"part": part, "seq": seq, "id": pd.Series(list(ids), dtype=object), "offset": ends - lengths, "n_tokens": lengths, "ids_crc32": crc})
    docs = shards.select("part", "seq", "ids", "lengths", "codes").mapInPandas(run, f"part long, seq long, id {kind}, offset long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "seq"]).select("id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, path: str, places: DataFrame, place: str = "place") -> DataFrame:
    """(place, token) for places in the whole id sequence; each reads one chunk a level of its shard.

    Places that are null, negative or past the end give no row.
    """
    shards = spark.read.parquet(path)
    before = F.sum("n_ids").over(W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1))
    starts = shards.select("part", "seq", "n_ids", F.coalesce(before, F.lit(0)).alias("first"))
    step = SHARD
    bins = starts.withColumn("bin", F.explode(F.sequence(F.floor(F.col("first") / step), F.floor((F.col("first") + F.col("n_ids") - 1) / step))))
    asked = places.select(F.col(place).cast("long").alias("place")).withColumn("bin", F.floor(F.col("place") / step))
    hit = asked.join(bins, "bin").filter("place >= first AND place < first + n_ids").select("part", "seq", (F.col("place") - F.col("first")).alias("at"), "place")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"place": pd.Series(dtype="int64"), "token": pd.Series(dtype="int64")})
        codes = Codes(bytes(right["codes"].iloc[0]))
        return pd.DataFrame({"place": left["place"], "token": [codes.get(int(i)) for i in left["at"]]})
    codes = spark.read.parquet(path).select(F.col("part").alias("p"), F.col("seq").alias("q"), "codes")
    return hit.groupBy("part", "seq").cogroup(codes.groupBy("p", "q")).applyInPandas(run, "place long, token long")


def token_digest(docs: DataFrame, name: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards to a new shared folder and return what the files hold for each document."""
    path = shared_folder(docs.sparkSession)
    write_tokens(docs, path, name, id_col, text_col)
    return read_documents(docs.sparkSession, path)
