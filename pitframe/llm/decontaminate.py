"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item is contained in a document if at least ``THRESHOLD`` of the item's distinct word shingles are
among the document's. Items are partitioned by number of shingles. In a partition up to ``u`` shingles
the sketch of an item is its ``u - ceil(t u) + 1`` smallest shingle hashes (bottom-k MinHash): a
document that holds the threshold misses at most ``n - ceil(t n)`` of the item's ``n`` shingles, so it
holds at least one of the sketch. The search therefore loses nothing, however long the document is;
a document with fewer shingles than a partition's least need is not asked for it. Each candidate is
verified on the shingles themselves.

Sketches of at most ``PASS`` hashes are sent to the tasks at a time; a larger benchmark is searched
in several passes over the documents, each of bounded size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.common import keep_rows, text_hash

SHINGLE = 5
THRESHOLD = 0.8
PASS = 1 << 19  # shingles of the items of one pass
BITS = 20
_ODD = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(8)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def gram_hashes(marks: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all ``width`` successive words, from their 32-bit marks."""
    n = len(marks) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h += marks[k:k + n] * _ODD[k + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def marks_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1)


class Index:
    """Sketches of some items by shingle width, with a bit filter before the sorted hashes."""

    def __init__(self, items: list[tuple[int, str]], threshold: float):
        self.threshold = threshold
        self.items: list[tuple[int, set, int]] = []
        found: dict[int, dict[int, list[int]]] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            width = min(SHINGLE, len(words))
            own = shingles(words, width)
            n = len(own)
            upper = 1 << (n - 1).bit_length()  # sizes (upper/2, upper]
            k = min(n, upper - math.ceil(threshold * upper - 1e-9) + 1)
            hashes = np.sort(np.unique(gram_hashes(marks_of(words), width)))
            at = len(self.items)
            self.items.append((item, own, width))
            for h in hashes[: max(k, 1)].tolist():
                found.setdefault(width, {}).setdefault(h, []).append(at)
        self.widths = []
        for width, by_hash in found.items():
            keys = np.array(sorted(by_hash), np.uint64)
            bits = np.zeros(1 << BITS, bool)
            bits[(keys >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.widths.append((width, keys, bits, [by_hash[int(k)] for k in keys]))

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, shingles of the item, of these in the text) of every item that the text contains."""
        words = words_of(text)
        marks = marks_of(words)
        asked: set[int] = set()
        for width, keys, bits, owners in self.widths:
            h = gram_hashes(marks, width)
            h = h[bits[(h >> np.uint64(64 - BITS)).astype(np.int64)]]
            if len(h):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                for i in np.unique(at[keys[at] == h]).tolist():
                    asked.update(owners[i])
        out, own = [], {}
        for i in sorted(asked):
            item, want, width = self.items[i]
            if len(words) - width + 1 < self.threshold * len(want) - 1e-9:
                continue  # too short for this size
            if width not in own:
                own[width] = shingles(words, width)
            shared = len(want & own[width])
            if shared >= self.threshold * len(want) - 1e-9:
                out.append((item, len(want), shared))
        return out


def passes(bench: DataFrame, item_col: str, text_col: str, threshold: float) -> Iterator[Index]:
    """Indexes of bounded size over all items, in turn; items are read one partition at a time."""
    held, size = [], 0
    for row in bench.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).toLocalIterator():
        held.append((row["item"], row["text"]))
        size += len((row["text"] or "").split())
        if size >= PASS:
            yield Index(held, threshold)
            held, size = [], 0
    if held:
        yield Index(held, threshold)


def contained(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(item, id, th, n_shingles, n_shared): every pair of an item and a document that contains it.

    Words are cut at ASCII white space and lower-cased (A-Z); an item of fewer than five words has
    one shingle of all its words; null texts and items without words contain nothing and are
    contained nowhere. Repeated rows and repeated items give repeated pairs; an empty table gives none.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), bench.schema[item_col].dataType.simpleString()
    schema = f"item {item_kind}, id {kind}, th long, n_shingles long, n_shared long"
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.col(text_col).alias("text"))
    out = None
    for index in passes(bench, item_col, item_text, threshold):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for x in batches:
                found = [(item, i, n, s) for i, t in enumerate(x["text"]) for item, n, s in sent.value.search(t)]
                at = [f[1] for f in found]
                yield pd.DataFrame({"item": pd.Series([f[0] for f in found], dtype=object), "id": x["id"].iloc[at].to_numpy(), "th": x["th"].iloc[at].to_numpy(), "n_shingles": pd.Series([f[2] for f in found], dtype="int64"), "n_shared": pd.Series([f[3] for f in found], dtype="int64")})
        part = rows.mapInPandas(run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_items(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they were; one pass, no shuffle."""
    for index in passes(bench, item_col, item_text, threshold):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[tuple[pa.RecordBatch, list[bool]]]:
            for batch in batches:
                yield batch, [not sent.value.search(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
        docs = keep_rows(docs, keep)
    return docs
