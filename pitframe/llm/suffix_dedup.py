"""Repeated byte strings of a given length, by ranking positions on growing lengths.

Prefix doubling on every byte would sort each position eight times. Here a position stands for the
run of windows (``LENGTH``-byte strings) that it represents, and it is sorted on growing lengths until
it is unique or the threshold is reached:

* Sampling. A window's anchor is the place of its least-hashed ``GRAM``-byte string, leftmost of
  ties. It depends on the window's bytes alone, so equal windows have equal anchors at equal offsets,
  and the windows of one anchor are a run of starts.
* Round 0 ranks anchors by ``GRAM`` bytes. Unique ones are done: none of their windows repeats.
* Round 1 ranks pairs (rank so far, bytes of the whole run). An anchor that isn't unique is done: all
  its windows repeat. This settles the inside of every repeat with one row an anchor.
* The following rounds cut the runs left over into spans of fewer and fewer starts. All windows of a
  span share a core, which grows by what the span shrinks, up to a single window of ``LENGTH`` bytes.
  A span with a unique core is done, one whose bytes repeat as a whole is done, the others are cut.

Ranks are 64-bit hashes of the compared bytes, next to the rank before them. Documents are told apart
by their text alone: copies of a text have equal results, whatever their ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.common import discard, stored, text_hash

LENGTH = 200
GRAM = 48
SPANS = (32, 8, 1)
BUFFER = 1 << 18
PLACE = np.uint64((1 << 21) - 1)  # a buffer's places, in the low bits of a hash
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` successive bytes, built from hashes of half the length."""
    have, widths, n = {1: _BYTE[data]}, [1], 1
    while 2 * n <= gram:
        h = have[n]
        have[2 * n] = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
        widths.append(n)
    out, done = None, 0
    for w in reversed(widths):
        while done + w <= gram:
            part = have[w][done:len(data) - gram + 1 + done]
            out = part.copy() if out is None else out * np.uint64(pow(_BASE, w, 1 << 64)) + part
            done += w
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` successive values."""
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[:len(x) - (width - n)], x[width - n:]) if width > n else x


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start) of all runs of windows; ``ends``: for each place, its document's end."""
    keys = gram_hashes(data, gram)
    keys = (keys & ~PLACE) | np.arange(len(keys), dtype=np.uint64)
    anchor = (window_minima(keys, length - gram + 1) & PLACE).astype(np.int64)
    starts = np.flatnonzero(np.arange(length, len(anchor) + length) <= ends[:len(anchor)])
    if not len(starts):
        return starts, starts, starts
    anchor = anchor[starts]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(starts) != 1)]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    return anchor[first], starts[first], starts[last]


def buffers(texts: Iterator[tuple[int, bytes]], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Whole texts packed into buffers; long ones cut so that each window lies in exactly one piece.

    Yields the bytes and, per piece, (place in the buffer, its size, place in the text, text).
    """
    held, size, pieces = [], 0, []
    for key, raw in texts:
        for at in range(0, max(len(raw) - length + 1, 0), BUFFER):
            piece = raw[at:at + BUFFER + length - 1]
            if size and size + len(piece) > BUFFER:
                yield b"".join(held), pieces
                held, size, pieces = [], 0, []
            pieces.append((size, len(piece), at, key))
            held.append(piece)
            size += len(piece)
    if held:
        yield b"".join(held), pieces


def anchors(docs: DataFrame, text_col: str, length: int, gram: int) -> DataFrame:
    """(k, at, lo, hi, core, whole): every anchor of every text with the starts it stands for, back from it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for x in batches:
            texts = ((k, t.encode()) for k, t in zip(x["k"], x["text"], strict=True))
            for raw, pieces in buffers(texts, length):
                data = np.frombuffer(raw, np.uint8)
                begin = np.array([p[0] for p in pieces])
                sizes = np.array([p[1] for p in pieces])
                anchor, lo, hi = anchor_runs(data, np.repeat(begin + sizes, sizes), length, gram)
                if not len(anchor):
                    continue
                own = np.searchsorted(begin, lo, "right") - 1
                shift = np.array([p[2] - p[0] for p in pieces])[own]
                core = [digest(raw[a:a + gram]) for a in anchor.tolist()]
                whole = [digest(raw[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist(), strict=True)]
                yield pd.DataFrame({"k": np.array([p[3] for p in pieces])[own], "at": anchor + shift, "lo": (anchor - hi).astype(np.int32), "hi": (anchor - lo).astype(np.int32),
                                    "core": np.array(core, np.uint64).view(np.int64), "whole": np.array(whole, np.uint64).view(np.int64)})
    rows = docs.select(text_hash(text_col).alias("k"), F.col(text_col).alias("text")).filter(F.octet_length("text") >= length)
    return rows.mapInPandas(run, "k long, at long, lo int, hi int, core long, whole long")


def spans_of(contexts: DataFrame, span: int, length: int) -> DataFrame:
    """(k, at, j, core, whole): the spans of ``span`` starts of each row's runs ``js``, all of them if null.

    Start ``d`` bytes before the anchor belongs to span ``d // span``. ``whole`` is null where the row
    doesn't stand for all starts of the span.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for x in batches:
            out = []
            for k, at, lo, hi, raw, js in zip(x["k"], x["at"], x["lo"], x["hi"], x["bytes"], x["js"], strict=True):
                raw = bytes(raw)  # begins at the start hi bytes before the anchor
                for j in range(lo // span, hi // span + 1) if js is None else js.tolist():
                    near, far = j * span, (j + 1) * span - 1
                    if far < lo or near > hi:
                        continue
                    core = digest(raw[hi - near:hi - far + length], j)
                    full = near >= lo and far <= hi
                    out.append((k, at, j, core, digest(raw[hi - far:hi - near + length], j) if full else None))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            whole = np.array([w or 0 for w in cols[4]], np.uint64).view(np.int64)
            yield pd.DataFrame({"k": np.array(cols[0], np.int64), "at": np.array(cols[1], np.int64), "j": np.array(cols[2], np.int32), "core": np.array(cols[3], np.uint64).view(np.int64),
                                "whole": pd.array(whole, "Int64") if not out else pd.arrays.IntegerArray(whole, np.array([w is None for w in cols[4]]))})
    return contexts.mapInPandas(run, "k long, at long, j int, core long, whole long")


def repeated(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, spans: tuple[int, ...] = SPANS) -> DataFrame:
    """(k, begin, end): byte ranges, per text hash, that together cover exactly the repeated windows."""
    first = stored(anchors(docs, text_col, length, gram))
    again = stored(first.groupBy("core").agg(F.count("*").alias("c")).filter("c > 1").select("core"))
    some = stored(first.join(again, "core", "left_semi"))
    discard(first)

    # a class by its first bytes and all bytes of the run: how many anchors, and one of them
    classes = stored(some.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("k", "at", "lo", "hi")).alias("r")))
    mixed = stored(classes.groupBy("core").agg(F.count("*").alias("c")).filter("c > 1").select("core"))
    known = classes.filter("n > 1").select("core", "whole")
    sure = some.join(known, ["core", "whole"], "left_semi").select("k", (F.col("at") - F.col("hi")).alias("begin"), (F.col("at") - F.col("lo") + length).alias("end")).distinct()
    # only classes that share their first bytes with another class are cut further
    reps = classes.join(mixed, "core", "left_semi").select("r.*", "n")
    ranges = stored(sure)
    reps = stored(reps)
    one_text = docs.select(text_hash(text_col).alias("k"), F.col(text_col).alias("text"))
    per_text = stored(reps.groupBy("k").agg(F.collect_list(F.struct("at", "lo", "hi", "n")).alias("rows")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            out = []
            for k, text, rows in zip(x["k"], x["text"], x["rows"], strict=True):
                raw = text.encode()
                out += [(k, r["at"], r["lo"], r["hi"], r["n"], raw[r["at"] - r["hi"]:r["at"] - r["lo"] + length]) for r in rows]
            yield pd.DataFrame(out, columns=["k", "at", "lo", "hi", "n", "bytes"])
    contexts = one_text.join(per_text, "k").mapInPandas(cut, "k long, at long, lo int, hi int, n long, bytes binary")
    contexts = stored(contexts.dropDuplicates(["k", "at", "lo", "hi"]))

    alive = contexts.withColumn("js", F.lit(None).cast("array<int>"))
    for i, span in enumerate(spans):
        rows = stored(spans_of(alive.select("k", "at", "lo", "hi", "bytes", "js"), span, length))
        cores = stored(rows.groupBy("core", "j").agg(F.count("*").alias("c")).filter("c > 1"))
        wholes = stored(rows.filter("whole IS NOT NULL").groupBy("core", "j", "whole").agg(F.count("*").alias("w"), F.min(F.struct("k", "at")).alias("one")).filter("w > 1"))
        left = stored(rows.join(cores.select("core", "j"), ["core", "j"], "left_semi"))
        done = left.join(wholes.select("whole", "j"), ["whole", "j"], "left_semi").select("k", "at", "j")
        ranges = ranges.unionByName(done.select("k", (F.col("at") - (F.col("j") + 1) * span + 1).alias("begin"), (F.col("at") - F.col("j") * span + length).alias("end")))
        if i + 1 < len(spans):
            finer = span // spans[i + 1]
            cut_more = left.join(wholes.select("whole", "j"), ["whole", "j"], "left_anti").select("k", "at", "j")
            # one of those that are done stays to be compared with, where others share its core
            stay = wholes.join(cores, ["core", "j"]).filter("c > w").select("one.k", "one.at", "j")
            todo = cut_more.unionByName(stay).select("k", "at", F.explode(F.transform(F.sequence(F.lit(0), F.lit(finer - 1)), lambda m: F.col("j") * finer + m)).alias("j2"))
            todo = stored(todo.groupBy("k", "at").agg(F.collect_set("j2").alias("js")))
            alive = contexts.join(todo, ["k", "at"])
    return ranges


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, spans: tuple[int, ...] = SPANS) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, removed): each text without its repeated windows.

    Texts are UTF-8 bytes; null texts are empty and have nothing removed, as texts shorter than
    ``length``. All copies of a repeated text lose all of it. ``removed`` lists the removed runs.
    Repeated rows and null ids come out as they came in; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    found = repeated(docs, text_col, length, gram, spans)
    per_text = stored(found.groupBy("k").agg(F.collect_list(F.struct("begin", "end")).alias("ranges")))
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("k"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            out = []
            for doc, text, ranges in zip(x["id"].astype(object).where(x["id"].notna(), None), x["text"], x["ranges"], strict=True):
                raw = (text or "").encode()
                gone = merge([] if ranges is None else [(r["begin"], r["end"]) for r in ranges])
                digest, at = hashlib.sha256(), 0
                for a, b in [*gone, (len(raw), len(raw))]:
                    digest.update(raw[at:a])
                    at = b
                out.append((doc, len(raw), sum(b - a for a, b in gone), len(gone), digest.hexdigest(), gone))
            yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
    return rows.join(per_text, "k", "left").select("id", "text", "ranges").mapInPandas(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<array<long>>")


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, those that touch or overlap made one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
