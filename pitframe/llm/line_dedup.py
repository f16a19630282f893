"""Near-duplicate lines: segment-partition edit join, verified by banded bit-parallel edit distance.

Lines of at least ``SHORTEST`` characters link at ``EDITS`` edits or fewer. A line is cut into
``EDITS + 1`` segments; a line within the distance holds one of them whole, shifted by no more than the
edits around it allow. Segments are indexed by (length of line, segment, bytes); for each length from
its own down to ``EDITS`` less a line probes the few substrings that the shifts allow.

A key with many lines is put off: its lines are signed again with one more segment, of which one more
must be whole, so keys name two, then three segments. The lines of a key are compared inside tasks, in
blocks: lengths and letter counts first, then the distance. Only links come out, never pairs to check.

With ``share`` the edits grow with the line: one for each ``share`` characters of the shorter line of a
pair. The probes of a line then grow with the third power of its edits.

Equal lines are one line throughout; each task sends a line once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.common import components, stored, text_hash

EDITS = 2
SHORTEST = 20
PAIR_KEY = 64  # lines of a key that are compared without another segment
LEVELS = 3
BLOCK = 2048  # lines of a key that meet another block's in one task
SEEN = 1 << 20  # lines a task remembers to send once
SLICE = 1 << 20  # characters of lines that are signed at once
BASE = 0x5851F42D4C957F2D  # odd, so that its powers have inverses modulo 2^64


def allowed(length: int, share: int | None) -> int:
    """Edits at which two lines link, the shorter one of ``length``."""
    few = EDITS if length >= SHORTEST else 0
    return few if share is None else max(few, length // share)


def allowed_all(lengths: np.ndarray, share: int | None) -> np.ndarray:
    """``allowed`` of many lengths."""
    few = np.where(lengths >= SHORTEST, EDITS, 0)
    return few if share is None else np.maximum(few, lengths // share)


def shortest(share: int | None) -> int:
    return SHORTEST if share is None else min(SHORTEST, share)


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of the parts of a line, sizes differing by one at most."""
    size, more = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        n = size + (i >= parts - more)
        out.append((at, n))
        at += n
    return out


@lru_cache(maxsize=200_000)
def probes(length: int, whole: int, share: int | None = None) -> tuple[tuple[tuple[int, ...], bool], ...]:
    """What a line of ``length`` is signed with: (numbers naming the key and its pieces, is indexed).

    ``whole`` segments of ``edits + whole`` are named. The shifts before, between and behind them cost
    an edit a step, so only shifts that cost ``edits`` or less in sum are probed. ``edits`` is what the
    indexed line's length allows.
    """
    out = {}
    for short in range(length, shortest(share) - 1, -1):
        edits, gap = allowed(short, share), length - short
        if gap > edits:
            break
        parts = edits + whole
        cut = segments(short, parts)
        for named in combinations(range(parts), whole):
            for shift in product(range(-edits, edits + 1), repeat=whole):
                path = (0, *shift, gap)
                if sum(abs(b - a) for a, b in zip(path, path[1:], strict=False)) > edits:
                    continue
                places = [(cut[i][0] + s, cut[i][1]) for i, s in zip(named, shift, strict=True)]
                # the segments before a named one hold the edits before it, one each at most goes unseen
                if whole == 1 and not _needed(named[0], shift[0], gap, parts, edits):
                    continue
                if any(a < 0 or a + n > length for a, n in places):
                    continue
                out[short, *named, *(x for p in places for x in p)] = gap == 0 and not any(shift)
    return tuple(out.items())


def _needed(i: int, shift: int, gap: int, parts: int, edits: int) -> bool:
    """Multi-match rule: some whole segment has at most ``i`` edits before it and ``parts - 1 - i`` behind it."""
    return abs(shift) <= i and abs(gap - shift) <= parts - 1 - i


def lines_of(text: str | None) -> list[str]:
    return (text or "").split("\n")


def line_hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode(), 42)


def distinct_lines(texts: Iterator[str | None], seen: set, least: int = SHORTEST) -> Iterator[tuple[int, str]]:
    for text in texts:
        for line in lines_of(text):
            if len(line) >= least:
                h = line_hash(line)
                if h not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(h)
                    yield h, line


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``BASE`` modulo 2^64 and their inverses."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def shifts_of(edits: int, gap: int) -> list[tuple[int, int]]:
    """(segment, shift) that a line probes among lines shorter by ``gap``, as ``probes`` does for one whole segment."""
    return [(i, s) for i in range(edits + 1) for s in range(-edits, edits + 1) if abs(s) + abs(gap - s) <= edits and _needed(i, s, gap, edits + 1, edits)]


def line_keys(lines: list[str], share: int | None, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, place in ``lines``, indexed) of every probe with one whole segment, for all lines at once.

    A segment's hash is the difference of two prefix sums of characters times powers; the lengths
    and places of segments follow from the line's length, so a probe is a few steps over arrays.
    """
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(sizes) - sizes
    chars = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    up, down = table
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars * up[:len(chars)], dtype=np.uint64)])
    most = allowed_all(sizes, share)
    keys, places, indexed = [], [], []
    for gap in range(int(most.max(initial=0)) + 1):
        edits = allowed_all(sizes - gap, share)
        edits[(edits < gap) | (sizes - gap < shortest(share))] = -1
        for e in np.unique(edits[edits >= 0]).tolist():
            at = np.flatnonzero(edits == e)
            short = sizes[at] - gap
            size, more = np.divmod(short, e + 1)
            for i, shift in shifts_of(e, gap):
                a = i * size + np.maximum(i - (e + 1 - more), 0) + shift
                b = a + size + (i >= e + 1 - more)
                ok = (a >= 0) & (b <= sizes[at])
                a, b = (starts[at] + a)[ok], (starts[at] + b)[ok]
                h = (sums[b] - sums[a]) * down[a] + short[ok].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)
                h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                keys.append(h ^ (h >> np.uint64(29)))
                places.append(at[ok])
                indexed.append(np.full(len(a), gap == 0 and shift == 0))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(keys), np.concatenate(places), np.concatenate(indexed)


def signed(rows: DataFrame, whole: int, column: str, is_line: bool, share: int | None = None) -> DataFrame:
    """(key, line, indexed) of every distinct line of a column of texts or of lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        table = powers(2 * SLICE)
        for x in batches:
            texts = (t.as_py() for t in x.column(0))
            found = ((line_hash(v), v) for v in texts) if is_line else distinct_lines(texts, seen, shortest(share))
            for numbers, lines in slices(found):
                if whole == 1:
                    n = sum(map(len, lines))
                    if n > len(table[0]):
                        table = powers(n)
                    keys, at, indexed = line_keys(lines, share, table)
                    yield packed(keys, np.array(numbers, np.uint64)[at], indexed)
                else:
                    yield from piece_keys(numbers, lines, whole, share)
    return rows.select(column).mapInArrow(run, "key long, line long, indexed boolean")


def slices(found: Iterator[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    """Lines with their numbers, about ``SLICE`` characters at a time."""
    numbers, lines, size = [], [], 0
    for h, line in found:
        numbers.append(h)
        lines.append(line)
        size += len(line)
        if size >= SLICE:
            yield numbers, lines
            numbers, lines, size = [], [], 0
    if lines:
        yield numbers, lines


def piece_keys(numbers: list[int], lines: list[str], whole: int, share: int | None) -> Iterator[pa.RecordBatch]:
    """Keys that name several whole segments."""
    digest = xxhash.xxh3_64_intdigest
    keys, own, indexed = [], [], []
    for h, line in zip(numbers, lines, strict=True):
        plan = probes(len(line), whole, share)
        for name, is_index in plan:
            piece, seed = "", hash(name[:1 + whole])
            for k in range(1 + whole, len(name), 2):
                piece += line[name[k]:name[k] + name[k + 1]]
            keys.append(digest(piece, seed & 0xFFFFFFFFFFFFFFFF))
            indexed.append(is_index)
        own += [h] * len(plan)
        if len(keys) > 400_000:
            yield packed(keys, own, indexed)
            keys, own, indexed = [], [], []
    yield packed(keys, own, indexed)


def packed(keys: Sequence[int], lines: Sequence[int], indexed: Sequence[bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.array(lines, np.uint64).view(np.int64)), pa.array(np.array(indexed, bool))], ["key", "line", "indexed"])


def within(a: str, b: str, most: int) -> int | None:
    """Edit distance if it is at most ``most``, else None: bit-parallel over a band of the matrix."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    n = 0
    while n < len(b) and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    n = 0
    while n < len(b) and a[-1 - n] == b[-1 - n]:
        n += 1
    if n:
        a, b = a[:-n], b[:-n]
    if not b:
        return len(a)
    # Column j holds rows j - most .. j + most as bits 0 .. 2 most of the vertical differences.
    width = 2 * most + 1
    ones = (1 << width) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    up, down = ones & ~((1 << most) - 1), 0  # below the corner every row costs one more
    at = min(most, len(a))  # distance on the band's last row, or on the pattern's once the band has passed it
    for j, c in enumerate(b):
        low = j - most  # pattern place of the band's first bit
        hit = where.get(c, 0)
        hit = (hit >> low if low >= 0 else hit << -low) & ones
        diag = ((((hit & up) + up) ^ up) | hit | down) & ones
        right, left = (down | ~(diag | up)) & ones, diag & up
        last = j + most  # row of the band's last bit, counted from zero
        if last < len(a):
            at += not diag >> (width - 1) & 1
        else:
            bit = width - 1 - (last - len(a) + 1)
            at += (right >> bit & 1) - (left >> bit & 1)
        up, down = (left | ~((diag >> 1) | right)) & ones, (diag >> 1) & right
    return at if at <= most else None


def shared_keys(rows: DataFrame, whole: int, column: str, is_line: bool, share: int | None = None) -> DataFrame:
    """(key, line) of the keys that several rows have, each line once.

    The first pass moves keys alone. The join is by merge at any size: the keys grow with the input.
    """
    again = stored(signed(rows, whole, column, is_line, share).groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"))
    met = signed(rows, whole, column, is_line, share).join(again.hint("merge"), "key", "left_semi")
    return stored(met.groupBy("key", "line").agg(F.max("indexed").alias("indexed")))


def histogram(text: str) -> np.ndarray:
    """Code points by their last five bits; an edit changes two counts at most, by one each."""
    return np.bincount(np.frombuffer(text.encode("utf-32-le"), "<u4") & 31, minlength=32)


def compared(rows: pd.DataFrame, share: int | None = None) -> list[tuple[int, int, int]]:
    """(a, b, edits) of the linked lines of one group; pairs of one block belong to that block's group."""
    line, text, block = rows["line"].to_numpy(), rows["text"].to_numpy(), rows["b"].to_numpy()
    across = len(np.unique(block)) > 1
    sizes = np.array([len(t) for t in text])
    most = np.array([allowed(n, share) for n in sizes.tolist()])  # never less for a longer line
    counts = np.array([histogram(t) for t in text], np.int32) if len(rows) > 2 else None
    out = []
    for i in range(len(rows) - 1):
        edits = np.minimum(most[i + 1:], most[i])
        near = np.abs(sizes[i + 1:] - sizes[i]) <= edits
        if counts is not None:
            near &= np.abs(counts[i + 1:] - counts[i]).sum(axis=1) <= 2 * edits
        if across:
            near &= block[i + 1:] != block[i]
        for j in (np.flatnonzero(near) + i + 1).tolist():
            d = within(text[i], text[j], int(edits[j - i - 1]))
            if d:
                out.append((min(line[i], line[j]), max(line[i], line[j]), d))
    return out


def links_of(members: DataFrame, texts: DataFrame, share: int | None = None) -> DataFrame:
    """(a, b, edits) among the lines of each key; ``members`` (key, line, n).

    Lines of a key are compared inside tasks, in groups of two blocks of about ``BLOCK`` lines at
    most; only links come out.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    x = members.withColumn("b", F.pmod(F.xxhash64("line"), blocks)).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    x = x.join(texts, "line").select("key", F.least("b", "c").alias("b1"), F.greatest("b", "c").alias("b2"), "b", "line", "text")
    x = x.repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            ids = rows[["key", "b1", "b2"]].to_numpy()
            ends = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            start, found = 0, []
            for end in ends.tolist():
                found += compared(rows.iloc[start:end], share)
                start = end
            held = rows.iloc[start:]
            yield pd.DataFrame(found, columns=["a", "b", "edits"])
        if held is not None:
            yield pd.DataFrame(compared(held, share), columns=["a", "b", "edits"])
    return x.mapInPandas(run, "a long, b long, edits int")


def line_texts(docs: DataFrame, text_col: str, share: int | None = None) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for x in batches:
            found = list(distinct_lines(x[text_col], seen, shortest(share)))
            yield pd.DataFrame({"line": np.array([f[0] for f in found], np.uint64).view(np.int64), "text": [f[1] for f in found]})
    return docs.select(text_col).mapInPandas(run, "line long, text string")


def line_links(docs: DataFrame, text_col: str = "text", share: int | None = None) -> DataFrame:
    """(a, b, edits): every pair of different lines, by hash, within the distance; a < b.

    The distance is ``EDITS`` for lines of ``SHORTEST`` characters or more; with ``share`` it is at least
    one edit for each ``share`` characters of the shorter line, and lines of ``share`` characters link too.
    """
    found, texts = None, None
    rows, column, is_line = docs, text_col, False
    levels = LEVELS if share is None else 1  # pairs of many segments and shifts would outgrow the keys' lines
    for whole in range(1, levels + 1):
        met = shared_keys(rows, whole, column, is_line, share)
        sizes = stored(met.groupBy("key").agg(F.count("*").alias("n"), F.max("indexed").alias("any")).filter("n > 1 AND any").select("key", "n"))
        last = whole == levels
        some = stored(met.join(sizes if last else sizes.filter(F.col("n") <= PAIR_KEY), "key").select("key", "line", "n"))
        hot = stored(met.join(sizes.filter(F.col("n") > PAIR_KEY).select("key"), "key", "left_semi").select("line").distinct())
        if texts is None:  # lines of later levels are among these
            wanted = some.select("line").unionByName(hot).distinct()
            texts = stored(line_texts(docs, text_col, share).join(wanted.hint("merge"), "line", "left_semi").dropDuplicates(["line"]))
        new = stored(links_of(some, texts, share))
        found = new if found is None else found.unionByName(new)
        if last or hot.isEmpty():
            break
        rows, column, is_line = stored(texts.join(hot, "line", "left_semi").select("text")), "text", True
    return found.distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int | None = None) -> DataFrame:
    """(id, n_lines, n_exact, n_near, n_links, removed): what each row loses if one line of a class stays.

    A class is a set of lines that are equal or linked, directly or over others; its first line by
    (id, text hash, place) stays, null ids last. ``n_exact`` lines are removed as a copy of an earlier
    line, ``n_near`` as the first of their text in a class that began earlier; ``removed`` lists their
    places from 0. ``n_links`` counts the different lines linked to the row's different lines. Empty
    lines separate and are never removed; lines under ``SHORTEST`` characters match by copy only
    (with ``share``, as in ``line_links``, those under ``share``). A null
    text has one empty line. Repeated rows are told apart by their order in the sort, an empty table
    gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            lines = [lines_of(t) for t in x["text"]]
            sizes = [len(v) for v in lines]
            at = np.repeat(np.arange(len(x)), sizes)
            flat = [v for own in lines for v in own]
            yield pd.DataFrame({"id": x["id"].to_numpy()[at], "th": x["th"].to_numpy()[at], "place": np.concatenate([np.arange(n) for n in sizes] or [np.zeros(0)]).astype(np.int32),
                                "line": np.array([line_hash(v) for v in flat], np.uint64).view(np.int64), "blank": np.array([not v.strip() for v in flat], bool)})
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.col(text_col).alias("text"))
    lines = stored(rows.mapInPandas(run, f"id {kind}, th long, place int, line long, blank boolean"))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "th", "place")
    first = lines.filter("NOT blank").groupBy("line").agg(F.min(place).alias("first"))
    links = stored(line_links(docs, text_col, share).select("a", "b"))
    comp = components(links).withColumnRenamed("node", "line")
    degree = links.select(F.explode(F.array("a", "b")).alias("line")).groupBy("line").agg(F.count("*").alias("links"))
    known = stored(first.join(comp, "line", "left").join(degree, "line", "left").select("line", "first", F.coalesce("root", "line").alias("root"), F.coalesce("links", F.lit(0)).alias("links")))
    began = stored(known.groupBy("root").agg(F.min("first").alias("began")))
    named = stored(known.join(began, "root").select("line", "first", (F.col("first") > F.col("began")).alias("late"), "links"))
    # repeated rows share (id, th, place): only one of them holds the first line
    each = lines.filter("NOT blank").groupBy("id", "th", "place", "line").agg(F.count("*").alias("copies"))
    each = each.join(named, "line").withColumn("is_first", place == F.col("first"))
    per_doc = each.groupBy("id", "th").agg(
        F.max("copies").alias("copies"),
        F.sum(F.when(~F.col("is_first"), 1).otherwise(0)).alias("n_exact"),
        F.sum(F.when(F.col("is_first") & F.col("late"), 1).otherwise(0)).alias("n_near"),
        F.sum(F.when(F.col("is_first") & ~F.col("late"), 1).otherwise(0)).alias("n_began"),
        F.sum_distinct(F.when(F.col("links") > 0, F.col("links"))).alias("unused"),
        F.collect_set(F.when(F.col("links") > 0, F.struct("line", "links"))).alias("linked"),
        F.sort_array(F.collect_list(F.when(~F.col("is_first") | F.col("late"), F.col("place")))).alias("removed"),
        F.sort_array(F.collect_list("place")).alias("all_places"),
    ).drop("unused")
    per_doc = per_doc.withColumn("n_links", F.aggregate("linked", F.lit(0).cast("long"), lambda s, v: s + v["links"]))
    base = rows.select("id", "th", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"))
    base = base.groupBy("id", "th").agg(F.max("n_lines").alias("n_lines"), F.count("*").alias("rows"))
    out = base.join(per_doc.select(F.col("id").alias("i"), F.col("th").alias("t"), "n_exact", "n_near", "n_links", "removed", "all_places"), F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")), "left")
    out = out.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    whole = F.coalesce("all_places", F.array().cast("array<int>"))
    zero = F.lit(0).cast("long")
    return out.select("id", "n_lines", F.when(F.col("nth") > 1, F.size(whole).cast("long")).otherwise(F.coalesce("n_exact", zero)).alias("n_exact"), F.when(F.col("nth") > 1, zero).otherwise(F.coalesce("n_near", zero)).alias("n_near"),
                      F.coalesce("n_links", zero).alias("n_links"), F.when(F.col("nth") > 1, whole).otherwise(F.coalesce("removed", F.array().cast("array<int>"))).alias("removed"))
