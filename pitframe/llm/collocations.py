"""Phrase collocations by marginalising the longest windows.

Every word starts one window: itself and the words that follow it in its piece, as columns, up to the
longest phrase and padded where the piece ends. Only these padded windows are counted; ROLLUP over
the columns then sums them over ever shorter prefixes, which gives the count of every phrase of every
length, of every word, and of all words of a language, from one row per window instead of one per
phrase.

Most windows occur once and no phrase in them can reach the wanted count. Two passes before count
prefixes of windows in hashed slots, first words and pairs, then longer ones whose pairs all stand; a
slot's count is never below that of its phrases, so a window may be padded from the first prefix on
whose slot stays below the bound. The second pass also marks the words of the pairs that stand: a word
in none of them is in no phrase, so its windows are all padding. Neither changes a count that a phrase
or its parts need. Slots are a fixed table
(2^28 bits, 32 MB); when the input fills it, less is padded away and the windows move whole, with the
same results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitframe.llm.common import discard, stored
from pitframe.session import estimated_bytes

LONGEST = 5  # words of a phrase
LEAST = 100  # occurrences of a phrase
COVERED = 100  # percent of a phrase's occurrences inside a longer one that drop it
TOP = 2000  # phrases a language
SLOT_BITS = 28
CHUNK_BITS = 16  # slots travel in chunks of 2^16
SEGMENT = 1 << 20  # bytes of text cut into words at a time
KNOWN = 1 << 18  # words of a language that a task remembers before it hands on what it counted
HELD = 1 << 20  # windows of a language that a task holds before it counts them
TASK_BYTES = 1 << 27  # of input to a task that counts windows

BREAK = b"\xff"  # in no UTF-8 text
PART = np.array([0x9FB21C651E98DF25], np.uint64)  # follows a word to mark that it is part of a pair
# A-Z is lowered, sentence marks and line ends divide pieces, tabs divide words
_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 255 if c in _MARKS else 32 if c == 9 else c for c in range(256))


class Words(dict):
    """Numbers of one language's words from 1 on, 0 for a break, and a hash of each."""

    def __init__(self, lang: str):
        super().__init__()
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        self[BREAK], self.names, self.hashes = 0, [b""], []  # hashes not yet in the array
        self.array = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return n

    def hashed(self, numbers: np.ndarray) -> np.ndarray:
        if len(self.hashes):
            self.array, self.hashes = np.concatenate([self.array, np.array(self.hashes, np.uint64)]), []
        return self.array[numbers]


def numbered(texts: list[bytes], words: Words, ahead: int) -> Iterator[tuple[np.ndarray, int]]:
    """(word numbers, how many of them start here): segments of the texts with ``ahead`` numbers of what follows.

    Texts and pieces are divided by breaks; the last segment is followed by breaks.
    """
    raw = BREAK.join([*texts, b""]).translate(_TABLE).replace(BREAK, b" \xff ")
    at, tail = 0, np.zeros(0, np.int32)
    while at < len(raw):
        end = raw.find(b" ", at + SEGMENT) if at + SEGMENT < len(raw) else -1
        end = len(raw) if end < 0 else end
        part = raw[at:end].split()
        at = end
        now = np.concatenate([tail, np.fromiter(map(words.__getitem__, part), np.int32, len(part))])
        if at < len(raw):
            starts = max(len(now) - ahead, 0)
            yield now, starts
            tail = now[starts:]
        else:
            yield np.concatenate([now, np.zeros(ahead, np.int32)]), len(now)


def followed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase hashed ``a`` with one more word hashed ``b``."""
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Slots:
    """The frequent slots: a bit each."""

    def __init__(self, bits: int, chunks: list[tuple[int, bytes]]):
        self.shift, step = np.uint64(64 - bits), 1 << CHUNK_BITS >> 3
        self.bitmap = np.zeros(max(1 << bits >> 3, step), np.uint8)
        for chunk, raw in chunks:
            self.bitmap[chunk * step:(chunk + 1) * step] |= np.frombuffer(zlib.decompress(raw), np.uint8)

    def hold(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> self.shift).astype(np.int64)
        return (self.bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of a batch in groups of one language."""
    groups: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
        if text.is_valid:
            groups.setdefault(lang, []).append(text.as_py())
    yield from groups.items()


def frequent_slots(rows: DataFrame, least: int, bits: int, longest: int, before: list[tuple[int, bytes]] | None = None) -> list[tuple[int, bytes]]:
    """(chunk, compressed bitmap of slots that hold at least ``least``), chunks without one left out.

    Counts words and pairs; with ``before``, their slots, the longer prefixes whose words and pairs all
    stand there. A task sends each chunk's slots and their counts, cut at ``least``; the sum of such counts
    reaches ``least`` exactly where the slot's does. At most 2^bits bits come to the driver.
    """
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if least <= np.iinfo(k).max)
    mask, shift = (1 << CHUNK_BITS) - 1, np.uint64(64 - bits)
    sent = rows.sparkSession.sparkContext.broadcast(before or [])
    first = before is None
    ahead = 1 if first else longest - 1

    def prefixes(now: np.ndarray, starts: int, h: np.ndarray, known: Slots | None, marked: list[np.ndarray]) -> Iterator[np.ndarray]:
        there = now > 0
        if known is None:
            yield h[:starts][there[:starts]]
            yield followed(h[:starts], h[1:starts + 1])[there[:starts] & there[1:starts + 1]]
            return
        pairs = there[:-1] & there[1:]
        pairs[pairs] = known.hold(followed(h[:-1][pairs], h[1:][pairs]))
        at = np.flatnonzero(pairs[:starts])
        run = followed(h[at], h[at + 1])
        marked.append(np.unique(np.concatenate([h[at], h[at + 1]])))
        for k in range(2, longest):
            on = pairs[at + k - 1]
            at, run = at[on], followed(run[on], h[at[on] + k])
            yield run

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, words_of, marked = [], 0, {}, [np.zeros(0, np.uint64)]
        known = None if first else Slots(bits, sent.value)

        def close() -> pa.RecordBatch:
            sure = (followed(np.unique(np.concatenate(marked)), PART) >> shift).astype(held[0].dtype)
            slot, n = np.unique(np.concatenate([*held, sure]), return_counts=True)
            n[np.searchsorted(slot, sure)] = least
            edges = np.flatnonzero(np.diff(slot >> CHUNK_BITS, prepend=-1))
            offsets, n = (slot & mask).astype("<u2"), np.minimum(n, least).astype(kind)
            ends = np.append(edges[1:], len(slot))
            out = [(int(slot[a] >> CHUNK_BITS), offsets[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(edges, ends, strict=True)] or [(0, b"", b"")]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["chunk", "slots", "counts"])
        for batch in batches:
            for lang, texts in by_language(batch):
                words = words_of.setdefault(lang, Words(lang))
                for now, starts in numbered(texts, words, ahead):
                    for hashes in prefixes(now, starts, words.hashed(now), known, marked):
                        held.append((hashes >> shift).astype(np.int32 if bits < 32 else np.int64))
                        size += len(hashes)
                    if len(marked) > 64:
                        marked[:] = [np.unique(np.concatenate(marked))]
                    if size > 4 * HELD:
                        yield close()
                        held, size = [], 0
                if len(words) > KNOWN:
                    del words_of[lang]
        if held:
            yield close()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, out = None, np.zeros(mask + 1, np.uint32), []

        def close() -> None:
            if (total >= least).any():
                out.append((at, zlib.compress(np.packbits(total >= least, bitorder="little").tobytes(), 1)))
            total[:] = 0
        for batch in batches:  # in order of chunks: one is held at a time
            for chunk, slot, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk != at:
                    close()
                    at = chunk
                total[np.frombuffer(slot, "<u2")] += np.frombuffer(n, kind)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], ["chunk", "bitmap"])
    moved = rows.mapInArrow(count, "chunk long, slots binary, counts binary").repartition("chunk").sortWithinPartitions("chunk")
    return [(r["chunk"], bytes(r["bitmap"])) for r in moved.mapInArrow(merge, "chunk long, bitmap binary").collect()]


class Tally:
    """How often each window of one language starts: windows of several words by row, single ones by number."""

    def __init__(self, longest: int):
        self.many, self.n, self.new, self.size = np.zeros((0, longest), np.int32), np.zeros(0, np.int64), [], 0
        self.one = np.zeros(1, np.int64)

    def add(self, wide: np.ndarray, alone: np.ndarray) -> None:
        one = np.bincount(alone, minlength=len(self.one))
        one[:len(self.one)] += self.one
        self.one = one
        self.new.append(wide)
        self.size += len(wide)
        if self.size > HELD:
            self.compact()

    def compact(self) -> None:
        many = np.concatenate([self.many, *self.new])
        n = np.concatenate([self.n, np.ones(self.size, np.int64)])
        order = np.lexsort(many.T[::-1])
        many, n = many[order], n[order]
        if len(many):
            edge = np.flatnonzero(np.append(True, (np.diff(many, axis=0) != 0).any(axis=1)))
            many, n = many[edge], np.add.reduceat(n, edge)
        self.many, self.n, self.new, self.size = many, n, [], 0

    def renumbered(self, words: Words, lang: str) -> Words:
        """The words that the windows have, numbered anew here too; all others are forgotten."""
        self.compact()
        used = np.union1d(self.many, np.flatnonzero(self.one)).astype(np.int64)
        used, fewer = used[used > 0], Words(lang)
        to = np.zeros(len(words.names), np.int32)
        to[used] = [fewer[words.names[i]] for i in used]
        one = np.zeros(len(fewer.names), np.int64)
        one[0], one[to[used[used < len(self.one)]]] = self.one[0], self.one[used[used < len(self.one)]]
        self.many, self.one = to[self.many], one
        return fewer


def windows(rows: DataFrame, frequent: list[tuple[int, bytes]], longest: int, bits: int) -> DataFrame:
    """(lang, w1, ..., n): padded windows with how often each starts; ``""`` is padding.

    A window ends before the first prefix whose slot isn't frequent; a window may be all padding.
    A window comes once from a task, so tasks are as few as the cores and ``TASK_BYTES`` allow; what a
    task holds doesn't grow with what it reads.
    """
    names = [f"w{i + 1}" for i in range(longest)]
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, min(-(-estimated_bytes(rows) // TASK_BYTES), 1 << 20))
    sent = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots(bits, sent.value)
        known: dict[str, Words] = {}
        tallies: dict[str, Tally] = {}

        def close(lang: str) -> pa.RecordBatch:
            words, tally = known[lang], tallies.pop(lang)
            tally.compact()
            there = np.flatnonzero(tally.one)
            alone = np.zeros((len(there), longest), np.int32)
            alone[:, 0] = there
            many, n = np.concatenate([tally.many, alone]), np.concatenate([tally.n, tally.one[there]])
            used, at = np.unique(many, return_inverse=True)
            text = pa.array([words.names[i] for i in used], pa.binary()).cast(pa.string())
            at = at.reshape(many.shape)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *(text.take(pa.array(at[:, k])) for k in range(longest)), pa.array(n, pa.int64())], ["lang", *names, "n"])
        for batch in batches:
            for lang, texts in by_language(batch):
                words = known.setdefault(lang, Words(lang))
                for now, starts in numbered(texts, words, longest - 1):
                    h = words.hashed(now)
                    on = np.flatnonzero((now[:starts] > 0) & slots.hold(h[:starts]))
                    run, lead = h[on], [np.zeros(starts, np.int32) for _ in range(longest)]  # a word and the words it leads
                    lead[0][on] = now[on]
                    for k in range(1, longest):
                        here = now[on + k] > 0
                        on, run = on[here], followed(run[here], h[on[here] + k])
                        here = slots.hold(run)
                        on, run = on[here], run[here]
                        lead[k][on] = now[on + k]
                    wide = lead[1] > 0 if longest > 1 else np.zeros(starts, bool)
                    alone = (lead[0] > 0) & ~wide
                    alone[alone] = slots.hold(followed(h[:starts][alone], PART))
                    lead[0][~alone & ~wide] = 0
                    tally = tallies.setdefault(lang, Tally(longest))
                    tally.add(np.stack([x[wide] for x in lead], axis=1), lead[0][(now[:starts] > 0) & ~wide])
                    if len(tally.many) > HELD:
                        yield close(lang)
                if len(words) > KNOWN:
                    known[lang] = tallies[lang].renumbered(words, lang) if lang in tallies else Words(lang)
                    if len(known[lang]) > KNOWN // 2:
                        yield close(lang)
                        del known[lang]
        for lang in list(tallies):
            yield close(lang)
    return rows.coalesce(tasks).mapInArrow(run, f"lang string, {', '.join(f'{w} string' for w in names)}, n long")


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST, bits: int = SLOT_BITS) -> DataFrame:
    """(lang, size, phrase, f): phrases of 2 to ``longest`` words with f >= ``least``, and their words (size 1); size 0 counts all words of a language.

    A null language is ``und``; null and empty texts have no words; an empty table gives no rows.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    names = [f"w{i + 1}" for i in range(longest)]
    frequent = frequent_slots(rows, least, bits, longest)
    frequent += frequent_slots(rows, least, bits, longest, frequent)
    top = windows(rows, frequent, longest, bits).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    sums = top.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("gid"))
    size = sum((F.col(w).isNotNull().cast("int") for w in names), F.lit(0))  # ROLLUP leaves nulls, padding is ""
    sums = sums.filter(f"gid < {(1 << longest)}").withColumn("size", size)  # not the total over languages
    last = F.element_at(F.array(F.lit(" "), *names), F.col("size") + 1)
    kept = sums.filter((F.col("size") == 0) | ((last != "") & (F.col("f") >= least)))
    return kept.select("lang", "size", F.array_join(F.array_compact(F.array(*names)), " ").alias("phrase"), "f")


def exact(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP, bits: int = SLOT_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words.

    Texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and tabs into words, A-Z
    lowered. ``a`` counts the phrase, ``n`` all words of the language, ``l`` and ``r`` the two parts of
    the cut with the lowest floor(1000 a n / (l r)), ties to the shortest first part. A phrase goes if a
    longer one of at least ``least`` occurrences holds it in at least ``covered`` percent of them.
    Order: score, then a, descending, then phrase by bytes. Repeated rows count each time; a null
    language is ``und``; an empty table gives no rows; other columns are not read.
    """
    counts = stored(phrase_counts(docs, lang_col, text_col, longest, least, bits))
    totals = stored(counts.filter("size = 0").select("lang", F.col("f").alias("n")))
    phrases = counts.filter("size > 0")
    found = phrases.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))
    word = F.split("phrase", " ")
    part = lambda x, a, n: F.array_join(F.slice(x, a, n), " ")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("head", part(word, F.lit(1), F.col("k"))).withColumn("rest", part(word, F.col("k") + 1, F.col("size") - F.col("k")))
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    cuts = cuts.withColumn("over", exact("a") * 1000 * exact("n")).withColumn("under", exact("l") * exact("r"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r")).alias("m"))
    inner = F.expr("flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), p -> array_join(slice(split(phrase, ' '), p, w), ' '))))")
    inside = found.filter("size > 2").select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    held = F.coalesce(exact("longer") * 100 >= exact("a") * covered, F.lit(False))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(~held).select("lang", "phrase", "a", "n", "m.score", "m.l", "m.r")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the best of each share of a language first, so that no task sorts a whole language
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    near = kept.withColumn("nth", F.row_number().over(W.partitionBy("lang", "share").orderBy(*order))).filter(F.col("nth") <= top)
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    out = stored(ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
    discard(counts)
    discard(totals)
    return out
