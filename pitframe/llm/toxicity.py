"""Toxicity: a convolutional text classifier over hashed word embeddings, learnt from every labelled text.

Words, and their first bytes, are hashed into 2^20 buckets; buckets met in at least ``MIN_DOCS`` training texts have an
embedding, all others share a zero vector; a word is the sum of its two. Filters of widths 1, 2 and 3 run over the whole text, the
largest response of each filter is kept, and a logistic layer on these gives the score. The first
embedding dimension starts as the smoothed log-odds of the bucket, so that filters begin near the
words that tell the classes apart; everything is then trained by AdaGrad.

Training is spread: labelled rows that aren't held out lie in shards of about ``SHARD``. In a round every shard starts
from the same model, steps over its rows, and hands on its changes as whole numbers; Spark averages them by parameter (an
embedding over the shards that met it), so that the sum doesn't depend on its order. The driver sees one model a round,
at most 2^20 embeddings.

Scores are calibrated (Platt) on the fifth of these rows that is kept from the fit; a threshold for each language is set on
the same rows, from counts of (language, label, logit to the nearest 1/``GRAIN``). Language is no input of a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.common import discard, give_back, keep_rows, parts, stored, text_hash
from pitframe.llm.learn import best_threshold, held_out, platt, sigmoid

SHARD = 4096  # labelled rows that step from one model, about
STEPPED = 40000  # rows stepped over, repeats counted, until which rounds go on
ROUNDS = (3, 5)  # fewest and most
MIN_DOCS = 4
BUCKETS = 1 << 20
DIM, FILTERS, WIDTHS, BATCH, RATE = 8, 6, (1, 2, 3), 128, 0.05
STEM = 4  # first bytes of a word that have an embedding of their own
FEW = 40  # calibration rows of a language under which it takes the common threshold
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SLICE = 1 << 18  # words scored, or stepped over, at a time
HELD = 1 << 22  # words of a shard held at a time
KNOWN = 1 << 18  # words whose buckets a worker remembers
UNIT = 1 << 30  # changes are handed on as multiples of its reciprocal
GRAIN = 200


class Known(dict):
    """Numbers of the words a worker has met, and their two buckets."""

    def __init__(self):
        super().__init__()
        self.array = np.zeros((1 << 12, 2), np.uint32)

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        if n == len(self.array):
            self.array = np.concatenate([self.array, np.zeros_like(self.array)])
        self.array[n] = zlib.crc32(word) & BUCKETS - 1, zlib.crc32(word[:STEM], 1) & BUCKETS - 1
        self[word] = n
        return n


_known = Known()


def forget() -> None:
    """Drop the words a worker remembers, with all else that its task has freed."""
    global _known
    _known = Known()
    give_back()


def buckets(text: str | None) -> np.ndarray:
    """A row a word: the bucket of the word and that of its first bytes, which forms of a word share."""
    words = WORD.findall((text or "").lower().encode())
    if len(_known) > KNOWN:
        _known.clear()
    at = np.fromiter(map(_known.__getitem__, words), np.int64, len(words))
    return _known.array[at]


class Model:
    """Row 0 of the embeddings is the zero vector of words not met; it is never changed."""

    def __init__(self, lookup: np.ndarray, odds: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.lookup = lookup
        self.e = rng.normal(0, 0.05, (len(odds), DIM))
        self.e[:, 0] = odds
        self.e[0] = 0
        self.w = {n: rng.normal(0, 0.1, (n, DIM, FILTERS)) for n in WIDTHS}
        for n in WIDTHS:
            self.w[n][:, 0, :] += 0.5 * np.where(np.arange(FILTERS) % 3 < 2, 1.0, -1.0)
        self.c = {n: np.zeros(FILTERS) for n in WIDTHS}
        self.v, self.b = rng.normal(0, 0.1, len(WIDTHS) * FILTERS), 0.0
        self.slope, self.offset, self.thresholds, self.common = 1.0, 0.0, {}, 0.5
        self.tables: dict[int, np.ndarray] = {}

    def seal(self) -> None:
        """Response of every embedding at every place of every filter; scoring only adds these up."""
        self.tables = {n: np.einsum("vd,jdf->jvf", self.e, self.w[n]).astype(np.float32) for n in WIDTHS}

    def pooled(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest response, its place) of each filter over a whole text, in slices that overlap."""
        longest, most, place = max(WIDTHS), [], []
        words = np.concatenate([words, np.zeros((max(longest - len(words), 0), 2), words.dtype)])
        for n in WIDTHS:
            best, where = np.full(FILTERS, -np.inf), np.zeros(FILTERS, np.int64)
            for a in range(0, len(words) - n + 1, SLICE):
                x = words[a:a + SLICE + n - 1]
                z = np.zeros((len(x) - n + 1, FILTERS), np.float32)
                for j in range(n):
                    for column in (0, 1):
                        z += self.tables[n][j][x[j:len(x) - n + 1 + j, column]]
                at = z.argmax(0)
                top = z[at, np.arange(FILTERS)]
                where = np.where(top > best, at + a, where)
                best = np.maximum(best, top)
            most.append(best + self.c[n])
            place.append(where)
        return np.concatenate(most), np.concatenate(place)

    def logit(self, words: np.ndarray) -> float:
        return float(np.maximum(self.pooled(words)[0], 0) @ self.v + self.b)

    def score(self, text: str | None) -> float:
        return float(sigmoid(np.float64(self.slope * self.logit(self.lookup[buckets(text)]) + self.offset)))

    def rejects(self, text: str | None, lang: str | None) -> bool:
        return self.score(text) >= self.thresholds.get(lang, self.common)

    def dense(self) -> np.ndarray:
        """All parameters but the embeddings, in one row."""
        return np.concatenate([*(self.w[n].ravel() for n in WIDTHS), *(self.c[n] for n in WIDTHS), self.v, [self.b]])

    def set_dense(self, flat: np.ndarray) -> None:
        parts = np.split(flat, np.cumsum([*(n * DIM * FILTERS for n in WIDTHS), *(FILTERS for _ in WIDTHS), len(self.v)]))
        k = len(WIDTHS)
        self.w = {n: x.reshape(n, DIM, FILTERS) for n, x in zip(WIDTHS, parts[:k], strict=True)}
        self.c = dict(zip(WIDTHS, parts[k:2 * k], strict=True))
        self.v, self.b = parts[-2], float(parts[-1][0])

    def gradient(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(of the dense parameters, embeddings met, of these) for a batch of texts, each of rows of embeddings."""
        least = max(WIDTHS)
        texts = [np.concatenate([t, np.zeros((least - len(t), 2), np.int64)]) if len(t) < least else t for t in texts]
        words, size = np.concatenate(texts), np.array([len(t) for t in texts])
        ends = np.cumsum(size)
        starts, doc = ends - size, np.repeat(np.arange(len(texts)), size)
        x = self.e[words[:, 0]] + self.e[words[:, 1]]
        tops, places = [], []
        for n in WIDTHS:
            z = np.full((len(x), FILTERS), -np.inf)
            z[:len(x) - n + 1] = sum(x[j:len(x) - n + 1 + j] @ self.w[n][j] for j in range(n))
            for j in range(1, n):
                z[ends - j] = -np.inf  # windows that would pass the end of their text
            top = np.maximum.reduceat(z, starts, axis=0)
            row, col = np.nonzero(z == top[doc])
            _, first = np.unique(doc[row] * FILTERS + col, return_index=True)
            tops.append(top + self.c[n])
            places.append(row[first].reshape(len(texts), FILTERS))
        on = np.maximum(np.concatenate(tops, axis=1), 0)
        err = (sigmoid(on @ self.v + self.b) - y) * weight / len(texts)
        g = err[:, None] * self.v * (on > 0)
        gw, gc, met, ge = [], [], [], []
        for k, n in enumerate(WIDTHS):
            own = g[:, k * FILTERS:(k + 1) * FILTERS]
            gc.append(own.sum(0))
            for j in range(n):
                at = words[places[k] + j]
                gw.append(np.einsum("bf,bfd->df", own, self.e[at[..., 0]] + self.e[at[..., 1]]).ravel())
                change = own[:, :, None] * self.w[n][j].T
                met += [at[..., 0].ravel(), at[..., 1].ravel()]
                ge += [change.reshape(-1, DIM)] * 2
        met, back = np.unique(np.concatenate(met), return_inverse=True)
        total = np.zeros((len(met), DIM))
        np.add.at(total, back.ravel(), np.concatenate(ge))
        keep = met > 0
        return np.concatenate([*gw, *gc, on.T @ err, [err.sum()]]), met[keep], total[keep]


class Steps:
    """AdaGrad from a model over the rows of one shard."""

    def __init__(self, model: Model, rate: float, seed: int):
        self.model, self.rate, self.rng = model, rate, np.random.default_rng(seed)
        self.start, self.e = model.dense(), model.e
        model.e = model.e.copy()
        self.seen, self.e_seen, self.met = np.full(len(self.start), 1e-6), np.full(model.e.shape, 1e-4), np.zeros(len(model.e), bool)

    def over(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
        model, order = self.model, self.rng.permutation(len(texts))
        ends = np.cumsum([len(texts[i]) for i in order])
        a = 0
        while a < len(order):
            most = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE))
            batch = order[a:max(min(a + BATCH, most), a + 1)]
            a += len(batch)
            flat, met, ge = model.gradient([texts[i] for i in batch], y[batch], weight[batch])
            self.seen += flat * flat
            model.set_dense(model.dense() - self.rate * flat / np.sqrt(self.seen))
            self.e_seen[met] += ge * ge
            model.e[met] -= self.rate * ge / np.sqrt(self.e_seen[met])
            self.met[met] = True

    def changes(self) -> tuple[np.ndarray, np.ndarray]:
        """(parameter rows, their changes in units): embeddings by number, the dense ones after them as rows of negative number."""
        at = np.flatnonzero(self.met)
        flat = self.model.dense() - self.start
        flat = np.concatenate([flat, np.zeros(-len(flat) % DIM)]).reshape(-1, DIM)
        rows = np.concatenate([self.model.e[at] - self.e[at], flat])
        self.model.e = self.e
        self.model.set_dense(self.start)
        return np.concatenate([at, -1 - np.arange(len(flat))]), np.round(rows * UNIT).astype(np.int64)


def labelled_rows(docs: DataFrame, labels: DataFrame, target: str, id_col: str) -> DataFrame:
    """(shard, fitted, lang, y, text), stored: all rows with a label that aren't held out; one fifth, by id, isn't fitted.

    Null ids and labels are left out; of several labels of an id the largest counts. The number of
    shards follows the labels, not the cluster.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(target).cast("int").alias("y")).filter("y IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    own = docs.filter(F.col("id").isNotNull() & ~held_out("id"))
    shards = -(-max(labels.count(), 1) // SHARD)
    rows = own.repartition(shards, "id").join(known.repartition(shards, "id"), "id")
    fitted = F.crc32(F.concat(F.lit("fit "), F.col("id").cast("string"))) % 5 != 0
    rows = rows.sortWithinPartitions(F.xxhash64(F.lit(7), "id"), "id", text_hash("text"), "lang")
    return stored(rows.select(F.spark_partition_id().alias("shard"), fitted.alias("fitted"), "lang", (F.col("y") == 1).cast("int").alias("y"), "text"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", target: str = "toxic") -> Model:
    """Fit on all labelled rows that aren't held out: four fifths are fitted on, one fifth calibrates.

    With one class or no labels the model scores the share of that class, or one half, and rejects nothing.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = labelled_rows(own, labels, target, id_col)
    sizes = {(bool(r["fitted"]), int(r["y"])): int(r["n"]) for r in rows.groupBy("fitted", "y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 4:
        model = Model(np.zeros(BUCKETS, np.int32), np.zeros(1))
        model.v[:] = 0
        model.seal()
        many = sum(sizes.values())
        only = sum(n for (_, y), n in sizes.items() if y) / many if many else 0.5
        model.offset, model.common = float(np.log((only + 1e-3) / (1 - only + 1e-3))), 2.0
    else:
        model = fit_model(rows, sizes[True, 0], sizes[True, 1])
    discard(rows)
    return model


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, neg, pos): fitted texts of each class that hold a bucket, all of them counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.zeros((2, BUCKETS), np.int64)
        for x in batches:
            for y, text in zip(x.column("y").to_pylist(), x.column("text").to_pylist(), strict=True):
                many[y, np.unique(buckets(text))] += 1
        met = np.flatnonzero(many.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(many[0, met]), pa.array(many[1, met])], ["bucket", "neg", "pos"])
    found = rows.filter("fitted").select("y", "text").mapInArrow(run, "bucket long, neg long, pos long")
    return found.groupBy("bucket").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))


def fit_model(rows: DataFrame, neg: int, pos: int) -> Model:
    """The model of :func:`labelled_rows`, of which ``neg`` and ``pos`` are fitted on."""
    spark = rows.sparkSession
    met = bucket_counts(rows).filter(F.col("neg") + F.col("pos") >= MIN_DOCS).toPandas().sort_values("bucket")
    lookup = np.zeros(BUCKETS, np.int32)
    lookup[met["bucket"].to_numpy()] = np.arange(1, len(met) + 1)
    a = 5.0
    odds = np.log((met["pos"].to_numpy() / pos * 1000 + a) / (met["neg"].to_numpy() / neg * 1000 + a))
    model = Model(lookup, np.append(0.0, odds))
    even = np.array([(neg + pos) / (2 * neg), (neg + pos) / (2 * pos)])  # classes weigh the same
    rounds = min(max(-(-STEPPED // (neg + pos)), ROUNDS[0]), ROUNDS[1])
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        total = changes(rows, sent, even, RATE / (1 + turn) ** 0.5, turn).toPandas()
        at, mean = total["at"].to_numpy(), total[[f"d{i}" for i in range(DIM)]].to_numpy() / total["n"].to_numpy()[:, None] / UNIT
        word = at >= 0
        model.e[at[word]] += mean[word]
        flat = np.zeros((int((~word).sum()), DIM))
        flat[-1 - at[~word]] = mean[~word]
        now = model.dense()
        model.set_dense(now + flat.ravel()[:len(now)])
        sent.unpersist()
    model.seal()
    calibrate(model, rows)
    return model


def changes(rows: DataFrame, sent, even: np.ndarray, rate: float, turn: int) -> DataFrame:
    """(at, d0, ..., n): sums over the shards of what their steps change in each row of parameters, and how many shards met it."""
    names = [f"d{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, steps, shard, texts, marks, size = sent.value, None, None, [], [], 0

        def close() -> None:
            nonlocal texts, marks, size
            if texts:
                y = np.array(marks)
                steps.over(texts, y.astype(float), even[y])
            texts, marks, size = [], [], 0

        def out() -> pa.RecordBatch:
            close()
            at, d = steps.changes()
            return pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(d[:, i]) for i in range(DIM))], ["at", *names])
        for x in batches:
            for own, y, text in zip(*(x.column(c).to_pylist() for c in ("shard", "y", "text")), strict=True):
                if own != shard:
                    if steps is not None:
                        yield out()
                    shard, steps = own, Steps(model, rate, 1000003 * turn + own)
                texts.append(model.lookup[buckets(text)].astype(np.int64))
                marks.append(y)
                size += len(texts[-1])
                if size > HELD:
                    close()
        if steps is not None:
            yield out()
    found = rows.filter("fitted").select("shard", "y", "text").mapInArrow(run, f"at long, {', '.join(f'{c} long' for c in names)}")
    return found.groupBy("at").agg(*(F.sum(c).alias(c) for c in names), F.count("*").alias("n"))


def calibrate(model: Model, rows: DataFrame) -> None:
    """Slope, offset and thresholds from all rows that weren't fitted on, counted by language, label and rounded logit."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for x in batches:
            z = np.array([m.logit(m.lookup[buckets(t)]) for t in x["text"]], np.float64)
            yield x[["lang", "y"]].assign(bin=np.round(np.clip(z, -40, 40) * GRAIN).astype(np.int64))
    found = rows.filter("NOT fitted").select("lang", "y", "text").mapInPandas(run, "lang string, y int, bin long")
    bins = stored(found.groupBy("lang", "y", "bin").agg(F.count("*").alias("n")))
    grain = lambda x: (x["bin"].to_numpy() / GRAIN, x["y"].to_numpy().astype(float), x["n"].to_numpy().astype(float))
    z, y, n = grain(bins.groupBy("y", "bin").agg(F.sum("n").alias("n")).toPandas().sort_values(["bin", "y"]))
    model.slope, model.offset = platt(z, y, n)
    model.common = best_threshold(sigmoid(model.slope * z + model.offset), y, n)
    enough = bins.filter("lang IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("all"), F.countDistinct("y").alias("classes")).filter((F.col("all") >= FEW) & (F.col("classes") == 2))
    for lang, own in bins.join(enough.select("lang"), "lang").toPandas().sort_values(["lang", "bin", "y"]).groupby("lang"):
        z, y, n = grain(own)
        model.thresholds[lang] = best_threshold(sigmoid(model.slope * z + model.offset), y, n)
    discard(bins)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, score, predicted, rejected) for every row, over whole texts.

    ``predicted`` is score >= 0.5; ``rejected`` uses the threshold of the row's language, or the common
    one where the language is null, rare or new. Null and empty texts get the score of no words.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, lang_col))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for x in batches:
            s = np.array([model.score(t) for t in x["text"]], np.float64)
            bar = np.array([model.thresholds.get(v, model.common) for v in x["lang"]], np.float64)
            yield pd.DataFrame({"id": x["id"], "held_out": x["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32), "rejected": s >= bar})
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, held_out boolean, score double, predicted int, rejected boolean")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that aren't rejected, all columns as they were."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, lang_col))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bool]]]:
        model = sent.value
        for batch in (p for b in batches for p in parts(b)):
            text, lang = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (text_col, lang_col))
            yield batch, [not model.rejects(t, v) for t, v in zip(text, lang, strict=True)]
        forget()
    return keep_rows(docs, keep)
