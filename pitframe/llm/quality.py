"""Quality by co-training: a text view and a page-metadata view teach each other.

The text view sees word shapes and layout ratios of the whole text; the metadata view sees source,
language and recorded size, never the text. Each is a logistic regression. In every round each view
labels all unlabelled documents that aren't held out, in Spark, and hands its most confident rows of
both classes to the other view; only handed rows reach the driver. After the last round both are
calibrated on labelled rows kept from the fit, and the calibrated log-odds are combined by a second
regression on the same rows. All documents are then scored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.common import discard, stored, text_hash
from pitframe.llm.learn import best_threshold, held_out, labelled_sample, logistic, platt, sigmoid

SAMPLE = 3000  # most labelled ids of each class
ROUNDS = 4
LOW, HIGH = 0.05, 0.95  # probabilities beyond which a view hands a row
HANDED = 200  # pseudo-labels of each class a round and view
SHAPES, METAS = 512, 256
SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 else 57 if 48 <= b <= 57 else 104 if b >= 128 else b for b in range(256))


def text_features(text: str | None) -> np.ndarray:
    """Layout ratios and hashed shares of word shapes; of a text without words all zero."""
    raw = (text or "").encode()
    words = raw.split()
    out = np.zeros(12 + SHAPES, np.float32)
    if not words:
        return out
    shaped = raw.translate(SHAPE)
    n, size = len(words), len(raw)
    letters = shaped.count(b"a") + shaped.count(b"h")
    upper = shaped.count(b"A")
    lines = raw.count(b"\n") + 1
    same = sum(map(bytes.__eq__, words, words[1:]))
    kinds = len(set(words))
    out[:12] = (
        upper / size, letters / size, shaped.count(b"9") / size, (size - upper - letters - shaped.count(b"9") - n) / size,
        same / n, kinds / n, math.log1p(n) / 10 * (1 - kinds / n), size / n / 20, math.log1p(n / lines) / 5, math.log1p(lines) / 5, math.log1p(n) / 10, float(n < 10),
    )
    for shape, c in Counter(shaped.split()).items():
        out[12 + zlib.crc32(shape) % SHAPES] += c / n
    out[12:] = np.sqrt(out[12:])
    return out


def meta_features(source: str | None, lang: str | None, size: int | None) -> np.ndarray:
    """Hashed source, language, size class and pairs of them; nulls are values of their own."""
    out = np.zeros(METAS, np.float32)
    step = "none" if size is None else str(int(2 * math.log2(max(size, 0) + 1)))
    for f in (f"s:{source}", f"l:{lang}", f"z:{step}", f"sl:{source}|{lang}", f"lz:{lang}|{step}"):
        out[zlib.crc32(f.encode()) % METAS] += 1
    return out


class Model:
    """Weights of both views, their calibration, and the weights that combine them."""

    def __init__(self, text: np.ndarray, meta: np.ndarray):
        self.text, self.meta = text, meta
        self.text_cal, self.meta_cal = (1.0, 0.0), (1.0, 0.0)
        self.both, self.bar = np.array([1.0, 0.0, 0.0]), 0.5

    def views(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        za, zb = a @ self.text[:-1] + self.text[-1], b @ self.meta[:-1] + self.meta[-1]
        return self.text_cal[0] * za + self.text_cal[1], self.meta_cal[0] * zb + self.meta_cal[1]

    def score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        za, zb = self.views(a, b)
        return sigmoid(self.both[0] * za + self.both[1] * zb + self.both[2])


def handed(view: np.ndarray, most: int, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, labels) of the most confident rows of each class, beyond the given probabilities."""
    order = np.argsort(view, kind="stable")
    zeros = order[:most][view[order[:most]] <= low]
    ones = order[::-1][:most]
    ones = ones[view[ones] >= high]
    return np.concatenate([zeros, ones]), np.concatenate([np.zeros(len(zeros)), np.ones(len(ones))])


def exchanged(a: np.ndarray, b: np.ndarray, y: np.ndarray, weight: np.ndarray, give: Callable[[dict], dict], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the text and the metadata view after ``rounds`` of pseudo-labels.

    ``give`` takes both views' weights by name and returns (features, labels) that each view is taught.
    """
    own = {"a": (a, y, weight), "b": (b, y, weight)}
    w = {v: logistic(*own[v]) for v in own}
    for _ in range(rounds):
        gave = give(w)
        for pupil in ("b", "a"):
            x, labels = gave[pupil]
            x0, y0, w0 = own[pupil]
            own[pupil] = np.vstack([x0, x]), np.append(y0, labels), np.append(w0, np.full(len(labels), 0.5 * w0.mean()))
            w[pupil] = logistic(*own[pupil])
    return w["a"], w["b"]


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, weight: np.ndarray, pool_a: np.ndarray, pool_b: np.ndarray, rounds: int = ROUNDS, most: int = HANDED) -> tuple[np.ndarray, np.ndarray]:
    """``exchanged`` with unlabelled rows that are held in memory."""
    free = {"a": np.arange(len(pool_a)), "b": np.arange(len(pool_a))}  # pool rows each view may still be taught

    def give(w: dict) -> dict:
        gave = {}
        for teacher, pupil, px, own in (("a", "b", pool_a, pool_b), ("b", "a", pool_b, pool_a)):
            rows = free[pupil]
            at, labels = handed(sigmoid(px[rows] @ w[teacher][:-1] + w[teacher][-1]), most, LOW, HIGH)
            gave[pupil] = own[rows[at]], labels
            free[pupil] = np.setdiff1d(rows, rows[at])
        return gave
    return exchanged(a, b, y, weight, give, rounds)


def sparse(x: np.ndarray) -> bytes:
    """Places and values of what isn't zero."""
    at = np.flatnonzero(x)
    return at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes()


def dense(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width))
    for row, v in zip(out, packed, strict=True):
        n = len(v) // 6
        row[np.frombuffer(v, "<u2", n)] = np.frombuffer(v, "<f4", n, 2 * n)
    return out


def unlabelled(own: DataFrame, known: DataFrame) -> DataFrame:
    """(key, a, b), stored: both views' features of every row that is neither held out nor labelled, repeated rows once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            a = [sparse(text_features(t)) for t in x["text"]]
            b = [sparse(meta_features(s, v, None if pd.isna(z) else int(z))) for s, v, z in zip(x["source"], x["lang"], x["size"], strict=True)]
            yield x[["id", "key"]].assign(a=a, b=b)
    rows = own.filter(F.col("id").isNotNull() & ~held_out("id")).withColumn("key", F.xxhash64("id", text_hash("text"), "source", "lang", "size"))
    x = rows.select("id", "key", "source", "lang", "size", "text").mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, key long, a binary, b binary")
    return stored(x.join(known, "id", "left_anti").dropDuplicates(["key"]).select("key", "a", "b"))


def most_confident(pool: DataFrame, w: dict, taught: dict, most: int = HANDED) -> pd.DataFrame:
    """(pupil, label, key, a, b): for each view the ``most`` rows of each class of which the other is surest.

    All rows of ``pool`` are scored but those of the keys in ``taught``. A task passes on its own best;
    the best of all are taken by order, ties by key.
    """
    sent = pool.sparkSession.sparkContext.broadcast((w, {v: np.array(sorted(k), np.int64) for v, k in taught.items()}))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, done = sent.value
        best: dict = {}
        for x in batches:
            for teacher, pupil in (("a", "b"), ("b", "a")):
                p = sigmoid(dense(x[teacher].tolist(), len(w[teacher]) - 1) @ w[teacher][:-1] + w[teacher][-1])
                free = ~np.isin(x["key"].to_numpy(), done[pupil])
                for label, far, sure in ((0, p, p <= LOW), (1, 1 - p, p >= HIGH)):
                    found = x[free & sure].assign(pupil=pupil, label=label, far=far[free & sure])
                    found = pd.concat([best[pupil, label], found]) if (pupil, label) in best else found
                    best[pupil, label] = found.sort_values(["far", "key"]).head(most)
        for found in best.values():
            yield found[["pupil", "label", "far", "key", "a", "b"]]
    near = stored(pool.mapInPandas(run, "pupil string, label int, far double, key long, a binary, b binary"))
    top = None
    for pupil in ("a", "b"):
        for label in (0, 1):
            part = near.filter((F.col("pupil") == pupil) & (F.col("label") == label)).orderBy("far", "key").limit(most)
            top = part if top is None else top.unionByName(part)
    found = top.toPandas()
    discard(near)
    return found.sort_values(["pupil", "label", "far", "key"]).reset_index(drop=True)


def narrow(docs: DataFrame, id_col: str, text_col: str, meta_cols: tuple[str, str, str]) -> DataFrame:
    s, v, z = meta_cols
    return docs.select(F.col(id_col).alias("id"), F.col(s).cast("string").alias("source"), F.col(v).cast("string").alias("lang"), F.col(z).cast("long").alias("size"), F.col(text_col).alias("text"))


def featured(rows: DataFrame, extra: list[str]) -> DataFrame:
    """(id, extra, a, b): both views' features as packed floats."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            a = [text_features(t).tobytes() for t in x["text"]]
            b = [meta_features(s, v, None if pd.isna(z) else int(z)).tobytes() for s, v, z in zip(x["source"], x["lang"], x["size"], strict=True)]
            yield x[["id", *extra]].assign(a=a, b=b)
    x = rows.select("id", *[F.col(c).cast("int") for c in extra], "source", "lang", "size", "text")
    return x.mapInPandas(run, ", ".join([f"id {kind}", *[f"{c} int" for c in extra], "a binary", "b binary"]))


def unpack(x: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    grid = lambda c, n: np.array([np.frombuffer(bytes(v), np.float32) for v in x[c]]).reshape(len(x), n).astype(np.float64)
    return grid("a", 12 + SHAPES), grid("b", METAS)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, str, str] = ("source", "lang", "n_chars"), target: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled ids of each class, drawn by seeded hash, and all unlabelled rows.

    No held-out row is used. Where the sample has one class only, the score is that class's share.
    """
    own = narrow(docs, id_col, text_col, meta_cols)
    rows, share = labelled_sample(own, labels, target, sample, id_col)
    x = featured(rows, ["y"]).toPandas()
    x["h"] = [zlib.crc32(v) for v in x["a"]]
    x = x.sort_values(["id", "h"], kind="stable").reset_index(drop=True)
    y = (x["y"].to_numpy() == 1).astype(float)
    fitted = np.array([zlib.crc32(f"fit {i}".encode()) % 5 != 0 for i in x["id"]], bool)
    if len(np.unique(y[fitted])) < 2 or len(np.unique(y[~fitted])) < 2:
        model = Model(np.zeros(13 + SHAPES), np.zeros(METAS + 1))
        only = float(y.mean()) if len(y) else 0.5
        model.both = np.array([0.0, 0.0, math.log((only + 1e-3) / (1 - only + 1e-3))])
        return model
    a, b = unpack(x)
    back = np.array([1 / share[int(v)] for v in x["y"]])
    pool = unlabelled(own, labels.filter(F.col(target).isNotNull()).select(F.col(id_col).alias("id")))
    taught: dict = {"a": set(), "b": set()}

    def give(w: dict) -> dict:
        rows, gave = most_confident(pool, w, taught), {}
        for pupil, width in (("a", 12 + SHAPES), ("b", METAS)):
            own = rows[rows["pupil"] == pupil]
            taught[pupil].update(own["key"].tolist())
            gave[pupil] = dense(own[pupil].tolist(), width), own["label"].to_numpy(float)
        return gave
    model = Model(*exchanged(a[fitted], b[fitted], y[fitted], back[fitted], give))
    discard(pool)
    rest = ~fitted
    za, zb = model.views(a[rest], b[rest])
    model.text_cal, model.meta_cal = platt(za, y[rest], back[rest]), platt(zb, y[rest], back[rest])
    z = np.stack(model.views(a[rest], b[rest]), axis=1)
    scale = np.maximum(z.std(0), 1e-6)
    both = logistic(z / scale, y[rest], back[rest], 1e-4, 800)
    model.both = np.append(both[:-1] / scale, both[-1])
    model.bar = 1 - best_threshold(1 - model.score(a[rest], b[rest]), 1 - y[rest], back[rest])
    return model


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, str, str] = ("source", "lang", "n_chars"), sample: int = SAMPLE) -> DataFrame:
    """(id, held_out, score, text_score, meta_score, keep): every row's probability of quality 1.

    ``keep`` is score >= 0.5. Null and empty texts are scored on an all-zero text view; null metadata
    are values of their own. Repeated rows and null ids come out as they came in.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, meta_cols, sample=sample))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            for s in range(0, len(batch), 1024):
                x = batch.iloc[s:s + 1024]
                a = np.array([text_features(t) for t in x["text"]], np.float64)
                b = np.array([meta_features(p, v, None if pd.isna(z) else int(z)) for p, v, z in zip(x["source"], x["lang"], x["size"], strict=True)], np.float64)
                za, zb = model.views(a, b)
                p = model.score(a, b)
                yield pd.DataFrame({"id": x["id"], "held_out": x["held_out"], "score": p, "text_score": sigmoid(za), "meta_score": sigmoid(zb), "keep": p >= 0.5})
    rows = narrow(docs, id_col, text_col, meta_cols).withColumn("held_out", held_out("id"))
    return rows.mapInPandas(run, f"id {kind}, held_out boolean, score double, text_score double, meta_score double, keep boolean")
