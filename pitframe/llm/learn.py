"""Shared by the trained operators: label folds, bounded samples, logistic regression, calibration."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.llm.common import text_hash

FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id as text is divisible by the number of folds (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == 0


def chosen_fold(value: object) -> bool:
    """``held_out`` of one id, outside Spark."""
    return zlib.crc32(str("" if value is None else value).encode()) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, most: int, id_col: str = "doc_id", seed: int = 7) -> tuple[DataFrame, dict[int, float]]:
    """(rows of ``docs`` with ``y``, share of each class that was sampled): at most ``most`` ids of each class.

    ``docs`` has columns id and text, and no y. Ids are drawn by seeded hash among labelled documents
    that aren't held out, whatever the length of their texts. Null ids and labels are left out; of
    several labels of an id the largest counts, of several rows of an id the one with the smallest text
    hash, so the bound holds for rows too.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(target).cast("int").alias("y")).filter("y IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    pool = known.join(docs.select("id").filter(F.col("id").isNotNull() & ~held_out("id")).distinct(), "id")
    sizes = {int(r["y"]): int(r["n"]) for r in pool.groupBy("y").agg(F.count("*").alias("n")).collect()}
    drawn = None
    for y in sizes:
        part = pool.filter(F.col("y") == y).orderBy(F.xxhash64(F.lit(seed), F.col("id"))).limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    if drawn is None:
        return docs.limit(0).withColumn("y", F.lit(0)), {}
    rows = docs.join(F.broadcast(drawn), "id")  # at most 2 * most ids
    one = rows.groupBy("id").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "id"]), text_hash("text")).alias("r")).select("id", "r.*")
    return one.select(*docs.columns, "y"), {y: min(1.0, most / n) for y, n in sizes.items()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 400, rate: float = 0.05) -> np.ndarray:
    """Weights (last one the offset) of a weighted, ridge-penalised logistic regression, by Adam."""
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, m, v = np.zeros(x1.shape[1]), 0.0, 0.0
    weight = weight / max(weight.sum(), 1e-9)
    for t in range(1, steps + 1):
        g = x1.T @ (weight * (sigmoid(x1 @ w) - y)) + penalty * np.append(w[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) so that sigmoid(slope * z + offset) is a calibrated probability."""
    if len(np.unique(y)) < 2:
        return 1.0, 0.0
    mean, spread = float(z.mean()), float(z.std()) or 1.0
    a, b = logistic(((z - mean) / spread)[:, None], y, weight, 1e-4, 800)
    return float(a / spread), float(b - a * mean / spread)


def best_threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Score at which F1 is largest; the middle between it and the next lower score."""
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum((weight * y)[order])
    said = np.cumsum(weight[order])
    f1 = 2 * hit / (said + (weight * y).sum())
    last = np.append(np.diff(s) != 0, True)
    i = int(np.argmax(np.where(last, f1, -1)))
    return float((s[i] + s[i + 1]) / 2 if i + 1 < len(s) else s[i] / 2)
