"""Nearest neighbours by inner product: low-dimensional stable projections under a kd-tree.

Largest inner product becomes nearest Euclidean point: a candidate gets one more coordinate,
sqrt(M^2 - |x|^2) with M the longest candidate, a query gets zero there. Both are projected on ``DIMS``
random Gaussian directions (2-stable: a projected squared distance over the true one is chi-square
with ``DIMS`` degrees of freedom). A kd-tree over the projected candidates gives leaves in order of
their least projected distance; leaves are verified on the original vectors, in that order, until

    chi2_cdf(next projected distance^2 / k-th true distance^2) > STOP

so that a candidate not seen yet is nearer than the k-th with a probability of at most 1 - STOP. There
is no cap on verified candidates.

Candidates are dealt by hash into blocks and queries into groups; every group meets every block, each
pair as one task, and the nearest of the blocks are merged. Every candidate is indexed; nothing is
fitted on a sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitframe.llm.common import stored

K = 20
DIMS = 8
STOP = 0.9
BLOCK = 8192  # candidates of a block
GROUP = 2048  # queries of a group
LEAF = 128
SEED = 20240301


def chi2_cdf(x: float, dims: int = DIMS) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, dims // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def chi2_point(p: float, dims: int = DIMS) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, dims) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dims) < p else (low, mid)
    return high


class KdTree:
    """Balanced kd-tree: rows in leaf order, with the bounding box of each leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.leaves: list[tuple[int, int]] = []
        todo = [(0, len(points))]
        while todo:
            a, b = todo.pop()
            if b - a <= leaf:
                self.leaves.append((a, b))
                continue
            rows = self.order[a:b]
            x = points[rows]
            axis = int(np.argmax(x.max(0) - x.min(0)))
            mid = (b - a) // 2
            self.order[a:b] = rows[np.argpartition(x[:, axis], mid)]
            todo += [(a, a + mid), (a + mid, b)]
        self.low = np.array([points[self.order[a:b]].min(0) for a, b in self.leaves])
        self.high = np.array([points[self.order[a:b]].max(0) for a, b in self.leaves])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Squared distance from each query to each leaf's box."""
        out = np.zeros((len(q), len(self.leaves)))
        for d in range(q.shape[1]):
            gap = np.maximum(self.low[None, :, d] - q[:, None, d], q[:, None, d] - self.high[None, :, d])
            out += np.square(np.maximum(gap, 0, out=gap))
        return out


def score(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each row summed alone, so that equal vectors score equally."""
    return (x * q).sum(axis=1)


def nearest_in_block(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, longest: float, k: int, stop: float, dims: int = DIMS) -> list[tuple[int, int, float]]:
    """(query, candidate, score): up to ``k`` nearest of one block for each query."""
    # Of equal vectors only the k rows of smallest ids can be among the nearest, not counting the query's
    # own id: a row is left out if k come before it without those of any one other id.
    by_id = np.argsort(vid, kind="stable")
    _, group = np.unique(x[by_id], axis=0, return_inverse=True)
    group = group.reshape(-1)
    same = np.argsort(group, kind="stable")
    first = np.concatenate([[True], np.diff(group[same]) != 0])
    nth = np.arange(len(same)) - np.maximum.accumulate(np.where(first, np.arange(len(same)), 0))
    new = first | np.concatenate([[True], np.diff(vid[by_id][same]) != 0])  # a run: rows of one vector and id
    run, begins = np.cumsum(new) - 1, np.flatnonzero(new)
    of, many = group[same][begins].astype(np.int64), np.diff(np.append(begins, len(same)))
    most = np.maximum.accumulate(of * (len(same) + 1) + many)
    before = np.where(first[begins], 0, np.concatenate([[0], most[:-1]]) - of * (len(same) + 1))  # longest earlier run of the vector
    keep = np.sort(by_id[same[nth - before[run] < k]])
    vid, x = vid[keep], x[keep]
    plane = np.random.default_rng(SEED).standard_normal((x.shape[1] + 1, dims))
    rest = np.sqrt(np.maximum(longest**2 - np.square(x).sum(1), 0.0))
    tree = KdTree(np.hstack([x, rest[:, None]]) @ plane)
    vid, x = vid[tree.order], x[tree.order]
    near = tree.bounds(q @ plane[:-1])
    point, out = chi2_point(stop, dims), []
    for i in range(len(q)):
        order = np.argsort(near[i], kind="stable")
        q2 = float(np.square(q[i]).sum()) + longest**2
        best_s, best_v, at, step = np.zeros(0), np.zeros(0, np.int64), 0, 4
        while at < len(order):
            if len(best_v) >= k:  # true distance^2 = |q|^2 + M^2 - 2 q.x
                if near[i, order[at]] > point * max(q2 - 2 * best_s[k - 1], 0.0) + 1e-12 * q2:
                    break
            rows = np.concatenate([np.arange(*tree.leaves[j]) for j in order[at:at + step]])
            at, step = at + step, 2 * step
            rows = rows[vid[rows] != qid[i]]
            if len(rows) > k or len(best_v) >= k:
                near_s = x[rows] @ q[i]
                least = best_s[k - 1] if len(best_v) >= k else np.partition(near_s, len(rows) - k)[len(rows) - k]
                rows = rows[near_s >= least - 1e-9 * q2]
            s, v = np.concatenate([best_s, score(q[i], x[rows])]), np.concatenate([best_v, vid[rows]])
            top = np.lexsort((v, -s))[:k]
            best_s, best_v = s[top], v[top]
        out += [(int(qid[i]), int(v), float(s)) for s, v in zip(best_s, best_v, strict=True)]
    return out


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part: no null, zero or non-finite vector, no null id."""
    v = F.col("vec")
    finite = F.forall(v, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < F.lit(float("inf"))))
    x = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return x.filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite).filter(F.exists(v, lambda a: a != 0))


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, stop: float = STOP, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest other vectors that were found.

    Larger inner product first, ties to the smaller id; all candidates if there are fewer. Null, zero
    or non-finite vectors and null ids take no part. Repeated rows of an id count as candidates once
    each; a query id with several vectors asks with the smallest of them. Vectors of another length than a query are no candidates of it. No rows in give none out.
    """
    x = stored(usable(vectors, id_col, vec_col).withColumn("dim", F.size("vec")))
    q = stored(usable(queries, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec")))
    facts = x.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, a: s + a * a))).alias("m")).first()
    if not facts["n"]:
        return x.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks, groups, longest = math.ceil(facts["n"] / block), math.ceil(max(q.count(), 1) / group), float(facts["m"]) * (1 + 1e-12)
    b, g = F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)), F.pmod(F.xxhash64("id"), F.lit(groups))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = q.select("dim", "id", "vec", g.cast("int").alias("g")).withColumn("b", every(blocks)).withColumn("is_query", F.lit(True))
    right = x.select("dim", "id", "vec", b.cast("int").alias("b")).withColumn("g", every(groups)).withColumn("is_query", F.lit(False))

    def run(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        asks = parts[parts["is_query"]]
        has = parts[~parts["is_query"]]
        found = []
        if len(asks) and len(has):
            found = nearest_in_block(asks["id"].to_numpy(), np.array(asks["vec"].tolist()), has["id"].to_numpy(), np.array(has["vec"].tolist()), longest, k, stop)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    both = left.unionByName(right).repartition("dim", "b", "g")
    found = both.groupBy("dim", "b", "g").applyInPandas(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K) -> Iterator[tuple[int, list[int]]]:
    """Brute force over small inputs, to measure recall."""
    x = usable(vectors, id_col, vec_col).toPandas()
    ids, data = x["id"].to_numpy(), np.array(x["vec"].tolist())
    for qid, vec in usable(queries, id_col, vec_col).toPandas().itertuples(index=False):
        s = score(np.array(vec), data)
        rows = np.flatnonzero(ids != qid)
        yield int(qid), ids[rows[np.lexsort((ids[rows], -s[rows]))[:k]]].tolist()
