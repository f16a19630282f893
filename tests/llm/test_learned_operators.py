"""Trained operators on held-out rows, nearest neighbours against brute force, and the pipeline's stages."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pitframe.llm import ann, quality, toxicity
from pitframe.llm.common import components, ship
from pitframe.llm.learn import chosen_fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, y int, held_out string"


@pytest.fixture(scope="module")
def corpus(spark):
    ship(spark)
    r = random.Random(6)
    docs, labels = [], []
    for i in range(900):
        lang = r.choice(["en", "de"])
        toxic, good = r.random() < 0.3, r.random() < 0.6
        w = [f"{lang}{r.randrange(800)}" for _ in range(r.randint(30, 120))]
        if toxic:
            for _ in range(2):
                w.insert(r.randrange(len(w)), r.choice(["vile", "rotten"] if lang == "en" else ["übel", "fies"]) + r.choice(["", "."]))
        if not good:
            w = [f"{x.upper()}!!" for x in w]
        docs.append((i, " ".join(w), lang, f"s{r.randrange(3) + 3 * good}", len(w), 0.5, 7, "clash"))
        if r.random() < 0.8:
            labels.append((i, int(good), int(toxic)))
    odd = [(None, None, None, None, None, None, None, None), (5000, "", "xx", "new", 0, None, None, None), docs[3], docs[3], (5001, "vile " * 70_000, "en", "s0", 3, None, None, None)]
    labels += [(None, 1, 1), (5002, None, None), (5000, None, 0), labels[0]]
    truth = {d[0]: (int("!!" not in d[1]), int(any(x in d[1].lower() for x in ("vile", "rotten", "übel", "fies")))) for d in docs}
    return spark.createDataFrame(docs + odd, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def accuracy(rows, truth, key, value):
    held = [x for x in rows if x["held_out"] and x["id"] in truth]
    assert len(held) > 100 and all(x["held_out"] == chosen_fold(x["id"]) for x in rows)
    return np.mean([value(x) == truth[x["id"]][key] for x in held])


def test_toxicity_on_held_out_rows(corpus):
    docs, labels, truth = corpus
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.5) for x in rows)
    assert accuracy(rows, truth, 1, lambda x: x["predicted"]) > 0.93
    assert accuracy(rows, truth, 1, lambda x: int(x["rejected"])) > 0.93
    assert [x["predicted"] for x in rows if x["id"] == 5001] == [1]
    left = toxicity.without_toxic(docs, labels)
    assert left.schema == docs.schema and left.count() == sum(not x["rejected"] for x in rows)


def test_toxicity_without_labels(corpus):
    docs, labels, _ = corpus
    assert {x["score"] for x in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.without_toxic(docs, labels.filter("toxic = 1")).count() == docs.count()
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_quality_on_held_out_rows(corpus):
    docs, labels, truth = corpus
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= x["score"] <= 1 for x in rows)
    assert accuracy(rows, truth, 0, lambda x: int(x["keep"])) > 0.95
    assert accuracy(rows, truth, 0, lambda x: int(x["meta_score"] >= 0.5)) > 0.9
    assert quality.quality(docs.limit(0), labels).count() == 0
    assert len({x["score"] for x in quality.quality(docs, labels.limit(0)).collect()}) == 1


def test_co_training_teaches_the_other_view():
    r = np.random.default_rng(1)
    y = r.integers(0, 2, 3000)
    a, b = r.normal(y[:, None] * 4, 1, (3000, 2)), r.normal(y[:, None] * 1.5, 1, (3000, 40))
    few = np.arange(12)
    alone = quality.co_train(a[few], b[few], y[few], np.ones(12), a[12:2000], b[12:2000], 0)[1]
    taught = quality.co_train(a[few], b[few], y[few], np.ones(12), a[12:2000], b[12:2000])[1]
    right = lambda w: np.mean((b[2000:] @ w[:-1] + w[-1] > 0) == y[2000:])
    assert right(taught) > right(alone)


def test_every_unlabelled_row_can_be_taught(spark, monkeypatch):
    ship(spark)
    r, docs, labels = random.Random(3), [], []
    for i in range(6400):
        good, rare = i % 2, i % 200 == 0
        w = [f"w{r.randrange(800)}" for _ in range(20)]
        w = [x.upper() + "!!" if rare or (not good and r.random() < 0.5) else x for x in w]
        docs.append((i, " ".join(w), "en", "rare" if rare else f"s{r.randrange(4)}", 100))
        if i < 400 and not rare:
            labels.append((i, good))
    docs[6200] = (6200, " ".join(f"W{r.randrange(800)}!!" for _ in range(20_000)), "en", "rare", 100)  # also a very long text
    seen = []
    fit = quality.logistic
    monkeypatch.setattr(quality, "logistic", lambda x, *more: seen.append(x) or fit(x, *more))
    quality.train(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int"))
    mark = quality.meta_features("rare", "en", 100) - quality.meta_features("s0", "en", 100)
    taught = max((x for x in seen if x.shape[1] == quality.METAS), key=len)
    rare = (taught[:, mark > 0] > 0).all(axis=1).sum()
    assert rare == sum(d[3] == "rare" and not chosen_fold(d[0]) for d in docs)


@pytest.fixture(scope="module")
def vectors(spark):
    ship(spark)
    r = np.random.default_rng(2)
    rows = [(i, [float(v) for v in r.normal(size=12)], "clash", 1.0) for i in range(700)]
    rows += [(700 + i, rows[40][1], "x", 0.0) for i in range(60)]  # equal vectors: ties
    rows += [(800, None, "x", 0.0), (820, [0.0] * 12, "x", 0.0), (840, [float("nan")] * 12, "x", 0.0), (860, [None, *[1.0] * 11], "x", 0.0), (880, [float("inf")] * 12, "x", 0.0), (None, [1.0] * 12, "x", 0.0), (900, [1.0, 2.0], "x", 0.0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, rank double").repartition(3)


def test_nearest_neighbours(vectors):
    asked = vectors.filter("vec_id % 20 = 0")
    found = {}
    for x in ann.nearest(vectors, asked, block=256, group=16).orderBy("query_id", "rank").collect():
        found.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    want = {q: v for q, v in ann.exact(vectors.filter("size(embedding) = 12"), asked.filter("size(embedding) = 12"))}
    assert set(found) == set(want)
    assert np.mean([len({v for _, v, _ in found[q]} & set(want[q])) / 20 for q in want]) >= 0.9
    for q, rows in found.items():
        assert [r for r, _, _ in rows] == list(range(1, 21)) and q not in {v for _, v, _ in rows}
        assert rows == sorted(rows, key=lambda t: (-t[2], t[1]))
    assert [v for _, v, _ in found[40]] == want[40]  # ties go to the smaller ids


def test_nearest_of_few_and_none(vectors):
    few = vectors.filter("vec_id < 5")
    assert Counter(x["query_id"] for x in ann.nearest(few, few.filter("vec_id = 0")).collect()) == {0: 4}
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).count() == 0
    assert ann.nearest(vectors, vectors.filter("vec_id = 800")).count() == 0


def test_nearest_with_repeated_rows(spark):
    ship(spark)
    r = np.random.default_rng(4)
    for ids in ([5] * 15 + list(range(6, 60)), list(range(40)) + [40] * 30 + list(range(41, 60)), [1, 2, 2, 3, 3, 3] * 9 + [9] * 4):
        vid = r.permutation(np.array(ids))
        x = np.ones((len(vid), 3))
        asked = np.unique(vid)
        found = ann.nearest_in_block(asked, np.ones((len(asked), 3)), vid, x, 2.0, 20, 0.9)
        for q in asked.tolist():
            assert sorted(v for i, v, _ in found if i == q) == sorted(v for v in ids if v != q)[:20]
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.9, 0.1]), (3, [0.1, 0.8]), *[(10 + i, [0.2, 0.3]) for i in range(30)]]
    for order in (rows, rows[::-1]):
        x = spark.createDataFrame(order, "vec_id long, embedding array<double>").coalesce(1)
        got = ann.nearest(x, x.filter("vec_id = 1")).filter("rank = 1").collect()
        assert [(g["vec_id"], g["score"]) for g in got] == [(3, 0.8)]


def test_chi_square():
    assert abs(ann.chi2_cdf(15.507, 8) - 0.95) < 1e-4 and abs(ann.chi2_point(0.9, 8) - 13.3616) < 1e-3


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 30)] + [(5, 5)] + [(r.randrange(500, 600), r.randrange(500, 600)) for _ in range(60)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    parent = {v: v for e in edges for v in e}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for a, b in edges:
        parent[top(a)] = top(b)
    alone = {v for v in parent if v not in got}
    assert all(top(v) == v and sum(top(u) == v for u in parent) == 1 for v in alone)
    pairs = {(got[v], top(v)) for v in got}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sample_keeps_long_texts_and_one_row_of_an_id(spark):
    from pitframe.llm.learn import chosen_fold, labelled_sample
    ids = [i for i in range(60) if not chosen_fold(i)][:6]
    long = "word " * 40_000
    rows = [(ids[0], long), *[(ids[1], f"copy {k % 3}") for k in range(50)], *[(i, "x") for i in ids[2:]], (ids[2], None), (None, "none")]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)] + [(ids[3], None), (None, 1)], "doc_id long, toxic int")
    got, share = labelled_sample(docs, labels, "toxic", 100)
    found = {r["id"]: (r["text"], r["y"]) for r in got.collect()}
    assert got.count() == len(found) == 6 and share == {0: 1.0, 1: 1.0}
    assert found[ids[0]] == (long, 0) and found[ids[1]][0] in {"copy 0", "copy 1", "copy 2"}
    again = {r["id"]: (r["text"], r["y"]) for r in labelled_sample(docs.repartition(7), labels, "toxic", 100)[0].collect()}
    assert again == found
    assert labelled_sample(docs, labels.limit(0), "toxic", 100)[0].count() == 0


def test_toxicity_counts_every_labelled_text(spark):
    from pitframe.llm import toxicity as T

    ids = [i for i in range(12000) if not chosen_fold(i)]
    rare = [i for i in ids if zlib.crc32(f"fit {i}".encode()) % 5][:20 * T.MIN_DOCS]
    word = {i: f"rare{n % 20}x" for n, i in enumerate(rare)}
    docs = spark.createDataFrame([(i, f"plain {'bad' if i % 3 else 'good'} {word.get(i, '')}", "en") for i in ids], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in ids], "doc_id long, toxic int")
    model = T.train(docs, labels)
    assert all(model.lookup[T.buckets(w)].all() for w in set(word.values()))
    assert model.score("bad") > 0.9 > 0.1 > model.score("good")
