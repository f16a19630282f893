"""The pipeline's stages against brute force on the smallest tables."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_text_operators import water_filled

import corpus_pipeline as P
from pitframe.llm import simhash, toxicity
from pitframe.llm.common import stored
from pitframe.llm.tokens import library

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF))
        out.append(docs)
    return out


def test_stage_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "tokens"]
    assert all(tuple(x.columns) == P.COLUMNS for x in stages[1:-1])


def test_each_stage(spark, stages):
    rows = [x.collect() for x in stages]
    start, clean, single, pure, mixed, tokens = rows
    rejected = {x["id"] for x in toxicity.toxicity(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).collect() if x["rejected"]}
    assert sorted(x["doc_id"] for x in clean) == sorted(x["doc_id"] for x in start if x["doc_id"] not in rejected)

    prints = {x["doc_id"]: simhash.fingerprint(x["text"]) for x in clean}
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 2:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    assert sorted(x["doc_id"] for x in single) == sorted({top(i) for i in ids})

    items = [x[0] for x in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    grams = lambda t: {tuple(w[i:i + 5]) for w in [(t or "").encode().lower().split()] for i in range(len(w) - 4)}
    wanted = [grams(t) for t in items]
    dirty = lambda t: any(len(w & g) >= 0.8 * len(w) for g in [grams(t)] for w in wanted)
    assert sorted(x["doc_id"] for x in pure) == sorted(x["doc_id"] for x in single if not dirty(x["text"]))

    size = {x["doc_id"]: len((x["text"] or "").encode().split()) for x in pure}
    by_source, took = Counter(), Counter()
    source = {x["doc_id"]: x["source"] for x in pure}
    for d, n in size.items():
        by_source[source[d]] += n
    times = Counter(x["doc_id"] for x in mixed)
    assert max(times.values()) <= 2 and set(times) <= set(size)
    for d, n in times.items():
        took[source[d]] += n * size[d]
    largest = Counter()
    for d, n in size.items():
        largest[source[d]] = max(largest[source[d]], n)
    goal = water_filled(by_source)
    assert all(abs(took[s] - goal[s]) <= largest[s] / 2 + 1 for s in by_source)

    text = {x["doc_id"]: x["text"] for x in mixed}
    lib = library("word_bpe_49k.json")
    at = 0
    assert Counter(x["doc_id"] for x in tokens) == times
    for x in sorted(tokens, key=lambda x: x["start"]):
        own = [*lib.encode(text[x["doc_id"]] or "", add_special_tokens=False).ids, 2]
        assert (x["start"], x["n_tokens"], x["ids_crc32"]) == (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        at += len(own)
