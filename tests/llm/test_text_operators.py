"""Operators on texts against brute force, over a fixture of nulls, empty, long, tied and repeated rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from pitframe.llm import decontaminate, line_dedup, mixing, simhash, suffix_dedup, token_count, token_store
from pitframe.llm.common import ship, stored
from pitframe.llm.tokens import library

NAME = "word_bpe_49k.json"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, th long, fp long, n_tokens string"


def words(r, n, kinds=400):
    return [f"w{r.randrange(kinds)}" for _ in range(n)]


def fixture_rows():
    r = random.Random(5)
    texts = [None, "", "   \n ", "one", "one two", "ÀÉ It's Don't 'S <|endoftext|>x naïve ΑΣ 日本語 🙂", "a\x00b \x1c x\x85y　z é"]
    base = [" ".join(words(r, 90)) for _ in range(12)]
    texts += base
    texts += [base[0], base[0], base[1]]  # copies
    for b in base[:6]:  # near copies
        w = b.split()
        w[r.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [base[2][:300] + " " + base[3][50:], base[4] + "\n" + base[4], "x" * 900, ("lorem ipsum " * 40).strip()]
    texts.append("\n".join(" ".join(words(r, 12, 60)) for _ in range(3000)))  # very long
    line = "the committee shall meet on the first monday"
    texts += [f"{line}\nunder the\n{line}s", f"{line.replace('first', 'frist')}\n\n{line}\nunder the"]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["b", "a", "é", None]), len(t or ""), "clash", 1, 2, "x") for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, base[0], "en", "a", 1, None, None, None, None), (None, None, None, None, None, None, None, None, None), (9, "other text of an id", "en", "b", 5, "c", 1, 1, "y")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return fixture_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *cols):
    return sorted((tuple(x[c] for c in cols) for x in df.collect()), key=str)


def test_suffix_dedup_equals_brute_force(docs, rows, empty):
    for length, gram in ((200, 48), (64, 16)):
        texts = [(r[1] or "").encode() for r in rows]
        seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
        want = []
        for r, t in zip(rows, texts, strict=True):
            gone = np.zeros(len(t), bool)
            for p in range(len(t) - length + 1):
                if seen[t[p:p + length]] > 1:
                    gone[p:p + length] = True
            runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
            want.append((r[0], len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
        got = suffix_dedup.remove_repeats(docs, length=length, gram=gram)
        assert collected(got, "id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_over_buffers(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUFFER", 50)
    r = random.Random(3)
    texts = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 90))) for _ in range(40)] + [b"a" * 170]
    found = {}
    for raw, pieces in suffix_dedup.buffers(enumerate(texts), 20):
        begin, sizes = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
        anchor, lo, hi = suffix_dedup.anchor_runs(np.frombuffer(raw, np.uint8), np.repeat(begin + sizes, sizes), 20, 6)
        for a, first, last in zip(anchor.tolist(), lo.tolist(), hi.tolist(), strict=True):
            at, _, shift, text = pieces[int(np.searchsorted(begin, first, "right")) - 1]
            for p in range(first, last + 1):
                assert (text, p - at + shift) not in found
                found[text, p - at + shift] = a - p
    assert set(found) == {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 19)}
    offsets = {}
    for (i, p), off in found.items():
        assert offsets.setdefault(texts[i][p:p + 20], off) == off


def brute_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, near):
    parent = list(range(len(values)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                parent[top(i)] = top(j)
    return [top(i) for i in range(len(values))]


def test_simhash_equals_brute_force(docs, rows, empty):
    fps = [brute_fingerprint(r[1]) for r in rows]
    comp = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for r, c in zip(rows, comp, strict=True):
        least[c] = min([x for x in (least.get(c), r[0]) if x is not None], default=None)
    want = sorted(((r[0], f, least[c]) for r, f, c in zip(rows, fps, comp, strict=True)), key=str)
    got = [(x["id"], x["fp"] & (1 << 64) - 1, x["component"]) for x in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(comp))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


@pytest.mark.parametrize("bucket", [1, 4, 32])
def test_simhash_links_have_all_components(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "PAIR_BUCKET", bucket)
    r = random.Random(2)
    values = {0, (1 << 64) - 1}
    for _ in range(15):
        v = r.getrandbits(64)
        for _ in range(12):
            values.add(v)
            for b in r.sample(range(64), r.randint(1, 3)):
                v ^= 1 << b
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    from pitframe.llm.common import components
    links = stored(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")))
    for a, b in links.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    root = dict(components(links).collect())
    got = [root.get(v, v) for v in signed]
    want = brute_components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def brute_contained(text, item, threshold=0.8):
    w, v = (text or "").encode().lower().split(), (item or "").encode().lower().split()
    if not v:
        return None
    n = min(5, len(v))
    want = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)}
    have = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    return (len(want), len(want & have)) if len(want & have) >= threshold * len(want) - 1e-9 else None


@pytest.mark.parametrize("size", [1 << 19, 40])
def test_decontamination_equals_brute_force(spark, docs, rows, empty, monkeypatch, size):
    monkeypatch.setattr(decontaminate, "PASS", size)  # also over several passes
    long = rows[-10][1] if rows[-10][1] else rows[8][1]
    items = [(0, rows[8][1]), (1, " ".join(rows[9][1].split()[10:40])), (2, "ONE  two"), (3, None), (4, "absent words that no text has at all"), (5, " ".join([*rows[10][1].split()[:30], "tail", "words"])), (6, " ".join(long.split()[-25:])), (0, rows[8][1]), (7, "lorem ipsum lorem ipsum lorem ipsum")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, item in items:
        for r in rows:
            if (hit := brute_contained(r[1], item)) is not None:
                want.append((i, r[0], *hit))
    got = decontaminate.contained(docs, bench)
    assert collected(got, "item", "id", "n_shingles", "n_shared") == sorted(want, key=str) and want
    dirty = {id(r) for r in rows for _, item in items if brute_contained(r[1], item) is not None}
    left = decontaminate.without_items(docs, bench)
    assert left.schema == docs.schema and collected(left, *docs.columns) == sorted((r for r in rows if id(r) not in dirty), key=str)
    assert decontaminate.contained(empty, bench).count() == 0 and decontaminate.contained(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_items(docs, bench.limit(0)).count() == len(rows)


def water_filled(sizes, share=1.5, repeats=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full, out = share * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in names if s not in full]
        rest = total - sum(repeats * sizes[s] for s in full)
        out = {s: repeats * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in open_) for s in names}
        over = {s for s in open_ if out[s] > repeats * sizes[s]}
        if not over:
            return out
        full |= over


def test_mixing(docs, rows, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    want, taken = water_filled(sizes), Counter()
    for x in got:
        assert x["size"] >= 0 and 0 <= x["times"] <= 2 and x["source_size"] == sizes[x["source"]]
        assert math.isclose(x["target"], want[x["source"]], abs_tol=1e-6)
        taken[x["source"]] += x["size"] * x["times"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(len((r[1] or "").split()) for r in rows if r[3] == s)
    assert collected(mixing.mix(docs.repartition(7)), "id", "th", "times") == sorted(((x["id"], x["th"], x["times"]) for x in got), key=str)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns and out.count() == sum(x["times"] for x in got)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0


def test_budget_is_met_exactly_where_sums_allow():
    r = random.Random(1)
    for _ in range(60):
        n = sorted(r.sample(range(1, 60), 6))
        c = [r.randint(1, 5) for _ in n]
        budget = r.randint(0, 300)
        took = mixing.reachable(n, c, budget)
        sums = {0}
        for a, k in zip(n, c, strict=True):
            sums = {s + a * i for s in sums for i in range(k + 1)}
        assert abs(sum(a * k for a, k in took.items()) - budget) == min(abs(s - budget) for s in sums)
        assert all(took.get(a, 0) <= k for a, k in zip(n, c, strict=True))


def brute_ids(text):
    return library(NAME).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("shard", [1 << 20, 500])
def test_token_store_round_trip(spark, docs, rows, empty, shard):
    from pitframe.llm.common import shared_folder
    path = shared_folder(spark)
    token_store.write_tokens(docs, path, shard=shard)
    got = sorted((x["start"], x["id"], x["n_tokens"], x["ids_crc32"]) for x in token_store.read_documents(spark, path).collect())
    ids = [x[1] for x in got]
    assert [x for x in ids if x is not None] == sorted(x for x in ids if x is not None) and None not in ids[:-2]
    want = Counter((r[0], len(v := [*brute_ids(r[1]), 2]), zlib.crc32(np.array(v, "<u4").tobytes())) for r in rows)
    assert Counter((d, n, c) for _, d, n, c in got) == want
    assert [x[0] for x in got] == np.concatenate([[0], np.cumsum([x[2] for x in got])])[:-1].tolist()
    if shard == 1 << 20:
        flat = [t for x in got for r in [next(r for r in rows if r[0] == x[1] and zlib.crc32(np.array([*brute_ids(r[1]), 2], "<u4").tobytes()) == x[3])] for t in [*brute_ids(r[1]), 2]]
        places = [0, 5, 17, len(flat) // 2, len(flat) - 1]
        asked = spark.createDataFrame([(p,) for p in [*places, -1, len(flat), None]], "place long")
        assert collected(token_store.tokens_at(spark, path, asked), "place", "token") == sorted(((p, flat[p]) for p in places), key=str)
    assert token_store.token_digest(empty).count() == 0


@pytest.mark.parametrize("top", [200, 70_000, 1 << 31])
def test_codes_round_trip(top):
    r = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 20_000):
        ids = r.integers(0, top, n, dtype=np.uint32)
        codes = token_store.Codes(token_store.encode(ids))
        assert np.array_equal(codes.all(), ids)
        assert all(codes.get(int(i)) == ids[i] for i in r.integers(0, n, 50)) if n else codes.n == 0
        with pytest.raises(IndexError):
            codes.get(n)


@pytest.mark.parametrize("chunk", [1 << 16, 700])
def test_token_counts_equal_the_library(docs, rows, empty, chunk):
    want = sorted(((r[0], len((r[1] or "").encode()), len(brute_ids(r[1]))) for r in rows), key=str)
    assert collected(token_count.token_counts(docs, chunk=chunk), "id", "n_bytes", "n_tokens") == want
    assert token_count.token_counts(empty).count() == 0


def test_transducer_equals_the_library_on_odd_texts():
    count, r = token_count.counter(NAME), random.Random(4)
    alphabet = "aeinorst'.,!<|> \t\nÀßéŸÇ日🙂́İΣς½²µª0123xyzthing"
    for _ in range(1500):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
        n = len(brute_ids(t))
        assert sum(count.values(t)) == n, t
        k = r.randint(1, 9)
        assert token_count.scan([token_count.chunk_map(t[i:i + k], count) for i in range(0, max(len(t), 1), k)], count) == n, t


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def edited(r, s, n):
    s = list(s)
    for _ in range(n):
        k, p = r.randint(0, 2), r.randrange(max(len(s), 1))
        if k == 0:
            s.insert(p, r.choice("abc"))
        elif s and k == 1:
            s.pop(p)
        elif s:
            s[p] = r.choice("abc")
    return "".join(s)


def test_banded_distance():
    r = random.Random(1)
    for _ in range(5000):
        a = "".join(r.choice("abc") for _ in range(r.randint(0, 14)))
        b = edited(r, a, r.randint(0, 5))
        d = edit_distance(a, b)
        for t in (1, 2, 3):
            assert line_dedup.within(a, b, t) == (d if d <= t else None)


@pytest.mark.parametrize(("key", "block"), [(64, 2048), (2, 2048), (2, 3)])
def test_line_links_equal_brute_force(spark, monkeypatch, key, block):
    monkeypatch.setattr(line_dedup, "PAIR_KEY", key)  # also over the levels for hot keys, and in blocks
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    ship(spark)
    r = random.Random(8)
    base = ["".join(r.choice("abc") for _ in range(r.randint(20, 45))) for _ in range(12)]
    lines = sorted({edited(r, b, r.randint(0, 3)) for b in base for _ in range(6)} | set(base))
    lines = [v for v in lines if len(v) >= line_dedup.SHORTEST]
    docs = spark.createDataFrame([(i, "\n".join(lines[i::4] + ["short"] + lines[:2])) for i in range(4)], "doc_id long, text string")
    number = {xxhash.xxh64_intdigest(v.encode(), 42): v for v in lines}
    got = {frozenset((number[x["a"] & (1 << 64) - 1], number[x["b"] & (1 << 64) - 1])): x["edits"] for x in line_dedup.line_links(docs).collect()}
    want = {frozenset((a, b)): d for i, a in enumerate(lines) for b in lines[:i] if (d := edit_distance(a, b)) <= 2}
    assert got == want and len(want) > 50


def test_line_links_with_a_share_equal_brute_force(spark):
    ship(spark)
    r = random.Random(9)
    base = ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in (9, 10, 14, 19, 20, 21, 30, 47, 69, 70, 100, 135)]
    lines = sorted({edited(r, b, n) for b in base for n in (0, 1, len(b) // 20, len(b) // 10, len(b) // 10 + 1)})
    word = base[-1][:60] + "replaced" + base[-1][68:]  # one word of a long line
    docs = spark.createDataFrame([(i, "\n".join([*lines, word][i::3])) for i in range(3)], "doc_id long, text string")
    number = {xxhash.xxh64_intdigest(v.encode(), 42): v for v in [*lines, word]}
    got = {frozenset((number[x["a"] & (1 << 64) - 1], number[x["b"] & (1 << 64) - 1])): x["edits"] for x in line_dedup.line_links(docs, share=10).collect()}
    most = lambda n: max(n // 10, 2 if n >= 20 else 0)
    want = {frozenset((a, b)): d for i, a in enumerate([*lines, word]) for b in [*lines, word][:i] if (d := edit_distance(a, b)) <= most(min(len(a), len(b)))}
    assert got == want and max(want.values()) > 8 and any(len(a) < 20 for pair in want for a in pair)
    assert any(word in pair and 2 < d for pair, d in want.items())


def test_line_dedup_equals_brute_force(docs, rows, empty):
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42))))
    every = [(n, p, v) for n, r in enumerate(order) for p, v in enumerate((r[1] or "").split("\n")) if v.strip()]
    kinds = sorted({v for _, _, v in every}, key=len)
    near = lambda a, b: len(a) >= 20 and len(b) >= 20 and abs(len(a) - len(b)) <= 2 and line_dedup.within(a, b, 2) is not None
    short = [v for v in kinds if not v.startswith("w") or len(v) > 300]  # random word lines are far apart
    comp = {v: v for v in kinds}
    comp |= dict(zip(short, [short[c] for c in brute_components(short, near)], strict=True))
    seen, classes, want = set(), set(), Counter()
    for n, _, v in every:
        if v in seen:
            want[n, "exact"] += 1
        elif comp[v] in classes:
            want[n, "near"] += 1
        seen.add(v)
        classes.add(comp[v])
    got = line_dedup.dedup_lines(docs)
    expect = sorted(((r[0], (r[1] or "").count("\n") + 1, want[n, "exact"], want[n, "near"]) for n, r in enumerate(order)), key=str)
    assert collected(got, "id", "n_lines", "n_exact", "n_near") == expect
    assert all(len(x["removed"]) == x["n_exact"] + x["n_near"] for x in got.collect())
    assert line_dedup.dedup_lines(empty).count() == 0
