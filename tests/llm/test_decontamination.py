"""Decontamination: retrieval and overlap against brute force."""

import math
import random
from collections import Counter

import pytest

from addrweave.llm import decontamination as dc
from addrweave.llm.decontamination import clean, contaminated


def words(t):
    return (t or "").encode().lower().split()


def grams(w):
    if len(w) < 10:
        n = min(5, len(w))
        whole = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        return whole, whole
    cut = -(-len(w) * 3 // 4) - 4
    return {tuple(w[i : i + 5]) for i in range(cut)}, {tuple(w[i : i + 5]) for i in range(cut, len(w) - 4)}


def brute(docs, items):
    segments = [(i, k, Counter(w[k : k + 64])) for i, t in items for w in [words(t)] for k in range(0, len(w), 64)]
    mean = sum(sum(c.values()) for *_, c in segments) / max(len(segments), 1)
    df = Counter(t for *_, c in segments for t in c)
    impact = []
    for i, _, c in segments:
        size = sum(c.values())
        x = {t: math.log1p((len(segments) - df[t] + 0.5) / (df[t] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / mean)) for t, n in c.items()}
        impact.append((i, {t: v / sum(x.values()) for t, v in x.items()}))
    out = {}
    for d, t in docs:
        w = words(t)
        have = {tuple(w[i : i + n]) for n in range(1, 6) for i in range(len(w) - n + 1)}
        for p in range(0, max(len(w), 1), 64):
            seen = set(w[p : p + 128])
            for i, x in impact:
                score = sum(v for k, v in x.items() if k in seen)
                q, a = grams(words(dict(items)[i]))
                if score >= 0.6 - 1e-9 and len(q & have) / len(q) >= 0.75 and len(a & have) / len(a) >= 0.5:
                    out[d, i] = max(out.get((d, i), 0), score)
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "and", *(f"w{i}" for i in range(300))])
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 7, 15, 40, 64, 150])))) for i in range(40)]
    docs = []
    for d in range(120):
        w = [word() for _ in range(rng.choice([5, 60, 300]))]
        if d % 3 == 0:
            part = rng.choice(items)[1].upper().split()
            if d % 2:
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(w))
            w[at:at] = part
        docs.append((d, " ".join(w)))
    return docs, items


def test_equals_brute_force(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(dc, "BLOCK_SEGMENTS", 4)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute(docs, items)
    assert len(want) > 30 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_shards_do_not_change_the_result(spark, tables, monkeypatch):
    docs, items = tables
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, contaminated(d, b).select("doc_id", "item_id").collect()))
    monkeypatch.setattr(dc, "SHARD_WORDS", 500)
    assert sorted(map(tuple, contaminated(d, b).select("doc_id", "item_id").collect())) == one


def test_odd_rows(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(1, None), (2, ""), (3, f"x {item} y"), (3, f"x {item} y"), (None, item), (4, "z " * 50000 + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (9, " "), (None, item)], "item_id long, text string")
    got = contaminated(docs, bench).collect()
    assert sorted(((r.doc_id or 0), (r.item_id or 0)) for r in got) == [(0, 7), (3, 7), (3, 7), (4, 7)]
    assert sorted((r.doc_id or 0) for r in clean(docs, bench).collect()) == [0, 1, 2]  # the null id stays
    assert contaminated(docs, bench.limit(0)).collect() == [] and contaminated(docs.limit(0), bench).collect() == []


def test_one_changed_word_at_every_place(spark):
    """An edited item with 75 % or more of its shingles left is found, whatever word changed; one with a foreign answer is not."""
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in (15, 16, 19, 23, 26, 38, 59)]
    docs, want = [], set()
    for i, t in items:
        for k in range(i):
            w = t.split()
            w[k] = "changed"
            docs.append((1000 * i + k, " ".join(["before", *w, "after"])))
            if sum(not j <= k < j + 5 for j in range(i - 4)) >= 0.75 * (i - 4):
                want.add((1000 * i + k, i))
    docs.append((1, " ".join([*items[-1][1].split()[:44], *(f"other{k}" for k in range(15))])))  # question without its answer: 40 of 55 shingles
    got = {(r.doc_id, r.item_id) for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), dc.WHOLE).collect()}
    assert len(want) > 130 and want <= got and not any(d == 1 for d, _ in got)


def test_a_rare_word_does_not_decide(spark):
    """The one word that tells items apart carries most of the BM25 score; without it the item is found by its shingles."""
    stem = [f"s{k}" for k in range(30)]
    items = [(i, " ".join([*stem, f"own{i}"])) for i in range(200)]
    docs = spark.createDataFrame([(1, " ".join([*stem, "changed"])), (2, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contaminated(docs, bench, dc.WHOLE).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, i) for i in range(200)} and all(r.score < dc.THRESHOLD for r in got)
