"""Language model: base and backoff scores against dictionaries, probabilities that sum to 1, held-out gain."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from addrweave.llm import chunks
from addrweave.llm.language_model import BINS, scores


def brute(rows):
    """Score of every text, and P(w | h)."""
    texts = [(d, (t or "").encode().lower().split() + ["end"]) for d, t in rows]
    train = [w for d, w in texts if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(x for w in train for x in w)
    past = Counter(x for w in train for x in ["start", *w[:-1]])
    two = Counter(p for w in train for p in zip(["start", *w], w))
    n, v = sum(c.values()), len(c)
    place = lambda k: int(min(2 * math.log2(max(k, 1)), BINS - 1))
    total, once = np.zeros(BINS), np.zeros(BINS)
    for (h, _), k in two.items():
        total[place(past[h])] += k
        once[place(past[h])] += k == 1
    rest = [(once[k:].sum() / max(total[k:].sum(), 1)) for k in range(BINS)]
    b = [min(max(once[k] / total[k] if total[k] else rest[k], 0.001), 0.999) for k in range(BINS)]
    alone = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))

    def p(w, h):
        if not past[h]:
            return alone(w)
        return (1 - b[place(past[h])]) * two[h, w] / past[h] + b[place(past[h])] * alone(w)

    out = [(d or -1, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(alone(x)) for x in w), sum(math.log10(p(x, h)) for h, x in zip(["start", *w], w))) for d, w in texts]
    return sorted(out), p, c, past


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    follow = {w: rng.sample(range(60), 4) for w in range(60)}
    out = []
    for d in range(400):
        w, text = rng.randrange(60), []
        for _ in range(rng.randint(0, 80)):
            text.append(f"W{w}é" if rng.random() < 0.95 else f"rare{rng.randrange(500)}")
            w = rng.choice(follow[w])
        out.append((d, rng.choice([" ", "\n"]).join(text)))
    return out + [(1000, None), (1001, " "), (3, "w1é w2é"), (3, "w1é w2é"), (None, "w1é only here")]


def test_equals_dictionaries(spark, rows, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 5000)
    df = spark.createDataFrame([(d, t, True) for d, t in rows], "doc_id long, text string, train boolean").repartition(3)
    got = sorted(((r.doc_id or -1), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scores(df).collect())
    want = brute(rows)[0]
    assert [g[:4] for g in got] == [w[:4] for w in want] and np.allclose([g[4:] for g in got], [w[4:] for w in want])


def test_probabilities_sum_to_one(rows):
    _, p, c, past = brute(rows)
    for h in [*list(past)[:20], "start", "never seen"]:
        assert sum(p(w, h) for w in [*c, "unknown"]) == pytest.approx(1)


def test_held_out_gain_and_empty(spark, rows):
    got = scores(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert {d: bool(h) for d, h in zip(got.doc_id, got.held_out) if d == d} == {float(d): zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows if d is not None}
    held = got[got.held_out == True]  # noqa: E712
    assert held.score.sum() > held.base_score.sum() * 0.8
    assert scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []
