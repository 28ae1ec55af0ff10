"""Toxicity: the model against a dictionary version, held-out accuracy, odd inputs."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from addrweave.llm import toxicity as tox
from addrweave.llm.toxicity import toxicity


def plain_model(words_by_class):
    """Log-likelihood of a word under each class, written with dictionaries."""
    n, d = tox.ORDER, tox.DISCOUNT
    grams = [Counter(), Counter()]
    for c in (0, 1):
        for w in words_by_class[c]:
            s = b" " * (n - 1) + w + b" "
            grams[c].update(s[i : i + n] for i in range(len(w) + 1))
    seen = {g for c in grams for g in c}

    def shared(g):
        if not g:
            return 1 / 256
        ends = {x[-len(g) - 1 :] for x in seen}
        times = Counter(x[1:] for x in ends)
        total = sum(v for k, v in times.items() if k[:-1] == g[:-1])
        types = sum(k[:-1] == g[:-1] for k in times)
        if not total:
            return shared(g[1:])
        return max(times[g] - d, 0) / total + d * types / total * shared(g[1:])

    def value(w):
        s, out = b" " * (n - 1) + w + b" ", [0.0, 0.0]
        for c in (0, 1):
            for i in range(len(w) + 1):
                g = s[i : i + n]
                total = sum(v for k, v in grams[c].items() if k[:-1] == g[:-1])
                types = sum(k[:-1] == g[:-1] for k in grams[c])
                out[c] += math.log(max(grams[c][g] - d, 0) / total + d * types / total * shared(g[1:]) if total else shared(g[1:]))
        return out[1] - out[0]

    return value


def test_differences_equal_the_plain_model():
    by_class = [[b"good", b"goods", b"day", b"gold"], [b"bad", b"bald", b"good"]]
    grams = [Counter(), Counter()]
    for c in (0, 1):
        code, _ = tox._grams(by_class[c])
        grams[c].update(code.tolist())
    keys = np.array(sorted(set(grams[0]) | set(grams[1])), np.uint64)
    model = tox.fit(keys, *(np.array([float(g[int(k)]) for k in keys]) for g in grams))
    value, words = plain_model(by_class), [b"good", b"bad", b"golds", b"zzz", b"da"]
    assert np.allclose(model.words(words), [value(w) for w in words])


def test_held_out_accuracy(spark):
    """Toxic texts carry about 3% of words with a few stems and endings of their own, many of them met in no labelled text."""
    rng = random.Random(1)
    part = lambda n: "".join(rng.choice(["an", "er", "th", "in", "ou", "le", "st", "be"]) for _ in range(n))
    rows = []
    for d in range(1500):
        toxic = d % 8 == 0
        w = [part(rng.randint(1, 4)) for _ in range(rng.choice([30, 80, 300]))]
        for k in range(len(w)):
            if toxic and (k == 5 or rng.random() < 0.03):
                w[k] = rng.choice(["vequ", "lostra"]) + part(rng.randint(1, 2))
        rows.append((d, " ".join(w), int(toxic)))
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    out = toxicity(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), labels).join(labels, "doc_id").where("held_out").toPandas()
    hit = ((out.predicted == 1) & (out.toxic == 1)).sum()
    assert hit / (out.toxic == 1).sum() > 0.9 and hit / max((out.predicted == 1).sum(), 1) > 0.9


def test_odd_rows(spark):
    fold = lambda d: zlib.crc32(str(d).encode()) % 4
    rows = [(d, "vile vile words here" if d % 2 else "kind words are here", d % 2) for d in range(60)]
    docs = spark.createDataFrame([(d, t, "x", 0.1) for d, t, _ in rows] + [(1000, None, "", 0.0), (1001, "", None, None), (None, "vile", "", 0.0), (3, rows[3][1], "", 0.0), (1002, "vile " * 30000, "", 0.0)], "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(d, t) for d, _, t in rows] + [(None, 1), (5, None), (77777, 1)], "doc_id long, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (fold(r.doc_id) == 2) for r in got if r.doc_id is not None)
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score and by[1002].predicted == 1
    assert all(by[d].predicted == t for d, _, t in rows)
    assert toxicity(docs.limit(0), labels).collect() == [] and {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.5}
