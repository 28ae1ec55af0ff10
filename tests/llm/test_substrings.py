"""Repeated passages against a plain reading of the rule."""

import hashlib
import random

import numpy as np

from addrweave.llm import chunks
from addrweave.llm.substrings import COVER, PERIOD, without_repetitions


def brute(rows):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            seq = tuple(w[i : i + 20])
            if seq in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(seq)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d or -1, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out)


def test_cover_holds_all_differences():
    assert all(any((i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER for d in range(PERIOD)) for i in range(PERIOD) for j in range(PERIOD))


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 3000)
    rng = random.Random(11)
    word = lambda: rng.choice(["a", "B", "b", "éé", *(f"w{i}" for i in range(40))])
    passages = [[word() for _ in range(rng.choice([19, 20, 21, 35, 80]))] for _ in range(8)]
    rows = []
    for d in range(150):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.5 else [word() for _ in range(rng.randint(1, 40))]
        rows.append((d * 3, rng.choice([" ", "\n", "  ", "\t"]).join(w)))
    rows += [(7, "x " * 3000), (8, None), (10, ""), (11, " \n"), (30, rows[10][1]), (13, "y\x1cz " * 25), (None, " ".join(passages[0] + passages[1]))]
    df = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, kept string").repartition(7)
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in without_repetitions(df).collect()) == brute(rows)
    assert without_repetitions(df.limit(0)).collect() == []


def test_keys_survive_packing():
    rng = np.random.default_rng(2)
    for n in (1, 2, 1000):
        keys = np.unique(np.concatenate([rng.integers(0, 2**64, n, np.uint64), np.array([0, 2**64 - 1], np.uint64)]))
        assert (chunks._unpack_keys(chunks._pack_keys(keys)) == keys).all()
    same = np.array([5, 5, 9], np.uint64)  # one half of 128-bit keys may repeat
    assert (chunks._unpack_keys(chunks._pack_keys(same)) == same).all()
