"""Near duplicates against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from addrweave.llm import near_duplicates as nd
from addrweave.llm.components import components
from addrweave.llm.near_duplicates import near_duplicates


def sets(rows):
    out = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        out[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def brute(rows):
    s = sets(rows)
    up = {d: d for d in s}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for a in s:
        for b in s:
            same = len(s[a] & s[b])
            if a < b and same and 100 * same >= 75 * len(s[a] | s[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(s[d]), root(d), root(d) == d) for d in s}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeÉ") for _ in range(5))
    out = []
    for g in range(12):
        base = [word() for _ in range(rng.choice([3, 5, 12, 60, 200]))]
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                w[rng.randrange(len(w))] = word()
            out.append(" ".join(w).upper() if rng.random() < 0.2 else " \n".join(w))
    out += ["", " \t ", None, None, "one two", "ONE two", "x " * 5000, "x " * 4000]
    ids = rng.sample(range(1000), len(out))
    return list(zip(ids, out, strict=True))


def test_groups_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], "doc_id long, text string, key string, n long")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()}
    assert got == brute(rows)


def test_hot_group_blocks(spark, monkeypatch):
    """A chain of near copies larger than a block: neighbours are linked, the ends are not."""
    monkeypatch.setattr(nd, "MEMBERS", 4)
    rows = [(k, " ".join(f"w{i}" for i in range(3 * k, 3 * k + 60))) for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_null_ids_repeats_and_empty_table(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
    got = sorted(near_duplicates(spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (7, "a b c d e f")], schema)).collect(), key=str)
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (4, 4, True), (4, 4, True), (7, 4, False)]


def test_chunk_keys_meet_within_the_distance():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 2**16, nd.ALL).astype(np.uint16)
        b = a.copy()
        at = rng.choice(nd.CHUNKS * nd.SYMBOLS, nd.DISTANCE, replace=False)
        b[at] ^= 1
        shared = set(nd.chunk_keys(a[None])[0]) & set(nd.chunk_keys(b[None])[0])
        assert nd.first_key(a[None], b[None])[0] in {k >> 48 for k in shared}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101), (101, 100), (5, 5), (None, 3)], "x long, y long")
    assert {r.node: r.component for r in components(edges).collect()} == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def test_sift_keeps_unlucky_pairs_that_met():
    """26 of the first 48 symbols apart, or 100 of all 256, may still be a similarity of 0.75."""
    a = np.zeros((2, nd.ALL), np.uint16)
    b = a.copy()
    b[0, :26], b[1, 40:140] = 1, 1
    assert nd.close(a, np.array([80, 80]), b, np.array([80, 80])).all()


def test_equal_short_hashes_lose_no_pair():
    """Six of eight shingles are shared (0.75); two of the shared ones have one 32-bit hash."""
    short = [np.array([1, 3, 4, 5, 6, x], np.uint32).tobytes() for x in (7, 8)]
    sign = [np.zeros(nd.ALL, np.uint16).tobytes()] * 2
    rows = pa.table({"key": [0, 0], "i": [0, 0], "j": [0, 0], "rep": [1, 2], "component": [1, 2], "n": [7, 7], "sign": sign, "short": short, "side": [2, 2]})
    assert [(x, y) for b in nd._across(iter(rows.to_batches())) for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist(), strict=True)] == [(1, 2)]
