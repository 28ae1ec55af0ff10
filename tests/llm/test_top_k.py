"""Exact top-k against brute force."""

import math
import random

import pytest

from addrweave.llm import top_k as tk
from addrweave.llm.top_k import top_k


def brute(rows, k=5, every=50):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine.setdefault((i, tuple(math.floor(256 * x) for x in v)), None)
    out = set()
    for q, a in fine:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in fine if c != q)[:k]
            out |= {(q, rank, c, -s) for rank, (s, c) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize(("count", "part"), [(700, 8192), (700, 5), (3, 8192)])
def test_equals_brute_force(spark, monkeypatch, count, part):
    monkeypatch.setattr(tk, "PART", part)
    monkeypatch.setattr(tk, "SAMPLE", 100)
    rng = random.Random(count)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(count)]
    rows += [(5000 + i, [0.1] * 6) for i in range(60)] + [(5000, [0.1] * 6), (7000, None), (7050, [None] * 6), (7100, [math.nan] * 6), (7150, [math.inf] + [0.0] * 5), (None, [1.0] * 6), (7200, [0.3, 0.2])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(5)
    assert {tuple(r) for r in top_k(df).collect()} == brute(rows)


def test_blocks_are_pruned_and_ties_kept():
    import numpy as np

    rows = np.vstack([np.full((40, 4), 1.0), np.full((40, 4), 9.0), np.full((40, 4), -3.0)])
    (_, s, i), = tk.search(np.ones((1, 4)), np.array([-np.inf]), rows, np.arange(120), 5, block=8)
    assert s.tolist() == [36.0] * 5 and i.tolist() == [40, 41, 42, 43, 44]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df).collect() == [] and top_k(spark.createDataFrame([(7, [1.0])], "vec_id long, embedding array<float>")).collect() == []


def test_many_rows_of_a_query_id_take_no_places(spark):
    """Eight vectors under id 0 score highest for each other; they take no places. As in the SQL, the rows of one query id are ranked together."""
    rows = [(0, [100.0 + i, 0.0]) for i in range(8)] + [(i, [float(i), 1.0]) for i in range(1, 9)]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("query_id = 0").orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(8, 256 * (100 + i) * 256 * 8) for i in range(7, 2, -1)]
