"""Components against dense linear algebra."""

import math

import numpy as np

from addrweave.llm.whitening import bidiagonalise, whitened


def plain(vectors, components=4):
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    dims = max(map(len, x))
    x = [v + [0] * (dims - len(v)) for v in x]
    once = sorted(set(map(tuple, x)))
    n, sums = len(once), [sum(c) for c in zip(*once, strict=True)]
    centred = np.array(once, float) - np.array(sums) / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1].T
    out = {}
    for k in range(min(components, dims)):
        if e[k] > 1e-9 * e[0]:
            out[k + 1] = [(np.array(v) - np.array(sums) / n) @ axes[k] / math.sqrt(e[k]) for v in x]
    return n, [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x], out, e / e.sum()


def compare(got, vectors):
    n, deviation, white, share = plain(vectors)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(by) == len(got) == len(vectors) * len(white)
    for k, want in white.items():
        mine = np.array([by[i, k].whitened for i in range(len(vectors))])
        sign = np.sign(mine @ np.array(want))
        assert np.abs(sign * mine - want).max() < 1e-9
        assert abs(by[0, k].explained / share[k - 1] - 1) < 1e-9
    assert all(by[i, 1].deviation == deviation[i] and by[i, 1].n == n for i in range(len(vectors)))
    assert all(r.identity_error < 1e-9 for r in got)


def test_equals_dense_algebra(spark):
    rng = np.random.default_rng(4)
    scales = np.array([3.0, 2.0, 1.5, 1.0, 0.9, 0.5, 0.3, 0.1])
    vectors = [list(map(float, v)) for v in rng.standard_normal((400, 8)) * scales + 2]
    vectors += [vectors[7], vectors[7], [0.5] * 3]
    rows = [(i, v, "k") for i, v in enumerate(vectors)] + [(900, None, "k"), (901, [1.0, None] + [0.0] * 6, "k"), (902, [math.nan] * 8, "k"), (903, [math.inf] * 8, "k")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string").repartition(5)
    compare(whitened(df).collect(), vectors)


def test_few_and_equal_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitened(spark.createDataFrame([(1, []), (2, None)], schema)).collect() == []
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    line = [[float(i), 2.0 * i, 0.0] for i in range(5)]  # one direction only
    compare(whitened(spark.createDataFrame(list(enumerate(line)), schema)).collect(), line)


def test_whole_numbers_of_any_size(spark):
    vectors = [[1e9, 0.0], [-1e9, 1.0], [5e8, 3.0]]
    got = whitened(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).where("component = 1").collect()
    n, deviation, white, _ = plain(vectors)
    assert {r.vec_id: (r.n, r.deviation) for r in got} == {i: (n, d) for i, d in enumerate(deviation)}
    assert all(abs(abs(r.whitened) - abs(white[1][r.vec_id])) < 1e-9 for r in got)


def test_repeated_eigenvalues():
    x = np.diag([3.0, 3.0, 3.0, 1.0, 0.0])

    def product(w, earlier):
        u = x @ w
        return x.T @ u, earlier.T @ (x.T @ u), float(u @ u)

    right, b = bidiagonalise(product, 5)
    assert np.abs(right.T @ right - np.eye(5)).max() < 1e-12
    assert np.allclose(np.linalg.svd(b)[1], [3, 3, 3, 1, 0], atol=1e-9)
