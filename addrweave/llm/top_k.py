"""Exact top-k inner products by block-at-a-time pruning.

Vectors are integers: floor(256 * x). Rows lie in blocks of consecutive ids; a block keeps the largest and smallest value of each dimension (its term
maxima) and its rows (the forward index). For each query blocks are ordered by the sum of term maxima, taking the smallest value where the query is
negative, and scored through the forward index until the next bound falls below the k-th score so far. Blocks that tie are scored, so ties
are exact. The k-th score starts from a bounded sample of rows, which can only be too low.

Queries go out in parts of at most ``PART`` (bounded broadcast); each task gives its own best k of each query, and these meet by query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.store import written

K, EVERY, SCALE = 5, 50, 256
BLOCK, PART, SAMPLE, TASK_ROWS = 128, 8192, 2048, 1 << 15


def vectors(table: DataFrame) -> DataFrame:
    """``vec_id`` and integer ``v``; rows with a null id, a null vector, or a null or non-finite component are left out."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return table.where(fine & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * SCALE).cast("double")).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` values; shorter vectors end in zeros."""
    sizes = np.diff(np.asarray(column.offsets, np.int64))
    flat = np.asarray(column.flatten(), np.float64)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search(q: np.ndarray, floor: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, block: int = BLOCK, own: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, scores and ids of each query's ``k`` best rows of at least its floor; rows with its ``own`` id are passed over before they take a place."""
    starts = np.arange(0, len(rows), block)
    high, low = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    orders = np.argsort(-bounds, axis=1, kind="stable")
    for i in range(len(q)):
        kth, got_s, got_i = floor[i], np.empty(0), np.empty(0, np.int64)
        step = 1
        at = 0
        while at < len(starts) and bounds[i, orders[i, at]] >= kth:
            some = orders[i, at : at + step]
            some = some[bounds[i, some] >= kth]
            place = np.concatenate([np.arange(starts[b], min(starts[b] + block, len(rows))) for b in some])
            s = rows[place] @ q[i]
            keep = s >= kth if own is None else (s >= kth) & (ids[place] != own[i])
            got_s, got_i = _best(np.concatenate([got_s, s[keep]]), np.concatenate([got_i, ids[place[keep]]]), k)
            if len(got_s) == k:
                kth = max(kth, got_s[-1])
            at += step
            step = min(step * 2, 64)
        yield i, got_s, got_i


def _searcher(shared, dims: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, q, floor = shared.value
        for batch in _joined(batches):
            ids, rows = np.asarray(batch.column("vec_id")), _matrix(batch.column("v").combine_chunks(), dims)
            order = np.argsort(ids, kind="stable")
            ids, rows = ids[order], rows[order]
            for lo in range(0, len(q), 512):
                out = [(np.full(len(i), query_ids[lo + n]), i, s) for n, s, i in search(q[lo : lo + 512], floor[lo : lo + 512], rows, ids, k, own=query_ids[lo : lo + 512])]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[c] for o in out]).astype(np.int64)) for c in range(3)], ["query_id", "vec_id", "score"])

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about ``TASK_ROWS`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= TASK_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def top_k(table: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """For each row of ``embeddings`` whose ``vec_id`` is divisible by ``every``: its ``k`` best other rows as ``query_id``, ``rank``, ``vec_id``, ``score``.

    Ties go to the smaller id; fewer rows where there are fewer candidates. Null ids, null vectors and vectors with a null or non-finite component
    take no part. Of repeated ids the rows are told apart by the vector; equal rows of one id count once, and a query's own id is no
    candidate. A shorter vector is filled up with zeros. No queries or an empty table give no rows. Scores are exact below 2**53.
    """
    spark = table.sparkSession
    rows = written(vectors(table).distinct(), "vectors")
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    result = "query_id long, rank int, vec_id long, score long"
    asked = rows.where(F.col("vec_id") % every == 0)
    parts = -(-asked.count() // PART)
    if not parts:
        return spark.createDataFrame([], result)
    share = SAMPLE / max(rows.count(), 1)
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < share * (1 << 20)).toArrow().combine_chunks()
    sample_ids, sampled = np.asarray(sample.column("vec_id").combine_chunks()) if sample.num_rows else np.empty(0, np.int64), _matrix(sample.column("v").combine_chunks(), dims) if sample.num_rows else np.empty((0, dims))
    found = None
    for p in range(parts):
        part = asked.where(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(parts)) == p).toArrow().combine_chunks()
        if not part.num_rows:
            continue
        ids, q = np.asarray(part.column("vec_id").combine_chunks()), _matrix(part.column("v").combine_chunks(), dims)
        floor = np.full(len(q), -np.inf)
        if len(sample_ids) > k:
            s = q @ sampled.T
            s[ids[:, None] == sample_ids[None, :]] = -np.inf
            floor = np.sort(s, axis=1)[:, -k]
        shared = spark.sparkContext.broadcast((ids, q, floor))
        one = rows.mapInArrow(_searcher(shared, dims, k), "query_id long, vec_id long, score long")
        found = one if found is None else found.unionByName(one)
    best = found.where("query_id != vec_id").groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "b")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.s")).alias("score"))
