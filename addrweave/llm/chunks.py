"""Questions from chunks of documents to hash buckets and back.

Documents are stored as a table of chunks of about ``CHUNK_BYTES`` of text, one compressed row each. A chunk asks about its distinct keys (64-bit
hashes, sorted): one row a bucket of keys. A bucket sees each key at most once per chunk, however often it occurs, and answers every chunk about its
keys in their order. Questions and answers are arrays of bytes, so the shuffles carry few and dense rows, and no key can make a
bucket large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.store import texts, written

CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 1 << 20
ASKED = "bucket int, chunk long, keys binary, extra binary"
ANSWERED = "chunk long, bucket int, answer binary"


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(raw: bytes) -> pa.RecordBatch:
    """The chunk's documents (``doc_id``, ``text``) as one batch."""
    return pa.ipc.open_stream(raw).read_all().combine_chunks().to_batches()[0]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part << 32 | number], pa.int64()), pa.array([size], pa.int64()), pa.array([pack(pa.Table.from_batches(held))], pa.binary())], ["chunk", "size", "data"])

    for batch in batches:
        ends = np.cumsum(np.asarray(batch.column("size")))
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = min(batch.num_rows, int(np.searchsorted(ends, before + CHUNK_BYTES - size, "right")) + 1)
            held.append(batch.select(["doc_id", "text"]).slice(lo, hi - lo))
            size += int(ends[hi - 1]) - before
            if size >= CHUNK_BYTES:
                yield flush()
                number, held, size = number + 1, [], 0
            lo = hi
    if held:
        yield flush()


def chunked(docs: DataFrame, ordered: bool) -> DataFrame:
    """``chunk``, ``size``, ``data``: a written table. ``ordered``: chunks follow each other in order of ``doc_id`` (then text), as do their rows."""
    rows = texts(docs)
    if ordered:
        rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = rows.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    return written(rows.mapInArrow(_gather, "chunk long, size long, data binary"), "chunks")


def bucket_count(table: DataFrame, keys_per_byte: float) -> int:
    """A power of two that leaves a bucket about ``BUCKET_KEYS`` keys."""
    total = table.agg(F.sum("size")).first()[0] or 0
    return 1 << max(3, int(np.ceil(np.log2(max(total * keys_per_byte / BUCKET_KEYS, 1)))))


def by_bucket(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """Bucket, first and end of the sorted keys."""
    if not len(keys):
        return []
    cuts = np.searchsorted(keys, np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - buckets.bit_length() + 1))
    edges = [0, *cuts.tolist(), len(keys)]
    return [(b, edges[b], edges[b + 1]) for b in range(buckets) if edges[b] < edges[b + 1]]


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of equal weight: the upper ones are zeros, which compress away."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_keys(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def questions(chunk: int, keys: np.ndarray, extra: np.ndarray | None, buckets: int) -> pa.Table:
    """Rows of a chunk's sorted keys; ``extra``: what belongs to each key."""
    cut = by_bucket(keys, buckets)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    more = [squeeze(extra[a:b].tobytes()) if extra is not None else b"" for _, a, b in cut]
    return pa.table([pa.array([b for b, *_ in cut], pa.int32()), pa.array([chunk] * len(cut), pa.int64()), pa.array([_pack_keys(keys[a:b]) for _, a, b in cut], pa.binary()), pa.array(more, pa.binary())], ["bucket", "chunk", "keys", "extra"])


def answer(asked: DataFrame, rule: Callable, extra: str | None = None, stats: int = 0) -> DataFrame:
    """Answers of all buckets, written.

    ``rule(keys, which, chunks, extra)`` gets all keys of a bucket, the number of the chunk of each (``chunks`` is sorted), and returns
    an array for all keys and an array of ``stats`` sums, which comes as a row with chunk -1.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        expand = zstandard.ZstdDecompressor().decompress
        keys = [_unpack_keys(k.as_py()) for k in rows.column("keys")]
        more = np.concatenate([np.frombuffer(expand(x.as_py()), extra) for x in rows.column("extra")]) if extra else None
        chunks = rows.column("chunk").to_numpy()
        which = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        said, sums = rule(np.concatenate(keys), which, chunks, more)
        squeeze, ends = zstandard.ZstdCompressor(level=1).compress, np.cumsum([len(k) for k in keys])
        out = [squeeze(said[b - len(k) : b].tobytes()) for k, b in zip(keys, ends.tolist(), strict=True)]
        bucket = rows.column("bucket")[0].as_py()
        extra_row = [np.asarray(sums, np.float64).tobytes()] if stats else []
        return pa.table([pa.array([*chunks.tolist(), *[-1] * len(extra_row)], pa.int64()), pa.array([bucket] * (len(out) + len(extra_row)), pa.int32()), pa.array(out + extra_row, pa.binary())], ["chunk", "bucket", "answer"])

    return written(asked.groupBy("bucket").applyInArrow(run, ANSWERED), "answers")


def totals(answers: DataFrame, stats: int) -> np.ndarray:
    """Sums over the buckets' statistics: one row a task goes to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(stats)
        for batch in batches:
            for raw in batch.column("answer"):
                total += np.frombuffer(raw.as_py(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["total"])

    rows = answers.where("chunk = -1").select("answer").mapInArrow(add, "total array<double>")
    return np.array([x or 0.0 for x in rows.agg(*[F.sum(F.col("total")[k]) for k in range(stats)]).first()])


def told(rows: pa.Table, kind: int, dtype: str) -> np.ndarray:
    """A chunk's answers of one kind, in order of its sorted keys."""
    mine = rows.filter(pc.equal(rows.column("kind"), kind)).sort_by("bucket")
    expand = zstandard.ZstdDecompressor().decompress
    parts = [np.frombuffer(expand(x.as_py()), dtype) for x in mine.column("answer")]
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def with_answers(table: DataFrame, answers: list[DataFrame], run: Callable, schema: str) -> DataFrame:
    """``run(chunk, documents, rows)`` for each chunk with the rows of all answers to it (``kind``: number in the list)."""
    rows = None
    for kind, one in enumerate(answers):
        one = one.where("chunk >= 0").select("chunk", "bucket", "answer", F.lit(kind).alias("kind"))
        rows = one if rows is None else rows.unionByName(one)

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        return run(left.column("chunk")[0].as_py(), unpack(left.column("data")[0].as_py()), right)

    return table.select("chunk", "data").groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInArrow(both, schema)


def each(table: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run(chunk, documents)`` for each chunk, where it lies."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("data"), strict=True):
                yield from run(chunk, unpack(data.as_py())).to_batches()

    return table.select("chunk", "data").mapInArrow(go, schema)
