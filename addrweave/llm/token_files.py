"""Token ids of all documents as files of Simple-8b blocks, in ascending order of ``doc_id``, and their reading.

Files are range-partitioned by ``doc_id``; Spark's committer writes them to the given folder as Parquet rows of one block each (``part``, ``block``,
``start`` within the part, ``n_ids``, ``payload``), so a lost task leaves nothing behind and any store serves.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.simple8b import Block
from addrweave.llm.store import texts, written
from addrweave.llm.tokens import encoded

END, BLOCK_IDS = 2, 1 << 18
FILES = "part int, block int, start long, n_ids long, payload binary"


def _write(path: str, end: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block, start, held, size = 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            docs, sizes, ids = zip(*held, strict=True)
            payload = Block([d for some in docs for d in some.to_pylist()], np.concatenate(sizes), np.concatenate(ids)).dumps()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())], ["part", "block", "start", "n_ids", "payload"])

        for batch in batches:
            for doc_id, sizes, ids in encoded(path, batch, end):
                ends, lo, at = np.cumsum(sizes), 0, 0
                while lo < len(sizes):
                    hi = int(np.searchsorted(ends, at + BLOCK_IDS - size)) + 1  # after the document that fills the block
                    full, hi = hi <= len(sizes), min(hi, len(sizes))
                    to = int(ends[hi - 1])
                    held.append((doc_id.slice(lo, hi - lo), sizes[lo:hi], ids[at:to]))
                    size, lo, at = size + to - at, hi, to
                    if full:
                        yield flush()
                        block, start, held, size = block + 1, start + size, [], 0
        if held:
            yield flush()

    return write


def write_tokens(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """Writes the ids of every text and ``end``; returns the files as a table.

    ``path`` is a tokenizer's file. Null text is empty; null ids come first; rows of one id follow each other in order of their text.
    """
    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(_write(path, end), FILES), "tokens")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, payload in zip(batch.column("start").to_pylist(), batch.column("payload"), strict=True):
            block = Block.loads(payload.as_py())
            raw, ends = memoryview(block.ids.astype("<u4").tobytes()), np.cumsum(block.sizes)
            starts = ends - block.sizes
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids, pa.int64()), pa.array(starts + base), pa.array(block.sizes), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(files: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` from the files.

    The parts' totals, a row for each file, go through the driver to be summed up.
    """
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    if not totals:
        return files.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    bases = np.cumsum([0, *(r.n for r in totals)]).tolist()
    base = files.sparkSession.createDataFrame([(r.part, b) for r, b in zip(totals, bases, strict=False)], "part int, base long")
    return files.join(F.broadcast(base), "part").select((F.col("start") + F.col("base")).alias("start"), "payload").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
