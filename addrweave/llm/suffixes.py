"""Removal of repeated byte strings: suffixes sorted a bucket at a time, long ties by cover-sample ranks.

Only suffixes down to ``LENGTH`` bytes matter, and only those that can tie. Two equal strings of ``LENGTH`` bytes have an offset below ``PERIOD`` at which both
stand on a cover position (every difference modulo ``PERIOD`` lies between two members of ``COVER``), so the cover samples are ranked first:

1. The ``ANCHOR`` bytes at each cover position. A sample alone in its bucket's order has no tie; suffixes without a shared sample in their first
   ``PERIOD`` bytes are unique and go no further.
2. Shared samples again, to ``LONG`` bytes. Where such a sample ties, all ``PERIOD`` suffixes that start in it tie to ``LENGTH`` bytes: long repeats are
   settled by one sample in ``PERIOD`` bytes, without sorting their suffixes.
3. What is left (the edges of repeats, and short ones) is sorted by its own ``LENGTH`` bytes, together with what it may tie with: each home says at which shared
   samples it has such suffixes, and all suffixes at these samples are sorted, also settled ones.

A bucket is a range of the order, small enough for one task and sorted alone; the order is that of 128-bit fingerprints (in 1, where more ties
cost only work, of as many bits as the corpus needs), as the bytes of all suffixes of a bucket together would be 200 times the text. Every *home*,
at most ``HOME_BYTES`` of text but for a longer document, asks about its distinct keys once, and is told which of them other homes have too.

Homes are rows of a bucketed table, a bucket for each input task: their text is written once where it is read, and no later step moves it. Only keys and
answers are shuffled.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.chunks import ASKED, BUCKET_KEYS, CHUNK_BYTES, pack, questions, told, unpack
from addrweave.llm.chunks import _unpack_keys as unpacked_keys
from addrweave.llm.store import texts, written
from addrweave.llm.words import bytes_of, hash_spans
from addrweave.session import checkpoint_dir

LENGTH = 200
PERIOD, COVER = 73, (0, 1, 3, 7, 15, 31, 36, 54, 63)
ANCHOR, LONG = LENGTH - PERIOD + 1, LENGTH + PERIOD - 1
SPARE_BITS = 8  # of a sample's key beyond what numbers all samples: one in 256 ties by chance
SEGMENT = 1 << 17
HOME_BYTES = 16 << 20
HOMES = 20  # bits for the homes of a task
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


# ---- homes


def _housed(places: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, held, size = places[TaskContext.get().partitionId() % len(places)], TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([pack(pa.Table.from_batches(held))], pa.binary())], ["place", "number", "size", "data"])

        for batch in batches:
            sizes = np.diff(bytes_of(batch.column("text"))[1])
            lo = 0
            while lo < batch.num_rows:
                hi = min(batch.num_rows, lo + 1 + int(np.searchsorted(np.cumsum(sizes[lo:]), CHUNK_BYTES - size)))
                held.append(batch.slice(lo, hi - lo))
                size += int(sizes[lo:hi].sum())
                if size >= CHUNK_BYTES:
                    yield flush()
                    number, held, size = number + 1, [], 0
                lo = hi
        if held:
            yield flush()

    return run


def housed(docs: DataFrame) -> DataFrame:
    """``place``, ``number``, ``size``, ``data`` (compressed documents): a table bucketed by ``place`` in the shared folder, one place an input task.

    A place's number is chosen so that it falls into the bucket of its task, so each task writes one file and all buckets fill alike.
    """
    spark, rows = docs.sparkSession, texts(docs)
    n = max(rows.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = spark.range(n * (20 + n.bit_length())).select(F.col("id").cast("int").alias("id"))
    by_bucket = {r["b"]: r["id"] for r in ids.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("b")).agg(F.min("id").alias("id")).collect()}
    name = f"homes_{uuid.uuid4().hex}"
    out = rows.mapInArrow(_housed([by_bucket.get(b, b) for b in range(n)]), "place int, number long, size long, data binary")
    out.write.option("path", f"{checkpoint_dir(spark)}/{name}").bucketBy(n, "place").saveAsTable(name)
    return spark.table(name)


def at_home(table: DataFrame, rows: DataFrame | None, run: Callable, schema: str) -> DataFrame:
    """``run(home, chunks, rows)`` for each home, one after the other in its place, with the rows that came back to it."""
    if rows is None:
        rows = table.sparkSession.createDataFrame([], TOLD)

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("number")
        place, sizes = left.column("place")[0].as_py(), left.column("size").to_numpy()
        of, out = (np.cumsum(sizes) - sizes) // HOME_BYTES, []
        for k in np.unique(of).tolist():
            home, lo, hi = place << HOMES | k, int(np.searchsorted(of, k)), int(np.searchsorted(of, k, "right"))
            out.append(run(home, _Chunks(left.column("data").slice(lo, hi - lo)), right.filter(pc.equal(right.column("home"), home))))
        return pa.concat_tables(out)

    return table.select("place", "number", "size", "data").groupBy("place").cogroup(rows.groupBy("place")).applyInArrow(both, schema)


TOLD = "place int, home long, bucket long, answer binary, kind int"


def answered(asked: DataFrame, rule: Callable, extra: str | None = None) -> DataFrame:
    """Answers of all buckets (kind 0), and the homes' notes (kind 1), which pass through beside them: written, so questions are shuffled once and kept nowhere."""

    def run(rows: pa.Table) -> pa.Table:
        bucket, expand, squeeze = rows.column("bucket")[0].as_py(), zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        homes = rows.column("chunk")
        places = pc.shift_right(homes, HOMES).cast(pa.int32())
        if bucket < 0:
            numbers = [int.from_bytes(n.as_py(), "big") for n in rows.column("extra")]
            return pa.table([places, homes, pa.array(numbers, pa.int64()), rows.column("keys"), pa.array([1] * len(numbers), pa.int32())], ["place", "home", "bucket", "answer", "kind"])
        keys = [unpacked_keys(k.as_py()) for k in rows.column("keys")]
        more = np.concatenate([np.frombuffer(expand(x.as_py()), extra) for x in rows.column("extra")]) if extra else None
        said, ends = rule(np.concatenate(keys), more), np.cumsum([len(k) for k in keys])
        out = [squeeze(said[e - len(k) : e].tobytes()) for k, e in zip(keys, ends.tolist(), strict=True)]
        return pa.table([places, homes, pa.array([bucket] * len(out), pa.int64()), pa.array(out, pa.binary()), pa.array([0] * len(out), pa.int32())], ["place", "home", "bucket", "answer", "kind"])

    return written(asked.groupBy("bucket").applyInArrow(run, TOLD), "answers")


class _Chunks:
    """A home's chunks, each unpacked when its turn comes."""

    def __init__(self, data: pa.ChunkedArray) -> None:
        self.data = data

    def __iter__(self) -> Iterator[_Chunk]:
        for d in self.data:
            yield _Chunk(unpack(d.as_py()))


def _state(home: int, number: int, masks: list[np.ndarray]) -> pa.Table:
    """Masks over a chunk's bytes, as a row beside the questions (bucket below 0, one a place)."""
    bits = b"".join(np.packbits(m).tobytes() for m in masks)
    return pa.table([pa.array([-1 - (home >> HOMES)], pa.int32()), pa.array([home], pa.int64()), pa.array([zstandard.ZstdCompressor(level=1).compress(bits)], pa.binary()), pa.array([number.to_bytes(8, "big")], pa.binary())], ["bucket", "chunk", "keys", "extra"])


class _Noted:
    """The masks of a home's chunks, each unpacked when its turn comes."""

    def __init__(self, rows: pa.Table, count: int) -> None:
        self.rows, self.count = rows.filter(pc.equal(rows.column("kind"), 1)).sort_by("bucket").column("answer"), count

    def __iter__(self) -> Iterator[np.ndarray]:
        for raw in self.rows:
            bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw.as_py()), np.uint8)
            yield np.unpackbits(bits.reshape(self.count, -1), axis=1).view(bool)


# ---- keys


class _Chunk:
    def __init__(self, docs: pa.RecordBatch) -> None:
        self.docs = docs
        self.buf, self.offsets = bytes_of(docs.column("text"))
        self.sizes = np.diff(self.offsets)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions with ``ANCHOR`` bytes after them in documents of ``LENGTH`` bytes and more, and the samples' hashes."""
        pattern = np.flatnonzero(np.resize(_IN_COVER, max(int(self.sizes.max(initial=0)), 1)))
        ends = np.searchsorted(pattern, self.sizes - ANCHOR, "right")
        places = [pattern[:e] + o for e, o, n in zip(ends.tolist(), self.offsets.tolist(), self.sizes.tolist(), strict=False) if n >= LENGTH]
        at = np.concatenate(places) if places else np.empty(0, np.int64)
        return at, hash_spans(self.buf, at, at + ANCHOR)

    def between(self, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """Mask of places in any of the ranges [low, high) that hold a string of ``LENGTH`` bytes of their document."""
        n = len(self.buf)
        highs = np.minimum(highs, self.offsets[np.searchsorted(self.offsets, lows, "right")] - LENGTH + 1)
        good = highs > lows
        steps = np.zeros(n + 1, np.int8)  # at most PERIOD ranges overlap
        np.add.at(steps, lows[good], 1)
        np.subtract.at(steps, highs[good], 1)
        return np.cumsum(steps, dtype=np.int8)[:n] > 0

    def around(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of strings that hold one of the anchors at an offset below ``PERIOD``."""
        first = self.offsets[np.searchsorted(self.offsets, anchors, "right") - 1]
        return self.between(np.maximum(anchors - PERIOD + 1, first), anchors + 1)

    def long(self, anchors: np.ndarray) -> np.ndarray:
        """Those of the anchors with ``LONG`` bytes of their document after them."""
        return anchors[anchors + LONG <= self.offsets[np.searchsorted(self.offsets, anchors, "right")]]

    def near(self, anchors: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Of each anchor: whether ``mask`` holds at one of the starts that have it at an offset below ``PERIOD``."""
        first = self.offsets[np.searchsorted(self.offsets, anchors, "right") - 1]
        total = np.zeros(len(mask) + 1, np.int32)
        np.cumsum(mask, out=total[1:])
        return total[anchors + 1] > total[np.maximum(anchors - PERIOD + 1, first)]

    def fingerprints(self, at: np.ndarray, size: int) -> np.ndarray:
        """128 bits of ``size`` bytes from each place, as two columns."""
        raw, digest, out = self.buf.tobytes(), xxhash.xxh3_128_digest, np.empty((len(at), 2), np.uint64)
        for lo in range(0, len(at), SEGMENT):
            some = b"".join([digest(raw[i : i + size]) for i in at[lo : lo + SEGMENT].tolist()])
            out[lo : lo + SEGMENT] = np.frombuffer(some, ">u8").reshape(-1, 2)
        return out


@dataclass
class _Distinct:
    """Keys of a home in order, each once (``of``: the key of each row), and whether they occur more than once in it."""

    high: np.ndarray
    low: np.ndarray | None
    of: np.ndarray
    twice: np.ndarray


def _distinct(keys: list[np.ndarray]) -> _Distinct:
    """Of rows of one or two columns."""
    k = np.concatenate(keys) if keys else np.empty((0, 2), np.uint64)
    keys.clear()
    high, low = (k[:, 0], k[:, 1]) if k.ndim == 2 else (k, None)
    order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
    high, low = high[order], low[order] if low is not None else None
    new = np.ones(len(high), bool)
    new[1:] = high[1:] != high[:-1]
    if low is not None:
        new[1:] |= low[1:] != low[:-1]
    of = np.empty(len(high), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return _Distinct(high[new], low[new] if low is not None else None, of, np.bincount(of, minlength=int(new.sum())) > 1)


def _ties(d: _Distinct, elsewhere: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """For each row, by chunk: whether its key occurs anywhere else."""
    again = (d.twice | elsewhere)[d.of] if len(d.of) else np.empty(0, bool)
    return np.split(again, np.cumsum(sizes)[:-1]) if sizes else []


def _elsewhere(keys: np.ndarray, low: np.ndarray | None) -> np.ndarray:
    """Rule of a bucket: sort it, and mark the keys that several homes have (each asks about a key once)."""
    order = np.argsort(keys, kind="stable") if low is None else np.lexsort((low, keys))
    same = keys[order][1:] == keys[order][:-1]
    if low is not None:
        same &= low[order][1:] == low[order][:-1]
    tie, out = np.zeros(len(keys), bool), np.empty(len(keys), bool)
    tie[1:] |= same
    tie[:-1] |= same
    out[order] = tie
    return out


def _any_wants(keys: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Rule of a bucket: sort it, and mark the keys that any home has marked."""
    _, of = np.unique(keys, return_inverse=True)
    return np.bincount(of, marked, minlength=1)[of] > 0


def _buckets(keys: float) -> int:
    return 1 << max(3, math.ceil(math.log2(max(keys / BUCKET_KEYS, 1))))


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>, kept binary"


def _spans(c: _Chunk, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal removed runs of bytes and the document of each, from the mask of repeated strings' starts."""
    at = np.flatnonzero(starts)
    doc = np.searchsorted(c.offsets, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] > at[:-1] + LENGTH) | (doc[1:] != doc[:-1])
    last = np.ones(len(at), bool)
    last[:-1] = new[1:]
    return at[new], at[last] + LENGTH, doc[new]


def _cut(c: _Chunk, starts: np.ndarray, with_text: bool) -> pa.Table:
    lows, highs, doc = _spans(c, starts)
    first = np.searchsorted(doc, np.arange(len(c.sizes) + 1)).tolist()
    raw, rows = c.buf.tobytes(), []
    lows, highs = lows.tolist(), highs.tolist()
    for k, (doc_id, lo, hi) in enumerate(zip(c.docs.column("doc_id").to_pylist(), c.offsets[:-1].tolist(), c.offsets[1:].tolist(), strict=True)):
        a, b = first[k], first[k + 1]
        edges = [lo, *[x for pair in zip(lows[a:b], highs[a:b], strict=True) for x in pair], hi]
        kept = b"".join([raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)])
        spans = [{"start": x - lo, "end": y - lo} for x, y in zip(lows[a:b], highs[a:b], strict=True)]
        rows.append((doc_id, hi - lo, hi - lo - len(kept), b - a, hashlib.sha256(kept).hexdigest(), spans if with_text else None, kept if with_text else None))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def without_repeated_bytes(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Each document's UTF-8 bytes without those covered by a 200-byte string that also starts anywhere else, in this or another document.

    Strings are judged on the input, so all copies of a repeat go; overlapping occurrences count. Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs), ``kept_sha256``, and with ``with_text`` the ``spans`` and the ``kept`` bytes (a cut may fall inside a character).

    Null and empty texts have no bytes, texts below 200 bytes keep all. Rows of one ``doc_id`` and equal rows are documents of their own, so equal ones
    of 200 bytes lose everything. Null ids stay null. An empty table gives no rows. Further columns are ignored. A text is never split:
    one of many MB is a chunk of its own.
    """
    table = housed(docs)
    total = table.agg(F.sum("size")).first()[0] or 0
    samples = total * len(COVER) / PERIOD
    drop = np.uint64(max(0, 64 - SPARE_BITS - math.ceil(math.log2(max(samples, 2)))))

    def sampled(chunks: _Chunks) -> tuple[list[np.ndarray], _Distinct]:
        places, keys = [], []
        for c in chunks:
            at, k = c.anchors()
            places.append(at.astype(np.int32))
            keys.append(k >> drop << drop)
        return places, _distinct(keys)

    def ask_samples(home, chunks, rows):
        return questions(home, sampled(chunks)[1].high, None, _buckets(samples))

    shared = answered(at_home(table, None, ask_samples, ASKED), _elsewhere)

    def ask_long(home, chunks, rows):
        places, keys = sampled(chunks)
        ties = _ties(keys, told(rows, 0, "bool"), [len(p) for p in places])
        del keys
        out, prints = [], []
        for number, (c, all_at, tie) in enumerate(zip(chunks, places, ties, strict=True)):
            at = np.sort(all_at[tie]).astype(np.int64)
            held = np.zeros(len(c.buf), bool)
            held[at] = True
            out.append(_state(home, number, [c.around(at), held]))
            prints.append(c.fingerprints(c.long(at), LONG))
        d = _distinct(prints)
        return pa.concat_tables([*out, questions(home, d.high, d.low, _buckets(samples / 4))])

    long_shared = answered(at_home(table, shared, ask_long, ASKED), _elsewhere, "u8")

    def ask_wanted(home, chunks, rows):
        noted = _Noted(rows, 2)
        places = [c.long(np.flatnonzero(held[: len(c.buf)])) for c, (_, held) in zip(chunks, noted, strict=True)]
        d = _distinct([c.fingerprints(at, LONG) for c, at in zip(chunks, places, strict=True)])
        ties = _ties(d, told(rows, 0, "bool"), [len(p) for p in places])
        out, prints, wants = [], [], []
        for number, (c, (candidates, held), at, tie) in enumerate(zip(chunks, noted, places, ties, strict=True)):
            candidates, at_sample = candidates[: len(c.buf)], np.flatnonzero(held)
            settled = c.between(at[tie], at[tie] + PERIOD)
            out.append(_state(home, number, [candidates, held[: len(c.buf)], settled]))
            prints.append(c.fingerprints(at_sample, ANCHOR)[:, 0])
            wants.append(c.near(at_sample, candidates & ~settled))
        d = _distinct(prints)
        wanted = np.bincount(d.of, np.concatenate(wants) if wants else None, minlength=len(d.high)) > 0
        return pa.concat_tables([*out, questions(home, d.high, wanted, _buckets(samples / 4))])

    wanted_anywhere = answered(at_home(table, long_shared, ask_wanted, ASKED), _any_wants, "bool")

    def ask_rest(home, chunks, rows):
        noted = _Noted(rows, 3)
        places = [np.flatnonzero(held) for _, held, _ in noted]
        d = _distinct([c.fingerprints(at, ANCHOR)[:, 0] for c, at in zip(chunks, places, strict=True)])
        told_wanted = told(rows, 0, "bool")
        out, prints, lo = [], [], 0
        for number, (c, (candidates, _, settled), at) in enumerate(zip(chunks, noted, places, strict=True)):
            mine = told_wanted[d.of[lo : lo + len(at)]]
            lo += len(at)
            candidates, settled = candidates[: len(c.buf)], settled[: len(c.buf)]
            sort = candidates & (c.around(at[mine]) | ~settled)
            out.append(_state(home, number, [settled, sort]))
            prints.append(c.fingerprints(np.flatnonzero(sort), LENGTH))
        d = _distinct(prints)
        return pa.concat_tables([*out, questions(home, d.high, d.low, _buckets(samples / 2))])

    rest_shared = answered(at_home(table, wanted_anywhere, ask_rest, ASKED), _elsewhere, "u8")

    def finish(home, chunks, rows):
        noted = _Noted(rows, 2)
        places = [np.flatnonzero(left).astype(np.int32) for _, left in noted]
        d = _distinct([c.fingerprints(at, LENGTH) for c, at in zip(chunks, places, strict=True)])
        out = []
        for c, (settled, _), at, tie in zip(chunks, noted, places, _ties(d, told(rows, 0, "bool"), [len(p) for p in places]), strict=True):
            settled[at[tie]] = True
            out.append(_cut(c, settled[: len(c.buf)], with_text))
        return pa.concat_tables(out)

    return at_home(table, rest_shared, finish, _RESULT)
