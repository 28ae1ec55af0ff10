"""Packing of documents into sequences by a grouping genetic algorithm on islands.

Pieces are dealt by hash into shards of about ``SHARD`` pieces. A shard where best fit does not reach the bound of its total length is evolved on ``ISLANDS`` islands (tasks): a chromosome is a set of bins;
crossover injects whole well-filled bins of one parent into the other, drops the bins that hold an injected piece and best-fits the displaced pieces. After
an epoch each island's elite moves to the next island and evolution goes on there; a shard that has reached the bound rests. What the shards leave in badly filled bins is dealt and packed anew, over fewer shards each time, until one shard is left or none is saved.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.store import texts, written
from addrweave.llm.tokens import encoded

CAPACITY, END = 2048, 0
SHARD, ISLANDS, EPOCHS = 8192, 3, 2
POPULATION, GENERATIONS, ELITE = 4, 6, 1
TASKS = 10_000
FULL = 0.98  #: bins filled less are packed anew with those of other shards

Bins = list[list[int]]


class Packer:
    """Bins over the pieces of one shard, given by their lengths."""

    def __init__(self, lengths: list[int], capacity: int, seed: int) -> None:
        self.lengths, self.capacity, self.rng = lengths, capacity, random.Random(seed)
        self.bound = -(-sum(lengths) // capacity)

    def load(self, one: list[int]) -> int:
        return sum(map(self.lengths.__getitem__, one))

    def best_fit(self, bins: Bins, items: list[int]) -> Bins:
        """Puts items, in their order, where the least room remains; a new bin where none has room."""
        by_room: dict[int, list[list[int]]] = {}
        rooms = 0  # bit r: some bin has room r
        for one in bins:
            room = self.capacity - self.load(one)
            by_room.setdefault(room, []).append(one)
            rooms |= 1 << room
        for k in items:
            need = self.lengths[k]
            fit = rooms >> need
            if fit:
                room = need + (fit & -fit).bit_length() - 1
                same = by_room[room]
                one = same.pop()
                if not same:
                    rooms ^= 1 << room
            else:
                room, one = self.capacity, []
                bins.append(one)
            one.append(k)
            room -= need
            by_room.setdefault(room, []).append(one)
            rooms |= 1 << room
        return bins

    def first(self, shaken: float) -> Bins:
        """Best fit by falling length, with each length shaken by up to that share."""
        key = [n * (1 + shaken * (self.rng.random() - 0.5)) for n in self.lengths]
        return self.best_fit([], sorted(range(len(key)), key=key.__getitem__, reverse=True))

    def cross(self, mother: Bins, father: Bins) -> Bins:
        """Father's best bins, mother's bins that share no piece with them, and the displaced pieces by best fit."""
        filled = sorted(father, key=self.load, reverse=True)
        whole = filled[: max(1, len(filled) // 2)]
        injected = [list(one) for one in self.rng.sample(whole, max(1, len(whole) // 2))]
        taken = {k for one in injected for k in one}
        kept, loose = injected, []
        for one in mother:
            if taken.isdisjoint(one):
                kept.append(list(one))
            else:
                loose += [k for k in one if k not in taken]
        return self.shake(self.best_fit(kept, sorted(loose, key=self.lengths.__getitem__, reverse=True)))

    def shake(self, bins: Bins) -> Bins:
        """Dissolves the emptiest bins and a few others, and best-fits their pieces."""
        bins = sorted(bins, key=self.load)
        cut = max(1, len(bins) // 50)
        out, bins = bins[:cut], bins[cut:]
        self.rng.shuffle(bins)
        out, bins = out + bins[:cut], bins[cut:]
        return self.best_fit(bins, sorted((k for one in out for k in one), key=self.lengths.__getitem__, reverse=True))

    def fitness(self, bins: Bins) -> tuple[int, float]:
        """Fewer bins first, then more uneven ones."""
        return len(bins), -sum(self.load(one) ** 2 for one in bins)

    def evolve(self, migrants: list[Bins]) -> list[Bins]:
        """The fittest chromosomes after some generations; at once when one meets the bound."""
        people = [*migrants]
        for k in range(POPULATION if not migrants else 1):
            if any(len(p) <= self.bound for p in people):
                break
            people.append(self.first(0.1 * k if not migrants else 0.2))
        for _ in range(GENERATIONS):
            people.sort(key=self.fitness)
            if len(people[0]) <= self.bound or len(people) < 2:
                break
            people = people[:POPULATION]
            people += [self.cross(*self.rng.sample(people, 2)) for _ in range(POPULATION // 2)]
        return sorted(people, key=self.fitness)[:ELITE]


def _bin_of(bins: Bins, n: int) -> list[int]:
    out = [0] * n
    for number, one in enumerate(bins):
        for k in one:
            out[k] = number
    return out


def _bins(bin_of: list[int]) -> Bins:
    bins: Bins = [[] for _ in range(max(bin_of, default=-1) + 1)]
    for k, number in enumerate(bin_of):
        bins[number].append(k)
    return bins


def _epoch(capacity: int, epoch: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, island, lengths, migrants in zip(*(batch.column(c).to_pylist() for c in ("shard", "island", "lengths", "migrants")), strict=True):
                packer = Packer(lengths, capacity, seed=shard * 1000 + island * 10 + epoch)
                elite = packer.evolve([_bins(m) for m in migrants])
                yield pa.RecordBatch.from_arrays([pa.array([x] * len(elite), t) for x, t in ((shard, pa.int64()), (island, pa.int32()))] + [pa.array([len(e) for e in elite], pa.int32()), pa.array([_bin_of(e, len(lengths)) for e in elite], pa.list_(pa.int32()))], ["shard", "island", "bins", "bin_of"])

    return run


def _first(capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lengths in zip(batch.column("shard"), batch.column("lengths"), strict=True):
                packer = Packer(lengths.as_py(), capacity, seed=0)
                bins = packer.first(0.0)
                yield pa.RecordBatch.from_arrays([pa.array([shard.as_py()], pa.int64()), pa.array([_bin_of(bins, len(packer.lengths))], pa.list_(pa.int32())), pa.array([len(bins) <= packer.bound])], ["shard", "bin_of", "rests"])

    return run


def _evolved(shards: DataFrame, count: int, capacity: int) -> DataFrame:
    """Best chromosome of each of ``count`` shards (``shard``, ``lengths``) as ``bin_of``.

    Best fit, with which every island begins, comes once a shard; only shards where it misses the bound go to the islands, a task each, as far as ``TASKS`` go.
    """
    result, places = "shard long, island int, bins int, bin_of array<int>", F.sequence(F.lit(0), F.lit(ISLANDS - 1))
    fitted = written(shards.select("shard", "lengths").repartition(min(count, TASKS), "shard").mapInArrow(_first(capacity), "shard long, bin_of array<int>, rests boolean"), "fitted")
    resting, left = fitted.where("rests").select("shard", "bin_of"), fitted.where("not rests").select("shard")
    count = left.count()
    if not count:
        return resting
    islands = shards.join(left, "shard").select("shard", "lengths", F.explode(places).alias("island"))
    elite = None
    for epoch in range(EPOCHS):
        if elite is None:
            start = islands.withColumn("migrants", F.array().cast("array<array<int>>"))
        else:
            moved = elite.unionByName(elite.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS))))
            start = islands.join(moved.groupBy("shard", "island").agg(F.sort_array(F.collect_list("bin_of")).alias("migrants")), ["shard", "island"])
        elite = written(start.repartition(min(count * ISLANDS, TASKS), "shard", "island").mapInArrow(_epoch(capacity, epoch), result), "elite")
    return resting.unionByName(elite.groupBy("shard").agg(F.min(F.struct("bins", "island", "bin_of")).alias("best")).select("shard", "best.bin_of"))


_DEALT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, load long"


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the pieces of each shard with sequence, place there and the sequence's load."""
    for batch in batches:
        for k in range(batch.num_rows):
            items = batch.column("items").slice(k, 1).flatten()
            bin_of = np.asarray(batch.column("bin_of").slice(k, 1).flatten(), np.int64)
            col = {f.name: items.field(i) for i, f in enumerate(items.type)}
            length = np.asarray(col["length"], np.int64)
            order = np.argsort(bin_of, kind="stable")
            end = np.cumsum(length[order])
            first = np.searchsorted(bin_of[order], bin_of[order])
            offset = np.empty_like(length)
            offset[order] = end - length[order] - (end - length[order])[first]
            load = np.bincount(bin_of, weights=length).astype(np.int64)[bin_of]
            base = batch.column("base")[k].as_py()
            yield pa.RecordBatch.from_arrays([col["doc_id"], col["piece"], col["start"], col["length"], col["ids_crc32"], pa.array(base + bin_of), pa.array(offset), pa.array(load)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "load"])


def _round(pieces: DataFrame, shards: int, level: int, capacity: int) -> DataFrame:
    item = F.struct("length", "doc_id", "piece", "start", "ids_crc32")
    table = pieces.groupBy(F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(shards)).alias("shard")).agg(F.sort_array(F.collect_list(item), asc=False).alias("items"))
    table = written(table, "shards")
    best = _evolved(table.select("shard", F.col("items.length").cast("array<int>").alias("lengths")), shards, capacity)
    both = table.join(best, "shard").select("items", "bin_of", (F.lit(level << 52) + F.col("shard") * F.lit(1 << 20)).cast("long").alias("base"))
    return written(both.mapInArrow(_dealt, _DEALT), "dealt")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (``doc_id``, ``piece``, ``start``, ``length`` of 1 to ``capacity``, ``ids_crc32``) with ``sequence_id`` and ``offset``."""
    pieces, done, level, before = written(pieces.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces"), None, 0, None
    while True:
        count = pieces.count()
        shards = max(1, -(-count // SHARD))
        now = _round(pieces, shards, level, capacity)
        used = now.agg(F.countDistinct("sequence_id")).first()[0]
        last = shards == 1 or used == before or level >= 1000
        kept = now if last else now.where(F.col("load") >= FULL * capacity)
        done = kept if done is None else done.unionByName(kept)
        if last:
            return done.drop("load")
        pieces = now.where(F.col("load") < FULL * capacity)
        before = pieces.agg(F.countDistinct("sequence_id")).first()[0]
        level += 1


def _cut(path: str, capacity: int, end: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, sizes, ids in encoded(path, batch, end):
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = ((sizes - 1) % capacity + 1)[doc]
                start, length = np.where(piece, first + (piece - 1) * capacity, 0), np.where(piece, capacity, first)
                raw, at = memoryview(ids).cast("B"), 4 * ((np.cumsum(sizes) - sizes)[doc] + start)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([doc_id.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    return texts(docs).mapInArrow(_cut(path, capacity, end), "doc_id long, piece int, start long, length long, ids_crc32 long")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` tokens.

    ``path`` is a tokenizer's file. Each document is its ids and then ``end``; one that is longer than ``capacity`` is cut from its end into
    full pieces, so its first piece may be shorter. Returns ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``;
    places in a sequence have no gaps. Null and empty texts are one piece of the end id. Repeated rows and null ids are packed like any
    others. An empty table gives an empty result.
    """
    return pack(pieces_of(docs, path, capacity, end), capacity)
