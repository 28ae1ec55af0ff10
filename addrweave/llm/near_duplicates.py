"""Near-duplicate documents: b-bit MinHash signatures and a multi-index Hamming join.

A signature has ``CHUNKS * SYMBOLS`` symbols of 16 bits. Two signatures that differ in at most ``DISTANCE`` symbols have, by the
pigeonhole, one of ``CHUNKS`` chunks with at most ``DISTANCE // CHUNKS`` (one) differing symbol. Each document files every chunk once per
symbol left out, so such a pair meets under an equal key for certain; most pairs that differ in more do too. At a similarity of exactly 0.75
(12 of 48 symbols differ on average) a pair meets under no key with probability 1.0e-7. Pairs that meet are sifted on ``ALL`` symbols:
more than 105 of 256 differ with probability 6.7e-09 where 64 are expected. Both rates fall as the similarity grows.

Links are confirmed on full shingle sets. Equal sets are one class; a key's members are not paired with each other: they are
linked to the key's smallest and largest class first, and only members that still lie in different components afterwards are compared, in
blocks of bounded size, by signature and by shingle hashes; a block gives links that join components, so no more than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.components import components
from addrweave.llm.store import texts, written
from addrweave.llm.words import blocks, mix, shingle_sets

SHINGLE, PERCENT = 5, 75
CHUNKS, SYMBOLS, DISTANCE = 12, 4, 23
ALL, ALL_DISTANCE = 256, 105
MEMBERS = 1024  #: members of a key that one block holds
_K = CHUNKS * SYMBOLS
_FACTORS = (mix(np.arange(ALL, dtype=np.uint64), 1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_MASKS = (mix(np.arange(ALL, dtype=np.uint64), 2) >> np.uint64(32)).astype(np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the smallest of each of the permuted shingle values."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(ALL, 2**32 - 1, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(short), 512):
            part = (short[None, i : i + 512] ^ _MASKS[:, None]) * _FACTORS[:, None]
            part ^= part >> np.uint32(15)
            low = np.minimum(low, (part * np.uint32(0x2C1B3C6D)).min(1))
        return (mix(low.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offsets in blocks(batch):
            n, high, low, signs = [], [], [], []
            for s in shingle_sets(buf, offsets, SHINGLE):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    high.append(int(mix(s, 3).sum(dtype=np.uint64).astype(np.int64)))
                    low.append(int(mix(s, 4).sum(dtype=np.uint64).astype(np.int64)))
                signs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(signs, pa.binary())], ["doc_id", "n", "high", "low", "sign"])


def _signs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, ALL)


def close(a: np.ndarray, m: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether signatures and set sizes (rows) allow a similarity that is high enough."""
    return ((a != b).sum(1) <= ALL_DISTANCE) & (100 * np.minimum(m, n) >= PERCENT * np.maximum(m, n))


def chunk_keys(signs: np.ndarray) -> np.ndarray:
    """Keys of each signature (rows): for each chunk and each symbol left out, the other symbols with both numbers."""
    chunks = signs[:, :_K].reshape(-1, CHUNKS, SYMBOLS).astype(np.int64)
    keys = []
    for left in range(SYMBOLS):
        key = np.arange(CHUNKS, dtype=np.int64)[None, :] * SYMBOLS + left
        for k in range(SYMBOLS):
            if k != left:
                key = key << 16 | chunks[:, :, k]
        keys.append(np.broadcast_to(key, chunks.shape[:2]))
    return np.concatenate(keys, axis=1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = chunk_keys(_signs(batch.column("sign").to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(np.asarray(batch.column("rep")), keys.shape[1]))], ["key", "rep"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs whose full shingle sets are similar enough."""
    last, seen = None, None
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            x, y, tx = part.column("x").to_pylist(), part.column("y").to_pylist(), part.column("text_x").to_pylist()
            kept = []
            sets = [s for _, _, buf, offsets in blocks(part, "text_y") for s in shingle_sets(buf, offsets, SHINGLE)]
            for i, b in enumerate(sets):
                if seen is None or tx[i] != last:
                    raw = np.frombuffer(tx[i].encode(), np.uint8)
                    last, seen = tx[i], shingle_sets(raw, np.array([0, len(raw)]), SHINGLE)[0]
                same = len(np.intersect1d(seen, b, assume_unique=True))
                if 100 * same >= PERCENT * (len(seen) + len(b) - same) and same:
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in kept], pa.int64()), pa.array([y[i] for i in kept], pa.int64())], ["x", "y"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            col = {c: batch.column(c) for c in batch.schema.names}
            keep = close(_signs(col["sign_x"].to_pylist()), np.asarray(col["n_x"]), _signs(col["sign_y"].to_pylist()), np.asarray(col["n_y"]))
            yield batch.select(["x", "y"]).filter(pa.array(keep))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``pairs`` (``x``, ``y``) that keep the signature distance and whose full sets are similar enough.

    ``docs`` holds the texts of candidates only; a hot document is a skewed join key, which Spark splits.
    """
    of = lambda c: classes.select(F.col("rep").alias(c), F.col("sign").alias(f"sign_{c}"), F.col("n").alias(f"n_{c}"))
    near = written(pairs.join(of("x"), "x").join(of("y"), "y").select("x", "y", "sign_x", "sign_y", "n_x", "n_y").mapInArrow(_near, "x long, y long").distinct(), "near-pairs")
    of = lambda c: docs.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    return written(near.join(of("y"), "y").join(of("x"), "x").select("x", "y", "text_x", "text_y").mapInArrow(_similar, "x long, y long").distinct(), "links")


def first_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of the first key that the signatures (rows) share, -1 where there is none."""
    apart = (a[:, :_K] != b[:, :_K]).reshape(-1, CHUNKS, SYMBOLS)
    few = apart.sum(2) <= DISTANCE // CHUNKS
    chunk = few.argmax(1)
    rows = np.arange(len(a))
    return np.where(few[rows, chunk], chunk * SYMBOLS + apart[rows, chunk].argmax(1), -1)


def _short_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of 32-bit shingle hashes; links are confirmed on full sets afterwards."""
    for batch in batches:
        for lo, hi, buf, offsets in blocks(batch):
            sets = [np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in shingle_sets(buf, offsets, SHINGLE)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(sets, pa.binary())], ["rep", "short"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within one block pair of a key (rows come together) that lie in different components and may be similar.

    A pair that meets under several keys is looked at under the first one only, and given if it joins components that no other given pair of
    the block joins. Equal 32-bit hashes within a set are made up for by the full sets' sizes, so no similar pair is lost to them; a pair that equal
    hashes across sets might have lifted over the limit is given but joins nothing. At most two blocks of members are held.
    """
    held: list[pa.RecordBatch] = []

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        col = {c: rows.column(c).to_numpy() for c in ("key", "i", "j", "rep", "component", "n", "side")}
        sign, short = _signs(rows.column("sign").to_pylist()), [np.frombuffer(x.as_py(), np.uint32) for x in rows.column("short")]
        edge = np.flatnonzero((np.diff(col["key"]) != 0) | (np.diff(col["i"]) != 0) | (np.diff(col["j"]) != 0)) + 1
        out: list[tuple[int, int]] = []
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), rows.num_rows], strict=True):
            side, place = col["side"][lo:hi], np.arange(lo, hi)
            left, right = place[side != 1], place[side != 0]
            up: dict[int, int] = {}

            def root(c: int, up: dict[int, int] = up) -> int:
                while up.get(c, c) != c:
                    c = up[c]
                return c

            for at in range(0, len(left), 128):
                x = left[at : at + 128]
                far = col["component"][x][:, None] != col["component"][right][None, :]
                if side[0] == 2:
                    far &= col["rep"][x][:, None] < col["rep"][right][None, :]
                small, large = np.minimum(col["n"][x][:, None], col["n"][right][None, :]), np.maximum(col["n"][x][:, None], col["n"][right][None, :])
                a, b = np.nonzero(far & (100 * small >= PERCENT * large))
                for k in range(0, len(a), 4096):
                    p, q = x[a[k : k + 4096]], right[b[k : k + 4096]]
                    mine = first_key(sign[p], sign[q]) == col["key"][lo] >> 16 * (SYMBOLS - 1)
                    p, q = p[mine], q[mine]
                    near = close(sign[p], col["n"][p], sign[q], col["n"][q])
                    for i, j in zip(p[near].tolist(), q[near].tolist(), strict=True):
                        one, two = root(int(col["component"][i])), root(int(col["component"][j]))
                        if one != two:
                            m, n = int(col["n"][i]), int(col["n"][j])
                            same = len(np.intersect1d(short[i], short[j], assume_unique=True))
                            most = same + min(m - len(short[i]), n - len(short[j]))
                            if (100 + PERCENT) * most >= PERCENT * (m + n):
                                least = same - (1 + (m * n >> 27) if m * n >= 4096 else 0)
                                if (100 + PERCENT) * least >= PERCENT * (m + n):
                                    up[max(one, two)] = min(one, two)
                                out.append((min(col["rep"][i], col["rep"][j]), max(col["rep"][i], col["rep"][j])))
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], ["x", "y"])

    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            group = lambda b, k: tuple(b.column(c)[k].as_py() for c in ("key", "i", "j"))
            if held and group(held[-1], held[-1].num_rows - 1) != group(part, 0):
                yield pairs(pa.Table.from_batches(held))
                held = []
            last, key = part.num_rows - 1, group(part, part.num_rows - 1)
            while last > 0 and group(part, last - 1) == key:
                last -= 1
            if last > 0:
                yield pairs(pa.Table.from_batches([*held, part.slice(0, last)]))
                held = []
            held.append(part.slice(last))
    if held:
        yield pairs(pa.Table.from_batches(held))


def _residual(live: DataFrame, classes: DataFrame, links: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs of members that share a key, still lie in different components and look similar on 32-bit shingle hashes."""
    labels = components(links)
    placed = written(live.select("key", "rep").join(labels, live.rep == labels.node, "left").select("key", "rep", F.coalesce("component", "rep").alias("component")), "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low != high")
    mixed = mixed.select("key", F.ceil(F.col("size") / MEMBERS).cast("int").alias("parts"))
    placed = written(placed.join(mixed, "key"), "mixed")
    short = docs.mapInArrow(_short_sets, "rep long, short binary")
    member = placed.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    member = member.join(classes.select("rep", "n", "sign").join(short, "rep"), "rep")
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    member = member.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "rep", "component", "n", "sign", "short",
                           F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"))
    return member.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_across, "x long, y long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Near-duplicate groups of ``docs`` (``doc_id``, ``text``; other columns are ignored), one row per input row.

    Returns ``doc_id``, ``n_shingles`` (distinct lower-cased five-word shingles; the whole sequence where a text is shorter), ``component_id``
    (smallest document reachable over links of similarity 0.75 or more) and ``kept``.

    Null or wordless text: no shingles, linked with nothing, kept. Null ``doc_id``: never linked, ``component_id`` null, kept. Rows with
    one ``doc_id`` are one document: they share its component and its ``kept``. An empty table gives an empty result.
    """
    docs = texts(docs)
    info = written(docs.mapInArrow(_describe, "doc_id long, n long, high long, low long, sign binary"), "signatures")
    classes = written(info.where("n > 0 and doc_id is not null").groupBy("high", "low", "n").agg(F.min("doc_id").alias("rep"), F.max("sign").alias("sign")), "classes")
    keys = classes.select("rep", "sign").mapInArrow(_keys, "key long, rep long")
    ends = keys.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low != high")
    live = written(keys.join(ends, "key"), "keys")
    docs = written(docs.join(live.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "candidates")  # whole texts are dealt out here only
    star = live.select(F.col("low").alias("x"), F.col("rep").alias("y")).union(live.select("rep", "high")).where("x != y").distinct()
    links = verified(star, classes, docs)
    rest = _residual(live, classes, links, docs)
    more = verified(rest.join(star, ["x", "y"], "left_anti"), classes, docs)
    same = info.join(classes.select("high", "low", "n", "rep"), ["high", "low", "n"], "left")
    twice = same.where("doc_id != rep").select(F.col("rep").alias("x"), F.col("doc_id").alias("y"))
    labels = components(links.union(more).union(twice))
    out = info.join(labels, info.doc_id == labels.node, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each near-duplicate group (the smallest id); null ids and wordless texts stay."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
