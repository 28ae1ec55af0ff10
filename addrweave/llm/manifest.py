"""Merkle manifest of a dataset in van Emde Boas layout.

A tree has ``RUN`` children a node. A *block* is an aligned subtree of up to ``HEIGHT`` levels over its leaves, one row of a table, its digests in one
byte string in van Emde Boas order: a tree of height h is split at half height into a top tree and the bottom trees under it, stored top first, each laid
out in the same way. Trees are complete to the left, so sizes of all subtrees follow from the number of leaves, and the address of a digest
is arithmetic; no pointers are stored and nothing is padded. Construction and the look-up of siblings go by these addresses. The roots
of the blocks of a tree are the leaves of the blocks above; this goes on until one node is left. First each source is a tree of its rows, then the
roots of the sources are the leaves of one more tree.

Leaves are numbered within a source by ranges: rows are sorted by source, id and digest over all tasks, each task counts its rows of each source, and a
source's earlier tasks give the offset. So a source of any size is spread over many tasks and blocks, and a task holds one block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrweave.llm.store import written

RUN, HEIGHT = 16, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<before: string, after: string>>"


# ---- van Emde Boas addresses


def widths(leaves: int, height: int) -> list[int]:
    """Nodes on each level from the leaves up, where each level has its runs joined."""
    out = [leaves]
    for _ in range(height):
        out.append(-(-out[-1] // RUN))
    return out


@lru_cache(maxsize=256)
def addresses(leaves: int, height: int) -> tuple[np.ndarray, ...]:
    """Place of each node of each level, leaves first, in a tree of ``height`` levels above its ``leaves``.

    Of the ``height + 1`` levels of nodes the lower half (rounded up) are the bottom trees, which follow the top tree from left to right.
    """
    if height == 0:
        return (np.arange(leaves),)
    low = height // 2  # height of the bottom trees
    level = widths(leaves, height)
    top = addresses(level[low + 1], height - low - 1)
    start, span = sum(map(len, top)), RUN**low
    out: list[list[np.ndarray]] = [[] for _ in range(low + 1)]
    for tree in range(level[low]):
        part = addresses(min(span, leaves - tree * span), low)
        for k, p in enumerate(part):
            out[k].append(p + start)
        start += sum(map(len, part))
    return (*[np.concatenate(p) for p in out], *top)


def levels_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    n = 0
    while leaves > 1:
        leaves, n = -(-leaves // RUN), n + 1
    return n


def build(leaves: list[str], height: int) -> bytes:
    """Digests (hex) of a block's leaves and of all nodes above, as bytes in van Emde Boas order."""
    places = addresses(len(leaves), height)
    out = bytearray(32 * sum(map(len, places)))
    level = leaves
    for k, place in enumerate(places):
        for a, digest in zip(place.tolist(), level, strict=True):
            out[32 * a : 32 * a + 32] = bytes.fromhex(digest)
        if k < height:
            level = [hashlib.sha256("".join(level[i : i + RUN]).encode()).hexdigest() for i in range(0, len(level), RUN)]
    return bytes(out)


def siblings(nodes: bytes, leaves: int, height: int) -> list[list[tuple[str, str]]]:
    """For each leaf and each level from it up: the hex digests of its run before and after it, joined."""
    out: list[list[tuple[str, str]]] = [[] for _ in range(leaves)]
    for k, place in enumerate(addresses(leaves, height)[:height]):
        level = [nodes[32 * a : 32 * a + 32].hex() for a in place.tolist()]
        sides = []
        for i in range(len(level)):
            lo = i // RUN * RUN
            sides.append(("".join(level[lo:i]), "".join(level[i + 1 : lo + RUN])))
        for leaf in range(leaves):
            out[leaf].append(sides[leaf // RUN**k])
    return out


def root_of(nodes: bytes, leaves: int, height: int) -> str:
    at = int(addresses(leaves, height)[-1][0])
    return nodes[32 * at : 32 * at + 32].hex()


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        digest = hashlib.sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


# ---- leaves and their numbers


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Hex sha256 of the columns: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    parts = []
    for c in columns.values():
        s = c.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` (a written table) with ``place``, their number from 0 in the order within ``tree``, and ``n``, the tree's rows.

    Equal rows may come in any order; a last key by input position lets even these be spread over tasks.
    """
    keys = [tree, *order]
    ranged = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys, "_at").sortWithinPartitions(*keys, "_at")
    count = lambda: F.row_number().over(Window.partitionBy(tree, "_part").orderBy(*order, "_at"))
    ranged = written(ranged.withColumn("_part", F.spark_partition_id()), "ranged")
    parts = ranged.groupBy(tree, "_part").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(tree)
    parts = parts.select(
        F.col(tree).alias("_tree"), F.col("_part").alias("_p"), F.sum("_rows").over(whole).alias("n"),
        F.coalesce(F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    local = ranged.withColumn("_row", count())
    both = local.join(parts, local[tree].eqNullSafe(parts["_tree"]) & (local["_part"] == parts["_p"]))
    return both.withColumn("place", F.col("_row") - 1 + F.col("_before")).drop("_at", "_part", "_row", "_tree", "_p", "_before")


def leaves_of(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``leaf`` and ``shown``: the leaf as a reader finds it, tampered with where 5 divides crc32(doc_id)."""
    own = {c: docs[c].cast("long" if c in ("doc_id", "n_chars") else "string") for c in COLUMNS}
    bad = F.coalesce(F.crc32(own["doc_id"].cast("string").cast("binary")) % 5 == 0, F.lit(False))
    lowered = {**own, "text": F.translate(own["text"], UPPER, LOWER)}
    d = docs.select(own["doc_id"].alias("doc_id"), own["source"].alias("source"), leaf_digest(own).alias("leaf"), F.when(bad, leaf_digest(lowered)).alias("_changed"))
    return d.select("doc_id", "source", "leaf", F.coalesce("_changed", "leaf").alias("shown"))


# ---- blocks


BLOCKS = "tree string, level int, block long, leaves long, height int, total long, root string, nodes binary"


def _blocks(level: int, most: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        leaves, total = rows.column("leaf").to_pylist(), rows.column("n")[0].as_py()
        height = most if total > RUN**most else levels_of(total)
        nodes = build(leaves, height)
        one = {"tree": rows.column("tree")[0].as_py(), "level": level, "block": rows.column("place")[0].as_py() // RUN**most, "leaves": len(leaves), "height": height,
               "total": -(-total // RUN**most), "root": root_of(nodes, len(leaves), height), "nodes": nodes}
        return pa.Table.from_pylist([one], pa.schema([("tree", pa.string()), ("level", pa.int32()), ("block", pa.int64()), ("leaves", pa.int64()), ("height", pa.int32()), ("total", pa.int64()), ("root", pa.string()), ("nodes", pa.binary())]))

    return run


def _block_of(most: int) -> Column:
    return F.expr(f"place div {RUN**most}").alias("block")


@dataclass
class Manifest:
    """Numbered leaves of some trees (``tree``, ``place``, ``n``, ``leaf``, and more) and the blocks over them, level by level.

    ``levels[0]`` has the blocks over the leaves, ``levels[k]`` those over the roots of the blocks before; a tree ends where it has one block.
    """

    leaves: DataFrame
    levels: list[DataFrame]
    height: int

    def roots(self) -> DataFrame:
        """``tree`` and ``root``."""
        return _union([b.where("total = 1").select("tree", "root") for b in self.levels])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def forest(leaves: DataFrame, height: int = HEIGHT) -> Manifest:
    """Blocks of at most ``height`` levels of all trees of numbered ``leaves``. Each round has a row for ``RUN ** height`` rows of the one before."""
    todo, levels = leaves, []
    while True:
        groups = todo.select("tree", "place", "n", "leaf", _block_of(height)).groupBy("tree", "block")
        levels.append(written(groups.applyInArrow(_blocks(len(levels), height), BLOCKS), "blocks"))
        more = levels[-1].where("total > 1")
        if more.isEmpty():
            return Manifest(leaves, levels, height)
        todo = more.select("tree", F.col("block").alias("place"), F.col("total").alias("n"), F.col("root").alias("leaf"))


def _unfolded(most: int) -> Callable:
    """Paths of a block's leaves, up to where the path of the block ends."""
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                count = r["leaves"]
                out = [[{"before": b, "after": a} for b, a in path] + r["path"] for path in siblings(r["nodes"], count, r["height"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tree"]] * count, pa.string()), pa.array(np.arange(count) + r["block"] * RUN**most, pa.int64()), pa.array(out, kind), pa.array([r["subroot"]] * count, pa.string())],
                    ["tree", "place", "path", "subroot"])

    return run


UNFOLDED = f"tree string, place long, path {PATH}, subroot string"


def with_paths(m: Manifest, above: DataFrame) -> DataFrame:
    """Blocks over the leaves with ``path`` (from the block's root up) and ``subroot``. ``above``: ``tree``, the ``path`` of its root, ``subroot``.

    Goes down level by level: the paths of a block's leaves are those of the blocks below.
    """
    above = above.select(F.col("tree").alias("_t"), "path", "subroot")
    lower = None
    for blocks in reversed(m.levels):
        known = blocks.where("total = 1").join(above, F.col("tree").eqNullSafe(F.col("_t"))).drop("_t")
        if lower is not None:
            inner = blocks.where("total > 1").join(lower, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("block") == F.col("_b"))).drop("_t", "_b")
            known = known.unionByName(inner)
        lower = known.mapInArrow(_unfolded(m.height), UNFOLDED).select(F.col("tree").alias("_t"), F.col("place").alias("_b"), "path", "subroot")
    return known


PROVED = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def _proved(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
    b = blocks.to_pylist()[0]
    leaves = leaves.sort_by("place")
    rest = [(p["before"], p["after"]) for p in b["path"]]
    tail = "".join(x + y for x, y in rest).encode()
    proofs, folded = [], []
    for shown, path in zip(leaves.column("shown").to_pylist(), siblings(b["nodes"], b["leaves"], b["height"]), strict=True):
        digest = hashlib.sha256("".join(x + y for x, y in path).encode())
        digest.update(tail)
        proofs.append(digest.hexdigest())
        folded.append(fold(shown, path + rest))
    return pa.table([leaves.column("doc_id"), leaves.column("leaf"), pa.array([b["subroot"]] * len(proofs), pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
                    ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])


def manifests(docs: DataFrame, height: int = HEIGHT) -> tuple[Manifest, Manifest]:
    """Trees of all sources, and the one tree over their roots."""
    leaves = written(leaves_of(docs), "leaves")
    sources = forest(written(numbered(leaves.withColumnRenamed("source", "tree"), "tree", ["doc_id", "leaf"]), "numbered"), height)
    roots = written(sources.roots().select(F.col("tree").alias("source"), F.col("root").alias("leaf"), F.lit("").alias("tree")), "roots")
    return sources, forest(written(numbered(roots, "tree", ["source"]), "numbered"), height)


def proved(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Each document's leaf, the roots above it, the digest of its proof, and whether it verifies as a reader finds it.

    ``root`` is the hash of the whole table; ``folded_root`` is what the leaf gives with its siblings, the leaf being made from the tampered text where 5
    divides crc32(doc_id). Null columns are hashed as ``-``; a null source is the first source, null ids come first and are not tampered with. Rows of
    one id are ordered by their digests, equal rows each have a leaf. A text of any length is one leaf. An empty table gives no rows. Further
    columns are ignored. ``height``: levels of a block.
    """
    sources, top = manifests(docs, height)
    root = top.roots().first()
    if root is None:
        return docs.sparkSession.createDataFrame([], f"{PROVED}, root string, verified boolean")
    ends = docs.sparkSession.createDataFrame([("", [], root["root"])], f"tree string, path {PATH}, subroot string")
    up = with_paths(top, ends).mapInArrow(_unfolded(height), UNFOLDED).select("place", "path")
    above = top.leaves.select(F.col("source").alias("tree"), F.col("leaf").alias("subroot"), "place").join(up, "place")
    blocks = with_paths(sources, above).groupBy("tree", "block")
    leaves = sources.leaves.select("tree", _block_of(height), "place", "doc_id", "leaf", "shown").groupBy("tree", "block")
    out = leaves.cogroup(blocks).applyInArrow(_proved, PROVED)
    return out.select("*", F.lit(root["root"]).alias("root"), (F.col("folded_root") == root["root"]).alias("verified"))
