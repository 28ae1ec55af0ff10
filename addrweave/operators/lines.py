"""Line work: covered length, Hausdorff distance, ring test."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from addrweave.functions import geometry as G
from addrweave.operators.cells import explode_along, explode_segments, segment_pairs
from addrweave.operators.skew import ROWS_PER_TASK
from addrweave.session import stable


def near_stretch(pairs: DataFrame, r: float) -> DataFrame:
    """Adds ``_lo, _hi``: the stretch of t along segment ``x1..y2`` within ``r`` of ``u1..v2`` (a capsule, so one stretch), 0 and 0 if none.

    The capsule is a bar (near the line of the right segment, between its ends) and a disc at each end; ``_fs``/``_fe`` mark flat ends,
    which lose their disc. Every intermediate value is a column of its own, so generated code computes it once, and none may be null: with null
    checks all through, the method that Spark generates is longer than the 8,000 bytes up to which the JVM compiles, and runs interpreted.
    A segment without all its coordinates has no length; a right one takes part with the ends that it has.
    """
    def slab(name: str, low: str, high: str) -> list[str]:  # low <= {name}0 + t * {name}d <= high
        inside = f"{name}0 >= {low} AND {name}0 <= {high}"
        a, b = f"({low} - {name}0) / {name}d", f"({high} - {name}0) / {name}d"
        return [f"CASE WHEN {name}d = 0D THEN IF({inside}, 0D, 2D) WHEN {name}d > 0D THEN {a} ELSE {b} END AS {name}lo",
                f"CASE WHEN {name}d = 0D THEN IF({inside}, 1D, -1D) WHEN {name}d > 0D THEN {b} ELSE {a} END AS {name}hi"]

    def disc(name: str, cx: str, cy: str) -> list[str]:  # qa t^2 + 2 b t + c <= 0
        return [f"_dx * (_x1 - {cx}) + _dy * (_y1 - {cy}) AS {name}b", f"(_x1 - {cx}) * (_x1 - {cx}) + (_y1 - {cy}) * (_y1 - {cy}) - {float(r * r)}D AS {name}c"]

    def crossing(name: str) -> list[str]:
        return [f"(-{name}b - {name}s) / _qd AS {name}lo", f"(-{name}b + {name}s) / _qd AS {name}hi"]

    def most(a: str, b: str) -> str:  # greatest and least make three times the code
        return f"IF({a} >= {b}, {a}, {b})"

    def least(a: str, b: str) -> str:
        return f"IF({a} <= {b}, {a}, {b})"

    def part(name: str) -> list[str]:  # from 0 to 1
        return [f"{most(f'{name}lo', '0D')} AS {name}from", f"{least(f'{name}hi', '1D')} AS {name}to"]

    def ends(name: str) -> list[str]:
        some = f"{name}ok AND {name}from <= {name}to"
        return [f"IF({some}, {name}from, 2D) AS {name}l", f"IF({some}, {name}to, -1D) AS {name}h"]

    xy = ("x1", "y1", "x2", "y2", "u1", "v1", "u2", "v2")
    d = pairs.selectExpr("*", *[f"coalesce(CAST({c} AS DOUBLE), 0D) AS _{c}" for c in xy], "NOT _fs AND u1 IS NOT NULL AND v1 IS NOT NULL AS _p", "NOT _fe AND u2 IS NOT NULL AND v2 IS NOT NULL AS _q",
                         "u1 IS NOT NULL AND v1 IS NOT NULL AND u2 IS NOT NULL AND v2 IS NOT NULL AS _a", "x1 IS NULL OR y1 IS NULL OR x2 IS NULL OR y2 IS NULL AS _void")
    d = d.selectExpr("*", "_x2 - _x1 AS _dx", "_y2 - _y1 AS _dy", "_u2 - _u1 AS _ex", "_v2 - _v1 AS _ey")
    d = d.selectExpr("*", "_dx * _dx + _dy * _dy AS _qa", "sqrt(_ex * _ex + _ey * _ey) AS _n")
    d = d.selectExpr("*", "IF(_n = 0D, 1D, _n) AS _nd", "IF(_qa = 0D, 1D, _qa) AS _qd", *disc("_p", "_u1", "_v1"), *disc("_q", "_u2", "_v2"))
    d = d.selectExpr("*", "((_x1 - _u1) * _ex + (_y1 - _v1) * _ey) / _nd AS _al0", "(_dx * _ex + _dy * _ey) / _nd AS _ald", "((_x1 - _u1) * _ey - (_y1 - _v1) * _ex) / _nd AS _ac0",
                     "(_dx * _ey - _dy * _ex) / _nd AS _acd", *[f"{k}b * {k}b - _qa * {k}c AS {k}s2" for k in ("_p", "_q")])
    d = d.selectExpr("*", *slab("_al", "0D", "_n"), *slab("_ac", f"{-float(r)}D", f"{float(r)}D"), *[f"{k} AND _qa > 0D AND {k}s2 >= 0D AS {k}ok" for k in ("_p", "_q")],
                     *[f"sqrt(abs({k}s2)) AS {k}s" for k in ("_p", "_q")])
    d = d.selectExpr("*", "_a AND _n <> 0D AS _bok", f"{most('_allo', '_aclo')} AS _blo", f"{least('_alhi', '_achi')} AS _bhi", *crossing("_p"), *crossing("_q"))
    d = d.selectExpr("*", *part("_b"), *part("_p"), *part("_q"))
    d = d.selectExpr("*", *ends("_b"), *ends("_p"), *ends("_q"))
    d = d.selectExpr("*", f"{least('_pl', '_ql')} AS _dl", f"{most('_ph', '_qh')} AS _dh")
    d = d.selectExpr("*", f"{least('_bl', '_dl')} AS _l", f"{most('_bh', '_dh')} AS _h")
    return d.selectExpr(*[f"`{c}`" for c in pairs.columns], "IF(_l <= _h, _l, 0D) AS _lo", "IF(_l <= _h, _h, 0D) AS _hi", "IF(_void, NULL, sqrt(_qa)) AS _len")


def covered_length(left: DataFrame, right: DataFrame, radius: float, keys: list[str], scope: list[str] | None = None, size: float = 200.0,
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Metres of each left line within ``radius`` of each right line (round ends), one row per near pair ``keys``.

    ``left`` has ``lines`` and ``right`` has ``other_lines`` next to their key columns. Near segments meet by cell; each pair of segments gives
    one stretch of the left segment and stretches are united by a running maximum.
    """
    rsegs = explode_segments(right, "other_lines", ("u1", "v1", "u2", "v2"), "_rseg").withColumns({"_fs": F.lit(False), "_fe": F.lit(False)})
    pairs = segment_pairs(explode_segments(left, "lines"), rsegs, radius, size, scope, rows_per_task)
    return _united_length(near_stretch(pairs, radius).select(*keys, "seg", "_lo", "_hi", "_len"), keys)


def covered_by_partners(rows: DataFrame, radius: float, key: str, partners_per_block: int = 1000) -> DataFrame:
    """G9 with flat ends: metres of each key's ``lines`` within ``radius`` of the union of its partners' ``other_lines``.

    Each row holds the key's line and one partner. Segments meet by cells within a key, so a long line never meets all segments of its partners.
    Stretches are united in two levels: first in blocks of partners, as many as the key has thousands of them, then the united ones of all blocks.
    """
    own = rows.groupBy(key).agg(F.min("lines").alias("lines"), F.ceil(F.count("*") / partners_per_block).alias("_blocks")).withColumn("_cell", _cell_size(2.0 * radius))
    left = explode_along(explode_segments(own, "lines"), F.col("_cell"), radius)
    right = rows.select(key, _cell_size(2.0 * radius).alias("_cell"), F.explode(_end_marked("other_lines")).alias("o")).select(
        key, "_cell", *[F.col(f"o.{c}").alias(n) for c, n in (("x1", "u1"), ("y1", "v1"), ("x2", "u2"), ("y2", "v2"), ("fs", "_fs"), ("fe", "_fe"))])
    right = explode_along(right, F.col("_cell"), names=("u1", "v1", "u2", "v2")).drop("_cell")
    pairs = left.join(right, [key, "_cx", "_cy"])  # a pair may meet in several cells: it gives the same stretch, which the union takes once
    st = near_stretch(pairs, radius).select(key, "seg", "_lo", "_hi", "_len", F.pmod(F.xxhash64("u1", "v1", "u2", "v2"), F.col("_blocks")).alias("_block"))
    return _united_length(_unite(st, [key, "seg", "_block"]), [key])


def _cell_size(least: float) -> Column:
    """Cells of a key: the mean length of its own line's segments, so cells and segments are about as many."""
    return F.greatest(F.lit(float(least)), G.length("lines") / F.greatest(F.size(G.segments("lines")), F.lit(1)))


def _end_marked(parts: str) -> Column:
    """All segments with flags for the first and last one of a part."""
    def of_part(part: Column) -> Column:
        last = F.size(part) - 2
        return F.transform(G.segments(F.array(part)), lambda s, i: F.named_struct(
            *[x for c in ("x1", "y1", "x2", "y2") for x in (F.lit(c), s[c])], F.lit("fs"), i == 0, F.lit("fe"), i == last))
    return F.flatten(F.transform(parts, of_part))


def _united_length(stretch: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys, "seg").orderBy("_lo", "_hi").rowsBetween(Window.unboundedPreceding, -1)
    d = stretch.withColumn("_seen", F.coalesce(F.max("_hi").over(w), F.lit(0.0)))
    fresh = F.greatest(F.lit(0.0), F.col("_hi") - F.greatest("_lo", "_seen"))
    return d.groupBy(*keys).agg(F.sum(fresh * F.col("_len")).alias("covered"))


def _unite(stretch: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping stretches merged into islands within ``keys``."""
    w = Window.partitionBy(*keys).orderBy("_lo", "_hi")
    back = w.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.when(F.col("_lo") <= F.max("_hi").over(back), 0).otherwise(1)
    marked = stretch.withColumn("_new", opens)
    island = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_island", island).groupBy(*keys, "_island").agg(
        F.first("_len").alias("_len"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")).drop("_island")


def hausdorff(rows: DataFrame, key: str, partner: str) -> DataFrame:
    """Discrete Hausdorff distance (vertices to nearest segment, both ways) between each key's ``lines`` and all its ``other_lines``.

    Each row holds the key's line and one partner (``key, partner`` is unique); each round reads ``rows``, so they should be stored. A nearest join within the key: vertices and segments meet by cells,
    a vertex looks one cell far, and those that found nothing so near go on with cells four times as wide. Keys without vertices or segments on a side
    give no row; a vertex with a coordinate that is no number has no distance.
    """
    rows = rows.where((F.size(G.segments("lines")) > 0) & (F.size(G.segments("other_lines")) > 0))
    own = rows.groupBy(key).agg(F.min("lines").alias("lines")).withColumn("_cell", _cell_size(1.0))
    theirs = rows.select(key, F.col(partner).cast("string").alias("_rid"), "other_lines", _cell_size(1.0).alias("_cell"))

    def vertices(df: DataFrame, parts: str, side: int, rid: Column) -> DataFrame:
        return df.select(key, "_cell", F.lit(side).alias("_side"), rid.alias("_rid"), F.posexplode(F.flatten(F.col(parts))).alias("_pos", "p")).select(
            key, "_cell", "_side", "_rid", "_pos", F.col("p.x").alias("x"), F.col("p.y").alias("y"))

    def segments(df: DataFrame, parts: str, side: int) -> DataFrame:
        return df.select(key, "_cell", F.lit(side).alias("_side"), F.explode(G.segments(parts)).alias("s")).select(key, "_cell", "_side", "s.*")

    open_points = vertices(own, "lines", 0, F.lit("")).unionByName(vertices(theirs, "other_lines", 1, F.coalesce("_rid", F.lit(""))))
    targets = segments(theirs, "other_lines", 0).unionByName(segments(own, "lines", 1))
    names, found, wider = [key, "_side", "_rid", "_pos"], None, 1.0
    while wider < 4.0**24:  # then cells are wider than any plane
        size = F.col("_cell") * wider
        near = explode_along(targets, size, size).drop("_cell")
        met = open_points.withColumns({"_cx": F.floor(F.col("x") / size), "_cy": F.floor(F.col("y") / size)}).join(near, [key, "_side", "_cx", "_cy"], "left")
        d = G.point_segment_distance(F.col("x"), F.col("y"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
        met = stable(met.groupBy(*names, "x", "y", "_cell").agg(F.min(d).alias("_d")))
        settled = F.coalesce(F.col("_d") <= size, F.lit(False))
        hits = met.where(settled & ~F.isnan("_d")).select(key, "_d")
        found = hits if found is None else found.unionByName(hits)
        open_points = met.where(~settled & ~F.isnan("x") & ~F.isnan("y")).drop("_d")
        if open_points.isEmpty():
            break
        wider *= 4
    return found.groupBy(key).agg(F.max("_d").alias("hausdorff"))


def _closes(chains: np.ndarray) -> bool:
    """Do parts (rows of start, end, length) chain up into one closed line? The two nearest free ends (under 20 m) are joined each time.

    A chain is only its two ends and its length, joints included; its middle plays no part in the answer.
    """
    if len(chains) >= 100:
        return _closes_long(chains)
    ends, lengths = chains[:, :4].reshape(-1, 2, 2), chains[:, 4]
    while len(ends) > 1:
        flat = ends.reshape(-1, 2)
        gaps = np.hypot(flat[:, None, 0] - flat[None, :, 0], flat[:, None, 1] - flat[None, :, 1])
        owner = np.arange(len(flat)) // 2
        gaps[owner[:, None] <= owner[None, :]] = np.inf
        i, j = divmod(int(gaps.argmin()), len(flat))
        if not gaps[i, j] < 20:
            return False
        rest = np.setdiff1d(np.arange(len(ends)), [owner[i], owner[j]])
        total = lengths[owner[i]] + lengths[owner[j]] + gaps[i, j]
        ends = np.concatenate([ends[rest], flat[[i ^ 1, j ^ 1]][None]])  # the far ends stay free
        lengths = np.append(lengths[rest], total)
    return bool(np.hypot(*(ends[0, 0] - ends[0, 1])) < 0.2 * lengths[0])


def _closes_long(chains: np.ndarray) -> bool:
    """The same for many parts: ends stay where they are, so joints are taken in the order of their gaps; close ends meet by 20 m cells."""
    xy = chains[:, :4].reshape(-1, 2)
    cells: dict[tuple[int, int], list[int]] = {}
    for k, c in enumerate(np.floor(xy / 20).astype(np.int64).tolist()):
        cells.setdefault((c[0], c[1]), []).append(k)
    near = []
    for (cx, cy), mine in cells.items():
        others = np.array([k for i in (-1, 0, 1) for j in (-1, 0, 1) for k in cells.get((cx + i, cy + j), ())])
        for k in mine:
            later = others[others // 2 < k // 2]
            gap = np.hypot(*(xy[later] - xy[k]).T)
            near += [(g, k, o) for g, o in zip(gap[gap < 20].tolist(), later[gap < 20].tolist(), strict=True)]
    up, free, total = list(range(len(chains))), [True] * len(xy), float(chains[:, 4].sum())

    def root(c: int) -> int:
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c

    for gap, k, o in sorted(near):
        one, two = root(k // 2), root(o // 2)
        if free[k] and free[o] and one != two:
            up[one], free[k], free[o] = two, False, False
            total += gap
    left = [k for k in range(len(xy)) if free[k]]
    return len(left) == 2 and bool(np.hypot(*(xy[left[0]] - xy[left[1]])) < 0.2 * total)


@F.pandas_udf(BooleanType())
def _chain_closes(chains: pd.Series) -> pd.Series:
    return chains.map(lambda c: None if c is None else _closes(np.asarray(c, dtype=float).reshape(-1, 5)))


def is_ring(parts: Column | str, limit: int | None = 100) -> Column:
    """An end gap below a fifth of the length; several parts are chained first, ``limit`` or more are no ring (None: no limit)."""
    p = F.col(parts) if isinstance(parts, str) else parts
    line = F.element_at(p, 1)
    a, b = F.element_at(line, 1), F.element_at(line, -1)
    one = G.distance(a["x"], a["y"], b["x"], b["y"]) < 0.2 * G.length(p)
    chains = F.flatten(F.transform(p, lambda q: F.array(q[0]["x"], q[0]["y"], F.element_at(q, -1)["x"], F.element_at(q, -1)["y"], G.length(F.array(q)))))
    few = F.size(p) < limit if limit is not None else F.size(p) > 1
    many = _chain_closes(F.when((F.size(p) > 1) & few, chains))
    return F.when(F.size(p) == 1, one).when(few, many).otherwise(False)
