"""Spatial joins as equi joins on square cells.

Each geometry is given the cells its search box covers; candidates meet on ``(scope, cell)`` and are then tested exactly.
A pair is kept only in the cell of one agreed point, so no later de-duplication shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.operators.skew import ROWS_PER_TASK, by_keys, split_hot
from addrweave.session import stable


def cell_of(c: Column | str, size: float) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c / F.lit(float(size)))


def explode_box(df: DataFrame, xmin: Column, ymin: Column, xmax: Column, ymax: Column, size: float) -> DataFrame:
    """One row per cell ``(_cx, _cy)`` the box touches."""
    return (df.withColumn("_cx", F.explode(F.sequence(cell_of(xmin, size), cell_of(xmax, size))))
            .withColumn("_cy", F.explode(F.sequence(cell_of(ymin, size), cell_of(ymax, size)))))


def radius_pairs(left: DataFrame, right: DataFrame, radius: float, scope: list[str] | None = None, left_xy: tuple[str, str] = ("x", "y"),
                 right_xy: tuple[str, str] = ("mx", "my"), rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, list[str]]:
    """Pairs of points at most ``radius`` apart, with ``distance``, and the keys the pairs are partitioned by.

    Cells are two radii wide, so a left point is repeated four times and a right point is in one cell only.
    """
    size = 2.0 * radius
    lx, ly, rx, ry = F.col(left_xy[0]), F.col(left_xy[1]), F.col(right_xy[0]), F.col(right_xy[1])
    lcells = explode_box(left, lx - radius, ly - radius, lx + radius, ly + radius, size)
    rcells = right.withColumns({"_cx": cell_of(rx, size), "_cy": cell_of(ry, size)})
    l2, r2, keys = split_hot(lcells, rcells, (scope or []) + ["_cx", "_cy"], rows_per_task)
    pairs = by_keys(l2, keys).join(by_keys(r2, keys), keys).withColumn("distance", G.distance(lx, ly, rx, ry)).where(F.col("distance") <= radius)
    return pairs, keys


def shape_pairs(points: DataFrame, shapes: DataFrame, radius: float, scope: list[str] | None = None, rows_per_task: int = ROWS_PER_TASK,
                count_shapes: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """J2 against geometry: pairs of a point (``x``, ``y``) and a shape (``rings``, or ``mx``, ``my`` where it is null) at most ``radius`` apart.

    A point is in the cells of its search box, a shape in those of its own box; a pair is kept in the cell of the lower-left corner of
    the common box, so a shape's pairs may lie in several cells. ``count_shapes`` may name rows that are cheaper to count than ``shapes`` and at
    least as many at each place, as those before copies were folded.
    """
    size = 2.0 * radius
    x, y, b = F.col("x").cast("double"), F.col("y").cast("double"), G.bounds("rings")
    box = {f"_{k}": F.coalesce(b[k], F.col(c).cast("double")) for k, c in (("xmin", "mx"), ("ymin", "my"), ("xmax", "mx"), ("ymax", "my"))}
    lcells = explode_box(points, x - radius, y - radius, x + radius, y + radius, size)
    rcells, counted = (None if d is None else explode_box(d.withColumns(box), *[F.col(k) for k in box], size) for d in (shapes, count_shapes))
    l2, r2, keys = split_hot(lcells, rcells, (scope or []) + ["_cx", "_cy"], rows_per_task, count_right=counted)
    meet = (x - radius <= F.col("_xmax")) & (F.col("_xmin") <= x + radius) & (y - radius <= F.col("_ymax")) & (F.col("_ymin") <= y + radius)
    owner = (F.col("_cx") == cell_of(F.greatest(x - radius, F.col("_xmin")), size)) & (F.col("_cy") == cell_of(F.greatest(y - radius, F.col("_ymin")), size))
    pairs = by_keys(l2, keys).join(by_keys(r2, keys), keys).where(meet & owner)
    kept = [c for c in pairs.columns if c != "rings" and c not in box]
    distance = F.struct(G.shape_distance(x, y, "rings", F.col("mx"), F.col("my"), {k: F.col(f"_{k}") for k in ("xmin", "ymin", "xmax", "ymax")}).alias("distance"))
    return pairs.select(*kept, F.inline(F.array(distance))).where(F.col("distance") <= radius), keys  # no filter passes the generator, so a distance is computed once


def explode_along(df: DataFrame, size: float | Column, grow: float | Column = 0.0, names: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"), shift: float = 0.0) -> DataFrame:
    """One row per cell ``(_cx, _cy)`` whose square, widened by ``grow``, the segment touches; rows of cells lie ``shift`` above multiples of ``size``.

    Column by column: a segment is in the cells between its heights at the two edges of a column, so a long slanting one takes as many cells as it
    passes, not those of its box. A hair of slack covers rounding.
    """
    size, grow = (v if isinstance(v, Column) else F.lit(float(v)) for v in (size, grow))
    x1, y1, x2, y2 = (F.col(c) for c in names)
    d = df.withColumns({"_size": size, "_grow": grow + size * 1e-6})
    s, g = F.col("_size"), F.col("_grow")
    d = d.withColumn("_cx", F.explode(F.sequence(F.floor((F.least(x1, x2) - g) / s), F.floor((F.greatest(x1, x2) + g) / s))))
    low, high = F.greatest(F.col("_cx") * s - g, F.least(x1, x2)), F.least((F.col("_cx") + 1) * s + g, F.greatest(x1, x2))

    def height(x: Column) -> Column:
        return F.least(F.greatest(y1 + (x - x1) * ((y2 - y1) / F.nullif(x2 - x1, F.lit(0.0))), F.least(y1, y2)), F.greatest(y1, y2))

    steep = x1 == x2
    d = d.withColumns({"_ya": F.when(steep, y1).otherwise(height(low)), "_yb": F.when(steep, y2).otherwise(height(high))})
    rows = F.sequence(F.floor((F.least("_ya", "_yb") - g - shift) / s), F.floor((F.greatest("_ya", "_yb") + g - shift) / s))
    return d.withColumn("_cy", F.explode(rows)).drop("_size", "_grow", "_ya", "_yb")


_SHIFT = 0.3819660113  # rows of polygon cells lie this share of a cell off round coordinates, so that no corner stands exactly under a vertex


def polygon_cells(polygons: DataFrame, size: float, grow: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Cut polygons into cells: ``(_cx, _cy, _whole, _edges, _odd)`` next to the polygon's other columns; and the edge rows behind them.

    ``polygons`` has a unique ``polygon_id`` and ``rings``. A cell keeps the edges that touch it (or come within ``grow``) and one bit: whether the number of
    edges that cross its bottom line farther right is odd. The bit is a running sum from the right over the row's crossings, each counted in
    the one cell it falls in (``b`` of that cell's edge). Cells that no edge touches are left out where outside, and ``_whole``, without edges, inside.
    """
    attrs = [c for c in polygons.columns if c not in ("rings", "polygon_id")]
    e = F.col("e")
    edges = polygons.select("polygon_id", *attrs, F.explode(G.segments("rings")).alias("e")).select(
        "polygon_id", *attrs, *[e[c].alias(c) for c in ("x1", "y1", "x2", "y2")])
    spread = explode_along(edges, size, grow, shift=size * _SHIFT)
    x1, y1, x2, y2, bottom = (*(F.col(c) for c in ("x1", "y1", "x2", "y2")), _bottom(size))
    crosses = ((y1 > bottom) != (y2 > bottom)) & (cell_of(x1 + (bottom - y1) * ((x2 - x1) / F.nullif(y2 - y1, F.lit(0.0))), size) == F.col("_cx"))
    spread = spread.withColumn("b", F.coalesce(crosses, F.lit(False)))
    cells = spread.groupBy("polygon_id", *attrs, "_cx", "_cy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2", "b")).alias("_edges"), F.count_if("b").alias("_n"))
    row = Window.partitionBy("polygon_id", "_cy").orderBy("_cx")
    right = F.coalesce(F.sum("_n").over(Window.partitionBy("polygon_id", "_cy").orderBy(F.desc("_cx")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumns({"_right": right, "_before": F.lag("_cx").over(row)})
    inside = (F.col("_n") + F.col("_right")) % 2 == 1  # of the untouched cells on the left
    gap = F.when(inside & (F.col("_before") + 1 < F.col("_cx")), F.sequence(F.col("_before") + 1, F.col("_cx") - 1)).otherwise(F.expr("array()"))
    kinds = F.concat(F.array(F.struct(F.col("_cx").alias("cx"), F.lit(False).alias("whole"))), F.transform(gap, lambda c: F.struct(c.cast("bigint").alias("cx"), F.lit(True).alias("whole"))))
    cells = cells.withColumn("_k", F.explode(kinds)).select(
        "polygon_id", *attrs, F.col("_k.cx").alias("_cx"), "_cy", F.col("_k.whole").alias("_whole"),
        F.when(~F.col("_k.whole"), F.col("_edges")).alias("_edges"), (F.col("_right") % 2 == 1).alias("_odd"))
    return cells, spread


def _bottom(size: float) -> Column:
    return (F.col("_cy") + F.lit(_SHIFT)) * F.lit(float(size))


def _inside_cell(px: Column, py: Column, size: float, border: bool) -> Column:
    """Even-odd test of a point by its cell: the way goes down to the bottom line, then right; only the cell's edges and its bit are needed.

    Edges below the point: those that cross its vertical between bottom line and point. Both halves use the same side test at the corner, so they
    agree about every edge.
    """
    bottom = _bottom(size)

    def side(e: Column, y: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])

    def below(e: Column) -> Column:
        east = e["x2"] > e["x1"]
        return ((e["x1"] > px) != (e["x2"] > px)) & F.when(east, side(e, py) > 0).otherwise(side(e, py) < 0) & F.when(east, side(e, bottom) <= 0).otherwise(side(e, bottom) >= 0)

    def right_of(e: Column) -> Column:
        return e["b"] & F.when(e["y2"] > e["y1"], side(e, bottom) > 0).otherwise(side(e, bottom) < 0)

    odd = ((F.size(F.filter("_edges", below)) + F.size(F.filter("_edges", right_of))) % 2 == 1) != F.col("_odd")
    on = G.on_edge(F.col("_edges"), px, py)
    return (odd | on) if border else (odd & ~on)


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, border: bool = True, grow: float = 0.0, scope: list[str] | None = None,
                       xy: tuple[str, str] = ("x", "y"), rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Inner join of points to every polygon they lie in (or within ``grow`` of).

    Both sides are distributed by cell; ``polygons`` brings ``polygon_id``, ``rings`` and its attributes (column names distinct
    from those of ``points``, except ``scope``).
    """
    px, py = F.col(xy[0]).cast("double"), F.col(xy[1]).cast("double")
    cells, edge_rows = polygon_cells(polygons, size, grow)
    pts = points.withColumns({"_cx": cell_of(px, size), "_cy": cell_of(py - size * _SHIFT, size)})
    p2, c2, keys = split_hot(pts, cells, (scope or []) + ["_cx", "_cy"], rows_per_task, count_right=edge_rows)
    hit = _inside_cell(px, py, size, border)
    if grow:
        hit = hit | (F.array_min(F.transform("_edges", lambda s: G.point_segment_distance(px, py, s["x1"], s["y1"], s["x2"], s["y2"]))) <= grow)
    return by_keys(p2, keys).join(by_keys(c2, keys), keys).where(F.col("_whole") | hit).drop("_cx", "_cy", "_bl", "_br", "_whole", "_edges", "_odd")


def segment_pairs(left: DataFrame, right: DataFrame, radius: float, size: float, scope: list[str] | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Pairs of segments whose boxes come within ``radius``; left has ``x1..y2``, right has ``u1,v1,u2,v2``.

    A pair found in several cells is kept only in the cell of the lower-left corner of the common box.
    """
    def boxed(df: DataFrame, side: str, x: tuple[str, str], y: tuple[str, str], grow: float) -> DataFrame:
        box = {f"{side}{k}{i}": F.coalesce(fn(*c).cast("double"), F.lit(0.0)) + s * grow for k, c in (("x", x), ("y", y)) for i, fn, s in ((0, F.least, -1), (1, F.greatest, 1))}
        return df.withColumns(box)

    def first(df: DataFrame, side: str) -> DataFrame:
        """Once a row, not once a pair: is this cell the first column and the first row of the segment's box?"""
        return df.withColumns({f"{side}f{k}": F.coalesce(F.col(f"_c{k}") == cell_of(f"{side}{k}0", size), F.lit(False)) for k in "xy"})

    def cells(df: DataFrame, *args) -> DataFrame:
        d = boxed(df, *args)
        return explode_box(d, *[F.col(f"{args[0]}{k}") for k in ("x0", "y0", "x1", "y1")], size).select(*df.columns, "_cx", "_cy")

    sides = ("_l", ("x1", "x2"), ("y1", "y2"), radius), ("_r", ("u1", "u2"), ("v1", "v2"), 0.0)
    l2, r2, keys = split_hot(cells(left, *sides[0]), cells(right, *sides[1]), (scope or []) + ["_cx", "_cy"], rows_per_task)
    l3, r3 = (first(boxed(by_keys(d, keys), *s), s[0]) for d, s in ((l2, sides[0]), (r2, sides[1])))
    meet = F.expr("_lx0 <= _rx1 AND _rx0 <= _lx1 AND _ly0 <= _ry1 AND _ry0 <= _ly1")
    owner = F.expr("(_lfx OR _rfx) AND (_lfy OR _rfy)")  # both boxes have the cell, so the common box starts in it where one of them does
    extra = [f"{s[0]}{k}" for s in sides for k in ("x0", "x1", "y0", "y1", "fx", "fy")]
    return l3.join(r3, keys).where(meet & owner).drop("_cx", "_cy", "_bl", "_br", *extra)


def explode_segments(df: DataFrame, parts: str, names: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2"), seg: str = "seg") -> DataFrame:
    """One row per segment of a line column, numbered from 0."""
    s = df.select(*[c for c in df.columns if c != parts], F.posexplode(G.segments(parts)).alias(seg, "_s"))
    return s.select(*[c for c in s.columns if c != "_s"], *[F.col("_s")[k].alias(n) for k, n in zip(("x1", "y1", "x2", "y2"), names)])


def segments_near(pairs: DataFrame, grow: float, keys: list[str]) -> DataFrame:
    """``keys`` of pairs of segments ``x1..y2`` and ``u1..v2`` at most ``grow`` apart: they cross or touch, else the nearest end counts.

    As in ``near_stretch``, values used again are columns of their own and none is null, so that the methods that Spark generates stay below the 8,000
    bytes up to which the JVM compiles; the answer leaves through a generator of one row, since a filter on it would be pushed down with all steps written out.
    """
    def ends(name: str, px: str, py: str, x: str, y: str, dx: str, dy: str, n: str) -> list[list[str]]:  # steps: distance of an end to the other segment
        return [[f"(({px} - {x}) * {dx} + ({py} - {y}) * {dy}) / {n}d AS {name}r"], [f"IF({name}r <= 1D, {name}r, 1D) AS {name}c"],
                [f"IF({n} = 0D, 0D, IF({name}c >= 0D, {name}c, 0D)) AS {name}t"], [f"{px} - ({x} + {name}t * {dx}) AS {name}x", f"{py} - ({y} + {name}t * {dy}) AS {name}y"],
                [f"sqrt({name}x * {name}x + {name}y * {name}y) AS {name}q"]]

    def side(name: str, ax: str, ay: str, dx: str, dy: str, px: str, py: str) -> str:
        return f"signum({dx} * ({py} - {ay}) - {dy} * ({px} - {ax})) AS {name}"

    def both(a: str, b: str) -> str:
        return f"IF({a} <= {b}, {a}, {b})"

    xy = ("x1", "y1", "x2", "y2", "u1", "v1", "u2", "v2")
    d = pairs.selectExpr(*keys, *[f"coalesce(CAST({c} AS DOUBLE), CAST('NaN' AS DOUBLE)) AS _{c}" for c in xy])
    d = d.selectExpr("*", "_x2 - _x1 AS _dx", "_y2 - _y1 AS _dy", "_u2 - _u1 AS _ex", "_v2 - _v1 AS _ey")
    d = d.selectExpr("*", "_dx * _dx + _dy * _dy AS _l", "_ex * _ex + _ey * _ey AS _m")
    d = d.selectExpr("*", "IF(_l = 0D, 1D, _l) AS _ld", "IF(_m = 0D, 1D, _m) AS _md",
                     side("_sa", "_x1", "_y1", "_dx", "_dy", "_u1", "_v1"), side("_sb", "_x1", "_y1", "_dx", "_dy", "_u2", "_v2"),
                     side("_sc", "_u1", "_v1", "_ex", "_ey", "_x1", "_y1"), side("_sd", "_u1", "_v1", "_ex", "_ey", "_x2", "_y2"))
    other, own = ("_u1", "_v1", "_ex", "_ey", "_m"), ("_x1", "_y1", "_dx", "_dy", "_l")
    for steps in zip(ends("_e1", "_x1", "_y1", *other), ends("_e2", "_x2", "_y2", *other), ends("_e3", "_u1", "_v1", *own), ends("_e4", "_u2", "_v2", *own)):
        d = d.selectExpr("*", *[s for some in steps for s in some])
    d = d.selectExpr("*", f"{both('_e1q', '_e2q')} AS _e12", f"{both('_e3q', '_e4q')} AS _e34")
    boxes = "least(_x1, _x2) <= greatest(_u1, _u2) AND least(_u1, _u2) <= greatest(_x1, _x2) AND least(_y1, _y2) <= greatest(_v1, _v2) AND least(_v1, _v2) <= greatest(_y1, _y2)"
    meet = f"_sa * _sb <= 0D AND _sc * _sd <= 0D AND {boxes}"  # boxes that meet settle the collinear case
    return d.selectExpr(*keys, f"inline(array(struct(({meet}) OR _e12 <= {float(grow)}D OR _e34 <= {float(grow)}D AS _near)))").where("_near").select(*keys)


def _first_points(df: DataFrame, key: str, parts: str) -> DataFrame:
    """One vertex of each part."""
    return df.select(key, F.explode(parts).alias("_part")).where(F.size("_part") > 0).select(key, F.col("_part")[0]["x"].alias("x"), F.col("_part")[0]["y"].alias("y"))


def _touching(left: DataFrame, right: DataFrame, grow: float, size: float, keys: list[str], rows_per_task: int) -> DataFrame:
    """``keys`` of segments ``x1..y2`` and ``u1..v2`` at most ``grow`` apart, as often as they share a cell; both sides take only the cells they pass."""
    lc, rc = explode_along(left, size, grow), explode_along(right, size, 0.0, ("u1", "v1", "u2", "v2"))
    l2, r2, on = split_hot(lc, rc, ["_cx", "_cy"], rows_per_task)
    slack = f"{float(grow + size * 1e-6)!r}D"  # as in explode_along
    near = " AND ".join(f"least({a}1, {a}2) - {slack} <= greatest({b}1, {b}2)" for a, b in (("x", "u"), ("u", "x"), ("y", "v"), ("v", "y")))
    return segments_near(by_keys(l2, on).join(by_keys(r2, on), on).where(near), grow, keys)


def lines_in_polygons(lines: DataFrame, polygons: DataFrame, size: float, grow: float = 0.0, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """J3/J4 and G7 for lines: distinct ``(line_id, polygon_id)`` where the line meets the polygon or comes within ``grow``.

    ``lines`` has ``line_id`` and ``lines``. A part that comes near no edge lies inside or outside as a whole, so one vertex of each part is tested.
    """
    segs = explode_segments(lines.select("line_id", "lines"), "lines")
    inside = points_in_polygons(_first_points(lines, "line_id", "lines"), polygons.select("polygon_id", "rings"), size, True, 0.0, None, ("x", "y"), rows_per_task).select("line_id", "polygon_id")
    edges = explode_segments(polygons.select("polygon_id", "rings"), "rings", ("u1", "v1", "u2", "v2"), "edge")
    return inside.unionByName(_touching(segs, edges, grow, size, ["line_id", "polygon_id"], rows_per_task)).distinct()


def polygons_meet(left: DataFrame, right: DataFrame, size: float, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Distinct ``(left_id, polygon_id)`` of polygons that share a point, borders included.

    ``left`` has ``left_id, rings`` and ``right`` has ``polygon_id, rings``. Edges cross or touch, or a ring of one lies in the other: then its first vertex does.
    """
    outer = lines_in_polygons(left.select(F.col("left_id").alias("line_id"), F.col("rings").alias("lines")), right, size, 0.0, rows_per_task).withColumnRenamed("line_id", "left_id")
    seeds = _first_points(right.withColumnRenamed("polygon_id", "_right"), "_right", "rings")
    held = points_in_polygons(seeds, left.select(F.col("left_id").alias("polygon_id"), "rings"), size, True, 0.0, None, ("x", "y"), rows_per_task)
    return outer.unionByName(held.select(F.col("polygon_id").alias("left_id"), F.col("_right").alias("polygon_id"))).distinct()


def entities_in_areas(entities: DataFrame, members: DataFrame, size: float, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Distinct ``(osm_id, area_id)`` of entities that share a point with any member of an area.

    ``entities``: ``osm_id, x, y`` and ``rings`` (null for points; open parts are lines). ``members``: ``area_id, rings``, any number of rows for an area, as a
    municipality's own border and those of its settlements; where they overlap, an entity still counts once. An entity may lie in several areas.
    """
    m = members.select("area_id", "rings").withColumn("polygon_id", F.monotonically_increasing_id())
    m = stable(m)  # the numbers are met again after two joins
    points = entities.where("rings IS NULL").select("osm_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    hits = points_in_polygons(points, m.select("polygon_id", "rings"), size, True, rows_per_task=rows_per_task).select("osm_id", "polygon_id")
    shapes = entities.where("rings IS NOT NULL").select(F.col("osm_id").alias("left_id"), "rings")
    closed = F.filter("rings", lambda r: (F.size(r) > 3) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)))
    lines = lines_in_polygons(shapes.select(F.col("left_id").alias("line_id"), F.col("rings").alias("lines")), m, size, 0.0, rows_per_task).select(F.col("line_id").alias("osm_id"), "polygon_id")
    around = points_in_polygons(_first_points(m.withColumnRenamed("polygon_id", "_member"), "_member", "rings"), shapes.select(F.col("left_id").alias("polygon_id"), closed.alias("rings")), size, True, rows_per_task=rows_per_task)
    hits = hits.unionByName(lines).unionByName(around.select(F.col("polygon_id").alias("osm_id"), F.col("_member").alias("polygon_id")))
    return hits.join(m.select("polygon_id", "area_id"), "polygon_id").select("osm_id", "area_id").distinct()


def nearest_polygon(points: DataFrame, polygons: DataFrame, start: float, reach: float | None = None, xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Nearest polygon of each point (ties: smaller id) by search radii that grow fourfold from ``start`` until no point is open.

    Each round joins only the points still open, through cells as wide as its radius; points and rounds are written once, since each is read several times. With ``reach`` the search
    ends there and farther points get null; without it the last radius spans all points and edges.
    """
    px, py = F.col(xy[0]).cast("double"), F.col(xy[1]).cast("double")
    edges = explode_segments(polygons.select("polygon_id", "rings"), "rings", ("u1", "v1", "u2", "v2"), "edge")
    points = stable(points)
    open_points, found, radius = points, None, float(start)
    last = reach if reach is not None else _span(points, edges, xy)
    while True:
        pts = open_points.withColumns({"x1": px, "y1": py, "x2": px, "y2": py})
        d = G.point_segment_distance(px, py, F.col("u1"), F.col("v1"), F.col("u2"), F.col("v2"))
        hits = (segment_pairs(pts.select("point_id", *xy, "x1", "y1", "x2", "y2"), edges, radius, 2 * radius)
                .withColumn("distance", d).where(F.col("distance") <= radius)
                .groupBy("point_id").agg(F.min(F.struct("distance", "polygon_id")).alias("n"))
                .select("point_id", F.col("n.polygon_id").alias("polygon_id"), F.col("n.distance").alias("distance")))
        hits = stable(hits)
        found = hits if found is None else found.unionByName(hits)
        open_points = stable(open_points.join(hits.select("point_id"), "point_id", "left_anti"))
        if radius >= last or open_points.isEmpty():
            break
        radius *= 4
    return points.join(found, "point_id", "left")


def _span(points: DataFrame, edges: DataFrame, xy: tuple[str, str]) -> float:
    """Width and height of all points and edges together: no distance is longer."""
    ends = points.select(F.col(xy[0]).cast("double").alias("x"), F.col(xy[1]).cast("double").alias("y")).union(edges.select("u1", "v1")).union(edges.select("u2", "v2"))
    b = ends.agg(F.max("x") - F.min("x"), F.max("y") - F.min("y")).first()
    return (b[0] or 0.0) + (b[1] or 0.0)


def within_or_nearest(points: DataFrame, polygons: DataFrame, size: float, reach: float | None = None, xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """The polygon a point lies in (smaller id on a shared border), else the nearest one; ``distance`` is 0 inside."""
    inside = stable(points_in_polygons(points.select("point_id", *xy), polygons.select("polygon_id", "rings"), size, True, 0.0, None, xy)
                    .groupBy("point_id").agg(F.min("polygon_id").alias("polygon_id")))
    open_points = points.join(inside, "point_id", "left_anti")
    near = nearest_polygon(open_points, polygons, size, reach, xy)
    return points.join(inside, "point_id").withColumn("distance", F.lit(0.0)).unionByName(near)
