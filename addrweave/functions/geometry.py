"""Plane geometry as column expressions.

A point is two doubles ``x, y``. A line or polygon is ``array<array<struct<x,y>>>``: the parts of a line, or the closed
rings of a polygon (holes and further parts alike, told apart by the even-odd rule).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions.text import _col

PARTS = "array<array<struct<x:double,y:double>>>"
_NUM = r"[-+0-9.eE]+"


def parse_wkt_point(wkt: Column | str) -> tuple[Column, Column]:
    """G1: coordinates of ``POINT (x y)``; null for anything else."""
    w = _col(wkt)
    pattern = rf"(?i)^\s*POINT\s*\(\s*({_NUM})\s+({_NUM})\s*\)\s*$"
    return F.regexp_extract(w, pattern, 1).try_cast("double"), F.regexp_extract(w, pattern, 2).try_cast("double")


def parse_wkt_parts(wkt: Column | str) -> Column:
    """G1: parts of LINESTRING, POLYGON, MULTILINESTRING and MULTIPOLYGON; null where the text is neither or a number is bad."""
    w = _col(wkt)
    bodies = F.regexp_extract_all(w, F.lit(r"\(([^()]+)\)"), F.lit(1))
    parts = F.transform(bodies, lambda b: F.transform(F.split(F.trim(b), r"\s*,\s*"), lambda p: F.struct(
        F.try_element_at(F.split(p, r"\s+"), F.lit(1)).try_cast("double").alias("x"),
        F.try_element_at(F.split(p, r"\s+"), F.lit(2)).try_cast("double").alias("y"))))
    bad = F.exists(parts, lambda part: F.exists(part, lambda p: p["x"].isNull() | p["y"].isNull()))
    ok = w.rlike(r"(?i)^\s*(MULTI)?(LINESTRING|POLYGON)") & (F.size(parts) > 0) & ~bad
    return F.when(ok, parts)


def to_wkt_lines(parts: Column | str) -> Column:
    """Text of a line geometry, for CSV sinks."""
    body = F.transform(_col(parts), lambda part: F.concat(F.lit("("), F.array_join(F.transform(
        part, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))), ", "), F.lit(")")))
    return F.when(F.size(body) == 1, F.concat(F.lit("LINESTRING "), body[0])).otherwise(
        F.concat(F.lit("MULTILINESTRING ("), F.array_join(body, ", "), F.lit(")")))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Straight distance."""
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt((dx * dx + dy * dy).cast("double"))


def point_segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance from a point to one segment."""
    dx, dy = x2 - x1, y2 - y1
    len2 = (dx * dx + dy * dy).cast("double")
    t = F.when(len2 == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / F.nullif(len2, F.lit(0.0)))))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def segments(parts: Column | str, of_ends: Callable[[Column, Column], Column] | None = None) -> Column:
    """``array<struct<x1,y1,x2,y2>>`` of all parts, or what ``of_ends`` makes of a segment's two points; a one-point part gives one zero-length segment."""
    of_ends = of_ends or (lambda a, b: F.named_struct(F.lit("x1"), a["x"], F.lit("y1"), a["y"], F.lit("x2"), b["x"], F.lit("y2"), b["y"]))

    def of_part(part: Column) -> Column:
        ends = F.when(F.size(part) > 1, F.slice(part, F.lit(2), F.size(part) - 1)).otherwise(part)
        starts = F.when(F.size(part) > 1, F.slice(part, F.lit(1), F.size(part) - 1)).otherwise(part)
        return F.zip_with(starts, ends, of_ends)
    return F.flatten(F.transform(_col(parts), of_part))


def point_lines_distance(px: Column, py: Column, parts: Column | str) -> Column:
    """Distance from a point to the nearest segment.

    As ``point_segment_distance``, a step at a time: a lambda's text is run as it is written, so what is used again is given a name by a step of its own.
    """
    def lay(a: Column, b: Column) -> Column:
        return F.struct(a["x"].alias("x1"), a["y"].alias("y1"), (b["x"] - a["x"]).alias("dx"), (b["y"] - a["y"]).alias("dy"))

    def miss(s: Column) -> Column:  # from the segment's nearest point
        along = ((px - s["x1"]) * s["dx"] + (py - s["y1"]) * s["dy"]) / F.nullif((s["dx"] * s["dx"] + s["dy"] * s["dy"]).cast("double"), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
        return F.struct(s["x1"].alias("x1"), s["y1"].alias("y1"), s["dx"].alias("dx"), s["dy"].alias("dy"), t.alias("t"))

    def gap(s: Column) -> Column:
        return F.struct((px - (s["x1"] + s["t"] * s["dx"])).alias("x"), (py - (s["y1"] + s["t"] * s["dy"])).alias("y"))

    steps = F.transform(F.transform(segments(parts, lay), miss), gap)
    return F.sqrt(F.array_min(F.transform(steps, lambda e: e["x"] * e["x"] + e["y"] * e["y"])))


def crossings(edges: Column, px: Column, py: Column) -> Column:
    """Number of edges a ray to the right of the point crosses (half-open rule, no division)."""
    def crosses(e: Column) -> Column:
        side = (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])
        return ((e["y1"] > py) != (e["y2"] > py)) & F.when(e["y2"] > e["y1"], side > 0).otherwise(side < 0)
    return F.size(F.filter(edges, crosses))


def on_edge(edges: Column, px: Column, py: Column) -> Column:
    """The point lies on one of the edges."""
    def hit(e: Column) -> Column:
        side = (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])
        return ((side == 0) & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
                & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))
    return F.exists(edges, hit)


def inside_edges(edges: Column, px: Column, py: Column, border: bool) -> Column:
    """Even-odd test over ring edges; ``border`` keeps (intersects) or drops (within) points on an edge."""
    odd = crossings(edges, px, py) % 2 == 1
    return (odd | on_edge(edges, px, py)) if border else (odd & ~on_edge(edges, px, py))


def point_in_polygon(rings: Column | str, px: Column, py: Column, border: bool = True) -> Column:
    """G6 over whole rings."""
    return inside_edges(segments(rings), px, py, border)


def shape_distance(px: Column, py: Column, rings: Column | str, x: Column, y: Column, box: dict[str, Column] | None = None) -> Column:
    """Distance from a point to a shape: 0 inside closed parts, else to the nearest segment; to ``x``, ``y`` where ``rings`` is null.

    Only points in the shape's ``box`` (``xmin`` to ``ymax``, by default that of ``rings``) are tested for lying inside.
    """
    b = box or bounds(rings)
    in_box = (px >= b["xmin"]) & (px <= b["xmax"]) & (py >= b["ymin"]) & (py <= b["ymax"])
    closed = F.filter(_col(rings), lambda r: (F.size(r) > 3) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)))
    inside = F.coalesce(point_in_polygon(closed, px, py), F.lit(False))
    return F.when(_col(rings).isNull(), distance(px, py, x, y)).when(in_box & inside, 0.0).otherwise(point_lines_distance(px, py, rings))


def length(parts: Column | str) -> Column:
    """Length of all parts."""
    return F.aggregate(segments(parts), F.lit(0.0), lambda acc, s: acc + distance(s["x1"], s["y1"], s["x2"], s["y2"]))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area of a closed ring."""
    segs = segments(F.array(ring))
    return F.aggregate(segs, F.lit(0.0), lambda acc, s: acc + (s["x1"] * s["y2"] - s["x2"] * s["y1"])) / 2.0


def area_and_centroid(rings: Column | str) -> Column:
    """Area of all rings together (outer ones and holes turn opposite ways, or there are no holes) and its centre, as a struct ``area, x, y``; null for none.

    Coordinates are taken from the first vertex, so nothing is lost far from the origin.
    """
    r = _col(rings)
    ox, oy = F.get(F.get(r, F.lit(0)), F.lit(0))["x"], F.get(F.get(r, F.lit(0)), F.lit(0))["y"]

    def add(acc: Column, s: Column) -> Column:
        x1, y1, x2, y2 = s["x1"] - ox, s["y1"] - oy, s["x2"] - ox, s["y2"] - oy
        c = x1 * y2 - x2 * y1
        return F.struct((acc["a"] + c).alias("a"), (acc["x"] + (x1 + x2) * c).alias("x"), (acc["y"] + (y1 + y2) * c).alias("y"))

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return F.aggregate(segments(r), zero, add, lambda t: F.when(t["a"] != 0, F.struct((F.abs(t["a"]) / 2.0).alias("area"), (ox + t["x"] / (3.0 * t["a"])).alias("x"), (oy + t["y"] / (3.0 * t["a"])).alias("y"))))


def round_coordinates(parts: Column | str, digits: int) -> Column:
    """Every coordinate rounded."""
    return F.transform(_col(parts), lambda part: F.transform(part, lambda p: F.struct(
        F.bround(p["x"], digits).alias("x"), F.bround(p["y"], digits).alias("y"))))


def thin(parts: Column | str, step: float) -> Column:
    """Vertices snapped to a grid of ``step`` and repeats dropped, for display; rings stay closed."""
    def of_part(part: Column) -> Column:
        snapped = F.transform(part, lambda p: F.struct((F.bround(p["x"] / step) * step).alias("x"), (F.bround(p["y"] / step) * step).alias("y")))
        before = F.concat(F.array(F.struct(F.lit(float("nan")).alias("x"), F.lit(float("nan")).alias("y"))), snapped)
        kept = F.filter(F.arrays_zip(snapped.alias("p"), F.slice(before, F.lit(1), F.size(snapped)).alias("q")),
                        lambda z: (z[F.lit("p")]["x"] != z[F.lit("q")]["x"]) | (z[F.lit("p")]["y"] != z[F.lit("q")]["y"]))
        return F.transform(kept, lambda z: z[F.lit("p")])
    return F.transform(_col(parts), of_part)


def bounds(parts: Column | str) -> Column:
    """Bounding box of one geometry as a struct."""
    pts = F.flatten(_col(parts))
    xs, ys = pts["x"], pts["y"]  # a field of an array of structs: no lambda, so Spark generates code for the whole
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def group_bounds(df: DataFrame, keys: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Bounding box of the points of each group."""
    return df.groupBy(*keys).agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))


def convex_hull(points: Column | str) -> Column:
    """Closed ring of the smallest convex shape around the points (counter-clockwise; two points give a line there and back)."""
    pts = F.array_sort(F.array_distinct(_col(points)))

    def chain(sorted_points: Column) -> Column:
        def add(acc: Column, p: Column) -> Column:
            def drop(a: Column, _: Column) -> Column:  # the last point goes while it makes no left turn
                o, q = F.get(a, F.size(a) - 2), F.get(a, F.size(a) - 1)
                turn = (q["x"] - o["x"]) * (p["y"] - o["y"]) - (q["y"] - o["y"]) * (p["x"] - o["x"])
                return F.when((F.size(a) >= 2) & (turn <= 0), F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a)
            return F.concat(F.aggregate(acc, acc, drop), F.array(p))
        return F.aggregate(sorted_points, F.slice(sorted_points, 1, 0), add)
    low, high = chain(pts), chain(F.reverse(pts))
    return F.concat(F.slice(low, F.lit(1), F.greatest(F.size(low) - 1, F.lit(0))), high)


def way_shape(points: Column | str) -> Column:
    """Point for one vertex, Polygon for a closed way of more than two, else LineString."""
    p = _col(points)
    closed = (F.size(p) > 2) & (F.element_at(p, 1) == F.element_at(p, -1))
    return F.when(F.size(p) == 1, "Point").when(closed, "Polygon").otherwise("LineString")
