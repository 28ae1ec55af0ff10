"""Lines and polygons far too large for all pairs in one row."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from addrweave.operators import cells as C
from addrweave.operators import lines as L
from tests.test_spatial import LINES, even_odd, parts, point_segment


def test_hausdorff_of_twenty_thousand_vertices(spark):
    """A spiral against itself moved by 7 m, with one far vertex: all vertices against all segments would be 4e8 pairs."""
    turn = [(0.5 * k * math.cos(k / 400), 0.5 * k * math.sin(k / 400)) for k in range(20_000)]
    moved = [(x + 7, y) for x, y in turn]
    moved[777] = (moved[777][0] + 90_000.0, moved[777][1])
    df = spark.createDataFrame([("a", 1, parts(turn), parts(moved))], f"k string, p int, lines {LINES}, other_lines {LINES}")
    got = L.hausdorff(df, "k", "p").collect()[0].hausdorff
    far = moved[777]
    want = min(point_segment(*far, s) for s in zip(turn, turn[1:]))
    assert got == pytest.approx(want)


def test_hausdorff_of_odd_lines(spark):
    rows = [("one", 1, parts([(0, 0)]), parts([(3, 4)])), ("same", 1, parts([(0, 0), (9, 0)]), parts([(9, 0), (0, 0)])), ("none", 1, None, parts([(0, 0)])), ("nan", 1, parts([(0, 0), (1, 0)]), parts([(0, 2), (math.nan, 0)])),
            ("far", 1, parts([(0, 0), (1, 0)]), parts([(5_000_000, 0), (5_000_001, 0)]))]
    df = spark.createDataFrame(rows, f"k string, p int, lines {LINES}, other_lines {LINES}")
    got = {r.k: r.hausdorff for r in L.hausdorff(df, "k", "p").collect()}
    assert (got["one"], got["same"], got["far"]) == (5.0, 0.0, 5_000_000.0) and "none" not in got


def test_street_under_five_thousand_partners(spark):
    """Partners of 3 m tile a street of 15 km but for a gap of 120 m; each lies there four times. Stretches are united in blocks of partners."""
    street = [(float(x), 0.0) for x in range(0, 15_001, 500)]
    partners = [(i, parts([(3.0 * (i % 5000), 1.0), (3.0 * (i % 5000) + 3, 1.0)])) for i in range(20_000) if not 6000 <= 3 * (i % 5000) < 6120]
    rows = spark.createDataFrame(partners, f"p int, other_lines {LINES}").withColumns({"k": F.lit("a"), "lines": F.array(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in street]))})
    got = L.covered_by_partners(rows, 30.0, "k").collect()
    assert [r.covered for r in got] == pytest.approx([15_000 - 120])  # flat ends: nothing reaches into the gap


def test_long_way_takes_the_cells_it_passes(spark):
    df = spark.createDataFrame([(0.0, 0.0, 50_000.0, 30_000.0)], "x1 double, y1 double, x2 double, y2 double")
    got = {(r._cx, r._cy) for r in C.explode_along(df, 100.0).collect()}
    assert {(math.floor(t * 5 / 100), math.floor(t * 3 / 100)) for t in range(10_000)} <= got and len(got) < 1000
    rnd = random.Random(3)
    segments = [(i, *(rnd.choice([rnd.uniform(-90, 90), rnd.randrange(-9, 9) * 10.0]) for _ in range(4))) for i in range(60)]
    cells = C.explode_along(spark.createDataFrame(segments, "i int, x1 double, y1 double, x2 double, y2 double"), 10.0, 4.0).collect()
    have = {(r.i, r._cx, r._cy) for r in cells}
    for i, x1, y1, x2, y2 in segments:
        for _ in range(200):
            t = rnd.random()
            x, y = x1 + t * (x2 - x1) + rnd.uniform(-4, 4), y1 + t * (y2 - y1) + rnd.uniform(-4, 4)
            assert (i, math.floor(x / 10), math.floor(y / 10)) in have


def coast(n, radius, seed):
    rnd = random.Random(seed)
    ring = [(round(radius * (1 + rnd.uniform(-0.3, 0.3)) * math.cos(2 * math.pi * k / n)), round(radius * (1 + rnd.uniform(-0.3, 0.3)) * math.sin(2 * math.pi * k / n))) for k in range(n)]
    return [*ring, ring[0]]


def test_hundred_kilometre_polygon(spark):
    """A cell holds the edges that touch it and one bit: edge rows grow with the border's length, not with the polygon's width."""
    ring = coast(500, 50_000.0, 1)
    polys = spark.createDataFrame([(1, parts(ring))], f"polygon_id int, rings {LINES}")
    cells, edges = C.polygon_cells(polys, 1000.0)
    border = sum(math.dist(*s) for s in zip(ring, ring[1:]))
    assert edges.count() < 2.5 * border / 1000 + 4 * len(ring)
    assert cells.where("NOT _whole").select(F.sum(F.size("_edges"))).first()[0] == edges.count()
    rnd = random.Random(2)
    pts = [(i, float(rnd.randrange(-66_000, 66_000)), float(rnd.randrange(-66_000, 66_000))) for i in range(3000)]
    df = spark.createDataFrame(pts, "p int, x double, y double")
    assert {r.p for r in C.points_in_polygons(df, polys, 1000.0).collect()} == {i for i, x, y in pts if even_odd([ring], x, y)}


def test_points_in_line_with_vertices_and_borders(spark):
    """Whole coordinates: points straight above, below and beside vertices, on level edges, at corners of cells."""
    comb = [(0, 0), (70, 0), (70, 50), (60, 50), (60, 10), (50, 10), (50, 50), (40, 50), (40, 10), (30, 10), (30, 50), (20, 50), (20, 10), (10, 10), (10, 50), (0, 50), (0, 0)]
    hole = [(42, 2), (48, 2), (45, 8), (42, 2)]
    polys = spark.createDataFrame([(1, parts(comb, hole)), (2, parts([(0, 0), (30, 30), (60, 0), (30, -30), (0, 0)]))], f"polygon_id int, rings {LINES}")
    pts = [(i, float(i % 74 - 2), float(i // 74 - 32)) for i in range(74 * 86)]
    df = spark.createDataFrame(pts, "p int, x double, y double").repartition(4)

    def on(rings, x, y):
        return any((b[0] - a[0]) * (y - a[1]) == (x - a[0]) * (b[1] - a[1]) and min(a[0], b[0]) <= x <= max(a[0], b[0]) and min(a[1], b[1]) <= y <= max(a[1], b[1])
                   for r in rings for a, b in zip(r, r[1:]))

    shapes = {1: [comb, hole], 2: [[(0, 0), (30, 30), (60, 0), (30, -30), (0, 0)]]}
    for size in (10.0, 7.0, 400.0):
        got = {(r.p, r.polygon_id) for r in C.points_in_polygons(df, polys, size, border=True).collect()}
        strict = {(r.p, r.polygon_id) for r in C.points_in_polygons(df, polys, size, border=False).collect()}
        edge = {(i, k) for i, x, y in pts for k, s in shapes.items() if on(s, x, y)}
        inner = {(i, k) for i, x, y in pts for k, s in shapes.items() if (i, k) not in edge and even_odd(s, x, y)}
        assert strict == inner and got == inner | edge


def test_generated_code_of_line_joins_is_compiled(spark):
    """The JVM only interprets methods of more than 8,000 bytes, which makes a pair of segments many times dearer."""
    line = "array(array(named_struct('x', cast(id AS double), 'y', 0D), named_struct('x', cast(id AS double), 'y', 9D)))"
    lines = spark.range(4).selectExpr("cast(id AS string) AS osm_id", "id % 2 AS muni_id", f"{line} AS lines")
    others = spark.range(4).selectExpr("id AS street_id", "id % 2 AS muni_id", f"{line} AS other_lines")
    rows = lines.crossJoin(others.select("street_id", "other_lines"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for threshold in ("-1", "10000000"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            for df in (L.covered_length(lines, others, 30.0, ["osm_id", "street_id"], scope=["muni_id"]), L.covered_by_partners(rows, 30.0, "street_id")):
                query = df._jdf.queryExecution()
                text = query.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
                sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
                assert sizes and max(sizes) < 8000, sizes
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_generated_code_of_touching_segments_is_compiled(spark):
    line = "array(array(named_struct('x', cast(id AS double), 'y', 0D), named_struct('x', cast(id AS double), 'y', 9D)))"
    lines, polygons = spark.range(4).selectExpr("id AS line_id", f"{line} AS lines"), spark.range(4).selectExpr("id AS polygon_id", f"{line} AS rings")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        query = C.lines_in_polygons(lines, polygons, 500.0)._jdf.queryExecution()
        text = query.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000, sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_segments_near_as_by_hand(spark):
    rng = random.Random(5)
    segs = [tuple(float(rng.randint(0, 12)) for _ in range(8)) for _ in range(400)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(segs)] + [(-1, math.nan, *segs[0][1:]), (-2, None, *segs[0][1:])], "i int, x1 double, y1 double, x2 double, y2 double, u1 double, v1 double, u2 double, v2 double")

    def turn(a, b, p):
        v = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        return (v > 0) - (v < 0)

    for grow in (0.0, 1.37):
        want = set()
        for i, (x1, y1, x2, y2, u1, v1, u2, v2) in enumerate(segs):
            a, b, c, d = (x1, y1), (x2, y2), (u1, v1), (u2, v2)
            ends = min(point_segment(*p, s) for p, s in ((a, (c, d)), (b, (c, d)), (c, (a, b)), (d, (a, b))))
            proper = turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0
            if proper or ends <= grow + 1e-9:
                want.add(i)
        assert {r.i for r in C.segments_near(df, grow, ["i"]).collect()} == want
