import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.functions import projection as P
from addrweave.operators import cells as C
from addrweave.operators import lines as L
from addrweave.operators import ranking as R
from addrweave.operators.skew import skew_join, split_hot

LINES = "array<array<struct<x:double,y:double>>>"


def parts(*ps):
    return [[{"x": float(x), "y": float(y)} for x, y in p] for p in ps]


def point_segment(px, py, s):
    (x1, y1), (x2, y2) = s
    d2 = (x2 - x1) ** 2 + (y2 - y1) ** 2
    t = 0 if d2 == 0 else max(0, min(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / d2))
    return math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1))


@pytest.mark.parametrize("rows_per_task", [500_000, 5])
def test_radius_pairs_equal_brute_force(spark, rows_per_task):
    rnd = random.Random(1)
    left = [(i, rnd.randrange(3), rnd.randrange(-600, 600), rnd.randrange(-600, 600)) for i in range(60)] + [(100 + i, 0, 10, 10) for i in range(20)]
    right = [(i, rnd.randrange(3), rnd.randrange(-600, 600), rnd.randrange(-600, 600)) for i in range(80)] + [(100 + i, 0, 0, 0) for i in range(20)]
    l, r = spark.createDataFrame(left, "a int, m int, x long, y long"), spark.createDataFrame(right, "b int, m int, mx long, my long")
    got = [tuple(p) for p in C.radius_pairs(l, r, 200, ["m"], rows_per_task=rows_per_task)[0].select("a", "b").collect()]
    want = [(a, b) for a, m, x, y in left for b, n, u, v in right if m == n and math.hypot(x - u, y - v) <= 200]
    assert sorted(got) == sorted(want)


def test_hot_keys_are_split(spark):
    left, right = spark.range(200).selectExpr("id", "IF(id < 150, 7, id) AS k"), spark.range(40).selectExpr("id AS rid", "IF(id < 25, 7, id) AS k")
    l2, r2, keys = split_hot(left, right, ["k"], 10)
    assert keys == ["k", "_bl", "_br"]
    j = l2.join(r2, keys)
    assert j.count() == left.join(right, "k").count() == j.select("id", "rid").distinct().count()
    assert l2.where("k = 7").select("_bl").distinct().count() == 15 and r2.where("k = 7").select("_br").distinct().count() == 3
    one = right.dropDuplicates(["k"])
    assert sorted(map(str, skew_join(left, one, ["k"], "left", 10).collect())) == sorted(map(str, left.join(one, "k", "left").collect()))


def even_odd(rings, px, py):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                inside = not inside
    return inside


def test_points_in_polygons(spark):
    outer, hole, small = [(0, 0), (1000, 0), (1000, 1000), (500, 600), (0, 1000), (0, 0)], [(200, 200), (400, 200), (400, 400), (200, 400), (200, 200)], [(2000, 0), (2100, 50), (2000, 100), (2000, 0)]
    polys = spark.createDataFrame([(1, parts(outer, hole)), (2, parts(small))], f"polygon_id int, rings {LINES}")
    rnd = random.Random(2)
    pts = [(i, rnd.uniform(-100, 2200), rnd.uniform(-100, 1100)) for i in range(400)]
    df = spark.createDataFrame(pts, "p int, x double, y double")
    for size in (50.0, 170.0, 5000.0):
        got = {tuple(r) for r in C.points_in_polygons(df, polys, size).select("p", "polygon_id").collect()}
        want = {(i, n) for i, x, y in pts for n, rings in ((1, [outer, hole]), (2, [small])) if even_odd(rings, x, y)}
        assert got == want
    edge = spark.createDataFrame([(1, 500.0, 0.0), (2, 0.0, 0.0), (3, 300.0, 200.0), (4, 100.0, 100.0)], "p int, x double, y double")
    assert {r.p for r in C.points_in_polygons(edge, polys, 100.0, border=True).collect()} == {1, 2, 3, 4}
    assert {r.p for r in C.points_in_polygons(edge, polys, 100.0, border=False).collect()} == {4}
    near = spark.createDataFrame([(1, -99.0, 500.0), (2, -101.0, 500.0), (3, 300.0, 300.0)], "p int, x double, y double")
    assert {r.p for r in C.points_in_polygons(near, polys, 150.0, grow=100.0).collect()} == {1, 3}


def test_within_or_nearest(spark):
    polys = spark.createDataFrame([(1, parts([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)])), (2, parts([(100, 0), (110, 0), (110, 10), (100, 10), (100, 0)]))], f"polygon_id int, rings {LINES}")
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 40.0, 5.0), (3, 70.0, 5.0), (4, 55.0, 5.0), (5, 9000.0, 0.0)], "point_id int, x double, y double")
    got = {r.point_id: (r.polygon_id, r.distance) for r in C.within_or_nearest(pts, polys, 10.0).collect()}
    assert got == {1: (1, 0.0), 2: (1, 30.0), 3: (2, 30.0), 4: (1, 45.0), 5: (2, 8890.0)}
    assert {r.point_id for r in C.within_or_nearest(pts, polys, 10.0, 2000.0).collect() if r.polygon_id is None} == {5}


def test_lines_in_polygons(spark):
    polys = spark.createDataFrame([(1, parts([(0, 0), (100, 0), (100, 100), (0, 100), (0, 0)]))], f"polygon_id int, rings {LINES}")
    ls = [(1, parts([(-50, 50), (150, 50)])), (2, parts([(10, 10), (20, 20)])), (3, parts([(130, 0), (130, 100)])), (4, parts([(400, 0), (500, 0)])), (5, parts([(100, 50), (200, 50)]))]
    df = spark.createDataFrame(ls, f"line_id int, lines {LINES}")
    assert {r.line_id for r in C.lines_in_polygons(df, polys, 40.0).collect()} == {1, 2, 5}
    assert {r.line_id for r in C.lines_in_polygons(df, polys, 40.0, grow=30.0).collect()} == {1, 2, 3, 5}


def covered(line, others, r, flat):
    total, steps = 0.0, 4000
    for a, b in zip(line, line[1:]):
        n = math.hypot(b[0] - a[0], b[1] - a[1])
        hits = 0
        for i in range(steps):
            t = (i + 0.5) / steps
            p = (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1]))
            hits += any(near(p, o, r, flat) for o in others)
        total += n * hits / steps
    return total


def near(p, line, r, flat):
    for k, s in enumerate(zip(line, line[1:])):
        (x1, y1), (x2, y2) = s
        if point_segment(*p, s) <= r:
            along = ((p[0] - x1) * (x2 - x1) + (p[1] - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)
            if not flat or not ((along < 0 and k == 0) or (along > 1 and k == len(line) - 2)):
                return True
    return False


def test_covered_length_agrees_with_sampling(spark):
    rnd = random.Random(3)

    def line():
        x, y = rnd.uniform(0, 200), rnd.uniform(0, 200)
        pts = [(x, y)]
        for _ in range(rnd.randrange(1, 4)):
            x, y = x + rnd.uniform(-120, 120), y + rnd.uniform(-120, 120)
            pts.append((x, y))
        return pts
    a, b = [line() for _ in range(5)], [line() for _ in range(5)]
    left = spark.createDataFrame([(i, parts(p)) for i, p in enumerate(a)], f"l int, lines {LINES}")
    right = spark.createDataFrame([(i, parts(p)) for i, p in enumerate(b)], f"r int, other_lines {LINES}")
    got = {(r.l, r.r): r.covered for r in L.covered_length(left, right, 30, ["l", "r"], size=64.0).collect()}
    for i, p in enumerate(a):
        for j, o in enumerate(b):
            assert got.get((i, j), 0.0) == pytest.approx(covered(p, [o], 30, False), abs=0.3)
    rows = left.crossJoin(right)
    flat = {r.l: r.covered for r in L.covered_by_partners(rows, 30, "l").collect()}
    for i, p in enumerate(a):
        assert flat.get(i, 0.0) == pytest.approx(covered(p, b, 30, True), abs=0.4)
    far = {r.l: r.hausdorff for r in L.hausdorff(rows, "l", "r").collect()}
    for i, p in enumerate(a):
        one = max(min(point_segment(*v, s) for o in b for s in zip(o, o[1:])) for v in p)
        two = max(min(point_segment(*v, s) for s in zip(p, p[1:])) for o in b for v in o)
        assert far[i] == pytest.approx(max(one, two))


def test_rings(spark):
    square = [(0, 0), (100, 0), (100, 100), (0, 100), (0, 10)]
    cases = [(1, parts(square), True), (2, parts([(0, 0), (100, 0)]), False), (3, parts([(0, 0), (100, 0)], [(100, 105), (100, 5)], [(0, 3), (0, 100), (95, 105)]), True),
             (4, parts([(0, 0), (100, 0)], [(500, 0), (600, 0)]), False), (5, parts(*[square] * 100), False)]
    df = spark.createDataFrame([c[:2] for c in cases], f"i int, lines {LINES}")
    assert {r.i: r.ring for r in df.select("i", L.is_ring("lines").alias("ring")).collect()} == {c[0]: c[2] for c in cases}


def test_rings_of_many_parts(spark):
    """Parts of a closed street in any order and direction; an arc and a street with a hole in it are no rings."""
    from addrweave.plans.streets import ring_streets

    def street(n, of, seed, gap=False):
        at = lambda k: (2000 * math.cos(2 * math.pi * k / of), 2000 * math.sin(2 * math.pi * k / of))
        rnd = random.Random(seed)
        out = [[at(k), at(k + 1)][:: rnd.choice((1, -1))] for k in range(n) if not gap or k not in (40, 90)]
        rnd.shuffle(out)
        return parts(*out)

    rows = [("a", street(120, 120, 1)), ("b", street(300, 300, 2)), ("c", street(120, 240, 3)), ("d", street(120, 120, 4, True)), ("e", street(99, 99, 5))]
    got = {r.street_code: r.ring for r in ring_streets(spark.createDataFrame(rows, f"street_code string, lines {LINES}")).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False, "e": True}
    for seed in range(20):  # both ways of chaining agree
        c = np.array([[q[0][0], q[0][1], q[1][0], q[1][1], math.dist(*q)] for q in ([(random.Random(seed * 99 + 2 * k + e).uniform(0, 60), random.Random(seed * 77 + 2 * k + e).uniform(0, 60)) for e in (0, 1)] for k in range(9))])
        assert L._closes(c) == L._closes_long(c)


def test_wkt(spark):
    rows = [("POINT (20.5 44.25)",), ("LINESTRING (0 0, 3 4)",), ("MULTIPOLYGON (((0 0,1 0,1 1,0 0)),((5 5, 6 5, 6 6, 5 5)))",), ("POINT (x y)",), (None,)]
    df = spark.createDataFrame(rows, "w string").repartition(1)
    x, y = G.parse_wkt_point("w")
    out = df.select(x.alias("x"), y.alias("y"), F.size(G.parse_wkt_parts("w")).alias("n"), G.length(G.parse_wkt_parts("w")).alias("len")).collect()
    assert (out[0].x, out[0].y) == (20.5, 44.25) and out[3].x is None and out[4].x is None
    assert out[1].len == 5.0 and out[2].n == 2


def test_projections(spark):
    pts = [(20.4573, 44.8178), (18.9, 42.3), (22.9, 46.1), (15.98, 45.81)]
    df = spark.createDataFrame(pts, "lon double, lat double").repartition(1)
    east = spark.createDataFrame([(21.5, 45.0)], "lon double, lat double").select(*P.to_utm(F.col("lon"), F.col("lat"))).collect()[0]
    a, c = math.radians(0.5) * math.cos(math.radians(45)), 0.0033697485  # second-order series for a point near the central meridian
    assert east[0] == pytest.approx(500000 + 0.9996 * 6388838.2902 * (a + c * a**3 / 6), abs=0.01)
    for to, back in ((P.to_utm, P.from_utm), (P.to_laea, P.from_laea)):
        x, y = to(F.col("lon"), F.col("lat"))
        e = df.select("lon", "lat", x.alias("x"), y.alias("y"))
        lon, lat = back(F.col("x"), F.col("y"))
        for r in e.select("lon", "lat", lon.alias("lon2"), lat.alias("lat2")).collect():
            assert abs(r.lon - r.lon2) < 9e-9 and abs(r.lat - r.lat2) < 9e-9  # under a millimetre
    mid = spark.createDataFrame([(10.0, 52.0)], "lon double, lat double").select(*P.to_laea(F.col("lon"), F.col("lat"))).collect()[0]
    assert (round(mid[0], 3), round(mid[1], 3)) == (4321000.0, 3210000.0)
    cm = spark.createDataFrame([(21.0, 0.0)], "lon double, lat double").select(*P.to_utm(F.col("lon"), F.col("lat"))).collect()[0]
    assert (round(cm[0], 6), round(cm[1], 6)) == (500000.0, 0.0)


def test_row_numbers_span_tasks(spark):
    df = spark.range(1000).selectExpr("IF(id % 10 < 7, 'hot', CAST(id % 10 AS STRING)) AS g", "(id * 7919) % 1009 AS v", "id")
    got = {r.id: r.n for r in R.row_numbers(df, ["g"], ["v", "id"], "n").collect()}
    for g in {r.g for r in df.collect()}:
        rows = sorted((r.v, r.id) for r in df.where(F.col("g") == g).collect())
        assert [got[i] for _, i in rows] == list(range(1, len(rows) + 1))


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = R.keep_first(df, ["k"], [F.desc("v")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_cells_are_split_by_pairs(spark):
    """20,000 x 20,000 rows of one key could give 4e8 pairs in one task: they are spread over blocks, each row once on its own side."""
    from addrweave.operators.skew import PAIR_ROWS, split_hot

    left = spark.range(20_000).selectExpr("id AS a", "1 AS k").unionByName(spark.range(5).selectExpr("id AS a", "2 AS k"))
    right = spark.range(20_000).selectExpr("id AS b", "1 AS k").unionByName(spark.range(5).selectExpr("id AS b", "2 AS k"))
    l2, r2, keys = split_hot(left, right, ["k"])
    assert keys == ["k", "_bl", "_br"]
    sizes = l2.groupBy(*keys).count().join(r2.groupBy(*keys).count().withColumnRenamed("count", "other"), keys)
    rows = sizes.where("k = 1").collect()
    assert len(rows) == 4 and all(r["count"] < 1.1 * PAIR_ROWS and r["other"] < 1.1 * PAIR_ROWS for r in rows)
    assert sum(r["count"] * r["other"] for r in rows) == 20_000**2
    few = split_hot(left.where("a < 9"), right.where("b < 9"), ["k"])
    assert few[2] == ["k"] and few[0].join(few[1], few[2]).count() == 81 + 25


def test_shape_pairs_against_plain_distances(spark):
    from addrweave.operators.cells import shape_pairs

    rnd = random.Random(7)
    pts = [(1, i, rnd.uniform(0, 900), rnd.uniform(0, 900)) for i in range(60)]
    shapes, square = [], {}
    for j in range(40):
        x, y, h = rnd.uniform(0, 900), rnd.uniform(0, 900), rnd.choice([0, 5, 150])
        ring = [(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)]
        shapes.append((1, j, x, y, parts(ring) if h else None))
        square[j] = (x, y, h)
    df = spark.createDataFrame(shapes, f"scope int, j int, mx double, my double, rings {LINES}")
    got, _ = shape_pairs(spark.createDataFrame(pts, "scope int, i int, x double, y double"), df, 60.0, ["scope"])
    want = {}
    for _, i, px, py in pts:
        for j, (x, y, h) in square.items():
            d = math.hypot(max(abs(px - x) - h, 0), max(abs(py - y) - h, 0))
            if d <= 60:
                want[i, j] = d
    rows = got.collect()
    assert len(rows) == len(want) and all(abs(want[r.i, r.j] - r.distance) < 1e-9 for r in rows)
