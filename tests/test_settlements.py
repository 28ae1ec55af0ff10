"""Tiles of settlements and nearest seeds against plain geometry."""

import math
import random

import pytest

from addrweave.functions import geometry as G
from addrweave.operators.cells import entities_in_areas, polygons_meet
from addrweave.plans import settlements as SE
from tests.test_spatial import LINES, even_odd, parts

# A comb: teeth fall into parts of their own when a bisector cuts across them.
COMB = [(0, 0), (900, 0), (900, 600), (750, 600), (750, 100), (600, 100), (600, 600), (450, 600), (450, 100), (300, 100), (300, 600), (150, 600), (150, 100), (100, 100), (100, 600), (0, 600), (0, 0)]


def area(ring):
    return abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:]))) / 2


def test_concave_municipality(spark):
    rnd = random.Random(5)
    seeds = [(k, rnd.randrange(0, 900), rnd.randrange(0, 600)) for k in range(60)] + [(90, 5, 5), (91, 5, 5)]
    auth = spark.createDataFrame([(1, k, x, y) for k, x, y in seeds] + [(2, 500, 10, 10)], "muni_id int, settl_id int, x long, y long")
    munis = spark.createDataFrame([(1, parts(COMB)), (2, parts(COMB))], f"muni_id int, rings {LINES}")
    rows = SE.settlement_borders(auth, munis).collect()
    tiles = {r.settl_id: [[(p.x, p.y) for p in ring] for ring in r.rings] for r in rows}
    assert len(rows) == 63 and tiles[91] == [] and area(tiles[500][0]) == area(COMB)
    assert sum(area(r) for k, t in tiles.items() if k != 500 for r in t) == pytest.approx(area(COMB))
    assert max(len(t) for t in tiles.values()) > 1  # a tile over several teeth
    for _ in range(1500):
        x, y = rnd.uniform(0, 900), rnd.uniform(0, 600)
        by = sorted((math.hypot(x - u, y - v), k) for k, u, v in seeds if k != 91)
        holders = [k for k, t in tiles.items() if k != 500 and even_odd(t, x, y)]
        if by[1][0] - by[0][0] > 1e-6:
            assert holders == ([by[0][1]] if even_odd([COMB], x, y) else [])


def test_clip_ring_splits():
    ring = [(0, 0), (4, 0), (4, 3), (3, 3), (3, 1), (1, 1), (1, 3), (0, 3)]
    top = SE.clip_ring(ring, 0.0, -1.0, -2.0)  # y >= 2: two towers
    assert sorted(area([*r, r[0]]) for r in top) == [1.0, 1.0] and all(len(r) == 4 for r in top)
    assert [area([*r, r[0]]) for r in SE.clip_ring(ring, 0.0, 1.0, 2.0)] == [6.0]
    assert SE.clip_ring(ring, 0.0, 1.0, -1.0) == [] and SE.clip_ring(ring, 0.0, 1.0, 9.0) == [ring]


def test_nearest_seed(spark):
    rnd = random.Random(8)
    seeds = [(m, m * 100 + k, rnd.uniform(0, 500), rnd.uniform(0, 500)) for m in (1, 2) for k in range(40)] + [(3, 301, 0.0, 0.0), (3, 300, 0.0, 0.0)]
    pts = [(i, 1 + i % 4, rnd.uniform(-3000, 3000), rnd.uniform(-200, 700)) for i in range(400)]
    got = SE.nearest_seed(spark.createDataFrame(pts, "p int, muni_id int, x double, y double"), spark.createDataFrame(seeds, "muni_id int, settl_id long, x double, y double")).collect()
    assert len(got) == 400
    for r in got:
        best = min(((math.hypot(r.x - u, r.y - v), k) for m, k, u, v in seeds if m == r.muni_id), default=(None, None))
        assert (r.nearest_settl_id, r.seed_distance) == (best[1], pytest.approx(best[0]) if best[0] is not None else None)


def test_area_and_centroid(spark):
    far = [(x + 4e6, y + 7e6) for x, y in [(0, 0), (6, 0), (6, 2), (2, 2), (2, 6), (0, 6), (0, 0)]]
    df = spark.createDataFrame([(1, parts(far)), (2, None), (3, [])], f"i int, rings {LINES}")
    got = {r.i: r.c for r in df.select("i", G.area_and_centroid("rings").alias("c")).collect()}
    assert tuple(got[1]) == pytest.approx((20.0, 4e6 + 2.2, 7e6 + 2.2)) and got[2] is None and got[3] is None


def square(x, y, h):
    return [(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)]


def test_polygons_meet(spark):
    hole = [square(500, 500, 400), square(500, 500, 200)]
    right = {1: hole, 2: [square(2000, 0, 5)], 3: [square(-500, 0, 100)]}
    left = {1: [square(500, 500, 50)], 2: [square(500, 500, 250)], 3: [square(120, 500, 5)], 4: [square(2000, 0, 50)], 5: [square(-350, 0, 50)], 6: [square(-349, 0, 50)], 7: [square(9000, 0, 5)], 8: [square(500, 500, 4000)]}
    frame = lambda d, name: spark.createDataFrame([(k, parts(*r)) for k, r in d.items()], f"{name} int, rings {LINES}")
    want = {(2, 1), (3, 1), (4, 2), (5, 3), (8, 1), (8, 2), (8, 3)}  # in the hole: none; touching along a border: met
    for size in (60.0, 1000.0):
        assert {tuple(r) for r in polygons_meet(frame(left, "left_id"), frame(right, "polygon_id"), size).collect()} == want


def test_entities_in_areas(spark):
    members = spark.createDataFrame([(1, parts(square(0, 0, 100))), (1, parts(square(80, 0, 100))), (2, parts(square(400, 0, 100)))], f"area_id int, rings {LINES}")
    rows = [("n1", 50, 0, None), ("n2", 170, 0, None), ("n3", 250, 0, None), ("w1", 240, 0, parts([(150, 0), (350, 0)])), ("w2", 240, 0, parts(square(240, 0, 50))), ("w3", 0, 0, parts(square(200, 0, 900))), ("w4", 240, 0, parts([(210, 5), (290, 5)]))]
    df = spark.createDataFrame(rows, f"osm_id string, x long, y long, rings {LINES}")
    got = sorted(tuple(r) for r in entities_in_areas(df, members, 50.0).collect())
    assert got == [("n1", 1), ("n2", 1), ("w1", 1), ("w1", 2), ("w3", 1), ("w3", 2)]
