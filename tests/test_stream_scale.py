"""What keeps the stream's batches in proportion: stored steps, register tables without versions, many files a batch, distances by steps."""

import math

import pytest
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.plans.address import match_addresses
from addrweave.streaming import incremental as I

POINT = "array<array<struct<x:double,y:double>>>"
MAP = f"osm_id string, muni_id int, street string, house_no string, house_ref string, x double, y double, rings {POINT}"


def test_register_tables_have_no_versions_to_rank(spark, tmp_path):
    rows = spark.range(50).selectExpr("cast(id AS string) AS k", "concat('m_', id % 3) AS block", "false AS deleted")
    log = I.BlockLog(spark, str(tmp_path), "k", copies=False, once=True)
    log.append(rows, -1)
    named = spark.createDataFrame([("7",), ("8",), ("99",)], "k string")
    assert log.current().count() == 50 and sorted(r.k for r in log.current(named=named).collect()) == ["7", "8"]
    plan = log.current()._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Repartition" not in plan


@pytest.mark.parametrize("sent", [I.SENT, 1])
def test_many_blocks_and_names_are_met(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(I, "LISTED", 3)
    monkeypatch.setattr(I, "SENT", sent)
    log = I.BlockLog(spark, str(tmp_path), "k")
    rows = spark.range(40).selectExpr("id AS k", "concat('m_', id) AS block", "false AS deleted")
    log.append(rows, -1)
    log.append(rows.where("k = 5").withColumn("deleted", F.lit(True)), 0)
    assert sorted(r.k for r in log.current(rows.where("k < 9").select("block")).collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert sorted(r.k for r in log.current(rows.where("k < 9").select("block"), 0, rows.where("k > 3").select("k")).collect()) == [4, 5, 6, 7, 8]


def test_all_files_present_make_one_batch(spark, tmp_path):
    """Changes had to be written by one task, since a batch was one file."""
    for i in range(3):
        spark.range(i, i + 1).write.mode("append").parquet(str(tmp_path / "changes"))
    inc = I.IncrementalMatch(spark, None, str(tmp_path / "state"))
    seen = []
    inc.process = lambda df, batch_id: seen.append((batch_id, sorted(r.id for r in df.collect())))
    for _ in range(2):
        inc.run(str(tmp_path / "changes"), spark.range(1).schema, str(tmp_path / "ckpt"), files_per_batch=None).awaitTermination()
        spark.range(9, 11).write.mode("append").parquet(str(tmp_path / "changes"))
    assert seen[0] == (0, [0, 1, 2]) and seen[1] == (1, [9, 10])


def test_entity_that_takes_another_id(spark, tmp_path):
    a = spark.createDataFrame([(f"a{i}", 1, "Ulica", str(i), 10.0 * i, 0.0) for i in range(200)], "addr_id string, muni_id int, street string, house_no string, x double, y double")
    bucket = {r.addr_id: r.b for r in a.select("addr_id", I.bucket_of("addr_id").alias("b")).collect()}
    old = "a0"
    new = next(k for k, b in sorted(bucket.items()) if b == bucket[old] and k != old)  # both lie in one block of the table by ids
    first = [("n1", 1, "Ulica", "1", old, 5.0, 0.0, None), ("n2", 1, "Ulica", "2", None, 9.0, 0.0, None)]
    inc = I.IncrementalMatch(spark, a, str(tmp_path / "state"))
    inc.start(spark.createDataFrame(first, MAP))
    kind = f"change_no long, action string, {MAP}"
    inc.process(spark.createDataFrame([(1, "modify", "n1", 1, "Ulica", "1", new, 5.0, 0.0, None)], kind), 0)
    found = {r.addr_id: r.conflated_osm_id for r in inc.current().collect()}
    assert found[old] is None and found[new] == "n1"
    assert {tuple(r) for r in inc.by_ref.current().select("house_ref", "osm_id").collect()} == {(new, "n1")}
    cols = ["addr_id", "conflated_osm_id", "osm_id", "score"]
    assert sorted(map(str, inc.current().select(*cols).collect())) == sorted(map(str, match_addresses(a, inc.map.current()).select(*cols).collect()))


def test_distance_to_shape_by_steps(spark):
    def away(px, py, x1, y1, x2, y2):
        dx, dy = x2 - x1, y2 - y1
        n = dx * dx + dy * dy
        t = 0.0 if n == 0 else max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / n))
        return math.hypot(px - (x1 + t * dx), py - (y1 + t * dy))

    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 8.0), (3.0, 12.0), (0.0, 0.0)]
    shapes = {"ring": [ring], "line": [ring[:4]], "spot": [[(4.0, 4.0)]], "both": [ring, [(20.0, 0.0), (20.0, 30.0)]], "none": None, "empty": []}
    points = [(5.0, 4.0), (5.0, 0.0), (10.0, 8.0), (-3.0, -4.0), (1.0, 9.0), (19.0, 15.0), (12.5, 7.0)]
    rows = [(n, s, p[0], p[1]) for n, s in shapes.items() for p in points]
    d = spark.createDataFrame(rows, f"n string, rings {POINT}, px double, py double")
    inside = {(5.0, 4.0), (5.0, 0.0), (10.0, 8.0)}
    for r in d.withColumn("d", G.shape_distance(F.col("px"), F.col("py"), "rings", F.lit(1.0), F.lit(2.0))).collect():
        if r.n == "none":
            assert r.d == pytest.approx(math.hypot(r.px - 1, r.py - 2))
        elif r.n == "empty":
            assert r.d is None
        elif r.n in ("ring", "both") and (r.px, r.py) in inside:
            assert r.d == 0.0
        else:
            legs = [(*s, *e) for part in shapes[r.n] for s, e in (zip(part, part[1:]) if len(part) > 1 else [(part[0], part[0])])]
            assert r.d == pytest.approx(min(away(r.px, r.py, *leg) for leg in legs), abs=1e-12)
    text = d.select(G.point_lines_distance(F.col("px"), F.col("py"), "rings").alias("d"))._jdf.queryExecution().analyzed().toString()
    assert text.count("/") == 1  # the nearest point's place is found once, not once for each use


def test_box_of_shape_without_lambdas(spark):
    """With a lambda the whole step ran as interpreted expressions, for every shape and in every batch."""
    shapes = [([[(1.0, 2.0), (5.0, -3.0)], [(9.0, 0.0)]],), ([[], [(4.0, 4.0)]],), ([],), (None,)]
    d = spark.createDataFrame(shapes, f"rings {POINT}").select(G.bounds("rings").alias("b"))
    assert [tuple(r.b) for r in d.collect()] == [(1.0, -3.0, 9.0, 2.0), (4.0, 4.0, 4.0, 4.0), (None,) * 4, (None,) * 4]
    assert "lambda" not in d._jdf.queryExecution().analyzed().toString()
