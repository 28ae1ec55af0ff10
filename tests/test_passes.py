"""Costly inputs are computed once (or a fixed number of times), not once for each step that reads them."""

from pyspark.sql import functions as F

from addrweave.operators import cells as C
from addrweave.plans import address as A
from addrweave.plans import edits as E
from addrweave.plans import housing as H


def counted(spark, df, column):
    """``df`` with ``column`` led through Python, and how many of its values were computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v
    kind = df.schema[column].dataType
    return df.withColumn(column, F.udf(count, kind)(column)), seen


def test_buildings_to_merge_are_found_once(spark):
    q2 = spark.createDataFrame([(1, "w1", "n1", 3), (1, "w1", "n2", 3), (2, "w2", "n3", 2)], "muni_id long, building_id string, osm_id string, resolution int")
    q2, seen = counted(spark, q2, "resolution")
    tags = spark.createDataFrame([("n1", {"a": "1"}), ("n2", {"a": "2"}), ("w1", {"a": "1"})], "osm_id string, tags map<string,string>")
    rows = {(r.entity_id, r.action, r.new_value) for r in E.move_into_buildings(q2, tags, tags).collect()}
    assert rows == {("w1", "modify", "1;2"), ("n1", "delete", None), ("n2", "delete", None)}
    assert seen.value == 3


def test_far_points_are_not_computed_once_a_round(spark):
    ring = "array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 9D, 'y', 0D), named_struct('x', 9D, 'y', 9D), named_struct('x', 0D, 'y', 9D), named_struct('x', 0D, 'y', 0D)))"
    polygons, passes = spark.range(1).selectExpr("id AS polygon_id", f"{ring} AS rings"), []
    for x in (15.0, 30000.0):
        points, seen = counted(spark, spark.createDataFrame([(1, x, 5.0)], "point_id long, x double, y double"), "x")
        (row,) = C.within_or_nearest(points, polygons, 10.0).collect()
        assert (row.polygon_id, row.distance) == (0, x - 9.0)
        passes.append(seen.value)
    assert passes[0] == passes[1]


def test_communities_are_matched_once(spark):
    addresses, seen = counted(spark, spark.createDataFrame([(1, "a1"), (2, "a2"), (3, None)], "hc_id long, addr_id string"), "addr_id")
    osm = spark.createDataFrame([("w1", "a1"), ("n2", "a1"), ("w3", "a2"), ("w4", "x")], "osm_id string, house_ref string")
    codes = spark.createDataFrame([("w1", 4, "w1"), ("n2", 5, "w9")], "osm_id string, code int, closest string")
    codes, coded = counted(spark, codes, "code")
    rows = {(r.hc_id, r.entities, r.resolution, r.closest_building, r.found_in_map) for r in H.housing_status(addresses, osm, codes).collect()}
    assert rows == {(1, 2, 5, "w9", True), (2, 1, None, None, True), (3, 0, None, None, False)}
    assert (seen.value, coded.value) == (3, 2)


def test_distances_and_number_parts_are_computed_once_a_pair(spark):
    auth = spark.createDataFrame([("a1", 1, "Дуга", "5a", 0.0, 0.0)], "addr_id string, muni_id long, street string, house_no string, x double, y double")
    osm = spark.createDataFrame([("w1", 1, "Дуга", "5a", None, 50.0, 0.0), ("w2", 1, "Дуга", "6", None, 60.0, 0.0)], "osm_id string, muni_id long, street string, house_no string, house_ref string, x double, y double")
    osm = osm.withColumn("rings", F.expr("array(array(named_struct('x', x, 'y', -9D), named_struct('x', x, 'y', 9D)))"))
    pairs, _ = A.scored_pairs(auth, osm)
    assert {(r.osm_id, r.distance, r.matching) for r in pairs.collect()} == {("w1", 50.0, True), ("w2", 60.0, False)}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")
    assert len(plan) == 2
    above, condition = plan[0], plan[1].splitlines()[0]
    assert "lambda" not in condition and "regexp_replace" not in above
