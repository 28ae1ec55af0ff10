import pytest
from pyspark.sql import functions as F

from addrweave.plans.address import match_addresses
from addrweave.streaming.incremental import MAP_COLUMNS, BlockLog, IncrementalMatch
from registry.address_queries import auth
from registry.world import World

POINT = "array<array<struct<x:double,y:double>>>"


def rows(df):
    cols = ["addr_id", "conflated_osm_id", "conflated_distance", "osm_id", "osm_street", "distance", "score", "matching"]
    return sorted(map(str, df.select(*cols).collect()))


def folders_read(df):
    """Folders (block and batch) that the scan opened after pruning."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numPartitions").value()


def test_stream_equals_batch(spark, sf, tmp_path):
    w = World(spark, sf)
    a, full = auth(w).persist(), w.map_entity.select(*MAP_COLUMNS, "entity_key", "status").persist()
    first = full.where("status <> 'P'").select(*MAP_COLUMNS)
    moved = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 60).alias("x"), p["y"].alias("y"))))
    changes = [
        full.where("status = 'P' AND entity_key < 800").select(F.col("entity_key").alias("change_no"), F.lit("create").alias("action"), *MAP_COLUMNS),
        full.where("entity_key % 9 = 0").select(F.col("entity_key").alias("change_no"), F.lit("modify").alias("action"), "osm_id", "muni_id", "street",
                                                F.lit("7").alias("house_no"), F.lit(None).cast("string").alias("house_ref"), (F.col("x") + 60).alias("x"), "y", moved.alias("rings")),
        full.where("entity_key % 13 = 0").select(F.col("entity_key").alias("change_no"), F.lit("delete").alias("action"), *MAP_COLUMNS),
    ]
    path = str(tmp_path / "changes")
    for c in changes:
        c.coalesce(1).write.mode("append").parquet(path)
    inc = IncrementalMatch(spark, a, str(tmp_path / "state"), block=500.0)
    inc.start(first)
    q = inc.run(path, changes[0].schema, str(tmp_path / "ckpt"), files_per_batch=1)
    q.awaitTermination(400)
    assert q.exception() is None
    state = inc.map.current()
    assert state.count() == inc.by_id.current().count()
    assert rows(inc.current()) == rows(match_addresses(a, state))
    assert inc.analysis.versions().where("batch = 2").count() < a.count()
    assert rows(inc.analysis.compact(str(tmp_path / "small")).current()) == rows(inc.current())


@pytest.fixture
def two_places(spark, tmp_path):
    """Addresses and entities in two far corners of one municipality."""
    a = spark.createDataFrame([(f"a{i}", 1, "Ulica", str(i % 9), float(i % 3) * 90, float(i) * 5) for i in range(30)]
                              + [(f"b{i}", 1, "Ulica", str(i % 9), 90_000.0, 50_000.0 + i) for i in range(30)], "addr_id string, muni_id int, street string, house_no string, x double, y double")
    m = spark.createDataFrame([(f"n{i}", 1, "Ulica", str(i % 9), None, float(i % 3) * 90, float(i) * 5, None) for i in range(10)]
                              + [("w1", 1, "Ulica", "3", None, 90_000.0, 50_000.0, [[(90_000.0, 50_000.0), (93_000.0, 50_000.0)]]), ("n90", 1, "Ulica", "4", "b3", 90_000.0, 50_000.0, None)],
                              f"osm_id string, muni_id int, street string, house_no string, house_ref string, x double, y double, rings {POINT}")
    inc = IncrementalMatch(spark, a, str(tmp_path / "state"))
    inc.start(m)
    return inc, a


def test_batch_reads_and_writes_touched_blocks_only(spark, two_places):
    inc, a = two_places
    assert folders_read(inc.map.versions()) == 3 and folders_read(inc.addresses.versions()) == 2  # the long way lies in two blocks
    change = spark.createDataFrame([(1, "modify", "n2", 1, "Ulica", "5", None, 150.0, 20.0, None)],
                                   f"change_no long, action string, osm_id string, muni_id int, street string, house_no string, house_ref string, x double, y double, rings {POINT}")
    seen = []
    for log in (inc.map, inc.addresses):
        def spy(blocks=None, before=None, real=log.versions):
            out = real(blocks, before)
            seen.append(folders_read(out))
            return out
        log.versions = spy
    inc.process(change, 0)
    del inc.map.versions, inc.addresses.versions
    assert seen == [1, 2, 1]  # addresses near the change, the map as it was and as it is, addresses near the entities
    assert {r[0] for r in inc.map.versions().where("batch = 0").select("block").distinct().collect()} == {"1_0_0"}
    assert all(r.addr_id.startswith("a") for r in inc.analysis.versions().where("batch = 0").collect())
    assert rows(inc.current()) == rows(match_addresses(a, inc.map.current()))
    inc.process(change, 0)  # a replay
    assert rows(inc.current()) == rows(match_addresses(a, inc.map.current()))
    gone = change.withColumns({"osm_id": F.lit("w1"), "action": F.lit("delete")})
    inc.process(gone, 1)
    assert "w1" not in {r.osm_id for r in inc.map.current().collect()}
    assert rows(inc.current()) == rows(match_addresses(a, inc.map.current()))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    log = BlockLog(spark, str(tmp_path), "k")
    kind = "k int, v string, block string, deleted boolean"
    log.append(spark.createDataFrame([(1, "a", "x", False), (1, "a", "y", False), (2, "b", "x", False)], kind), -1)
    for _ in range(2):
        log.append(spark.createDataFrame([(1, "c", "y", False), (1, "a", "x", True), (2, "b", "x", True)], kind), 0)
    assert [tuple(r) for r in log.current().collect()] == [(1, "c")]
    assert {tuple(r) for r in log.current(before=0).collect()} == {(1, "a"), (2, "b")}
    assert {tuple(r) for r in log.current(spark.createDataFrame([("x",)], "block string"), 0).collect()} == {(1, "a"), (2, "b")}


def test_many_blocks_lie_in_few_folders(spark, tmp_path):
    """A country's blocks are tens of thousands; a folder and file for each in every batch took most of the time."""
    log = BlockLog(spark, str(tmp_path), "k")
    rows = spark.range(600).selectExpr("id AS k", "concat('m_', id) AS block", "false AS deleted")
    log.append(rows, -1)
    assert len([p for p in tmp_path.iterdir() if p.is_dir()]) <= 64
    assert sorted(r.k for r in log.current(rows.where("k < 5").select("block")).collect()) == [0, 1, 2, 3, 4]
    assert log.current().count() == 600
