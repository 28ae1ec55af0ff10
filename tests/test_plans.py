from addrweave.options import Options
from addrweave.plans import address as A
from addrweave.plans import buildings as B
from addrweave.plans import edits as E
from registry.address_queries import auth
from registry.world import World

PAIR = "building_id string, b_street string, b_house_no string, b_has_note boolean, osm_id string, muni_id int, street string, house_no string, is_poi boolean, is_simple boolean, has_note boolean"


def leaf(name, building, nodes, want, kind="a", note=False):
    street, number = building
    return name, [(name, street, number, note, f"n{i}", 1, s, h, kind == "p", kind == "a", False) for i, (s, h) in enumerate(nodes)], want


LEAVES = [
    leaf("n1", (None, None), [("А", "1")], B.BUILDING_IS_NODE), leaf("w01", ("А", "1"), [("А", "1")], B.NO_ACTION, "p"), leaf("w02", ("А", "1"), [("А", "2")], B.NOT_MATCHING, "p"),
    leaf("w03", ("А", "1"), [("А", "1")], B.MERGE_ADDRESS), leaf("w04", ("А", None), [("А", "1")], B.MERGE_ADDRESS), leaf("w05", ("А", "2"), [("А", "1")], B.NOT_MATCHING),
    leaf("w06", (None, "1"), [("А", "1")], B.MERGE_ADDRESS), leaf("w07", ("Б", "1"), [("А", "1")], B.NOT_MATCHING), leaf("w08", ("Б", "2"), [("А", "1")], B.MERGE_ADDRESS),
    leaf("w09", ("А", "1"), [("А", "1"), ("А", "1")], B.NO_ACTION, "p"), leaf("w10", ("А", "1"), [("А", "1"), ("А", "1a")], B.REMOVE_FROM_BUILDING, "p"),
    leaf("w11", ("А", "1"), [("А", "1a"), ("А", "1b")], B.NO_ACTION, "p"), leaf("w12", ("А", "1"), [("А", "1a"), ("А", "1a"), ("А", "1b")], B.NOT_MATCHING, "p"),
    leaf("w13", ("А", "1c"), [("А", "1a"), ("А", "1b")], B.NOT_MATCHING, "p"), leaf("w14", ("А", "1"), [("А", "2"), ("А", "2")], B.NOT_MATCHING, "p"), leaf("w15", ("А", "1"), [("А", "2"), ("А", "3")], B.REMOVE_FROM_BUILDING, "p"),
    leaf("w16", ("А", "1"), [("А", "1"), ("А", "1")], B.MERGE_ADDRESS), leaf("w17", ("А", "1"), [("А", "1"), ("А", "1a")], B.NOT_MATCHING), leaf("w18", ("А", "1"), [("А", "1a"), ("А", "1b")], B.NO_ACTION),
    leaf("w19", (None, None), [("А", "1")], B.MERGE_POI, "p"), leaf("w20", (None, None), [("А", "1")], B.MERGE_ADDRESS), leaf("w21", (None, None), [("А", "1"), ("А", "1")], B.COPY_POI_ADDRESS, "p"),
    leaf("w22", (None, None), [("А", "1"), ("А", "2")], B.NO_ACTION, "p"), leaf("w23", (None, None), [("А", "1"), ("А", "1")], B.MERGE_ADDRESS), leaf("w24", (None, None), [("А", "1"), ("А", "2")], B.ATTACH_ADDRESSES),
    leaf("w25", ("А", "1"), [("А", "1")], B.NOTE_PRESENT, "a", True), leaf("w26", ("А", "1"), [("А", "1")], B.NO_ACTION, "p", True), leaf("w27", ("А", "1"), [("А", "1")], B.TOO_COMPLEX, "x"),
    leaf("w28", (None, None), [("А", "1")], B.TOO_COMPLEX, "x", True),
]


def test_every_resolution(spark):
    rows = [r for _, rs, _ in LEAVES for r in rs] + [("w99", None, None, False, "n1", 1, "А", "1", True, False, False), ("w99", None, None, False, "n2", 1, "А", "1", False, True, False)]
    got = {r.building_id: r.resolution for r in B.resolution(B.building_facts(spark.createDataFrame(rows, PAIR))).collect()}
    assert got == {**{n: w for n, _, w in LEAVES}, "w99": B.TOO_COMPLEX}


def test_split_cells_do_not_change_the_match(spark, sf):
    w = World(spark, sf)
    cols = ["addr_id", "conflated_osm_id", "osm_id", "score", "matching"]
    plain = sorted(map(str, A.match_addresses(auth(w), w.map_entity).select(*cols).collect()))
    split = sorted(map(str, A.match_addresses(auth(w), w.map_entity, Options(rows_per_task=7)).select(*cols).collect()))
    assert plain == split
    used = [r.osm_id for r in A.match_addresses(auth(w), w.map_entity).where("osm_id IS NOT NULL").collect()]
    assert len(used) == len(set(used))


def test_apartments_and_alt_names(spark):
    status = spark.createDataFrame([(1, 4, 1, "w1"), (2, 4, 1, "w1"), (3, 4, 2, "w2"), (4, 5, 1, "w3"), (5, 4, 1, "w4"), (6, 4, 1, "w5"), (7, 4, 1, "r6")], "hc_id int, resolution int, entities int, closest_building string")
    b = spark.createDataFrame([("w1", "yes", None), ("w2", "yes", None), ("w3", "apartments", None), ("w4", "construction", "house"), ("w5", "school", None), ("r6", "yes", None)], "osm_id string, building string, construction string")
    got = sorted((r.entity_id, r.tag, r.old_value, r.new_value) for r in E.tag_apartments(status, b).collect())
    assert got == [("w1", "building", "yes", "apartments"), ("w4", "construction", "house", "apartments")]
    cols = ", ".join(f"{c} string, {p}missing boolean, {p}wrong boolean, {p}suggestion string, {p}partial boolean" for p, c, _ in E.ALT_SPELLINGS)
    none = (None, False, False, "", False)
    q8 = spark.createDataFrame([
        ("w1", None, True, False, "22. дивизије", False, *none, *none), ("w2", None, True, False, "~~прве~~ x", True, *none, None, True, False, "~~prve~~ x", True),
        ("w3", None, True, False, "~~друге~~ x", True, *none, *none), ("w4", "a", False, True, "б", False, "в", False, True, "г", False, *none),
        ("w5", "a", False, True, "б", False, *none, *none), ("n6", None, True, False, "б", False, *none, *none), ("w7", "a", False, False, "", False, *none, *none)], f"osm_id string, {cols}")
    rep = spark.createDataFrame([("~~прве~~ x", "Прве x")], "alt_suggestion string, full_name string")
    got = lambda df: sorted((r.entity_id, r.tag, r.new_value) for r in df.collect())
    want = [("w1", "alt_name", "22. дивизије"), ("w2", "alt_name", "Прве x"), ("w2", "alt_name:sr-Latn", "Prve x"), ("w4", "alt_name", "б"), ("w4", "alt_name:sr", "г"), ("w5", "alt_name", "б")]
    assert got(E.fix_alt_names(q8, rep)) == want
    now = spark.createDataFrame([("w1", "N", "new", None, None), ("w2", "N", None, None, "x"), ("w4", "N", "a", "changed", None), ("w5", None, "a", None, None)],
                                "osm_id string, now_name string, now_alt_name string, now_alt_name_sr string, now_alt_name_sr_latn string")
    assert got(E.fix_alt_names(q8, rep, now)) == [("w2", "alt_name", "Прве x"), ("w4", "alt_name", "б")]


def test_new_addresses_in_degrees_and_changes_with_nulls(spark):
    from addrweave.plans import diff as D
    from addrweave.plans import edits as E

    q1 = spark.createDataFrame([("a", None, None, "s", "S", "1", "c", 457000.0, 4960000.0, ""), ("b", None, "n1", "s", "S", "2", "c", 457000.0, 4960000.0, "11000"), ("d", None, None, "s", "S", "3", "c", 457000.0, 4960000.0, "11000")],
                               "addr_id string, conflated_osm_id string, osm_id string, settl_id string, street string, house_no string, street_code string, x double, y double, postcode string")
    rows = E.new_addresses(q1).collect()
    assert {(r.lon, r.lat) for r in rows} == {(20.457361, 44.792006)} or all(20 < r.lon < 21 and 44 < r.lat < 45 and round(r.lon, 6) == r.lon for r in rows)
    assert {r.new_value for r in rows if r.tag == "addr:postcode"} == {"11000"}
    schema = "addr_id string, muni_id int, muni_name string, settl_id int, settl_name string, street_id int, street_name string, house_no string, x double, y double"
    old = spark.createDataFrame([("a", 1, "M", 1, "N", 1, "S", None, 0.0, 0.0), ("b", 1, "M", 1, "N", 1, "S", "1", 0.0, 0.0), ("c", 1, "M", 1, "N", 1, "S", "1", 0.0, 0.0), ("d", 1, "M", 1, "N", 1, "S", "1", 0.0, 0.0)], schema)
    new = spark.createDataFrame([("a", 1, "M", 1, "N", 1, "S", "5", 0.0, 0.0), ("b", 1, "M2", 1, "N", 1, "S", "1", 0.0, 0.0), ("c", 1, "M", 1, "N2", 1, "S", "1", 0.0, 0.0), ("d", 1, "M", 1, "N", 1, "S", "1", 0.0, 0.0)], schema)
    assert {r.addr_id: r.change_type for r in D.diff_addresses(old, new).collect()} == {"a": "changed", "b": "muni_changed", "c": "changed"}
    assert {r.addr_id for r in D.changed_addresses(old, new).collect()} == {"a", "c"} and [r.addr_id for r in D.moved_to_other_muni(old, new, "addr_id").collect()] == ["b"]


def test_tags_become_nulls_and_reach_the_street_join(spark):
    from addrweave.sources import elements as EL

    ways = spark.createDataFrame([("w1", "LineString", {"highway": "residential", "name": ""}), ("w2", "LineString", {"highway": "residential", "name": "Липова"}), ("w3", "Point", {})], "osm_id string, shape string, tags map<string,string>")
    got = {r.osm_id: (r.name, r.street_ref) for r in EL.explode_sides(EL.promote_tags(ways)).collect()}
    assert got == {"w1": (None, None), "w2": ("Липова", None)}
    assert {r.osm_id for r in EL.explode_refs(EL.promote_tags(ways)).collect()} == {"w1", "w2"}
    first = spark.createDataFrame([("a", 1)], "osm_id string, v int")
    assert [(r.osm_id, r.v) for r in EL.union_tiles([first, first.selectExpr("osm_id", "v + 1 AS v")]).collect()] == [("a", 1)]
