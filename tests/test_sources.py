import pytest
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.functions import projection as P
from addrweave.operators import rollup as RU
from addrweave.plans import mapping as M
from addrweave.sources import elements as E
from addrweave.sources import register as RG
from addrweave.sources import sinks as K

HEAD = "kucni_broj_id,kucni_broj,opstina_maticni_broj,opstina_ime,opstina_ime_lat,naselje_maticni_broj,naselje_ime,ulica_maticni_broj,ulica_ime,vrsta_stanja,retired,geometry\n"


def test_load_addresses(spark, tmp_path):
    row = "{i},{n},70017,БАЧКА ТОПОЛА,Bačka Topola,001,НАСЕЉЕ,0700170001,ГЛАВНА,{s},{r},{g}\n"
    point = "POINT (457102 4962982)"
    (tmp_path / "backatopola.csv").write_text(HEAD + row.format(i="01", n="1", s="АКТИВАН", r="", g=point) + row.format(i="02", n="2", s="УГАШЕН", r="", g=point)
                                              + row.format(i="03", n="3", s="АКТИВАН", r="2020", g=point) + row.format(i="04", n="4", s="АКТИВАН", r="", g="POINT EMPTY"), encoding="utf-8")
    (tmp_path / "drugi.csv").write_text(HEAD + row.format(i="05", n="5", s="АКТИВАН", r="", g=point), encoding="utf-8")
    got = RG.load_addresses(spark, str(tmp_path)).collect()
    assert [r.addr_id for r in got] == ["01"]
    assert got[0].lon == pytest.approx(20.457, abs=0.01) and got[0].lat == pytest.approx(44.82, abs=0.01)
    with pytest.raises(ValueError):
        RG.load_streets(spark, str(tmp_path))


def test_load_streets_and_split(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "nis.csv").write_text('opstina_ime,opstina_ime_lat,naselje_maticni_broj,naselje_ime,ulica_maticni_broj,ulica_ime,geometry\nНИШ,Niš,1,Н,71,А,"LINESTRING (0 0, 3 4)"\nНИШ,Niš,1,Н,72,Б,bad\n', encoding="utf-8")
    got = RG.load_streets(spark, str(tmp_path / "in"))
    assert [r.street_code for r in got.collect()] == ["71"]
    RG.split_by_muni(got.withColumn("muni_id", F.lit("9")), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("muni_id = 9").count() == 1


XML = """<?xml version="1.0"?><base:SpatialDataSet xmlns:base="b" xmlns:au="a" xmlns:gml="g" xmlns:gn="n" xmlns:gmd="d" xmlns:xlink="x">
{units}</base:SpatialDataSet>"""
UNIT = """<base:member><au:AdministrativeUnit gml:id="{gid}"><au:nationalCode>{code}</au:nationalCode>
<au:inspireId><base:Identifier><base:localId>{lid}</base:localId></base:Identifier></au:inspireId>
<au:nationalLevelName><gmd:LocalisedCharacterString>{kind}</gmd:LocalisedCharacterString></au:nationalLevelName>
<au:name><gn:GeographicalName><gn:spelling><gn:SpellingOfName><gn:text>{name}</gn:text></gn:SpellingOfName></gn:spelling></gn:GeographicalName></au:name>
<au:upperLevelUnit xlink:href="#{up}" xlink:title="{title}"/>
<au:geometry><gml:MultiSurface>{members}</gml:MultiSurface></au:geometry></au:AdministrativeUnit></base:member>"""
MEMBER = "<gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>{p}</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></gml:surfaceMember>"


def test_admin_units(spark, tmp_path):
    units = [UNIT.format(gid="g1", code="0042", lid="L1", kind="Naselje", name="Selo", up="5835", title="Privlaka", members=MEMBER.format(p="45 15 45 16 46 16 45 15")),
             UNIT.format(gid="g2", code="0000", lid="L2", kind="Naselje", name="Dva", up="7", title="Sedam", members=MEMBER.format(p="1 2 3 4 5 6 1 2") * 2),
             UNIT.format(gid="g3", code="5835", lid="L3", kind="Jedinica lokalne samouprave", name="Privlaka", up="1", title="Z", members=MEMBER.format(p="1 2 3 4 5 6 1 2"))]
    f = tmp_path / "au.xml"
    f.write_text(XML.format(units="".join(units)))
    got = {r.inspire_id: r for r in RG.load_admin_units(spark, str(f), "Naselje").collect()}
    assert (got["L1"].code, got["L1"].name, got["L1"].parent_id, got["L1"].parent_name) == ("42", "Selo", "5835", "Općina Privlaka")
    assert [(p.x, p.y) for p in got["L1"].rings[0]][:2] == [(15.0, 45.0), (16.0, 45.0)]
    assert got["L2"].code == "0" and len(got["L2"].rings) == 2
    muni = RG.load_admin_units(spark, str(f), RG.MUNICIPALITY_TYPE, id_from_gml=True).collect()
    assert [(m.inspire_id, m.name) for m in muni] == [("g3", "Općina Privlaka")]


def test_elements(spark):
    nodes = spark.createDataFrame([(i, float(x), float(y), t) for i, x, y, t in ((1, 0, 0, {}), (2, 4, 0, {}), (3, 4, 4, {}), (4, 1, 1, {"addr:housenumber": "5", "addr:place": "Село", "addr:street": ""}), (5, 2, 2, {"x": "y"}))],
                                  "id long, lon double, lat double, tags map<string,string>")
    ways = spark.createDataFrame([(10, [1, 2, 3, 1], {"building": "yes"}), (11, [1, 2], {"building": ""}), (12, [4], {}), (13, [1, 99], {})], "id long, nodes array<long>, tags map<string,string>")
    rels = spark.createDataFrame([(20, [("w", 10, "outer"), ("n", 1, "outer"), ("w", 77, "inner")], {"building": "yes"}), (21, [("w", 11, "outer")], {})],
                                 "id long, members array<struct<type:string,ref:long,role:string>>, tags map<string,string>")
    assert {r.osm_id for r in E.scan_entities(nodes, ways, rels, ["building"]).collect()} == {"w10", "r20"}
    one = E.scan_entities(nodes, ways, rels, ["addr:housenumber"], only_nodes=True).collect()
    assert [(r.osm_id, r.street, r.house_no) for r in one] == [("n4", "Село", "5")]
    geoms, lost = E.assemble_ways(ways, nodes)
    assert {r.id: r["shape"] for r in geoms.collect()} == {10: "Polygon", 11: "LineString", 12: "Point"}
    assert [tuple(r) for r in lost.collect()] == [(13, 99)]
    r = {x.id: x for x in E.assemble_relations(rels, geoms).collect()}
    assert len(r[20].rings) == 1 and not r[20].all_open and r[21].all_open and len(r[21].rings[0]) == 3 and r[21].lines == []
    assert E.union_tiles([nodes.selectExpr("concat('n', id) AS osm_id")] * 2).count() == 5


def test_sides(spark):
    ref = "ref:RS:ulica"
    rows = [("w1", {"name": "А", ref + ":left": "1", ref + ":right": "2", "name:left": "Л", "name:left:sr": "ЛС"}), ("w2", {ref + ":left": "1", ref + ":right": "1"}), ("w3", {ref: "7;8", "name": "Б"}), ("w4", {"name": "В"})]
    d = spark.createDataFrame(rows, "osm_id string, tags map<string,string>").withColumn("shape", F.lit("LineString"))
    got = sorted(((r.osm_id, r.street_ref, r.name, r.name_sr) for r in E.explode_sides(E.promote_tags(d)).collect()), key=str)
    assert got == [("w1", "1", "Л", "ЛС"), ("w1", "2", "А", None), ("w3", "7", "Б", None), ("w3", "8", "Б", None), ("w4", None, "В", None)]
    assert E.explode_refs(spark.createDataFrame([("1;2",)], "street_ref string")).count() == 2


def test_guards(spark):
    df = spark.createDataFrame([(1,), (2,)], "m int")
    assert RU.require_complete(df, "m", 2).count() == 2
    with pytest.raises(Exception, match="expected at least 3"):
        RU.require_complete(df, "m", 3).collect()
    with pytest.raises(Exception, match="blank name"):
        M.sorted_curated(spark.createDataFrame([("А", " ")], "rgz_name string, name string")).collect()
    sheet = spark.createDataFrame([("Б", "б", "-"), ("А", "a", "а"), ("В", "", ""), ("", "x", "y")], "rgz string, name string, ispravka string")
    assert [tuple(r) for r in RG.reshape_sheet(sheet).collect()] == [("А", "а"), ("Б", "б")]


def test_sinks(spark, tmp_path):
    ring = [[{"x": 1.23456, "y": 2.0}, {"x": 3.0, "y": 2.0}, {"x": 3.0, "y": 4.0}, {"x": 1.23456, "y": 2.0}]]
    b = spark.createDataFrame([(1, 5, ring), (2, 25, ring)], "m int, district int, rings array<array<struct<x:double,y:double>>>")
    f = K.choropleth(b, spark.createDataFrame([(1, 50.0), (2, 60.0)], "m int, ratio double"), "m", 0.0001)
    K.write_features(f, str(tmp_path / "geo"))
    text = [r.value for r in spark.read.text(str(tmp_path / "geo")).collect()]
    assert text == ['{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[1.2346,2.0],[3.0,2.0],[3.0,4.0],[1.2346,2.0]]]},"properties":{"id":"1","ratio":50.0}}']
    K.write_csv(b, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    K.write_json(b, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_wgs84_grid_matches_zone_centre(spark):
    d = spark.createDataFrame([(500000.0, 4_982_950.4)], "x double, y double")
    lon, lat = d.select(*P.from_utm(F.col("x"), F.col("y"))).collect()[0]
    assert lon == pytest.approx(21.0) and lat == pytest.approx(45.0, abs=1e-6)


def test_convex_hull(spark):
    import random

    rnd = random.Random(5)
    sets = [[(rnd.randint(0, 9), rnd.randint(0, 9)) for _ in range(n)] for n in (1, 2, 3, 8, 25, 40)]

    def hull(points):
        pts = sorted(set(points))
        def half(ps):
            out = []
            for p in ps:
                while len(out) >= 2 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                    out.pop()
                out.append(p)
            return out
        return half(pts)[:-1] + half(pts[::-1])
    df = spark.createDataFrame([(i, [{"x": float(x), "y": float(y)} for x, y in p]) for i, p in enumerate(sets)], "i int, p array<struct<x:double,y:double>>")
    got = {r.i: [(v.x, v.y) for v in r.h] for r in df.select("i", G.convex_hull("p").alias("h")).collect()}
    assert all(got[i] == hull([(float(x), float(y)) for x, y in p]) for i, p in enumerate(sets))


def test_from_elements_to_the_match(spark):
    """A building way around the register point is matched at distance 0; its node-only neighbour is farther."""
    from addrweave.plans.address import match_addresses

    lon, lat = 20.46, 44.81
    corner = [(1, -1e-4, -1e-4), (2, 1e-4, -1e-4), (3, 1e-4, 1e-4), (4, -1e-4, 1e-4)]
    nodes = spark.createDataFrame([(i, lon + a, lat + b, {}) for i, a, b in corner] + [(9, lon + 5e-4, lat, {"addr:street": "Осма", "addr:housenumber": "1"})], "id long, lon double, lat double, tags map<string,string>")
    ways = spark.createDataFrame([(7, [1, 2, 3, 4, 1], {"addr:street": "Осма", "addr:housenumber": "1"}), (8, [1, 2], {"addr:street": ""})], "id long, nodes array<long>, tags map<string,string>")
    relations = spark.createDataFrame([(5, [("w", 7, "outer")], {"addr:street": "Девета"})], "id long, members array<struct<type:string,ref:long,role:string>>, tags map<string,string>")
    osm = E.address_entities(nodes, ways, relations).withColumn("muni_id", F.lit(1))
    assert {r.osm_id for r in osm.collect()} == {"n9", "w7", "r5"}
    x, y = E.to_utm(F.col("lon"), F.col("lat"))
    auth = spark.createDataFrame([("a", 1, "Осма", "1", lon, lat)], "addr_id string, muni_id int, street string, house_no string, lon double, lat double").withColumns({"x": x, "y": y})
    (r,) = match_addresses(auth, osm).collect()
    assert (r.osm_id, r.distance, r.matching) == ("w7", 0.0, True)
