import glob
import xml.etree.ElementTree as ET

from addrweave.sources.changes import change_elements, write_change_files

PLAN = "entity_id string, action string, tag string, old_value string, new_value string, batch_id string, reason string, lon double, lat double"


def test_files_parse_back(spark, tmp_path):
    plan = spark.createDataFrame(
        [("n10", "modify", "ref", None, "7", "1-a-0", "r", None, None), ("n9", "modify", "ref", None, "8", "1-a-0", "r", None, None), ("n9", "modify", "old", "x", None, "1-a-0", "r", None, None),
         ("w5", "modify", "name", "a", 'b<"&>', "1-a-0", "r", None, None), ("r3", "modify", "name", None, "Ћ", "1-a-0", "r", None, None), ("-1", "create", "addr:street", None, "Д", "1-a-1", "r", 20.5, 44.25),
         ("-2", "create", "addr:street", None, "Е", "1-a-1", "r", 20.6, 44.3), ("n9", "delete", None, None, None, "1-a-1", "r", None, None), ("n77", "modify", "k", None, "v", None, "r", None, None)]
        + [(f"n{100 + i}", "modify", "k", None, str(i), f"2-{i % 7}", "r", None, None) for i in range(70)], PLAN).repartition(5)
    entities = spark.createDataFrame([("n10", 3, 44.1, 20.1, {"k": "1"}), ("n9", 4, 44.2, 20.2, {"old": "x", "keep": "y"}), ("w5", 2, None, None, {"name": "a", "highway": "path"}), ("r3", 1, None, None, None)],
                                     "osm_id string, version int, lat double, lon double, tags map<string,string>")
    members = spark.createDataFrame([("w5", 2, "n12", None), ("w5", 1, "n11", None), ("w5", 3, "n11", None), ("r3", 1, "w5", "outer"), ("w6", 1, "n1", None)], "osm_id string, pos int, ref string, role string")
    path = str(tmp_path / "out")
    write_change_files(change_elements(plan, entities, members), path)
    folders = {f.split("batch_id=")[1].split("/")[0]: f for f in glob.glob(f"{path}/batch_id=*/*.txt")}
    assert len(folders) == len(glob.glob(f"{path}/*/*.txt")) == 10  # one file a batch
    first = ET.parse(folders["1-a-0"]).getroot()
    assert [(e.tag, e.get("id"), e.get("version"), e.get("action")) for e in first] == [("node", "9", "4", "modify"), ("node", "10", "3", "modify"), ("way", "5", "2", "modify"), ("relation", "3", "1", "modify")]
    tags = {e.get("id"): {t.get("k"): t.get("v") for t in e.findall("tag")} for e in first}
    assert tags == {"9": {"keep": "y", "ref": "8"}, "10": {"k": "1", "ref": "7"}, "5": {"name": 'b<"&>', "highway": "path"}, "3": {"name": "Ћ"}}
    assert [n.get("ref") for n in first[2].findall("nd")] == ["11", "12", "11"] and first[3].find("member").attrib == {"type": "way", "ref": "5", "role": "outer"}
    assert (first[0].get("lat"), first[0].get("lon"), first[2].get("lat")) == ("44.2000000", "20.2000000", None)
    second = {e.get("id"): e for e in ET.parse(folders["1-a-1"]).getroot()}
    assert second["-1"].get("version") is None and second["-1"].get("lat") == "44.2500000" and second["9"].get("action") == "delete"
    assert [e.get("id") for e in ET.parse(folders["all"]).getroot()] == ["77"]
    many = [int(e.get("id")) for e in ET.parse(folders["2-3"]).getroot()]
    assert many == sorted(many) and len(many) == 10
