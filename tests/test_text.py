import pytest
from pyspark.sql import functions as F

from addrweave.functions import similarity as S
from addrweave.functions import text as T


def values(spark, rows, schema, *cols):
    df = spark.createDataFrame(rows, schema).repartition(1)
    return [tuple(r) for r in df.select(*cols).collect()]


def test_transliteration(spark):
    got = values(spark, [("Љиљана Џо",), ("ЊЕГОШЕВА-Ђ. č",), ("Đurđa",)], "n string",
                 T.norm("n"), T.norm_latin("n"), T.cyr2lat("n"), T.cyr2lat_small("n"), T.cyr2intname("n"))
    assert got[0] == ("ljiljanadzo", "ljiljanadžo", "LJiljana DŽo", "Ljiljana Džo", "Ljiljana Dzo")
    assert got[1] == ("njegosevadjc", "njegoševađč", "NJEGOŠEVA-Đ. č", "NjEGOŠEVA-Đ. č", "NjEGOSEVA-Dj. č")
    assert got[2] == ("djurdja", "đurđa", "Đurđa", "Đurđa", "Đurđa")


@pytest.mark.parametrize("h,padded,order,number", [
    ("12", "00012", 12.0, 12), ("12a", "00012a", 12.033, 12), ("12lj", "00012lj", 12.567, None), ("a", "0000a", 0.033, None),
    ("", "00000", 0.0, None), (None, "00000", 0.0, -1), ("123456b", "123456b", 123456.067, 123456), ("12q", "00012q", 12.0, 12)])
def test_house_numbers(spark, h, padded, order, number):
    assert values(spark, [(h,)], "h string", T.pad_house_number("h"), T.house_number_order("h"), T.house_number_int("h")) == [(padded, order, number)]


def test_address_number_match(spark):
    rows = [("s", "s", "1", "1a"), (None, None, "1", "1"), ("s", None, "1", "1"), ("s", "s", None, None), ("s", "s", "a", "a")]
    got = values(spark, rows, "a string,b string,c string,d string", T.address_number_match(*map(F.col, "abcd")))
    assert [g[0] for g in got] == [True, True, False, True, False]


def test_decapitalize(spark):
    got = values(spark, [("ПУТ ЗА ЉИГ",), ("15.ОКТОБРА",), ("ПЕТРА И ПАВЛА",), ("ДРАГЕ РЕКЕ",), ("РЕКЕ",)], "n string", T.decapitalize("n"))
    assert [g[0] for g in got] == ["Пут за Љиг", "15. октобра", "Петра и Павла", "Драге реке", "Реке"]


def test_small_functions(spark):
    got = values(spark, [("  a    b   ",)], "n string", T.squeeze("n"), T.show_blank("n"), T.xml_escape(F.lit("<a&'\">")), T.mark_partial(F.lit("x ~~5~~ y")))
    assert got == [("  a b".replace("  a", " a"), "␣ a    b  ␣", "&lt;a&amp;&apos;&quot;&gt;", "x <b>5</b> y")]
    notes = [("Izbrisano iz RGZ-a 2023-07-15",), ("x;Izbrisano iz RGZ-a 2023-02-30",), ("a;Izbrisano iz RGZ-a 2024-01-02;b",), ("no",)]
    got = values(spark, notes, "n string", T.removal_date("n").cast("string"))
    assert [g[0] for g in got] == ["2023-07-15", None, "2024-01-02", None]
    got = values(spark, [("15. октобра",), ("Булевар 5",), ("x",)], "n string", *T.first_number("n"))
    assert got == [(15, True), (5, False), (None, False)]
    got = values(spark, [("n12",), ("w3",), ("r4",)], "n string", T.osm_type("n"), T.osm_link("n"))
    assert got == [("node", "https://www.openstreetmap.org/node/12"), ("way", "https://www.openstreetmap.org/way/3"),
                   ("relation", "https://www.openstreetmap.org/relation/4")]


def test_serbian_order(spark):
    names = ["Џеп", "Чачак", "Љиг", "Лазар", "Ђура", "Дунав", "Шабац", "5. улица"]
    df = spark.createDataFrame([(n,) for n in names], "n string").orderBy(T.serbian_sort_key("n"))
    assert [r.n for r in df.collect()] == ["5. улица", "Дунав", "Ђура", "Лазар", "Љиг", "Чачак", "Џеп", "Шабац"]


def test_tags(spark):
    rows = [({"addr:street": "x", "note": "y"},), ({"addr:street": "x", "shop": "y"},), ({"highway": "x"},), ({},)]
    got = values(spark, rows, "t map<string,string>", T.is_simple_address("t"), T.is_poi("t"), T.tag("t", "shop"))
    assert got == [(True, False, ""), (False, True, "y"), (False, False, ""), (True, False, "")]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_indel_ratio(spark):
    pairs = [("kitten", "sitting"), ("", ""), ("a", ""), ("x" * 70 + "abc", "yabcz"), ("petradrapsina", "petrabojovica"), ("ab" * 31, "ba" * 31),
             ("a" * 62, "a" * 40 + "b"), ("њ" * 3, "шњ")]
    got = values(spark, pairs, "a string, b string", S.indel_ratio("a", "b"))
    for (a, b), (r,) in zip(pairs, got):
        want = 1.0 if a == b else 2 * lcs(a, b) / (len(a) + len(b))
        assert r == pytest.approx(want), (a, b)


def test_scores(spark):
    rows = [("12a", "12a"), ("12", "13b"), ("12", None), ("2", "7"), ("a", "a")]
    got = values(spark, rows, "a string, b string", S.house_number_similarity("a", "b"))
    assert [round(g[0], 6) for g in got] == [1.0, 0.72, 0.0, 0.1, 1.0]
    got = values(spark, [(1.0, 1.0, 0.0), (None, 0.5, 250.0), (0.5, 0.0, 900.0)], "a double, b double, d double",
                 S.match_score(F.col("a"), F.col("b"), F.col("d")))
    assert [round(g[0], 6) for g in got] == [0.99, 0.2475, 0.165]
