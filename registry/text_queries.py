"""Scalar functions over whole tables of names, numbers and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from addrweave.functions import names as N
from addrweave.functions import similarity as S
from addrweave.functions import text as T
from registry.sql import CYR2LAT, INTNAME, NORM, NORM_LATIN, lcs_sql, number_similarity_sql
from registry.world import World, _duck_pool, duck

QUERIES, ORACLES = {}, {}


def add(name, query, sql):
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


add("transliterate_street_names",
    lambda s, d: World(s, d).street.select("street_id", T.norm("street_name").alias("norm"), T.norm_latin("street_name").alias("norm_latin"), T.cyr2lat("street_name").alias("lat"),
                                           T.cyr2lat_small("street_name").alias("lat_small"), T.cyr2intname("street_name").alias("int_name"), T.norm_keep_case("street_name").alias("norm_case"),
                                           T.norm("proper_name").alias("p_norm"), T.cyr2lat_small("proper_name").alias("p_lat"), T.cyr2intname("proper_name").alias("p_int")),
    duck(f"""SELECT street_id, {NORM('street_name')} AS norm, {NORM_LATIN('street_name')} AS norm_latin, {CYR2LAT('street_name')} AS lat, {CYR2LAT('street_name', True)} AS lat_small,
      {INTNAME('street_name')} AS int_name, replace(replace(street_name, ' ', ''), '.', '') AS norm_case, {NORM('proper_name')} AS p_norm, {CYR2LAT('proper_name', True)} AS p_lat,
      {INTNAME('proper_name')} AS p_int FROM street""", "street"))

add("normalize_documents",
    lambda s, d: World(s, d).table("documents").select("doc_id", T.norm("text").alias("norm"), T.norm_latin("text").alias("norm_latin"), T.xml_escape("text").alias("escaped")),
    duck(f"""SELECT doc_id, {NORM('text')} AS norm, {NORM_LATIN('text')} AS norm_latin,
      replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&apos;') AS escaped FROM documents"""))

add("squeeze_documents",
    lambda s, d: World(s, d).table("documents").select("doc_id", T.squeeze("text").alias("squeezed"), T.is_cyrillic("text").alias("cyrillic"), T.has_month("text").alias("month"),
                                                       T.show_blank("text").alias("shown"), T.first_number("text")[0].alias("number"), T.first_number("text")[1].alias("ordinal")),
    """SELECT doc_id, regexp_replace(rtrim(text, ' '), ' {2,}', ' ', 'g') AS squeezed, NOT regexp_matches(text, '[aeiou]') AS cyrillic,
      regexp_matches(lower(text), 'јануар|фебруар|март|април|мај|јун|јул|август|септемб|октоб|новемб|децемб') AS month,
      CASE WHEN text LIKE ' %' THEN '␣' ELSE substr(text, 1, 1) END || substr(text, 2, length(text) - 2) || CASE WHEN text LIKE '% ' THEN '␣' ELSE substr(text, length(text), 1) END AS shown,
      try_cast(nullif(regexp_extract(text, '([0-9]+)', 1), '') AS bigint) AS number, regexp_extract(text, '[0-9]+(\\.?)', 1) = '.' AS ordinal FROM documents""")

HN = "CASE WHEN house_no IS NULL THEN {none} ELSE {some} END"
add("house_number_forms",
    lambda s, d: World(s, d).map_entity.select("osm_id", T.pad_house_number("house_no").alias("padded"), T.house_number_order("house_no").alias("hn_order"), T.house_number_int("house_no").alias("hn_int")),
    duck("""SELECT osm_id, CASE WHEN house_no IS NULL THEN '00000' ELSE lpad(regexp_extract(house_no, '^([0-9]+)', 1), 5, '0') || regexp_extract(house_no, '^[0-9]+(.*)$', 1) END AS padded,
      CASE WHEN house_no IS NULL THEN 0.0 ELSE round(cast(regexp_extract(house_no, '^([0-9]+)', 1) AS double) + CASE regexp_extract(house_no, '^[0-9]+(.*)$', 1)
        WHEN 'a' THEN 1 WHEN 'b' THEN 2 ELSE 0 END / 30.0, 3) END AS hn_order,
      CASE WHEN house_no IS NULL THEN -1 WHEN length(regexp_extract(house_no, '^[0-9]+(.*)$', 1)) < 2 THEN cast(regexp_extract(house_no, '^([0-9]+)', 1) AS bigint) END AS hn_int
      FROM map_entity""", "map_entity"))

add("entity_links",
    lambda s, d: World(s, d).map_entity.select("osm_id", T.osm_type("osm_id").alias("kind"), T.osm_link("osm_id").alias("link")),
    duck("""SELECT osm_id, CASE osm_id[1] WHEN 'n' THEN 'node' WHEN 'w' THEN 'way' ELSE 'relation' END AS kind,
      'https://www.openstreetmap.org/' || CASE osm_id[1] WHEN 'n' THEN 'node' WHEN 'w' THEN 'way' ELSE 'relation' END || '/' || substr(osm_id, 2) AS link FROM map_entity""", "map_entity"))

add("hamlet_streets",
    lambda s, d: World(s, d).street.select("street_id", T.is_hamlet("street_code").alias("is_hamlet"), T.strip_id("street_code", "^0+").alias("bare_code")),
    duck("SELECT street_id, substr(street_code, 7, 1) = '2' AS is_hamlet, regexp_replace(street_code, '^0+', '') AS bare_code FROM street", "street"))

# The pool names as best-effort decapitalising gives them.
GUESSES = ["Милана Кадевића", "Двадесет Пете бригаде", "Змајевачка", "Џемала Живковића", "Трећег марта", "Др Ане Радић", "Пут за Његовац", "Краља Стефана Другог", "Осма", "7. априла",
           "Ђурђа Љубичића", "Јасенова"]
add("serbian_order_key",
    lambda s, d: World(s, d).street.select("street_id", T.serbian_sort_key("street_name").alias("sort_key"), T.decapitalize("street_name").alias("guess")),
    duck("SELECT street_id, translate(upper(street_name), 'АБВГДЂЕЖЗИЈКЛЉМНЊОПРСТЋУФХЦЧЏШ', '" + "".join(chr(0xE000 + i) for i in range(30)) + "') AS sort_key, "
         + _duck_pool(GUESSES, "street_id") + " || coalesce(' ' || nullif(regexp_extract(street_name, ' ([0-9]+)$', 1), ''), '') AS guess FROM street", "street"))

add("name_similarity_pairs",
    lambda s, d: (lambda w: w.map_entity.join(w.auth_address.select(F.col("addr_key").alias("k"), F.col("proper_name"), F.col("house_no").alias("a_no")),
                                              F.col("k") == F.floor(F.col("entity_key") / 10)).select(
        "osm_id", F.round(S.indel_ratio(T.norm("street"), T.norm("proper_name")), 9).alias("ratio"), F.round(S.house_number_similarity("a_no", "house_no"), 9).alias("number_score"),
        T.address_number_match(F.col("street"), F.col("proper_name"), F.col("house_no"), F.col("a_no")).alias("number_match")))(World(s, d)),
    duck(f""", p AS (SELECT e.osm_id, e.street, a.proper_name, {NORM('e.street')} AS a, {NORM('a.proper_name')} AS b, e.house_no, a.house_no AS a_no
        FROM map_entity e JOIN auth_address a ON a.addr_key = cast(floor(e.entity_key / 10) AS bigint)),
      r AS (SELECT a, b, CASE WHEN a = b THEN 1.0 ELSE 2.0 * {lcs_sql('a', 'b')} / (length(a) + length(b)) END AS ratio FROM (SELECT DISTINCT a, b FROM p WHERE a IS NOT NULL))
      SELECT p.osm_id, round(r.ratio, 9) AS ratio, round({number_similarity_sql('p.a_no', 'p.house_no')}, 9) AS number_score,
        (p.street IS NOT DISTINCT FROM p.proper_name) AND coalesce(CASE WHEN p.house_no IS NULL THEN -1 ELSE cast(regexp_extract(p.house_no, '^([0-9]+)', 1) AS bigint) * CASE WHEN regexp_matches(p.house_no, '^[0-9]+.?$') THEN 1 END END
          = cast(regexp_extract(p.a_no, '^([0-9]+)', 1) AS bigint), false) AS number_match
      FROM p LEFT JOIN r ON r.a = p.a AND r.b = p.b""", "map_entity"))


def tagged(w: World):
    """Map entities with a tag map built from their columns."""
    e = w.map_entity
    pairs = F.array(
        F.when(F.col("street").isNotNull(), F.struct(F.lit("addr:street").alias("k"), F.col("street").alias("v"))),
        F.when(F.col("house_no").isNotNull(), F.struct(F.lit("addr:housenumber").alias("k"), F.col("house_no").alias("v"))),
        F.when(F.col("house_ref").isNotNull(), F.struct(F.lit("ref:RS:kucni_broj").alias("k"), F.col("house_ref").alias("v"))),
        F.when(F.col("status") == "F", F.struct(F.lit("shop").alias("k"), F.lit("yes").alias("v"))),
        F.when(F.col("price") > 300000, F.struct(F.lit("note").alias("k"), F.concat(F.lit("Izbrisano iz RGZ-a 2024-0"), (F.col("entity_key") % 9 + 1).cast("string"), F.lit("-15")).alias("v"))),
        F.when(F.col("price") < 30000, F.struct(F.lit("barrier").alias("k"), F.lit("gate").alias("v"))),
        F.when((F.col("status") == "P") & F.col("house_ref").isNull(), F.struct(F.lit("removed:ref:RS:kucni_broj").alias("k"), F.col("osm_id").alias("v"))))
    return e.withColumn("tags", F.map_from_entries(F.filter(pairs, lambda p: p.isNotNull())))


add("tag_predicates",
    lambda s, d: tagged(World(s, d)).select("osm_id", T.is_simple_address("tags").alias("is_simple"), T.is_poi("tags").alias("is_poi"), T.tag("tags", "shop").alias("shop"),
                                            T.removal_date(T.tag("tags", "note")).cast("string").alias("removal_date"), F.size("tags").alias("tags")),
    duck("""SELECT osm_id, status <> 'F' AND price >= 30000 AS is_simple, status = 'F' AS is_poi, CASE WHEN status = 'F' THEN 'yes' ELSE '' END AS shop,
      CASE WHEN price > 300000 THEN '2024-0' || (entity_key % 9 + 1) || '-15' END AS removal_date,
      cast((street IS NOT NULL)::int + (house_no IS NOT NULL)::int + (house_ref IS NOT NULL)::int + (status = 'F')::int + (price > 300000)::int + (price < 30000)::int
        + (status = 'P' AND house_ref IS NULL)::int AS int) AS tags FROM map_entity""", "map_entity"))


def named_streets(w: World):
    """Map streets with eight name tags derived from register and map names (Q7, Q8 input)."""
    k, n, p = F.col("way_key"), F.col("name"), F.col("proper_name")
    return w.way_line.select(
        "osm_id", "way_key", "muni_id", "street_ref", F.when(F.col("street_ref").isNotNull(), p).alias("proper"), n.alias("name"),
        F.when(k % 4 == 0, p).when(k % 4 == 1, n).alias("name_sr"), F.when(k % 5 == 0, T.cyr2lat_small(p)).when(k % 5 == 1, T.cyr2intname(n)).when(k % 5 == 2, "").alias("name_sr_latn"),
        F.when(k % 6 == 0, T.cyr2intname(n)).when(k % 6 == 1, F.lit("Main Street")).alias("name_en"), F.when(k % 7 == 0, T.cyr2intname(n)).when(k % 7 == 1, n).alias("int_name"),
        F.when(k % 3 == 0, F.lit("2. дивизије")).alias("alt_name"), F.when(k % 3 == 1, F.lit("2. дивизије")).alias("alt_name_sr"), F.when(k % 3 == 2, F.lit("2. divizije")).alias("alt_name_sr_latn"))


NAMED = {"named": (["way_base"], f"""
  SELECT osm_id, way_key, muni_id, street_ref, CASE WHEN street_ref IS NOT NULL THEN proper_name END AS proper, name,
    CASE way_key % 4 WHEN 0 THEN proper_name WHEN 1 THEN name END AS name_sr,
    CASE way_key % 5 WHEN 0 THEN {CYR2LAT('proper_name', True)} WHEN 1 THEN {INTNAME('name')} WHEN 2 THEN '' END AS name_sr_latn,
    CASE way_key % 6 WHEN 0 THEN {INTNAME('name')} WHEN 1 THEN 'Main Street' END AS name_en, CASE way_key % 7 WHEN 0 THEN {INTNAME('name')} WHEN 1 THEN name END AS int_name
  FROM way_base"""),
    "q7flags": (["named"], f"""
  SELECT *, coalesce(proper <> name, false) AS wrong_name, proper IS NOT NULL AND name IS NULL AS missing_name,
    coalesce(coalesce(proper, name) <> name_sr, false) AS wrong_name_sr, name IS NOT NULL AND name_sr IS NULL AS missing_name_sr,
    coalesce(name_sr_latn <> '' AND {CYR2LAT('coalesce(proper, name)', True)} <> name_sr_latn, false) AS wrong_name_sr_latn,
    name IS NOT NULL AND (name_sr_latn IS NULL OR name_sr_latn = '') AS missing_name_sr_latn,
    coalesce({INTNAME('coalesce(proper, name)')} <> int_name, false) AS wrong_int_name,
    int_name IS NULL AND coalesce(regexp_matches(coalesce(proper, name), '[шчћжђШЧЋЖЂ]'), false) AS missing_int_name
  FROM named"""),
    "en_pair": (["named"], f"""
  SELECT name, name_en, {CYR2LAT('name', True)} AS l, {INTNAME('name')} AS i FROM (SELECT DISTINCT name, name_en FROM named WHERE name IS NOT NULL AND name_en IS NOT NULL)"""),
    "en_ratio": (["en_pair"], f"""
  SELECT name, name_en, CASE WHEN l = name_en THEN 1.0 ELSE 2.0 * {lcs_sql('l', 'name_en')} / (length(l) + length(name_en)) END AS rl,
    CASE WHEN i = name_en THEN 1.0 ELSE 2.0 * {lcs_sql('i', 'name_en')} / (length(i) + length(name_en)) END AS ri FROM en_pair"""),
    "q7": (["q7flags", "en_ratio"], """
  SELECT f.*, coalesce(least(r.rl, r.ri) < 0.7, false) AS suspicious_name_en, coalesce(greatest(r.rl, r.ri) > 0.9, false) AS unneeded_name_en
  FROM q7flags f LEFT JOIN en_ratio r ON r.name = f.name AND r.name_en = f.name_en
  WHERE wrong_name OR missing_name OR wrong_name_sr OR missing_name_sr OR wrong_name_sr_latn OR missing_name_sr_latn OR greatest(r.rl, r.ri) > 0.9 OR wrong_int_name OR missing_int_name"""),
}
