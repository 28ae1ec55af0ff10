"""Name mapping, snapshot diffs, housing, ingest joins and edit plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from addrweave.functions import text as T
from addrweave.plans import address as A
from addrweave.plans import diff as D
from addrweave.plans import edits as E
from addrweave.plans import housing as H
from addrweave.plans import mapping as M
from addrweave.plans import streets as ST
from addrweave.sources import changes as CH
from addrweave.sources import elements as EL
from addrweave.sources import register as RG
from registry.address_queries import auth, matched
from registry.building_queries import STEPS as BUILDING
from registry.building_queries import flagged, q2
from registry.sql import CYR2LAT, INTNAME, NORM_LATIN, _dst
from registry.street_queries import STEPS as STREET
from registry.street_queries import found, q7, summary
from registry.text_queries import named_streets
from registry.world import PROPER_NAMES, RGZ_NAMES, World, duck

QUERIES, ORACLES = {}, {}


def add(name, query, sql):
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


VOWEL = "regexp_matches(name, '[aeiou]')"
STEPS = {
    **BUILDING, **STREET,
    "hwy": (["way_base"], "SELECT * FROM way_base WHERE name IS NOT NULL"),
    "ref_name": (["hwy"], "SELECT street_ref, name, count(*) AS way_count FROM hwy WHERE street_ref IS NOT NULL GROUP BY ALL"),
    "latin_name": (["hwy"], f"SELECT {NORM_LATIN('name')} AS name_key, name, count(*) AS way_count FROM hwy WHERE NOT {VOWEL} GROUP BY ALL"),
    "curated": (["street"], "SELECT street_name AS rgz_name, min(proper_name) || ' (к)' AS name FROM street WHERE p_type IN ('STANDARD', 'PROMO') GROUP BY street_name HAVING count(*) > 1"),
    "override": (["street"], "SELECT street_name AS rgz_name, street_code, proper_name || ' (о)' AS name FROM street WHERE substr(street_code, 7, 1) = '2'"),
    "resolved_name": (["street", "curated", "ref_name", "latin_name"], f"""
      SELECT s.street_code, s.street_name AS rgz_name, coalesce(c.name, r.name, l.name, s.street_name) AS name,
        CASE WHEN c.name IS NOT NULL THEN 'curated' WHEN r.name IS NOT NULL THEN 'ref:RS:ulica' WHEN l.name IS NOT NULL THEN 'OSM' ELSE 'BestEffort' END AS source,
        CASE WHEN c.name IS NOT NULL THEN 0 WHEN r.name IS NOT NULL THEN r.way_count ELSE coalesce(l.way_count, 0) END AS ref_count
      FROM street s LEFT JOIN curated c ON c.rgz_name = s.street_name
      LEFT JOIN (SELECT * FROM ref_name QUALIFY count(*) OVER (PARTITION BY street_ref) = 1) r ON r.street_ref = s.street_code
      LEFT JOIN (SELECT * FROM latin_name QUALIFY count(*) OVER (PARTITION BY name_key) = 1) l ON l.name_key = {NORM_LATIN('s.street_name')}"""),
    "mapping": (["resolved_name", "curated"], """
      SELECT rgz_name, name, 'curated' AS source, 0 AS ref_count, NULL AS street_code FROM curated UNION ALL
      SELECT rgz_name, name, source, ref_count, street_code FROM resolved_name WHERE rgz_name NOT IN (SELECT rgz_name FROM curated) QUALIFY row_number() OVER (PARTITION BY rgz_name ORDER BY street_code) = 1"""),
    "mapping_way": (["mapping", "hwy"], f"""
      SELECT m.rgz_name, h.osm_id FROM mapping m JOIN hwy h ON h.street_ref = m.street_code WHERE m.source = 'ref:RS:ulica' UNION ALL
      SELECT m.rgz_name, h.osm_id FROM mapping m JOIN hwy h ON {NORM_LATIN('h.name')} = {NORM_LATIN('m.rgz_name')} WHERE m.source = 'OSM' AND NOT {VOWEL.replace('name', 'h.name')}"""),
    "moved": (["auth_old", "auth_new"], """
      SELECT o.addr_id AS old_id, n.addr_id AS new_id, sqrt(cast((o.x - n.x) * (o.x - n.x) + (o.y - n.y) * (o.y - n.y) AS double)) AS distance
      FROM (SELECT * FROM auth_old WHERE addr_id NOT IN (SELECT addr_id FROM auth_new)) o JOIN (SELECT * FROM auth_new WHERE addr_id NOT IN (SELECT addr_id FROM auth_old)) n
        ON o.street_name = n.street_name AND o.house_no = n.house_no AND (o.x - n.x) * (o.x - n.x) + (o.y - n.y) * (o.y - n.y) < 10000
      QUALIFY row_number() OVER (PARTITION BY o.addr_id ORDER BY distance, n.addr_id) = 1"""),
    "hc_addr": (["housing", "auth_address"], """
      SELECT hc_id, muni_id, hc_street, hc_house_no, CASE WHEN addr_id IS NOT NULL AND copies = 1 THEN addr_id END AS addr_id, copies > 1 AS is_duplicated, addr_id IS NOT NULL AND copies = 1 AS found_in_register
      FROM (SELECT h.*, a.addr_id, count(*) OVER (PARTITION BY h.muni_id, hc_street, hc_house_no) AS copies, row_number() OVER (PARTITION BY h.muni_id, hc_street, hc_house_no ORDER BY hc_id, addr_id) AS rn
        FROM housing h LEFT JOIN auth_address a ON a.muni_id = h.muni_id AND replace(replace(a.proper_name, ' ', ''), '.', '') = replace(replace(hc_street, ' ', ''), '.', '') AND a.house_no = hc_house_no) WHERE rn = 1
      QUALIFY (NOT (addr_id IS NOT NULL AND copies = 1)) OR row_number() OVER (PARTITION BY CASE WHEN addr_id IS NOT NULL AND copies = 1 THEN addr_id END ORDER BY hc_id) = 1"""),
    "way_tag": ([], """
      SELECT 'w' || o_orderkey AS wid, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'O' THEN 4 ELSE 3 END AS code,
        CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'O' THEN 4 ELSE CASE o_orderkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 4 ELSE 3 END END AS own_code FROM orders"""),
    "node_code": (["way_node", "way_tag"], """
      SELECT 'n' || node_id AS nid, max(code) AS code, arg_min('w' || way_id, (-code, 'w' || way_id)) AS way FROM way_node JOIN way_tag ON o_orderkey = way_id GROUP BY 1"""),
    "ent_code": (["map_entity", "way_tag", "node_code"], """
      SELECT e.osm_id, CASE e.osm_id[1] WHEN 'n' THEN coalesce(v.code, CASE WHEN entity_key % 9 = 1 THEN t.code END, 2)
          WHEN 'r' THEN CASE entity_key % 4 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 ELSE 1 END ELSE t.own_code END AS code,
        CASE e.osm_id[1] WHEN 'n' THEN CASE WHEN v.code > 3 THEN v.way WHEN v.code IS NULL AND entity_key % 9 = 1 THEN t.wid END
          WHEN 'r' THEN CASE WHEN entity_key % 4 < 2 THEN e.osm_id END ELSE CASE WHEN t.own_code > 3 THEN e.osm_id END END AS closest
      FROM map_entity e JOIN way_tag t ON t.o_orderkey = e.entity_key LEFT JOIN node_code v ON v.nid = e.osm_id"""),
    "hc_status": (["hc_addr", "map_entity", "ent_code"], """
      SELECT h.*, coalesce(s.entities, 0) AS entities, s.resolution, s.closest_building
      FROM hc_addr h LEFT JOIN (SELECT e.house_ref, count(*) AS entities, max(c.code) AS resolution, arg_min(struct_pack(v := c.closest), (-c.code, e.osm_id)).v AS closest_building FROM map_entity e JOIN ent_code c ON c.osm_id = e.osm_id
        WHERE e.house_ref IS NOT NULL GROUP BY 1) s ON s.house_ref = h.addr_id"""),
}


def q(body: str, *needs: str) -> str:
    return duck(body, *needs, extra=STEPS)


# --- street-name mapping
def curated(w: World):
    return w.street.where("p_type IN ('STANDARD', 'PROMO')").groupBy(F.col("street_name").alias("rgz_name")).agg(F.concat(F.min("proper_name"), F.lit(" (к)")).alias("name"), F.count("*").alias("n")).where("n > 1").drop("n")


def overrides(w: World):
    return w.street.where(T.is_hamlet("street_code")).select(F.col("street_name").alias("rgz_name"), "street_code", F.concat("proper_name", F.lit(" (о)")).alias("name"))


def mapping(w: World):
    return M.build_mapping(w.street, curated(w), M.ref_names(w.way_line), M.latin_names(w.way_line))


ME = ["rgz_name", "name", "source", "ref_count"]
add("ref_names", lambda s, d: M.ref_names(World(s, d).way_line), q("SELECT * FROM ref_name", "ref_name"))
add("latin_names", lambda s, d: M.latin_names(World(s, d).way_line), q("SELECT * FROM latin_name", "latin_name"))
add("resolve_names", lambda s, d: (lambda w: M.resolve_names(w.street, curated(w), M.ref_names(w.way_line), M.latin_names(w.way_line)))(World(s, d)), q("SELECT * FROM resolved_name", "resolved_name"))
add("build_mapping", lambda s, d: mapping(World(s, d)).select(*ME), q("SELECT rgz_name, name, source, cast(ref_count AS bigint) AS ref_count FROM mapping", "mapping"))
add("mapping_ways", lambda s, d: (lambda w: M.mapping_ways(mapping(w), w.way_line))(World(s, d)), q("SELECT rgz_name, osm_id FROM mapping_way", "mapping_way"))
add("ref_name_ways", lambda s, d: M.ref_name_ways(World(s, d).way_line), q("SELECT street_ref, name, osm_id FROM hwy WHERE street_ref IS NOT NULL", "hwy"))
add("lookup_names", lambda s, d: (lambda w: M.lookup_name(w.street.select("street_id", "street_code", "street_name"), mapping(w), overrides(w), F.col("street_name")).select("street_id", "proper_name"))(World(s, d)),
    q("""SELECT s.street_id, CASE WHEN m.name IS NULL THEN s.street_name ELSE coalesce(o.name, m.name) END AS proper_name FROM street s LEFT JOIN mapping m ON m.rgz_name = s.street_name
      LEFT JOIN override o ON o.rgz_name = s.street_name AND o.street_code = s.street_code""", "street", "mapping", "override"))
add("street_names_joined", lambda s, d: (lambda w: ST.named_by_register(w.way_line.select("osm_id", "muni_id", "street_ref"), w.street, mapping(w), overrides(w), w.muni, [3, 7]).select("osm_id", "street_name", "proper"))(World(s, d)),
    q("""SELECT b.osm_id, t.street_name, CASE WHEN t.street_name IS NOT NULL THEN CASE WHEN m.name IS NULL THEN '' ELSE coalesce(o.name, m.name) END END AS proper
      FROM way_base b JOIN muni u ON u.muni_id = b.muni_id AND u.district NOT IN (3, 7) LEFT JOIN street t ON t.street_code = b.street_ref
      LEFT JOIN mapping m ON m.rgz_name = t.street_name LEFT JOIN override o ON o.rgz_name = t.street_name AND o.street_code = t.street_code""", "way_base", "muni", "street", "mapping", "override"))
add("missing_names", lambda s, d: (lambda w: M.missing_names(w.street, curated(w)).select("street_code", "rgz_name"))(World(s, d)),
    q("SELECT DISTINCT street_code, street_name AS rgz_name FROM street WHERE street_name NOT IN (SELECT rgz_name FROM curated)", "street", "curated"))
add("overrides_without_base", lambda s, d: (lambda w: M.overrides_without_base(overrides(w), curated(w)).select("rgz_name", "street_code"))(World(s, d)),
    q("SELECT rgz_name, street_code FROM override WHERE rgz_name NOT IN (SELECT rgz_name FROM curated)", "override", "curated"))
add("street_name_list", lambda s, d: (lambda w: M.name_list(w.street, curated(w)))(World(s, d)),
    q("SELECT street_name AS name FROM (SELECT DISTINCT street_name FROM street) WHERE street_name NOT IN (SELECT rgz_name FROM curated) UNION SELECT name FROM curated WHERE rgz_name IN (SELECT street_name FROM street)", "street", "curated"))
add("mapping_listing", lambda s, d: (lambda w: M.mapping_listing(mapping(w), overrides(w), w.way_line).drop("sort_key"))(World(s, d)),
    q("""SELECT m.rgz_name, m.name, m.source, coalesce(array_to_string(list_sort(r.ids)[1:5], ','), '') AS refs, cast(m.ref_count AS bigint) AS ref_count, coalesce(o.n, 0) AS exceptions
      FROM mapping m LEFT JOIN (SELECT rgz_name, count(*) AS n FROM override GROUP BY 1) o ON o.rgz_name = m.rgz_name LEFT JOIN (SELECT rgz_name, list(osm_id) AS ids FROM mapping_way GROUP BY 1) r ON r.rgz_name = m.rgz_name""", "mapping", "mapping_way", "override"))
add("sorted_curated", lambda s, d: M.sorted_curated(curated(World(s, d))), q("SELECT rgz_name, name FROM curated", "curated"))

# --- snapshot diffs
add("added_addresses", lambda s, d: D.added(World(s, d).auth_old, World(s, d).auth_new, "addr_id").select("addr_id", "house_no"), q("SELECT addr_id, house_no FROM auth_new WHERE addr_id NOT IN (SELECT addr_id FROM auth_old)", "auth_old", "auth_new"))
add("removed_addresses", lambda s, d: D.removed(World(s, d).auth_old, World(s, d).auth_new, "addr_id").select("addr_id", "house_no"), q("SELECT addr_id, house_no FROM auth_old WHERE addr_id NOT IN (SELECT addr_id FROM auth_new)", "auth_old", "auth_new"))
add("changed_addresses", lambda s, d: D.changed_addresses(World(s, d).auth_old, World(s, d).auth_new).select("addr_id", "house_no_old", "house_no_new", "house_no_changed", "street_name_changed", "moved_metres"),
    q("""SELECT o.addr_id, o.house_no AS house_no_old, n.house_no AS house_no_new, o.house_no <> n.house_no AS house_no_changed, o.street_name <> n.street_name AS street_name_changed,
      cast(round_even(sqrt(cast((o.x - n.x) * (o.x - n.x) + (o.y - n.y) * (o.y - n.y) AS double)), 0) AS bigint) AS moved_metres FROM auth_old o JOIN auth_new n USING (addr_id)
      WHERE o.house_no <> n.house_no OR o.street_name <> n.street_name OR (o.x - n.x) * (o.x - n.x) + (o.y - n.y) * (o.y - n.y) > 0""", "auth_old", "auth_new"))
add("diff_addresses", lambda s, d: D.diff_addresses(World(s, d).auth_old, World(s, d).auth_new).select("addr_id", "change_type", "house_no_old", "house_no_new", "moved_metres"),
    q("""SELECT coalesce(o.addr_id, n.addr_id) AS addr_id, CASE WHEN o.addr_id IS NULL THEN 'added' WHEN n.addr_id IS NULL THEN 'removed' ELSE 'changed' END AS change_type, o.house_no AS house_no_old, n.house_no AS house_no_new,
      cast(round_even(sqrt(cast((o.x - n.x) * (o.x - n.x) + (o.y - n.y) * (o.y - n.y) AS double)), 0) AS bigint) AS moved_metres FROM auth_old o FULL JOIN auth_new n ON n.addr_id = o.addr_id
      WHERE o.addr_id IS NULL OR n.addr_id IS NULL OR o.house_no <> n.house_no OR (o.x - n.x) * (o.x - n.x) + (o.y - n.y) * (o.y - n.y) > 0""", "auth_old", "auth_new"))


def moved(w: World):
    return D.reissued(D.removed(w.auth_old, w.auth_new, "addr_id"), D.added(w.auth_old, w.auth_new, "addr_id"))


add("reissued_addresses", lambda s, d: moved(World(s, d)).withColumn("distance", F.round("distance", 6)), q("SELECT * REPLACE (round(distance, 6) AS distance) FROM moved", "moved"))


def streets_new(w: World):
    p = F.col("lines")[0]
    bent = F.array(F.transform(p, lambda v, i: F.struct(v["x"].alias("x"), (v["y"] + F.when((i == 2) & (F.col("street_id") % 4 == 0), 30.0).otherwise(0.0)).alias("y"))))
    return w.street_line.withColumns({"muni_name": F.lit("m"), "lines": bent, "street_name": F.when(F.col("street_id") % 5 == 0, F.concat("street_name", F.lit(" НОВА"))).otherwise(F.col("street_name"))})


add("diff_streets", lambda s, d: (lambda w: D.diff_streets(w.street_line.withColumn("muni_name", F.lit("m")), streets_new(w)).select("street_code", "street_name_changed", "moved_metres"))(World(s, d)),
    q("""SELECT street_code, street_id % 5 = 0 AS street_name_changed, cast(round_even(max(d), 0) AS bigint) AS moved_metres FROM (
        SELECT v.street_code, v.street_id, v.pos, min(DST) AS d FROM street_vertex v JOIN (SELECT a.street_id, a.pos AS seg, a.x AS x1, a.y + CASE WHEN a.pos = 3 AND a.street_id % 4 = 0 THEN 30 ELSE 0 END AS y1, b.x AS x2,
          b.y + CASE WHEN b.pos = 3 AND b.street_id % 4 = 0 THEN 30 ELSE 0 END AS y2 FROM street_vertex a JOIN street_vertex b ON b.street_id = a.street_id AND b.pos = a.pos + 1) s ON s.street_id = v.street_id GROUP BY ALL
        UNION ALL
        SELECT v.street_code, v.street_id, v.pos, min(DST) FROM (SELECT * REPLACE (y + CASE WHEN pos = 3 AND street_id % 4 = 0 THEN 30 ELSE 0 END AS y) FROM street_vertex) v JOIN street_segment s ON s.street_id = v.street_id GROUP BY ALL)
      GROUP BY ALL HAVING street_id % 5 = 0 OR round_even(max(d), 0) > 0""".replace("DST", "_DST_"), "street_segment").replace(
        "_DST_", _dst("DST(v.x, v.y, s.x1, s.y1, s.x2, s.y2)")))


# --- housing
def way_tags(w: World):
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    part = F.when(status == "P", F.when(k % 4 == 0, "apartments").when(k % 4 == 1, "yes"))
    return w.table("orders").select(F.concat(F.lit("w"), k.cast("string")).alias("osm_id"), F.when(status == "F", "apartments").when(status == "O", "yes").alias("building"), part.alias("building_part"))


def resolutions(w: World):
    nodes = w.way_node.select(F.concat(F.lit("n"), F.col("node_id").cast("string")).alias("node_id"), F.concat(F.lit("w"), F.col("way_id").cast("string")).alias("way_id"))
    k = F.col("entity_key") % 4
    relations = w.map_entity.where(F.col("osm_id").startswith("r") & (k < 3)).select("osm_id", F.when(k == 0, "apartments").when(k == 1, "house").alias("building"))
    inside = w.map_entity.where(F.col("osm_id").startswith("n") & (F.col("entity_key") % 9 == 1)).select(
        F.col("osm_id").alias("node_id"), F.concat(F.lit("w"), F.col("entity_key").cast("string")).alias("building_id"))
    return H.entity_resolution(w.map_entity, way_tags(w), relations, nodes, inside)


def hc(w: World):
    return H.housing_addresses(w.housing, auth(w))


add("housing_addresses", lambda s, d: hc(World(s, d)), q("SELECT * FROM hc_addr", "hc_addr"))
add("housing_status", lambda s, d: (lambda w: H.housing_status(hc(w), w.map_entity, resolutions(w)).select("hc_id", "addr_id", "entities", "resolution", "closest_building"))(World(s, d)),
    q("SELECT hc_id, addr_id, entities, resolution, closest_building FROM hc_status", "hc_status"))
add("housing_counts", lambda s, d: (lambda w: H.housing_counts(H.housing_status(hc(w), w.map_entity, resolutions(w))))(World(s, d)),
    q("""SELECT muni_id, count(*) AS communities, count(*) FILTER (WHERE found_in_register) AS in_register, count(*) FILTER (WHERE entities > 0) AS in_map, count(*) FILTER (WHERE resolution = 1) AS entity_not_found,
      count(*) FILTER (WHERE resolution = 2) AS node_detached, count(*) FILTER (WHERE resolution = 3) AS not_building, count(*) FILTER (WHERE resolution = 4) AS not_apartment, count(*) FILTER (WHERE resolution = 5) AS apartment
      FROM hc_status GROUP BY muni_id""", "hc_status"))
add("node_ways", lambda s, d: World(s, d).way_node.groupBy("node_id").agg(F.count("*").alias("ways"), F.min("way_id").alias("first_way")), q("SELECT node_id, count(*) AS ways, min(way_id) AS first_way FROM way_node GROUP BY node_id", "way_node"))

# --- ingest
add("assemble_ways", lambda s, d: (lambda w: EL.assemble_ways(
    w.table("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_set("l_partkey")).alias("nodes")),
    w.table("part").select(F.col("p_partkey").alias("id"), ((F.col("p_partkey") * 37) % 1000003).alias("lon"), ((F.col("p_partkey") * 91) % 1000003).alias("lat")))[0].select(
        "id", "shape", F.size("points").alias("n"), F.aggregate("points", F.lit(0.0), lambda a, p: a * 3 % 1000003 + p["x"] * 7 + p["y"]).alias("course")))(World(s, d)),
    q("""SELECT way_id AS id, CASE WHEN count(*) = 1 THEN 'Point' ELSE 'LineString' END AS shape, cast(count(*) AS int) AS n,
      list_reduce(list_prepend(0.0::double, list((node_id * 37) % 1000003 * 7.0::double + (node_id * 91) % 1000003 ORDER BY node_id)), lambda t_a, t_p: t_a * 3 % 1000003 + t_p) AS course FROM way_node GROUP BY way_id""", "way_node"))
add("inspire_consolidation", lambda s, d: (lambda w: RG.consolidate_inspire(
    w.table("orders").select(F.concat(F.lit("KB.000"), F.col("o_orderkey").cast("string")).alias("inspire_id"), (F.col("o_custkey") % 20000000000).alias("thoroughfare_name_id"), F.col("o_orderpriority").alias("postal_descriptor_id"),
                             F.col("o_custkey").alias("admin_unit_1"), F.col("o_orderstatus").alias("designators"), F.lit(1.5).alias("lon"), F.lit(2.5).alias("lat")),
    w.table("part").select(F.col("p_partkey").alias("gml_id"), F.concat(F.lit("HR.TN."), F.col("p_partkey").cast("string")).alias("inspire_id"), F.col("p_name").alias("name")),
    w.table("orders").select(F.col("o_orderpriority").alias("gml_id"), F.substring("o_orderpriority", 1, 1).alias("postcode")).distinct(),
    w.table("customer").select(F.col("c_custkey").alias("gml_id"), F.col("c_nationkey").alias("inspire_id"), F.col("c_name").alias("name")),
    w.table("nation").select(F.col("n_nationkey").alias("inspire_id"), F.col("n_name").alias("settl_id"), F.col("n_regionkey").alias("muni_inspire_id")),
    w.table("region").select(F.col("r_regionkey").alias("inspire_id"), F.col("r_regionkey").alias("muni_id"), F.col("r_name").alias("muni_name"))).drop("lon", "lat"))(World(s, d)),
    """SELECT regexp_replace('KB.000' || o_orderkey, '^KB\\.0*', '') AS addr_id, r_regionkey AS muni_id, r_name AS muni_name, n_name AS settl_id, c_name AS settl_name, n_nationkey AS settl_inspire_id,
      'HR.TN.' || p_partkey AS street_code, p_name AS street_name, o_orderstatus AS house_no, o_orderpriority[1] AS postcode
      FROM orders JOIN part ON p_partkey = o_custkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
add("inspire_consolidation_by_unit", lambda s, d: (lambda w: RG.consolidate_inspire_by_unit(
    w.table("orders").select(F.concat(F.lit("HS."), F.col("o_orderkey").cast("string")).alias("inspire_id"), F.col("o_custkey").alias("thoroughfare_name_id"), F.col("o_orderpriority").alias("postal_descriptor_id"),
                             F.col("o_custkey").alias("admin_unit_1"), F.concat(F.lit("SI.GURS.RPE."), F.floor(F.col("o_custkey") / 15).cast("string")).alias("admin_unit_2"), F.col("o_orderstatus").alias("designators"), F.lit(1.5).alias("lon"), F.lit(2.5).alias("lat")),
    w.table("part").select(F.col("p_partkey").alias("gml_id"), F.col("p_partkey").cast("string").alias("inspire_id"), F.col("p_name").alias("name")),
    w.table("orders").select(F.col("o_orderpriority").alias("gml_id"), F.substring("o_orderpriority", 1, 1).alias("postcode")).distinct(),
    w.table("customer").select(F.col("c_custkey").alias("gml_id"), F.col("c_custkey").cast("string").alias("inspire_id"), F.col("c_name").alias("name")),
    w.muni.select(F.concat(F.lit("AU."), F.col("muni_id").cast("string")).alias("inspire_id"), "muni_id", "muni_name")).drop("lon", "lat"))(World(s, d)),
    q("""SELECT cast(o_orderkey AS varchar) AS addr_id, m.muni_id, m.muni_name, cast(c_custkey AS varchar) AS settl_id, c_name AS settl_name, cast(c_custkey AS varchar) AS settl_inspire_id, cast(p_partkey AS varchar) AS street_code, p_name AS street_name,
      o_orderstatus AS house_no, o_orderpriority[1] AS postcode FROM orders JOIN part ON p_partkey = o_custkey JOIN customer ON c_custkey = o_custkey JOIN muni m ON m.muni_id = cast(floor(o_custkey / 15) AS bigint)""", "muni"))


def side_ways(w: World):
    k = F.col("way_key")
    tags = F.map_filter(F.map_from_arrays(F.array(*[F.lit(x) for x in ("name", "name:left", "name:sr", "ref:RS:ulica", "ref:RS:ulica:left", "ref:RS:ulica:right")]), F.array(
        F.col("name"), F.when(k % 5 == 1, F.concat(F.col("name"), F.lit(" л"))), F.col("proper_name"), F.when(k % 7 == 0, F.concat_ws(";", "street_ref", k.cast("string"))),
        F.when(k % 3 == 0, F.concat(F.lit("L"), (k % 4).cast("string"))), F.when(k % 4 == 0, F.concat(F.when(k % 12 == 0, "L").otherwise("R"), (k % 4).cast("string"))))), lambda a, b: b.isNotNull())
    return EL.explode_sides(EL.promote_tags(w.way_line.select("osm_id", "way_key", F.lit("LineString").alias("shape"), tags.alias("tags"))))


add("street_sides", lambda s, d: side_ways(World(s, d)).select("osm_id", "street_ref", "name", "name_sr"),
    q("""SELECT osm_id, unnest(CASE WHEN refs LIKE '%;%' THEN string_split(refs, ';') WHEN l IS NOT NULL AND l = r THEN [] WHEN l IS NOT NULL OR r IS NOT NULL THEN list_filter([l, r], lambda t_r: t_r IS NOT NULL) ELSE [refs] END) AS street_ref,
        unnest(CASE WHEN refs LIKE '%;%' THEN [nm, nm] WHEN l IS NOT NULL AND l = r THEN [] WHEN l IS NOT NULL OR r IS NOT NULL THEN CASE WHEN l IS NULL THEN [nm] WHEN r IS NULL THEN [coalesce(nl, nm)] ELSE [coalesce(nl, nm), nm] END ELSE [nm] END) AS name, sr AS name_sr
      FROM (SELECT osm_id, name AS nm, CASE WHEN way_key % 5 = 1 THEN name || ' л' END AS nl, proper_name AS sr, CASE WHEN way_key % 7 = 0 THEN concat_ws(';', street_ref, cast(way_key AS varchar)) END AS refs,
        CASE WHEN way_key % 3 = 0 THEN 'L' || (way_key % 4) END AS l, CASE WHEN way_key % 4 = 0 THEN CASE WHEN way_key % 12 = 0 THEN 'L' ELSE 'R' END || (way_key % 4) END AS r FROM way_base)""", "way_base"))
add("lookup_elements", lambda s, d: (lambda w: EL.lookup_elements(w.map_entity.where("status = 'P'").select(F.col("entity_key").alias("id")), w.table("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_partkey").alias("nodes")),
                                     w.table("part").select(F.col("p_partkey").alias("id"), "p_name"))[1])(World(s, d)),
    q("SELECT p_partkey AS id, p_name FROM part WHERE p_partkey IN (SELECT node_id FROM way_node JOIN map_entity ON entity_key = way_id WHERE status = 'P')", "way_node", "map_entity"))

# --- edit plans
PLAN = ["entity_id", "action", "tag", "old_value", "new_value", "batch_id", "reason"]


def unpivot(select: str, rows: list[tuple[str, str, str]], reason: str, source: str, action: str = "modify", batch: str = "NULL") -> str:
    """Union of one row per tag whose value changes."""
    return " UNION ALL ".join(
        f"SELECT {select} AS entity_id, '{action}' AS action, '{t}' AS tag, cast({o} AS varchar) AS old_value, cast({n} AS varchar) AS new_value, cast({batch} AS varchar) AS batch_id, '{reason}' AS reason FROM {source} AND ({o}) IS DISTINCT FROM ({n})"
        for t, o, n in rows)


def plan(df):
    return df.select(*PLAN)


NEW = [("addr:street", "NULL", "street"), ("addr:housenumber", "NULL", NORM_LATIN("house_no")), ("ref:RS:ulica", "NULL", "street_code"), ("ref:RS:kucni_broj", "NULL", "addr_id")]
NEWEST = {**STEPS, "fresh": (["q1"], "SELECT *, row_number() OVER (PARTITION BY settl_id ORDER BY street, house_no, addr_id) AS no, row_number() OVER (PARTITION BY settl_id, street, street_code ORDER BY house_no, addr_id) AS sno FROM q1 WHERE state = 'not_found'"),
          "hit": (["q1"], "SELECT *, row_number() OVER (PARTITION BY settl_id ORDER BY street, house_no, addr_id) AS no FROM q1 WHERE state = 'matched' AND osm_id[1] IN ('n', 'w')")}
add("plan_new_addresses", lambda s, d: plan(E.new_addresses(matched(World(s, d)))),
    duck(unpivot("cast(-1 - (no - 1) % 100 AS varchar)", NEW, "new address", "fresh WHERE true", "create", "settl_id || '-new-' || cast(floor((no - 1) / 100) AS bigint)"), "fresh", extra=NEWEST))
add("plan_new_addresses_per_street", lambda s, d: plan(E.new_addresses_per_street(matched(World(s, d)))),
    duck(unpivot("cast(-sno AS varchar)", NEW, "new address per street", "fresh WHERE true", "create", "settl_id || '-' || street_code"), "fresh", extra=NEWEST))
add("plan_attach_refs", lambda s, d: plan(E.attach_refs(matched(World(s, d)))),
    duck(unpivot("osm_id", [("ref:RS:kucni_broj", "NULL", "addr_id")], "attach id", "hit WHERE true", batch="settl_id || '-matched-' || cast(floor((no - 1) / 100) AS bigint)"), "hit", extra=NEWEST))


def change_elements(w: World):
    """The files that attach ids: elements with all their tags, ways with their nodes."""
    k = F.col("entity_key")
    tags = F.map_filter(F.create_map(F.lit("addr:street"), F.col("street"), F.lit("addr:housenumber"), F.col("house_no"), F.lit("note"), F.when(k % 4 == 0, "a < b & 'c'")), lambda _, v: v.isNotNull())
    entities = w.map_entity.select("osm_id", (1 + k % 7).alias("version"), (F.col("y") / 100000.0).alias("lat"), (F.col("x") / 100000.0).alias("lon"), tags.alias("tags"))
    members = w.way_node.select(F.concat(F.lit("w"), F.col("way_id").cast("string")).alias("osm_id"), F.col("node_id").alias("pos"), F.concat(F.lit("n"), F.col("node_id").cast("string")).alias("ref"))
    return CH.change_elements(E.attach_refs(matched(w)), entities, members)


TAG = "coalesce('    <tag k=\"{}\" v=\"' || {} || '\"/>' || chr(10), '')"
add("change_elements", lambda s, d: change_elements(World(s, d)),
    duck(f"""SELECT settl_id || '-matched-' || cast(floor((h.no - 1) / 100) AS bigint) AS batch_id, kind, cast(substr(e.osm_id, 2) AS bigint) AS number,
        '  <' || kind || ' id="' || substr(e.osm_id, 2) || '" action="modify" visible="true" version="' || (1 + entity_key % 7) || '"'
          || CASE WHEN kind = 'node' THEN printf(' lat="%.7f" lon="%.7f"', e.y / 100000.0, e.x / 100000.0) ELSE '' END || '>' || chr(10) || CASE WHEN kind = 'way' THEN coalesce(nd, '') ELSE '' END
          || {TAG.format('addr:housenumber', 'e.house_no')} || {TAG.format('addr:street', 'e.street')} || {TAG.format('note', "CASE WHEN entity_key % 4 = 0 THEN 'a &lt; b &amp; &apos;c&apos;' END")}
          || {TAG.format('ref:RS:kucni_broj', 'h.addr_id')} || '  </' || kind || '>' AS value
      FROM hit h JOIN (SELECT *, CASE osm_id[1] WHEN 'n' THEN 'node' ELSE 'way' END AS kind FROM map_entity) e ON e.osm_id = h.osm_id
      LEFT JOIN (SELECT 'w' || way_id AS wid, string_agg('    <nd ref="' || node_id || '"/>' || chr(10), '' ORDER BY node_id) AS nd FROM way_node GROUP BY 1) n ON n.wid = e.osm_id""",
         "hit", "map_entity", "way_node", extra=NEWEST))
add("plan_auto_attach", lambda s, d: plan(E.auto_attach(matched(World(s, d)))),
    q(unpivot("osm_id", [("ref:RS:kucni_broj", "NULL", "addr_id"), ("addr:street", "osm_street", "street"), ("addr:housenumber", "osm_house_no", NORM_LATIN("house_no"))], "auto attach",
              "q1 WHERE conflated_osm_id IS NULL AND osm_id[1] IN ('n', 'w') AND distance <= 50 AND (matching OR distance <= 20)"), "q1"))


def move_plan(w: World):
    nodes = w.map_node.select("osm_id", F.map_filter(F.create_map(F.lit("addr:street"), F.col("street"), F.lit("addr:housenumber"), F.col("house_no"), F.lit("source"), (F.col("node_key") % 3).cast("string")), lambda k, v: v.isNotNull()).alias("tags"))
    own = w.map_building.select("osm_id", F.map_filter(F.create_map(F.lit("addr:street"), F.col("street"), F.lit("building"), F.col("building"), F.lit("source"), F.when(F.col("addr_key") % 2 == 0, "1")), lambda k, v: v.isNotNull()).alias("tags"))
    return E.move_into_buildings(q2(w), nodes, own)


MOVE = {**STEPS, "mv": (["q2"], "SELECT * FROM q2 WHERE resolution = 3 AND building_id[1] = 'w'"),
        "mv_b": (["mv"], "SELECT building_id, m || '-address_to_building-' || cast(floor((row_number() OVER (PARTITION BY m ORDER BY building_id) - 1) / 100) AS bigint) AS batch_id FROM (SELECT building_id, min(muni_id) AS m FROM mv GROUP BY 1)"),
        "mv_tag": (["mv"], """SELECT building_id, tag, list_sort(list(DISTINCT value)) AS vs FROM (SELECT building_id, 'addr:street' AS tag, street AS value FROM mv UNION ALL SELECT building_id, 'addr:housenumber', house_no FROM mv
          UNION ALL SELECT building_id, 'source', cast(node_key % 3 AS varchar) FROM mv) WHERE value IS NOT NULL GROUP BY ALL"""),
        "mv_own": (["map_building"], "SELECT osm_id AS building_id, 'addr:street' AS tag, street AS o FROM map_building WHERE street IS NOT NULL UNION ALL SELECT osm_id, 'source', '1' FROM map_building WHERE addr_key % 2 = 0")}
add("plan_move_into_buildings", lambda s, d: plan(move_plan(World(s, d))),
    duck("""SELECT * FROM (SELECT t.building_id AS entity_id, 'modify' AS action, t.tag, o.o AS old_value, CASE WHEN o.o IS NULL THEN array_to_string(vs, ';') WHEN t.tag LIKE 'addr:%' THEN o.o
        ELSE array_to_string(list_prepend(o.o, list_filter(vs, lambda t_v: t_v <> o.o)), ';') END AS new_value, b.batch_id, 'move address to building' AS reason
      FROM mv_tag t JOIN mv_b b ON b.building_id = t.building_id LEFT JOIN mv_own o ON o.building_id = t.building_id AND o.tag = t.tag) WHERE old_value IS DISTINCT FROM new_value
      UNION ALL SELECT DISTINCT m.osm_id, 'delete', NULL, NULL, NULL, b.batch_id, 'move address to building' FROM mv m JOIN mv_b b ON b.building_id = m.building_id""", "mv_tag", "mv_b", "mv_own", extra=MOVE))
add("plan_attach_street_refs", lambda s, d: (lambda w: E.attach_street_refs(found(w), w.street, w.way_line))(World(s, d)),
    q("""SELECT f.osm_id AS entity_id, 'modify' AS action, 'ref:RS:ulica' AS tag, cast(NULL AS varchar) AS old_value, b.street_code AS new_value, b.batch_id, 'attach street id' AS reason, xmin, ymin, xmax, ymax
      FROM found f JOIN (SELECT x.*, t.street_code, t.settl_id || '-streets-' || cast(floor((row_number() OVER (PARTITION BY t.settl_id ORDER BY t.street_name, t.street_id) - 1) / 10) AS bigint) AS batch_id
        FROM (SELECT f.street_id, cast(min(x) AS double) AS xmin, cast(min(y) AS double) AS ymin, cast(max(x) AS double) AS xmax, cast(max(y) AS double) AS ymax FROM found f JOIN way_vertex v ON v.osm_id = f.osm_id WHERE name_match GROUP BY f.street_id) x
        JOIN street t ON t.street_id = x.street_id) b ON b.street_id = f.street_id WHERE f.name_match""", "found", "way_vertex", "street"))


def removal_plan(w: World):
    return E.reref_or_remove(D.removed(w.auth_old, w.auth_new, "addr_id").select("addr_id"), moved(w).select("old_id", "new_id"), flagged(w), "2024-05-01")


REM = {**STEPS, "gone": (["entity_flags", "auth_old", "auth_new", "moved"], """SELECT e.*, m.new_id FROM entity_flags e LEFT JOIN moved m ON m.old_id = e.house_ref
  WHERE e.house_ref IN (SELECT addr_id FROM auth_old WHERE addr_id NOT IN (SELECT addr_id FROM auth_new))""")}
add("plan_reref_or_remove", lambda s, d: plan(removal_plan(World(s, d))),
    duck(unpivot("osm_id", [("ref:RS:kucni_broj", "house_ref", "new_id")], "id re-issued", "gone WHERE new_id IS NOT NULL") + " UNION ALL "
         + unpivot("osm_id", [("removed:ref:RS:kucni_broj", "removed_ref", "house_ref"), ("note", "note", "note || ';Izbrisano iz RGZ-a 2024-05-01'"), ("ref:RS:kucni_broj", "house_ref", "NULL")], "address removed",
                   "gone WHERE new_id IS NULL AND removed_ref IS NULL"), "gone", extra=REM))
add("plan_changed_addresses", lambda s, d: (lambda w: plan(E.changed_addresses(D.changed_addresses(w.auth_old, w.auth_new).withColumn("street_new", T.cyr2lat("street_name_new")), w.map_entity)))(World(s, d)),
    duck(unpivot("osm_id", [("addr:street", "street", "s2"), ("addr:housenumber", "house_no", "h2")], "address changed", "chg WHERE true"), "chg", extra={**STEPS, "chg": (["map_entity", "auth_old", "auth_new"], f"""
      SELECT e.osm_id, e.street, e.house_no, {CYR2LAT('n.street_name')} AS s2, {NORM_LATIN('n.house_no')} AS h2 FROM map_entity e JOIN auth_new n ON n.addr_id = e.house_ref JOIN auth_old o ON o.addr_id = n.addr_id WHERE o.house_no <> n.house_no""")}))
add("plan_rewrite_streets", lambda s, d: (lambda w: plan(E.rewrite_streets(A.import_check(w.map_entity, auth(w)), w.street.select(F.col("proper_name").alias("a_street"), F.lit("Липова").alias("street"), F.lit(True).alias("accepted")))))(World(s, d)),
    q(unpivot("osm_id", [("addr:street", "street", "a_street")], "street rewritten", "problem WHERE known AND NOT street_perfect AND street = 'Липова'"), "problem"))
add("plan_removed_streets", lambda s, d: (lambda w: plan(E.removed_streets(w.street.where("p_type = 'LARGE'").select("street_code"), w.way_line)))(World(s, d)),
    q(unpivot("osm_id", [("removed:ref:RS:ulica", "NULL", "street_ref"), ("ref:RS:ulica", "street_ref", "NULL")], "street removed", "way_base WHERE street_ref IN (SELECT street_code FROM street WHERE p_type = 'LARGE')"), "way_base", "street"))
add("plan_renamed_streets", lambda s, d: (lambda w: plan(E.renamed_streets(w.street.select("street_code", F.col("street_name").alias("old_name"), F.col("proper_name").alias("new_name")),
                                                                          w.way_line.withColumn("tags", F.create_map(F.lit("short_name"), F.lit("к")).cast("map<string,string>")))))(World(s, d)),
    q(unpivot("osm_id", [("name", "name", "proper_name"), ("name:sr", "NULL", "proper_name"), ("name:sr-Latn", "NULL", CYR2LAT("proper_name")), ("int_name", "NULL", INTNAME("proper_name")), ("short_name", "'к'", "NULL"),
                         ("old_name", "NULL", "street_name"), ("old_name:sr", "NULL", "street_name"), ("old_name:sr-Latn", "NULL", CYR2LAT("street_name"))], "street renamed",
              "way_base WHERE street_ref IS NOT NULL AND street_name <> proper_name AND name IS DISTINCT FROM proper_name"), "way_base"))
add("plan_auto_street_refs", lambda s, d: (lambda w: plan(E.auto_street_refs(found(w), w.street.withColumn("is_hamlet", T.is_hamlet("street_code")))))(World(s, d)),
    q(unpivot("osm_id", [("ref:RS:ulica", "NULL", "street_code")], "auto street id", "(SELECT f.*, t.street_code FROM found f JOIN street t ON t.street_id = f.street_id) WHERE (name_match OR norm_match) AND substr(street_code, 7, 1) <> '2'"), "found", "street"))
add("plan_fix_name_tags", lambda s, d: (lambda w: plan(E.fix_name_tags(q7(w), named_streets(w).select("osm_id", F.col("name").alias("now_name"), F.when(F.col("way_key") % 8 != 0, F.col("name_sr")).alias("now_sr"), F.col("name_sr_latn").alias("now_latn")))))(World(s, d)),
    q(f"""SELECT * FROM ({unpivot('osm_id', [('name:sr', 'now_sr', "CASE WHEN (wrong_name_sr AND name_sr IS NOT DISTINCT FROM now_sr) OR (missing_name_sr AND now_sr IS NULL) THEN name ELSE now_sr END"),
      ('name:sr-Latn', 'name_sr_latn', f"CASE WHEN wrong_name_sr_latn OR (missing_name_sr_latn AND name_sr_latn IS NULL) THEN {CYR2LAT('name', True)} ELSE name_sr_latn END")], 'name tags',
      "(SELECT *, CASE WHEN way_key % 8 <> 0 THEN name_sr END AS now_sr FROM q7) WHERE street_ref IS NOT NULL AND NOT wrong_name AND NOT missing_name AND name IS NOT NULL")})""", "q7"))
add("plan_fix_int_names", lambda s, d: (lambda w: plan(E.fix_int_names(q7(w), named_streets(w).select(
        "osm_id", F.when(F.col("way_key") % 10 != 0, F.col("name")).alias("now_name"), F.when(F.col("way_key") % 3 == 0, F.lit("x")).otherwise(F.col("int_name")).alias("now_int_name")))))(World(s, d)),
    q(unpivot("osm_id", [("int_name", "int_name", INTNAME("name"))], "int_name", "q7 WHERE (wrong_int_name OR missing_int_name) AND proper = name AND way_key % 10 <> 0 AND way_key % 3 <> 0"), "q7"))


def alt_plan(w: World):
    found_ = ST.wrong_alt_names(named_streets(w))
    full = found_.where("alt_partial").select("alt_suggestion", F.regexp_replace("alt_suggestion", "~", "").alias("full_name")).distinct()
    return plan(E.fix_alt_names(found_, full))


add("plan_fix_alt_names", lambda s, d: alt_plan(World(s, d)), None)
add("plan_unnamed_ways", lambda s, d: (lambda w: plan(E.unnamed_ways(found(w), w.way_line, w.street.withColumn("is_hamlet", T.is_hamlet("street_code")), w.muni)))(World(s, d)),
    q(unpivot("osm_id", [("ref:RS:ulica", "NULL", "street_code"), ("name", "NULL", "proper_name"), ("name:sr", "NULL", "proper_name"), ("name:sr-Latn", "NULL", CYR2LAT("proper_name", True)), ("int_name", "NULL", INTNAME("proper_name"))],
              "unnamed way", "(SELECT f.osm_id, f.share, f.way_length, t.street_code, t.proper_name, m.district, w.name, w.bridge FROM found f JOIN street t ON t.street_id = f.street_id JOIN muni m ON m.muni_id = f.muni_id JOIN way_base w ON w.osm_id = f.osm_id) "
              "WHERE share >= 0.9 AND way_length >= 20 AND bridge IS NULL AND name IS NULL AND substr(street_code, 7, 1) <> '2'", batch="district"), "found", "street", "muni", "way_base"))
add("plan_tag_apartments", lambda s, d: (lambda w: plan(E.tag_apartments(H.housing_status(hc(w), w.map_entity, resolutions(w)), way_tags(w).withColumn("construction", F.lit(None).cast("string")))))(World(s, d)), None)
add("change_rows", lambda s, d: E.change_rows(plan(E.auto_attach(matched(World(s, d))))).select(*PLAN),
    q(unpivot("osm_id", [("ref:RS:kucni_broj", "NULL", "addr_id"), ("addr:street", "osm_street", "street"), ("addr:housenumber", "osm_house_no", NORM_LATIN("house_no"))], "auto attach",
              "q1 WHERE conflated_osm_id IS NULL AND osm_id[1] IN ('n', 'w') AND distance <= 50 AND (matching OR distance <= 20)"), "q1"))
