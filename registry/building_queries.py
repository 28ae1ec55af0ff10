"""Buildings, municipalities, address checks and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.functions import text as T
from addrweave.operators import ranking as R
from addrweave.operators import rollup as RU
from addrweave.operators.cells import entities_in_areas, lines_in_polygons, points_in_polygons
from addrweave.plans import address as A
from addrweave.plans import buildings as B
from addrweave.plans import settlements as SE
from registry.address_queries import STEPS as MATCH
from registry.address_queries import auth, matched
from registry.sql import NORM, NORM_LATIN, _dst
from registry.world import World, duck

QUERIES, ORACLES = {}, {}


def add(name, query, sql):
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def inside_sql(px: str, py: str) -> str:
    """Crossing number of a rightward ray, for edges x1..y2 aggregated per point and polygon."""
    return f"sum(CASE WHEN (y1 > {py}) <> (y2 > {py}) AND {px} < x1 + ({py} - y1) * (x2 - x1) / cast(y2 - y1 AS double) THEN 1 ELSE 0 END) % 2 = 1"


def edge_sql(px: str, py: str) -> str:
    return (f"bool_or((x2 - x1) * ({py} - y1) - ({px} - x1) * (y2 - y1) = 0 AND {px} BETWEEN least(x1, x2) AND greatest(x1, x2) AND {py} BETWEEN least(y1, y2) AND greatest(y1, y2))")


STEPS = {
    **MATCH,
    "in_muni": (["map_entity", "muni_edge"], f"""
      SELECT osm_id, poly_id FROM (SELECT e.osm_id, e.x AS px, e.y AS py, m.muni_id AS poly_id, x1, y1, x2, y2 FROM map_entity e
        JOIN (SELECT *, min(x1) OVER w AS bx0, max(x1) OVER w AS bx1, min(y1) OVER w AS by0, max(y1) OVER w AS by1 FROM muni_edge WINDOW w AS (PARTITION BY muni_id)) m
          ON e.x BETWEEN bx0 AND bx1 AND e.y BETWEEN by0 AND by1)
      GROUP BY osm_id, poly_id, px, py HAVING {inside_sql('px', 'py')} OR {edge_sql('px', 'py')}"""),
    "entity_flags": (["map_entity"], """SELECT *, status = 'P' AND house_ref IS NULL AS is_removed, CASE WHEN status = 'P' THEN osm_id END AS removed_ref,
      CASE WHEN entity_key % 3 = 0 THEN 'x;' ELSE '' END || 'Izbrisano iz RGZ-a 2024-0' || (entity_key % 9 + 1) || CASE WHEN entity_key % 10 = 0 THEN '-41' ELSE '-15' END AS note FROM map_entity"""),
    "in_building": (["map_node", "map_building"], """
      SELECT n.*, b.osm_id AS building_id, b.street AS b_street, b.house_no AS b_house_no, b.has_note AS b_has_note
      FROM map_node n JOIN map_building b ON n.x > b.xmin AND n.x < b.xmax AND n.y > b.ymin AND n.y < b.ymax"""),
    "hn": (["in_building"], """
      SELECT *, CASE WHEN house_no IS NULL THEN -1 WHEN regexp_matches(house_no, '^[0-9]+.?$') THEN cast(regexp_extract(house_no, '^([0-9]+)', 1) AS bigint) END AS num,
        CASE WHEN b_house_no IS NULL THEN -1 WHEN regexp_matches(b_house_no, '^[0-9]+.?$') THEN cast(regexp_extract(b_house_no, '^([0-9]+)', 1) AS bigint) END AS b_num FROM in_building"""),
    "facts": (["hn"], """
      SELECT building_id, any_value(b_street) AS b_street, any_value(b_house_no) AS b_house_no, any_value(b_has_note) AS b_has_note, count(*) AS n,
        count(*) FILTER (WHERE is_poi) AS pois, count(*) FILTER (WHERE is_simple) AS simple, count(DISTINCT coalesce('=' || street, '')) AS streets,
        count(DISTINCT coalesce('=' || street, '') || '|' || coalesce('=' || house_no, '')) AS addresses, count(DISTINCT coalesce(num, -2)) AS numbers,
        bool_and((street IS NOT DISTINCT FROM b_street) AND (house_no IS NOT DISTINCT FROM b_house_no)) AS match,
        bool_and((street IS NOT DISTINCT FROM b_street) AND coalesce(num = b_num, false)) AS number_match, coalesce(bool_or(house_no = b_house_no), false) AS any_same,
        bool_or(has_note) OR any_value(b_has_note) AS note, arg_min(coalesce(street, '~'), osm_id) AS s1, arg_min(coalesce(house_no, '~'), osm_id) AS h1 FROM hn GROUP BY building_id"""),
    "raw_code": (["facts"], """
      SELECT *, CASE
        WHEN building_id[1] = 'n' THEN 9 WHEN pois > 0 AND simple > 0 THEN 8 WHEN pois = 0 AND simple = 0 THEN 8
        WHEN b_street IS NULL AND b_house_no IS NULL THEN CASE WHEN pois = 1 THEN 2 WHEN simple = 1 THEN 3
          WHEN pois > 1 THEN CASE WHEN addresses = 1 THEN 4 ELSE 1 END ELSE CASE WHEN addresses = 1 THEN 3 ELSE 5 END END
        WHEN pois = 1 THEN CASE WHEN match THEN 1 ELSE 7 END
        WHEN simple = 1 THEN CASE WHEN match THEN 3 WHEN s1 <> '~' AND s1 = b_street THEN CASE WHEN h1 = '~' OR b_house_no IS NULL THEN 3 ELSE 7 END
          WHEN h1 <> '~' AND h1 = b_house_no THEN CASE WHEN s1 = '~' OR b_street IS NULL THEN 3 ELSE 7 END ELSE 3 END
        WHEN addresses = 1 AND match THEN CASE WHEN pois > 0 THEN 1 ELSE 3 END
        WHEN streets = 1 AND numbers = 1 AND number_match THEN CASE WHEN any_same THEN CASE WHEN pois > 0 THEN 6 ELSE 7 END WHEN addresses < n AND addresses > 1 THEN 7
          WHEN NOT coalesce(regexp_matches(b_house_no, '^[0-9]+$'), false) THEN 7 ELSE 1 END
        WHEN addresses = 1 THEN 7 ELSE 6 END AS code FROM facts"""),
    "resolved": (["raw_code"], """SELECT *, cast(CASE WHEN code IN (1, 9) OR (pois = 0 AND simple = 0) THEN code WHEN note THEN 10 ELSE code END AS int) AS resolution FROM raw_code"""),
    "q2": (["in_building", "resolved"], "SELECT i.*, r.resolution, r.pois, r.simple FROM in_building i JOIN resolved r ON r.building_id = i.building_id WHERE r.resolution <> 1"),
    "problem": (["map_entity", "auth_address"], f"""
      SELECT * FROM (SELECT e.osm_id, e.house_ref, a.muni_id AS a_muni_id, e.street, e.house_no, a.proper_name AS a_street, a.house_no AS a_house_no, a.addr_id IS NOT NULL AS known,
        sqrt(cast(power(greatest(abs(a.x - e.x) - e.half, 0), 2) + power(greatest(abs(a.y - e.y) - e.half, 0), 2) AS double)) AS distance, coalesce(a.proper_name = e.street, false) AS street_perfect,
        coalesce({NORM('a.proper_name')} = {NORM('e.street')}, false) AS street_partial, coalesce({NORM_LATIN('a.house_no')} = e.house_no, false) AS number_perfect,
        coalesce({NORM_LATIN('a.house_no')} = {NORM_LATIN('e.house_no')}, false) AS number_partial
      FROM map_entity e LEFT JOIN auth_address a ON a.addr_id = e.house_ref WHERE e.house_ref IS NOT NULL)
      WHERE NOT known OR distance > 50 OR NOT street_perfect OR NOT street_partial OR NOT number_perfect OR NOT number_partial"""),
    "dup": (["map_entity"], """
      SELECT house_ref FROM map_entity WHERE house_ref IS NOT NULL GROUP BY house_ref
      HAVING (count(DISTINCT coalesce(street, '')) > 1 AND count(*) FILTER (WHERE coalesce(street, '') = '') = 0) OR (count(DISTINCT coalesce(house_no, '')) > 1 AND count(*) FILTER (WHERE coalesce(house_no, '') = '') = 0)"""),
}


def q(body: str, *needs: str) -> str:
    return duck(body, *needs, extra=STEPS)


def muni_polygons(w: World):
    return w.muni_polygon.select(F.col("muni_id").alias("polygon_id"), "rings")


def flagged(w: World):
    k = F.col("entity_key")
    note = F.concat(F.when(k % 3 == 0, "x;").otherwise(""), F.lit("Izbrisano iz RGZ-a 2024-0"), (k % 9 + 1).cast("string"), F.when(k % 10 == 0, "-41").otherwise("-15"))
    return w.map_entity.withColumns({"is_removed": (F.col("status") == "P") & F.col("house_ref").isNull(), "removed_ref": F.when(F.col("status") == "P", F.col("osm_id")), "note": note})


def q2(w: World):
    return B.addresses_in_buildings(w.map_node, w.building_polygon)


add("points_in_munis", lambda s, d: points_in_polygons(World(s, d).map_entity.select("osm_id", "x", "y"), muni_polygons(World(s, d)), 1000.0).select("osm_id", F.col("polygon_id").alias("poly_id")),
    q("SELECT osm_id, poly_id FROM in_muni", "in_muni"))
add("unaccounted", lambda s, d: A.unaccounted(flagged(World(s, d)), muni_polygons(World(s, d))).select("osm_id", F.col("polygon_id").alias("poly_id"), "house_no"),
    q("SELECT e.osm_id, i.poly_id, e.house_no FROM entity_flags e JOIN in_muni i ON i.osm_id = e.osm_id WHERE e.house_no IS NOT NULL AND e.house_ref IS NULL AND NOT e.is_removed", "entity_flags", "in_muni"))
add("unaccounted_counts", lambda s, d: RU.with_zero_rows(RU.count_per_muni(A.unaccounted(flagged(World(s, d)), muni_polygons(World(s, d))).drop("muni_id").withColumnRenamed("polygon_id", "muni_id")), World(s, d).muni, "muni_id"),
    q("""SELECT m.muni_id, count(u.osm_id) AS n FROM muni m LEFT JOIN (SELECT e.osm_id, i.poly_id FROM entity_flags e JOIN in_muni i ON i.osm_id = e.osm_id
      WHERE e.house_no IS NOT NULL AND e.house_ref IS NULL AND NOT e.is_removed) u ON u.poly_id = m.muni_id GROUP BY m.muni_id""", "entity_flags", "in_muni", "muni"))
add("removed_on_map", lambda s, d: A.removed_on_map(flagged(World(s, d)), muni_polygons(World(s, d))).select("osm_id", F.col("polygon_id").alias("poly_id"), F.col("removal_date").cast("string").alias("removal_date")),
    q("""SELECT e.osm_id, i.poly_id, CASE WHEN entity_key % 10 <> 0 THEN '2024-0' || (entity_key % 9 + 1) || '-15' END AS removal_date
      FROM entity_flags e JOIN in_muni i ON i.osm_id = e.osm_id WHERE removed_ref IS NOT NULL""", "entity_flags", "in_muni"))
add("removed_counts", lambda s, d: RU.removed_counts(A.removed_on_map(flagged(World(s, d)), muni_polygons(World(s, d))).drop("muni_id").withColumnRenamed("polygon_id", "muni_id"), World(s, d).muni),
    q("""SELECT m.muni_id, coalesce(r.removed, 0) AS removed, coalesce(r.readded, 0) AS readded FROM muni m LEFT JOIN (SELECT i.poly_id, count(*) AS removed, count(e.house_ref) AS readded
      FROM entity_flags e JOIN in_muni i ON i.osm_id = e.osm_id WHERE removed_ref IS NOT NULL GROUP BY 1) r ON r.poly_id = m.muni_id""", "entity_flags", "in_muni", "muni"))
add("nodes_in_buildings", lambda s, d: B.nodes_in_buildings(World(s, d).map_node, World(s, d).building_polygon).select("osm_id", "building_id"), q("SELECT osm_id, building_id FROM in_building", "in_building"))
add("building_resolution", lambda s, d: B.resolution(B.building_facts(B.nodes_in_buildings(World(s, d).map_node, World(s, d).building_polygon))).select("building_id", "resolution", "pois", "simple", "addresses"),
    q("SELECT building_id, resolution, pois, simple, addresses FROM resolved", "resolved"))
add("addresses_in_buildings", lambda s, d: q2(World(s, d)).select("osm_id", "building_id", "muni_id", "resolution", "pois", "simple"), q("SELECT osm_id, building_id, muni_id, resolution, pois, simple FROM q2", "q2"))
CODES = {c: n.lower() for c, n in B.RESOLUTIONS.items() if c != 1}
add("resolution_breakdown", lambda s, d: B.resolution_breakdown(q2(World(s, d)), World(s, d).muni),
    q("SELECT m.muni_id, " + ", ".join(f"count(DISTINCT building_id) FILTER (WHERE resolution = {c}) AS {n}" for c, n in CODES.items())
      + ", count(DISTINCT building_id) AS total FROM muni m LEFT JOIN q2 ON q2.muni_id = m.muni_id GROUP BY m.muni_id", "q2", "muni"))
add("building_listing", lambda s, d: B.building_listing(q2(World(s, d))).drop("any_ref"),
    q("SELECT building_id, concat_ws(' ', any_value(b_street), any_value(b_house_no)) AS building_address, count(*) AS nodes, count(*) FILTER (WHERE is_poi) AS pois, CASE any_value(resolution) "
      + " ".join(f"WHEN {c} THEN '{n}'" for c, n in B.RESOLUTIONS.items()) + " END AS resolution_name FROM q2 GROUP BY building_id", "q2"))
add("import_check", lambda s, d: A.import_check(World(s, d).map_entity, auth(World(s, d))).withColumn("distance", F.round("distance", 6)).withColumn("priority", A.import_priority()),
    q("""SELECT * REPLACE (round(distance, 6) AS distance), cast(CASE WHEN NOT known THEN 1 WHEN NOT street_perfect AND NOT street_partial THEN 2 WHEN NOT number_perfect AND NOT number_partial THEN 3
      WHEN NOT street_perfect THEN 4 ELSE 5 END AS int) AS priority FROM problem""", "problem"))
NOTES = ["RGZ: proveriti", "Izbrisano iz RGZ-a 2024-01-15", "RGZ; Izbrisano iz RGZ-a 2024-01-15", "bez broja"]
add("import_notes", lambda s, d: (lambda w: A.import_check(w.map_entity.withColumn("note", F.get(F.array(*[F.lit(n) for n in NOTES]), (F.col("entity_key") % 5).cast("int"))), auth(w)))(World(s, d)).select("osm_id", "note"),
    q(f"""SELECT p.osm_id, CASE WHEN contains(n, 'RGZ') AND NOT contains(n, 'Izbrisano iz RGZ-a') THEN n ELSE '' END AS note
      FROM problem p JOIN (SELECT osm_id, {NOTES}[entity_key % 5 + 1] AS n FROM map_entity) USING (osm_id)""", "problem", "map_entity"))
add("import_too_far", lambda s, d: A.import_check(World(s, d).map_entity, auth(World(s, d))).where("distance >= 30").select("osm_id", F.round("distance", 6).alias("distance")),
    q("SELECT osm_id, round(distance, 6) AS distance FROM problem WHERE distance >= 30", "problem"))
add("duplicated_refs", lambda s, d: A.duplicated_refs(World(s, d).map_entity, World(s, d).auth_address).select("house_ref", "osm_id", "street", "house_no", "muni_name", "entities"),
    q("""SELECT e.house_ref, e.osm_id, coalesce(e.street, '') AS street, coalesce(e.house_no, '') AS house_no, coalesce(a.muni_name, 'N/A') AS muni_name, count(*) OVER (PARTITION BY e.house_ref) AS entities
      FROM map_entity e JOIN dup d ON d.house_ref = e.house_ref LEFT JOIN auth_address a ON a.addr_id = e.house_ref""", "map_entity", "dup", "auth_address"))
add("ref_inventory", lambda s, d: __import__("addrweave.sources.elements", fromlist=["x"]).ref_inventory(World(s, d).map_entity),
    q("SELECT house_ref, count(*) AS entities, min(osm_id) AS first_id FROM map_entity WHERE house_ref IS NOT NULL GROUP BY house_ref", "map_entity"))


def with_state(w: World):
    return matched(w).withColumn("state", A.progress_state())


add("address_progress", lambda s, d: RU.address_progress(with_state(World(s, d)), World(s, d).map_entity).withColumns({"ratio": F.round("ratio", 6), "level": F.col("level").cast("int")}),
    q("""SELECT g.*, m.on_map FROM (SELECT muni_id, settl_id, count(*) AS authority, count(*) FILTER (WHERE state = 'conflated') AS conflated, count(*) FILTER (WHERE state = 'matched') AS matched,
        count(*) FILTER (WHERE state = 'partial') AS partial, count(*) FILTER (WHERE state = 'not_found') AS not_found, cast(grouping(muni_id, settl_id) AS int) AS level,
        round(100.0 * count(*) FILTER (WHERE state = 'conflated') / count(*), 6) AS ratio FROM q1 GROUP BY GROUPING SETS ((muni_id, settl_id), (muni_id), ())) g
      LEFT JOIN (SELECT muni_id, count(*) AS on_map, CASE WHEN grouping(muni_id) = 1 THEN 3 ELSE 1 END AS level FROM map_entity GROUP BY GROUPING SETS ((muni_id), ())) m
        ON m.muni_id IS NOT DISTINCT FROM g.muni_id AND m.level = g.level""", "q1", "map_entity"))
add("building_ratio", lambda s, d: (lambda w: SE.settlement_building_ratio(auth(w), w.map_entity.where("rings IS NOT NULL"), w.settl_polygon, 500.0))(World(s, d)).withColumns(
    {"ratio": F.round("ratio", 6), "ratio_order": F.round("ratio_order", 6)}),
    q("""SELECT settl_id, addresses, buildings, round(least(100.0 * buildings / nullif(addresses, 0), 100000.0), 6) AS ratio, round(coalesce(least(100.0 * buildings / nullif(addresses, 0), 100000.0), 100001.0), 6) AS ratio_order
      FROM (SELECT settl_id, (SELECT count(*) FROM auth_address a WHERE a.x BETWEEN bx0 AND bx1 AND a.y BETWEEN by0 AND by1) AS addresses,
        (SELECT count(*) FROM map_entity e WHERE e.half > 0 AND e.x + e.half >= bx0 AND e.x - e.half <= bx1 AND e.y + e.half >= by0 AND e.y - e.half <= by1) AS buildings FROM settl_box)""", "auth_address", "map_entity", "settl_box"))
add("entities_in_munis", lambda s, d: (lambda w: entities_in_areas(w.map_entity.select("osm_id", "x", "y", "rings"), w.muni_polygon.select(F.col("muni_id").alias("area_id"), "rings").unionByName(
    w.settl_polygon.select(F.col("muni_id").alias("area_id"), "rings")), 500.0))(World(s, d)),
    duck("SELECT osm_id, muni_id AS area_id FROM in_box UNION SELECT osm_id, muni_id FROM in_ring", "in_box", "in_ring", extra={
        **STEPS,
        "in_box": (["map_entity", "settl_box"], """SELECT e.osm_id, b.muni_id FROM map_entity e JOIN settl_box b ON e.x + e.half >= bx0 AND e.x - e.half <= bx1 AND e.y + e.half >= by0 AND e.y - e.half <= by1"""),
        "side": (["muni_edge"], """SELECT muni_id, x1, y1, x2, y2, min(x1) OVER w AS bx0, max(x1) OVER w AS bx1, min(y1) OVER w AS by0, max(y1) OVER w AS by1 FROM muni_edge WINDOW w AS (PARTITION BY muni_id)"""),
        "in_ring": (["map_entity", "side"], """
          SELECT osm_id, muni_id FROM (SELECT e.osm_id, e.x, e.y, e.half, m.muni_id, m.x1, m.y1, m.x2, m.y2 FROM map_entity e JOIN side m ON e.x + e.half >= bx0 AND e.x - e.half <= bx1 AND e.y + e.half >= by0 AND e.y - e.half <= by1)
          GROUP BY osm_id, muni_id
          HAVING bool_and((x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) + half * (abs(x2 - x1) + abs(y2 - y1)) >= 0)"""),  # a convex ring meets a square that no side and no box parts from it
    }))
add("distinct_values", lambda s, d: RU.distinct_values(World(s, d).map_entity.where("house_ref IS NOT NULL"), ["house_ref"], "street", "house_no"),
    q("""SELECT DISTINCT house_ref, 'street' AS attribute, street AS value FROM map_entity WHERE house_ref IS NOT NULL AND street IS NOT NULL
      UNION ALL SELECT DISTINCT house_ref, 'house_no', house_no FROM map_entity WHERE house_ref IS NOT NULL AND house_no IS NOT NULL""", "map_entity"))
add("first_value", lambda s, d: RU.first_value(World(s, d).map_entity.where("street IS NOT NULL"), ["muni_id"], "street", "osm_id"),
    q("SELECT muni_id, arg_min(street, osm_id) AS street FROM map_entity WHERE street IS NOT NULL GROUP BY muni_id", "map_entity"))
add("merged_tags", lambda s, d: RU.merged_tags(World(s, d).map_entity.where("house_ref IS NOT NULL").select("house_ref", F.create_map(F.lit("addr:street"), F.coalesce("street", F.lit("")), F.lit("status"), F.col("status")).alias("tags")), "house_ref"),
    q("""SELECT house_ref, tag, string_agg(value, ';' ORDER BY value) AS value FROM (SELECT DISTINCT house_ref, 'addr:street' AS tag, coalesce(street, '') AS value FROM map_entity WHERE house_ref IS NOT NULL
      UNION ALL SELECT DISTINCT house_ref, 'status', status FROM map_entity WHERE house_ref IS NOT NULL) GROUP BY house_ref, tag""", "map_entity"))
add("group_bounds", lambda s, d: G.group_bounds(auth(World(s, d)), ["settl_id"]), q("SELECT settl_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM auth_address GROUP BY settl_id", "auth_address"))
add("settlement_seeds", lambda s, d: SE.seeds(auth(World(s, d))).withColumns({"x": F.round("x", 4), "y": F.round("y", 4)}),
    q("SELECT muni_id, settl_id, round(avg(x), 4) AS x, round(avg(y), 4) AS y, count(*) AS addresses FROM auth_address GROUP BY muni_id, settl_id", "auth_address"))
add("nearest_settlement", lambda s, d: SE.nearest_seed(World(s, d).map_entity.select("osm_id", "muni_id", "x", "y"), SE.seeds(auth(World(s, d)))).select("osm_id", "nearest_settl_id", F.round("seed_distance", 4).alias("seed_distance")),
    q("""SELECT osm_id, arg_min(settl_id, (d, settl_id)) AS nearest_settl_id, round(min(d), 4) AS seed_distance FROM (SELECT e.osm_id, s.settl_id, sqrt((e.x - s.x) * (e.x - s.x) + (e.y - s.y) * (e.y - s.y)) AS d
      FROM map_entity e JOIN (SELECT muni_id, settl_id, avg(x) AS x, avg(y) AS y FROM auth_address GROUP BY ALL) s ON s.muni_id = e.muni_id) GROUP BY osm_id""", "map_entity", "auth_address"))
add("settlement_borders", lambda s, d: SE.settlement_borders(auth(World(s, d)), World(s, d).muni_polygon).withColumn("c", G.area_and_centroid("rings")).select(
    "muni_id", "settl_id", "addresses", F.round("c.area", 1).alias("area"), F.round("c.x", 3).alias("cx"), F.round("c.y", 3).alias("cy")),
    duck("""
      SELECT any_value(muni_id) AS muni_id, settl_id, any_value(addresses) AS addresses, round(any_value(doubled) / 2, 1) AS area,
        round(any_value(x0) + any_value(sx) / (3 * any_value(doubled)), 3) AS cx, round(any_value(y0) + any_value(sy) / (3 * any_value(doubled)), 3) AS cy
      FROM tile_sum GROUP BY settl_id""", "tile_sum", extra={
        "seed": (["auth_address"], "SELECT muni_id, settl_id, avg(x) AS x0, avg(y) AS y0, count(*) AS addresses FROM auth_address GROUP BY muni_id, settl_id"),
        "plane": (["seed", "muni_edge"], """
          SELECT s.settl_id, cast(m.y2 - m.y1 AS double) AS nx, cast(m.x1 - m.x2 AS double) AS ny, cast(m.y2 - m.y1 AS double) * (m.x1 - x0) + cast(m.x1 - m.x2 AS double) * (m.y1 - y0) AS c FROM seed s JOIN muni_edge m ON m.muni_id = s.muni_id
          UNION ALL
          SELECT a.settl_id, b.x0 - a.x0, b.y0 - a.y0, ((b.x0 - a.x0) * (b.x0 - a.x0) + (b.y0 - a.y0) * (b.y0 - a.y0)) / 2 FROM seed a JOIN seed b ON a.muni_id = b.muni_id AND (a.x0 <> b.x0 OR a.y0 <> b.y0)"""),
        "unit": (["plane"], "SELECT settl_id, nx / sqrt(nx * nx + ny * ny) AS nx, ny / sqrt(nx * nx + ny * ny) AS ny, c / sqrt(nx * nx + ny * ny) AS c, row_number() OVER (PARTITION BY settl_id) AS k FROM plane"),
        "corner": (["unit"], """
          SELECT p.settl_id, (p.c * q.ny - q.c * p.ny) / (p.nx * q.ny - q.nx * p.ny) AS x, (p.nx * q.c - q.nx * p.c) / (p.nx * q.ny - q.nx * p.ny) AS y
          FROM unit p JOIN unit q ON p.settl_id = q.settl_id AND p.k < q.k AND abs(p.nx * q.ny - q.nx * p.ny) > 1e-9"""),
        "tile_corner": (["corner", "unit"], """
          SELECT c.settl_id, round(c.x, 6) AS rx, round(c.y, 6) AS ry, any_value(c.x) AS x, any_value(c.y) AS y, atan2(any_value(c.y), any_value(c.x)) AS turn FROM corner c JOIN unit u ON u.settl_id = c.settl_id
          GROUP BY c.settl_id, c.x, c.y HAVING max(u.nx * c.x + u.ny * c.y - u.c) < 1e-6"""),
        "tile_edge": (["tile_corner"], """
          SELECT settl_id, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
          FROM (SELECT settl_id, rx, ry, any_value(x) AS x, any_value(y) AS y, any_value(turn) AS turn FROM tile_corner GROUP BY settl_id, rx, ry) WINDOW w AS (PARTITION BY settl_id ORDER BY turn)"""),
        "tile_sum": (["tile_edge", "seed"], """
          SELECT s.*, t.doubled, t.sx, t.sy FROM seed s LEFT JOIN (SELECT settl_id, sum(x * y2 - x2 * y) AS doubled, sum((x + x2) * (x * y2 - x2 * y)) AS sx, sum((y + y2) * (x * y2 - x2 * y)) AS sy FROM tile_edge GROUP BY settl_id) t
          ON t.settl_id = s.settl_id AND NOT EXISTS (SELECT 1 FROM seed o WHERE o.muni_id = s.muni_id AND o.x0 = s.x0 AND o.y0 = s.y0 AND o.settl_id < s.settl_id)"""),
    }))
add("address_listing", lambda s, d: SE.address_listing(matched(World(s, d))).withColumns({"score": F.round("score", 6), "distance": F.round("distance", 6)}),
    q("""SELECT addr_id, settl_id, street, house_no, lpad(cast(rk AS varchar), cast(length(cast(mx AS varchar)) AS int), '0') || '-' || lpad(regexp_extract(house_no, '^([0-9]+)', 1), 5, '0') || regexp_extract(house_no, '^[0-9]+(.*)$', 1) AS sort_key,
        'https://www.openstreetmap.org/' || CASE conflated_osm_id[1] WHEN 'n' THEN 'node' WHEN 'w' THEN 'way' ELSE 'relation' END || '/' || substr(conflated_osm_id, 2) AS conflated_link,
        CASE WHEN conflated_osm_id IS NULL THEN 'https://www.openstreetmap.org/' || CASE osm_id[1] WHEN 'n' THEN 'node' WHEN 'w' THEN 'way' ELSE 'relation' END || '/' || substr(osm_id, 2) END AS candidate_link,
        round(CASE WHEN conflated_osm_id IS NOT NULL OR (osm_id IS NOT NULL AND matching) THEN 1.0 WHEN osm_id IS NOT NULL THEN score END, 6) AS score,
        round(CASE WHEN conflated_osm_id IS NOT NULL THEN conflated_distance ELSE distance END, 6) AS distance
      FROM (SELECT q1.*, dense_rank() OVER (PARTITION BY settl_id ORDER BY translate(upper(street), 'АБВГДЂЕЖЗИЈКЛЉМНЊОПРСТЋУФХЦЧЏШ', '"""
      + "".join(chr(0xE000 + i) for i in range(30)) + """'), street) AS rk FROM q1) JOIN (SELECT settl_id, count(DISTINCT street) AS mx FROM q1 GROUP BY settl_id) USING (settl_id)""", "q1"))
add("place_settlements", lambda s, d: (lambda w: SE.place_settlements(auth(w).withColumn("settl_id", F.col("street_id")), w.street.select(
    F.col("street_id").alias("settl_id"), F.when(F.col("street_id") % 2 == 0, T.cyr2lat("proper_name")).otherwise("Насеље").alias("settl_name"))))(World(s, d)),
    q("SELECT street_id AS settl_id, min(proper_name) AS street, street_id % 2 = 0 AS use_place FROM auth_address GROUP BY street_id HAVING count(DISTINCT proper_name) = 1", "auth_address"))
add("fill_settlements", lambda s, d: (lambda w: SE.fill_settlements(w.map_entity.select(F.col("osm_id").alias("addr_id"), "x", "y"), muni_polygons(w), 1000.0).select("addr_id", "polygon_id", F.round("distance", 4).alias("distance")))(World(s, d)),
    q(_dst("""SELECT e.osm_id AS addr_id, coalesce(i.pid, arg_min(m.muni_id, (m.d, m.muni_id))) AS polygon_id, CASE WHEN i.pid IS NOT NULL THEN 0.0 ELSE round(min(m.d), 4) END AS distance
      FROM map_entity e LEFT JOIN (SELECT osm_id, min(poly_id) AS pid FROM in_muni GROUP BY 1) i ON i.osm_id = e.osm_id
      LEFT JOIN (SELECT a.osm_id, g.muni_id, DST(a.x, a.y, g.x1, g.y1, g.x2, g.y2) AS d FROM map_entity a CROSS JOIN muni_edge g WHERE a.osm_id NOT IN (SELECT osm_id FROM in_muni)) m ON m.osm_id = e.osm_id
      GROUP BY e.osm_id, i.pid"""), "map_entity", "in_muni", "muni_edge"))
WAYS = {**STEPS, "seg_edge": (["way_segment", "muni_edge"], """SELECT w.osm_id, m.muni_id, w.x1, w.y1, w.x2, w.y2, m.x1 AS u1, m.y1 AS v1, m.x2 AS u2, m.y2 AS v2 FROM way_segment w JOIN muni_edge m
        ON least(w.x1, w.x2) - 100 <= greatest(m.x1, m.x2) AND least(m.x1, m.x2) <= greatest(w.x1, w.x2) + 100 AND least(w.y1, w.y2) - 100 <= greatest(m.y1, m.y2) AND least(m.y1, m.y2) <= greatest(w.y1, w.y2) + 100"""),
        "vert_in": (["way_vertex", "muni_edge"], f"""SELECT osm_id, muni_id FROM (SELECT v.osm_id, v.pos, v.x AS px, v.y AS py, m.muni_id, m.x1, m.y1, m.x2, m.y2 FROM way_vertex v
          JOIN (SELECT *, min(x1) OVER w AS bx0, max(x1) OVER w AS bx1, min(y1) OVER w AS by0, max(y1) OVER w AS by1 FROM muni_edge WINDOW w AS (PARTITION BY muni_id)) m ON v.x BETWEEN bx0 AND bx1 AND v.y BETWEEN by0 AND by1)
          GROUP BY osm_id, pos, px, py, muni_id HAVING {inside_sql('px', 'py')}""")}
add("ways_in_munis", lambda s, d: (lambda w: lines_in_polygons(w.way_line.select(F.col("osm_id").alias("line_id"), "lines"), muni_polygons(w), 1000.0, 100.0))(World(s, d)),
    duck(_dst("""SELECT DISTINCT osm_id AS line_id, muni_id AS polygon_id FROM seg_edge WHERE DST(x1, y1, u1, v1, u2, v2) <= 100 OR DST(x2, y2, u1, v1, u2, v2) <= 100 OR DST(u1, v1, x1, y1, x2, y2) <= 100 OR DST(u2, v2, x1, y1, x2, y2) <= 100
      OR (sign((x2 - x1) * (v1 - y1) - (y2 - y1) * (u1 - x1)) * sign((x2 - x1) * (v2 - y1) - (y2 - y1) * (u2 - x1)) < 0 AND sign((u2 - u1) * (y1 - v1) - (v2 - v1) * (x1 - u1)) * sign((u2 - u1) * (y2 - v1) - (v2 - v1) * (x2 - u1)) < 0)
      UNION SELECT osm_id, muni_id FROM vert_in"""), "seg_edge", "vert_in", extra=WAYS))
add("duplicate_numbers", lambda s, d: R.with_group_counts(World(s, d).map_entity.select("osm_id", "muni_id", "street", "house_no"), ["muni_id", "street", "house_no"], copies=F.lit(True)).select("osm_id", "copies"),
    q("""SELECT osm_id, CASE WHEN street IS NULL OR house_no IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY muni_id, street, house_no) END AS copies FROM map_entity""", "map_entity"))
add("address_batches", lambda s, d: R.batch_numbers(auth(World(s, d)), ["muni_id"], ["street", "house_no", "addr_id"], 4).select("addr_id", "batch_no"),
    q("SELECT addr_id, cast(floor((row_number() OVER (PARTITION BY muni_id ORDER BY proper_name, house_no, addr_id) - 1) / 4) AS bigint) AS batch_no FROM auth_address", "auth_address"))
add("report_order", lambda s, d: A.import_check(World(s, d).map_entity, auth(World(s, d))).orderBy("a_muni_id", "a_street", "a_house_no", "osm_id").select("osm_id", "a_muni_id", "a_street", "a_house_no"),
    q("SELECT osm_id, a_muni_id, a_street, a_house_no FROM problem ORDER BY a_muni_id, a_street, a_house_no, osm_id", "problem"))
add("flag_duplicates", lambda s, d: R.flag_duplicates(World(s, d).map_entity.select("osm_id", F.coalesce("house_ref", F.lit("")).alias("house_ref")), "house_ref", [F.asc("osm_id")]),
    q("""SELECT osm_id, coalesce(house_ref, '') AS house_ref, house_ref IS NOT NULL AND count(*) OVER (PARTITION BY house_ref) > 1 AS is_duplicate,
      house_ref IS NOT NULL AND row_number() OVER (PARTITION BY house_ref ORDER BY osm_id) > 1 AS is_repeat FROM map_entity""", "map_entity"))
add("duplicate_keys", lambda s, d: RU.duplicate_keys(World(s, d).map_entity.where("house_ref IS NOT NULL"), "house_ref"),
    q("SELECT house_ref, count(*) AS copies FROM map_entity WHERE house_ref IS NOT NULL GROUP BY 1 HAVING count(*) > 1", "map_entity"))
