"""Address matching and its checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from addrweave.operators import ranking as R
from addrweave.plans import address as A
from addrweave.session import checkpoint_dir
from addrweave.streaming.incremental import IncrementalMatch
from registry.sql import NORM, NORM_LATIN, lcs_sql, number_similarity_sql
from registry.world import World, duck

QUERIES, ORACLES = {}, {}


def auth(w: World):
    return w.auth_address.select("addr_id", "muni_id", "muni_name", "settl_id", "street_id", "street_code", F.col("proper_name").alias("street"), "house_no", "x", "y")


def matched(w: World):
    return A.match_addresses(auth(w), w.map_entity)


# --- shared SQL steps of the match
STEPS = {
    "m_entity": (["map_entity"], f"SELECT *, {NORM('street')} AS m_street, {NORM('house_no')} AS m_number FROM map_entity"),
    "a_address": (["auth_address"], f"SELECT *, {NORM('proper_name')} AS a_street, {NORM('house_no')} AS a_number FROM auth_address"),
    "carried": (["map_entity", "auth_address"], """
      SELECT * EXCLUDE (rn) FROM (SELECT a.addr_id, e.osm_id AS conflated_osm_id, e.street AS conflated_street, e.house_no AS conflated_house_no,
        sqrt(cast(power(greatest(abs(a.x - e.x) - e.half, 0), 2) + power(greatest(abs(a.y - e.y) - e.half, 0), 2) AS double)) AS conflated_distance,
        row_number() OVER (PARTITION BY a.addr_id ORDER BY power(greatest(abs(a.x - e.x) - e.half, 0), 2) + power(greatest(abs(a.y - e.y) - e.half, 0), 2), e.osm_id) AS rn
      FROM auth_address a JOIN map_entity e ON e.house_ref = a.addr_id) WHERE rn = 1"""),
    "near": (["a_address", "m_entity"], """
      SELECT a.addr_id, a.a_street, a.a_number, e.osm_id, e.street AS osm_street, e.house_no AS osm_house_no, e.m_street, e.m_number,
        sqrt(cast(power(greatest(abs(a.x - e.x) - e.half, 0), 2) + power(greatest(abs(a.y - e.y) - e.half, 0), 2) AS double)) AS distance
      FROM a_address a JOIN m_entity e ON e.muni_id = a.muni_id AND e.house_ref IS NULL
       AND power(greatest(abs(a.x - e.x) - e.half, 0), 2) + power(greatest(abs(a.y - e.y) - e.half, 0), 2) <= 40000"""),
    "name_pair": (["near"], f"""
      SELECT a_street, m_street, CASE WHEN a_street = m_street THEN 1.0 ELSE 2.0 * {lcs_sql('a_street', 'm_street')} / (length(a_street) + length(m_street)) END AS name_score
      FROM (SELECT DISTINCT a_street, m_street FROM near WHERE m_street IS NOT NULL)"""),
    "scored": (["near", "name_pair"], f"""
      SELECT n.*, coalesce(n.a_street = n.m_street AND n.a_number = n.m_number, false) AS matching,
        round(0.33 * coalesce(p.name_score, 0.0) + 0.33 * {number_similarity_sql('n.a_number', 'n.m_number')}
          + 0.33 * (((500.0 - greatest(0.0, least(500.0, n.distance))) / 500.0) * ((500.0 - greatest(0.0, least(500.0, n.distance))) / 500.0)), 9) AS score
      FROM near n LEFT JOIN name_pair p ON p.a_street = n.a_street AND p.m_street = n.m_street"""),
    "cleared": (["scored"], """
      SELECT * FROM (SELECT *, bool_or(matching) OVER (PARTITION BY osm_id) AS taken FROM scored) WHERE matching OR NOT taken"""),
    "given": (["cleared"], """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY score DESC, addr_id) AS rn3 FROM cleared) WHERE rn3 = 1"""),
    "best": (["given"], """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY addr_id ORDER BY matching DESC, score DESC, osm_id DESC) AS rn4 FROM given) WHERE rn4 = 1"""),
    "q1": (["auth_address", "carried", "best"], """
      SELECT a.addr_id, a.muni_id, a.muni_name, a.settl_id, a.street_id, a.street_code, a.proper_name AS street, a.house_no, a.x, a.y, c.conflated_osm_id, c.conflated_street,
        c.conflated_house_no, c.conflated_distance, b.osm_id, b.osm_street, b.osm_house_no, b.distance, coalesce(b.score, 0.0) AS score,
        coalesce(b.matching, false) AS matching,
        CASE WHEN c.conflated_osm_id IS NOT NULL THEN 'conflated' WHEN b.osm_id IS NOT NULL AND b.matching THEN 'matched'
             WHEN b.osm_id IS NOT NULL THEN 'partial' ELSE 'not_found' END AS state
      FROM auth_address a LEFT JOIN carried c ON c.addr_id = a.addr_id LEFT JOIN best b ON b.addr_id = a.addr_id"""),
}


def q(body: str, *needs: str) -> str:
    return duck(body, *needs, extra=STEPS)


QUERIES["match_addresses"] = lambda s, d: matched(World(s, d)).select(
    "addr_id", "muni_id", "conflated_osm_id", F.round("conflated_distance", 6).alias("conflated_distance"), "osm_id", "osm_street", "osm_house_no",
    F.round("distance", 6).alias("distance"), "score", "matching", A.progress_state().alias("state"))
ORACLES["match_addresses"] = q("""SELECT addr_id, muni_id, conflated_osm_id, round(conflated_distance, 6) AS conflated_distance, osm_id, osm_street, osm_house_no,
  round(distance, 6) AS distance, score, matching, state FROM q1""", "q1")

QUERIES["conflation_join"] = lambda s, d: A.conflate(auth(World(s, d)), World(s, d).map_entity).withColumn("conflated_distance", F.round("conflated_distance", 6))
ORACLES["conflation_join"] = q("SELECT * REPLACE (round(conflated_distance, 6) AS conflated_distance) FROM carried", "carried")

QUERIES["radius_candidates"] = lambda s, d: A.candidates(auth(World(s, d)), World(s, d).map_entity).withColumn("distance", F.round("distance", 6))
ORACLES["radius_candidates"] = q("""SELECT a.addr_id, a.muni_id, n.osm_id, round(n.distance, 6) AS distance FROM auth_address a LEFT JOIN near n ON n.addr_id = a.addr_id""", "near")


def streamed(s, d):
    """The first map, then the changes of ``events`` as a stream of two micro-batches, each of any number of files."""
    w = World(s, d)
    root = f"{checkpoint_dir(s)}/stream-{uuid.uuid4().hex}"
    half = w.table("events").agg(F.max("event_id")).first()[0] // 2
    changes = w.map_change
    inc = IncrementalMatch(s, auth(w), f"{root}/state")
    inc.start(w.map_entity)
    for part in (changes.where(F.col("change_no") <= half), changes.where(F.col("change_no") > half)):  # a batch holds what has come since the last one
        part.write.mode("append").parquet(f"{root}/changes")
        query = inc.run(f"{root}/changes", changes.schema, f"{root}/checkpoint", files_per_batch=None)
        query.awaitTermination()
    return inc.current()


def after_changes(body: str) -> str:
    """The steps of the match over the map after all events."""
    steps = {name: (["map_after" if n == "map_entity" else n for n in needs], sql.replace("map_entity", "map_after")) for name, (needs, sql) in STEPS.items()}
    return duck(body, "q1", extra=steps)


QUERIES["stream_matching"] = lambda s, d: streamed(s, d).select(
    "addr_id", "muni_id", "conflated_osm_id", F.round("conflated_distance", 6).alias("conflated_distance"), "osm_id", "osm_street", "osm_house_no",
    F.round("distance", 6).alias("distance"), "score", "matching")
ORACLES["stream_matching"] = after_changes("""SELECT addr_id, muni_id, conflated_osm_id, round(conflated_distance, 6) AS conflated_distance, osm_id, osm_street, osm_house_no,
  round(distance, 6) AS distance, score, matching FROM q1""")
