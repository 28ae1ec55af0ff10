"""Street matching, name mismatch, missing geometry, progress, rings and name rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from addrweave.operators import ranking as R
from addrweave.operators.cells import lines_in_polygons
from addrweave.operators.lines import covered_by_partners, covered_length, hausdorff, is_ring
from addrweave.plans import streets as ST
from addrweave.functions import geometry as G
from addrweave.functions import names as N
from registry.sql import NORM, _dst
from registry.text_queries import NAMED, named_streets
from registry.world import World, duck

QUERIES, ORACLES = {}, {}
NO_STREET = "(" + ", ".join(f"'{c}'" for c in ST.NO_STREET) + ")"


def stretch_sql(source: str, r: float) -> tuple[str, ...]:
    """CTE bodies giving lo, hi of the left segment (x1..y2) near the right one (u1..v2); fs/fe mark flat ends."""
    a = f"""SELECT *, cast(x2 - x1 AS double) AS dx, cast(y2 - y1 AS double) AS dy, cast(u2 - u1 AS double) AS ex, cast(v2 - v1 AS double) AS ey,
      sqrt(cast((u2-u1)*(u2-u1)+(v2-v1)*(v2-v1) AS double)) AS n FROM {source}
      WHERE least(x1,x2) - {r} <= greatest(u1,u2) AND least(u1,u2) <= greatest(x1,x2) + {r} AND least(y1,y2) - {r} <= greatest(v1,v2) AND least(v1,v2) <= greatest(y1,y2) + {r}"""
    b = f"""SELECT *, ((x1-u1)*ex+(y1-v1)*ey)/n AS f0, (dx*ex+dy*ey)/n AS fd, ((x1-u1)*ey-(y1-v1)*ex)/n AS g0, (dx*ey-dy*ex)/n AS gd, dx*dx+dy*dy AS qa,
      dx*(x1-u1)+dy*(y1-v1) AS b1, (x1-u1)*(x1-u1)+(y1-v1)*(y1-v1)-{r * r} AS c1, dx*(x1-u2)+dy*(y1-v2) AS b2, (x1-u2)*(x1-u2)+(y1-v2)*(y1-v2)-{r * r} AS c2 FROM A_"""

    def slab(f0, fd, low, high):
        lo = f"CASE WHEN {fd} = 0 THEN CASE WHEN {f0} BETWEEN {low} AND {high} THEN 0.0 ELSE 2.0 END ELSE least(({low} - {f0}) / {fd}, ({high} - {f0}) / {fd}) END"
        hi = f"CASE WHEN {fd} = 0 THEN CASE WHEN {f0} BETWEEN {low} AND {high} THEN 1.0 ELSE -1.0 END ELSE greatest(({low} - {f0}) / {fd}, ({high} - {f0}) / {fd}) END"
        return lo, hi
    sa, sb = slab("f0", "fd", "0.0", "n"), slab("g0", "gd", f"-{r}", f"{r}")
    c = f"""SELECT *, greatest({sa[0]}, {sb[0]}, 0.0) AS plo, least({sa[1]}, {sb[1]}, 1.0) AS phi,
      CASE WHEN NOT fs AND b1*b1 - qa*c1 >= 0 THEN greatest((-b1 - sqrt(b1*b1 - qa*c1)) / qa, 0.0) ELSE 2.0 END AS d1lo, CASE WHEN NOT fs AND b1*b1 - qa*c1 >= 0 THEN least((-b1 + sqrt(b1*b1 - qa*c1)) / qa, 1.0) ELSE -1.0 END AS d1hi,
      CASE WHEN NOT fe AND b2*b2 - qa*c2 >= 0 THEN greatest((-b2 - sqrt(b2*b2 - qa*c2)) / qa, 0.0) ELSE 2.0 END AS d2lo, CASE WHEN NOT fe AND b2*b2 - qa*c2 >= 0 THEN least((-b2 + sqrt(b2*b2 - qa*c2)) / qa, 1.0) ELSE -1.0 END AS d2hi
      FROM B_"""
    d = """SELECT *, least(CASE WHEN plo <= phi THEN plo ELSE 2.0 END, CASE WHEN d1lo <= d1hi THEN d1lo ELSE 2.0 END, CASE WHEN d2lo <= d2hi THEN d2lo ELSE 2.0 END) AS lo,
      greatest(CASE WHEN plo <= phi THEN phi ELSE -1.0 END, CASE WHEN d1lo <= d1hi THEN d1hi ELSE -1.0 END, CASE WHEN d2lo <= d2hi THEN d2hi ELSE -1.0 END) AS hi FROM C_"""
    return a, b, c, d


def coverage(prefix: str, source: str, needs: list[str], keys: str, r: float = 30.0) -> dict:
    a, b, c, d = stretch_sql(source, r)
    union = f"""SELECT {keys}, sum(add_) AS covered FROM (
      SELECT {keys}, sqrt(qa) * greatest(0.0, hi - greatest(lo, coalesce(max(hi) OVER (PARTITION BY {keys}, seg ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))) AS add_
      FROM {prefix}_d WHERE lo <= hi) GROUP BY {keys}"""
    return {f"{prefix}_a": (needs, a), f"{prefix}_b": ([f"{prefix}_a"], b.replace("A_", f"{prefix}_a")), f"{prefix}_c": ([f"{prefix}_b"], c.replace("B_", f"{prefix}_b")),
            f"{prefix}_d": ([f"{prefix}_c"], d.replace("C_", f"{prefix}_c")), f"{prefix}_cov": ([f"{prefix}_d"], union)}


STEPS = {
    "way_len": (["way_segment"], """SELECT osm_id, sum(sqrt(cast((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) AS double))) AS way_length FROM way_segment GROUP BY osm_id"""),
    "street_len": (["street_segment"], """SELECT street_id, sum(sqrt(cast((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) AS double))) AS street_length FROM street_segment GROUP BY street_id"""),
    "free_near": (["way_segment", "street_segment"], f"""
      SELECT w.osm_id, s.street_id, w.seg, w.x1, w.y1, w.x2, w.y2, s.x1 AS u1, s.y1 AS v1, s.x2 AS u2, s.y2 AS v2, false AS fs, false AS fe
      FROM way_segment w JOIN street_segment s ON s.muni_id = w.muni_id WHERE w.street_ref IS NULL AND w.highway NOT IN {NO_STREET}"""),
    **coverage("nr", "free_near", ["free_near"], "osm_id, street_id"),
    "shares": (["nr_cov", "way_len", "way_base"], """
      SELECT c.osm_id, c.street_id, w.muni_id, w.name, l.way_length, round(c.covered / l.way_length, 9) AS share
      FROM nr_cov c JOIN way_len l ON l.osm_id = c.osm_id JOIN way_base w ON w.osm_id = c.osm_id WHERE round(c.covered / l.way_length, 9) > 0.6"""),
    "found": (["shares", "street"], f"""
      SELECT osm_id, muni_id, street_id, share, round(way_length, 2) AS way_length, name, same_name, coalesce(proper_name = name, false) AS name_match,
        coalesce({NORM('proper_name')} = {NORM('name')}, false) AS norm_match
      FROM (SELECT s.*, t.proper_name, coalesce({NORM('t.proper_name')} = {NORM('s.name')}, true) AS same_name,
              row_number() OVER (PARTITION BY s.osm_id ORDER BY coalesce({NORM('t.proper_name')} = {NORM('s.name')}, true) DESC, s.share DESC, s.street_id) AS rn
            FROM shares s JOIN street t ON t.street_id = s.street_id) WHERE rn = 1"""),
    "con": (["way_base", "street", "way_len"], """
      SELECT t.street_id, t.street_code, w.osm_id, round(l.way_length, 2) AS way_length FROM way_base w JOIN street t ON t.street_code = w.street_ref JOIN way_len l ON l.osm_id = w.osm_id"""),
    "con_near": (["con", "way_segment", "street_segment"], """
      SELECT c.street_id, s.seg, s.x1, s.y1, s.x2, s.y2, w.x1 AS u1, w.y1 AS v1, w.x2 AS u2, w.y2 AS v2, w.seg = 0 AS fs, w.seg = 1 AS fe
      FROM con c JOIN street_segment s ON s.street_id = c.street_id JOIN way_segment w ON w.osm_id = c.osm_id"""),
    **coverage("cn", "con_near", ["con_near"], "street_id"),
    "haus": (["con", "street_vertex", "way_vertex", "street_segment", "way_segment"], """
      SELECT street_id, greatest(max(a), max(b)) AS max_error FROM (
        SELECT v.street_id, v.pos, min(DST(v.x, v.y, w.x1, w.y1, w.x2, w.y2)) AS a, NULL AS b FROM street_vertex v JOIN con c ON c.street_id = v.street_id JOIN way_segment w ON w.osm_id = c.osm_id GROUP BY v.street_id, v.pos
        UNION ALL
        SELECT c.street_id, v.pos, NULL, min(DST(v.x, v.y, s.x1, s.y1, s.x2, s.y2)) FROM way_vertex v JOIN con c ON c.osm_id = v.osm_id JOIN street_segment s ON s.street_id = c.street_id GROUP BY c.street_id, v.osm_id, v.pos)
      GROUP BY street_id"""),
    "summary": (["street", "street_len", "con", "cn_cov", "haus"], """
      SELECT t.street_id, t.street_code, t.muni_id, t.settl_id, t.street_name, t.proper_name, substr(t.street_code, 7, 1) = '2' AS is_hamlet, l.street_length,
        coalesce(c.n, 0) AS conflated_count, coalesce(c.len, 0.0) AS conflated_length, c.maxlen AS conflated_max_length, coalesce(v.covered, 0.0) AS covered, h.max_error
      FROM street t JOIN street_len l ON l.street_id = t.street_id LEFT JOIN (SELECT street_id, count(*) AS n, sum(way_length) AS len, max(way_length) AS maxlen FROM con GROUP BY street_id) c ON c.street_id = t.street_id
      LEFT JOIN cn_cov v ON v.street_id = t.street_id LEFT JOIN haus h ON h.street_id = t.street_id"""),
    "report": (["summary", "found"], """
      SELECT s.*, coalesce(f.found_count, 0) AS found_count, coalesce(f.found_length, 0.0) AS found_length, f.found_max_share, coalesce(f.found_run_sum, 0.0) AS found_run_sum,
        coalesce(f.found_run_max, 0.0) AS found_run_max, greatest(round_even(s.street_length, 0) - round_even(s.covered, 0), 0.0) AS uncovered
      FROM summary s LEFT JOIN (SELECT street_id, count(*) AS found_count, sum(way_length) AS found_length, max(share) AS found_max_share, sum(share * way_length) AS found_run_sum,
        max(share * way_length) AS found_run_max FROM found GROUP BY street_id) f ON f.street_id = s.street_id"""),
    "q10": (["found", "way_base"], """
      SELECT street_id, sum(way_length) AS total_length, sum(share * way_length) AS average_length, count(*) AS wrong_count FROM found
      WHERE name IS NOT NULL AND NOT name_match AND NOT norm_match AND osm_id NOT IN (SELECT osm_id FROM way_base WHERE place = 'square') GROUP BY street_id"""),
    "q11": (["report"], """
      SELECT * FROM (SELECT *, CASE WHEN least(street_length - covered, max_error) > 50 AND least(found_run_max, max_error) <= 50 THEN least(street_length - covered, max_error) ELSE 0.0 END AS need_drawing,
        CASE WHEN least(found_run_max, max_error) > 50 THEN least(found_run_sum, max_error) ELSE 0.0 END AS need_conflating FROM report WHERE conflated_count > 0)
      WHERE need_drawing > 0 OR need_conflating > 0"""),
    **NAMED,
}


STEPS = {k: (n, _dst(b)) for k, (n, b) in STEPS.items()}


def q(body: str, *needs: str) -> str:
    return duck(body, *needs, extra=STEPS)


def add(name, query, sql):
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def rounded(df, *cols, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def found(w: World):
    return ST.found_ways(w.street_line, w.way_line)


def summary(w: World):
    return ST.street_summary(w.street_line, w.way_line)


def report(w: World):
    return ST.street_report(summary(w), found(w))


def q7(w: World):
    return ST.wrong_names(named_streets(w))


def munis(w: World):
    return w.muni


FOUND = ["osm_id", "muni_id", "street_id", "share", "way_length", "name", "same_name", "name_match", "norm_match"]
add("street_candidates", lambda s, d: rounded(found(World(s, d)), "share", digits=6).select(*FOUND),
    q("SELECT * REPLACE (round(share, 6) AS share) FROM found", "found"))
add("way_buffer_shares", lambda s, d: (lambda w: ST.near_ways(w.street_line, w.way_line).select("osm_id", "street_id", F.round("share", 6).alias("share"), F.round("way_length", 4).alias("way_length")))(World(s, d)),
    q("SELECT osm_id, street_id, round(share, 6) AS share, round(way_length, 4) AS way_length FROM shares", "shares"))
SUMMARY = ["street_id", "street_code", "is_hamlet", "street_length", "conflated_count", "conflated_length", "conflated_max_length", "covered", "max_error"]
SUMMARY_SQL = """street_id, street_code, is_hamlet, round(street_length, 4) AS street_length, conflated_count, round(conflated_length, 4) AS conflated_length, conflated_max_length,
  round(covered, 4) AS covered, round(max_error, 4) AS max_error"""
add("match_streets", lambda s, d: rounded(summary(World(s, d)), "street_length", "conflated_length", "covered", "max_error").select(*SUMMARY), q(f"SELECT {SUMMARY_SQL} FROM summary", "summary"))
add("street_report", lambda s, d: rounded(report(World(s, d)), "found_length", "found_max_share", "found_run_sum", "found_run_max").select(
    "street_id", "found_count", "found_length", "found_max_share", "found_run_sum", "found_run_max", "uncovered"),
    q("""SELECT street_id, found_count, round(found_length, 4) AS found_length, round(found_max_share, 4) AS found_max_share, round(found_run_sum, 4) AS found_run_sum,
      round(found_run_max, 4) AS found_run_max, uncovered FROM report""", "report"))
add("street_progress", lambda s, d: rounded(ST.street_progress(report(World(s, d))), "length", "conflated_length", "covered_length", "found_length", "notfound_length", "ratio", digits=3).withColumn("level", F.col("level").cast("int")),
    q("""SELECT *, streets - conflated - found AS notfound, round(greatest(length_ - conflated_ - found_, 0.0), 3) AS notfound_length, round(coalesce(least(100.0 * covered_ / nullif(length_, 0), 100.0), 0.0), 3) AS ratio,
        round(length_, 3) AS length, round(conflated_, 3) AS conflated_length, round(covered_, 3) AS covered_length, round(found_, 3) AS found_length
      FROM (SELECT muni_id, settl_id, count(*) AS streets, sum(street_length) AS length_, sum(conflated_length) AS conflated_, sum(covered) AS covered_, sum(found_length) AS found_,
        count(*) FILTER (WHERE conflated_count > 0) AS conflated, count(*) FILTER (WHERE conflated_count = 0 AND found_count > 0) AS found, cast(grouping(muni_id, settl_id) AS int) AS level
      FROM report WHERE NOT is_hamlet GROUP BY GROUPING SETS ((muni_id, settl_id), (muni_id), ()))""", "report").replace("SELECT *, streets", "SELECT muni_id, settl_id, streets, conflated, found, level, streets"))
add("settlement_street_totals", lambda s, d: ST.settlement_totals(report(World(s, d))),
    q("""SELECT settl_id, sum(round_even(street_length, 0)) AS street_length, sum(round_even(covered, 0)) AS covered, sum(uncovered) AS uncovered, sum(round_even(coalesce(max_error, 0.0), 0)) AS max_error,
      round_even(round(sum(conflated_length), 2), 0) AS conflated_length FROM report WHERE NOT is_hamlet GROUP BY settl_id""", "report"))
add("name_mismatch", lambda s, d: rounded(ST.name_mismatch(found(World(s, d)), World(s, d).way_line), "total_length", "average_length"),
    q("SELECT * REPLACE (round(total_length, 4) AS total_length, round(average_length, 4) AS average_length) FROM q10", "q10"))
add("name_mismatch_per_muni", lambda s, d: (lambda w: rounded(ST.mismatch_per_muni(ST.name_mismatch(found(w), w.way_line), w.street.select("street_id", "muni_id", (F.substring("street_code", 7, 1) == "2").alias("is_hamlet")), w.muni), "length"))(World(s, d)),
    q("""SELECT m.muni_id, coalesce(ways, 0) AS ways, coalesce(length, 0.0) AS length FROM muni m LEFT JOIN (
      SELECT t.muni_id, cast(sum(wrong_count) AS bigint) AS ways, round(sum(total_length), 4) AS length FROM q10 JOIN street t ON t.street_id = q10.street_id
      WHERE substr(t.street_code, 7, 1) <> '2' GROUP BY t.muni_id) USING (muni_id)""", "q10", "street", "muni"))
add("top_name_mismatch", lambda s, d: (lambda w: ST.top_streets(ST.name_mismatch(found(w), w.way_line).withColumn("total_length", F.round("total_length", 4)).join(
    w.street.select("street_id", (F.substring("street_code", 7, 1) == "2").alias("is_hamlet")), "street_id"), "total_length").select("street_id", "total_length"))(World(s, d)),
    q("""SELECT street_id, total_length FROM (SELECT q10.street_id, round(total_length, 4) AS total_length, substr(t.street_code, 7, 1) = '2' AS h FROM q10 JOIN street t ON t.street_id = q10.street_id
      ORDER BY 2 DESC, 1 LIMIT 100) WHERE NOT h""", "q10", "street"))
add("missing_geometry", lambda s, d: rounded(ST.missing_geometry(report(World(s, d))), "need_drawing", "need_conflating").select("street_id", "need_drawing", "need_conflating"),
    q("SELECT street_id, round(need_drawing, 4) AS need_drawing, round(need_conflating, 4) AS need_conflating FROM q11", "q11"))
for metric in ("need_drawing", "need_conflating"):
    add(f"top_{metric}", lambda s, d, by=metric: ST.top_streets(rounded(ST.missing_geometry(report(World(s, d))), by), by).select("street_id", by),
        q(f"SELECT street_id, {metric} FROM (SELECT street_id, round({metric}, 4) AS {metric}, is_hamlet FROM q11 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 100) WHERE NOT is_hamlet", "q11"))
add("ring_streets_with_exceptions", lambda s, d: (lambda w: ST.ring_streets(w.street_line, w.street.where("street_id % 10 = 0").select("street_code", (F.col("street_id") % 20 == 0).alias("is_ring"))))(World(s, d)),
    q("SELECT street_code, street_id % 20 = 0 AS ring FROM street", "street"))
add("missing_geometry_per_muni", lambda s, d: rounded(ST.missing_per_muni(ST.missing_geometry(report(World(s, d))), World(s, d).muni), "drawing_length", "conflating_length", "drawing_conflated", "conflating_conflated", digits=3),
    q("""SELECT m.muni_id, count(*) FILTER (WHERE need_drawing > 0) AS drawing_count, round(coalesce(sum(need_drawing) FILTER (WHERE need_drawing > 0), 0.0), 3) AS drawing_length,
      count(*) FILTER (WHERE NOT need_drawing > 0) AS conflating_count, round(coalesce(sum(need_conflating) FILTER (WHERE NOT need_drawing > 0), 0.0), 3) AS conflating_length,
      round(coalesce(sum(conflated_length) FILTER (WHERE need_drawing > 0), 0.0), 3) AS drawing_conflated, round(coalesce(sum(conflated_length) FILTER (WHERE NOT need_drawing > 0), 0.0), 3) AS conflating_conflated
      FROM muni m LEFT JOIN (SELECT * FROM q11 WHERE NOT is_hamlet) f ON f.muni_id = m.muni_id GROUP BY m.muni_id""", "q11", "muni"))
add("ring_streets", lambda s, d: (lambda w: ST.ring_streets(w.street_line.withColumn("lines", F.array(F.concat(F.col("lines")[0], F.when(F.col("street_id") % 3 == 0, F.slice(F.col("lines")[0], 1, 1)).otherwise(F.slice(F.col("lines")[0], 1, 0)))))))(World(s, d)),
    q("SELECT street_code, street_id % 3 = 0 AS ring FROM street", "street"))


def own_parts():
    """Each segment of ``lines`` as a part of its own, every other one turned round."""
    def part(a, b):
        return F.array(F.struct(a[0].alias("x"), a[1].alias("y")), F.struct(b[0].alias("x"), b[1].alias("y")))
    return F.transform(G.segments("lines"), lambda g, i: F.when(i % 2 == 0, part((g["x1"], g["y1"]), (g["x2"], g["y2"]))).otherwise(part((g["x2"], g["y2"]), (g["x1"], g["y1"]))))


add("ring_streets_of_parts", lambda s, d: (lambda w: ST.ring_streets(w.street_line.withColumn("lines", F.array(F.concat(F.col("lines")[0], F.when(
    F.col("street_id") % 3 == 0, F.slice(F.col("lines")[0], 1, 1)).otherwise(F.slice(F.col("lines")[0], 1, 0))))).withColumn("lines", F.reverse(own_parts()))))(World(s, d)),
    q("SELECT street_code, street_id % 3 = 0 AS ring FROM street", "street"))
add("line_measures", lambda s, d: World(s, d).way_line.select("osm_id", F.round(G.length("lines"), 4).alias("length"), G.bounds("lines")["xmin"].alias("xmin"), G.bounds("lines")["ymax"].alias("ymax")),
    q("""SELECT l.osm_id, round(l.way_length, 4) AS length, v.xmin, v.ymax FROM way_len l JOIN (SELECT osm_id, cast(min(x) AS double) AS xmin, cast(max(y) AS double) AS ymax FROM way_vertex GROUP BY osm_id) v ON v.osm_id = l.osm_id""", "way_len"))
FLAGS = ["wrong_name", "missing_name", "wrong_name_sr", "missing_name_sr", "wrong_name_sr_latn", "missing_name_sr_latn", "suspicious_name_en", "unneeded_name_en", "wrong_int_name", "missing_int_name"]
add("wrong_names", lambda s, d: q7(World(s, d)).select("osm_id", *FLAGS), q("SELECT osm_id, " + ", ".join(FLAGS) + " FROM q7", "q7"))
add("wrong_name_counts", lambda s, d: ST.name_counts(q7(World(s, d)), World(s, d).muni, FLAGS),
    q("SELECT m.muni_id, " + ", ".join(f"count(*) FILTER (WHERE q7.{f}) AS {f}" for f in FLAGS) + " FROM muni m LEFT JOIN q7 ON q7.muni_id = m.muni_id GROUP BY m.muni_id", "q7", "muni"))
from registry.sql import CYR2LAT, INTNAME  # noqa: E402

add("suggested_names", lambda s, d: ST.suggested_names(named_streets(World(s, d))).select("osm_id", "suggest_sr", "suggest_sr_latn", "suggest_int_name"),
    q(f"SELECT osm_id, coalesce(proper, name, '?') AS suggest_sr, coalesce({CYR2LAT('coalesce(proper, name)', True)}, '?') AS suggest_sr_latn, coalesce({INTNAME('coalesce(proper, name)')}, '?') AS suggest_int_name FROM named", "named"))
ALT = {"wrong_alt_name": "alt_wrong", "missing_alt_name": "alt_missing", "wrong_alt_name_sr": "alt_sr_wrong", "missing_alt_name_sr": "alt_sr_missing",
       "wrong_alt_name_sr_latn": "alt_latn_wrong", "missing_alt_name_sr_latn": "alt_latn_missing"}
add("alt_name_counts", lambda s, d: (lambda w: ST.name_counts(ST.wrong_alt_names(named_streets(w)).withColumns({k: F.col(v) for k, v in ALT.items()}), w.muni, list(ALT)))(World(s, d)), None)
add("wrong_alt_names", lambda s, d: ST.wrong_alt_names(named_streets(World(s, d))).select("osm_id", *[f"{p}{c}" for p in ("alt_", "alt_sr_", "alt_latn_") for c in ("missing", "wrong", "suggestion", "partial")]), None)
