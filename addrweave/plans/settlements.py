"""Settlement geometry and address listings."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.functions import text as T
from addrweave.operators.cells import points_in_polygons, polygons_meet, within_or_nearest
from addrweave.operators.ranking import group_order
from addrweave.operators.rollup import building_counts, with_ratio, with_zero_rows
from addrweave.session import stable


def seeds(auth: DataFrame) -> DataFrame:
    """Mean address point per settlement."""
    return auth.groupBy("muni_id", "settl_id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("*").alias("addresses"))


def _spacing(seed: DataFrame) -> DataFrame:
    """Per municipality about how far its seeds lie apart."""
    span = F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))
    return seed.groupBy("muni_id").agg(F.greatest(span / F.sqrt(F.count("*")), F.lit(1.0)).alias("_space"))


def _around(size: Column, x: str = "x", y: str = "y") -> dict[str, Column]:
    return {"_cx": F.floor(F.col(x) / size), "_cy": F.floor(F.col(y) / size)}


def _nine_cells(df: DataFrame) -> DataFrame:
    """Rows copied to their cell and its eight neighbours."""
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return df.withColumn("_cx", F.explode(F.transform(steps, lambda d: F.col("_cx") + d))).withColumn("_cy", F.explode(F.transform(steps, lambda d: F.col("_cy") + d)))


def nearest_seed(points: DataFrame, seed: DataFrame) -> DataFrame:
    """Q17 as membership: the settlement of the point's municipality whose seed is nearest (ties: smaller id); null where it has none.

    A point looks at the seeds of its own cell and the eight around it; cells are four times as wide as seeds lie apart, and four times wider in each further round for
    points that found none within a cell's width. So a point never meets all seeds of its municipality.
    """
    space = _spacing(seed)
    todo = points.join(space, "muni_id", "left")
    found, wide = todo.where("_space IS NULL").withColumn("_n", F.expr("CAST(NULL AS struct<distance:double,settl_id:bigint>)")), 4.0
    targets = seed.join(space, "muni_id").select("muni_id", "_space", F.col("x").alias("_u"), F.col("y").alias("_v"), "settl_id")
    todo = todo.where("_space IS NOT NULL")
    while True:
        size = F.col("_space") * wide
        cells = _nine_cells(targets.withColumns(_around(size, "_u", "_v"))).groupBy("muni_id", "_cx", "_cy").agg(F.collect_list(F.struct("settl_id", "_u", "_v")).alias("_seeds"))
        d = F.transform("_seeds", lambda z: F.struct(G.distance(F.col("x"), F.col("y"), z["_u"], z["_v"]).alias("distance"), z["settl_id"].cast("bigint").alias("settl_id")))
        met = todo.withColumns(_around(size)).join(cells, ["muni_id", "_cx", "_cy"], "left")  # one row of seeds a cell; adaptive execution splits a crowded one
        met = met.withColumn("_n", F.array_min(d)).drop("_seeds", "_cx", "_cy")
        met = stable(met)
        near = F.coalesce(F.col("_n.distance") <= size, F.lit(False)) | F.isnan(F.col("x").cast("double")) | F.isnan(F.col("y").cast("double")) | F.col("x").isNull() | F.col("y").isNull()
        found = found.unionByName(met.where(near))
        todo = met.where(~near).drop("_n")
        if todo.isEmpty():
            break
        wide *= 4
    return found.withColumns({"nearest_settl_id": F.col("_n.settl_id"), "seed_distance": F.col("_n.distance")}).drop("_n", "_space")


def clip_ring(ring: list[tuple[float, float]], nx: float, ny: float, limit: float) -> list[list[tuple[float, float]]]:
    """Parts of a ring (not closed) where ``x * nx + y * ny <= limit``; a concave ring may fall into several.

    What runs on the kept side are chains between crossings of the line. Sorted along the line, crossings bound its pieces inside the ring two by
    two, so each chain goes on at the partner of its end.
    """
    over = [x * nx + y * ny - limit for x, y in ring]
    if all(f <= 0 for f in over):
        return [ring]
    n, chains = len(ring), []
    for i in range(n):
        if over[i - 1] > 0 >= over[i]:  # the ring comes in between i - 1 and i
            chain, k = [_cut(ring[i - 1], ring[i], over[i - 1], over[i])], i
            while over[k % n] <= 0:
                chain.append(ring[k % n])
                k += 1
            chain.append(_cut(ring[(k - 1) % n], ring[k % n], over[(k - 1) % n], over[k % n]))
            chains.append(chain)
    ends = sorted((p[1] * nx - p[0] * ny, k, last) for k, c in enumerate(chains) for last, p in ((False, c[0]), (True, c[-1])))
    after = {}
    for (_, k, last), (_, m, other) in zip(ends[::2], ends[1::2]):
        if last == other:  # pieces touch in a point: keep one ring with a bridge along the line
            return [[p for c in chains for p in c]]
        after[k if last else m] = m if last else k
    parts, left = [], set(range(len(chains)))
    while left:
        k = start = min(left)
        part: list[tuple[float, float]] = []
        while True:
            part += chains[k]
            left.discard(k)
            k = after[k]
            if k == start or k not in left:
                break
        parts.append(part)
    return parts


def _cut(p: tuple[float, float], q: tuple[float, float], f: float, g: float) -> tuple[float, float]:
    t = f / (f - g)
    return p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])


def _tile(rings: list, x: float, y: float, settl_id: int, others: list) -> tuple[list, float]:
    """What of the rings lies nearer to the seed than to any of the others (by distance), and how far it reaches."""
    rings = [[(p["x"], p["y"]) for p in r[:-1]] for r in rings]

    def reach() -> float:
        return max((((px - x) ** 2 + (py - y) ** 2) ** 0.5 for r in rings for px, py in r), default=0.0)

    far = reach()
    for z in sorted(others, key=lambda z: z["distance"]):
        if z["distance"] == 0 and z["settl_id"] < settl_id:
            return [], 0.0
        if z["distance"] == 0 or z["distance"] > 2 * far:
            continue
        nx, ny = z["x"] - x, z["y"] - y
        rings = [part for r in rings for part in clip_ring(r, nx, ny, (z["x"] ** 2 + z["y"] ** 2 - x * x - y * y) / 2)]
        far = reach()
    return [[{"x": px, "y": py} for px, py in [*r, r[0]]] for r in rings], far


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    for batch in batches:
        rows = [_tile(r["rings"] or [], r["x"], r["y"], r["settl_id"], r["_others"] or []) for r in batch.select(["rings", "x", "y", "settl_id", "_others"]).to_pylist()]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("muni_id", "settl_id", "addresses", "x", "y", "_radius")], pa.array([t for t, _ in rows], pa.list_(pa.list_(point))), pa.array([f for _, f in rows], pa.float64())],
                                         ["muni_id", "settl_id", "addresses", "x", "y", "_radius", "tile", "_reach"])


def settlement_borders(auth: DataFrame, munis: DataFrame) -> DataFrame:
    """Each settlement's part of the municipality (``rings``), cut by the bisectors to the other seeds; one seed keeps the whole.

    ``munis``: ``muni_id, rings``; every ring is tiled, and parts of concave ones are rings of their own. A seed is cut by seeds within a radius of three spacings; a
    seed farther away than twice the tile's farthest vertex can cut nothing, so where that is within the radius the tile is done, and the others
    go on with twice the radius. Equal seeds: the smaller id takes the part, the other has no rings.
    """
    s = stable(seeds(auth).withColumns({"x": F.col("x").cast("double"), "y": F.col("y").cast("double")}))
    todo = s.join(_spacing(s), "muni_id").withColumn("_radius", 3.0 * F.col("_space")).drop("_space")
    space, wide, done = _spacing(s), 3.0, None
    kind = ", ".join(f"{c} {s.schema[c].dataType.simpleString()}" for c in ("muni_id", "settl_id", "addresses", "x", "y"))
    while True:
        size = F.col("_space") * wide
        near = _nine_cells(s.join(space, "muni_id").withColumns(_around(size))).select("muni_id", "_cx", "_cy", F.col("settl_id").alias("_id"), F.col("x").alias("_u"), F.col("y").alias("_v"))
        open_seeds = todo.join(space, "muni_id").withColumns(_around(size)).drop("_space")
        d = G.distance(F.col("x"), F.col("y"), F.col("_u"), F.col("_v"))
        other = F.struct(F.col("_id").alias("settl_id"), F.col("_u").alias("x"), F.col("_v").alias("y"), d.alias("distance"))
        pairs = open_seeds.join(near, ["muni_id", "_cx", "_cy"]).where((F.col("_id") != F.col("settl_id")) & (d <= F.col("_radius")))
        others = pairs.groupBy("muni_id", "settl_id").agg(F.collect_list(other).alias("_others"))
        tiles = todo.join(others, ["muni_id", "settl_id"], "left").join(munis.select("muni_id", "rings"), "muni_id")
        tiles = stable(tiles.mapInArrow(_tiles, f"{kind}, _radius double, tile {G.PARTS}, _reach double"))
        ready = tiles.where("2 * _reach <= _radius")
        done = ready if done is None else done.unionByName(ready)
        todo = tiles.where("2 * _reach > _radius").select(*s.columns, (2.0 * F.col("_radius")).alias("_radius"))
        if todo.isEmpty():
            break
        wide *= 2
    return done.select("muni_id", "settl_id", "addresses", F.col("tile").alias("rings"))


def fill_settlements(auth: DataFrame, polygons: DataFrame, size: float, reach: float | None = None) -> DataFrame:
    """Q16: settlement of each address by the polygon it lies in, else the nearest. ``auth`` has ``addr_id, x, y``; ``polygons`` ``polygon_id, rings``."""
    pts = auth.select(F.col("addr_id").alias("point_id"), "x", "y")
    return within_or_nearest(pts, polygons, size, reach).withColumnRenamed("point_id", "addr_id")


def settlement_building_ratio(addresses: DataFrame, buildings: DataFrame, settlements: DataFrame, size: float) -> DataFrame:
    """Per settlement polygon the register addresses in it, the map buildings that meet it, and their ratio; settlements without either come with zeros.

    ``addresses``: ``addr_id, x, y``; ``buildings``: ``osm_id, rings``; ``settlements``: ``settl_id, rings``, one polygon each. A building on a border
    counts in every settlement it meets.
    """
    areas = settlements.select(F.col("settl_id").alias("polygon_id"), "rings")
    inside = points_in_polygons(addresses.select("addr_id", "x", "y"), areas, size).select(F.col("polygon_id").alias("settl_id"))
    met = polygons_meet(buildings.select(F.col("osm_id").alias("left_id"), "rings"), areas, size).select(F.col("polygon_id").alias("settl_id"))
    return with_ratio(with_zero_rows(building_counts(inside, met, ["settl_id"]), settlements, "settl_id"))


def replace_group(df: DataFrame, rows: DataFrame, key: str, value) -> DataFrame:
    """Rows of one group replaced by new ones."""
    return df.where(F.col(key) != F.lit(value)).unionByName(rows)


def address_listing(q1: DataFrame) -> DataFrame:
    """Q19: per address its sort key (street place in the settlement, padded number), links, and one score and distance."""
    order = group_order(q1, ["settl_id"], "street", T.serbian_sort_key("street"), "street_no")
    con, cand = F.col("conflated_osm_id").isNotNull(), F.col("osm_id").isNotNull()
    return order.select(
        "addr_id", "settl_id", "street", "house_no", F.concat("street_no", F.lit("-"), T.pad_house_number("house_no")).alias("sort_key"),
        T.osm_link("conflated_osm_id").alias("conflated_link"), F.when(~con, T.osm_link("osm_id")).alias("candidate_link"),
        F.when(con | (cand & F.col("matching")), 1.0).when(cand, F.col("score")).alias("score"),
        F.when(con, F.col("conflated_distance")).when(cand, F.col("distance")).alias("distance"))


def place_settlements(auth: DataFrame, settlements: DataFrame) -> DataFrame:
    """Q20: settlements with exactly one street name, and whether it is the settlement's own name (then addresses take ``addr:place``)."""
    one = auth.groupBy("settl_id").agg(F.min("street").alias("_lo"), F.max("street").alias("_hi")).where("_lo = _hi")
    return one.join(settlements, "settl_id").select("settl_id", F.col("_lo").alias("street"), (
        T.norm_latin(T.cyr2lat("_lo")) == T.norm_latin(T.cyr2lat("settl_name"))).alias("use_place"))
