"""Map elements from decoded tables: tag scans, geometry assembly, attribute promotion.

``nodes``: ``id, lon, lat, tags``; ``ways``: ``id, nodes array<long>, tags``; ``relations``: ``id, members array<struct<type,ref,role>>, tags``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.functions.projection import to_utm
from addrweave.operators.ranking import keep_first
from addrweave.operators.skew import skew_join
from addrweave.options import DEFAULTS, Options

# Street attributes promoted to columns, column name to tag.
STREET_TAGS = {
    "name": "name", "name_sr": "name:sr", "name_sr_latn": "name:sr-Latn", "name_en": "name:en", "alt_name": "alt_name", "alt_name_sr": "alt_name:sr",
    "alt_name_sr_latn": "alt_name:sr-Latn", "short_name": "short_name", "short_name_sr": "short_name:sr", "short_name_sr_latn": "short_name:sr-Latn", "int_name": "int_name",
}


def has_any_tag(keys: list[str]) -> Column:
    """One of the tags is present and not empty."""
    return F.exists(F.array(*[F.lit(k) for k in keys]), lambda k: F.coalesce(F.try_element_at("tags", k), F.lit("")) != "")


def scan_entities(nodes: DataFrame, ways: DataFrame, relations: DataFrame, keys: list[str], options: Options = DEFAULTS, only_nodes: bool = False) -> DataFrame:
    """Tagged nodes, ways and relations as ``osm_id`` with address attributes; the street falls back to the place."""
    def pick(df: DataFrame, prefix: str) -> DataFrame:
        return df.where(has_any_tag(keys)).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("osm_id"), "tags")
    d = pick(nodes, "n")
    if not only_nodes:
        d = d.unionByName(pick(ways, "w")).unionByName(pick(relations, "r"))

    def t(k: str) -> Column:
        return F.nullif(F.try_element_at("tags", F.lit(k)), F.lit(""))
    return d.select("osm_id", t("addr:country").alias("country"), t("addr:city").alias("city"), t("addr:postcode").alias("postcode"),
                    F.coalesce(t("addr:street"), t("addr:place")).alias("street"), t("addr:housenumber").alias("house_no"), t(options.street_ref).alias("street_ref"),
                    t(options.house_ref).alias("house_ref"), t("note").alias("note"), "tags")


def assemble_ways(ways: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, shape, points)`` of each way, and the ``(id, node)`` pairs that lack coordinates.

    Node references are joined once; a way is rebuilt from its own references only (ways have a bounded node count).
    """
    refs = ways.select("id", F.posexplode("nodes").alias("pos", "node"))
    xy = nodes.select(F.col("id").alias("node"), F.col("lon").cast("double").alias("x"), F.col("lat").cast("double").alias("y"))
    j = skew_join(refs, xy, ["node"], "left")
    pts = j.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("p"), F.count_if(F.col("x").isNull()).alias("lost"))
    whole = pts.where("lost = 0").select("id", F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))
    return whole.select("id", G.way_shape("points").alias("shape"), "points"), j.where(F.col("x").isNull()).select("id", "node")


def assemble_relations(relations: DataFrame, way_geoms: DataFrame) -> DataFrame:
    """Rings of each relation: closed outer and inner ways (the even-odd rule subtracts the inner ones).

    Where no outer way is closed (``all_open``) the only ring is the hull of their vertices; open outer ways beside closed ones are ``lines``.
    Non-way members, ways without geometry and relations without outer ways are left out. A relation's members, which the map bounds, meet in one row.
    """
    m = relations.select("id", F.explode("members").alias("m")).where((F.col("m.type") == "w") & F.col("m.role").isin("outer", "inner"))
    g = way_geoms.select(F.col("id").alias("ref"), "points", (F.col("shape") == "Polygon").alias("closed"))
    j = skew_join(m.select("id", F.col("m.ref").alias("ref"), F.col("m.role").alias("role")), g, ["ref"], "inner")
    outer = F.col("role") == "outer"
    d = j.groupBy("id").agg(
        F.collect_list(F.when(F.col("closed"), F.col("points"))).alias("rings"), (~F.bool_or(outer & F.col("closed"))).alias("all_open"), F.bool_or(outer).alias("_outer"),
        F.collect_list(F.when(outer & ~F.col("closed"), F.col("points"))).alias("lines")).where("_outer").drop("_outer")
    return d.withColumns({"rings": F.when(F.col("all_open"), F.array(G.convex_hull(F.flatten("lines")))).otherwise(F.col("rings")),
                          "lines": F.when(F.col("all_open"), F.slice("lines", 1, 0)).otherwise(F.col("lines"))})


def address_entities(nodes: DataFrame, ways: DataFrame, relations: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Map entities with an address tag or id as the address analyses read them: ``osm_id, street, house_no, house_ref, x, y, rings``.

    Coordinates are metres. ``rings`` holds the parts of ways and relations and is null for nodes; ``x, y`` is a vertex of them. ``muni_id`` comes
    from a join to municipality polygons.
    """
    lines, _ = assemble_ways(ways, nodes)
    shapes = assemble_relations(relations, lines)

    def metres(p: Column) -> Column:
        x, y = to_utm(p["x"], p["y"], options.metric_crs)
        return F.struct(x.alias("x"), y.alias("y"))

    def entity(df: DataFrame, letter: str, parts: Column) -> DataFrame:
        return df.select(F.concat(F.lit(letter), F.col("id").cast("string")).alias("osm_id"), "tags", F.transform(parts, lambda part: F.transform(part, metres)).alias("parts"))
    point = F.struct(F.col("lon").cast("double").alias("x"), F.col("lat").cast("double").alias("y"))
    d = entity(nodes, "n", F.array(F.array(point))).unionByName(entity(ways.join(lines, "id"), "w", F.array("points"))).unionByName(
        entity(relations.join(shapes, "id"), "r", F.concat("rings", "lines")))
    first = F.get(F.get("parts", F.lit(0)), F.lit(0))
    d = d.select("osm_id", _tag("addr:street").alias("street"), _tag("addr:housenumber").alias("house_no"), _tag(options.house_ref).alias("house_ref"),
                 first["x"].alias("x"), first["y"].alias("y"), F.when(~F.col("osm_id").startswith("n"), F.col("parts")).alias("rings"))
    return d.where("street IS NOT NULL OR house_no IS NOT NULL OR house_ref IS NOT NULL")


def union_tiles(tiles: list[DataFrame]) -> DataFrame:
    """Overlapping tiles as one table, each entity once: its row in the first tile that has it (of several there, the one whose JSON text is smallest)."""
    d = tiles[0].withColumn("_tile", F.lit(0))
    for i, t in enumerate(tiles[1:], 1):
        d = d.unionByName(t.withColumn("_tile", F.lit(i)))
    return keep_first(d, ["osm_id"], [F.asc("_tile"), F.to_json(F.struct(*tiles[0].columns))]).drop("_tile")


def _tag(key: str) -> Column:
    """Value of a tag; absent and empty ones are null."""
    return F.nullif(F.try_element_at("tags", F.lit(key)), F.lit(""))


def promote_tags(ways: DataFrame, columns: dict[str, str] | None = None, options: Options = DEFAULTS) -> DataFrame:
    """Street tags as columns, null where missing or empty; lines and polygons only."""
    d = ways.where(F.col("shape").isin("LineString", "Polygon"))
    cols = {c: _tag(t) for c, t in (columns or STREET_TAGS).items()}
    return d.withColumns({**cols, "street_ref": _tag(options.street_ref)})


def explode_refs(df: DataFrame) -> DataFrame:
    """One row per street reference of a ``;`` list."""
    return df.withColumn("street_ref", F.explode_outer(F.split("street_ref", ";")))


def _side_tag(tag: str, side: str) -> str:
    head, *tail = tag.split(":", 1)
    return ":".join([head, side, *tail])


def explode_sides(df: DataFrame, options: Options = DEFAULTS, columns: dict[str, str] | None = None) -> DataFrame:
    """I16: ways with a left or right reference give one row per side, names falling back from the side's tag to the plain one.

    Equal references on both sides drop the way; a way with neither stays as it is; a ``;`` list is split first and has no sides.
    """
    cols = columns or STREET_TAGS

    def t(k: str) -> Column:
        return _tag(k)

    def row(ref: Column, side: str | None) -> Column:
        values = [F.col(c) if side is None else F.coalesce(t(_side_tag(k, side)), t(k)) for c, k in cols.items()]
        return F.struct(ref.alias("street_ref"), *[v.alias(c) for v, c in zip(values, cols)])
    left, right = t(options.street_ref + ":left"), t(options.street_ref + ":right")
    lists = F.transform(F.split("street_ref", ";"), lambda r: row(r, None))
    sides = F.filter(F.array(F.when(left.isNotNull(), row(left, "left")), F.when(right.isNotNull(), row(right, "right"))), lambda s: s.isNotNull())
    same = F.coalesce(left == right, F.lit(False))
    rows = F.when(F.col("street_ref").contains(";"), lists).when(same, F.slice(sides, 1, 0)).when(left.isNotNull() | right.isNotNull(), sides).otherwise(F.array(row(F.col("street_ref"), None)))
    rest = [c for c in df.columns if c not in cols and c != "street_ref"]
    return df.select(*rest, F.explode(rows).alias("_r")).select(*rest, "_r.*")


def ref_inventory(entities: DataFrame) -> DataFrame:
    """Authority ids on the map with entity counts; the entities of an id stay rows of the input."""
    return entities.where(F.col("house_ref").isNotNull()).groupBy("house_ref").agg(F.count("*").alias("entities"), F.min("osm_id").alias("first_id"))


def lookup_elements(way_ids: DataFrame, ways: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Needed ways, then the nodes they use."""
    w = ways.join(way_ids.select("id").distinct(), "id", "left_semi")
    used = w.select(F.explode("nodes").alias("id")).distinct()
    return w, nodes.join(used, "id", "left_semi")
