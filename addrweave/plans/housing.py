"""Housing communities against register and map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.functions import text as T
from addrweave.operators.ranking import keep_first
from addrweave.operators.skew import skew_join
from addrweave.session import stable

# Apartment resolution codes.
NOT_FOUND, DETACHED, NOT_BUILDING, NOT_APARTMENT, APARTMENT = 1, 2, 3, 4, 5


def housing_addresses(housing: DataFrame, auth: DataFrame) -> DataFrame:
    """Register address of each community by municipality, street and number; ambiguous ones count as not found.

    ``housing``: ``hc_id, muni_id, hc_street, hc_house_no``; ``auth``: ``addr_id, muni_id, street, house_no``.
    """
    h = housing.withColumns({"street_key": T.norm_keep_case("hc_street"), "house_no": F.col("hc_house_no")})
    a = (auth.select("muni_id", T.norm_keep_case("street").alias("street_key"), "house_no", "addr_id")
         .groupBy("muni_id", "street_key", "house_no").agg(F.count("*").alias("hits"), F.min("addr_id").alias("addr_id")))
    j = h.join(a, ["muni_id", "street_key", "house_no"], "left")
    group = ["muni_id", "hc_street", "hc_house_no"]
    totals = j.groupBy(*group).agg(F.sum(F.coalesce("hits", F.lit(1))).alias("copies"))
    first = keep_first(j, group, [F.asc("hc_id")]).join(totals, group, "left")  # one row a key on both sides
    found = F.col("addr_id").isNotNull() & (F.col("copies") == 1)
    one = first.withColumns({"is_duplicated": F.col("copies") > 1, "found_in_register": found, "addr_id": F.when(found, F.col("addr_id"))})
    named, rest = one.where("addr_id IS NOT NULL"), one.where("addr_id IS NULL")
    return keep_first(named, ["addr_id"], [F.asc("hc_id")]).unionByName(rest).select(
        "hc_id", "muni_id", "hc_street", "hc_house_no", "addr_id", "is_duplicated", "found_in_register")


def entity_resolution(entities: DataFrame, ways: DataFrame, relations: DataFrame, node_ways: DataFrame, in_building: DataFrame) -> DataFrame:
    """Apartment code and closest building of each map entity.

    ``entities``: ``osm_id``; ``ways``/``relations``: ``osm_id, building`` (null if untagged) for all that exist; ``node_ways``: ``node_id, way_id``
    with prefixes; ``in_building``: ``node_id, building_id``. Ways may bring ``building_part``: a way that is an entity itself and no building goes by
    its part; ways and buildings that a node lies on or in do not.
    """
    e = entities.select("osm_id").distinct()
    code = F.when(F.col("building") == "apartments", APARTMENT).when(F.col("building").isNotNull(), NOT_APARTMENT).otherwise(NOT_BUILDING)
    nodes = e.where(F.col("osm_id").startswith("n"))
    tagged = ways.select(F.col("osm_id").alias("way_id"), "building", code.alias("code"))
    on_way = stable(node_ways.join(nodes.select(F.col("osm_id").alias("node_id")), "node_id", "left_semi"))  # counted, then joined
    via_way = skew_join(on_way, tagged, ["way_id"], "inner")
    via_way = keep_first(via_way, ["node_id"], [F.desc("code"), F.asc("way_id")]).select(
        F.col("node_id").alias("osm_id"), "code", F.when(F.col("code") > NOT_BUILDING, F.col("way_id")).alias("closest"))
    inside = in_building.select("node_id", F.col("building_id").alias("osm_id"))
    inside = skew_join(inside, ways.select("osm_id", "building").unionByName(relations.select("osm_id", "building")).select("osm_id", code.alias("in_code")), ["osm_id"], "inner")
    inside = keep_first(inside, ["node_id"], [F.asc("osm_id")]).select(F.col("node_id"), "in_code", F.col("osm_id").alias("in_closest"))
    n = nodes.join(via_way, "osm_id", "left").join(inside.withColumnRenamed("node_id", "osm_id"), "osm_id", "left").select(
        "osm_id", F.coalesce("code", "in_code", F.lit(DETACHED)).alias("code"), F.when(F.col("code").isNotNull(), F.col("closest")).otherwise(F.col("in_closest")).alias("closest"))
    own = ways.withColumn("building", F.coalesce("building", "building_part")) if "building_part" in ways.columns else ways
    own = own.select("osm_id", "building").unionByName(relations.select("osm_id", "building"))
    shapes = e.where(~F.col("osm_id").startswith("n")).join(own.withColumn("exists", F.lit(True)), "osm_id", "left").select(
        "osm_id", F.when(F.col("exists").isNull(), NOT_FOUND).otherwise(code).alias("code"), F.when(F.col("building").isNotNull(), F.col("osm_id")).alias("closest"))
    return n.unionByName(shapes)


def housing_status(addresses: DataFrame, osm: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Per community the number of map entities carrying its address id and the best of their codes (ties: smallest entity id)."""
    addresses = stable(addresses)  # asked for their entities, then listed with them
    carriers = osm.where(F.col("house_ref").isNotNull()).select(F.col("house_ref").alias("addr_id"), "osm_id")
    wanted = addresses.where("addr_id IS NOT NULL").select("addr_id")
    e = skew_join(carriers, wanted, ["addr_id"], "inner")
    place = F.struct(F.coalesce(-F.col("code"), F.lit(0)).alias("place"), "osm_id", F.col("code").alias("resolution"), F.col("closest").alias("closest_building"))  # no code comes last
    found = e.join(resolutions, "osm_id", "left").groupBy("addr_id").agg(F.count("*").alias("entities"), F.min(place).alias("_best")).select(
        "addr_id", "entities", "_best.resolution", "_best.closest_building")
    return addresses.join(found, "addr_id", "left").withColumns(
        {"entities": F.coalesce("entities", F.lit(0)), "found_in_map": F.coalesce(F.col("entities") > 0, F.lit(False))})


def housing_counts(status: DataFrame) -> DataFrame:
    """Communities per municipality: total, in the register, on the map, and per apartment code."""
    codes = {NOT_FOUND: "entity_not_found", DETACHED: "node_detached", NOT_BUILDING: "not_building", NOT_APARTMENT: "not_apartment", APARTMENT: "apartment"}
    return status.groupBy("muni_id").agg(
        F.count("*").alias("communities"), F.count_if("found_in_register").alias("in_register"), F.count_if("found_in_map").alias("in_map"),
        *[F.count_if(F.col("resolution") == c).alias(n) for c, n in codes.items()])
