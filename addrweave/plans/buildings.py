"""Addresses inside buildings and what to do about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import text as T
from addrweave.operators.cells import points_in_polygons
from addrweave.operators.rollup import with_zero_rows
from addrweave.options import DEFAULTS, Options

# Resolution codes.
NO_ACTION, MERGE_POI, MERGE_ADDRESS, COPY_POI_ADDRESS, ATTACH_ADDRESSES = 1, 2, 3, 4, 5
REMOVE_FROM_BUILDING, NOT_MATCHING, TOO_COMPLEX, BUILDING_IS_NODE, NOTE_PRESENT = 6, 7, 8, 9, 10
RESOLUTIONS = {
    NO_ACTION: "NO_ACTION", MERGE_POI: "MERGE_POI_TO_BUILDING", MERGE_ADDRESS: "MERGE_ADDRESS_TO_BUILDING",
    COPY_POI_ADDRESS: "COPY_POI_ADDRESS_TO_BUILDING", ATTACH_ADDRESSES: "ATTACH_ADDRESSES_TO_BUILDING",
    REMOVE_FROM_BUILDING: "REMOVE_ADDRESS_FROM_BUILDING", NOT_MATCHING: "ADDRESSES_NOT_MATCHING", TOO_COMPLEX: "CASE_TOO_COMPLEX",
    BUILDING_IS_NODE: "BUILDING_IS_NODE", NOTE_PRESENT: "NOTE_PRESENT",
}


def nodes_in_buildings(nodes: DataFrame, buildings: DataFrame, size: float = 100.0, options: Options = DEFAULTS) -> DataFrame:
    """Address nodes strictly inside buildings; building columns get the prefix ``b_``."""
    b = buildings.select(F.col("osm_id").alias("polygon_id"), "rings", F.col("street").alias("b_street"), F.col("house_no").alias("b_house_no"),
                         F.col("has_note").alias("b_has_note"))
    return points_in_polygons(nodes, b, size, border=False, rows_per_task=options.rows_per_task).withColumnRenamed("polygon_id", "building_id")


def building_facts(pairs: DataFrame) -> DataFrame:
    """Per building: counts and comparisons the rules need, in two aggregation steps (first per distinct address in the building)."""
    number = T.house_number_int("house_no")
    per_address = pairs.groupBy("building_id", "b_street", "b_house_no", "b_has_note", "street", "house_no").agg(
        F.count("*").alias("rows"), F.sum(F.col("is_poi").cast("long")).alias("pois"), F.sum(F.col("is_simple").cast("long")).alias("simple"),
        F.bool_or("has_note").alias("note"), F.min("osm_id").alias("first_id"), F.min("muni_id").alias("muni_id"))
    same = F.col("street").eqNullSafe(F.col("b_street")) & F.col("house_no").eqNullSafe(F.col("b_house_no"))
    one = F.struct(F.col("first_id"), F.col("street"), F.col("house_no"), F.col("muni_id"))
    text = F.coalesce(F.concat(F.lit("="), F.col("street")), F.lit(""))
    return per_address.groupBy("building_id", "b_street", "b_house_no", "b_has_note").agg(
        F.sum("rows").alias("rows"), F.sum("pois").alias("pois"), F.sum("simple").alias("simple"), F.count("*").alias("addresses"),
        (F.min(text) == F.max(text)).alias("one_street"),
        (F.min(F.coalesce(number, F.lit(-2))) == F.max(F.coalesce(number, F.lit(-2)))).alias("one_number"),
        F.bool_and(same).alias("match"),
        F.bool_and(T.address_number_match(F.col("street"), F.col("b_street"), F.col("house_no"), F.col("b_house_no"))).alias("number_match"),
        F.bool_or(F.coalesce(F.col("house_no") == F.col("b_house_no"), F.lit(False))).alias("any_number_same"),
        F.bool_or("note").alias("any_note"), F.min(one).alias("one"))


def resolution(facts: DataFrame) -> DataFrame:
    """One code per building."""
    f = F.col
    poi_only, addr_only = (f("pois") > 0) & (f("simple") == 0), (f("simple") > 0) & (f("pois") == 0)
    both, single = (f("pois") > 0) & (f("simple") > 0), f("pois") + f("simple") == 1
    has_address = f("b_street").isNotNull() | f("b_house_no").isNotNull()

    def agree(a: str, b: str) -> Column:
        return F.coalesce(f(a) == f(b), F.lit(False))

    def present(a: str, b: str) -> Column:
        return f(a).isNotNull() & f(b).isNotNull()

    same_street, same_number = agree("one.street", "b_street"), agree("one.house_no", "b_house_no")
    clash = F.when(same_street, present("one.house_no", "b_house_no")).otherwise(same_number & present("one.street", "b_street"))
    equal_all = (f("addresses") == 1) & f("match")
    loose = f("one_street") & f("one_number") & f("number_match")
    half_repeated = (f("addresses") > 1) & (f("addresses") < f("rows"))
    plain_number = F.coalesce(f("b_house_no").rlike("^[0-9]+$"), F.lit(False))

    def pick(poi: int, address: int) -> Column:
        return F.when(poi_only, poi).otherwise(address)

    one_with = F.when(poi_only, F.when(f("match"), NO_ACTION).otherwise(NOT_MATCHING)).otherwise(
        F.when(f("match"), MERGE_ADDRESS).when(clash, NOT_MATCHING).otherwise(MERGE_ADDRESS))
    many_with = (F.when(equal_all, pick(NO_ACTION, MERGE_ADDRESS))
                 .when(loose & f("any_number_same"), pick(REMOVE_FROM_BUILDING, NOT_MATCHING))
                 .when(loose & (half_repeated | ~plain_number), NOT_MATCHING).when(loose, NO_ACTION)
                 .when(f("addresses") == 1, NOT_MATCHING).otherwise(REMOVE_FROM_BUILDING))
    one_without = pick(MERGE_POI, MERGE_ADDRESS)
    many_without = F.when(f("addresses") == 1, pick(COPY_POI_ADDRESS, MERGE_ADDRESS)).otherwise(pick(NO_ACTION, ATTACH_ADDRESSES))
    code = F.when(both, TOO_COMPLEX).when(has_address, F.when(single, one_with).otherwise(many_with)).otherwise(F.when(single, one_without).otherwise(many_without))
    noted = F.when((code != NO_ACTION) & (f("b_has_note") | f("any_note")), NOTE_PRESENT).otherwise(code)
    final = (F.when(f("building_id").startswith("n"), BUILDING_IS_NODE).when((f("pois") == 0) & (f("simple") == 0), TOO_COMPLEX).otherwise(noted))
    return facts.withColumn("resolution", final)


def resolution_label(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(RESOLUTIONS[i]) for i in range(1, 11)]), code)


def addresses_in_buildings(nodes: DataFrame, buildings: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Q2: every address node in a building with the building's resolution; buildings that need nothing are left out.

    ``nodes``: ``osm_id, muni_id, street, house_no, is_poi, is_simple, has_note, x, y``; ``buildings``: ``osm_id, rings, street, house_no, has_note``.
    """
    pairs = nodes_in_buildings(nodes, buildings, options=options)
    codes = resolution(building_facts(pairs)).where(F.col("resolution") != NO_ACTION).select("building_id", "resolution", "pois", "simple")
    return pairs.join(codes, "building_id")  # one code per building; adaptive execution splits a crowded one


def resolution_breakdown(q2: DataFrame, munis: DataFrame | None = None) -> DataFrame:
    """Distinct buildings per municipality and resolution, nine columns and a total; with ``munis`` zeros for those without any."""
    one = q2.select("muni_id", "building_id", "resolution").distinct()
    codes = [c for c in RESOLUTIONS if c != NO_ACTION]
    counts = one.groupBy("muni_id").agg(*[F.count_if(F.col("resolution") == c).alias(RESOLUTIONS[c].lower()) for c in codes], F.count("*").alias("total"))
    return counts if munis is None else with_zero_rows(counts, munis, "muni_id")


def building_listing(q2: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """One row per building: address text, node counts, whether any node carries an authority id, resolution name.

    The nodes stay rows of ``addresses_in_buildings`` (same ``building_id``), so no building gathers an unbounded list.
    """
    has_ref = F.bool_or(F.col("house_ref").isNotNull()) if "house_ref" in q2.columns else F.lit(False)
    g = q2.groupBy("building_id", "b_street", "b_house_no", "resolution").agg(F.count("*").alias("nodes"), F.sum(F.col("is_poi").cast("long")).alias("pois"), has_ref.alias("any_ref"))
    return g.select("building_id", F.concat_ws(" ", "b_street", "b_house_no").alias("building_address"), "nodes", "pois", "any_ref",
                    resolution_label(F.col("resolution")).alias("resolution_name"))
