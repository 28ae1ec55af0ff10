"""Street-name mapping: from authority spelling to the name on the map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import text as T
from addrweave.operators.ranking import keep_top
from addrweave.operators.skew import skew_join
from addrweave.options import DEFAULTS, Options

SHOWN_REFS = 5  #: references that the listing shows; a display rule only


def _named_ways(ways: DataFrame) -> DataFrame:
    return ways.where(F.col("highway").isNotNull() & F.col("name").isNotNull() & (F.col("name") != ""))


def ref_names(ways: DataFrame) -> DataFrame:
    """M1: distinct names per street reference with the number of ways; the ways themselves are ``ref_name_ways``."""
    return ref_name_ways(ways).groupBy("street_ref", "name").agg(F.count("*").alias("way_count"))


def ref_name_ways(ways: DataFrame) -> DataFrame:
    """Every named way with a street reference: ``street_ref, name, osm_id``."""
    return _named_ways(ways).where(F.col("street_ref").isNotNull()).select("street_ref", "name", "osm_id")


def latin_names(ways: DataFrame) -> DataFrame:
    """M2: distinct Cyrillic names per Latin comparison form with the number of ways; the ways themselves are ``latin_name_ways``."""
    return latin_name_ways(ways).groupBy("name_key", "name").agg(F.count("*").alias("way_count"))


def latin_name_ways(ways: DataFrame) -> DataFrame:
    """Every way with a Cyrillic name: ``name_key, name, osm_id``."""
    return _named_ways(ways).where(T.is_cyrillic("name")).select(T.norm_latin("name").alias("name_key"), "name", "osm_id")


def _only_one(names: DataFrame, key: str) -> DataFrame:
    """Keys with exactly one name."""
    one = names.groupBy(key).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return names.join(one, key)


def resolve_names(streets: DataFrame, curated: DataFrame, ref: DataFrame, latin: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """M3: name and source of distinct ``(street_code, street_name)``: curated, one name by reference, one name by spelling, best effort."""
    s = streets.select("street_code", "street_name", T.squeeze("street_name").alias("rgz_name")).withColumn("name_key", T.norm_latin("rgz_name"))
    by_ref = _only_one(ref, "street_ref").select(F.col("street_ref").alias("street_code"), F.col("name").alias("ref_name"), F.col("way_count").alias("ref_ways"))
    by_latin = _only_one(latin, "name_key").select("name_key", F.col("name").alias("osm_name"), F.col("way_count").alias("osm_ways"))
    cur = curated.select("rgz_name", F.col("name").alias("curated_name"))
    j = skew_join(s, cur, ["rgz_name"], "left").join(by_ref, "street_code", "left")
    j = skew_join(j, by_latin, ["name_key"], "left")
    guess = T.decapitalize("rgz_name") if options.decapitalize else F.col("rgz_name")
    source = F.when(F.col("curated_name").isNotNull(), "curated").when(F.col("ref_name").isNotNull(), options.street_ref).when(F.col("osm_name").isNotNull(), "OSM")
    ways = F.when(F.col("curated_name").isNotNull(), F.lit(0)).when(F.col("ref_name").isNotNull(), F.col("ref_ways")).otherwise(F.col("osm_ways"))
    return j.select("street_code", F.col("street_name").alias("rgz_name"), F.coalesce("curated_name", "ref_name", "osm_name", guess).alias("name"),
                    F.coalesce(source, F.lit("BestEffort")).alias("source"), F.coalesce(ways, F.lit(0)).alias("ref_count"))


def build_mapping(streets: DataFrame, curated: DataFrame, ref: DataFrame, latin: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """M4: one row per authority name: all curated names, then the name of the smallest street code bearing the name."""
    pairs = streets.select("street_code", "street_name").distinct()  # U4
    resolved = resolve_names(pairs, curated, ref, latin, options)
    rest = resolved.join(curated.select("rgz_name"), "rgz_name", "left_anti")
    first = rest.groupBy("rgz_name").agg(F.min(F.struct("street_code", "name", "source", "ref_count")).alias("m"))
    return curated.select("rgz_name", "name", F.lit("curated").alias("source"), F.lit(0).cast("long").alias("ref_count"), F.lit(None).cast("string").alias("street_code")).unionByName(
        first.select("rgz_name", "m.name", "m.source", "m.ref_count", "m.street_code"))


def mapping_ways(mapping: DataFrame, ways: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """All ways that a mapped name was taken from, one row each: ``rgz_name, osm_id``."""
    by_ref = mapping.where(F.col("source") == options.street_ref).select("rgz_name", F.col("street_code").alias("street_ref"))
    by_name = mapping.where("source = 'OSM'").select("rgz_name", T.norm_latin(T.squeeze("rgz_name")).alias("name_key"))
    return by_ref.join(ref_name_ways(ways), "street_ref").select("rgz_name", "osm_id").unionByName(
        skew_join(latin_name_ways(ways), by_name, ["name_key"], "inner").select("rgz_name", "osm_id"))


def lookup_name(df: DataFrame, mapping: DataFrame, overrides: DataFrame, default: Column, out: str = "proper_name") -> DataFrame:
    """M5: name for ``(street_name, street_code)``: the street's own override, else the mapped name, else ``default``.

    An override counts only for names the mapping knows. Joins are skew-safe: a popular name may be on very many rows.
    """
    m = mapping.select(F.col("rgz_name").alias("street_name"), F.col("name").alias("_mapped"))
    o = overrides.select(F.col("rgz_name").alias("street_name"), F.col("street_code"), F.col("name").alias("_own"))
    j = skew_join(skew_join(df, m, ["street_name"], "left"), o, ["street_name", "street_code"], "left")
    name = F.when(F.col("_mapped").isNull(), default).otherwise(F.coalesce("_own", "_mapped"))
    return j.withColumn(out, name).drop("_mapped", "_own")


def overrides_without_base(overrides: DataFrame, mapping: DataFrame) -> DataFrame:
    """M6: overrides whose name the mapping lacks; any row is an error."""
    return overrides.join(mapping.select("rgz_name"), "rgz_name", "left_anti")


def missing_names(streets: DataFrame, mapping: DataFrame) -> DataFrame:
    """M7: authority names without mapping and a first guess."""
    lost = streets.select("street_code", F.col("street_name").alias("rgz_name")).distinct().join(mapping.select("rgz_name"), "rgz_name", "left_anti")
    return lost.withColumn("guess", T.decapitalize("rgz_name"))


def sorted_curated(curated: DataFrame) -> DataFrame:
    """M8: curated list in name order; a blank name fails the job."""
    checked = F.when(F.col("name").isNull() | (F.trim("name") == ""), F.raise_error(F.concat(F.lit("blank name for "), "rgz_name"))).otherwise(F.col("name"))
    return curated.select("rgz_name", checked.alias("name")).orderBy("rgz_name")


def name_list(streets: DataFrame, curated: DataFrame) -> DataFrame:
    """Names in use that are not curated, and curated spellings of names in use."""
    used = streets.select(F.col("street_name").alias("rgz_name")).distinct()
    plain = used.join(curated.select("rgz_name"), "rgz_name", "left_anti").select(F.col("rgz_name").alias("name"))
    return plain.union(curated.join(used, "rgz_name", "left_semi").select("name")).distinct()


def mapping_listing(mapping: DataFrame, overrides: DataFrame, ways: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Q18: default name, source, first references for display, number of exceptions; outer blanks made visible; in Serbian order."""
    o = overrides.groupBy("rgz_name").agg(F.count("*").alias("exceptions"))
    shown = keep_top(mapping_ways(mapping, ways, options), ["rgz_name"], [F.asc("osm_id")], SHOWN_REFS)
    shown = shown.groupBy("rgz_name").agg(F.array_join(F.array_sort(F.collect_list("osm_id")), ",").alias("refs"))
    return mapping.join(o, "rgz_name", "left").join(shown, "rgz_name", "left").select(
        T.show_blank("rgz_name").alias("rgz_name"), T.show_blank("name").alias("name"), "source", F.coalesce("refs", F.lit("")).alias("refs"),
        "ref_count", F.coalesce("exceptions", F.lit(0)).alias("exceptions"), T.serbian_sort_key("rgz_name").alias("sort_key"))
