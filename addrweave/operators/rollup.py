"""Aggregations over analysis tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def address_progress(q1: DataFrame, osm: DataFrame | None = None) -> DataFrame:
    """A1 + A2: authority, conflated, matched and partial counts per settlement, municipality and country, in one pass.

    ``level`` is 0 for settlement, 1 for municipality, 3 for country. With ``osm``, its entities are counted per municipality and country.
    """
    def state(s: str) -> Column:
        return F.count_if(F.col("state") == s).alias(s)
    g = q1.groupingSets([["muni_id", "settl_id"], ["muni_id"], []], "muni_id", "settl_id").agg(
        F.count("*").alias("authority"), state("conflated"), state("matched"), state("partial"), state("not_found"), F.grouping_id().alias("level"))
    g = g.withColumn("ratio", F.try_divide(100.0 * F.col("conflated"), F.col("authority")))
    if osm is None:
        return g
    m = osm.groupingSets([["muni_id"], []], "muni_id").agg(F.count("*").alias("on_map"), F.when(F.grouping("muni_id") == 1, 3).otherwise(1).alias("level"))
    m = m.select(F.col("muni_id").alias("_m"), F.col("level").alias("_l"), "on_map")
    return g.join(m, g["muni_id"].eqNullSafe(m["_m"]) & (g["level"] == m["_l"]), "left").drop("_m", "_l")


def building_counts(addresses: DataFrame, buildings: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both tables per key."""
    a = addresses.groupBy(*keys).agg(F.count("*").alias("addresses"))
    b = buildings.groupBy(*keys).agg(F.count("*").alias("buildings"))
    return a.join(b, keys, "full").fillna(0, ["addresses", "buildings"])


def with_ratio(counts: DataFrame) -> DataFrame:
    """``100 * buildings / addresses`` capped at 100000; no address gives 100001 as sort value."""
    ratio = F.least(F.try_divide(100.0 * F.col("buildings"), F.col("addresses")), F.lit(100000.0))
    return counts.withColumns({"ratio": ratio, "ratio_order": F.coalesce(ratio, F.lit(100001.0))})


def building_ratio(addresses: DataFrame, buildings: DataFrame, keys: list[str]) -> DataFrame:
    """Addresses and buildings per key that both tables carry, and their ratio (``settlement_building_ratio`` finds the key by geometry)."""
    return with_ratio(building_counts(addresses, buildings, keys))


def with_zero_rows(counts: DataFrame, keys_table: DataFrame, key: str) -> DataFrame:
    """Every key of ``keys_table`` present, missing counts zero."""
    return keys_table.select(key).distinct().join(counts, key, "left").fillna(0)


def count_per_muni(df: DataFrame, name: str = "n") -> DataFrame:
    """Rows per municipality."""
    return df.groupBy("muni_id").agg(F.count("*").alias(name))


def removed_counts(removed: DataFrame, munis: DataFrame | None = None) -> DataFrame:
    """Removed addresses still on the map, and those that carry a new id again, per municipality; with ``munis`` also those without any."""
    counts = removed.groupBy("muni_id").agg(F.count("*").alias("removed"), F.count_if(F.col("house_ref").isNotNull()).alias("readded"))
    return counts if munis is None else munis.select("muni_id").join(counts, "muni_id", "left").fillna(0, ["removed", "readded"])


def merged_tags(tagged: DataFrame, key: str) -> DataFrame:
    """Per key and tag, the distinct values joined by ``;`` in value order. Tags are exploded, so a key's rows never meet as a list of rows."""
    t = tagged.select(key, F.explode("tags").alias("tag", "value")).distinct()
    return t.groupBy(key, "tag").agg(F.array_join(F.array_sort(F.collect_list("value")), ";").alias("value"))


def distinct_values(df: DataFrame, keys: list[str], *cols: str) -> DataFrame:
    """Every distinct value per key, one row each (``attribute``, ``value``); nulls are left out. A set of any size stays rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(*keys, pairs.alias("p")).select(*keys, "p.attribute", "p.value").where("value IS NOT NULL").distinct()


def first_value(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Value of the row with the smallest ``order``."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(value))


def require_complete(df: DataFrame, key: str, at_least: int) -> DataFrame:
    """``df``; fails when it has fewer than ``at_least`` distinct keys (one number comes to the driver)."""
    seen = df.agg(F.count_distinct(key)).first()[0]
    if seen < at_least:
        raise ValueError(f"expected at least {at_least} {key} values, found {seen}")
    return df


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that should be unique and are not."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")
