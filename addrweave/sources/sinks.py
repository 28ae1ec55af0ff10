"""Sinks: CSV, JSON and GeoJSON layers (O1-O3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.options import EXCLUDED_DISTRICTS


def write_csv(df: DataFrame, path: str) -> None:
    """O1: CSV with a header; nested columns as JSON text."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    """O2: one JSON object per row."""
    df.write.mode("overwrite").json(path)


def feature(rings: Column, single: Column, **properties: Column) -> Column:
    """GeoJSON feature text; ``single`` picks Polygon over MultiPolygon."""
    coords = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    props = F.struct(*[v.alias(k) for k, v in properties.items()])
    one = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"), props.alias("properties")))
    many = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("MultiPolygon").alias("type"), F.transform(coords, lambda r: F.array(r)).alias("coordinates")).alias("geometry"),
                              props.alias("properties")))
    return F.when(single, one).otherwise(many)


def choropleth(bounds: DataFrame, ratios: DataFrame, key: str, step: float, digits: int = 4) -> DataFrame:
    """Boundary and ratio as GeoJSON features, thinned to ``step``; single polygons rounded; some districts left out.

    ``bounds``: key, ``district``, ``rings``; ``ratios``: key, ``ratio``.
    """
    d = bounds.where(~F.col("district").isin(EXCLUDED_DISTRICTS)).join(ratios.select(key, "ratio"), key)
    thin, single = G.thin("rings", step), F.size("rings") == 1
    shape = F.when(single, G.round_coordinates(thin, digits)).otherwise(thin)
    return d.select(key, feature(shape, single, id=F.col(key).cast("string"), ratio=F.col("ratio")).alias("value"))


def write_features(features: DataFrame, path: str) -> None:
    """O3: one feature per line."""
    features.select("value").write.mode("overwrite").text(path)
