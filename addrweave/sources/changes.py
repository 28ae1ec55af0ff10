"""Change files for map editors (E18): the elements an edit plan touches, as they are after it, one XML file a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import text as T

KINDS = {"n": "node", "w": "way", "r": "relation"}


def _attribute(name: str, value: Column) -> Column:
    """`` name="value"``, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f' {name}="'), T.xml_escape(value), F.lit('"')), F.lit(""))


def _lines(items: Column, line) -> Column:
    return F.array_join(F.transform(items, line), "")


def change_elements(plan: DataFrame, entities: DataFrame, members: DataFrame) -> DataFrame:
    """One row per batch and element: ``batch_id, kind, number`` (its order in the file) and its XML in ``value``.

    ``plan`` as in ``plans.edits`` (``lon, lat`` where elements are created); ``entities``: ``osm_id, version, lat, lon, tags``; ``members``: ``osm_id, pos,
    ref`` (and ``role`` of relation members), the nodes of ways in order, since an editor takes a way without nodes as one that lost them. An element's tags are those
    of now with the plan's changes; a null new value removes a tag. Created elements have ids that count down from -1 in a batch. An entity the table lacks comes
    with its changes alone.
    """
    place = [F.first(c, ignorenulls=True).alias(f"_{c}") if c in plan.columns else F.lit(None).cast("double").alias(f"_{c}") for c in ("lat", "lon")]
    change = F.struct("tag", "new_value")
    d = plan.groupBy(F.coalesce("batch_id", F.lit("all")).alias("batch_id"), "entity_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("tag").isNotNull(), change))).alias("_changes"),
        F.when(F.bool_or(F.col("action") == "delete"), "delete").when(F.bool_or(F.col("action") == "create"), "create").otherwise("modify").alias("action"), *place)
    now = entities.select(F.col("osm_id").alias("entity_id"), "version", "lat", "lon", "tags")
    parts = members.join(plan.select(F.col("entity_id").alias("osm_id")).distinct(), "osm_id", "left_semi")
    role = F.col("role") if "role" in members.columns else F.lit(None).cast("string")
    parts = parts.groupBy(F.col("osm_id").alias("entity_id")).agg(F.array_sort(F.collect_list(F.struct("pos", "ref", role.alias("role")))).alias("_parts"))
    d = d.join(now, "entity_id", "left").join(parts, "entity_id", "left")
    kept = F.filter(F.map_entries(F.coalesce("tags", F.expr("map()").cast("map<string,string>"))), lambda t: ~F.exists("_changes", lambda c: c["tag"] == t["key"]))
    new = F.transform(F.filter("_changes", lambda c: c["new_value"].isNotNull()), lambda c: F.struct(c["tag"].alias("key"), c["new_value"].alias("value")))
    tags = F.array_sort(F.concat(kept, new))
    created = F.col("action") == "create"
    kind = F.when(created, "node").otherwise(F.coalesce(*[F.when(F.col("entity_id").startswith(k), v) for k, v in KINDS.items()]))
    d = d.withColumns({"kind": kind, "_tags": tags, "_id": F.when(created, F.col("entity_id")).otherwise(F.substring("entity_id", 2, 30))})
    at = {c: F.format_string("%.7f", F.coalesce(c, f"_{c}").cast("double")) for c in ("lat", "lon")}
    head = F.concat(
        F.lit("  <"), "kind", _attribute("id", F.col("_id")), _attribute("action", F.when(created, "modify").otherwise(F.col("action"))), F.lit(' visible="true"'),
        _attribute("version", F.when(~created, F.col("version"))), *[_attribute(c, F.when((F.col("kind") == "node") & F.coalesce(c, f"_{c}").isNotNull(), at[c])) for c in ("lat", "lon")], F.lit(">\n"))
    inner = F.when(F.col("kind") == "way", _lines("_parts", lambda p: F.concat(F.lit("    <nd"), _attribute("ref", F.substring(p["ref"], 2, 30)), F.lit("/>\n")))).when(
        F.col("kind") == "relation", _lines("_parts", lambda p: F.concat(
            F.lit("    <member"), _attribute("type", F.coalesce(*[F.when(p["ref"].startswith(k), v) for k, v in KINDS.items()])), _attribute("ref", F.substring(p["ref"], 2, 30)),
            _attribute("role", F.coalesce(p["role"], F.lit(""))), F.lit("/>\n"))))
    body = _lines("_tags", lambda t: F.concat(F.lit("    <tag"), _attribute("k", t["key"]), _attribute("v", t["value"]), F.lit("/>\n")))
    return d.select("batch_id", "kind", F.col("_id").cast("bigint").alias("number"), F.concat(head, F.coalesce(inner, F.lit("")), body, F.lit("  </"), "kind", F.lit(">")).alias("value"))


def write_change_files(elements: DataFrame, path: str, generator: str = "addrweave") -> None:
    """One file a batch under ``path/batch_id=B``: a batch goes to one task, which writes its elements in order (nodes, ways, relations; by id)."""
    batches = elements.select("batch_id").distinct()
    order = F.when(F.col("kind") == "node", 1).when(F.col("kind") == "way", 2).otherwise(3)
    rows = elements.select("batch_id", order.alias("_k"), "number", "value")
    for k, text in ((0, f'<?xml version="1.0" encoding="UTF-8"?>\n<osm version="0.6" generator="{generator}">'), (9, "</osm>")):
        rows = rows.unionByName(batches.select("batch_id", F.lit(k).alias("_k"), F.lit(0).cast("bigint").alias("number"), F.lit(text).alias("value")))
    rows = rows.repartition("batch_id").sortWithinPartitions("batch_id", "_k", "number")
    rows.select("batch_id", "value").write.mode("overwrite").partitionBy("batch_id").text(path)
