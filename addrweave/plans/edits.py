"""Edit plans (E1-E18): tables of proposed tag changes ``(entity_id, action, tag, old_value, new_value, batch_id, reason)``.

Nothing is sent anywhere; the current map table is joined where a plan depends on what an entity holds now.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.functions import text as T
from addrweave.functions.projection import from_utm
from addrweave.operators.ranking import batch_numbers, keep_first, row_numbers
from addrweave.operators.rollup import merged_tags
from addrweave.operators.skew import skew_join
from addrweave.options import DEFAULTS, Options
from addrweave.session import stable

# Tags whose building value stays when an address moves in, next to addr:*.
KEEP_ON_BUILDING = ["building", "building:levels", "roof:levels", "survey:date"]
# Building values that may become apartments.
MAY_BE_APARTMENTS = ["house", "yes", "residential", "terrace", "construction"]
NO_TEXT = "CAST(NULL AS STRING)"


def tag_rows(df: DataFrame, entity: str, reason: str, changes: list[tuple[str, Column, Column]], action: str = "modify", batch: str | None = None,
             keep: list[str] | None = None) -> DataFrame:
    """One row per tag whose value changes. ``changes``: tag, old value, new value (null new value removes the tag)."""
    items = F.array(*[F.struct(F.lit(t).alias("tag"), o.cast("string").alias("old_value"), n.cast("string").alias("new_value")) for t, o, n in changes])
    real = F.filter(items, lambda c: ~c["old_value"].eqNullSafe(c["new_value"]))
    batch_id = F.col(batch).cast("string") if batch else F.expr(NO_TEXT)
    d = df.select(F.col(entity).alias("entity_id"), F.lit(action).alias("action"), batch_id.alias("batch_id"), F.lit(reason).alias("reason"), *(keep or []),
                  F.explode(real).alias("c"))
    return d.select("entity_id", "action", "c.tag", "c.old_value", "c.new_value", "batch_id", "reason", *(keep or []))


def is_kind(c: str, kinds: str) -> Column:
    return F.substring(c, 1, 1).isin(list(kinds))


def _new_address_rows(df: DataFrame, reason: str, options: Options) -> DataFrame:
    none = F.expr(NO_TEXT)
    place = F.col("use_place") if "use_place" in df.columns else F.lit(False)
    return tag_rows(df, "local_id", reason, [
        ("addr:street", none, F.when(~place, F.col("street"))), ("addr:place", none, F.when(place, F.col("street"))),
        ("addr:housenumber", none, T.norm_latin("house_no")), (options.street_ref, none, F.col("street_code")), (options.house_ref, none, F.col("addr_id")),
        ("addr:postcode", none, F.nullif(F.col("postcode").cast("string"), F.lit("")) if "postcode" in df.columns else none)],
        "create", "batch_id", ["lon", "lat"])


def _degrees(df: DataFrame, options: Options) -> DataFrame:
    """``lon`` and ``lat`` in degrees to six decimals: the register's own, else from its metres."""
    if "lon" in df.columns and "lat" in df.columns:
        lon, lat = F.col("lon").cast("double"), F.col("lat").cast("double")
    else:
        lon, lat = from_utm(F.col("x").cast("double"), F.col("y").cast("double"), options.metric_crs)
    return df.withColumns({"lon": F.bround(lon, 6), "lat": F.bround(lat, 6)})


def new_addresses(q1: DataFrame, options: Options = DEFAULTS, per_file: int = 100) -> DataFrame:
    """Addresses with neither id nor candidate, in batches of 100 per settlement; local ids count down from -1 in each batch."""
    d = q1.where(F.col("conflated_osm_id").isNull() & F.col("osm_id").isNull())
    d = row_numbers(d, ["settl_id"], ["street", "house_no", "addr_id"], "_no")
    d = d.withColumns({"local_id": (-1 - (F.col("_no") - 1) % per_file).cast("string"), "batch_id": F.concat(F.col("settl_id").cast("string"), F.lit("-new-"), F.floor((F.col("_no") - 1) / per_file).cast("string"))})
    return _new_address_rows(_degrees(d, options), "new address", options)


def new_addresses_per_street(q1: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """The same addresses with one batch per street of a settlement."""
    d = q1.where(F.col("conflated_osm_id").isNull() & F.col("osm_id").isNull())
    d = row_numbers(d, ["settl_id", "street", "street_code"], ["house_no", "addr_id"], "_no")
    d = d.withColumns({"local_id": (-F.col("_no")).cast("string"), "batch_id": F.concat(F.col("settl_id").cast("string"), F.lit("-"), F.col("street_code"))})
    return _new_address_rows(_degrees(d, options), "new address per street", options)


def attach_refs(q1: DataFrame, options: Options = DEFAULTS, per_file: int = 100) -> DataFrame:
    """Perfect candidates get the authority id; relations are left to people."""
    d = q1.where(F.col("conflated_osm_id").isNull() & F.col("osm_id").isNotNull() & F.col("matching") & is_kind("osm_id", "nw"))
    d = batch_numbers(d, ["settl_id"], ["street", "house_no", "addr_id"], per_file, "_b")
    d = d.withColumn("batch", F.concat(F.col("settl_id").cast("string"), F.lit("-matched-"), F.col("_b").cast("string")))
    none = F.expr(NO_TEXT)
    return tag_rows(d, "osm_id", "attach id", [(options.house_ref, none, F.col("addr_id"))], batch="batch")


def move_into_buildings(q2: DataFrame, node_tags: DataFrame, building_tags: DataFrame, merge_code: int = 3, per_file: int = 100) -> DataFrame:
    """Nodes of a building to merge give their tags to it and are deleted. ``node_tags``/``building_tags``: ``osm_id, tags``.

    ``addr:*`` and four building keys keep the building's value; other values are appended after ``;`` if new.
    """
    d = stable(q2.where((F.col("resolution") == merge_code) & F.col("building_id").startswith("w")).select("muni_id", "building_id", "osm_id"))  # three steps read it
    b = batch_numbers(d.select("muni_id", "building_id").groupBy("building_id").agg(F.min("muni_id").alias("muni_id")), ["muni_id"], ["building_id"], per_file, "_b")
    b = b.select("building_id", F.concat(F.col("muni_id").cast("string"), F.lit("-address_to_building-"), F.col("_b").cast("string")).alias("batch_id"))
    nodes = d.select("building_id", "osm_id").join(node_tags, "osm_id")
    merged = merged_tags(nodes, "building_id")
    own = building_tags.select(F.col("osm_id").alias("building_id"), F.explode("tags").alias("tag", "old_value"))
    j = merged.join(own, ["building_id", "tag"], "left").join(b, "building_id")
    stays = F.col("tag").startswith("addr:") | F.col("tag").isin(KEEP_ON_BUILDING)
    fresh = F.array_except(F.split("value", ";"), F.split("old_value", ";"))
    new = F.when(F.col("old_value").isNull(), F.col("value")).when(stays, F.col("old_value")).otherwise(F.array_join(F.concat(F.array("old_value"), fresh), ";"))
    changed = j.withColumn("new_value", new).where(~F.col("old_value").eqNullSafe(F.col("new_value"))).select(
        F.col("building_id").alias("entity_id"), F.lit("modify").alias("action"), "tag", "old_value", "new_value", "batch_id", F.lit("move address to building").alias("reason"))
    gone = d.select("building_id", "osm_id").distinct().join(b, "building_id").select(
        F.col("osm_id").alias("entity_id"), F.lit("delete").alias("action"), F.expr(NO_TEXT).alias("tag"), F.expr(NO_TEXT).alias("old_value"),
        F.expr(NO_TEXT).alias("new_value"), "batch_id", F.lit("move address to building").alias("reason"))
    return changed.unionByName(gone)


def attach_street_refs(found: DataFrame, streets: DataFrame, ways: DataFrame, per_file: int = 10, options: Options = DEFAULTS) -> DataFrame:
    """E5: name-matched ways get the street code; 10 streets per batch and settlement, with the bounding box of each street's ways."""
    hit = found.where(F.col("name_match") & is_kind("osm_id", "w")).select("osm_id", "street_id")
    pts = ways.select("osm_id", G.bounds("lines").alias("b"))
    j = hit.join(pts, "osm_id")
    box = j.groupBy("street_id").agg(F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"), F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax"))
    named = box.join(streets.select("street_id", "street_code", "settl_id", "street_name"), "street_id")
    batched = batch_numbers(named, ["settl_id"], ["street_name", "street_id"], per_file, "_b").withColumn(
        "batch", F.concat(F.col("settl_id").cast("string"), F.lit("-streets-"), F.col("_b").cast("string")))
    d = hit.join(batched, "street_id")
    return tag_rows(d, "osm_id", "attach street id", [(options.street_ref, F.expr(NO_TEXT), F.col("street_code"))], batch="batch", keep=["xmin", "ymin", "xmax", "ymax"])


def reref_or_remove(removed: DataFrame, moved: DataFrame, osm: DataFrame, on_date: str, options: Options = DEFAULTS) -> DataFrame:
    """Entities that carry a removed id get the id of the re-issued address, or keep it under ``removed:`` with a dated note; done ones are skipped.

    ``removed``: ``addr_id``; ``moved``: ``old_id, new_id``; ``osm``: ``osm_id, house_ref, removed_ref, note``.
    """
    d = skew_join(osm.where(F.col("house_ref").isNotNull()), removed.select(F.col("addr_id").alias("house_ref")), ["house_ref"], "inner")
    d = d.join(moved.select(F.col("old_id").alias("house_ref"), "new_id"), "house_ref", "left")
    text = f"Izbrisano iz {options.authority}-a {on_date}"
    again = d.where(F.col("new_id").isNotNull() & (F.col("house_ref") != F.col("new_id")))
    gone = d.where(F.col("new_id").isNull() & F.col("removed_ref").isNull())
    return tag_rows(again, "osm_id", "id re-issued", [(options.house_ref, F.col("house_ref"), F.col("new_id"))]).unionByName(tag_rows(
        gone, "osm_id", "address removed", [(f"removed:{options.house_ref}", F.col("removed_ref"), F.col("house_ref")),
                                            ("note", F.col("note"), F.concat_ws(";", "note", F.lit(text))), (options.house_ref, F.col("house_ref"), F.expr(NO_TEXT))]))


def changed_addresses(changed: DataFrame, osm: DataFrame) -> DataFrame:
    """Entities of an address whose mapped street or number changed. ``changed``: ``addr_id, street_name_old/new, street_new, house_no_old/new``."""
    c = changed.where((F.col("street_name_old") != F.col("street_name_new")) | (F.col("house_no_old") != F.col("house_no_new"))).select(
        F.col("addr_id").alias("house_ref"), F.col("street_new").alias("_s"), T.norm_latin("house_no_new").alias("_h"))
    d = skew_join(osm.where(F.col("house_ref").isNotNull()), c, ["house_ref"], "inner")
    return tag_rows(d, "osm_id", "address changed", [("addr:street", F.col("street"), F.col("_s")), ("addr:housenumber", F.col("house_no"), F.col("_h"))])


def auto_attach(q1: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Candidates up to 50 m (20 m unless perfect), no relations: id, and street and number put right. A null map street is written too."""
    near = (F.col("distance") <= options.far) & (F.col("matching") | (F.col("distance") <= 20))
    d = q1.where(F.col("conflated_osm_id").isNull() & F.col("osm_id").isNotNull() & is_kind("osm_id", "nw") & near)
    return tag_rows(d, "osm_id", "auto attach", [
        (options.house_ref, F.expr(NO_TEXT), F.col("addr_id")), ("addr:street", F.col("osm_street"), F.when(F.col("street") != "", F.col("street")).otherwise(F.col("osm_street"))),
        ("addr:housenumber", F.col("osm_house_no"), T.norm_latin("house_no"))])


def rewrite_streets(import_problems: DataFrame, decisions: DataFrame) -> DataFrame:
    """Street rewritten where the pair (map name, register name) is accepted. ``decisions``: ``street, a_street, accepted``."""
    d = import_problems.where(F.col("known") & ~F.col("street_perfect"))
    ok = decisions.where("accepted").select("street", "a_street").distinct()
    return tag_rows(d.join(ok, ["street", "a_street"]), "osm_id", "street rewritten", [("addr:street", F.col("street"), F.col("a_street"))])


def removed_streets(removed: DataFrame, ways: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """The code of a removed street moves to ``removed:``."""
    d = skew_join(ways.where(F.col("street_ref").isNotNull()), removed.select(F.col("street_code").alias("street_ref")), ["street_ref"], "inner")
    return tag_rows(d, "osm_id", "street removed", [(f"removed:{options.street_ref}", F.expr(NO_TEXT), F.col("street_ref")), (options.street_ref, F.col("street_ref"), F.expr(NO_TEXT))])


def renamed_streets(changed: DataFrame, ways: DataFrame, keep_old: bool = True) -> DataFrame:
    """Mapped name changed: four name tags set, alternative and short names dropped, old names kept if asked.

    ``changed``: ``street_code, old_name, new_name`` (mapped); ``ways``: ``osm_id, street_ref, name, tags``.
    """
    c = changed.where(F.col("old_name") != F.col("new_name")).select(F.col("street_code").alias("street_ref"), "old_name", "new_name")
    d = skew_join(ways.where(F.col("street_ref").isNotNull()), c, ["street_ref"], "inner").where(~F.col("name").eqNullSafe(F.col("new_name")))
    none = F.expr(NO_TEXT)

    def now(k: str) -> Column:
        return F.try_element_at("tags", F.lit(k))
    new, old = F.col("new_name"), F.col("old_name")
    rows = [("name", F.col("name"), new), ("name:sr", now("name:sr"), new), ("name:sr-Latn", now("name:sr-Latn"), T.cyr2lat(new)), ("int_name", now("int_name"), T.cyr2intname(new))]
    rows += [(k, now(k), none) for k in ("alt_name", "alt_name:sr", "alt_name:sr-Latn", "short_name", "short_name:sr", "short_name:sr-Latn")]
    if keep_old:
        rows += [("old_name", now("old_name"), old), ("old_name:sr", now("old_name:sr"), old), ("old_name:sr-Latn", now("old_name:sr-Latn"), T.cyr2lat(old))]
    return tag_rows(d, "osm_id", "street renamed", rows)


def auto_street_refs(found: DataFrame, summary: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Ways with a matching name or spelling get the street code; no hamlets, no unnamed ways."""
    hit = found.where((F.col("name_match") | F.col("norm_match")) & F.col("name").isNotNull() & is_kind("osm_id", "w"))
    d = hit.join(summary.where(~F.col("is_hamlet")).select("street_id", "street_code"), "street_id")
    return tag_rows(d, "osm_id", "auto street id", [(options.street_ref, F.expr(NO_TEXT), F.col("street_code"))])


def fix_name_tags(q7: DataFrame, now: DataFrame) -> DataFrame:
    """``name:sr`` and ``name:sr-Latn`` set from the current name, only where they still are what the analysis saw.

    ``now``: ``osm_id, now_name, now_sr, now_latn``; streets whose name itself is wrong or missing wait.
    """
    d = q7.where(F.col("street_ref").isNotNull() & ~F.col("wrong_name") & ~F.col("missing_name") & is_kind("osm_id", "w"))
    d = keep_first(d, ["osm_id"], [F.asc("street_ref")]).join(now, "osm_id").where(F.col("now_name").isNotNull())

    def target(wrong: str, missing: str, seen: str, current: str, value: Column) -> Column:
        go = (F.col(wrong) & F.col(seen).eqNullSafe(F.col(current))) | (F.col(missing) & F.col(current).isNull())
        return F.when(go, value).otherwise(F.col(current))
    return tag_rows(d, "osm_id", "name tags", [
        ("name:sr", F.col("now_sr"), target("wrong_name_sr", "missing_name_sr", "name_sr", "now_sr", F.col("now_name"))),
        ("name:sr-Latn", F.col("now_latn"), target("wrong_name_sr_latn", "missing_name_sr_latn", "name_sr_latn", "now_latn", T.cyr2lat_small("now_name")))])


def fix_int_names(q7: DataFrame, now: DataFrame | None = None) -> DataFrame:
    """``int_name`` put right on ways whose name is the register's; of a way's several references the first counts.

    With ``now`` (``osm_id, now_name, now_int_name``) only where name and tag still are what the analysis saw.
    """
    d = keep_first(q7.where((F.col("wrong_int_name") | F.col("missing_int_name")) & (F.col("proper") == F.col("name")) & is_kind("osm_id", "w")), ["osm_id"], [F.asc("street_ref")])
    if now is not None:
        d = d.join(now, "osm_id").where(F.col("name").eqNullSafe(F.col("now_name")) & F.col("int_name").eqNullSafe(F.col("now_int_name")))
    return tag_rows(d, "osm_id", "int_name", [("int_name", F.col("int_name"), T.cyr2intname("name"))])


ALT_SPELLINGS = [("alt_", "alt_name", "alt_name"), ("alt_sr_", "alt_name_sr", "alt_name:sr"), ("alt_latn_", "alt_name_sr_latn", "alt_name:sr-Latn")]


def fix_alt_names(q8: DataFrame, replacements: DataFrame, now: DataFrame | None = None) -> DataFrame:
    """Missing and wrong alternative names in three spellings set to the suggestion.

    Partial suggestions are used only where the table gives the full form; the Latin forms of its rows are derived. ``replacements``:
    ``alt_suggestion, full_name``. With ``now`` (``osm_id, now_name, now_alt_name, now_alt_name_sr, now_alt_name_sr_latn``) a tag is changed only while it is what the
    analysis saw, and unnamed ways wait; otherwise the analysed tags stand for the current ones.
    """
    spellings = [x for x in ALT_SPELLINGS if f"{x[0]}missing" in q8.columns]
    flags = [F.coalesce(F.col(f"{p}{f}"), F.lit(False)) for p, _, _ in spellings for f in ("missing", "wrong")]
    d = q8.where(is_kind("osm_id", "w") & reduce(lambda x, y: x | y, flags))
    if {"street_ref", "proper", "name"} <= set(q8.columns):
        d = d.where(F.col("street_ref").isNotNull() & (F.col("name") == F.col("proper")))
    d = keep_first(d, ["osm_id"], [F.asc("alt_suggestion")])
    d = d.withColumns({f"now_{c}": F.col(c) for _, c, _ in spellings}) if now is None else d.join(now, "osm_id").where(F.col("now_name").isNotNull())
    forms = [F.struct(f("alt_suggestion").alias("alt_suggestion"), f("full_name").alias("full_name")) for f in (F.col, T.cyr2lat_small)]
    table = stable(replacements.select(F.inline(F.array(*forms))).groupBy("alt_suggestion").agg(F.min("full_name").alias("_full")))  # one row a form, read for each spelling
    changes = []
    for p, c, tag in spellings:
        d = d.join(table.select(F.col("alt_suggestion").alias(f"{p}suggestion"), F.col("_full").alias(f"_{p}full")), f"{p}suggestion", "left")
        current = F.col(f"now_{c}")
        go = (F.col(f"{p}wrong") & current.eqNullSafe(F.col(c))) | (F.col(f"{p}missing") & current.isNull())
        new = F.when(F.col(f"{p}partial"), F.col(f"_{p}full")).otherwise(F.col(f"{p}suggestion"))
        changes.append((tag, current, F.when(go, F.coalesce(new, current)).otherwise(current)))
    return tag_rows(d, "osm_id", "alt_name", changes)


def unnamed_ways(found: DataFrame, ways: DataFrame, summary: DataFrame, munis: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Unnamed ways that run along a street (share 0.9, 20 m), no bridges: code and names, batched by district."""
    w = ways.where(F.col("bridge").isNull() & F.col("name").isNull() & F.col("street_ref").isNull()).select("osm_id")
    d = found.where((F.col("share") >= 0.9) & (F.col("way_length") >= 20) & is_kind("osm_id", "w")).join(w, "osm_id", "left_semi")
    s = summary.where(~F.col("is_hamlet") & F.col("proper_name").isNotNull()).select("street_id", "street_code", "proper_name")
    d = d.join(s, "street_id").join(munis.select("muni_id", "district"), "muni_id")
    none, p = F.expr(NO_TEXT), F.col("proper_name")
    return tag_rows(d, "osm_id", "unnamed way", [(options.street_ref, none, F.col("street_code")), ("name", none, p), ("name:sr", none, p),
                                                 ("name:sr-Latn", none, T.cyr2lat_small(p)), ("int_name", none, T.cyr2intname(p))], batch="district")


def tag_apartments(status: DataFrame, buildings: DataFrame, code: int = 4) -> DataFrame:
    """The one building of a community with a single map entity becomes apartments; each building once. ``buildings``: ``osm_id, building, construction``."""
    d = status.where((F.col("resolution") == code) & (F.col("entities") == 1) & F.col("closest_building").startswith("w"))
    d = keep_first(d, ["closest_building"], [F.asc("hc_id")]).join(buildings.withColumnRenamed("osm_id", "closest_building"), "closest_building")
    site = F.col("building") == "construction"
    d = d.where(F.col("building").isin(MAY_BE_APARTMENTS) & ~(site & F.coalesce(F.col("construction") == "apartments", F.lit(False))))
    return tag_rows(d, "closest_building", "apartments", [("building", F.col("building"), F.when(site, F.col("building")).otherwise("apartments")),
                                                          ("construction", F.col("construction"), F.when(site, F.lit("apartments")).otherwise(F.col("construction")))])


def change_rows(plan: DataFrame) -> DataFrame:
    """Plan rows ready for a change file: values escaped for XML."""
    return plan.withColumns({"tag": T.xml_escape("tag"), "new_value": T.xml_escape("new_value")})
