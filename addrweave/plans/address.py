"""Address analyses: matching, progress, import check, duplicates, unaccounted and removed addresses (Q1, Q3-Q6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.functions import similarity as S
from addrweave.functions import text as T
from addrweave.operators.cells import points_in_polygons, radius_pairs, shape_pairs
from addrweave.operators.ranking import keep_first
from addrweave.operators.skew import skew_join
from addrweave.options import DEFAULTS, Options


def _shape(osm: DataFrame) -> Column:
    """Rings or lines of a map entity; null for points and for tables without shapes."""
    return F.col("rings") if "rings" in osm.columns else F.lit(None).cast("array<array<struct<x:double,y:double>>>").alias("rings")


def _near(auth: DataFrame, free: DataFrame, with_shapes: bool, options: Options, counted: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Pairs within the radius by the distance to the entity's geometry."""
    if with_shapes:
        return shape_pairs(auth, free, options.radius, ["muni_id"], options.rows_per_task, counted)
    return radius_pairs(auth, free.drop("rings"), options.radius, ["muni_id"], rows_per_task=options.rows_per_task)


def conflate(auth: DataFrame, osm: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """J1 + W1: nearest map entity that carries the authority id; one row per authority address that has one."""
    carriers = osm.where(F.col("house_ref").isNotNull()).select(
        F.col("house_ref").alias("addr_id"), F.col("osm_id").alias("conflated_osm_id"), F.col("street").alias("conflated_street"),
        F.col("house_no").alias("conflated_house_no"), F.col("x").alias("mx"), F.col("y").alias("my"), _shape(osm))
    pairs = skew_join(carriers, auth.select("addr_id", "x", "y"), ["addr_id"], "inner", options.rows_per_task)
    pairs = pairs.withColumn("conflated_distance", G.shape_distance(F.col("x"), F.col("y"), "rings", F.col("mx"), F.col("my"))).drop("x", "y", "mx", "my", "rings")
    return keep_first(pairs, ["addr_id"], [F.col("conflated_distance"), F.col("conflated_osm_id")])


def candidates(auth: DataFrame, osm: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Authority addresses with every map entity of their municipality within the radius that has no authority id.

    Left join: an address with nothing near comes once, with nulls.
    """
    free = osm.where(F.col("house_ref").isNull()).select("muni_id", "osm_id", F.col("x").alias("mx"), F.col("y").alias("my"), _shape(osm))
    pairs, _ = _near(auth.select("muni_id", "addr_id", "x", "y"), free, "rings" in osm.columns, options)
    pairs = pairs.select("addr_id", "osm_id", "distance")
    return auth.select("addr_id", "muni_id").join(pairs, "addr_id", "left")


def scored_pairs(auth: DataFrame, osm: DataFrame, options: Options = DEFAULTS) -> tuple[DataFrame, list[str]]:
    """Candidate pairs with score and perfect-match flag, between representatives.

    Equal authority rows (place, street, number) and equal map rows score alike. Only the smallest authority id and the largest map id of
    such copies can win the rankings that follow, so copies are folded before the join and cannot multiply its pairs.
    """
    a = (auth.select("muni_id", "addr_id", "x", "y", T.norm("street").alias("a_street"), T.norm("house_no").alias("a_number"))
         .groupBy("muni_id", "x", "y", "a_street", "a_number").agg(F.min("addr_id").alias("addr_id")).withColumns(S.number_parts("a_number", "a")))
    free = osm.where(F.col("house_ref").isNull()).select(
        "muni_id", "osm_id", F.col("x").alias("mx"), F.col("y").alias("my"), T.norm("street").alias("m_street"), T.norm("house_no").alias("m_number"), _shape(osm))
    m = (free.groupBy("muni_id", "mx", "my", "rings", "m_street", "m_number").agg(F.max("osm_id").alias("osm_id")).withColumns(S.number_parts("m_number", "m")))
    pairs, keys = _near(a, m, "rings" in osm.columns, options, free)  # counted before folding, which then happens once
    name = S.indel_ratio("a_street", "m_street")
    number = S.number_parts_similarity(*[{k: F.col(f"{side}_{k}") for k in ("digits", "letters")} for side in "am"])
    matching = F.coalesce((F.col("a_street") == F.col("m_street")) & (F.col("a_number") == F.col("m_number")), F.lit(False))
    return pairs.select(*keys, "addr_id", "osm_id", "distance", F.round(S.match_score(name, number, F.col("distance")), 9).alias("score"),
                        matching.alias("matching")), keys


def best_candidates(pairs: DataFrame, keys: list[str], with_shapes: bool = False) -> DataFrame:
    """W2-W4 as two keep-one steps: a map entity goes to its best address (perfect matches first), an address keeps its best entity.

    All pairs of a map point share one cell, so the first step runs where the join left them; only blocks of split cells and shapes, which may lie
    in several cells, need another look.
    """
    order = [F.desc("matching"), F.desc("score"), F.asc("addr_id")]
    won = keep_first(pairs, [*keys, "osm_id"], order)
    if "_bl" in keys or with_shapes:
        won = keep_first(won, ["osm_id"], order)
    return keep_first(won.drop(*[k for k in keys]), ["addr_id"], [F.desc("matching"), F.desc("score"), F.desc("osm_id")])


def match_addresses(auth: DataFrame, osm: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Q1: every authority address with the map entity that carries its id and the best candidate without id.

    ``auth``: ``addr_id, muni_id, street`` (mapped name), ``house_no, x, y`` and more; ``osm``: ``osm_id, muni_id, street, house_no,
    house_ref, x, y`` and, where ways and relations have one, ``rings``: distances go to that geometry and are 0 inside. Addresses that already carry an id still compete for candidates.
    """
    pairs, keys = scored_pairs(auth, osm, options)
    best = best_candidates(pairs, keys, "rings" in osm.columns)
    named = osm.select("osm_id", F.col("street").alias("osm_street"), F.col("house_no").alias("osm_house_no"))
    best = best.join(named, "osm_id")
    out = auth.join(conflate(auth, osm, options), "addr_id", "left").join(best, "addr_id", "left")
    return out.withColumn("score", F.coalesce("score", F.lit(0.0))).withColumn("matching", F.coalesce("matching", F.lit(False)))


def progress_state() -> Column:
    """Conflated, matched, partial or not found."""
    return (F.when(F.col("conflated_osm_id").isNotNull(), "conflated").when(F.col("osm_id").isNotNull() & F.col("matching"), "matched")
            .when(F.col("osm_id").isNotNull(), "partial").otherwise("not_found"))


def import_check(osm: DataFrame, auth: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """J7 + Q5: map entities with an authority id that is unknown, far away, or has another street or number. With a ``note`` column also the note to list."""
    a = auth.select(F.col("addr_id").alias("house_ref"), F.col("muni_id").alias("a_muni_id"), F.col("street").alias("a_street"), F.col("house_no").alias("a_house_no"),
                    F.col("x").alias("ax"), F.col("y").alias("ay"), F.lit(True).alias("known"))
    j = skew_join(osm.where(F.col("house_ref").isNotNull()), a, ["house_ref"], "left", options.rows_per_task)

    def same(left: Column, right: Column) -> Column:
        return F.coalesce(left == right, F.lit(False))

    number = T.norm_latin("a_house_no")
    note = [import_note(F.col("note"), options).alias("note")] if "note" in osm.columns else []
    out = j.select(
        "osm_id", "house_ref", "a_muni_id", "street", "house_no", "a_street", "a_house_no", F.coalesce("known", F.lit(False)).alias("known"),
        G.shape_distance(F.col("ax"), F.col("ay"), _shape(osm), F.col("x"), F.col("y")).alias("distance"),
        same(F.col("a_street"), F.col("street")).alias("street_perfect"), same(T.norm("a_street"), T.norm("street")).alias("street_partial"),
        same(number, F.col("house_no")).alias("number_perfect"), same(number, T.norm_latin("house_no")).alias("number_partial"), *note)
    ok = F.col("street_perfect") & F.col("street_partial") & F.col("number_perfect") & F.col("number_partial")
    return out.where(~F.col("known") | (F.col("distance") > options.far) | ~ok)


def import_note(note: Column, options: Options = DEFAULTS) -> Column:
    """A mapper's note is listed if it names the authority and is not the mark of a removal; else an empty text."""
    kept = note.contains(options.authority) & ~note.contains(f"Izbrisano iz {options.authority}-a")
    return F.when(F.coalesce(kept, F.lit(False)), note).otherwise("")


def import_priority() -> Column:
    """1 id unknown, 2 other street, 3 other number, 4 street spelled otherwise, 5 number spelled otherwise."""
    return (F.when(~F.col("known"), 1).when(~F.col("street_perfect") & ~F.col("street_partial"), 2)
            .when(~F.col("number_perfect") & ~F.col("number_partial"), 3).when(~F.col("street_perfect"), 4).otherwise(5))


def duplicated_refs(osm: DataFrame, auth: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Q3 (I17, A16, J21): authority ids on several map entities whose streets or numbers differ; a blank counts as equal.

    One row per entity of such an id, with the id's municipality or ``N/A``. Sets are reduced to minimum, maximum and a blank flag, so an
    id repeated on most of the map is no larger than any other.
    """
    e = osm.where(F.col("house_ref").isNotNull()).select("house_ref", "osm_id", F.coalesce("street", F.lit("")).alias("street"),
                                                         F.coalesce("house_no", F.lit("")).alias("house_no"))

    def differ(c: str) -> Column:
        return (F.min(c) != F.max(c)) & ~F.bool_or(F.col(c) == "")

    bad = (e.groupBy("house_ref").agg(differ("street").alias("streets_differ"), differ("house_no").alias("numbers_differ"), F.count("*").alias("entities"))
           .where("streets_differ OR numbers_differ"))
    munis = auth.select(F.col("addr_id").alias("house_ref"), T.cyr2lat("muni_name").alias("muni_name"))
    bad = bad.join(munis, "house_ref", "left").withColumn("muni_name", F.coalesce("muni_name", F.lit("N/A")))
    return skew_join(e, bad, ["house_ref"], "inner", options.rows_per_task)


def unaccounted(osm: DataFrame, muni_polygons: DataFrame, size: float = 1000.0, options: Options = DEFAULTS) -> DataFrame:
    """Q4: map addresses inside a municipality with a number, no authority id and no removed-id tag."""
    free = osm.where(F.col("house_no").isNotNull() & F.col("house_ref").isNull() & ~F.col("is_removed"))
    return points_in_polygons(free, muni_polygons, size, rows_per_task=options.rows_per_task)


def removed_on_map(osm: DataFrame, muni_polygons: DataFrame, size: float = 1000.0, options: Options = DEFAULTS) -> DataFrame:
    """Q6: entities that keep a removed authority id, with municipality and removal date from the note."""
    gone = osm.where(F.col("removed_ref").isNotNull())
    return points_in_polygons(gone, muni_polygons, size, rows_per_task=options.rows_per_task).withColumn(
        "removal_date", T.removal_date("note", options.authority))
