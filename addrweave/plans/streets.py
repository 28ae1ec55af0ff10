"""Street analyses: matching by geometry, name mismatch, missing geometry, rings, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.functions import names as N
from addrweave.functions import text as T
from addrweave.operators.lines import covered_by_partners, covered_length, hausdorff, is_ring
from addrweave.operators.ranking import keep_first
from addrweave.operators.rollup import with_zero_rows
from addrweave.operators.skew import skew_join
from addrweave.options import DEFAULTS, EXCLUDED_DISTRICTS, Options
from addrweave.plans.mapping import lookup_name
from addrweave.session import stable

# Highway classes that are no street candidates.
NO_STREET = ["footway", "cycleway", "path", "steps", "proposed", "construction", "corridor", "platform", "services", "rest_area", "raceway"]


def conflated_ways(streets: DataFrame, ways: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Map ways that carry the street's code: one row per street and way with both lines and the way's length."""
    carriers = ways.where(F.col("street_ref").isNotNull()).select(F.col("street_ref").alias("street_code"), "osm_id", F.col("lines").alias("other_lines"),
                                                                  F.round(G.length("lines"), 2).alias("way_length"))
    return skew_join(carriers, streets.select("street_code", "street_id", "lines"), ["street_code"], "inner", options.rows_per_task)


def near_ways(streets: DataFrame, ways: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Share of each way without code that runs within the buffer of a street of its municipality; shares above the limit only."""
    free = ways.where(F.col("street_ref").isNull() & ~F.col("highway").isin(NO_STREET))
    covered = covered_length(free.select("osm_id", "muni_id", "lines"), streets.select("street_id", "muni_id", F.col("lines").alias("other_lines")), options.buffer,
                             ["osm_id", "street_id"], scope=["muni_id"], rows_per_task=options.rows_per_task)
    lengths = free.select("osm_id", "name", "muni_id", G.length("lines").alias("way_length"))
    shares = covered.join(lengths, "osm_id").withColumn("share", F.round(F.col("covered") / F.col("way_length"), 9))
    return shares.where(F.col("share") > options.min_share).drop("covered")


def found_ways(streets: DataFrame, ways: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Q9, candidate side: each way with its one best street (W5: same name first, then share, then street id), with name comparisons."""
    names = streets.select("street_id", F.col("proper_name").alias("proper"), T.norm(F.coalesce("proper_name", "street_name")).alias("street_key"))
    j = near_ways(streets, ways, options).join(names, "street_id")  # names are unique; adaptive execution splits a street under very many ways
    key = T.norm("name")
    same = F.coalesce(F.col("street_key") == key, F.lit(True))  # W6: a missing name does not speak against a pair
    best = keep_first(j.withColumn("same_name", same), ["osm_id"], [F.desc("same_name"), F.desc("share"), F.asc("street_id")])
    return best.select("osm_id", "muni_id", "street_id", "share", F.round("way_length", 2).alias("way_length"), "name", "same_name",
                       F.coalesce((F.col("proper") == F.col("name")) & (F.col("proper") != ""), F.lit(False)).alias("name_match"),
                       F.coalesce((F.col("street_key") == key) & (key != ""), F.lit(False)).alias("norm_match"))


def street_summary(streets: DataFrame, ways: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Q9, register side: per street its length, the ways that carry its code, covered length and largest distance to them."""
    con = stable(conflated_ways(streets, ways, options))
    sums = con.groupBy("street_id").agg(F.count("*").alias("conflated_count"), F.sum("way_length").alias("conflated_length"), F.max("way_length").alias("conflated_max_length"))
    cover = covered_by_partners(con, options.buffer, "street_id")
    error = hausdorff(con, "street_id", "osm_id").withColumnRenamed("hausdorff", "max_error")
    base = streets.select("street_id", "street_code", "muni_id", "settl_id", "street_name", "proper_name", T.is_hamlet("street_code").alias("is_hamlet"),
                          G.length("lines").alias("street_length"))
    out = base.join(sums, "street_id", "left").join(cover, "street_id", "left").join(error, "street_id", "left")
    return out.fillna(0, ["conflated_count"]).fillna(0.0, ["conflated_length", "covered"])


def street_report(summary: DataFrame, found: DataFrame) -> DataFrame:
    """A5: per-street metrics of found ways next to the register side."""
    run = F.col("share") * F.col("way_length")
    f = found.groupBy("street_id").agg(F.count("*").alias("found_count"), F.sum("way_length").alias("found_length"), F.max("share").alias("found_max_share"),
                                       F.sum(run).alias("found_run_sum"), F.max(run).alias("found_run_max"))
    uncovered = F.greatest(F.bround("street_length") - F.bround("covered"), F.lit(0.0))
    return summary.join(f, "street_id", "left").fillna(0, ["found_count"]).fillna(0.0, ["found_length", "found_run_sum", "found_run_max"]).withColumn("uncovered", uncovered)


def street_progress(report: DataFrame) -> DataFrame:
    """A3 + A4: counts and lengths per settlement, municipality and country, hamlets left out."""
    con = F.col("conflated_count") > 0
    g = (report.where(~F.col("is_hamlet")).groupingSets([["muni_id", "settl_id"], ["muni_id"], []], "muni_id", "settl_id").agg(
        F.count("*").alias("streets"), F.sum("street_length").alias("length"), F.sum("conflated_length").alias("conflated_length"),
        F.sum("covered").alias("covered_length"), F.sum("found_length").alias("found_length"), F.count_if(con).alias("conflated"),
        F.count_if(~con & (F.col("found_count") > 0)).alias("found"), F.grouping_id().alias("level")))
    return g.withColumns({
        "notfound": F.col("streets") - F.col("conflated") - F.col("found"),
        "notfound_length": F.greatest(F.col("length") - F.col("conflated_length") - F.col("found_length"), F.lit(0.0)),
        "ratio": F.coalesce(F.least(F.try_divide(100.0 * F.col("covered_length"), F.col("length")), F.lit(100.0)), F.lit(0.0))})


def settlement_totals(report: DataFrame) -> DataFrame:
    """Totals of per-street rounded metres per settlement, hamlets left out."""
    def total(c: str) -> Column:
        return F.bround(F.sum(F.bround(F.coalesce(c, F.lit(0.0))))).alias(c)
    return report.where(~F.col("is_hamlet")).groupBy("settl_id").agg(total("street_length"), total("covered"), total("uncovered"),
                                                                      F.bround(F.round(F.sum("conflated_length"), 2)).alias("conflated_length"), total("max_error"))


def name_mismatch(found: DataFrame, ways: DataFrame) -> DataFrame:
    """Q10: per street the found ways whose name is neither the street's name nor its spelling; squares are exempt."""
    wrong = found.where(F.col("name").isNotNull() & (F.col("name") != "") & ~F.col("name_match") & ~F.col("norm_match"))
    squares = ways.where(F.col("place") == "square").select("osm_id")
    return wrong.join(squares, "osm_id", "left_anti").groupBy("street_id").agg(
        F.sum("way_length").alias("total_length"), F.sum(F.col("share") * F.col("way_length")).alias("average_length"), F.count("*").alias("wrong_count"))


def missing_geometry(report: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Q11: metres to draw, or metres found and only to conflate, for streets that have a conflated way."""
    lim = options.min_missing
    missing = F.least(F.col("street_length") - F.col("covered"), F.col("max_error"))
    found_sum, found_max = F.least(F.col("found_run_sum"), F.col("max_error")), F.least(F.col("found_run_max"), F.col("max_error"))
    draw = F.when((missing > lim) & (found_max <= lim), missing).otherwise(0.0)
    conflate = F.when(found_max > lim, found_sum).otherwise(0.0)
    return report.where("conflated_count > 0").withColumns({"need_drawing": draw, "need_conflating": conflate}).where("need_drawing > 0 OR need_conflating > 0")


def missing_per_muni(q11: DataFrame, munis: DataFrame | None = None) -> DataFrame:
    """Per municipality, streets that need drawing first, the others need conflating; hamlets left out. With ``munis`` zeros for those without any."""
    draw = F.col("need_drawing") > 0

    def of(cond: Column, c: str) -> Column:
        return F.sum(F.when(cond, F.col(c)).otherwise(0.0))
    counts = q11.where(~F.col("is_hamlet")).groupBy("muni_id").agg(
        F.count_if(draw).alias("drawing_count"), of(draw, "need_drawing").alias("drawing_length"), F.count_if(~draw).alias("conflating_count"),
        of(~draw, "need_conflating").alias("conflating_length"), of(draw, "conflated_length").alias("drawing_conflated"), of(~draw, "conflated_length").alias("conflating_conflated"))
    return counts if munis is None else with_zero_rows(counts, munis, "muni_id")


def mismatch_per_muni(q10: DataFrame, summary: DataFrame, munis: DataFrame | None = None) -> DataFrame:
    """Mismatching ways and metres per municipality, hamlets left out. With ``munis`` zeros for those without any."""
    s = summary.where(~F.col("is_hamlet")).select("street_id", "muni_id")
    counts = q10.join(s, "street_id").groupBy("muni_id").agg(F.sum("wrong_count").alias("ways"), F.sum("total_length").alias("length"))
    return counts if munis is None else with_zero_rows(counts, munis, "muni_id")


def top_streets(df: DataFrame, by: str, n: int = 100) -> DataFrame:
    """The ``n`` longest, hamlets removed after the cut."""
    return df.orderBy(F.desc(by), F.asc("street_id")).limit(n).where(~F.col("is_hamlet"))


def ring_streets(streets: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Streets that close on themselves; ``exceptions(street_code, is_ring)`` overrule the test."""
    r = streets.select("street_code", is_ring("lines", limit=None).alias("ring"))
    if exceptions is None:
        return r
    return r.join(exceptions, "street_code", "left").select("street_code", F.coalesce("is_ring", "ring").alias("ring"))


def wrong_names(named: DataFrame) -> DataFrame:
    """Q7: map streets with any name problem. ``named``: ``osm_id, muni_id, proper, name, name_sr, name_sr_latn, name_en, int_name``."""
    p, n = F.col("proper"), F.col("name")
    flags = {
        "wrong_name": N.wrong_name(p, n), "missing_name": N.missing_name(p, n), "wrong_name_sr": N.wrong_name_sr(p, n, F.col("name_sr")),
        "missing_name_sr": N.missing_name_sr(n, F.col("name_sr")), "wrong_name_sr_latn": N.wrong_name_sr_latn(p, n, F.col("name_sr_latn")),
        "missing_name_sr_latn": N.missing_name_sr_latn(n, F.col("name_sr_latn")), "suspicious_name_en": N.suspicious_name_en(n, F.col("name_en")),
        "unneeded_name_en": N.unneeded_name_en(n, F.col("name_en")), "wrong_int_name": N.wrong_int_name(p, n, F.col("int_name")),
        "missing_int_name": N.missing_int_name(p, n, F.col("int_name")),
    }
    shown = [f for f in flags if f != "suspicious_name_en"]
    return named.withColumns(flags).where(" OR ".join(shown))


def named_by_register(ways: DataFrame, streets: DataFrame, mapping: DataFrame, overrides: DataFrame, munis: DataFrame, excluded: list[int] | None = None) -> DataFrame:
    """Map streets outside the excluded districts with the register's name of their street code, ``proper`` as the mapping spells it.

    ``proper`` is null where the way has no known code and ``''`` where the mapping lacks the name. ``munis`` has ``muni_id, district``.
    """
    here = munis.where(~F.col("district").isin(EXCLUDED_DISTRICTS if excluded is None else excluded)).select("muni_id")
    named = streets.groupBy("street_code").agg(F.min("street_name").alias("street_name"))
    j = skew_join(ways.join(here, "muni_id", "left_semi").withColumn("street_code", F.col("street_ref")), named, ["street_code"], "left")
    known = F.col("street_name").isNotNull() & (F.col("street_name") != "")
    return lookup_name(j, mapping, overrides, F.lit(""), "_mapped_name").withColumn("proper", F.when(known, F.col("_mapped_name"))).drop("_mapped_name")


def suggested_names(df: DataFrame) -> DataFrame:
    """Suggestions from the register name, else the map name, else a question mark."""
    ref = F.coalesce(F.nullif("proper", F.lit("")), F.nullif("name", F.lit("")))
    return df.withColumns({"suggest_sr": F.coalesce(ref, F.lit("?")), "suggest_sr_latn": F.coalesce(T.cyr2lat_small(ref), F.lit("?")),
                           "suggest_int_name": F.coalesce(T.cyr2intname(ref), F.lit("?"))})


def wrong_alt_names(named: DataFrame) -> DataFrame:
    """Q8: alternative names checked in three spellings; rows with a missing or wrong plain one."""
    p = F.col("proper")
    d = N.check_alt_names(named, p, F.col("name"), F.col("alt_name"), prefix="alt_").where("alt_missing OR alt_wrong")  # the others are checked where this one asks
    d = N.check_alt_names(d, p, F.col("name_sr"), F.col("alt_name_sr"), prefix="alt_sr_")
    return N.check_alt_names(d, T.cyr2lat_small(p), F.col("name_sr_latn"), F.col("alt_name_sr_latn"), latin=True, prefix="alt_latn_")


def name_counts(q7: DataFrame, munis: DataFrame, flags: list[str]) -> DataFrame:
    """Problem counts per municipality, with a zero row for those without any."""
    counts = q7.groupBy("muni_id").agg(*[F.count_if(F.col(f)).alias(f) for f in flags])
    return munis.select("muni_id").join(counts, "muni_id", "left").fillna(0, flags)
