"""Snapshot comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.functions import geometry as G
from addrweave.operators.lines import hausdorff
from addrweave.operators.ranking import keep_first
from addrweave.operators.skew import split_hot
from addrweave.session import stable


def added(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows only in the new snapshot."""
    return new.join(old.select(key), key, "left_anti")


def removed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows only in the old snapshot."""
    return old.join(new.select(key), key, "left_anti")


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _paired(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    o = old.select(key, F.col("muni_id").alias("_om"), F.col("muni_name").alias("_on"), *[F.col(c).alias(f"{c}_old") for c in cols])
    n = new.select(key, "muni_id", "muni_name", *[F.col(c).alias(f"{c}_new") for c in cols])
    return n.join(o, key)


def _same_muni() -> Column:
    return F.col("muni_id").eqNullSafe(F.col("_om")) & F.col("muni_name").eqNullSafe(F.col("_on"))


def _flags(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_changed": ~F.col(f"{c}_old").eqNullSafe(F.col(f"{c}_new")) for c in cols})


def moved_to_other_muni(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows whose municipality changed; they are set aside for a person."""
    p = _paired(old, new, key, [])
    return p.where(~_same_muni()).select(key, F.col("_om").alias("muni_id_old"), F.col("muni_id").alias("muni_id_new"))


def changed_addresses(old: DataFrame, new: DataFrame) -> DataFrame:
    """Same id, other settlement, street, number or place (whole metres, half to even)."""
    cols = ["settl_id", "street_id", "street_name", "house_no"] + ["settl_name"] * ("settl_name" in old.columns and "settl_name" in new.columns)
    p = _paired(old, new, "addr_id", cols + ["x", "y"]).where(_same_muni())
    metres = F.bround(G.distance(F.col("x_old"), F.col("y_old"), F.col("x_new"), F.col("y_new"))).cast("long")
    out = _flags(p, cols).withColumn("moved_metres", metres)
    return out.where(_any([F.col(f"{c}_changed") for c in cols] + [F.col("moved_metres") > 0])).drop("_om", "_on", "x_old", "y_old", "x_new", "y_new")


def diff_addresses(old: DataFrame, new: DataFrame) -> DataFrame:
    """Q13 as one table: ``change_type`` added, removed, muni_changed or changed with old and new values. One full outer join by id.

    A value that appears or goes counts as changed. Names of municipality and settlement are compared where both snapshots have them.
    """
    cols = [c for c in ("muni_id", "muni_name", "settl_id", "settl_name", "street_id", "street_name", "house_no", "x", "y") if c in old.columns and c in new.columns]
    o = old.select("addr_id", F.lit(True).alias("_o"), *[F.col(c).alias(f"{c}_old") for c in cols])
    n = new.select("addr_id", F.lit(True).alias("_n"), *[F.col(c).alias(f"{c}_new") for c in cols])
    j = o.join(n, "addr_id", "full")
    metres = F.bround(G.distance(F.col("x_old"), F.col("y_old"), F.col("x_new"), F.col("y_new"))).cast("long")
    def other(c: str) -> Column:
        return ~F.col(f"{c}_old").eqNullSafe(F.col(f"{c}_new"))
    differs = _any([other(c) for c in cols if c not in ("muni_id", "muni_name", "x", "y")] + [F.coalesce(metres > 0, F.lit(False))])
    muni = _any([other(c) for c in cols if c in ("muni_id", "muni_name")])
    kind = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(muni, "muni_changed").when(differs, "changed")
    return j.withColumns({"change_type": kind, "moved_metres": metres}).where(F.col("change_type").isNotNull()).drop("_o", "_n")


def diff_streets(old: DataFrame, new: DataFrame) -> DataFrame:
    """Q14: same street code, other settlement, name or course (Hausdorff distance in whole metres)."""
    cols = ["settl_id", "street_name"]
    p = _paired(old, new, "street_code", cols).where(_same_muni())
    both = old.select("street_code", "lines").join(new.select("street_code", F.col("lines").alias("other_lines"), F.lit(0).alias("_one")), "street_code")
    far = hausdorff(stable(both), "street_code", "_one")
    out = _flags(p, cols).join(far, "street_code", "left").withColumn("moved_metres", F.bround("hausdorff").cast("long"))
    return out.where(_any([F.col(f"{c}_changed") for c in cols] + [F.col("moved_metres") > 0])).drop("_om", "_on", "hausdorff")


def reissued(gone: DataFrame, come: DataFrame, reach: float = 100.0) -> DataFrame:
    """A removed address and the nearest added one with the same street and number, under ``reach`` metres apart."""
    g = gone.select(F.col("addr_id").alias("old_id"), "street_name", "house_no", F.col("x").alias("ox"), F.col("y").alias("oy"), F.floor(F.col("x") / reach).alias("_gx"), F.floor(F.col("y") / reach).alias("_gy"))
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    g = g.withColumn("_gx", F.explode(F.transform(near, lambda d: F.col("_gx") + d))).withColumn("_gy", F.explode(F.transform(near, lambda d: F.col("_gy") + d)))
    c = come.select(F.col("addr_id").alias("new_id"), "street_name", "house_no", F.col("x").alias("nx"), F.col("y").alias("ny"), F.floor(F.col("x") / reach).alias("_gx"), F.floor(F.col("y") / reach).alias("_gy"))
    l2, r2, keys = split_hot(g, c, ["street_name", "house_no", "_gx", "_gy"])
    d = l2.join(r2, keys).withColumn("distance", G.distance(F.col("ox"), F.col("oy"), F.col("nx"), F.col("ny"))).where(F.col("distance") < reach)
    return keep_first(d.select("old_id", "new_id", "distance"), ["old_id"], [F.asc("distance"), F.asc("new_id")])
