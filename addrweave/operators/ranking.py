"""Keep-one, flag and numbering operators.

``row_number() = 1`` filters are planned by Spark with a group limit before the shuffle, so a hot group sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrweave.operators.skew import skew_join
from addrweave.session import stable


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_top(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per key with their rank."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def with_group_counts(df: DataFrame, keys: list[str], **counts: Column) -> DataFrame:
    """Per-group sums of boolean columns put back on every row (aggregate, then a skew-safe join; null keys count as none)."""
    aggs = [F.sum(c.cast("long")).alias(name) for name, c in counts.items()]
    grouped = df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys).agg(*aggs)
    return skew_join(df, grouped, keys, "left").fillna(0, list(counts))


def flag_duplicates(df: DataFrame, key: str, order: list[Column], blank: str = "") -> DataFrame:
    """``is_duplicate`` on every row of a repeated key and ``is_repeat`` on all but its first; blank keys are exempt."""
    named = df.where(F.col(key).isNotNull() & (F.col(key) != blank))
    first = keep_first(named, [key], order).select(F.col(key), F.struct(*[c for c in df.columns if c != key]).alias("_first"))
    many = named.groupBy(key).agg(F.count("*").alias("_n"))
    out = skew_join(df, first.join(many, key), [key], "left")
    me = F.struct(*[c for c in df.columns if c != key])
    return (out.withColumn("is_duplicate", F.coalesce(F.col("_n") > 1, F.lit(False)))
            .withColumn("is_repeat", F.coalesce((F.col("_n") > 1) & (me != F.col("_first")), F.lit(False))).drop("_first", "_n"))


def row_numbers(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "row_no") -> DataFrame:
    """Number rows from 1 within ``keys``, for groups of any size.

    Rows are range-partitioned by keys and order, so one large group spans many tasks; each task numbers its own rows and adds the
    counts of the group's earlier tasks. The partitioned rows are checkpointed first: both readers must see the same ranges.
    """
    cols = {f"_o{i}": (F.col(o) if isinstance(o, str) else o) for i, o in enumerate(order)}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.withColumns(cols).repartitionByRange(parts, *keys, *cols).withColumn("_p", F.spark_partition_id()))
    ranged = stable(ranged)
    w = Window.partitionBy(*keys, "_p")
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*keys, "_p").agg(F.count("*").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))  # one row per group and task
    local = ranged.withColumn("_rn", F.row_number().over(w.orderBy(*cols)))
    cond = [local[k].eqNullSafe(offsets[k]) for k in [*keys, "_p"]]
    joined = local.join(offsets, cond, "left")
    return joined.select(*[local[c] for c in df.columns], (local["_rn"] + offsets["_before"]).alias(name))


def batch_numbers(df: DataFrame, keys: list[str], order: list[str | Column], size: int, name: str = "batch_no") -> DataFrame:
    """Batches of ``size`` rows in sort order, numbered from 0 within ``keys``."""
    return row_numbers(df, keys, order, "_no").withColumn(name, F.floor((F.col("_no") - 1) / size)).drop("_no")


def group_order(df: DataFrame, keys: list[str], value: str, order: Column, name: str = "order_no") -> DataFrame:
    """Zero-padded place of each distinct ``value`` within ``keys``, put back on the rows."""
    distinct = df.select(*keys, value).distinct()
    ranked = row_numbers(distinct, keys, [order, value], "_no")
    widths = distinct.groupBy(*keys).agg(F.length(F.count("*").cast("string")).alias("_w"))
    ranked = ranked.join(widths, keys).select(*keys, value, F.lpad(F.col("_no").cast("string"), F.col("_w"), "0").alias(name))
    return df.join(ranked, [*keys, value], "left")  # ranked is unique; df may be costly to derive, so it is not counted first
