"""Equi joins whose keys may be very uneven.

Keys that hold more rows (or, with repeats on both sides, can give more pairs) than one task should see are found by a pre-aggregated count. Only then are both sides of such a
key cut into blocks: a row stays in one block of its own side and is repeated over the blocks of the other side, so every
pair meets exactly once and no row is dropped. The count reads the inputs once more, so this is for stored or cheaply derived tables; joins of
costly results to a unique side are plain joins, whose uneven partitions adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 500_000
PAIR_ROWS = 10_000  #: rows of a side that one task sees where both sides repeat a key: at most PAIR_ROWS ** 2 pairs of a key meet in a task
_BROADCAST_KEYS = 10_000


def _hot(left: DataFrame, right: DataFrame | None, on: list[str], rows: int) -> tuple[DataFrame, int]:
    """Keys with more than ``rows`` rows on a side and the blocks each side of them needs; ``right=None`` says the right side is unique.

    Each side is counted once, with map-side sums; all but the hot keys are filtered out before anything leaves the counting tasks.
    """
    def heavy(df: DataFrame, blocks: str, other: str) -> DataFrame:
        n = df.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > rows)
        return n.select(*on, F.ceil(F.col("_n") / rows).cast("int").alias(blocks), F.lit(1).alias(other)).select(*on, "_sl", "_sr")
    hot = heavy(left, "_sl", "_sr")
    if right is not None:
        hot = hot.unionByName(heavy(right, "_sr", "_sl"))
    found = hot.limit(_BROADCAST_KEYS + 1).collect()  # at most 10,001 key rows
    if found and right is not None:
        hot = hot.groupBy(*on).agg(F.max("_sl").alias("_sl"), F.max("_sr").alias("_sr"))
        found = hot.limit(_BROADCAST_KEYS + 1).collect() if len(found) <= _BROADCAST_KEYS else found
    if len(found) <= _BROADCAST_KEYS:
        return left.sparkSession.createDataFrame(found, hot.schema), len(found)
    return hot, len(found)


def _not_null(on: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])


def split_hot(left: DataFrame, right: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK,
              unique_right: bool = False, count_right: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides, ready for a join on the returned keys, with the rows of hot keys spread over blocks.

    Where both sides repeat keys, blocks are small enough to bound the pairs of a key in a task, not only its rows. ``count_right`` may name
    rows that are cheaper to count than ``right`` and at least as many per key.
    """
    rows_per_task = rows_per_task if unique_right else min(rows_per_task, PAIR_ROWS)
    counted = right if count_right is None else count_right
    hot, n = _hot(left.where(_not_null(on)), None if unique_right else counted.where(_not_null(on)), on, rows_per_task)
    if n == 0:
        return left, right, on
    if n <= _BROADCAST_KEYS:
        hot = F.broadcast(hot)  # n was counted just above

    def spread(df: DataFrame, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        cols = df.columns
        return (df.join(hot, on, "left")
                .withColumn(own_block, F.pmod(F.xxhash64(*[F.col(c) for c in cols if not _is_map(df, c)]), F.coalesce(own, F.lit(1))).cast("int"))
                .withColumn(other_block, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
                .select(*cols, own_block, other_block))

    return (spread(left, "_sl", "_sr", "_bl", "_br"), spread(right, "_sr", "_sl", "_br", "_bl"), on + ["_bl", "_br"])


def by_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash-partition by ``keys`` into ``spark.sql.shuffle.partitions`` tasks.

    A named count keeps adaptive execution from merging partitions that are small in bytes but heavy in candidate pairs.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _is_map(df: DataFrame, c: str) -> bool:
    return "map<" in df.schema[c].dataType.simpleString()


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Inner or left join of rows with uneven keys to a side that is unique on ``on``. Count and join both read ``left``: keep it cheap to derive."""
    if how not in ("inner", "left"):
        raise ValueError("skew_join does inner and left joins")
    l2, r2, keys = split_hot(left, right, on, rows_per_task, unique_right=True)
    return l2.join(r2, keys, how).drop("_bl", "_br")
