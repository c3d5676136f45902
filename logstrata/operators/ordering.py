"""Running totals over a total order, with no task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstrata.session import materialize

# Number of range boundaries. It bounds the one table that is broadcast and the
# one window that is not partitioned; every row is kept whatever its value.
BOUNDARIES = 255


def ordered_prefix(df: DataFrame, key: list[str], amount: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all rows whose ``key`` is smaller.

    ``key`` must be unique, and ``df`` narrow: it is written once and read by each
    of the steps below. Boundaries are the keys with the smallest hashes, an
    even and repeatable choice, so recomputed tasks always see the same ranges.
    Each range is summed, the few range sums are accumulated and every range
    continues from its own start.
    """
    keyed = materialize(df, "ordered").withColumn("_key", F.struct(*key)).withColumn("_amount", amount.cast("bigint"))
    bounds = (
        keyed.select("_key")
        .orderBy(F.xxhash64("_key"))
        .limit(BOUNDARIES)
        .agg(F.sort_array(F.collect_list("_key")).alias("bounds"))
    )
    ranged = (
        keyed.withColumn("_bounds", bounds.scalar())
        .withColumn("_range", F.size(F.filter("_bounds", lambda b: b <= F.col("_key"))))
        .drop("_bounds")
    )
    sums = ranged.groupBy("_range").agg(F.sum("_amount").alias("_sum"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
        .drop("_key", "_amount", "_range", "_start")
    )


def block_prefix(blocks: DataFrame, keys: list[str], block: str, amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` over the earlier blocks of the same file: one narrow row per block."""
    w = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn(name, F.coalesce(F.sum(amount).over(w), F.lit(0)))
