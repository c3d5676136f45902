"""What differs between two runs of a corpus, read from the blocks that differ alone.

A run is stored in blocks by a hash of the record, so an inserted record moves no other. Every block has an order-free
fingerprint of its multiset of records: their number and the sums of two 64-bit hashes, exact integers that add up. Sums of
blocks give the fingerprints of the nodes above, sixteen children to a node. Comparing two runs starts at the top and goes down
into differing nodes only; the blocks at the bottom are the ones whose records are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Levels of the tree below its root: 16 to the power of this many blocks.
LEVELS = 2
FAN_BITS = 4
MASK = ["n", "h1", "h2"]


def _hash(columns: Sequence[str], seed: int) -> Column:
    # Each value with its nullness: a null is not an empty text, and the borders of columns count.
    parts = [p for c in columns for p in (F.lit(seed), F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*parts)


def block_of(columns: Sequence[str], levels: int = LEVELS) -> Column:
    return F.pmod(_hash(columns, 1), F.lit(1 << FAN_BITS * levels)).cast("int")


def fingerprints(records: DataFrame, columns: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """``(level, node, n, h1, h2)`` of every node with a record, level 0 being the root.

    Records are summed in their tasks to one row a block; all levels come from those. Sums are decimals, so none wraps.
    """
    own = records.select(
        block_of(columns, levels).alias("block"), *[_hash(columns, s).cast("decimal(38,0)").alias(f"h{s - 1}") for s in (2, 3)]
    )
    blocks = own.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    ancestors = [F.struct(F.lit(i).alias("level"), F.shiftright("block", FAN_BITS * (levels - i)).alias("node")) for i in range(levels + 1)]
    nodes = blocks.select("n", "h1", "h2", F.inline(F.array(*ancestors)))
    return nodes.groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in MASK])


def write_run(records: DataFrame, columns: Sequence[str], path: str, levels: int = LEVELS) -> None:
    """Store a run: its records below ``records/block=…`` and then its fingerprints, which make it complete."""
    blocked = records.select(*columns, block_of(columns, levels).alias("block"))
    blocked.limit(0).write.parquet(f"{path}/columns")  # an empty run has no block to tell them
    blocked.repartition("block").write.partitionBy("block").parquet(f"{path}/records")
    stored = records.sparkSession.read.schema(blocked.schema).parquet(f"{path}/records")
    fingerprints(stored, columns, levels).write.parquet(f"{path}/fingerprints")


def changed_blocks(left: DataFrame, right: DataFrame, levels: int = LEVELS) -> list[int]:
    """The blocks whose multisets differ, by descent: on each level only children of differing nodes are compared."""
    differing = [0]
    for level in range(levels + 1):
        within = (F.col("level") == level) & F.shiftright("node", FAN_BITS).isin(differing)
        within = F.col("level") == 0 if level == 0 else within
        a, b = left.where(within).alias("a"), right.where(within).alias("b")
        same = F.lit(True)
        for c in MASK:
            same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        met = a.join(b, F.col("a.node") == F.col("b.node"), "full").where(~same)
        # Sixteen nodes for each differing parent; 16 ** levels in all.
        differing = sorted(r[0] for r in met.select(F.coalesce("a.node", "b.node")).collect())
        if not differing:
            return []
    return differing


def corpus_diff(spark: SparkSession, left: str, right: str, columns: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """``(columns, n_left, n_right)`` of every record whose number differs between two stored runs.

    Multiplicities count, order doesn't, null equals null. Both runs were stored with the same columns and levels. Blocks with
    equal fingerprints are not read: two multisets that differ there would have to agree in their number and in the sums
    of two independent 64-bit hashes.
    """
    columns = list(columns)
    blocks = changed_blocks(*[spark.read.parquet(f"{p}/fingerprints") for p in (left, right)], levels)
    sides = []
    for path, mine, other in ((left, "n_left", "n_right"), (right, "n_right", "n_left")):
        held = spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/records")
        stored = held.where(F.col("block").isin(blocks) if blocks else F.lit(False))
        counted = stored.groupBy(*columns, "block").agg(F.count(F.lit(1)).alias(mine))
        sides.append(counted.withColumn(other, F.lit(0).cast("bigint")))
    both = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    return both.where(F.col("n_left") != F.col("n_right"))
