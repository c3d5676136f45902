"""Connected components of an edge table, without gathering edges anywhere.

Each round hangs every node on the smallest label among itself and its neighbours and then halves the paths to that label,
so the number of rounds grows with the logarithm of the longest chain. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstrata.session import materialize

# A label may hang over very many nodes: rows that look one up are dealt over so many copies of it.
COPIES = 16


def _looked_up(rows: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined with ``table`` where ``column`` equals its ``key``, a frequent value in many places."""
    spread = rows.withColumn("_copy", F.pmod(F.xxhash64("node"), F.lit(COPIES)))
    copies = table.withColumn("_of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COPIES - 1).cast("long"))))
    return spread.join(copies, (F.col(column) == F.col(key)) & (F.col("_copy") == F.col("_of")), "left")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``(a, b)`` edges; a component is named by its smallest node."""
    both = edges.select("a", "b").where(F.col("a") != F.col("b"))
    both = materialize(both.union(both.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        of_neighbour = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        least = both.join(of_neighbour, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        hung = labels.join(least, "node").select("node", F.least("component", "near").alias("up"), F.col("component").alias("was"))
        # The old label learns the smaller one too, so that whole trees move at once.
        moved = hung.where(F.col("up") < F.col("was")).groupBy(F.col("was").alias("root")).agg(F.min("up").alias("lower"))
        hung = _looked_up(hung, "was", moved, "root").select("node", F.least("up", "lower").alias("up"), "was")
        # Only nodes that have a label other than themselves are worth looking up.
        above = labels.where(F.col("node") != F.col("component")).select(F.col("node").alias("top"), F.col("component").alias("jump"))
        jumped = _looked_up(hung, "up", above, "top")
        new = materialize(jumped.select("node", F.least("up", "jump").alias("component"), "was"), "labels")
        changed = new.where(F.col("component") != F.col("was")).limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
