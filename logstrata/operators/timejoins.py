"""Joins over time: points in intervals, and rows with the version that is valid at their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logstrata.operators.timeline import BLOCK_ROWS, axis, cut, free_names, with_time_block
from logstrata.session import materialize

# Points that may meet in one cell before it is split.
CELL_POINTS = 1_000_000


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, on: Sequence[str] = (), cell_points: int = CELL_POINTS) -> DataFrame:
    """Every point with every interval that holds it: ``start <= at < end`` and equal ``on`` columns.

    An interval of any length is covered by at most nine dyadic cells, of an eighth to a quarter of its length; a point lies
    in one cell of each length in use, 63 at most. So both meet by equality, each pair in one cell only, and the times are
    compared within it. A cell with more than ``cell_points`` points is split by a hash of the point; its intervals go to
    every part. (Points that agree in all columns stay together.)

    Null times or ``on`` values match nothing, nor do intervals that end at or before their start. Points and intervals that
    repeat match each time. The columns of both sides are returned, ``on`` once; other common names are an error.
    """
    on = list(on)
    free_names([c for c in points.columns if c not in on], [c for c in intervals.columns if c not in on])
    spans = intervals.withColumns({"_start": axis(intervals, start), "_end": axis(intervals, end)}).where(F.col("_end") > F.col("_start"))
    # In decimals: an interval may be longer than a BIGINT holds.
    length = F.col("_end").cast("decimal(20,0)") - F.col("_start")
    level = F.greatest(F.ceil(F.log2(length + F.lit(1))).cast("int") - 3, F.lit(0))
    spans = materialize(spans.withColumn("_level", level), "spans")
    cells = spans.withColumn("_cell", F.explode(F.expr("sequence(shiftright(_start, _level), shiftright(_end - 1, _level))")))
    levels = sorted(r["_level"] for r in spans.select("_level").distinct().collect())  # 64 at most
    # Written once: the points are counted by cell and joined.
    timed = materialize(points.withColumn("_at", axis(points, at)).where(F.col("_at").isNotNull()), "points")
    placed = timed.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    placed = placed.withColumn("_cell", F.expr("shiftright(_at, _level)"))
    place = [*on, "_level", "_cell"]
    crowds = placed.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cell_points)
    crowds = crowds.join(cells.select(*place).distinct(), place, "left_semi")
    crowds = materialize(crowds.select(*place, F.ceil(F.col("_n") / cell_points).cast("int").alias("_parts")), "crowds")
    if crowds.limit(1).count():
        own = [f.name for f in points.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
        parts = F.coalesce("_parts", F.lit(1))
        placed = placed.join(crowds, place, "left").withColumn("_part", F.pmod(F.xxhash64(*own), parts).cast("int")).drop("_parts")
        cells = cells.join(crowds, place, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
        place = [*place, "_part"]
    met = placed.join(cells, place).where((F.col("_start") <= F.col("_at")) & (F.col("_at") < F.col("_end")))
    return met.select(*points.columns, *[c for c in intervals.columns if c not in on])


def asof_join(
    rows: DataFrame,
    versions: DataFrame,
    at: str,
    since: str,
    on: Sequence[str],
    inclusive: bool = True,
    within: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``rows`` with the columns of the latest version of their ``on`` key: the greatest ``since`` up to ``at``.

    Keys with many rows are cut into time blocks. A block's last version is its summary; a running last over the summaries of
    a key, one narrow row a block, carries a version into the blocks after it. Rows are ordered inside their block only.

    With ``inclusive`` false a version counts from the instant after ``since`` on; ``within`` drops versions that are older
    than so many units at ``at``. Of versions at the same instant the greatest counts, in the order of its columns. Every
    row is returned once, with nulls where there is no version: before the first, or with a null time or key. Versions with
    a null time or key are never valid. Names that both sides have outside ``on`` are an error.
    """
    on = list(on)
    carried = [c for c in versions.columns if c not in on]
    free_names([c for c in rows.columns if c not in on], carried)
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    # Written once: the rows are counted by key, cut into blocks and joined.
    timed = materialize(rows.withColumn("_at", axis(rows, at)), "timed")
    placeable = known & F.col("_at").isNotNull()
    blocked, busy = with_time_block(timed.where(placeable), on, "_at", block_rows)
    dated = versions.select(*on, axis(versions, since).alias("_at"), F.struct(*carried).alias("_version")).where(placeable)
    dated = cut(dated, busy, on, "_at")

    last = dated.groupBy(*on, "_block").agg(F.max(F.struct("_at", "_version")).alias("_last"))
    steps = blocked.select(*on, "_block").distinct().withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType))
    steps = steps.unionByName(last).groupBy(*on, "_block").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*on).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier)).where(F.col("_carry").isNotNull())
    carry = steps.select(*on, F.col("_carry._at").alias("_at"), F.col("_carry._version").alias("_version"), "_block")

    body = F.struct(*rows.columns)
    asked = blocked.select(*on, "_at", "_block", F.lit(1).alias("_side"), body.alias("_row"))
    offered = dated.unionByName(carry).withColumn("_side", F.lit(0 if inclusive else 2))
    both = asked.unionByName(offered, allowMissingColumns=True)
    order = Window.partitionBy(*on, "_block").orderBy("_at", "_side", "_version").rowsBetween(Window.unboundedPreceding, 0)
    found = F.when(F.col("_side") != 1, F.struct(F.col("_at").alias("_since"), F.col("_version")))
    seen = both.withColumn("_found", F.last(found, ignorenulls=True).over(order)).where(F.col("_side") == 1)
    valid = F.col("_found").isNotNull()
    if within is not None:
        valid = valid & (F.col("_at") - F.col("_found._since") <= within)
    out = seen.select("_row.*", *[F.when(valid, F.col(f"_found._version.{c}")).alias(c) for c in carried])
    rest = timed.where(~F.coalesce(placeable, F.lit(False))).select(*rows.columns)
    return out.unionByName(rest, allowMissingColumns=True)
