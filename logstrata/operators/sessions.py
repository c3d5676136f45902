"""Sessions and sliding windows over time, folded from blocks and panes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstrata.operators.timeline import BLOCK_ROWS, axis, with_time_block
from logstrata.session import materialize


def _all_known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known


def sessions(rows: DataFrame, on: Sequence[str], at: str, gap: int, sums: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(on, session, start, end, rows, sum_<column>…)``: runs of a key's rows with steps of at most ``gap`` between them.

    Every block of a key yields its pieces of sessions: the first may be open to the left, the last to the right, all between
    are closed. Folding them in order needs each block's first and last time and its number of pieces alone, one narrow row
    a block; pieces that touch across blocks get the same number and are summed. So the result doesn't depend on the cut,
    and neither a busy key nor an endless session is ordered by one task.

    ``session`` counts from 0 within a key. Times are those of the axis: microseconds for a timestamp. Rows with a null key or
    time belong to no session. Null values count as nothing in a sum, which is null if all are.
    """
    on = list(on)
    # Written once: the rows are counted by key and put in order.
    timed = materialize(rows.select(*on, axis(rows, at).alias("_at"), *sums).where(_all_known([*on, "_at"])), "timed")
    blocked, _ = with_time_block(timed, on, "_at", block_rows)
    order = Window.partitionBy(*on, "_block").orderBy("_at")
    opens = (F.col("_at").cast("decimal(20,0)") - F.lag("_at").over(order) > gap).cast("bigint")
    marked = blocked.withColumn("_opens", F.coalesce(opens, F.lit(0).cast("bigint")))
    pieced = marked.withColumn("_piece", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = pieced.groupBy(*on, "_block", "_piece").agg(
        F.min("_at").alias("_start"), F.max("_at").alias("_end"), F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(f"sum_{c}") for c in sums]
    )
    blocks = pieces.groupBy(*on, "_block").agg(F.min("_start").alias("_first"), F.max("_end").alias("_last"), F.count(F.lit(1)).alias("_pieces"))
    key = Window.partitionBy(*on).orderBy("_block")
    touches = (F.col("_first").cast("decimal(20,0)") - F.lag("_last").over(key) <= gap).cast("bigint")
    blocks = blocks.withColumn("_joined", F.coalesce(touches, F.lit(0).cast("bigint")))
    # A block whose first piece continues the session before it adds one session less.
    before = F.coalesce(F.sum(F.col("_pieces")).over(key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = before - F.sum("_joined").over(key.rowsBetween(Window.unboundedPreceding, 0))
    blocks = blocks.select(*on, "_block", first.alias("_session"))
    numbered = pieces.join(blocks, [*on, "_block"]).withColumn("session", F.col("_session") + F.col("_piece"))
    return numbered.groupBy(*on, "session").agg(
        F.min("_start").alias("start"), F.max("_end").alias("end"), F.sum("rows").alias("rows"), *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in sums]
    )


def panes(rows: DataFrame, on: Sequence[str], at: str, width: int, value: str) -> DataFrame:
    """``(on, pane, rows, sum, least, most)``: partial aggregates of the panes of ``width`` units, ``pane`` counted from 0.

    The summaries add up: those of two sets of rows, grouped again, are that of both. Rows with a null time are in no pane.
    """
    timed = rows.select(*on, axis(rows, at).alias("_at"), F.col(value).alias("_value")).where("_at is not null")
    pane = F.expr(f"(_at - pmod(_at, {width}L)) div {width}L")
    return timed.groupBy(*on, pane.alias("pane")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_value").alias("sum"), F.min("_value").alias("least"), F.max("_value").alias("most")
    )


def merged_panes(parts: DataFrame, on: Sequence[str]) -> DataFrame:
    """Panes put together from partial ones, as batches of a stream deliver them."""
    return parts.groupBy(*on, "pane").agg(
        F.sum("rows").alias("rows"), F.sum("sum").alias("sum"), F.min("least").alias("least"), F.max("most").alias("most")
    )


def windows_of_panes(parts: DataFrame, on: Sequence[str], width: int, size: int, slide: int) -> DataFrame:
    """``(on, start, rows, sum, least, most)`` of every window of ``size`` units with a row; one begins every ``slide`` units.

    ``width`` divides both. A tumbling window has ``slide`` equal to ``size``. A pane goes to blocks of as many panes as a
    window spans. Inside a block, aggregates run forward from its start and backward from its end; a window over two
    blocks is the tail of one and the head of the next, so it costs two partial aggregates whatever its size. Nothing
    else is kept of a key, and a busy one is spread by its blocks.
    """
    if size % width or slide % width or width <= 0 or slide <= 0 or size <= 0:
        raise ValueError("size and slide are multiples of the pane's width")
    on, span, step = list(on), size // width, slide // width
    block = F.expr(f"(pane - pmod(pane, {span}L)) div {span}L")
    blocked = parts.withColumn("_block", block)
    order = Window.partitionBy(*on, "_block").orderBy("pane")
    ahead, behind = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    names = {"rows": F.sum, "sum": F.sum, "least": F.min, "most": F.max}
    heads = blocked.select(*on, "_block", "pane", *[f(n).over(ahead).alias(n) for n, f in names.items()], F.lead("pane").over(order).alias("_next"))
    tails = blocked.select(*on, "_block", "pane", *[f(n).over(behind).alias(n) for n, f in names.items()], F.lag("pane").over(order).alias("_before"))
    # Of a window that begins at pane s, its own block gives the tail from the first pane at or after s.
    low = F.coalesce(F.col("_before") + 1, F.col("_block") * span)
    from_tail = tails.withColumn("_s", F.explode(_starts(low, F.col("pane"), step)))
    # The next block gives the head up to the last pane before s + span; a window at a block's start needs none.
    high = F.coalesce("_next", (F.col("_block") + 1) * span - 1) - span
    from_head = heads.withColumn("_s", F.explode(_starts(F.col("pane") + 1 - span, high, step)))
    pieces = from_tail.select(*on, "_s", *names).unionByName(from_head.select(*on, "_s", *names))
    return pieces.groupBy(*on, (F.col("_s") * width).alias("start")).agg(*[f(n).alias(n) for n, f in names.items()])


def _starts(low: Column, high: Column, step: int) -> Column:
    """Multiples of ``step`` from ``low`` to ``high``, both included; none if there is no such."""
    first = low + F.pmod(-low, F.lit(step))
    return F.when(first <= high, F.sequence(first, high, F.lit(step).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
