"""Rows on a time axis, cut into blocks where one key has too many of them.

The axis is a BIGINT (any unit) or a TIMESTAMP column (microseconds). A key with more rows than a block should hold gets time
blocks of equal width, so many that one holds about that number; all other keys are one block. Which keys those are is a
small table that Spark broadcasts or not by its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata.session import materialize

# Rows of one key that are put in order by one task.
BLOCK_ROWS = 200_000


def axis(df: DataFrame, column: str) -> Column:
    """The column as a BIGINT: itself, or microseconds since 1970 of a timestamp; one without a zone is UTC."""
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp":
        return F.unix_micros(column)
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column))
    if kind not in ("long", "integer", "short", "byte"):
        raise ValueError(f"{column} is neither a timestamp nor an integer")
    return F.col(column).cast("bigint")


def free_names(left: Sequence[str], right: Sequence[str]) -> None:
    clash = sorted(set(left) & set(right))
    if clash:
        raise ValueError(f"both sides have columns {clash}; rename them")


def same(on: Sequence[str], a: str, b: str) -> Column:
    """Null-safe equality of the key columns of two aliased sides."""
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return condition


def with_time_block(rows: DataFrame, on: Sequence[str], at: str, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Add ``_block`` to rows with a BIGINT ``at``; and the table ``(on, _low, _width)`` of the keys that are cut, if any."""
    sums = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_low"), F.max(at).alias("_high"))
    busy = sums.where((F.col("_n") > block_rows) & (F.col("_high") > F.col("_low")))
    parts = F.ceil(F.col("_n") / block_rows)
    # In decimals: the span of an axis may exceed a BIGINT's.
    width = F.ceil((F.col("_high").cast("decimal(20,0)") - F.col("_low")) / parts).cast("bigint") + 1
    busy = materialize(busy.select(*on, "_low", width.alias("_width")), "busy")
    if not busy.limit(1).count():
        return rows.withColumn("_block", F.lit(0).cast("bigint")), None
    return cut(rows, busy, on, at), busy


def cut(rows: DataFrame, busy: DataFrame | None, on: Sequence[str], at: str) -> DataFrame:
    """``rows`` with the ``_block`` of ``at`` under the widths of ``busy``; 0 for keys that are not cut."""
    if busy is None:
        return rows.withColumn("_block", F.lit(0).cast("bigint"))
    met = rows.alias("r").join(busy.alias("b"), same(on, "r", "b"), "left")
    inside = F.floor((F.col(f"r.{at}").cast("decimal(20,0)") - F.col("b._low")) / F.col("b._width")).cast("bigint")
    return met.select("r.*", F.coalesce(inside, F.lit(0)).alias("_block"))
