"""Grouping sets with distinct counts: exact, and by mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Of a sketch with 2^12 registers: 1.04 / sqrt(4096), the relative standard error.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def all_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """Every subset, the whole one first: the sets of a cube."""
    return [s for n in range(len(dimensions), -1, -1) for s in combinations(dimensions, n)]


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def _expanded(rows: DataFrame, dimensions: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Each row once a set, the other dimensions null; ``grouping`` has a bit for each of those, the last one lowest."""
    unknown = {c for s in sets for c in s} - set(dimensions)
    if unknown:
        raise ValueError(f"not among the dimensions: {sorted(unknown)}")
    copies = []
    for s in dict.fromkeys(tuple(c for c in dimensions if c in own) for own in sets):
        bits = sum(1 << (len(dimensions) - 1 - i) for i, c in enumerate(dimensions) if c not in s)
        copies.append(F.struct(F.lit(bits).alias("grouping"), *[F.when(F.lit(c in s), F.col(c)).alias(c) for c in dimensions]))
    others = [c for c in rows.columns if c not in dimensions]
    return rows.select(*others, F.inline(F.array(*copies)))


def exact_cube(rows: DataFrame, dimensions: Sequence[str], sets: Sequence[Sequence[str]], sums: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """``(dimensions, grouping, rows, sum_<c>…, distinct_<c>…)`` for every group of every set.

    Rows are summed at the finest grain before they are copied for the sets. Distinct values take two levels: each value
    once a group, shuffled by group and value, so that no task holds a group's values; then their number. Nulls are a
    value of a dimension (``grouping`` tells them from the nulls of a coarser set) and count as nothing elsewhere. An empty
    table has no groups.
    """
    dimensions, sums, distinct = list(dimensions), list(sums), list(distinct)
    fine = rows.groupBy(*dimensions).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(f"sum_{c}") for c in sums])
    totals = _expanded(fine, dimensions, sets).groupBy("grouping", *dimensions)
    parts = [totals.agg(F.sum("rows").alias("rows"), *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in sums])]
    for c in distinct:
        values = rows.select(*dimensions, F.col(c).alias("_value")).where("_value is not null").distinct()
        values = _expanded(values, dimensions, sets).distinct()
        parts.append(values.groupBy("grouping", *dimensions).agg(F.count(F.lit(1)).alias(f"distinct_{c}")))
    # The parts meet by adding up: one row of each group from every part.
    measures = ["rows", *[f"sum_{c}" for c in sums], *[f"distinct_{c}" for c in distinct]]
    union = parts[0]
    for more in parts[1:]:
        union = union.unionByName(more, allowMissingColumns=True)
    out = union.groupBy(*dimensions, "grouping").agg(*[F.sum(m).alias(m) for m in measures])
    return out.withColumns({f"distinct_{c}": F.coalesce(f"distinct_{c}", F.lit(0).cast("bigint")) for c in distinct}) if distinct else out


def sketch_cube(rows: DataFrame, dimensions: Sequence[str], sets: Sequence[Sequence[str]], distinct: Sequence[str]) -> DataFrame:
    """``(dimensions, grouping, rows, distinct_<c>…)`` with distinct counts from sketches of a relative error of about 1.6 %.

    One sketch is made for each group of the finest grain; coarser groups merge sketches, never values. The copies for the
    sets are copies of sketches of a bounded size.
    """
    dimensions = list(dimensions)
    fine = rows.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("rows"), *[F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(c) for c in distinct]
    )
    merged = _expanded(fine, dimensions, sets).groupBy(*dimensions, "grouping")
    return merged.agg(F.sum("rows").alias("rows"), *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"distinct_{c}") for c in distinct])
