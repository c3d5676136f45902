"""What is in a corpus: the fields of its records with their types, and the most frequent values of each."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstrata.functions.jsonleaves import TYPES, json_leaves
from logstrata.session import materialize

# Counters a task keeps of one group, and of all groups before it hands them on.
COUNTERS = 1_000
HELD = 200_000


def field_values(records: DataFrame, carry: Sequence[str], text: str = "record_json") -> DataFrame:
    """``(carry, field, type, value)``: every value of every record by its path; texts that are no JSON have none."""
    leaf = F.explode_outer(json_leaves(F.col(text))).alias("_leaf")
    return records.select(*carry, leaf).where("_leaf is not null").select(*carry, "_leaf.field", "_leaf.type", "_leaf.value")


# --- structure ------------------------------------------------------------------------


def type_name(mask: Column) -> Column:
    """The least type of the lattice above a set of types: nothing < each type < number < mixed, apart from null."""
    known = mask.bitwiseAND(F.lit(~1))
    name = F.when(known == 0, "null").when(known == 12, "number")
    for bit, kind in enumerate(TYPES):
        if bit:
            name = name.when(known == 1 << bit, kind)
    return name.otherwise("mixed")


def partial_profile(values: DataFrame, by: Sequence[str], record: Sequence[str]) -> DataFrame:
    """``(by, field, records, occurrences, types, longest)`` of a part of a corpus; ``record`` tells its records apart.

    Counts add up, sets of types join by "or", lengths by the greater: parts may be merged in any order and grouping, as
    long as a record lies in one part.
    """
    # A list may hold a field many times in one record: once a record first.
    once = values.groupBy(*by, *record, "field").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("type").alias("types"), F.max(F.length("value")).alias("longest")
    )
    return once.groupBy(*by, "field").agg(
        F.count(F.lit(1)).alias("records"), F.sum("n").alias("occurrences"), F.bit_or("types").alias("types"), F.max("longest").alias("longest")
    )


def merged_profiles(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.groupBy(*by, "field").agg(
        F.sum("records").alias("records"), F.sum("occurrences").alias("occurrences"), F.bit_or("types").alias("types"), F.max("longest").alias("longest")
    )


def finished_profile(parts: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by, field, type, nullable, optional, records, occurrences, longest)``; ``totals`` is ``(by, all_records)``.

    ``type`` is the least type that holds every value (``mixed`` if there is none but that), ``nullable`` whether a value is
    null, ``optional`` whether a record lacks the field, ``longest`` the characters of the longest scalar.
    """
    return parts.join(totals, list(by)).select(
        *by, "field", type_name(F.col("types")).alias("type"), (F.col("types").bitwiseAND(F.lit(1)) > 0).alias("nullable"),
        (F.col("records") < F.col("all_records")).alias("optional"), "records", "occurrences", "longest",
    )


def structure_profile(records: DataFrame, by: Sequence[str], record: Sequence[str], text: str = "record_json") -> DataFrame:
    """The profile of the fields of all records, for each ``by``; ``record`` are columns that tell records apart.

    Texts that are null or no JSON count as records without fields. Empty tables have no fields.
    """
    values = field_values(records, [*by, *record], text)
    totals = records.groupBy(*by).agg(F.count(F.lit(1)).alias("all_records"))
    return finished_profile(partial_profile(values, by, record), totals, by)


# --- frequent values ------------------------------------------------------------------


def _reduced(counts: pd.DataFrame, group: list[str], counters: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """At most ``counters`` rows of a group, all lowered by its first count beyond them; and by how much each group was."""
    counts = counts.sort_values("n", ascending=False, kind="stable")
    place = counts.groupby(group, dropna=False, sort=False).cumcount()
    beyond = counts[place == counters][[*group, "n"]].rename(columns={"n": "less"})
    if not len(beyond):
        return counts, beyond
    counts = counts.merge(beyond, on=group, how="left")
    counts["n"] -= counts["less"].fillna(0).astype("int64")
    return counts[counts["n"] > 0].drop(columns="less"), beyond


def frequent_summaries(values: DataFrame, group: Sequence[str], value: str, counters: int = COUNTERS) -> DataFrame:
    """``(group, value, n, less)``: summaries of frequent values as the tasks hand them on.

    A task keeps ``counters`` counts of a group; one more lowers all of them. Rows with a value hold a count that is too low
    by at most the sum of the group's ``less``, which rows with a null value bring. So summaries merge by adding up.
    """
    group = list(group)
    source = values.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("value"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields)
    schema = f"{kinds}n long, less long"

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*group, "value"]
        kind = None

        def rows(counts: pd.DataFrame, less: pd.DataFrame) -> Iterator[pa.RecordBatch]:
            out = pd.concat([counts.assign(less=0), less.assign(n=0, value=None)])[[*names, "n", "less"]]
            yield from pa.Table.from_pandas(out, kind, preserve_index=False).to_batches()

        held, lowered = None, []
        for batch in batches:
            if kind is None:
                kind = pa.schema([*(batch.schema.field(c).with_nullable(True) for c in names), ("n", pa.int64()), ("less", pa.int64())])
            counted = pa.Table.from_batches([batch]).group_by(names).aggregate([([], "count_all")]).rename_columns([*names, "n"])
            # A batch may say that a column holds no null, which a lowered summary does not: one schema for both.
            counted = counted.cast(pa.schema(list(kind)[:-1]))
            held = counted if held is None else pa.concat_tables([held, counted])
            if held.num_rows > HELD:
                held = held.group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])
                kept, less = _reduced(held.to_pandas(integer_object_nulls=True), group, counters)
                lowered.append(less)
                if len(kept) > HELD // 2:  # many groups: a new summary begins
                    yield from rows(kept, pd.concat(lowered))
                    held, lowered = None, []
                else:
                    held = pa.Table.from_pandas(kept[[*names, "n"]], pa.schema(list(kind)[:-1]), preserve_index=False)
        if held is not None:
            held = held.group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])
            kept, less = _reduced(held.to_pandas(integer_object_nulls=True), group, counters)
            yield from rows(kept, pd.concat([*lowered, less]))

    return source.mapInArrow(summarise, schema)


def top_values(values: DataFrame, group: Sequence[str], value: str, k: int, counters: int = COUNTERS) -> DataFrame:
    """``(group, rank, value, n)``: the ``k`` most frequent values of each group, exact; equal counts by ascending value.

    Mergeable summaries find every value that can be among them: one whose count, raised by the group's error, reaches the
    ``k``-th lower bound. Only those are counted in a second pass. A group whose ``k``-th bound is no higher than its error
    (many values of about equal frequency) is counted in full instead. The shuffle so holds candidates, not all
    distinct values, and a group is nowhere collected. Null values don't count; null groups are groups.
    """
    group = list(group)
    # Written once: the values are summarised and counted, and taking them from records is the costly part.
    asked = materialize(values.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("value")), "values")
    parts = materialize(frequent_summaries(asked, group, "value", counters), "summaries")
    merged = parts.where("value is not null").groupBy(*group, "value").agg(F.sum("n").alias("n"))
    # A group may have lost every counter, so groups come from the errors too.
    error = parts.groupBy(*group).agg(F.sum("less").alias("_error"))
    place = Window.partitionBy(*group).orderBy(F.desc("n"), "value")
    bound = merged.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= k)
    bound = bound.groupBy(*group).agg(F.when(F.count(F.lit(1)) == k, F.min("n")).otherwise(0).alias("_bound"))
    known = _joined(error, bound, group).withColumn("_bound", F.coalesce("_bound", F.lit(0)))
    known = materialize(known.withColumn("_open", (F.col("_bound") <= F.col("_error")) & (F.col("_error") > 0)), "bounds")
    settled = _joined(merged, known.where(~F.col("_open")), group, "inner")
    likely = settled.where(F.col("n") + F.col("_error") >= F.col("_bound")).select(*group, "value")
    some = _joined(asked, likely, [*group, "value"], "left_semi")
    rest = _joined(asked, known.where("_open").select(*group), group, "left_semi")
    exact = some.unionByName(rest).groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    return exact.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(*group, "rank", "value", "n")


def _joined(a: DataFrame, b: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """A join on null-safe equality that keeps the columns of ``a`` and the further ones of ``b``."""
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    met = a.alias("a").join(b.alias("b"), condition, how)
    more = [] if how == "left_semi" else [f"b.{c}" for c in b.columns if c not in on]
    return met.select(*[F.col(f"a.{c}") for c in a.columns], *more)
