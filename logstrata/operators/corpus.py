"""Reads on a finished corpus: by position, by source, and back to the raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus_count(index: DataFrame) -> DataFrame:
    return index.agg(F.count(F.lit(1)).alias("records"))


def located(wanted: DataFrame, index: DataFrame) -> DataFrame:
    """``(asked, shard_id, offset)`` of the wanted ``idx`` values.

    A negative one counts from the end; one beyond the corpus has no place.
    """
    total = index.agg(F.count(F.lit(1)))
    placed = wanted.withColumn("_total", total.scalar()).select(
        F.col("idx").alias("asked"),
        F.when(F.col("idx") < 0, F.col("idx") + F.col("_total")).otherwise(F.col("idx")).alias("idx"),
    )
    return placed.join(index.select("idx", "shard_id", "offset"), "idx", "left").drop("idx")


def fetch_by_index(wanted: DataFrame, index: DataFrame, shard_lines: DataFrame) -> DataFrame:
    """Records at the wanted ``idx`` values, read by shard and offset; null where there is none."""
    lines = shard_lines.select("shard_id", "offset", "line")
    found = located(wanted, index).join(lines, ["shard_id", "offset"], "left")
    return found.select(F.col("asked").alias("idx"), "line")


def indices_for_source(wanted: DataFrame, index: DataFrame, dictionary: DataFrame) -> DataFrame:
    """All positions of the wanted ``source_id`` names, one row each; an unknown name has none."""
    ids = wanted.join(dictionary, "source_id").select(F.col("source_id").alias("name"), F.col("id").alias("source_id"))
    return index.join(ids, "source_id").select(F.col("name").alias("source_id"), "idx")


def provenance(index: DataFrame, dictionary: DataFrame, manifest: DataFrame) -> DataFrame:
    """Each position with the manifest row of the file it came from."""
    names = dictionary.withColumnRenamed("source_id", "name")
    return (
        index.join(names, index["source_id"] == names["id"])
        .select("idx", F.col("name").alias("source_id"), "record_ref")
        .join(manifest, "source_id")
    )


def resolve_records(wanted: DataFrame, records: DataFrame, strict: bool = False) -> DataFrame:
    """Records re-derived from the raw files for ``(path, record_ref)`` requests; null if there is none."""
    parsed = records.select("path", "record_ref", "record_json")
    found = wanted.join(parsed, ["path", "record_ref"], "left")
    if not strict:
        return found
    message = F.concat(F.lit("ref "), F.col("record_ref").cast("string"), F.lit(" not found in "), F.col("path"))
    return found.withColumn("record_json", F.coalesce("record_json", F.raise_error(message)))
