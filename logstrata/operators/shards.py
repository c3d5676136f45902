"""Dense numbering, shard layout and the source dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logstrata.functions import jsontext, pytext
from logstrata.operators.framing import line_offsets
from logstrata.operators.ordering import ordered_prefix
from logstrata.sources import files

SHARD_SIZE = 10_000


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def global_index(records: DataFrame, sources: DataFrame, first: int | Column = 0) -> DataFrame:
    """Add ``source_id`` and ``idx``: the position of each record in (source order, order inside the source).

    ``sources`` is ``(path, source_id, source_ord)``; records of other paths are
    left out. Records are counted per block, and only those counts meet the
    sources and are put into a total order. The records themselves join on
    ``(path, block)``, which they are already grouped by, so a source holding a
    large share of them is no hot key.
    """
    counts = records.groupBy("path", "block").agg(F.count(F.lit(1)).alias("_n"))
    placed = counts.join(sources.select("path", "source_id", "source_ord"), "path")
    bases = ordered_prefix(placed, ["source_ord", "block"], F.col("_n"), "_base").drop("_n", "source_ord")
    inside = Window.partitionBy("path", "block").orderBy("position")
    return (
        records.withColumn("_rank", F.row_number().over(inside))
        .join(bases, ["path", "block"])
        .withColumn("idx", _column(first) + F.col("_base") + F.col("_rank") - 1)
        .drop("_base", "_rank")
    )


def shard_of(position: Column, shard_size: int, last_shard: int | Column | None = None, in_last: int | Column = 0) -> Column:
    """Shard of the ``position``-th new record, filling up the last shard of an earlier run first."""
    last, held = _column(last_shard).cast("int"), _column(in_last)
    return (
        F.when(last.isNull(), F.floor(position / shard_size))
        .when(held < shard_size, last + F.floor((position + held) / shard_size))
        .otherwise(last + 1 + F.floor(position / shard_size))
        .cast("int")
    )


def shard_assign(
    indexed: DataFrame,
    shard_size: int = SHARD_SIZE,
    first: int | Column = 0,
    last_shard: int | Column | None = None,
    in_last: int | Column = 0,
) -> DataFrame:
    """Add ``shard_id`` to numbered records; ``first`` is the number of the first new one."""
    return indexed.withColumn("shard_id", shard_of(F.col("idx") - _column(first), shard_size, last_shard, in_last))


def shard_offsets(
    sharded: DataFrame, last_shard: int | Column | None = None, last_bytes: int | Column = 0
) -> DataFrame:
    """Add ``offset``: the byte position of each record in its shard; a shard is a bounded group."""
    w = Window.partitionBy("shard_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    start = F.when(F.col("shard_id") == _column(last_shard).cast("int"), _column(last_bytes)).otherwise(0)
    written = F.coalesce(F.sum(F.octet_length("line") + 1).over(w), F.lit(0))
    return sharded.withColumn("offset", (written + start).cast("bigint"))


def shard_lines(records: DataFrame) -> DataFrame:
    """Add ``line``: the record as it is written to its shard."""
    return records.withColumn("line", jsontext.record_to_json(F.col("record_json")))


def source_dictionary(indexed: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """``(id, source_id)`` of the sources, in order of their first record, after the existing ids."""
    seen = indexed.groupBy("source_id").agg(F.min("idx").alias("_first"))
    if existing is None:
        return ordered_prefix(seen, ["_first"], F.lit(1), "id").select(F.col("id").cast("int"), "source_id")
    new = seen.join(existing, "source_id", "left_anti")
    used = existing.agg(F.coalesce(F.max("id") + 1, F.lit(0)))
    numbered = (
        ordered_prefix(new, ["_first"], F.lit(1), "_n")
        .withColumn("_used", used.scalar())
        .select((F.col("_used") + F.col("_n")).cast("int").alias("id"), "source_id")
    )
    return existing.select("id", "source_id").unionByName(numbered)


def shard_index(sharded: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(idx, shard_id, offset, source_id INT, record_ref)``."""
    return sharded.join(dictionary, "source_id").select(
        "idx", "shard_id", "offset", F.col("id").alias("source_id"), "record_ref"
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One ordered text file per shard, in a folder per shard."""
    (
        sharded.repartition("shard_id")
        .sortWithinPartitions("shard_id", "idx")
        .select("shard_id", F.col("line").alias("value"))
        .write.partitionBy("shard_id")
        .option(*files.COMMIT_BY_TASKS)
        .text(path)
    )


def write_corpus(sharded: DataFrame, dictionary: DataFrame, path: str) -> None:
    """Shard files, their index and the dictionary of sources below one folder."""
    write_shards(sharded, f"{path}/shards")
    shard_index(sharded, dictionary).write.parquet(f"{path}/index")
    dictionary.write.parquet(f"{path}/source_ids")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``(idx, shard_name, offset, line, source_id, record_ref)`` of a written corpus, in terms of its files.

    Offsets are counted anew from the bytes of the shard files and meet those of the index, ids meet the dictionary. A line
    without an index entry, an entry without a line and an id without a name are errors.
    """
    text = spark.read.option("lineSep", "\n").text(f"{path}/shards")
    rows = text.select(
        "shard_id", F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"),
    )
    lines = line_offsets(rows).select("shard_id", F.col("byte_offset").alias("offset"), "line")
    index, names = spark.read.parquet(f"{path}/index"), spark.read.parquet(f"{path}/source_ids")
    named = index.join(names.withColumnRenamed("source_id", "name"), F.col("source_id") == F.col("id"), "left")
    met = lines.join(named, ["shard_id", "offset"], "full")
    place = F.concat_ws(" ", F.lit("in shard"), "shard_id", F.lit("at"), "offset")
    problem = (
        F.when(F.col("idx").isNull(), F.concat(F.lit("no index entry "), place))
        .when(F.col("line").isNull(), F.concat(F.lit("no line "), place))
        .when(F.col("name").isNull(), F.concat(F.lit("no source name "), place))
    )
    return met.select(
        "idx", pytext.shard_name(F.col("shard_id")).alias("shard_name"), "offset",
        F.when(problem.isNull(), F.col("line")).otherwise(F.raise_error(problem)).alias("line"), F.col("name").alias("source_id"), "record_ref",
    )
