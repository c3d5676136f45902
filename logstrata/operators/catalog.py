"""Source ids, incremental selection and the manifest.

``files`` carries ``(dataset_id, file_name, checksum_sha256, ord, …)`` with
``ord`` the processing order. Groups of equal names or copies are reduced to one
row per group before anything is joined back, so their size does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata.operators.classify import record_ref_type

SUFFIX_LENGTH = 8

MANIFEST_SCHEMA = (
    "source_id string, dataset_id string, file_name string, source_url string, license string, "
    "ingested_at string, checksum_sha256 string, bytes bigint, record_count bigint, labeled boolean, "
    "record_ref_type string, notes string"
)
MANIFEST_COLUMNS = [c.strip().split(" ")[0] for c in MANIFEST_SCHEMA.split(",")]


def empty_manifest(spark) -> DataFrame:
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def path_order(path: Column) -> Column:
    """Sort key of a path: its parts, so a folder sorts before names that extend its own."""
    return F.split(path, "/")


# Fixed format: how a disambiguated id ends.
_DISAMBIGUATED = r"#[0-9a-f]{8}\z"


def assign_source_id(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add ``source_id``: the plain name, or name#checksum when another file holds that name.

    The holder is the catalogued file, else the first one of this run. ``files``
    is read several times, so it should be a written table.
    """
    named = files.withColumn("_candidate", F.concat("dataset_id", F.lit("/"), "file_name"))
    first = named.groupBy("_candidate").agg(
        F.min_by("checksum_sha256", "ord").alias("_first"), F.min("ord").alias("_first_ord")
    )
    known = manifest.select(F.col("source_id").alias("_candidate"), F.col("checksum_sha256").alias("_known"))
    holders = first.join(known, "_candidate", "left").withColumn("_holder", F.coalesce("_known", "_first"))

    # A file's own name may look like the id another one was given in this run; the earlier of the two holds it.
    lookalikes = first.where(F.col("_candidate").rlike(_DISAMBIGUATED)).select(F.col("_candidate").alias("source_id"))
    given = _identified(named, holders).where("collided").join(lookalikes, "source_id", "left_semi")
    claims = given.groupBy(F.col("source_id").alias("_candidate")).agg(
        F.min_by("checksum_sha256", "ord").alias("_claim"), F.min("ord").alias("_claim_ord")
    )
    earlier = F.when(F.col("_claim_ord") < F.col("_first_ord"), F.col("_claim"))
    settled = holders.join(claims, "_candidate", "left").withColumn("_holder", F.coalesce("_known", earlier, "_first"))
    return _identified(named, settled).drop("_candidate")


def _identified(named: DataFrame, holders: DataFrame) -> DataFrame:
    suffixed = F.concat("_candidate", F.lit("#"), F.substring("checksum_sha256", 1, SUFFIX_LENGTH))
    return (
        named.join(holders.select("_candidate", "_holder"), "_candidate")
        .withColumn("collided", F.col("_holder") != F.col("checksum_sha256"))
        .withColumn("source_id", F.when(F.col("collided"), suffixed).otherwise(F.col("_candidate")))
        .drop("_holder")
    )


def collision_report(identified: DataFrame) -> DataFrame:
    """Files that had to be told apart from another one of the same name."""
    return identified.where("collided").select("dataset_id", "file_name", "source_id")


def mark_new(identified: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add ``is_new``: not catalogued, and the first file of this run with its id."""
    first = identified.groupBy("source_id").agg(F.min("ord").alias("_first_ord"))
    known = manifest.select("source_id", F.lit(True).alias("_known"))
    return (
        identified.join(first.join(known, "source_id", "left"), "source_id")
        .withColumn("is_new", F.col("_known").isNull() & (F.col("ord") == F.col("_first_ord")))
        .drop("_first_ord", "_known")
    )


def incremental_new_files(identified: DataFrame, manifest: DataFrame) -> DataFrame:
    return mark_new(identified, manifest).where("is_new").drop("is_new")


def manifest_build(sources: DataFrame, records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """One row per ingested file, files without surviving records included."""
    counts = records.groupBy("source_id").agg(F.count(F.lit(1)).alias("record_count"))
    return manifest_rows(sources.join(counts, "source_id", "left"), ingested_at)


def manifest_rows(counted: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Manifest rows of sources that already carry their ``record_count``, null for none."""
    today = F.date_format(F.current_date(), "yyyy-MM-dd") if ingested_at is None else ingested_at
    return (
        counted.withColumn("record_count", F.coalesce("record_count", F.lit(0)).cast("bigint"))
        .withColumn("ingested_at", today)
        .withColumn("record_ref_type", record_ref_type(F.col("format")))
        .withColumn("notes", F.lit(""))
        .select(*MANIFEST_COLUMNS)
    )


def manifest_upsert(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """The last entry of a key wins. Both sides carry ``version``, the order of their writes.

    The row keeps the ``version`` of the key's first write as its ``position``.
    """
    both = manifest.unionByName(entries)
    row = F.struct(*both.columns)
    return (
        both.groupBy("source_id")
        .agg(F.max_by(row, "version").alias("row"), F.min("version").alias("position"))
        .select("row.*", "position")
        .drop("version")
    )


def manifest_sorted(manifest: DataFrame, sort: bool = True) -> DataFrame:
    return manifest.orderBy("source_id" if sort else "position")


def ingest_summary(marked: DataFrame, records: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of counters for a run: ``marked`` files, parsed ``records`` and those ``kept``."""
    files = marked.agg(F.count_if("is_new").alias("files_ingested"), F.count_if(~F.col("is_new")).alias("files_skipped"))
    parsed = records.agg(F.count(F.lit(1)).alias("n"))
    written = kept.agg(F.count(F.lit(1)).alias("n"))
    return (
        files.withColumn("records_written", written.scalar())
        .withColumn("_parsed", parsed.scalar())
        .withColumn("records_dropped", F.col("_parsed") - F.col("records_written"))
        .drop("_parsed")
    )
