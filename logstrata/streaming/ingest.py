"""Ingest whenever raw files arrive.

The file stream only tells which files are new to it; whether a file was
ingested before is still decided by name and checksum, so a replayed batch adds
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logstrata.plans.ingest import ingest_dataset
from logstrata.sources.files import named_paths

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stream_ingest(
    spark: SparkSession, dataset_id: str, raw_root: str, out_root: str, checkpoint: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Start the stream; by default it handles everything present and stops."""
    arriving = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("recursiveFileLookup", "true")
        .load(raw_root)
        .select("path")
    )

    def ingest(batch: DataFrame, _: int) -> None:
        paths = named_paths(batch)
        if paths != []:
            ingest_dataset(spark, dataset_id, raw_root, out_root, paths, **options)

    return (
        arriving.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
