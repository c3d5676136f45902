"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

REQUIRED_CONF = {
    # A later duplicate key wins, in key/value logs and in JSON objects alike.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Parsing is bound by CPU, not by bytes: keep small shuffles spread over the cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator of this package relies on."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


_own: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.TemporaryDirectory(prefix="logstrata-")
    return _own[context.applicationId].name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
