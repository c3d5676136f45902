"""Incremental ingest of one dataset, and the corpus it publishes.

Layout below the output root, all in shared storage::

    manifest/run=<id>/            one row per ingested file; written last
    corpus/<dataset>/shards/run=<id>/shard_id=<n>/
    corpus/<dataset>/index/run=<id>/
    corpus/<dataset>/source_ids/run=<id>/
    corpus/<dataset>/problems/run=<id>/    lines a quarantine run could not parse

A run is visible once its manifest rows exist. What a failed run left behind is
never read, and the next run parses those files again.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.operators import catalog, classify, corpus, shards
from logstrata.operators.framing import line_offsets
from logstrata.operators.ordering import ordered_prefix
from logstrata.plans.datasets import Discovery, discover
from logstrata.plans.payloads import parse_sources
from logstrata.session import configure, materialize

INDEX_SCHEMA = "idx bigint, shard_id int, offset bigint, source_id int, record_ref bigint"
DICTIONARY_SCHEMA = "id int, source_id string"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table in run folders, empty before the first run."""
    schema = f"{schema}, run string"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


class Corpus:
    """Tables of one published dataset."""

    def __init__(self, spark: SparkSession, out_root: str, dataset_id: str):
        self.spark, self.dataset_id = spark, dataset_id
        self.out_root = out_root.rstrip("/")
        self.root = f"{self.out_root}/corpus/{dataset_id}"

    def manifest(self) -> DataFrame:
        rows = _table(self.spark, f"{self.out_root}/manifest", catalog.MANIFEST_SCHEMA)
        return rows.where(F.col("dataset_id") == self.dataset_id)

    def _published(self, name: str, schema: str) -> DataFrame:
        runs = self.manifest().select("run").distinct()
        return _table(self.spark, f"{self.root}/{name}", schema).join(runs, "run", "left_semi")

    def index(self) -> DataFrame:
        return self._published("index", INDEX_SCHEMA).select("idx", "shard_id", "offset", "source_id", "record_ref", "run")

    def dictionary(self) -> DataFrame:
        return self._published("source_ids", DICTIONARY_SCHEMA).select("id", "source_id")

    def shard_lines(self, only: DataFrame | None = None) -> DataFrame:
        """``(shard_id, offset, line)``: the shard files with the positions the index uses.

        ``only`` limits the read to the folders of some ``(shard_id)``. A resumed
        shard has one file per run; its part starts at the first offset the index
        has for that run.
        """
        path, index = f"{self.root}/shards", self.index()
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], "shard_id int, offset bigint, line string")
        parts = index.groupBy("run", "shard_id").agg(F.min("offset").alias("_from"))
        parts = parts if only is None else parts.join(only.select("shard_id").distinct(), "shard_id", "left_semi")
        text = self.spark.read.option("lineSep", "\n").option("basePath", path).text(path)
        # Run and shard are folder names, so this join decides which folders are read.
        rows = text.select(
            "run", "shard_id", F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).join(parts, ["run", "shard_id"])
        return line_offsets(rows).select("shard_id", (F.col("byte_offset") + F.col("_from")).alias("offset"), "line")

    def count(self) -> int:
        return corpus.corpus_count(self.index()).first()["records"]

    def fetch(self, wanted: DataFrame) -> DataFrame:
        index = self.index()
        shards_read = corpus.located(wanted, index).select("shard_id").where("shard_id is not null")
        return corpus.fetch_by_index(wanted, index, self.shard_lines(shards_read))

    def indices_for_source(self, wanted: DataFrame) -> DataFrame:
        return corpus.indices_for_source(wanted, self.index(), self.dictionary())

    def provenance(self) -> DataFrame:
        return corpus.provenance(self.index(), self.dictionary(), self.manifest().drop("run"))

    def state(self) -> tuple[int, int | None, int, int]:
        """Records so far, last shard, and the records and bytes in it."""
        index = self.index()
        total = index.agg(F.count(F.lit(1)).alias("n"), F.max("shard_id").alias("last")).first()
        if total["last"] is None:
            return 0, None, 0, 0
        held = index.where(F.col("shard_id") == total["last"]).count()
        lines = self.shard_lines(index.where(F.col("shard_id") == total["last"]))
        size = lines.agg(F.max(F.col("offset") + F.octet_length("line") + 1).alias("n")).first()["n"]
        return total["n"], total["last"], held, size


def parse_new(
    found: Discovery,
    manifest: DataFrame,
    skip_non_dict: bool = True,
    minimum_fields: int | None = 4,
    mode: str = "failfast",
) -> tuple[DataFrame, DataFrame]:
    """Sources with ``is_new``, and the parsed records of the new ones with ``kept``.

    Everything is written once: digests and probes behind the sources read whole
    files, and ids, numbering, shards and counts all read these tables.
    """
    sources = materialize(found.sources, "discovered")
    marked = materialize(catalog.mark_new(catalog.assign_source_id(sources, manifest), manifest), "sources")
    parsed = parse_sources(found.payload, marked.where("is_new"), found.kinds, mode)
    kept = F.coalesce(classify.passes_quality(skip_non_dict, minimum_fields) & F.col("problem").isNull(), F.lit(False))
    columns = ["path", "block", "position", "record_ref", "kept", "problem"]
    text = F.when(F.col("kept"), F.col("record_json")).alias("record_json")
    return marked, materialize(parsed.withColumn("kept", kept).select(*columns, text), "records")


def numbered_sources(marked: DataFrame) -> DataFrame:
    """``(path, source_id, source_ord)`` of the new sources, their order as a plain number."""
    new = marked.where("is_new").select("path", "source_id", "ord")
    return ordered_prefix(new, ["ord"], F.lit(1), "source_ord").drop("ord")


def ingest_discovered(
    spark: SparkSession,
    dataset_id: str,
    found: Discovery,
    out_root: str,
    *,
    skip_non_dict: bool = True,
    minimum_fields: int | None = 4,
    shard_size: int = shards.SHARD_SIZE,
    mode: str = "failfast",
) -> DataFrame:
    """Parse the files that are not catalogued yet, publish them, return the run's counters."""
    configure(spark)
    held = Corpus(spark, out_root, dataset_id)
    manifest = held.manifest()
    run = datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%dT%H%M%S-") + uuid.uuid4().hex[:8]

    marked, parsed = parse_new(found, manifest, skip_non_dict, minimum_fields, mode)
    records = parsed.where("kept").drop("kept", "problem")
    sources = materialize(numbered_sources(marked), "numbered")

    first, last_shard, in_last, last_bytes = held.state()
    indexed = shards.shard_assign(shards.global_index(records, sources, first), shard_size, first, last_shard, in_last)
    lines = shards.shard_lines(indexed).drop("record_json")
    placed = materialize(shards.shard_offsets(lines, last_shard, last_bytes), "placed")
    dictionary = held.dictionary()
    names = materialize(shards.source_dictionary(placed, dictionary), "names")

    shards.write_shards(placed, f"{held.root}/shards/run={run}")
    shards.shard_index(placed, names).write.parquet(f"{held.root}/index/run={run}")
    names.join(dictionary.select("id"), "id", "left_anti").write.parquet(f"{held.root}/source_ids/run={run}")
    problems = parsed.where("problem is not null").join(sources, "path")
    problems.select("source_id", "record_ref", "problem").write.parquet(f"{held.root}/problems/run={run}")
    entries = catalog.manifest_build(marked.where("is_new"), placed)
    entries.write.parquet(f"{held.out_root}/manifest/run={run}")
    return catalog.ingest_summary(marked, parsed.where("problem is null"), placed)


def ingest_dataset(
    spark: SparkSession, dataset_id: str, raw_root: str, out_root: str, only: list[str] | None = None, **options
) -> DataFrame:
    """Discover a raw folder and ingest what is new in it."""
    configure(spark)
    return ingest_discovered(spark, dataset_id, discover(spark, dataset_id, raw_root, only), out_root, **options)
