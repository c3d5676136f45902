"""The six datasets: which raw files count, and which format each one holds.

Every function returns a :class:`Discovery`: sources in processing order and the
payload their records are parsed from.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.functions import pytext
from logstrata.operators import classify
from logstrata.operators.catalog import path_order
from logstrata.plans.payloads import EventTablePayload, FilePayload, RowPayload
from logstrata.session import materialize
from logstrata.sources import archives, catalogs, evtx, files

# Origin, licence and labelling of each dataset (fixed values); None: per file.
DATASETS = {
    "otrf": ("https://github.com/OTRF/Security-Datasets", "GPL-3.0", True),
    "evtx_attack_samples": ("https://github.com/sbousseaden/EVTX-ATTACK-SAMPLES", "GPL-3.0", True),
    "flaws_cloud": ("https://summitroute.com/downloads/flaws_cloudtrail_logs.tar", "unspecified", True),
    "ait_lds": ("https://zenodo.org/records/19483937", "CC-BY-NC-SA-4.0", False),
    "elastic_fixtures": ("https://github.com/elastic/integrations", "Elastic-2.0", False),
    "splunk_attack_data": ("https://github.com/splunk/attack_data", "Apache-2.0", None),
}

SOURCE_COLUMNS = [
    "dataset_id", "file_name", "path", "format", "source_url", "license", "labeled", "ord", "checksum_sha256", "bytes",
]

# Host logs live in these folders; classify.path_classify decides on each file.
HOST_LOG_MEMBER = r"gather/[^/]+/logs/(?:apache2|horde|audit|suricata|logstash)/.*"


@dataclass(frozen=True)
class Discovery:
    sources: DataFrame
    payload: object
    kinds: tuple[str, ...]


def order_key(group: Column, path: Column) -> Column:
    """Processing order: by group, then by path parts within it."""
    return F.struct(group.alias("a"), path_order(path).alias("b"))


def _no_group() -> Column:
    return F.array().cast("array<string>")


def label_sources(files_: DataFrame, dataset_id: str) -> DataFrame:
    """Add the dataset's constant columns; ``labeled`` stays when it is given per file."""
    url, licence, labeled = DATASETS[dataset_id]
    named = (
        files_.withColumn("dataset_id", F.lit(dataset_id))
        .withColumn("source_url", F.lit(url))
        .withColumn("license", F.lit(licence))
    )
    return named if labeled is None else named.withColumn("labeled", F.lit(labeled))


def _described(files_: DataFrame, dataset_id: str) -> DataFrame:
    return label_sources(files_, dataset_id).select(*SOURCE_COLUMNS)


def member_files(members: DataFrame, root: str = "") -> DataFrame:
    """Archive members as files: they live in a folder named after their archive."""
    path = F.concat(pytext.stem_dir(F.col("archive")), F.lit("/"), F.col("member"))
    return (
        members.withColumn("path", path)
        .withColumn("file_name", pytext.relative_to(path, root) if root else path)
        .withColumn("bytes", F.octet_length("content").cast("bigint"))
        .withColumn("checksum_sha256", files.file_checksum(F.col("content")))
        .withColumn("ord", order_key(path_order(F.col("archive")), path))
    )


def archive_logs(members: DataFrame, root: str = "") -> Discovery:
    """Archives holding one JSON file, or logs judged by content (``otrf``)."""
    held = member_files(members, root)
    payload = RowPayload(held)
    logs = held.where(F.endswith("member", F.lit(".log")))
    probes = classify.probe(payload.lines(logs))
    chosen = classify.archive_select(held.select("archive", "member", "path"), probes)
    failed = F.raise_error(F.concat(F.col("archive"), F.lit(": "), F.col("problem")))
    chosen = chosen.select(
        F.when(F.col("problem").isNull(), F.col("path")).otherwise(failed).alias("path"), "format"
    )
    kinds = (classify.JSON_LINES, classify.AUDITD)
    return Discovery(_described(held.drop("content").join(chosen, "path"), "otrf"), payload, kinds)


def windows_events(files_: DataFrame, events: DataFrame) -> Discovery:
    """Windows event logs below technique folders (``evtx_attack_samples``), decoded to ``events``."""
    sources = (
        classify.suffix_select(files_)
        .withColumn("format", F.lit(classify.WINDOWS_EVENTS))
        .withColumn("ord", order_key(_no_group(), F.col("path")))
    )
    return Discovery(_described(sources, "evtx_attack_samples"), EventTablePayload(events), (classify.WINDOWS_EVENTS,))


def cloud_trail(members: DataFrame, root: str = "") -> Discovery:
    """Unpacked members of tar archives, each a ``Records`` document (``flaws_cloud``)."""
    held = member_files(members, root)
    sources = held.drop("content").withColumn("format", F.lit(classify.JSON_ARRAY))
    return Discovery(_described(sources, "flaws_cloud"), RowPayload(held), (classify.JSON_ARRAY,))


def host_logs(members: DataFrame, root: str = "") -> Discovery:
    """Scenario archives: formats follow from the path inside the archive (``ait_lds``)."""
    held = member_files(members, root)
    sources = (
        held.drop("content").withColumn("format", classify.path_classify(F.col("member"))).where("format is not null")
    )
    kinds = (classify.ACCESS_LOG, classify.AUDITD, classify.JSON_LINES)
    return Discovery(_described(sources, "ait_lds"), RowPayload(held), kinds)


def vendor_fixtures(files_: DataFrame, payload) -> Discovery:
    """Pipeline samples of vendor packages (``elastic_fixtures``); ``file_name`` is the path in the checkout."""
    kind = classify.fixture_kind(F.col("file_name"))
    logs = files_.where(kind == classify.JSON_LINES)
    wrappers = files_.where(kind == classify.EVENTS_WRAPPER)
    probes = classify.is_json_lines(payload.lines(logs)).where("json_lines").select("path")
    usable = classify.has_normalizable_event(payload.texts(wrappers)).where("usable").select("path")
    chosen = (
        files_.withColumn("format", kind)
        .where("format is not null")
        .join(probes.unionByName(usable), "path", "left_semi")
        # All line files come before the wrapped ones.
        .withColumn("_group", F.when(F.col("format") == classify.JSON_LINES, F.lit("0")).otherwise("1"))
        .withColumn("ord", order_key(F.array("_group"), F.col("path")))
    )
    kinds = (classify.JSON_LINES, classify.EVENTS_WRAPPER)
    return Discovery(_described(chosen, "elastic_fixtures"), payload, kinds)


def attack_catalog(samples: DataFrame, files_: DataFrame, payload) -> Discovery:
    """Files listed by sample catalogues (``splunk_attack_data``).

    ``samples`` is the output of ``catalog_samples``; ``files_`` are those on
    disk, ``file_name`` their path in the checkout.
    """
    listed = classify.resolve_samples(samples, files_.select(F.col("file_name").alias("path")))
    position = F.array(F.lpad(F.col("pos").cast("string"), 10, "0"))
    placed = (
        listed.withColumnRenamed("path", "file_name")
        .join(files_.select("file_name", "path", "bytes", "checksum_sha256"), "file_name")
        .withColumn("ord", F.struct(path_order(F.col("manifest_path")).alias("a"), position.alias("b")))
    )
    probes = classify.probe(payload.lines(placed.select("path").distinct()))
    chosen = classify.sourcetype_classify(placed, probes).where("format is not null")
    kinds = (classify.JSON_LINES, classify.AUDITD, classify.XML_EVENTS)
    return Discovery(_described(chosen, "splunk_attack_data"), payload, kinds)


# --- real folders ------------------------------------------------------------------


def _members(spark: SparkSession, where, glob: str, **options) -> DataFrame:
    """Members of all archives, unpacked once and kept for the run."""
    found = archives.archive_members(files.read_contents(spark, where, glob), **options)
    return materialize(found, "members")


def discover(spark: SparkSession, dataset_id: str, root: str, only: list[str] | None = None) -> Discovery:
    """Sources of a dataset's raw folder, or of ``only`` some archives or event logs in it."""
    root = root.rstrip("/")
    where = only or root
    if dataset_id == "otrf":
        return archive_logs(_members(spark, where, "*.zip", opened_if=archives.HAS_DATA_FILE), root)
    if dataset_id == "evtx_attack_samples":
        found = files.relative_names(files.checksums(spark, where, "*.evtx"), root)
        return windows_events(found, evtx.decode_events(files.read_contents(spark, where, "*.evtx")))
    if dataset_id == "flaws_cloud":
        return cloud_trail(_members(spark, where, "*.tar", wanted=r".*\.gz", gunzip=True), root)
    if dataset_id == "ait_lds":
        return host_logs(_members(spark, where, "*.zip", wanted=HOST_LOG_MEMBER), root)
    if dataset_id == "elastic_fixtures":
        # Hidden folders are only listed when the pattern names them.
        where = f"{root}/packages/*/data_stream/*/_dev/test/pipeline/test-*.{{log,json}}"
        if only is not None:
            shape = re.compile(r".*/packages/[^/]+/data_stream/[^/]+/_dev/test/pipeline/test-[^/]*\.(?:log|json)")
            where = [p for p in only if shape.fullmatch(p)]
        found = files.checksums(spark, where) if where else spark.createDataFrame([], "path string, bytes bigint, checksum_sha256 string")
        return vendor_fixtures(files.relative_names(found, root), FilePayload(spark, where or root))
    if dataset_id == "splunk_attack_data":
        samples = catalogs.catalog_samples(files.read_texts(spark, f"{root}/datasets", "*.yml"))
        # A new catalogue may list files that came before it, so only data files can be looked at alone.
        where = root if only is None or any(p.lower().endswith(".yml") for p in only) else only
        present = files.relative_names(files.list_files(spark, where), root)
        listed = classify.resolve_samples(samples, present.select(F.col("file_name").alias("path")))
        names = listed.select(F.col("path").alias("file_name"))
        # Only listed files are read; the rest of the checkout is not even hashed.
        wanted = present.join(names, "file_name", "left_semi")
        found = files.relative_names(files.checksums(spark, root, wanted=wanted), root)
        return attack_catalog(samples, found, FilePayload(spark, root))
    raise LookupError(f"unknown dataset {dataset_id!r}")
