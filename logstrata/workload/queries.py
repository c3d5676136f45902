"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.functions import jsontext, kv, pytext, xmltext
from logstrata.operators import catalog, classify, corpus, cubes, difference, eventtime, formats, framing, ordering, profile, sessions, shards, timejoins
from logstrata.plans import datasets
from logstrata.plans.ingest import parse_new
from logstrata.plans.payloads import RowPayload
from logstrata.session import configure, materialize, scratch_path
from logstrata.sources import archives, catalogs, datasource, files
from logstrata.streaming import sessions as arriving
from logstrata.workload import corpora, packing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARD_SIZE = 1_000
MINIMUM_FIELDS = 4


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def lines_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return framing.with_block(corpora.corpus(spark, sf_dir, name))


# --- framing and formats --------------------------------------------------------------


@query
def line_offsets(spark, sf_dir):
    framed = framing.line_offsets(lines_of(spark, sf_dir, "audit_lines"))
    return framed.select("path", "seq", "byte_offset", F.octet_length("line").alias("octets"))


@query
def json_lines_scan(spark, sf_dir):
    records = formats.json_lines(lines_of(spark, sf_dir, "json_lines"))
    return records.select("path", "record_ref", "record_json", "field_count", "is_object", "problem")


@query
def auditd_scan(spark, sf_dir):
    records = formats.checked(formats.auditd(lines_of(spark, sf_dir, "audit_lines")))
    return records.select("path", "record_ref", jsontext.record_to_json(F.col("record_json")).alias("record_json"), "field_count")


@query
def access_log_scan(spark, sf_dir):
    fields = formats.checked(formats.grok_fields(lines_of(spark, sf_dir, "access_lines"), formats.COMBINED_ACCESS))
    return fields.select("path", "record_ref", "fields.*")


GROK_PATTERN = r'%{IPV4:ip} - %{USER:account} \[%{HTTPDATE:at}\] "%{DATA:call}" %{INT:status} %{GREEDYDATA:rest}'


@query
def grok_extract(spark, sf_dir):
    fields = formats.grok_fields(lines_of(spark, sf_dir, "access_lines"), GROK_PATTERN)
    return fields.select("path", "record_ref", "fields.*", "problem")


SYSLOG_PATTERN = (
    r"%{SYSLOGBASE} %{LOGLEVEL:level} %{EMAILADDRESS:mail} %{URI:uri} took %{BASE10NUM:took} %{MAC:mac} %{PATH:file} \(%{UUID:id}\)"
)


@query
def grok_syslog(spark, sf_dir):
    """Syslog lines by the general pattern names; lines that were cut off are problems."""
    fields = formats.grok_fields(lines_of(spark, sf_dir, "syslog_lines"), SYSLOG_PATTERN)
    return fields.select("path", "record_ref", "fields.*", "problem")


@query
def csv_scan(spark, sf_dir):
    records = formats.checked(formats.csv(framing.with_block(corpora.csv_lines(spark, sf_dir))))
    return records.select("path", "record_ref", jsontext.record_to_json(F.col("record_json")).alias("record_json"), "field_count")


def trail_documents(spark, sf_dir):
    joined = corpora.joined_lines(corpora.corpus(spark, sf_dir, "trail_items"), ["path"], ",", "")
    return joined.select("path", F.concat(F.lit('{"Records":['), "content", F.lit("]}")).alias("content"))


@query
def json_array_explode(spark, sf_dir):
    records = formats.checked(formats.json_array(trail_documents(spark, sf_dir)))
    return records.select("path", "record_ref", jsontext.record_to_json(F.col("record_json")).alias("record_json"), "field_count")


def event_documents(spark, sf_dir):
    joined = corpora.joined_lines(corpora.corpus(spark, sf_dir, "event_items"), ["path"], ",", "")
    return joined.select("path", F.concat(F.lit('{"events":['), "content", F.lit("]}")).alias("content"))


@query
def events_wrapper_explode(spark, sf_dir):
    records = formats.checked(formats.events_wrapper(event_documents(spark, sf_dir)))
    return records.select("path", "record_ref", "record_json", "field_count")


@query
def xml_event_split(spark, sf_dir):
    events = framing.xml_event_split(lines_of(spark, sf_dir, "xml_chunks"))
    return events.select("path", "record_ref", F.col("event").cast("string").alias("event"))


@query
def xml_truncated_events(spark, sf_dir):
    return framing.xml_truncated_events(lines_of(spark, sf_dir, "xml_chunks"))


@query
def xml_event_records(spark, sf_dir):
    records = formats.xml_events(lines_of(spark, sf_dir, "xml_chunks"))
    return records.select("path", "record_ref", "record_json", "field_count")


@query
def xml_event_fields(spark, sf_dir):
    fields = formats.xml_event_fields(lines_of(spark, sf_dir, "xml_chunks")).where("event_id is not null")
    named = F.element_at(F.filter("data", lambda d: d["_Name"] == "CommandLine"), 1)
    return fields.select("path", "record_ref", "event_id", "event_record_id", named["_VALUE"].alias("command_line"))


def block_files(spark, lines: DataFrame, line: str) -> str:
    """A folder with a file for each block of each path."""
    folder = scratch_path(spark, "files")
    rows = lines.repartition("path", "block").sortWithinPartitions("path", "block", "seq").select("path", "block", F.col(line).alias("value"))
    rows.write.partitionBy("path", "block").option(*files.COMMIT_BY_TASKS).text(folder)
    return folder


def sourced(spark, name: str, folder: str) -> DataFrame:
    """Records of a folder through a data source, with the path and block that its files are named by."""
    datasource.register(spark)
    found = spark.read.format(name).load(folder)
    place = F.url_decode(F.regexp_extract("path", r"path=([^/]*)/", 1))
    block = F.regexp_extract("path", r"block=(\d+)/", 1).cast("bigint")
    return found.select(place.alias("path"), block.alias("block"), "record_ref", "record_json", "field_count")


@query
def audit_source(spark, sf_dir):
    return sourced(spark, "audit_log", block_files(spark, lines_of(spark, sf_dir, "audit_lines"), "line"))


@query
def event_xml_source(spark, sf_dir):
    """Events of XML files, each chunk of which ends a line."""
    chunks = lines_of(spark, sf_dir, "xml_chunks")
    closed = F.concat("chunk", F.when(F.col("terminated"), F.lit(framing.EVENT_CLOSE)).otherwise(F.lit("")))
    return sourced(spark, "event_xml", block_files(spark, chunks.withColumn("text", closed), "text"))


@query
def windows_event_records(spark, sf_dir):
    decoded = lines_of(spark, sf_dir, "windows_events").withColumnRenamed("line", "event")
    return formats.checked(formats.windows_events(decoded)).select("path", "record_ref", "record_json", "field_count")


# --- archives and catalogues ----------------------------------------------------------


def archive_files(spark, sf_dir):
    return corpora.joined_lines(corpora.corpus(spark, sf_dir, "archive_rows"), ["archive", "member"])


def unpacked(spark, sf_dir, name, **options):
    packed = packing.pack(corpora.joined_lines(corpora.corpus(spark, sf_dir, name), ["archive", "member"]))
    return materialize(archives.archive_members(packed, **options), "members")


@query
def archive_members(spark, sf_dir):
    members = unpacked(spark, sf_dir, "archive_rows")
    return members.select(
        "archive", "member", F.octet_length("content").alias("bytes"), files.file_checksum(F.col("content")).alias("checksum_sha256")
    )


@query
def gz_members(spark, sf_dir):
    texts = corpora.corpus(spark, sf_dir, "doc_files")
    packed = texts.select(
        F.concat("file_name", F.lit("#"), F.col("ord").cast("string"), F.lit(".gz")).alias("path"),
        packing.gzipped(F.col("content").cast("binary")).alias("content"),
    )
    return archives.gz_members(packed).select(
        "path", F.octet_length("content").alias("bytes"), files.file_checksum(F.col("content")).alias("checksum_sha256")
    )


def catalog_documents(spark, sf_dir):
    """One YAML document per manifest (JSON text is YAML), listing its own and the previous sample."""

    def entry(name, path):
        return F.concat(
            F.lit(f'{{"name": "{name}", "path": "'), path, F.lit('", "sourcetype": "'), "sourcetype", F.lit('"}')
        )

    listed = corpora.corpus(spark, sf_dir, "sample_list").distinct()
    return listed.select(
        F.col("manifest_path").alias("path"),
        F.concat(
            F.lit('{"mitre_technique": '), "technique", F.lit(', "datasets": ['), entry("own", F.col("path")), F.lit(", "),
            entry("previous", F.col("previous")), F.lit("]}"),
        ).alias("content"),
    )


@query
def catalog_samples(spark, sf_dir):
    return catalogs.catalog_samples(catalog_documents(spark, sf_dir))


# --- classification -------------------------------------------------------------------


@query
def is_json_lines(spark, sf_dir):
    return classify.is_json_lines(lines_of(spark, sf_dir, "json_lines"))


@query
def looks_like_auditd(spark, sf_dir):
    both = lines_of(spark, sf_dir, "audit_lines").unionByName(lines_of(spark, sf_dir, "json_lines"))
    return classify.looks_like_auditd(both)


@query
def first_nonblank_char(spark, sf_dir):
    both = lines_of(spark, sf_dir, "access_lines").unionByName(lines_of(spark, sf_dir, "json_lines"))
    return classify.first_nonblank_char(both)


def sample_files(spark, sf_dir):
    rows = corpora.corpus(spark, sf_dir, "sample_rows")
    present = F.floor(F.col("seq") / corpora.FILE_ROWS) % 10 != 9
    held = corpora.joined_lines(rows.where(present), ["path"])
    described = held.select(
        "path",
        F.col("path").alias("file_name"),
        F.octet_length("content").cast("bigint").alias("bytes"),
        files.file_checksum(F.col("content")).alias("checksum_sha256"),
        "content",
    )
    return materialize(described, "samples")


@query
def sourcetype_classify(spark, sf_dir):
    held = sample_files(spark, sf_dir)
    samples = classify.resolve_samples(catalogs.catalog_samples(catalog_documents(spark, sf_dir)), held)
    probes = classify.probe(files.content_lines(held))
    return classify.sourcetype_classify(samples, probes).select("manifest_path", "pos", "path", "sourcetype", "format")


@query
def path_classify(spark, sf_dir):
    paths = corpora.corpus(spark, sf_dir, "host_paths")
    return paths.select("ord", "member", classify.path_classify(F.col("member")).alias("format"))


@query
def normalize_event(spark, sf_dir):
    items = corpora.corpus(spark, sf_dir, "event_items")
    return jsontext.normalized_events(items.select("path", "seq", "line"), "line").drop("line")


@query
def has_normalizable_event(spark, sf_dir):
    documents = event_documents(spark, sf_dir).unionByName(trail_documents(spark, sf_dir))
    return classify.has_normalizable_event(documents)


@query
def junk_member_filter(spark, sf_dir):
    names = corpora.corpus(spark, sf_dir, "archive_names")
    return names.where(~classify.is_junk_member(F.col("member")))


@query
def archive_candidates(spark, sf_dir):
    return classify.archive_candidates(corpora.corpus(spark, sf_dir, "archive_names"))


@query
def archive_select(spark, sf_dir):
    held = datasets.member_files(archive_files(spark, sf_dir))
    probes = classify.probe(files.content_lines(held.where(F.endswith("member", F.lit(".log")))))
    # The name-only corpus adds archives with several JSON members, reported as problems.
    names = corpora.corpus(spark, sf_dir, "archive_names").select("archive", "member", F.concat_ws("/", "archive", "member").alias("path"))
    members = held.select("archive", "member", "path").unionByName(names)
    return classify.archive_select(members, probes)


def vendor_files(spark, sf_dir):
    rows = corpora.corpus(spark, sf_dir, "vendor_rows")
    wrapper = F.endswith("path", F.lit(".json"))
    plain = corpora.joined_lines(rows.where(~wrapper), ["path"])
    joined = corpora.joined_lines(rows.where(wrapper), ["path"], ",", "")
    wrapped = joined.select("path", F.concat(F.lit('{"events":['), "content", F.lit("]}")).alias("content"))
    return materialize(plain.unionByName(wrapped).withColumn("file_name", F.col("path")), "vendor")


@query
def fixture_select(spark, sf_dir):
    held = vendor_files(spark, sf_dir)
    probes = classify.is_json_lines(files.content_lines(held.where(F.endswith("path", F.lit(".log")))))
    return classify.fixture_select(held.select("path"), probes, held.select("path", "content"))


@query
def suffix_select(spark, sf_dir):
    return classify.suffix_select(corpora.corpus(spark, sf_dir, "fixture_paths"))


@query
def sample_candidates(spark, sf_dir):
    return classify.sample_candidates(corpora.corpus(spark, sf_dir, "catalog_items"))


@query
def resolve_samples(spark, sf_dir):
    listed = corpora.corpus(spark, sf_dir, "catalog_items")
    on_disk = listed.where("ord % 10 <> 0").select(F.ltrim(F.col("path"), F.lit("/")).alias("path"))
    return classify.resolve_samples(listed, on_disk)


@query
def label_sources(spark, sf_dir):
    listed = corpora.corpus(spark, sf_dir, "catalog_items").select("path", "labeled")
    hosts = corpora.corpus(spark, sf_dir, "host_paths").select(F.col("member").alias("path"))
    named = datasets.label_sources(listed, "splunk_attack_data").unionByName(datasets.label_sources(hosts, "ait_lds"))
    return named.select("dataset_id", "path", "source_url", "license", "labeled")


@query
def quality_filter(spark, sf_dir):
    records = formats.json_lines(lines_of(spark, sf_dir, "json_lines"))
    return classify.quality_filter(records).select("path", "record_ref", "field_count")


# --- functions ------------------------------------------------------------------------


@query
def count_fields(spark, sf_dir):
    events = corpora.corpus(spark, sf_dir, "windows_events").unionByName(corpora.corpus(spark, sf_dir, "event_items"))
    return events.select("path", "seq", jsontext.count_fields(F.col("line")).alias("field_count"))


@query
def kv_tokens(spark, sf_dir):
    lines = corpora.corpus(spark, sf_dir, "audit_lines")
    tokens = lines.select("path", "seq", F.posexplode_outer(kv.kv_tokens(F.col("line"))).alias("pos", "token")).where("pos is not null")
    return tokens.select("path", "seq", "pos", "token.key", "token.value")


@query
def unquote(spark, sf_dir):
    lines = corpora.corpus(spark, sf_dir, "audit_lines")
    tokens = lines.select("path", "seq", F.posexplode_outer(kv.kv_tokens(F.col("line"))).alias("pos", "token")).where("pos is not null")
    return tokens.select("path", "seq", "pos", kv.unquote(F.col("token.value")).alias("value"))


@query
def escape_bare_amp(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    repaired = xmltext.escape_bare_amp(F.concat("html", F.lit(" "), "url", F.lit("&copy=1 &#x41; &#66; &")))
    return pages.select("page_id", F.octet_length(repaired).alias("octets"), F.sha2(repaired, 256).alias("repaired_sha256"))


@query
def file_checksum(spark, sf_dir):
    texts = corpora.corpus(spark, sf_dir, "doc_files")
    return texts.select("ord", files.file_checksum(F.col("content")).alias("checksum_sha256"), F.octet_length("content").alias("bytes"))


@query
def record_to_json(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    record = F.to_json(F.struct("doc_id", "lang", "text", F.struct("source").alias("meta")))
    written = texts.select("doc_id", jsontext.record_to_json(record).alias("line"))
    return written.select(
        F.get_json_object("line", "$.doc_id").cast("bigint").alias("doc_id"),
        F.get_json_object("line", "$.lang").alias("lang"),
        F.get_json_object("line", "$.meta.source").alias("source"),
        F.sha2(F.get_json_object("line", "$.text"), 256).alias("text_sha256"),
        (F.octet_length("line") == F.length("line")).alias("ascii_only"),
        F.substring_index("line", ":", 2).alias("opening"),
    )


@query
def relative_name(spark, sf_dir):
    names = corpora.corpus(spark, sf_dir, "archive_names")
    path = F.concat(F.lit("/data/raw/set/"), pytext.stem_dir(F.col("archive")), F.lit("/"), "member")
    return names.select("ord", pytext.relative_to(path, "/data/raw/set").alias("file_name"))


@query
def shard_name(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return parts.select("p_partkey", pytext.shard_name(F.col("p_partkey") * 97).alias("shard_name"))


# --- catalogue ------------------------------------------------------------------------


def doc_files(spark, sf_dir):
    texts = corpora.corpus(spark, sf_dir, "doc_files")
    described = texts.select(
        "dataset_id", "file_name", "ord", F.octet_length("content").cast("bigint").alias("bytes"),
        files.file_checksum(F.col("content")).alias("checksum_sha256"),
    )
    return materialize(described, "docs")


def earlier_manifest(spark, docs):
    """Manifest of an earlier run that saw only part of the files."""
    seen = docs.where("ord % 3 = 0")
    none = catalog.empty_manifest(spark)
    new = catalog.incremental_new_files(catalog.assign_source_id(seen, none), none)
    return new.select("source_id", "checksum_sha256", "bytes")


@query
def assign_source_id(spark, sf_dir):
    docs = doc_files(spark, sf_dir)
    identified = catalog.assign_source_id(docs, earlier_manifest(spark, docs))
    return identified.select("ord", "source_id", "checksum_sha256")


@query
def collision_report(spark, sf_dir):
    return catalog.collision_report(catalog.assign_source_id(doc_files(spark, sf_dir), catalog.empty_manifest(spark)))


@query
def incremental_new_files(spark, sf_dir):
    docs = doc_files(spark, sf_dir)
    manifest = earlier_manifest(spark, docs)
    identified = catalog.assign_source_id(docs, manifest)
    return catalog.incremental_new_files(identified, manifest).select("ord", "source_id")


def log_sources(spark, sf_dir):
    """The audit and JSON line corpora as one dataset of files."""
    def described(name, fmt):
        paths = corpora.corpus(spark, sf_dir, name).select("path").distinct()
        return paths.withColumn("format", F.lit(fmt))

    both = described("audit_lines", classify.AUDITD).unionByName(described("json_lines", classify.JSON_LINES))
    return both.withColumn("source_id", F.concat(F.lit("logs/"), "path")).withColumn("source_ord", catalog.path_order(F.col("path")))


def log_records(spark, sf_dir, corpus_name=None):
    """Surviving records of both corpora, or of one."""
    parsers = {"audit_lines": formats.auditd, "json_lines": formats.json_lines}
    parsed = None
    for name, parser in parsers.items():
        if corpus_name in (None, name):
            one = parser(lines_of(spark, sf_dir, name))
            parsed = one if parsed is None else parsed.unionByName(one)
    kept = classify.quality_filter(parsed.where("problem is null"), minimum_fields=MINIMUM_FIELDS)
    return kept.select("path", "block", "position", "record_ref", "record_json")


def numbered(spark, sf_dir, corpus_name=None, first=0):
    records = materialize(log_records(spark, sf_dir, corpus_name), "records")
    return shards.global_index(records, log_sources(spark, sf_dir), first)


@query
def manifest_build(spark, sf_dir):
    sources = datasets.label_sources(log_sources(spark, sf_dir), "ait_lds").withColumnsRenamed({"path": "file_name"})
    sized = lines_of(spark, sf_dir, "audit_lines").unionByName(lines_of(spark, sf_dir, "json_lines"))
    sizes = sized.groupBy(F.col("path").alias("file_name")).agg(F.sum(F.octet_length("line") + 1).alias("bytes"))
    described = sources.join(sizes, "file_name").withColumn("checksum_sha256", F.sha2("file_name", 256))
    records = log_records(spark, sf_dir).select(F.concat(F.lit("logs/"), "path").alias("source_id"))
    return catalog.manifest_build(described, records).drop("ingested_at")


def manifest_versions(spark, sf_dir):
    """Two successive writes per name: the documents as they came, then those with a label."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    first = docs.select(name.alias("source_id"), F.col("n_chars").alias("record_count"), F.lit(False).alias("labeled"), F.col("doc_id").alias("version"))
    later = docs.join(labels, "doc_id").select(
        name.alias("source_id"), F.col("quality").cast("bigint").alias("record_count"), F.lit(True).alias("labeled"),
        (F.col("doc_id") + (1 << 40)).alias("version"),
    )
    return first, later


@query
def manifest_upsert(spark, sf_dir):
    return catalog.manifest_upsert(*manifest_versions(spark, sf_dir))


@query
def manifest_sorted(spark, sf_dir):
    held = catalog.manifest_upsert(*manifest_versions(spark, sf_dir))
    placed = ordering.ordered_prefix(held.select("source_id", "record_count"), ["source_id"], F.lit(1), "place")
    return catalog.manifest_sorted(placed)


@query
def ingest_summary(spark, sf_dir):
    marked = log_sources(spark, sf_dir).withColumn("is_new", F.col("format") == classify.JSON_LINES)
    records = formats.json_lines(lines_of(spark, sf_dir, "json_lines")).where("problem is null")
    return catalog.ingest_summary(marked, records, classify.quality_filter(records))


@query
def source_order(spark, sf_dir):
    paths = corpora.corpus(spark, sf_dir, "fixture_paths").select("path").distinct()
    keyed = paths.withColumn("parts", catalog.path_order(F.col("path")))
    return ordering.ordered_prefix(keyed, ["parts"], F.lit(1), "place").select("path", "place")


# --- numbering and shards -------------------------------------------------------------


def indexed_records(spark, sf_dir):
    return numbered(spark, sf_dir)


def sharded_records(spark, sf_dir):
    assigned = shards.shard_assign(indexed_records(spark, sf_dir), SHARD_SIZE)
    return shards.shard_offsets(shards.shard_lines(assigned))


def log_index(spark, sf_dir):
    sharded = materialize(sharded_records(spark, sf_dir), "placed")
    return sharded, shards.source_dictionary(sharded)


@query
def global_index(spark, sf_dir):
    return indexed_records(spark, sf_dir).select("source_id", "record_ref", "idx")


@query
def shard_assign(spark, sf_dir):
    """Two runs: the audit records first, then the JSON records continue the last shard."""
    size = SHARD_SIZE
    first = shards.shard_assign(numbered(spark, sf_dir, "audit_lines"), size)
    state = first.agg(F.count(F.lit(1)).alias("n"), F.max("shard_id").alias("last"))
    total, last = state.select("n").scalar(), state.select("last").scalar()
    # Every shard but the last one is full.
    held = state.select(F.col("n") - F.col("last") * size).scalar()
    later = numbered(spark, sf_dir, "json_lines", total)
    second = (
        later.withColumn("_first", total)
        .withColumn("_last", last)
        .withColumn("_held", held)
        .transform(lambda d: shards.shard_assign(d, size, F.col("_first"), F.col("_last"), F.col("_held")))
    )
    columns = ["source_id", "record_ref", "idx", "shard_id"]
    return first.select(*columns).unionByName(second.select(*columns))


@query
def shard_offsets(spark, sf_dir):
    return sharded_records(spark, sf_dir).select("idx", "shard_id", "offset")


@query
def source_dictionary(spark, sf_dir):
    """Ids of a second run continue those of the first, which saw the JSON records only."""
    earlier = shards.source_dictionary(numbered(spark, sf_dir, "json_lines"))
    return shards.source_dictionary(indexed_records(spark, sf_dir), earlier)


@query
def shard_write(spark, sf_dir):
    """Shard files written and read back: what the index says lies at each offset, by the bytes of the files.

    A line is found by its place in the file; index and dictionary tell which record it is.
    """
    sharded, dictionary = log_index(spark, sf_dir)
    path = scratch_path(spark, "shards")
    shards.write_corpus(sharded, dictionary, path)
    found = shards.read_corpus(spark, path)
    return found.groupBy("shard_name").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.octet_length("line") + 1).alias("bytes"),
        F.min_by("line", "idx").alias("first_line"),
        F.max_by("line", "offset").alias("last_line"),
        F.count_distinct("source_id").alias("sources"),
        F.max_by("source_id", "offset").alias("last_source"),
    )


# --- corpus reads ---------------------------------------------------------------------


@query
def corpus_count(spark, sf_dir):
    sharded, dictionary = log_index(spark, sf_dir)
    return corpus.corpus_count(shards.shard_index(sharded, dictionary))


@query
def fetch_by_index(spark, sf_dir):
    sharded, dictionary = log_index(spark, sf_dir)
    wanted = spark.read.parquet(f"{sf_dir}/customer.parquet").select((F.col("c_custkey") * 13 - 100).alias("idx"))
    return corpus.fetch_by_index(wanted, shards.shard_index(sharded, dictionary), sharded)


@query
def indices_for_source(spark, sf_dir):
    sharded, dictionary = log_index(spark, sf_dir)
    names = corpora.corpus(spark, sf_dir, "json_lines").select(F.concat(F.lit("logs/"), "path").alias("source_id")).distinct()
    unknown = names.select(F.concat("source_id", F.lit(".bak")).alias("source_id"))
    return corpus.indices_for_source(names.unionByName(unknown), shards.shard_index(sharded, dictionary), dictionary)


@query
def provenance_join(spark, sf_dir):
    sharded, dictionary = log_index(spark, sf_dir)
    manifest = datasets.label_sources(log_sources(spark, sf_dir), "ait_lds").select(
        "source_id", "source_url", "license", "labeled", classify.record_ref_type(F.col("format")).alias("record_ref_type")
    )
    return corpus.provenance(shards.shard_index(sharded, dictionary), dictionary, manifest)


@query
def index_frame(spark, sf_dir):
    return shards.shard_index(*log_index(spark, sf_dir))


@query
def resolve_records(spark, sf_dir):
    """Every second offset asked for is that of a record, the others hit nothing."""
    records = formats.checked(formats.auditd(lines_of(spark, sf_dir, "audit_lines")))
    framed = framing.line_offsets(lines_of(spark, sf_dir, "audit_lines"))
    wanted = framed.select("path", (F.col("byte_offset") + F.col("seq") % 2).alias("record_ref"))
    found = corpus.resolve_records(wanted, records)
    return found.select("path", "record_ref", F.get_json_object("record_json", "$.audit_id").alias("audit_id"))


# --- what is in a corpus --------------------------------------------------------------


def described_records(spark, sf_dir) -> DataFrame:
    """Records of two datasets: ``(dataset, path, record_ref, record_json)``."""
    parsed = {"json": formats.json_lines(lines_of(spark, sf_dir, "json_lines")).where("is_object")}
    parsed["auditd"] = formats.checked(formats.auditd(lines_of(spark, sf_dir, "audit_lines")))
    named = [r.select(F.lit(n).alias("dataset"), "path", "record_ref", "record_json") for n, r in parsed.items()]
    return named[0].unionByName(named[1])


@query
def structure_profile(spark, sf_dir):
    return profile.structure_profile(described_records(spark, sf_dir), ["dataset", "path"], ["record_ref"])


@query
def top_fields(spark, sf_dir):
    """The five most frequent values of every field, found through summaries of 50 counters a task."""
    values = profile.field_values(described_records(spark, sf_dir), ["dataset"])
    return profile.top_values(values, ["dataset", "field"], "value", 5, counters=50)


@query
def corpus_diff(spark, sf_dir):
    """Two runs over the same logs: the later one lacks some records, holds some twice and has some changed."""
    columns = ["path", "record_ref", "record_json"]
    first = formats.json_lines(lines_of(spark, sf_dir, "json_lines")).where("is_object").select(*columns)
    changed = F.when(F.col("record_ref") % 1009 == 5, F.replace("record_json", F.lit("a:b"), F.lit("b:a"))).otherwise(F.col("record_json"))
    later = first.where("record_ref % 997 <> 3").withColumn("record_json", changed)
    later = later.unionByName(later.where("record_ref % 1013 = 7"))
    runs = [scratch_path(spark, f"run{i}") for i in range(2)]
    for records, path in zip((first, later), runs):
        difference.write_run(records, columns, path)
    return difference.corpus_diff(spark, *runs, columns)


def catalogued(spark, sf_dir) -> DataFrame:
    rows = corpora.corpus(spark, sf_dir, "doc_files")
    name = F.split("file_name", "/")
    return rows.select(
        name[0].alias("source"), name[1].alias("file"), (F.col("ord") % 3 == 0).alias("labeled"),
        F.octet_length("content").cast("bigint").alias("bytes"), files.file_checksum(F.col("content")).alias("checksum"),
    )


@query
def manifest_cube(spark, sf_dir):
    dimensions = ["source", "file", "labeled"]
    return cubes.exact_cube(catalogued(spark, sf_dir), dimensions, cubes.all_sets(dimensions), ["bytes"], ["checksum"])


@query
def manifest_sketch(spark, sf_dir):
    """Distinct checksums from sketches, judged against the exact ones: within four standard errors."""
    dimensions = ["source", "file"]
    rows, sets = materialize(catalogued(spark, sf_dir), "catalogued"), cubes.rollup_sets(dimensions)
    near = cubes.sketch_cube(rows, dimensions, sets, ["checksum"]).withColumnRenamed("distinct_checksum", "estimate")
    exact = cubes.exact_cube(rows, dimensions, sets, [], ["checksum"]).drop("rows")
    place = [near[c].eqNullSafe(exact[c]) for c in (*dimensions, "grouping")]
    both = near.join(exact, place[0] & place[1] & place[2]).select(near["source"], near["file"], near["grouping"], "rows", "estimate", "distinct_checksum")
    allowed = 4 * cubes.SKETCH_ERROR * F.col("distinct_checksum") + 1
    return both.select("source", "file", "grouping", "rows", (F.abs(F.col("estimate") - F.col("distinct_checksum")) <= allowed).alias("within"))


# --- time -----------------------------------------------------------------------------


def timed_events(spark, sf_dir) -> DataFrame:
    """Lines of six kinds of sources with the instant each tells, and their host."""
    timed = eventtime.event_times(lines_of(spark, sf_dir, "timed_lines"))
    return timed.withColumn("host", F.substring_index("path", "/", 1))


@query
def event_time(spark, sf_dir):
    timed = timed_events(spark, sf_dir)
    return timed.select("path", "seq", "time_format", F.unix_micros("event_time").alias("event_us"), "time_problem")


@query
def interval_label_join(spark, sf_dir):
    """Events inside the attack windows of their host."""
    events = timed_events(spark, sf_dir).select("host", "path", "seq", "event_time")
    windows = corpora.corpus(spark, sf_dir, "attack_windows")
    windows = windows.select("host", "window_id", "technique", *[F.timestamp_micros(f"{c}_us").alias(c) for c in ("start", "end")])
    held = timejoins.interval_join(events, windows, "event_time", "start", "end", on=["host"])
    return held.select("path", "seq", F.unix_micros("event_time").alias("event_us"), "window_id", "technique")


@query
def asof_manifest(spark, sf_dir):
    """Every event with the catalogue version that was valid for its host."""
    events = timed_events(spark, sf_dir).select("host", "path", "seq", F.unix_micros("event_time").alias("event_us"))
    versions = corpora.corpus(spark, sf_dir, "host_versions")
    return timejoins.asof_join(events, versions, "event_us", "since_us", on=["host"])


HOUR = 3_600_000_000


@query
def host_sessions(spark, sf_dir):
    events = timed_events(spark, sf_dir).select("host", "event_time", F.octet_length("line").cast("bigint").alias("octets"))
    return sessions.sessions(events, ["host"], "event_time", HOUR // 4, sums=["octets"])


STREAM_DELAY = 9 * HOUR


@query
def stream_sessions(spark, sf_dir):
    """The hosts' sessions from a stream of three batches; every 11th row comes with the last one, and may be late."""
    events = timed_events(spark, sf_dir).select(
        F.col("host").alias("source"), F.unix_micros("event_time").alias("at"), F.col("seq").alias("ref"),
        F.octet_length("line").cast("bigint").alias("value"),
    )
    third = F.floor((F.col("at") - corpora.START_MS * 1000) / (28 * 8 * HOUR))
    batch = F.when(F.col("ref") % 11 == 0, 2).otherwise(F.least(third, F.lit(2))).cast("int")
    events = materialize(events.where("at is not null").withColumn("batch", batch), "arriving")
    batches = [events.where(F.col("batch") == n).drop("batch") for n in range(3)]
    return arriving.replay(spark, batches, scratch_path(spark, "stream"), gap=HOUR // 4, delay=STREAM_DELAY)


def _windows(spark, sf_dir, size: int, slide: int) -> DataFrame:
    events = timed_events(spark, sf_dir).select("host", "event_time", F.octet_length("line").cast("bigint").alias("octets"))
    parts = sessions.panes(events, ["host"], "event_time", HOUR, "octets")
    return sessions.windows_of_panes(parts, ["host"], HOUR, size, slide)


@query
def tumbling_windows(spark, sf_dir):
    return _windows(spark, sf_dir, 6 * HOUR, 6 * HOUR)


@query
def sliding_windows(spark, sf_dir):
    return _windows(spark, sf_dir, 24 * HOUR, 3 * HOUR)


# --- whole datasets -------------------------------------------------------------------


def ingested(spark, found) -> DataFrame:
    """Manifest of one run over discovered sources."""
    marked, parsed = parse_new(found, catalog.empty_manifest(spark))
    new = marked.where("is_new")
    counted = parsed.where("kept").groupBy("path").agg(F.count(F.lit(1)).alias("record_count"))
    return catalog.manifest_rows(new.join(counted, "path", "left")).drop("ingested_at")


def archive_discovery(spark, sf_dir):
    return datasets.archive_logs(unpacked(spark, sf_dir, "archive_rows", opened_if=archives.HAS_DATA_FILE))


@query
def ingest_archive_logs(spark, sf_dir):
    return ingested(spark, archive_discovery(spark, sf_dir))


@query
def ingest_windows_events(spark, sf_dir):
    rows = corpora.corpus(spark, sf_dir, "windows_events")
    held = corpora.joined_lines(rows, ["path"])
    listed = held.select(
        "path", F.col("path").alias("file_name"), F.octet_length("content").cast("bigint").alias("bytes"),
        files.file_checksum(F.col("content")).alias("checksum_sha256"),
    )
    return ingested(spark, datasets.windows_events(listed, rows.withColumnRenamed("line", "event")))


@query
def ingest_cloud_trail(spark, sf_dir):
    documents = trail_documents(spark, sf_dir)
    packed = packing.pack(
        documents.select(
            F.regexp_replace("path", r"trail/(\d+)\d\.json|trail/\d\.json", "trails$1.tar").alias("archive"),
            F.concat("path", F.lit(".gz")).alias("member"),
            packing.gzipped(F.col("content").cast("binary")).alias("content"),
        )
    )
    members = materialize(archives.archive_members(packed, wanted=r".*\.gz", gunzip=True), "members")
    return ingested(spark, datasets.cloud_trail(members))


@query
def ingest_host_logs(spark, sf_dir):
    return ingested(spark, datasets.host_logs(unpacked(spark, sf_dir, "host_rows", wanted=datasets.HOST_LOG_MEMBER)))


@query
def ingest_vendor_fixtures(spark, sf_dir):
    held = vendor_files(spark, sf_dir).withColumn("bytes", F.octet_length("content").cast("bigint"))
    held = held.withColumn("checksum_sha256", files.file_checksum(F.col("content")))
    return ingested(spark, datasets.vendor_fixtures(held.drop("content"), RowPayload(held)))


@query
def ingest_attack_catalog(spark, sf_dir):
    held = sample_files(spark, sf_dir)
    samples = catalogs.catalog_samples(catalog_documents(spark, sf_dir))
    return ingested(spark, datasets.attack_catalog(samples, held.drop("content"), RowPayload(held)))


@query
def ingest_dataset(spark, sf_dir):
    """A second run over host logs, of which the access logs were ingested before."""
    found = datasets.host_logs(unpacked(spark, sf_dir, "host_rows", wanted=datasets.HOST_LOG_MEMBER))
    none = catalog.empty_manifest(spark)
    found = replace(found, sources=materialize(found.sources, "discovered"))
    identified = catalog.assign_source_id(found.sources, none)
    manifest = identified.where(F.col("format") == classify.ACCESS_LOG)
    marked, parsed = parse_new(found, manifest)
    return catalog.ingest_summary(marked, parsed, parsed.where("kept"))
