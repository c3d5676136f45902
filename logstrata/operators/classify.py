"""Which files hold which format: decided by path, catalogue entry and content.

Content probes are aggregates per path with map-side combine, so a file of any
size costs one scan and a few bytes per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata.functions import jsontext, kv, pytext
from logstrata.functions.barrier import once

JSON_LINES, AUDITD, ACCESS_LOG = "json_lines", "auditd", "access_log"
XML_EVENTS, JSON_ARRAY, EVENTS_WRAPPER, WINDOWS_EVENTS = "xml_events", "json_array", "events_wrapper", "windows_events"

# What a record ref counts, per format (fixed values).
REF_TYPES = {
    JSON_LINES: "byte_offset",
    AUDITD: "byte_offset",
    ACCESS_LOG: "byte_offset",
    XML_EVENTS: "byte_offset",
    JSON_ARRAY: "array_index",
    EVENTS_WRAPPER: "array_index",
    WINDOWS_EVENTS: "event_record_id",
}

# Catalogue sourcetypes with a known format (fixed values).
XML_SOURCETYPES = ("xmlwineventlog", "sysmon:linux")
AUDIT_SOURCETYPES = ("auditd",)
SKIPPED_SOURCETYPES = ("vmw-syslog", "msexchange:management")
CANDIDATE_SUFFIXES = (".json", ".ndjson", ".log", ".xml")


def record_ref_type(fmt: Column) -> Column:
    pairs = [F.lit(v) for kind in REF_TYPES.items() for v in kind]
    return F.element_at(F.create_map(*pairs), fmt)


def _probe_lines(lines: DataFrame) -> DataFrame:
    """Stripped lines that are not blank; a lone carriage return ends a line here too."""
    pieces = F.posexplode_outer(F.split("line", "\r"))
    parts = lines.select("path", "block", "seq", pieces.alias("piece", "part"))
    return once(parts, text=pytext.strip(F.col("part"))).where(F.length("text") > 0)


def probe(lines: DataFrame) -> DataFrame:
    """Per path with content: ``json_lines``, ``auditd`` and the ``first_char``, in one pass."""
    texts = _probe_lines(lines)
    position = F.struct("block", "seq", "piece")
    return (
        texts.select(
            "path",
            position.alias("position"),
            jsontext.is_json(F.col("text")).alias("valid"),
            F.struct(
                F.col("text").rlike(kv.AUDIT_PREFIX).alias("auditd"),
                F.substring("text", 1, 1).alias("first_char"),
            ).alias("opening"),
        )
        .groupBy("path")
        .agg(F.bool_and("valid").alias("json_lines"), F.min_by("opening", "position").alias("opening"))
        .select("path", "json_lines", "opening.auditd", "opening.first_char")
    )


def is_json_lines(lines: DataFrame) -> DataFrame:
    """Per path: at least one line that is not blank, and every one of them a JSON value."""
    parts = lines.select("path", F.explode_outer(F.split("line", "\r")).alias("part"))
    texts = once(parts, text=pytext.strip(F.col("part")))
    valid = F.when(F.length("text") > 0, jsontext.is_json(F.col("text")))
    return texts.groupBy("path").agg(F.coalesce(F.bool_and(valid), F.lit(False)).alias("json_lines"))


def _opening(lines: DataFrame, value: Column, name: str) -> DataFrame:
    first = F.min_by(value, F.struct("block", "seq", "piece"))
    return _probe_lines(lines).groupBy("path").agg(first.alias(name))


def looks_like_auditd(lines: DataFrame) -> DataFrame:
    """Per path with content: does its first line that is not blank carry the audit prefix?"""
    return _opening(lines, F.col("text").rlike(kv.AUDIT_PREFIX), "auditd")


def first_nonblank_char(lines: DataFrame) -> DataFrame:
    """Per path with content: the first character that is not whitespace."""
    return _opening(lines, F.substring("text", 1, 1), "first_char")


def sourcetype_classify(samples: DataFrame, probes: DataFrame) -> DataFrame:
    """Format of each catalogued sample ``(path, sourcetype)``, null when unsupported."""
    kind = F.lower(pytext.strip(F.coalesce("sourcetype", F.lit(""))))
    audit = F.when(F.col("auditd"), F.lit(AUDITD))
    fmt = (
        F.when(kind.isin(*SKIPPED_SOURCETYPES), F.lit(None).cast("string"))
        .when(kind.isin(*XML_SOURCETYPES), F.lit(XML_EVENTS))
        .when(kind.isin(*AUDIT_SOURCETYPES), audit)
        .when(F.col("first_char").isin("{", "["), F.when(F.col("json_lines"), F.lit(JSON_LINES)))
        .when(F.col("first_char") == "<", F.lit(XML_EVENTS))
        .otherwise(audit)
    )
    return samples.join(probes, "path", "left").withColumn("format", fmt).drop("json_lines", "auditd", "first_char")


def path_classify(member: Column) -> Column:
    """Format of a host log by its path inside the scenario archive, null when out of scope."""
    parts = F.split(member, "/")
    category, name = F.get(parts, F.lit(3)), F.element_at(parts, -1)
    in_logs = (F.size(parts) >= 4) & (F.get(parts, F.lit(0)) == "gather") & (F.get(parts, F.lit(2)) == "logs")
    return F.when(
        in_logs,
        F.when((category == "apache2") & F.contains(name, F.lit("access")), F.lit(ACCESS_LOG))
        .when((category == "horde") & (name == "horde-access.log"), F.lit(ACCESS_LOG))
        .when((category == "audit") & (name == "audit.log"), F.lit(AUDITD))
        .when((category == "suricata") & (name == "eve.json"), F.lit(JSON_LINES))
        .when(
            (category == "logstash") & (F.size(parts) == 6) & ~F.contains(name, F.lit("system.service")),
            F.lit(JSON_LINES),
        ),
    )


def is_junk_member(name: Column) -> Column:
    """Resource-fork leftovers that some archives carry next to the real files."""
    return F.array_contains(F.split(name, "/"), "__MACOSX") | F.startswith(pytext.basename(name), F.lit("._"))


def _is_candidate(name: Column) -> Column:
    return ~is_junk_member(name) & name.rlike(r"\.(?:json|log)\z")


def archive_candidates(members: DataFrame) -> DataFrame:
    """Archives ``(archive, member)`` worth opening, judged by member names alone."""
    return members.groupBy("archive").agg(F.bool_or(_is_candidate(F.col("member"))).alias("keep")).where("keep").drop("keep")


def archive_select(members: DataFrame, probes: DataFrame) -> DataFrame:
    """Files of each candidate archive with their format.

    ``members`` is ``(archive, member, path)``, ``probes`` describes the ``.log``
    files by path. A single JSON file is taken unprobed; several are reported as
    a problem row per archive; without one, each log is judged by its content.
    """
    opened = members.join(archive_candidates(members), "archive", "left_semi")
    # Inside an opened archive only the file's own name tells junk apart.
    real = opened.where(~F.startswith(pytext.basename(F.col("member")), F.lit("._")))
    ends = pytext.suffix(F.col("member"))
    counts = real.groupBy("archive").agg(F.count_if(ends == ".json").alias("json_files"))
    single = (F.col("json_files") == 1) & (ends == ".json")
    logs = (F.col("json_files") == 0) & (ends == ".log")
    fmt = F.when(single, F.lit(JSON_LINES)).when(
        logs, F.when(F.col("json_lines"), F.lit(JSON_LINES)).when(F.col("auditd"), F.lit(AUDITD))
    )
    files = (
        real.join(counts, "archive")
        .where(single | logs)
        .join(probes.select("path", "json_lines", "auditd"), "path", "left")
        .select("archive", "member", "path", fmt.alias("format"), F.lit(None).cast("string").alias("problem"))
        .where("format is not null")
    )
    several = counts.where("json_files > 1").select(
        "archive",
        F.lit(None).cast("string").alias("member"),
        F.lit(None).cast("string").alias("path"),
        F.lit(None).cast("string").alias("format"),
        F.concat(F.lit("several .json members in one archive: "), F.col("json_files").cast("string")).alias("problem"),
    )
    return files.unionByName(several)


# Fixed format: where a package keeps its pipeline samples.
_FIXTURE = r"(?s)\Apackages/[^/]+/data_stream/[^/]+/_dev/test/pipeline/test-[^/]*"
FIXTURE_LOG = _FIXTURE + r"\.log\z"
FIXTURE_JSON = _FIXTURE + r"\.json\z"


def fixture_kind(path: Column) -> Column:
    """Candidate format of a vendor sample by its path; expected outputs are no samples."""
    expected = F.endswith(path, F.lit("-expected.json"))
    return F.when(path.rlike(FIXTURE_LOG), F.lit(JSON_LINES)).when(
        path.rlike(FIXTURE_JSON) & ~expected, F.lit(EVENTS_WRAPPER)
    )


def has_normalizable_event(documents: DataFrame) -> DataFrame:
    """Per document ``(path, content)``: a JSON object with a list of events, one of them usable."""
    whole = jsontext.is_object(F.col("content"))
    usable = F.size("elements") > 0
    return jsontext.listed_events(documents).select("path", F.coalesce(whole & usable, F.lit(False)).alias("usable"))


def fixture_select(files: DataFrame, probes: DataFrame, documents: DataFrame) -> DataFrame:
    """Vendor samples whose content qualifies: ``files`` by path, then by what they hold."""
    kinds = files.withColumn("format", fixture_kind(F.col("path"))).where("format is not null")
    wrappers = has_normalizable_event(documents.where(fixture_kind(F.col("path")) == EVENTS_WRAPPER))
    return (
        kinds.join(probes.select("path", "json_lines"), "path", "left")
        .join(wrappers, "path", "left")
        .where(F.when(F.col("format") == JSON_LINES, F.col("json_lines")).otherwise(F.col("usable")))
        .drop("json_lines", "usable")
    )


def suffix_select(files: DataFrame, ending: str = ".evtx") -> DataFrame:
    return files.where(F.endswith("path", F.lit(ending)))


def sample_candidates(catalog: DataFrame) -> DataFrame:
    """Distinct catalogued paths whose extension could be a supported format."""
    pattern = r"(?:" + "|".join(s.replace(".", r"\.") for s in CANDIDATE_SUFFIXES) + r")\z"
    return (
        catalog.where(F.lower("path").rlike(pattern)).select("path").distinct().select(F.ltrim(F.col("path"), F.lit("/")).alias("path"))
    )


def resolve_samples(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Catalogue entries whose file exists; the leading slash of their path is dropped."""
    located = catalog.where("path is not null and path <> ''").withColumn("path", F.ltrim(F.col("path"), F.lit("/")))
    return located.join(files.select("path").distinct(), "path", "left_semi")


def missing_samples(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Catalogue entries whose file does not exist: expected drift, reported rather than raised."""
    located = catalog.where("path is not null and path <> ''").withColumn("path", F.ltrim(F.col("path"), F.lit("/")))
    return located.join(files.select("path").distinct(), "path", "left_anti")


def passes_quality(skip_non_dict: bool = True, minimum_fields: int | None = 4) -> Column:
    """Is the record an object with enough fields? Either check can be switched off."""
    keep = F.col("is_object") if skip_non_dict else F.lit(True)
    return keep if minimum_fields is None else keep & (F.col("field_count") >= minimum_fields)


def quality_filter(records: DataFrame, skip_non_dict: bool = True, minimum_fields: int | None = 4) -> DataFrame:
    """Drop records that are no objects and records with too few fields."""
    return records.where(passes_quality(skip_non_dict, minimum_fields))
