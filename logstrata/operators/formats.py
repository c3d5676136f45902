"""Record formats: framed input to ``(path, block, position, record_ref, record_json, field_count, is_object)``.

``position`` orders the records of a file, ``record_ref`` finds one again.
``problem`` says why a row could not be parsed; ``checked`` turns it into an
error (``failfast``) or leaves it for the caller to split off (``quarantine``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata.functions import jsontext, kv, pytext, strictjson, xmltext
from logstrata.functions.barrier import once
from logstrata.operators import framing

RECORD_COLUMNS = ["path", "block", "position", "record_ref", "record_json", "field_count", "is_object", "problem"]


def checked(records: DataFrame, mode: str = "failfast") -> DataFrame:
    """``failfast`` raises on the first unparsable row; ``quarantine`` keeps it with its ``problem``."""
    if mode == "quarantine":
        return records
    if mode != "failfast":
        raise ValueError(f"unknown mode {mode!r}")
    message = F.concat_ws(" ", F.lit("record"), "record_ref", F.lit("of"), "path", F.lit("-"), "problem")
    raised = F.when(F.col("problem").isNotNull(), F.raise_error(message).cast("string"))
    # Held together, so that a filter on the others cannot drop the row before it is reported.
    judged = [c for c in ("is_object", "field_count") if c in records.columns]
    return once(records, **{c: F.col(c) for c in judged}, problem=raised)


def _judged_fields(variant: Column, text: Column) -> Column:
    """Key/value pairs of a guarded text, null when it is not one JSON value in UTF-8."""
    parsed = F.when(jsontext.is_guarded(variant, text), jsontext.variant_fields(variant))
    count = strictjson.judged(F.when(F.is_valid_utf8(text), parsed), F.when(F.is_valid_utf8(text), text))
    return count.cast("int")


def _json_records(rows: DataFrame, text: str, problem: str) -> DataFrame:
    source = F.col(text)
    parsed = once(rows, _variant=jsontext.guarded(source))
    judged = once(parsed, field_count=_judged_fields(F.col("_variant"), source)).withColumn("_ok", F.col("field_count").isNotNull())
    return (
        judged.withColumn("record_json", F.when(F.col("_ok"), F.trim(source, F.lit(" \t\r\n"))))
        .withColumn("is_object", F.col("_ok") & jsontext.is_object(source))
        .withColumn("problem", F.when(~F.col("_ok"), F.lit(problem)))
        .withColumn("position", F.col("record_ref"))
        .select(*RECORD_COLUMNS)
    )


def json_lines(lines: DataFrame) -> DataFrame:
    """One JSON value per line that is not blank."""
    framed = framing.line_offsets(lines).where(pytext.has_bytes(F.col("line")))
    return _json_records(framed.withColumn("record_ref", F.col("byte_offset")), "line", "not a JSON value")


def _decoded(raw: Column, encoding: str) -> Column:
    return raw if encoding.upper() == "UTF-8" else F.decode(raw.cast("binary"), encoding)


def _text_lines(lines: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Lines without their ends; only empty ones are skipped. Offsets count the bytes on disk."""
    return (
        framing.line_offsets(lines)
        .withColumn("text", pytext.chomp(_decoded(F.col("line"), encoding)))
        .where(F.octet_length("text") > 0)
        .withColumn("record_ref", F.col("byte_offset"))
        .withColumn("position", F.col("byte_offset"))
    )


def _problem(text: Column, failed: Column, reason: str) -> Column:
    return F.when(~F.is_valid_utf8(text), F.lit("not UTF-8")).when(failed, F.lit(reason))


def auditd_fields(lines: DataFrame) -> DataFrame:
    """``type=… msg=audit(…): k=v …`` lines with their fields as a map."""
    parts = F.col("parts")
    prefix = F.map_from_arrays(F.array(F.lit("type"), F.lit("epoch"), F.lit("audit_id")), F.slice(parts, 1, 3))
    split = once(_text_lines(lines), parts=kv.audit_parts(F.col("text")))
    return once(split, fields=F.map_concat(prefix, kv.kv_map(parts[3]))).withColumn(
        "problem", _problem(F.col("text"), F.col("fields").isNull(), "no audit prefix")
    )


def auditd(lines: DataFrame) -> DataFrame:
    return (
        auditd_fields(lines)
        .withColumn("record_json", F.to_json("fields"))
        .withColumn("field_count", F.when(F.col("fields").isNotNull(), F.size("fields")))
        .withColumn("is_object", F.col("fields").isNotNull())
        .select(*RECORD_COLUMNS)
    )


# Fixed patterns, by their public grok names: words and numbers, hosts, paths, dates, syslog, access logs.
GROK = {
    "USERNAME": r"[a-zA-Z0-9._-]+",
    "USER": r"%{USERNAME}",
    "EMAILLOCALPART": r"[a-zA-Z0-9!#$%&'*+\-/=?^_`{|}~]{1,64}(?:\.[a-zA-Z0-9!#$%&'*+\-/=?^_`{|}~]{1,62}){0,63}",
    "EMAILADDRESS": r"%{EMAILLOCALPART}@%{HOSTNAME}",
    "HTTPDUSER": r"(?:[a-zA-Z0-9!#$&'*+\-/=?^_`{|}~.]+@%{HOSTNAME}|%{USER})",
    "INT": r"[+-]?[0-9]+",
    "BASE10NUM": r"(?<![0-9.+-])[+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)",
    "NUMBER": r"[+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)",
    "BASE16NUM": r"(?<![0-9A-Fa-f])(?:[+-]?(?:0x)?[0-9A-Fa-f]+)",
    "BASE16FLOAT": r"\b(?<![0-9A-Fa-f.])(?:[+-]?(?:0x)?(?:[0-9A-Fa-f]+(?:\.[0-9A-Fa-f]*)?|\.[0-9A-Fa-f]+))\b",
    "POSINT": r"\b[1-9][0-9]*\b",
    "NONNEGINT": r"\b[0-9]+\b",
    "WORD": r"\b\w+\b",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "QS": r"""(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+'|`[^`\\]*+(?:\\.[^`\\]*+)*+`)""",
    "QUOTEDSTRING": r"%{QS}",
    "UUID": r"[A-Fa-f0-9]{8}-(?:[A-Fa-f0-9]{4}-){3}[A-Fa-f0-9]{12}",
    "URN": r"urn:[0-9A-Za-z][0-9A-Za-z-]{0,31}:(?:%[0-9a-fA-F]{2}|[0-9A-Za-z()+,.:=@;$_!*'/?#-])+",
    "CISCOMAC": r"(?:[A-Fa-f0-9]{4}\.){2}[A-Fa-f0-9]{4}",
    "WINDOWSMAC": r"(?:[A-Fa-f0-9]{2}-){5}[A-Fa-f0-9]{2}",
    "COMMONMAC": r"(?:[A-Fa-f0-9]{2}:){5}[A-Fa-f0-9]{2}",
    "MAC": r"(?:%{CISCOMAC}|%{WINDOWSMAC}|%{COMMONMAC})",
    "IPV4": r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])",
    "IPV6": r"(?=[0-9A-Fa-f.]*:)[0-9A-Fa-f:.]+(?:%[0-9A-Za-z]+)?",
    "IP": r"(?:%{IPV6}|%{IPV4})",
    "HOSTNAME": r"\b[0-9A-Za-z][0-9A-Za-z-]{0,62}(?:\.[0-9A-Za-z][0-9A-Za-z-]{0,62})*(?:\.?|\b)",
    "HOST": r"%{HOSTNAME}",
    "IPORHOST": r"(?:%{IP}|%{HOSTNAME})",
    "HOSTPORT": r"%{IPORHOST}:%{POSINT}",
    "UNIXPATH": r"(?:/[\w_%!$@:.,+~-]*)+",
    "WINPATH": r"(?:[A-Za-z]+:|\\)(?:\\[^\\?*]*)+",
    "PATH": r"(?:%{UNIXPATH}|%{WINPATH})",
    "TTY": r"/dev/(?:pts|tty(?:[pq])?)(?:\w+)?/?(?:[0-9]+)",
    "URIPROTO": r"[A-Za-z](?:[A-Za-z0-9+\-.]+)+",
    "URIHOST": r"%{IPORHOST}(?::%{POSINT})?",
    "URIPATH": r"(?:/[A-Za-z0-9$.+!*'(){},~:;=@#%&_\-]*)+",
    "URIQUERY": r"[A-Za-z0-9$.+!*'|(){},~@#%&/=:;_?\-\[\]<>]*",
    "URIPARAM": r"\?%{URIQUERY}",
    "URIPATHPARAM": r"%{URIPATH}(?:%{URIPARAM})?",
    "URI": r"%{URIPROTO}://(?:%{USER}(?::[^@]*)?@)?(?:%{URIHOST})?(?:%{URIPATHPARAM})?",
    "MONTH": r"\b(?:[Jj]an(?:uary)?|[Ff]eb(?:ruary)?|[Mm]ar(?:ch)?|[Aa]pr(?:il)?|[Mm]ay|[Jj]une?|[Jj]uly?|[Aa]ug(?:ust)?|[Ss]ep(?:tember)?|[Oo]ct(?:ober)?|[Nn]ov(?:ember)?|[Dd]ec(?:ember)?)\b",
    "MONTHNUM": r"(?:0?[1-9]|1[0-2])",
    "MONTHNUM2": r"(?:0[1-9]|1[0-2])",
    "MONTHDAY": r"(?:0[1-9]|[12][0-9]|3[01]|[1-9])",
    "DAY": r"(?:Mon(?:day)?|Tue(?:sday)?|Wed(?:nesday)?|Thu(?:rsday)?|Fri(?:day)?|Sat(?:urday)?|Sun(?:day)?)",
    "YEAR": r"(?:[0-9]{2}){1,2}",
    "HOUR": r"(?:2[0123]|[01]?[0-9])",
    "MINUTE": r"[0-5][0-9]",
    "SECOND": r"(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?",
    "TIME": r"(?:2[0123]|[01]?[0-9]):[0-5][0-9](?::(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?)?",
    "DATE_US": r"%{MONTHNUM}[/-]%{MONTHDAY}[/-]%{YEAR}",
    "DATE_EU": r"%{MONTHDAY}[./-]%{MONTHNUM}[./-]%{YEAR}",
    "DATE": r"(?:%{DATE_US}|%{DATE_EU})",
    "DATESTAMP": r"%{DATE}[- ]%{TIME}",
    "ISO8601_TIMEZONE": r"(?:Z|[+-]%{HOUR}(?::?%{MINUTE}))",
    "ISO8601_SECOND": r"%{SECOND}",
    "TIMESTAMP_ISO8601": r"%{YEAR}-%{MONTHNUM}-%{MONTHDAY}[T ]%{HOUR}:?%{MINUTE}(?::?%{SECOND})?(?:%{ISO8601_TIMEZONE})?",
    "TZ": r"(?:[APMCE][SD]T|UTC)",
    "DATESTAMP_RFC822": r"%{DAY} %{MONTH} %{MONTHDAY} %{YEAR} %{TIME} %{TZ}",
    "DATESTAMP_RFC2822": r"%{DAY}, %{MONTHDAY} %{MONTH} %{YEAR} %{TIME} %{ISO8601_TIMEZONE}",
    "DATESTAMP_OTHER": r"%{DAY} %{MONTH} %{MONTHDAY} %{TIME} %{TZ} %{YEAR}",
    "DATESTAMP_EVENTLOG": r"%{YEAR}%{MONTHNUM2}%{MONTHDAY}%{HOUR}%{MINUTE}%{SECOND}",
    "HTTPDATE": r"%{MONTHDAY}/%{MONTH}/%{YEAR}:%{TIME} %{INT}",
    "SYSLOGTIMESTAMP": r"%{MONTH} +%{MONTHDAY} %{TIME}",
    "PROG": r"[\x21-\x5a\x5c\x5e-\x7e]+",
    "SYSLOGPROG": r"%{PROG:program}(?:\[%{POSINT:pid}\])?",
    "SYSLOGHOST": r"%{IPORHOST}",
    "SYSLOGFACILITY": r"<%{NONNEGINT:facility}\.%{NONNEGINT:priority}>",
    "SYSLOGBASE": r"%{SYSLOGTIMESTAMP:timestamp} (?:%{SYSLOGFACILITY} )?%{SYSLOGHOST:logsource} %{SYSLOGPROG}:",
    "LOGLEVEL": r"(?:[Aa]lert|ALERT|[Tt]race|TRACE|[Dd]ebug|DEBUG|[Nn]otice|NOTICE|[Ii]nfo|INFO|[Ww]arn(?:ing)?|WARN(?:ING)?|[Ee]rr(?:or)?|ERR(?:OR)?|[Cc]rit(?:ical)?|CRIT(?:ICAL)?|[Ff]atal|FATAL|[Ss]evere|SEVERE|[Ee]merg(?:ency)?|EMERG(?:ENCY)?)",
    "COMMONAPACHELOG": (
        r"%{IPORHOST:clientip} %{HTTPDUSER:ident} %{USER:auth} \[%{HTTPDATE:timestamp}\] "
        r'"(?:%{WORD:verb} %{NOTSPACE:request}(?: HTTP/%{NUMBER:httpversion})?|%{DATA:rawrequest})" '
        r"%{NUMBER:response} (?:%{NUMBER:bytes}|-)"
    ),
    "COMBINEDAPACHELOG": r"%{COMMONAPACHELOG} %{QS:referrer} %{QS:agent}",
}
COMBINED_ACCESS = "%{COMBINEDAPACHELOG}"


def grok_regex(pattern: str) -> tuple[str, list[str]]:
    """A grok pattern as a Java regex over a whole line, and its field names in order."""
    names: list[str] = []

    def expand(match: re.Match) -> str:
        body = re.sub(r"%\{(\w+)(?::(\w+))?\}", expand_or_name, GROK[match[1]])
        return body

    def expand_or_name(match: re.Match) -> str:
        if match[1] not in GROK:
            raise ValueError(f"unknown grok pattern {match[1]!r}")
        if not match[2]:
            return f"(?:{expand(match)})"
        if match[2] not in names:
            names.append(match[2])
        return f"({expand(match)})"

    body = re.sub(r"%\{(\w+)(?::(\w+))?\}", expand_or_name, pattern)
    if "%{" in body:
        # A type suffix or a misspelt item would otherwise be matched as literal text.
        raise ValueError(f"unsupported grok item in {pattern!r}")
    return rf"(?Us)\A(?:{body})\z", names


def grok_fields(lines: DataFrame, pattern: str, encoding: str = "UTF-8") -> DataFrame:
    """One column per pattern field, null where an optional part is absent."""
    regex, names = grok_regex(pattern)
    split = once(_text_lines(lines, encoding), parts=pytext.capture(F.col("text"), regex, len(names)))
    values = [F.nullif(F.col("parts")[i], F.lit("")).alias(n) for i, n in enumerate(names)]
    problem = _problem(F.col("text"), F.col("parts").isNull(), "pattern does not match")
    return split.withColumn("problem", problem).withColumn("fields", F.struct(*values))


def grok(lines: DataFrame, pattern: str = COMBINED_ACCESS, encoding: str = "UTF-8") -> DataFrame:
    fields = grok_fields(lines, pattern, encoding)
    matched = F.col("problem").isNull()
    width = len(fields.schema["fields"].dataType)
    return (
        fields.withColumn("record_json", F.when(matched, F.to_json("fields", {"ignoreNullFields": "false"})))
        .withColumn("field_count", F.when(matched, F.lit(width)))
        .withColumn("is_object", matched)
        .select(*RECORD_COLUMNS)
    )


_CSV_FIELD = r'(?s)("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+),'


def csv_fields(text: Column) -> Column:
    """Fields of one CSV record as an array of strings."""
    raw = F.regexp_extract_all(F.concat(text, F.lit(",")), F.lit(_CSV_FIELD), F.lit(1))

    def plain(field: Column) -> Column:
        body = F.regexp_extract(field, r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"', 1)
        rest = F.regexp_extract(field, r'(?s)\A"[^"]*+(?:""[^"]*+)*+"(.*)\z', 1)
        return F.when(F.startswith(field, F.lit('"')), F.concat(F.replace(body, F.lit('""'), F.lit('"')), rest)).otherwise(field)

    return F.transform(raw, plain)


def csv(lines: DataFrame, encoding: str = "UTF-8", row_bytes: int = framing.CSV_ROW_BYTES) -> DataFrame:
    """Header row names the fields; a row with another width is a problem, and one of more than ``row_bytes`` bytes."""
    decoded = framing.csv_rows(lines, row_bytes).withColumn("text", _decoded(F.col("text"), encoding))
    rows = once(decoded, values=csv_fields(pytext.chomp(F.col("text"))))
    header = rows.where("record_ref = 0").select("path", F.col("values").alias("names"))
    width = F.when(F.col("text").rlike(r"\A[\r\n]*\z"), 0).otherwise(F.size("values"))
    fields = F.when((width == F.size("names")) & ~F.col("too_long"), F.map_from_arrays("names", "values"))
    reason = F.when(F.col("too_long"), F.lit(f"row of more than {row_bytes} bytes, perhaps a quote left open"))
    return (
        rows.where("record_ref > 0")
        .join(header, "path")
        .withColumn("fields", fields)
        .withColumn("record_json", F.to_json("fields"))
        .withColumn("field_count", F.when(F.col("fields").isNotNull(), F.size("fields")))
        .withColumn("is_object", F.col("fields").isNotNull())
        .withColumn("problem", F.coalesce(reason, _problem(F.col("text"), F.col("fields").isNull(), "row width differs from the header")))
        .withColumn("position", F.col("record_ref"))
        .select(*RECORD_COLUMNS)
    )


def _exploded(documents: DataFrame, problem: str) -> DataFrame:
    """One record per ``(text, typed)`` element; a document without a list leaves one problem row."""
    bad = F.col("elements").isNull()
    spread = documents.select("path", bad.alias("_bad"), F.posexplode_outer("elements").alias("pos", "element"))
    # An empty list leaves nothing at all.
    records = once(spread.where("pos is not null or _bad"), element=F.col("element"))
    at = F.coalesce("pos", F.lit(0)).cast("bigint")
    return records.select(
        "path",
        F.lit(0).cast("bigint").alias("block"),
        at.alias("position"),
        at.alias("record_ref"),
        F.col("element.text").alias("record_json"),
        F.when(~F.col("_bad"), jsontext.text_fields(F.col("element.typed"))).alias("field_count"),
        F.coalesce(F.startswith("element.typed", F.lit("{")), F.lit(False)).alias("is_object"),
        F.when(F.col("_bad"), F.lit(problem)).alias("problem"),
    )


def json_array(documents: DataFrame) -> DataFrame:
    """``{"Records": […]}`` documents: the ref is the position in the list."""
    return _exploded(jsontext.listed(documents, "Records"), "no Records list")


def events_wrapper(documents: DataFrame) -> DataFrame:
    """``{"events": […]}`` documents: the ref counts the events that survive normalisation."""
    return _exploded(jsontext.listed_events(documents), "no events list")


def xml_events(chunks: DataFrame) -> DataFrame:
    """Windows event XML of any shape; malformed events are skipped."""
    repaired = F.encode(
        xmltext.escape_bare_amp(F.decode(F.col("event"), "ISO-8859-1")), "ISO-8859-1"
    )
    return (
        once(framing.xml_event_split(chunks).withColumn("_json", xmltext.xml_to_json(repaired)), record_json=F.col("_json"))
        .where("record_json is not null")
        .withColumn("field_count", jsontext.count_fields(F.col("record_json")))
        .withColumn("is_object", F.lit(True))
        .withColumn("problem", F.lit(None).cast("string"))
        .withColumn("position", F.col("record_ref"))
        .select(*RECORD_COLUMNS)
    )


SYSTEM_SCHEMA = (
    "System struct<EventID string, EventRecordID string, Computer string, Channel string>, "
    "EventData struct<Data array<struct<_Name string, _VALUE string>>>"
)


def xml_event_fields(chunks: DataFrame) -> DataFrame:
    """Common fields of well-shaped events, parsed inside the JVM with an all-string schema."""
    text = xmltext.escape_bare_amp(F.decode(F.col("event"), "UTF-8"))
    parsed = F.from_xml(text, F.lit(SYSTEM_SCHEMA), {"mode": "PERMISSIVE"})
    return (
        framing.xml_event_split(chunks)
        .withColumn("e", parsed)
        .select(
            "path",
            "record_ref",
            F.col("e.System.EventID").alias("event_id"),
            F.col("e.System.EventRecordID").alias("event_record_id"),
            F.col("e.EventData.Data").alias("data"),
        )
    )


def windows_events(decoded: DataFrame) -> DataFrame:
    """Decoded event JSON keyed by its record id; entries that did not decode are skipped."""
    text = F.col("event")
    parsed = once(decoded, _variant=jsontext.guarded(text))
    # Read from the text itself where the parser refused the whole of it.
    record_id = F.regexp_extract(text, r'"EventRecordID"\s*+:\s*+"?+(\d++)', 1)
    judged = once(
        parsed,
        field_count=_judged_fields(F.col("_variant"), text),
        record_ref=F.when(
            F.col("_variant").isNull(), F.nullif(record_id, F.lit("")).try_cast("bigint")
        ).otherwise(F.try_variant_get("_variant", "$[0].Event.System.EventRecordID", "bigint")),
    )
    return (
        judged.where(F.col("field_count").isNotNull() & jsontext.is_object(text))
        .withColumn("record_json", text)
        .withColumn("is_object", F.lit(True))
        .withColumn("problem", F.when(F.col("record_ref").isNull(), F.lit("no EventRecordID")))
        .withColumn("position", F.col("seq"))
        .select(*RECORD_COLUMNS)
    )
