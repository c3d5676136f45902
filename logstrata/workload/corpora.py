"""Log corpora as column expressions over the given tables.

Each expression reads the same in Spark and in DuckDB, so a query and its check
start from one definition. Line corpora are ``(path, seq, line)``; a line takes
its bytes plus one, in ``seq`` order within its path. File corpora put a bounded
number of consecutive rows into each file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.functions.barrier import once

# Rows per derived file, so that no file grows with the tables.
FILE_ROWS = 400

_BUCKET = f"cast(floor(event_id / {FILE_ROWS}) as bigint)"


def _s(expression: str) -> str:
    return f"cast({expression} as string)"


AUDIT_LINE = (
    "case when event_id % 50 = 0 then '' else concat('type=', upper(event_type), ' msg=audit(', "
    "case when event_id % 10 = 3 then '11/02/2024 21:40:07.125' else concat(cast(1700000000 + event_id as string), '.337') end, "
    "':', cast(event_id as string), case when event_id % 10 = 3 then ') : pid=' else '): pid=' end, cast(user_id as string), "
    "' old-auid=', cast(event_id % 7 as string), ' comm=\"', event_type, ' x\" msg=', chr(39), 'op=PAM acct=\"u', "
    "cast(user_id as string), '\" res=success', chr(39), case when event_id % 6 = 0 then ' pid=0' else '' end) end"
)
ACCESS_LINE = (
    "concat('10.0.', cast(user_id % 256 as string), '.', cast(event_id % 256 as string), ' - u', cast(user_id as string), "
    "' [03/Feb/2021:18:05:44 +0000] \"', "
    "case when event_id % 17 = 0 then '-' else concat('GET /', event_type, '?id=', cast(event_id as string), ' HTTP/1.1') end, '\" ', "
    "case when event_type = 'error' then '404 ' else '200 ' end, case when event_id % 5 = 0 then '-' else cast(event_id as string) end, "
    "' \"-\" \"agent/', cast(event_id % 5 as string), '\"')"
)
JSON_OBJECT = (
    "concat('{\"eventName\": \"', event_type, '\", \"eventID\": ', cast(event_id as string), ', \"user\": {\"id\": ', "
    "cast(user_id as string), ', \"tags\": [\"a:b\", \"c\"]}, \"props\": ', props, '}')"
)
JSON_LINE = (
    "case when event_id % 40 = 0 then ' ' when event_id % 100 = 1 then '400' "
    "when event_id % 9 = 0 then concat('{\"eventName\": \"', event_type, '\"}') "
    "when user_id % 10 = 7 and event_id % 50 = 7 then '2026-01-01 host {\"a\": 1}' "
    f"else {JSON_OBJECT} end"
)
EVENT_ITEM = (
    "case event_id % 5 "
    "when 0 then concat('{\"message\":\"{', chr(92), '\"a', chr(92), '\":', cast(event_id as string), ',', chr(92), '\"b', chr(92), "
    "'\":', chr(92), '\"', event_type, chr(92), '\"}\"}') "
    "when 1 then concat('{\"json\":{\"id\":', cast(event_id as string), ',\"type\":\"', event_type, '\"}}') "
    "when 2 then '{\"@timestamp\":\"x\",\"ecs\":{\"version\":\"1\"}}' "
    "when 3 then concat('{\"@timestamp\":\"x\",\"json\":{\"z\":', cast(event_id as string), ',\"a\":1},\"tags\":[\"f\"]}') "
    "else concat('{\"message\":\"<', cast(event_id as string), '> raw text\"}') end"
)
# Text up to an event close: a whole event, after a cut-off one every 25 rows; every 40 rows a stray close.
XML_CHUNK = (
    "concat(case when event_id % 25 = 0 then '<Event xmlns=\"urn:x\"><System><EventID>1</EventID></Sys' else '' end, "
    "case when event_id % 40 = 7 then 'stray <Eventual/> text' else "
    "concat('<Event xmlns=\"urn:x\"><System><EventID>0', cast(event_id % 90 as string), '</EventID><EventRecordID>', "
    "cast(event_id as string), '</EventRecordID></System><EventData><Data Name=\"CommandLine\">', event_type, "
    "' 2>&1 &amp; u', cast(user_id as string), case when event_id % 30 = 11 then ' <broken' else '' end, '</Data></EventData>') end)"
)
WINDOWS_EVENT = (
    "case when event_id % 60 = 0 then 'invalid chunk' else concat('{\"Event\":{\"System\":{\"EventID\":', cast(event_id % 90 as string), "
    "',\"EventRecordID\":', cast(5000000000 + event_id as string), '},\"EventData\":{\"User\":\"u', cast(user_id as string), '\"}}}') end"
)
# A day's worth of formats: six kinds of sources tell the same instant in their own way.
START_MS = 1730419200000  # 2024-11-01
_AT = f"({START_MS} + (event_id * 13337 + (event_id % 7) * 61000 + cast(floor(event_id / 50) as bigint) * 60000000) % 2419200000)"
_TIME_KIND = "user_id % 6"


def _digits(ms: str, unit: int, count: int, width: int, first: int = 0) -> str:
    """One part of the clock or calendar, in so many digits."""
    return f"lpad(cast(cast(floor(({ms} - {START_MS}) / {unit}) as bigint) % {count} + {first} as string), {width}, '0')"


def _clock(ms: str) -> str:
    return f"{_digits(ms, 3600000, 24, 2)}, ':', {_digits(ms, 60000, 60, 2)}, ':', {_digits(ms, 1000, 60, 2)}"


def _day(ms: str) -> str:
    return _digits(ms, 86400000, 100, 2, 1)


_LATER = f"({_AT} + 7200000)"
_MILLIS = _digits(_AT, 1, 1000, 3)
_AUDIT_REST = "cast(event_id as string), ') : pid=', cast(user_id as string))"
# Every 97th line tells no time; some sources hold lines in another format, or a decoy.
TIMED_LINE = (
    f"case when event_id % 97 = 0 then concat('no time here ', cast(event_id as string)) "
    f"when {_TIME_KIND} = 0 and event_id % 40 <> 3 then concat('type=SYSCALL msg=audit(', cast(cast(floor({_AT} / 1000) as bigint) as string), '.', {_MILLIS}, ':', "
    "cast(event_id as string), '): note=\"2001-02-03 04:05:06\" pid=', cast(user_id as string)) "
    f"when {_TIME_KIND} = 0 or {_TIME_KIND} = 1 then concat('type=LOGIN msg=audit(11/', {_day(_AT)}, '/2024 ', {_clock(_AT)}, '.', {_MILLIS}, ':', {_AUDIT_REST} "
    f"when {_TIME_KIND} = 2 then concat('type=LOGIN msg=audit(', {_day(_AT)}, '/11/2024 ', {_clock(_AT)}, ':', {_AUDIT_REST} "
    f"when {_TIME_KIND} = 3 then concat('10.0.0.1 - u', cast(user_id as string), ' [', {_day(_LATER)}, '/Nov/2024:', {_clock(_LATER)}, ' +0200] \"GET /', event_type, ' HTTP/1.1\" 200 5 \"-\" \"-\"') "
    f"when {_TIME_KIND} = 4 and event_id % 3 = 0 then concat('{{\"eventTime\": \"2024-11-', {_day(_LATER)}, 'T', {_clock(_LATER)}, '.', {_MILLIS}, '0009+02:00\", \"id\": ', cast(event_id as string), '}}') "
    f"when {_TIME_KIND} = 4 then concat('{{\"eventTime\": \"2024-11-', {_day(_AT)}, 'T', {_clock(_AT)}, case when event_id % 3 = 1 then 'Z' else '' end, '\", \"id\": ', cast(event_id as string), '}}') "
    f"else concat('{{\"FileTime\": ', cast(116444736000000000 + {_AT} * 10000 as string), case when event_id % 5 = 0 then ', \"seen\": \"2020-01-01T00:00:00Z\"' else '' end, '}}') end"
)
HOSTS = 24
# Rows 400 apart end up in one file, so the bucket number decides what a file holds.
_ARCHIVE_KIND = f"{_BUCKET} % 4"
_HOST_KIND = f"{_BUCKET} % 8"
_SAMPLE_KIND = f"{_BUCKET} % 6"

# name -> (table, {column: expression})
CORPORA: dict[str, tuple[str, dict[str, str]]] = {
    "audit_lines": (
        "events",
        {"path": "concat('host', cast(user_id % 8 as string), '/logs/audit/audit.log')", "seq": "event_id", "line": AUDIT_LINE},
    ),
    "access_lines": (
        "events",
        {"path": "concat('web', cast(user_id % 4 as string), '/logs/apache2/access.log')", "seq": "event_id", "line": ACCESS_LINE},
    ),
    "json_lines": (
        "events",
        {"path": "concat('f', cast(user_id % 10 as string), '.log')", "seq": "event_id", "line": JSON_LINE},
    ),
    "event_items": (
        "events",
        {"path": f"concat('w/', {_s(_BUCKET)}, '.json')", "seq": "event_id", "line": EVENT_ITEM},
    ),
    "trail_items": (
        "events",
        {"path": f"concat('trail/', {_s(_BUCKET)}, '.json')", "seq": "event_id", "line": JSON_OBJECT},
    ),
    "xml_chunks": (
        "events",
        {
            "path": "case when event_id % 499 = 0 then concat('tail', cast(event_id as string), '.log') "
            "else concat('x', cast(user_id % 6 as string), '.log') end",
            "seq": "event_id",
            "chunk": XML_CHUNK,
            "terminated": "event_id % 499 <> 0",
        },
    ),
    "doc_files": (
        "documents",
        {"dataset_id": "'docs'", "file_name": "concat(source, '/', lang, '.txt')", "ord": "doc_id", "content": "text"},
    ),
    "csv_logical": (
        "customer",
        {
            "path": "concat('c', cast(c_nationkey % 5 as string), '.csv')",
            "seq": "c_custkey",
            "line": "concat(cast(c_custkey as string), ',\"', c_name, ' \"\"q\"\" ', case when c_custkey % 8 = 0 then chr(10) else '' end, "
            "c_mktsegment, '\",', cast(c_nationkey as string), case when c_custkey % 11 = 0 then ' 5\" disk' else '' end)",
        },
    ),
    "csv_headers": (
        "nation",
        {"path": "concat('c', cast(n_nationkey % 5 as string), '.csv')", "seq": "-1", "line": "'id,name,nation'"},
    ),
    "catalog_items": (
        "part",
        {
            "ord": "p_partkey",
            "path": "concat('/datasets/T', cast(p_size as string), '/s', cast(p_partkey as string), "
            "case p_partkey % 5 when 0 then '.json' when 1 then '.LOG' when 2 then '.xml' when 3 then '.pcap' else '.ndjson' end)",
            "sourcetype": "case p_partkey % 6 when 0 then ' XmlWinEventLog' when 1 then 'auditd' when 2 then 'vmw-syslog' "
            "when 3 then 'aws:cloudtrail' when 4 then 'sysmon:linux ' else 'o365' end",
            "labeled": "p_size % 3 <> 0",
        },
    ),
    "archive_names": (
        "part",
        {
            "archive": "concat('z', cast(p_size as string), '.zip')",
            "ord": "p_partkey",
            "member": "concat(case when p_partkey % 7 = 0 then '__MACOSX/._' else 'd/' end, 'm', cast(p_partkey as string), "
            "case when p_size % 4 = 0 then '.pcap' when p_partkey % 43 = 0 then '.json' else '.log' end)",
        },
    ),
    "windows_events": (
        "events",
        {"path": f"concat('cat', {_s(_BUCKET + ' % 5')}, '/s', {_s(_BUCKET)}, '.evtx')", "seq": "event_id", "line": WINDOWS_EVENT},
    ),
    "syslog_lines": (
        "events",
        {
            "path": "concat('var/log/h', cast(user_id % 6 as string))",
            "seq": "event_id",
            "line": f"concat('Nov ', case when {_day(_AT)} < '10' then concat(' ', substring({_day(_AT)}, 2, 1)) else {_day(_AT)} end, ' ', {_clock(_AT)}, ' h', "
            "cast(user_id % 6 as string), '.example.org ', case when event_id % 4 = 0 then 'kernel' else concat('app/', event_type, '[', cast(1 + user_id as string), ']') end, ': ', "
            "case event_id % 3 when 0 then 'WARN' when 1 then 'info' else 'Error' end, ' ', case when event_id % 29 = 0 then 'cut off' else concat('u', cast(user_id as string), "
            "'@mail.example.org https://u:p@10.1.', cast(user_id % 256 as string), '.7:8443/a/', event_type, '?id=', cast(event_id as string), '&x=[1] took ', cast(event_id % 90 as string), "
            "'.5 0a:1b:2c:3d:4e:', lpad(cast(event_id % 100 as string), 2, '0'), ' /var/lib/', event_type, '.d/f-', cast(event_id % 13 as string), ' (00000000-aaaa-4bbb-8ccc-', "
            "lpad(cast(event_id as string), 12, '0'), ')') end)",
        },
    ),
    "timed_lines": (
        "events",
        {"path": f"concat('host', cast(user_id % {HOSTS} as string), '/', cast({_TIME_KIND} as string))", "seq": "event_id", "line": TIMED_LINE},
    ),
    # From a minute to the whole time; every 16th ends before it begins.
    "attack_windows": (
        "supplier",
        {
            "window_id": "s_suppkey",
            "host": f"concat('host', cast(s_suppkey % {HOSTS} as string))",
            "technique": "concat('T', cast(1000 + s_nationkey as string))",
            "start_us": f"({START_MS} + (s_suppkey * 7919 * 1000) % 1209600000) * 1000",
            "end_us": f"({START_MS} + (s_suppkey * 7919 * 1000) % 1209600000 + case when s_suppkey % 100 = 7 then 2419200000 "
            "when s_suppkey % 16 = 3 then 0 when s_suppkey % 7 = 0 then 86400000 when s_suppkey % 2 = 0 then 3600000 else 60000 end) * 1000",
        },
    ),
    # Versions of what is known about a host; some appear at the same instant.
    "host_versions": (
        "part",
        {
            "host": f"concat('host', cast(p_partkey % {HOSTS - 1} as string))",
            "since_us": f"({START_MS} + 3600000 + (cast(floor(p_partkey / {HOSTS - 1}) as bigint) % 60 * 7200000)) * 1000",
            "version": "p_partkey",
            "license": "concat('L', cast(p_size as string))",
        },
    ),
    "host_paths": (
        "part",
        {
            "ord": "p_partkey",
            "member": "concat(case when p_partkey % 13 = 0 then 'labels' else 'gather' end, '/h', cast(p_size as string), '/', "
            "case when p_partkey % 17 = 0 then 'conf' else 'logs' end, '/', case p_partkey % 10 "
            "when 0 then 'apache2/access.log' when 1 then 'apache2/other_vhosts_access.log.2' when 2 then 'apache2/error.log' "
            "when 3 then 'horde/horde-access.log' when 4 then 'audit/audit.log' when 5 then 'audit/audit.log.wrong' "
            "when 6 then 'suricata/eve.json' when 7 then 'logstash/share/2022-system.cpu.log' "
            "when 8 then 'logstash/share/2022-system.service.log' else 'logstash/logstash-plain.log' end)",
        },
    ),
    "fixture_paths": (
        "part",
        {
            "ord": "p_partkey",
            "path": "concat(case when p_partkey % 6 = 0 then 'docs/' else 'packages/' end, 'pkg', cast(p_size as string), "
            "'/data_stream/ds', cast(p_partkey % 3 as string), '/_dev/test/pipeline/', case p_partkey % 7 "
            "when 0 then 'test-a.log' when 1 then 'test-a.json' when 2 then 'test-a.json-expected.json' when 3 then 'test-a.log-config.yml' "
            "when 4 then 'a.log' when 5 then 'sub/test-a.log' else 'sample.evtx' end)",
        },
    ),
    # --- rows of bounded files for the six datasets -------------------------------
    "archive_rows": (
        "events",
        {
            "archive": f"concat('cat', {_s(_BUCKET + ' % 3')}, '/z', {_s(_BUCKET)}, '.zip')",
            "member": f"case {_ARCHIVE_KIND} "
            "when 0 then case when user_id % 4 = 0 then '__MACOSX/d/._real.json' else 'd/real.json' end "
            "when 1 then concat('logs/m', cast(user_id % 3 as string), '.log') "
            "when 2 then 'cap.pcap' "
            "else case when user_id % 2 = 0 then 'sys.log' else 'notes.txt' end end",
            "seq": "event_id",
            "line": f"case when {_ARCHIVE_KIND} = 0 or ({_ARCHIVE_KIND} = 1 and user_id % 3 = 0) then "
            f"case when event_id % 40 = 0 then ' ' when event_id % 9 = 0 then '{{\"only\": 1}}' else {JSON_OBJECT} end "
            f"when ({_ARCHIVE_KIND} = 1 and user_id % 3 = 1) or {_ARCHIVE_KIND} = 3 then {AUDIT_LINE} "
            "else concat('#separator', chr(9), event_type) end",
        },
    ),
    "host_rows": (
        "events",
        {
            "archive": f"concat('sc', cast(cast(floor(event_id / {FILE_ROWS * 8}) as bigint) as string), '_no-pcaps.zip')",
            "member": f"concat('gather/h', {_s(_BUCKET + ' % 5')}, '/logs/', case {_HOST_KIND} "
            "when 0 then 'apache2/access.log' when 1 then 'audit/audit.log' when 2 then 'suricata/eve.json' "
            "when 3 then 'logstash/share/2022-system.cpu.log' when 4 then 'logstash/share/2022-system.service.log' "
            "when 5 then 'apache2/error.log' when 6 then 'horde/horde-access.log' else 'syslog' end)",
            "seq": "event_id",
            "line": f"case when {_HOST_KIND} in (0, 6) then {ACCESS_LINE} when {_HOST_KIND} = 1 then {AUDIT_LINE} "
            f"else {JSON_OBJECT} end",
        },
    ),
    "vendor_rows": (
        "events",
        {
            "path": f"concat('packages/p', {_s(_BUCKET)}, '/data_stream/d', cast(user_id % 2 as string), '/_dev/test/pipeline/', "
            f"case {_BUCKET} % 5 when 0 then 'test-a.log' when 1 then 'test-b.log' when 2 then 'test-a.json' "
            "when 3 then 'test-a.json-expected.json' else 'test-a.log-config.yml' end)",
            "seq": "event_id",
            "line": f"case {_BUCKET} % 5 when 0 then {JSON_OBJECT} "
            f"when 1 then case when event_id % 397 = 0 then 'syslog text' else {JSON_OBJECT} end "
            f"when 2 then {EVENT_ITEM} else '{{}}' end",
        },
    ),
    "sample_rows": (
        "events",
        {
            "path": f"concat('datasets/T', {_s(_BUCKET + ' % 7')}, '/s', {_s(_BUCKET)}, '.log')",
            "seq": "event_id",
            "line": f"case {_SAMPLE_KIND} when 0 then concat({XML_CHUNK}, '</Event>') when 1 then {AUDIT_LINE} "
            f"when 2 then {JSON_OBJECT} when 3 then {JSON_OBJECT} when 4 then {AUDIT_LINE} "
            "else concat('free text ', event_type) end",
        },
    ),
    # One listed sample per file of sample_rows; a tenth of the files is missing on disk.
    "sample_list": (
        "events",
        {
            "manifest_path": f"concat('datasets/T', {_s(_BUCKET + ' % 7')}, '/m', {_s(_BUCKET)}, case when {_BUCKET} % 13 = 5 "
            "then '/TEMPLATE.yml' else '/manifest.yml' end)",
            "bucket": _BUCKET,
            "path": f"concat('/datasets/T', {_s(_BUCKET + ' % 7')}, '/s', {_s(_BUCKET)}, '.log')",
            "sourcetype": f"case {_SAMPLE_KIND} when 0 then 'XmlWinEventLog ' when 1 then 'auditd' when 2 then 'aws:cloudtrail' "
            "when 3 then 'vmw-syslog' when 4 then 'linux:text' else 'stash' end",
            "previous": f"concat('/datasets/T', {_s(f'({_BUCKET} + 6) % 7')}, '/s', {_s(f'{_BUCKET} - 1')}, '.log')",
            "technique": f"case when {_BUCKET} % 3 = 0 then '[]' else '[\"T1234\"]' end",
        },
    ),
}


def corpus_sql(name: str) -> str:
    """The corpus as a plain SELECT over its table."""
    table, columns = CORPORA[name]
    return "select " + ", ".join(f"{e} as {c}" for c, e in columns.items()) + f" from {table}"


def corpus(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The corpus as a DataFrame."""
    table, columns = CORPORA[name]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    # Behind the barrier the columns behave like those of a scan.
    return once(rows, **{c: F.expr(e) for c, e in columns.items()}).select(*columns)


def joined_lines(rows: DataFrame, keys: list[str], separator: str = "\n", closing: str = "\n") -> DataFrame:
    """One bounded file per key: its lines in ``seq`` order."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("seq", "line"))), lambda x: x["line"])
    return rows.groupBy(*keys).agg(F.concat(F.array_join(ordered, separator), F.lit(closing)).alias("content"))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical lines of the CSV files: rows cut at the newlines inside their fields, after a header."""
    rows = corpus(spark, sf_dir, "csv_logical").unionByName(corpus(spark, sf_dir, "csv_headers").distinct())
    pieces = rows.select("path", "seq", F.posexplode_outer(F.split("line", "\n")).alias("_part", "line"))
    return pieces.select("path", (F.col("seq") * 2 + F.col("_part")).alias("seq"), "line")
