"""Plain SQL for each query over the same tables, written without the engine's operators."""

from __future__ import annotations

from logstrata.plans.datasets import DATASETS
from logstrata.workload.corpora import FILE_ROWS, START_MS, corpus_sql

ORACLES: dict[str, str] = {}


def check(name: str, body: str, *tables: str, **views: str) -> None:
    """Register a check: ``tables`` are corpora, ``views`` further subqueries in order."""
    parts = [f"{t} as ({corpus_sql(t)})" for t in tables]
    parts += [f"{view} as ({sql})" for view, sql in views.items()]
    ORACLES[name] = (f"with {', '.join(parts)} " if parts else "") + body


def framed(table: str) -> str:
    return (
        "select *, cast(coalesce(sum(strlen(line) + 1) over (partition by path order by seq "
        f"rows between unbounded preceding and 1 preceding), 0) as bigint) as record_ref from {table}"
    )


def fields(text: str) -> str:
    bare = rf"""regexp_replace({text}, '"(?:[^"\\]|\\.)*"', '', 'g')"""
    return f"cast(length({bare}) - length(replace({bare}, ':', '')) as int)"


AUDIT_RE = r"'^type=(\S+) msg=audit\((.+):(\d+)\)\s*:'"
AUDIT_JSON = (
    """concat('{"type": "', regexp_extract(line, %(p)s, 1), '", "epoch": "', regexp_extract(line, %(p)s, 2), '", "audit_id": "', """
    """regexp_extract(line, %(p)s, 3), '", "pid": "', case when regexp_matches(line, ' pid=\\d+$') then """
    """regexp_extract(line, ' pid=(\\d+)$', 1) else regexp_extract(line, ': ?pid=(\\d+)', 1) end, '", "old-auid": "', """
    """regexp_extract(line, 'old-auid=(\\d+)', 1), '", "comm": "', regexp_extract(line, 'comm="([^"]*)"', 1), '", "msg": "', """
    """replace(regexp_extract(line, 'msg=''([^'']*)''', 1), '"', '\\"'), '"}')"""
) % {"p": AUDIT_RE}
VALID_RECORD = f"json_valid(line) and line like '{{%' and {fields('line')} >= 4"
TEXT = r"regexp_matches(line, '\S')"
NORMALIZED = r"""case when line like '{"message":"{%' then replace(substring(line, 13, length(line) - 14), '\"', '"')
  when line like '{"json":%' then substring(line, 9, length(line) - 9)
  when line like '{"@timestamp":"x","json"%' then '{' || substring(line, 19) end"""

# --- framing and formats --------------------------------------------------------------

check("line_offsets", "select path, seq, record_ref as byte_offset, strlen(line) as octets from framed", "audit_lines", framed=framed("audit_lines"))
check(
    "json_lines_scan",
    f"""select path, record_ref, case when json_valid(line) then trim(line) end as record_json,
        case when json_valid(line) then {fields("line")} end as field_count,
        json_valid(line) and line like '{{%' as is_object,
        case when not json_valid(line) then 'not a JSON value' end as problem from framed where {TEXT}""",
    "json_lines",
    framed=framed("json_lines"),
)
check("auditd_scan", f"select path, record_ref, {AUDIT_JSON} as record_json, 7 as field_count from framed where line <> ''", "audit_lines", framed=framed("audit_lines"))

_REQUEST = r"""'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(?:(\w+) (\S+)(?: HTTP/([0-9.]+))?|(.*?))" \d+ (?:\d+|-) "[^"]*" "[^"]*"$'"""
_REPLY = r"""'" (\d+) (?:(\d+)|-) ("[^"]*") ("[^"]*")$'"""
_PARTS = [(_REQUEST, "clientip ident auth timestamp verb request httpversion rawrequest"), (_REPLY, "response bytes referrer agent")]
check(
    "access_log_scan",
    "select path, record_ref, "
    + ", ".join(
        f"nullif(regexp_extract(line, {regex}, {i}), '') as {n}" for regex, names in _PARTS for i, n in enumerate(names.split(), 1)
    )
    + " from framed",
    "access_lines",
    framed=framed("access_lines"),
)
_CUSTOM = r"""'^(\S+) - (\S+) \[([^\]]+)\] "(.*?)" (\d+) (.*)$'"""
check(
    "grok_extract",
    "select path, record_ref, "
    + ", ".join(f"regexp_extract(line, {_CUSTOM}, {i}) as {n}" for i, n in enumerate("ip account at call status rest".split(), 1))
    + ", cast(null as varchar) as problem from framed",
    "access_lines",
    framed=framed("access_lines"),
)
_SYSLOG = r"""'^(Nov +\d+ [0-9:]+) (\S+) ([^ \[\]]+)(?:\[(\d+)\])?: (\w+) (\S+@\S+) (https://\S+) took [0-9.]+ \S+ /\S+ \(\S+\)$'"""
_SYSLOG_END = r"""' (https://\S+) took ([0-9.]+) (\S+) (/\S+) \((\S+)\)$'"""
_SYSLOG_PARTS = [(_SYSLOG, "timestamp logsource program pid level mail"), (_SYSLOG_END, "uri took mac file id")]
check(
    "grok_syslog",
    "select path, record_ref, null::varchar as facility, null::varchar as priority, "
    + ", ".join(f"nullif(regexp_extract(line, {regex}, {i}), '') as {n}" for regex, names in _SYSLOG_PARTS for i, n in enumerate(names.split(), 1))
    + f", case when not regexp_matches(line, {_SYSLOG}) then 'pattern does not match' end as problem from framed",
    "syslog_lines",
    framed=framed("syslog_lines"),
)
check(
    "csv_scan",
    r"""select path, record_ref, concat('{"id": "', c_custkey, '", "name": "', c_name, ' \"q\" ',
        case when c_custkey % 8 = 0 then '\n' else '' end, c_mktsegment, '", "nation": "', c_nationkey,
        case when c_custkey % 11 = 0 then ' 5\" disk' else '' end, '"}') as record_json, 3 as field_count
        from framed join customer on c_custkey = seq""",
    "csv_logical",
    "csv_headers",
    physical="select * from csv_logical union all select distinct * from csv_headers",
    framed=framed("physical"),
)
check(
    "json_array_explode",
    f"select path, row_number() over (partition by path order by seq) - 1 as record_ref, line as record_json, {fields('line')} as field_count from trail_items",
    "trail_items",
)
check(
    "events_wrapper_explode",
    f"select path, row_number() over (partition by path order by seq) - 1 as record_ref, record as record_json, {fields('record')} as field_count from normalized where record is not null",
    "event_items",
    normalized=f"select path, seq, {NORMALIZED} as record from event_items",
)
_CHUNKS = (
    "select *, cast(coalesce(sum(strlen(chunk) + 8) over (partition by path order by seq "
    "rows between unbounded preceding and 1 preceding), 0) as bigint) as start from xml_chunks"
)
_EVENTS = r"""select path, start + strlen(regexp_extract(chunk, '(?s)^(.*)(<Event[ >].*)$', 1)) as record_ref,
  regexp_extract(chunk, '(?s)^(.*)(<Event[ >].*)$', 2) || '</Event>' as event
  from placed where terminated and regexp_matches(chunk, '<Event[ >]')"""
check("xml_event_split", "select path, record_ref, event from events_", "xml_chunks", placed=_CHUNKS, events_=_EVENTS)
check(
    "xml_truncated_events",
    """select path, cast(start + list_sum(list_transform(pieces[1:i], lambda p: strlen(p))) + (i - 1) * 7 as bigint) as record_ref
       from (select *, unnest(range(1, len(pieces) + case when terminated then -1 else 0 end)) as i from pieced)""",
    "xml_chunks",
    placed=_CHUNKS,
    pieced="select path, start, terminated, regexp_split_to_array(chunk, '<Event[ >]') as pieces from placed",
)
_XML = {
    "id": "regexp_extract(event, '<EventID>([^<]*)', 1)",
    "record": "regexp_extract(event, '<EventRecordID>([^<]*)', 1)",
    "text": "replace(regexp_extract(event, '<Data Name=\"CommandLine\">(.*)</Data>', 1), '&amp;', '&')",
}
check(
    "xml_event_records",
    f"""select path, record_ref, concat('{{"Event": {{"xmlns": "urn:x", "System": {{"EventID": "', {_XML["id"]}, '", "EventRecordID": "',
        {_XML["record"]}, '"}}, "EventData": {{"Data": {{"Name": "CommandLine", "#text": "', {_XML["text"]}, '"}}}}}}}}') as record_json,
        9 as field_count from events_ where event not like '%<broken%'""",
    "xml_chunks",
    placed=_CHUNKS,
    events_=_EVENTS,
)
check(
    "xml_event_fields",
    f"""select path, record_ref, {_XML["id"]} as event_id, {_XML["record"]} as event_record_id, {_XML["text"]} as command_line
        from events_ where event not like '%<broken%'""",
    "xml_chunks",
    placed=_CHUNKS,
    events_=_EVENTS,
)
# The same records from files of a block each, in which refs begin anew.
_IN_BLOCK = "over (partition by path, seq // 8192 order by seq rows between unbounded preceding and 1 preceding), 0) as bigint)"
check(
    "audit_source",
    f"select path, seq // 8192 as block, record_ref, {AUDIT_JSON} as record_json, 7 as field_count from framed where line <> ''",
    "audit_lines",
    framed=f"select *, cast(coalesce(sum(strlen(line) + 1) {_IN_BLOCK} as record_ref from audit_lines",
)
check(
    "event_xml_source",
    f"""select path, block, record_ref, concat('{{"Event": {{"xmlns": "urn:x", "System": {{"EventID": "', {_XML["id"]}, '", "EventRecordID": "',
        {_XML["record"]}, '"}}, "EventData": {{"Data": {{"Name": "CommandLine", "#text": "', {_XML["text"]}, '"}}}}}}}}') as record_json,
        9 as field_count from events_ where event not like '%<broken%'""",
    "xml_chunks",
    placed=f"select *, cast(coalesce(sum(strlen(chunk) + case when terminated then 9 else 1 end) {_IN_BLOCK} as start from xml_chunks",
    events_=_EVENTS.replace("select path,", "select path, seq // 8192 as block,"),
)
check(
    "windows_event_records",
    f"""select path, cast(json_extract(line, '$.Event.System.EventRecordID') as bigint) as record_ref, line as record_json,
        {fields("line")} as field_count from windows_events where json_valid(line)""",
    "windows_events",
)

# --- archives and catalogues ----------------------------------------------------------


def joined(table: str, keys: str, separator: str = "chr(10)", head: str = "''", tail: str = "chr(10)") -> str:
    return f"select {keys}, {head} || string_agg(line, {separator} order by seq) || {tail} as content from {table} group by {keys}"


_TRAIL = joined("trail_items", "path", "','", "'{\"Records\":['", "']}'")
check(
    "archive_members",
    "select archive, member, strlen(content) as bytes, sha256(content) as checksum_sha256 from held",
    "archive_rows",
    held=joined("archive_rows", "archive, member"),
)
check("gz_members", "select concat(file_name, '#', ord) as path, strlen(content) as bytes, sha256(content) as checksum_sha256 from doc_files", "doc_files")
_SAMPLES = """select manifest_path, 0 as pos, path, sourcetype, technique <> '[]' as labeled from listed
  union all select manifest_path, 1, previous, sourcetype, technique <> '[]' from listed"""
_LISTED = "select distinct * from sample_list where manifest_path not like '%/TEMPLATE.yml'"
check("catalog_samples", "select * from samples", "sample_list", listed=_LISTED, samples=_SAMPLES)

# --- classification -------------------------------------------------------------------


def probed(table: str) -> str:
    return (
        f"select path, bool_and(json_valid(trim(line))) as json_lines, arg_min(regexp_matches(line, {AUDIT_RE}), seq) as auditd, "
        f"arg_min(substr(trim(line), 1, 1), seq) as first_char from {table} where {TEXT} group by path"
    )


check(
    "is_json_lines",
    f"select path, coalesce(bool_and(json_valid(trim(line))) filter (where {TEXT}), false) as json_lines from json_lines group by path",
    "json_lines",
)
check(
    "looks_like_auditd",
    "select path, auditd from probes",
    "audit_lines",
    "json_lines",
    either="select * from audit_lines union all select * from json_lines",
    probes=probed("either"),
)
check(
    "first_nonblank_char",
    "select path, first_char from probes",
    "access_lines",
    "json_lines",
    either="select * from access_lines union all select * from json_lines",
    probes=probed("either"),
)
_PRESENT = f"select * from sample_rows where cast(floor(seq / {FILE_ROWS}) as bigint) % 10 <> 9"
_RESOLVED = "select * replace (ltrim(path, '/') as path) from samples where ltrim(path, '/') in (select path from present)"
_CLASSIFIED = """select r.*, case when lower(trim(sourcetype)) in ('vmw-syslog', 'msexchange:management') then null
  when lower(trim(sourcetype)) in ('xmlwineventlog', 'sysmon:linux') then 'xml_events'
  when lower(trim(sourcetype)) = 'auditd' then case when auditd then 'auditd' end
  when first_char in ('{', '[') then case when json_lines then 'json_lines' end
  when first_char = '<' then 'xml_events' when auditd then 'auditd' end as format
  from resolved r left join probes using (path)"""
_CATALOG = {
    "listed": _LISTED,
    "samples": _SAMPLES,
    "present": _PRESENT,
    "resolved": _RESOLVED,
    "probes": probed("present"),
    "classified": _CLASSIFIED,
}
check("sourcetype_classify", "select manifest_path, pos, path, sourcetype, format from classified", "sample_list", "sample_rows", **_CATALOG)


def host_format(member: str) -> str:
    parts = f"string_split({member}, '/')"
    name = f"{parts}[-1]"
    return f"""case when len({parts}) < 4 or {parts}[1] <> 'gather' or {parts}[3] <> 'logs' then null
      when {parts}[4] = 'apache2' and contains({name}, 'access') then 'access_log'
      when {parts}[4] = 'horde' and {name} = 'horde-access.log' then 'access_log'
      when {parts}[4] = 'audit' and {name} = 'audit.log' then 'auditd'
      when {parts}[4] = 'suricata' and {name} = 'eve.json' then 'json_lines'
      when {parts}[4] = 'logstash' and len({parts}) = 6 and not contains({name}, 'system.service') then 'json_lines' end"""


check("path_classify", f"select ord, member, {host_format('member')} as format from host_paths", "host_paths")
check("normalize_event", f"select path, seq, {NORMALIZED} as record_json from event_items", "event_items")
check(
    "has_normalizable_event",
    f"select path, bool_or({NORMALIZED} is not null) as usable from event_items group by path union all select distinct path, false from trail_items",
    "event_items",
    "trail_items",
)
_JUNK = "(list_contains(string_split(member, '/'), '__MACOSX') or starts_with(string_split(member, '/')[-1], '._'))"
_CANDIDATE = f"not {_JUNK} and (member like '%.json' or member like '%.log')"
check("junk_member_filter", f"select * from archive_names where not {_JUNK}", "archive_names")
check("archive_candidates", f"select archive from archive_names group by archive having bool_or({_CANDIDATE})", "archive_names")


def chosen(members: str) -> dict[str, str]:
    """Subqueries that pick the files of each archive and count the problems."""
    return {
        "opened": f"select * from {members} where archive in (select archive from {members} where {_CANDIDATE})",
        "real": r"select *, regexp_extract(string_split(member, '/')[-1], '.+(\.[^.]+)$', 1) as ext from opened "
        "where not starts_with(string_split(member, '/')[-1], '._')",
        "counted": "select *, count(*) filter (where ext = '.json') over (partition by archive) as json_files from real",
        "picked": """select archive, member, path, case when json_files = 1 and ext = '.json' then 'json_lines'
          when json_files = 0 and ext = '.log' then case when json_lines then 'json_lines' when auditd then 'auditd' end end as format
          from counted left join probes using (path)""",
    }


_HELD_PATH = r"regexp_replace(archive, '\.[^.]*$', '') || '/' || member"
_ARCHIVE_LINES = f"select *, {_HELD_PATH} as path from archive_rows"
check(
    "archive_select",
    """select *, cast(null as varchar) as problem from picked where format is not null union all
       select distinct archive, null, null, null, 'several .json members in one archive: ' || json_files from counted where json_files > 1""",
    "archive_rows",
    "archive_names",
    lines=_ARCHIVE_LINES,
    probes=probed("(select * from lines where member like '%.log')"),
    members="select distinct archive, member, path from lines union all select archive, member, archive || '/' || member from archive_names",
    **chosen("members"),
)
_FIXTURE = r"'^packages/[^/]+/data_stream/[^/]+/_dev/test/pipeline/test-[^/]*"
_VENDOR = {
    "logs": rf"select path, 'json_lines' as format from vendor_rows where regexp_matches(path, {_FIXTURE}\.log$') "
    f"group by path having bool_and(json_valid(trim(line))) filter (where {TEXT})",
    "wrapped": rf"select path, 'events_wrapper' as format from vendor_rows where regexp_matches(path, {_FIXTURE}\.json$') "
    f"and path not like '%-expected.json' group by path having bool_or({NORMALIZED} is not null)",
    "picked": "select * from logs union all select * from wrapped",
}
check("fixture_select", "select * from picked", "vendor_rows", **_VENDOR)
check("suffix_select", "select * from fixture_paths where path like '%.evtx'", "fixture_paths")
check(
    "sample_candidates",
    r"select ltrim(path, '/') as path from (select distinct path from catalog_items where regexp_matches(lower(path), '\.(json|ndjson|log|xml)$'))",
    "catalog_items",
)
check("resolve_samples", "select ltrim(path, '/') as path, ord, sourcetype, labeled from catalog_items where ord % 10 <> 0", "catalog_items")


def constants(dataset_id: str, labeled: str | None = None) -> str:
    url, licence, fixed = DATASETS[dataset_id]
    flag = labeled or str(fixed).lower()
    return f"'{dataset_id}' as dataset_id, '{url}' as source_url, '{licence}' as license, {flag} as labeled"


check(
    "label_sources",
    f"select path, {constants('splunk_attack_data', 'labeled')} from catalog_items union all select member, {constants('ait_lds')} from host_paths",
    "catalog_items",
    "host_paths",
)
check(
    "quality_filter",
    f"select path, record_ref, {fields('line')} as field_count from framed where {VALID_RECORD}",
    "json_lines",
    framed=framed("json_lines"),
)

# --- functions ------------------------------------------------------------------------

check(
    "count_fields",
    f"select path, seq, case when json_valid(line) then {fields('line')} else 0 end as field_count from (select * from windows_events union all select * from event_items)",
    "windows_events",
    "event_items",
)
_TOKENS = (
    r"""select path, seq, unnest(toks) as token, generate_subscripts(toks, 1) - 1 as pos from """
    r"""(select *, regexp_extract_all(line, '[\w.-]+=(?:"(?:[^"\\]|\\.)*"|''(?:[^''\\]|\\.)*''|\S+)') as toks from audit_lines)"""
)
_VALUE = "substring(token, strpos(token, '=') + 1)"
check("kv_tokens", f"select path, seq, pos, substring(token, 1, strpos(token, '=') - 1) as key, {_VALUE} as value from tokens", "audit_lines", tokens=_TOKENS)
check(
    "unquote",
    f"""select path, seq, pos, case when length({_VALUE}) >= 2 and left({_VALUE}, 1) = right({_VALUE}, 1) and left({_VALUE}, 1) in ('"', '''')
        then substring({_VALUE}, 2, length({_VALUE}) - 2) else {_VALUE} end as value from tokens""",
    "audit_lines",
    tokens=_TOKENS,
)
_ENTITY = r"'&(amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);'"
check(
    "escape_bare_amp",
    "select page_id, strlen(repaired) as octets, sha256(repaired) as repaired_sha256 from repaired_",
    repaired_=f"select page_id, replace(replace(regexp_replace(html || ' ' || url || '&copy=1 &#x41; &#66; &', {_ENTITY}, chr(1) || '\\1;', 'g'), "
    "'&', '&amp;'), chr(1), '&') as repaired from pages",
)
check("file_checksum", "select doc_id as ord, sha256(text) as checksum_sha256, strlen(text) as bytes from documents")
check(
    "record_to_json",
    """select doc_id, lang, source, sha256(text) as text_sha256, true as ascii_only,
       concat('{"doc_id": ', doc_id, ', "lang"') as opening from documents""",
)
check("relative_name", rf"select ord, {_HELD_PATH} as file_name from archive_names", "archive_names")
check(
    "shard_name",
    """select p_partkey, case when p_partkey * 97 < 100000 then lpad(cast(p_partkey * 97 as varchar), 5, '0')
       else cast(p_partkey * 97 as varchar) end || '.jsonl' as shard_name from part""",
)

# --- catalogue ------------------------------------------------------------------------

_DOCS = "select dataset_id, file_name, ord, 'docs/' || file_name as cand, sha256(content) as cs from doc_files"


def identified(files: str, manifest: str | None) -> str:
    """Ids of files after a manifest ``(id, cs)``: the first holder of a name keeps it plain."""
    first = f"(select cand, arg_min(cs, ord) as first_cs from {files} group by cand)"
    known = f"left join {manifest} m on m.id = f.cand" if manifest else ""
    holder = "coalesce(m.cs, first_cs)" if manifest else "first_cs"
    return f"""select f.*, {holder} <> f.cs as collided,
      case when {holder} = f.cs then f.cand else f.cand || '#' || substr(f.cs, 1, 8) end as id
      from {files} f join {first} using (cand) {known}"""


_EARLIER = {
    "docs": _DOCS,
    "seen": "select * from docs where ord % 3 = 0",
    "seen_ids": identified("seen", None),
    "manifest": "select id, arg_min(cs, ord) as cs from seen_ids group by id",
    "identified": identified("docs", "manifest"),
}
check("assign_source_id", "select ord, id as source_id, cs as checksum_sha256 from identified", "doc_files", **_EARLIER)
check(
    "collision_report",
    "select dataset_id, file_name, id as source_id from identified where collided",
    "doc_files",
    docs=_DOCS,
    identified=identified("docs", None),
)
check(
    "incremental_new_files",
    "select min(ord) as ord, id as source_id from identified where id not in (select id from manifest) group by id",
    "doc_files",
    **_EARLIER,
)
_LOGS = {
    "audit_framed": framed("audit_lines"),
    "json_framed": framed("json_lines"),
    "surviving": f"""select path, record_ref, {AUDIT_JSON} as text, 0 as run from audit_framed where line <> ''
      union all select path, record_ref, line, 1 from json_framed where {VALID_RECORD}""",
    "indexed": "select *, row_number() over (order by string_split(path, '/'), record_ref) - 1 as idx from surviving",
    "placed": """select *, idx // 1000 as shard_id, cast(coalesce(sum(strlen(text) + 1) over (partition by idx // 1000 order by idx
      rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from indexed""",
    "dictionary": "select path, row_number() over (order by min(idx)) - 1 as id from indexed group by path",
}
_BOTH = ("audit_lines", "json_lines")
_MANIFEST_ENDS = "'byte_offset' as record_ref_type, '' as notes"
check(
    "manifest_build",
    f"""select 'logs/' || path as source_id, {constants("ait_lds")}, path as file_name, sha256(path) as checksum_sha256, bytes,
        coalesce(n, 0) as record_count, {_MANIFEST_ENDS} from
        (select path, cast(sum(strlen(line) + 1) as bigint) as bytes from (select * from audit_lines union all select * from json_lines) group by path)
        left join (select path, count(*) as n from surviving group by path) using (path)""",
    *_BOTH,
    **_LOGS,
)
_UPSERT = """select source || '/' || doc_id as source_id, coalesce(quality, n_chars) as record_count, quality is not null as labeled,
  doc_id as position from documents left join labels using (doc_id)"""
check("manifest_upsert", _UPSERT)
check("manifest_sorted", f"select source_id, record_count, row_number() over (order by source_id) - 1 as place from ({_UPSERT})")
check(
    "ingest_summary",
    f"""select count(distinct path) as files_ingested, (select count(distinct path) from audit_lines) as files_skipped,
        count(*) filter (where {VALID_RECORD}) as records_written,
        count(*) filter (where json_valid(line)) - count(*) filter (where {VALID_RECORD}) as records_dropped from json_lines""",
    *_BOTH,
)
check(
    "source_order",
    "select path, row_number() over (order by string_split(path, '/')) - 1 as place from (select distinct path from fixture_paths)",
    "fixture_paths",
)

# --- numbering, shards and corpus reads -----------------------------------------------

check("global_index", "select 'logs/' || path as source_id, record_ref, idx from indexed", *_BOTH, **_LOGS)
check(
    "shard_assign",
    "select 'logs/' || path as source_id, record_ref, idx, idx // 1000 as shard_id from continued",
    *_BOTH,
    **_LOGS,
    continued="select *  replace (row_number() over (order by run, string_split(path, '/'), record_ref) - 1 as idx) from indexed",
)
check("shard_offsets", 'select idx, shard_id, "offset" from placed', *_BOTH, **_LOGS)
check(
    "source_dictionary",
    "select row_number() over (order by max(run) desc, min(idx)) - 1 as id, 'logs/' || path as source_id from indexed group by path",
    *_BOTH,
    **_LOGS,
)
check(
    "shard_write",
    """select lpad(cast(shard_id as varchar), 5, '0') || '.jsonl' as shard_name, count(*) as records, cast(sum(strlen(text) + 1) as bigint) as bytes,
       arg_min(text, idx) as first_line, arg_max(text, idx) as last_line, count(distinct path) as sources, 'logs/' || arg_max(path, idx) as last_source
       from placed group by shard_id""",
    *_BOTH,
    **_LOGS,
)
check("corpus_count", "select count(*) as records from surviving", *_BOTH, **_LOGS)
check(
    "fetch_by_index",
    """select w.idx, text as line from (select c_custkey * 13 - 100 as idx from customer) w
       left join placed p on p.idx = case when w.idx < 0 then w.idx + (select count(*) from placed) else w.idx end""",
    *_BOTH,
    **_LOGS,
)
check("indices_for_source", "select 'logs/' || path as source_id, idx from indexed where run = 1", *_BOTH, **_LOGS)
check(
    "provenance_join",
    f"""select idx, 'logs/' || path as source_id, record_ref, source_url, license, labeled, 'byte_offset' as record_ref_type
        from indexed, (select {constants("ait_lds")})""",
    *_BOTH,
    **_LOGS,
)
check(
    "index_frame",
    'select idx, shard_id, "offset", id as source_id, record_ref from placed join dictionary using (path)',
    *_BOTH,
    **_LOGS,
)
check(
    "resolve_records",
    f"""select path, record_ref + seq % 2 as record_ref,
        case when seq % 2 = 0 and line <> '' then regexp_extract(line, {AUDIT_RE}, 3) end as audit_id from framed""",
    "audit_lines",
    framed=framed("audit_lines"),
)

# --- whole datasets -------------------------------------------------------------------


def manifest(dataset_id: str, files: str, counts: str, ref: str, labeled: str | None = None) -> str:
    """Manifest rows from ``files`` (path, content) and ``counts`` (path, n)."""
    return f"""select '{dataset_id}/' || path as source_id, {constants(dataset_id, labeled)}, path as file_name,
      sha256(content) as checksum_sha256, strlen(content) as bytes, coalesce(n, 0) as record_count,
      {ref} as record_ref_type, '' as notes from {files} left join {counts} using (path)"""




def counted(lines: str, picked: str) -> str:
    return f"""select path, count(*) as n from {lines} join {picked} using (path) where case format
      when 'json_lines' then {VALID_RECORD} else line <> '' end group by path"""


_BYTE = "'byte_offset'"
check(
    "ingest_archive_logs",
    manifest("otrf", "files", "counts", _BYTE),
    "archive_rows",
    lines=_ARCHIVE_LINES,
    probes=probed("(select * from lines where member like '%.log')"),
    members="select distinct archive, member, path from lines",
    **chosen("members"),
    files=joined("(select path, seq, line from lines join picked using (path) where format is not null)", "path"),
    counts=counted("(select path, line from lines)", "(select path, format from picked where format is not null)"),
)
check(
    "ingest_windows_events",
    manifest("evtx_attack_samples", "files", "counts", "'event_record_id'"),
    "windows_events",
    files=joined("windows_events", "path"),
    counts=f"select path, count(*) as n from windows_events where json_valid(line) and {fields('line')} >= 4 group by path",
)
check(
    "ingest_cloud_trail",
    manifest("flaws_cloud", "files", "counts", "'array_index'"),
    "trail_items",
    documents_=_TRAIL,
    files=r"select 'trails' || regexp_extract(path, 'trail/(\d*)\d\.json', 1) || '/' || path as path, content from documents_",
    counts=r"select 'trails' || regexp_extract(path, 'trail/(\d*)\d\.json', 1) || '/' || path as path, count(*) as n from trail_items group by 1",
)
_HOSTS = {
    "lines": f"select *, {_HELD_PATH} as path, {host_format('member')} as format from host_rows where {host_format('member')} is not null",
    "picked": "select distinct path, format from lines",
    "files": joined("lines", "path"),
    "counts": counted("(select path, line from lines)", "picked"),
}
check("ingest_host_logs", manifest("ait_lds", "files", "counts", _BYTE), "host_rows", **_HOSTS)
check(
    "ingest_vendor_fixtures",
    manifest("elastic_fixtures", "files", "counts", "case when path like '%.json' then 'array_index' else 'byte_offset' end"),
    "vendor_rows",
    **_VENDOR,
    files=f"""{joined("(select * from vendor_rows where path in (select path from logs))", "path")} union all
      {joined("(select * from vendor_rows where path in (select path from wrapped))", "path", "','", "'{\"events\":['", "']}'")}""",
    counts=f"""select path, count(*) as n from vendor_rows join picked using (path) where case format when 'json_lines' then {VALID_RECORD}
      else coalesce({fields(NORMALIZED)}, 0) >= 4 end group by path""",
)
check(
    "ingest_attack_catalog",
    manifest("splunk_attack_data", "files join first using (path)", "counts", _BYTE, "labeled"),
    "sample_list",
    "sample_rows",
    **_CATALOG,
    first="""select path, arg_min(format, place) as format, arg_min(labeled, place) as labeled from
      (select *, row_number() over (order by string_split(manifest_path, '/'), pos) as place from classified where format is not null) group by path""",
    files=joined("present", "path"),
    counts=f"""select path, count(*) as n from present join first using (path) where case format when 'json_lines' then {VALID_RECORD}
      when 'auditd' then line <> '' else line like '%<Event %</Event>' and line not like '%<broken%' and line not like '%<Eventual%' end group by path""",
)
check(
    "ingest_dataset",
    """select count(*) filter (where format <> 'access_log') as files_ingested, count(*) filter (where format = 'access_log') as files_skipped,
       cast((select sum(n) from counts join picked using (path) where format <> 'access_log') as bigint) as records_written,
       cast(0 as bigint) as records_dropped from picked""",
    "host_rows",
    **_HOSTS,
)

# --- time -----------------------------------------------------------------------------

_ISO = r"(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(?:[.,](\d{1,9}))?(?:Z|([+-]\d{2}):?(\d{2}))?"
_HTTP = r"\[(\d{1,2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2}) ([+-]\d{2})(\d{2})\]"
_AUDIT = r"msg=audit\((\d{1,2}/\d{1,2}/\d{4} \d{2}:\d{2}:\d{2})(?:\.(\d{1,6}))?:\d+\)"
_EPOCH = r"msg=audit\((\d{9,11})(?:\.(\d{1,6}))?:\d+\)"


def _part(regex: str, group: int) -> str:
    return f"regexp_extract(line, '{regex}', {group})"


def _fraction(regex: str, group: int) -> str:
    return f"coalesce(try_cast(rpad(left({_part(regex, group)}, 6), 6, '0') as bigint), 0)"


def _zone(regex: str, hours: int) -> str:
    minutes = f"coalesce(try_cast({_part(regex, hours + 1)} as bigint), 0)"
    return f"(coalesce(try_cast({_part(regex, hours)} as bigint), 0) * 60 + case when {_part(regex, hours)} like '-%' then -{minutes} else {minutes} end) * 60000000"


def _stamp(text: str, layout: str) -> str:
    return f"epoch_us(try_strptime({text}, '{layout}'))"


_TIMED = {
    "audit_epoch": f"try_cast({_part(_EPOCH, 1)} as bigint) * 1000000 + {_fraction(_EPOCH, 2)}",
    "httpdate": f"{_stamp(_part(_HTTP, 1), '%d/%b/%Y:%H:%M:%S')} - {_zone(_HTTP, 2)}",
    "filetime": r"(try_cast(regexp_extract(line, '(?:^|[^\d.])(1[1-9]\d{16})(?:[^\d.]|$)', 1) as bigint) - 116444736000000000) // 10",
    "iso": f"{_stamp(f"concat({_part(_ISO, 1)}, ' ', {_part(_ISO, 2)})", '%Y-%m-%d %H:%M:%S')} + {_fraction(_ISO, 3)} - {_zone(_ISO, 4)}",
    "month_first": f"{_stamp(_part(_AUDIT, 1), '%m/%d/%Y %H:%M:%S')} + {_fraction(_AUDIT, 2)}",
    "day_first": f"{_stamp(_part(_AUDIT, 1), '%d/%m/%Y %H:%M:%S')} + {_fraction(_AUDIT, 2)}",
}
TIMED_VIEWS = {
    "read_as": "select *, " + ", ".join(f"{e} as {n}" for n, e in _TIMED.items()) + " from timed_lines",
    "votes": "select path, " + ", ".join(f"count({n}) as {n}" for n in _TIMED) + " from read_as group by path",
    # One row for each format a line can be read in, the readings of a numeric date only if they won.
    "readings": " union all ".join(
        f"select r.path, r.seq, r.line, '{n}' as format, r.{n} as us, v.{n} as n, {i} as place from read_as r join votes v using (path) where r.{n} is not null"
        + {"month_first": " and v.month_first >= v.day_first", "day_first": " and v.day_first > v.month_first"}.get(n, "")
        for i, n in enumerate(_TIMED)
    ),
    "chosen": "select path, seq, arg_max(format, (n, -place)) as time_format, arg_max(us, (n, -place)) as event_us from readings group by path, seq",
    "timed": "select l.path, split_part(l.path, '/', 1) as host, l.seq, l.line, c.time_format, c.event_us from timed_lines l left join chosen c on c.path = l.path and c.seq = l.seq",
}

check(
    "event_time",
    "select path, seq, time_format, event_us, case when time_format is null then 'no time of a known format' end as time_problem from timed",
    "timed_lines",
    **TIMED_VIEWS,
)
check(
    "interval_label_join",
    "select path, seq, event_us, window_id, technique from timed t join attack_windows w on t.host = w.host and w.start_us <= t.event_us and t.event_us < w.end_us",
    "timed_lines",
    "attack_windows",
    **TIMED_VIEWS,
)
check(
    "asof_manifest",
    """select t.host, t.path, t.seq, t.event_us, max(v.since_us) as since_us, arg_max(v.version, (v.since_us, v.version)) as version,
       arg_max(v.license, (v.since_us, v.version)) as license
       from timed t left join host_versions v on v.host = t.host and v.since_us <= t.event_us group by all""",
    "timed_lines",
    "host_versions",
    **TIMED_VIEWS,
)
check(
    "host_sessions",
    """select host, session, min(event_us) as start, max(event_us) as "end", count(*) as rows, sum(octets)::bigint as sum_octets from counted group by host, session""",
    "timed_lines",
    **TIMED_VIEWS,
    opened="""select host, event_us, strlen(line) as octets,
      case when event_us - lag(event_us) over (partition by host order by event_us) > 900000000 then 1 else 0 end as opens from timed where event_us is not null""",
    counted="select *, cast(sum(opens) over (partition by host order by event_us range between unbounded preceding and current row) as bigint) as session from opened",
)

check(
    "stream_sessions",
    """select source, 'late' as kind, null as start, null as "end", null as rows, null as sum, ref from judged where late
       union all select source, 'session', min(us), max(us), count(*), sum(value)::bigint, null from counted group by source, session""",
    "timed_lines",
    **TIMED_VIEWS,
    arrived=f"""select host as source, event_us as us, seq as ref, strlen(line)::bigint as value,
      case when seq % 11 = 0 then 2 else least((event_us - {START_MS * 1000}) // (28 * 8 * 3600000000), 2) end as batch from timed where event_us is not null""",
    clocks="select a.source, b.batch, max(a.us) as clock from arrived a join (select range as batch from range(3)) b on a.batch < b.batch group by all",
    judged="select a.*, coalesce(a.us < c.clock - 32400000000, false) as late from arrived a left join clocks c on a.source = c.source and a.batch = c.batch",
    opened="""select *, case when us - lag(us) over (partition by source order by us) > 900000000 then 1 else 0 end as opens from judged where not late""",
    counted="select *, sum(opens) over (partition by source order by us range between unbounded preceding and current row) as session from opened",
)


def _window_check(name: str, size: int, slide: int) -> None:
    hour = 3_600_000_000
    check(
        name,
        f"""select host, start, count(*) as rows, sum(strlen(line))::bigint as sum, min(strlen(line)) as least, max(strlen(line)) as most
            from (select host, line, unnest(range(event_us // {slide * hour} * {slide * hour}, event_us - {size * hour}, {-slide * hour})) as start
                  from timed where event_us is not null) group by host, start""",
        "timed_lines",
        **TIMED_VIEWS,
    )


_window_check("tumbling_windows", 6, 6)
_window_check("sliding_windows", 24, 3)

# --- what is in a corpus --------------------------------------------------------------

_LEAVES = {
    "framed_json": framed("json_lines"),
    "framed_audit": framed("audit_lines"),
    "records": f"""select 'json' as dataset, path, record_ref, trim(line) as record from framed_json where json_valid(line) and line like '{{%'
      union all select 'auditd', path, record_ref, {AUDIT_JSON} from framed_audit where line <> ''""",
    "leaves": r"""select dataset, records.path, record_ref, regexp_replace(regexp_replace(replace(t.fullkey, '"', ''), '^\$\.?', ''), '\[\d+\]', '[]', 'g') as field,
      t.type as kind, case when t.type not in ('ARRAY', 'OBJECT') then t.atom::varchar end as value
      from records, json_tree(records.record::json) t where t.fullkey <> '$'""",
}
_KIND = "case kind when 'NULL' then 'null' when 'BOOLEAN' then 'boolean' when 'UBIGINT' then 'integer' when 'BIGINT' then 'integer' when 'DOUBLE' then 'double' when 'VARCHAR' then 'string' when 'ARRAY' then 'array' else 'object' end"
check(
    "structure_profile",
    """select dataset, path, field, case when len(kinds) = 0 then 'null' when len(kinds) = 1 then kinds[1] when kinds = ['double', 'integer'] then 'number' else 'mixed' end as type,
       nullable, records < total as optional, records, occurrences, longest
       from profiled join totals using (dataset, path)""",
    "json_lines",
    "audit_lines",
    **_LEAVES,
    totals="select dataset, path, count(*) as total from records group by all",
    profiled=f"""select dataset, path, field, list_sort(list(distinct {_KIND}) filter (where kind <> 'NULL')) as kinds, bool_or(kind = 'NULL') as nullable,
      count(distinct record_ref) as records, count(*) as occurrences, max(length(value)) as longest from leaves group by dataset, path, field""",
)
check(
    "top_fields",
    "select dataset, field, rank, value, n from ranked where rank <= 5",
    "json_lines",
    "audit_lines",
    **_LEAVES,
    counted="select dataset, field, value, count(*) as n from leaves where value is not null group by all",
    ranked="select *, cast(row_number() over (partition by dataset, field order by n desc, value) as int) as rank from counted",
)
check(
    "corpus_diff",
    """select path, record_ref, record_json, sum(l)::bigint as n_left, sum(r)::bigint as n_right from both_runs group by all having sum(l) <> sum(r)""",
    "json_lines",
    framed=framed("json_lines"),
    first_run="select path, record_ref, trim(line) as record_json from framed where json_valid(line) and line like '{%'",
    later_run="""select path, record_ref, case when record_ref % 1009 = 5 then replace(record_json, 'a:b', 'b:a') else record_json end as record_json
      from first_run where record_ref % 997 <> 3""",
    both_runs="""select *, 1 as l, 0 as r from first_run union all select *, 0, 1 from later_run
      union all select *, 0, 1 from later_run where record_ref % 1013 = 7""",
)
_CATALOGUED = "select split_part(file_name, '/', 1) as source, split_part(file_name, '/', 2) as file, ord % 3 = 0 as labeled, strlen(content) as bytes, sha256(content) as checksum from doc_files"
check(
    "manifest_cube",
    """select source, file, labeled, cast(grouping(source, file, labeled) as int) as "grouping", count(*) as rows, sum(bytes)::bigint as sum_bytes,
       count(distinct checksum) as distinct_checksum from catalogued group by cube (source, file, labeled)""",
    "doc_files",
    catalogued=_CATALOGUED,
)
check(
    "manifest_sketch",
    """select source, file, cast(grouping(source, file) as int) as "grouping", count(*) as rows, true as within from catalogued group by rollup (source, file)""",
    "doc_files",
    catalogued=_CATALOGUED,
)
