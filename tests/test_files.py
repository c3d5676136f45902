"""Framing and parsing of real files, cut into many splits."""

from __future__ import annotations

import csv
import gzip
import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from logstrata.operators import classify, corpus, formats, framing
from logstrata.sources import files


def line_starts(data: bytes) -> list[int]:
    starts = [0] + [m.end() for m in re.finditer(b"\n", data)]
    return [s for s in starts if s < len(data)]


def records(df):
    return {(r["path"].rsplit("/", 1)[-1], r["record_ref"]): r for r in df.collect()}


@pytest.fixture
def line_files(tmp_path):
    body = "".join(f'{{"n": {i}, "t": "é{"x" * (i % 90)}"}}\r\n' + ("\n" if i % 7 == 0 else "") for i in range(900))
    contents = {
        "big.log": body.encode(),
        "tail.log": body.encode().rstrip(b"\r\n"),
        "bom.log": b"\xef\xbb\xbf" + body.encode(),
        "bomtail.log": b"\xef\xbb\xbf" + body.encode().rstrip(b"\r\n"),
        "a b+c%20.log": b'{"a": 1}\n',
        "empty.log": b"",
    }
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    return tmp_path, contents


def test_line_offsets_are_exact_over_splits(spark, small_splits, line_files):
    root, contents = line_files
    framed = framing.line_offsets(files.read_lines(spark, str(root)))
    got: dict[str, list[int]] = {}
    for r in framed.collect():
        got.setdefault(r["path"].rsplit("/", 1)[-1], []).append(r["byte_offset"])
    for name, data in contents.items():
        expected = line_starts(data)
        if data.startswith(b"\xef\xbb\xbf"):
            expected[0] = 3
        assert sorted(got.get(name, [])) == expected, name
    assert framed.select("block").where("path like '%big.log'").distinct().count() > 5


def test_json_lines_refs_point_at_their_records(spark, small_splits, line_files):
    root, contents = line_files
    got = records(formats.checked(formats.json_lines(files.read_lines(spark, str(root)))))
    assert sum(1 for name, _ in got if name == "big.log") == 900
    for (name, ref), r in got.items():
        raw = contents[name][ref:].split(b"\n", 1)[0]
        assert json.loads(raw) == json.loads(r["record_json"])
        assert r["field_count"] == len(json.loads(raw))


def test_xml_events_over_splits(spark, small_splits, tmp_path):
    parts, expected, truncated = [], [], []
    size = 0

    def add(text):
        nonlocal size
        parts.append(text.encode())
        size += len(parts[-1])

    for i in range(400):
        add("\n" if i % 3 else "é stray </Event> <Events/>")
        if i % 11 == 0:
            truncated.append(size)
            add(f"<Event xmlns='u'><System><EventID>{i}</Sys")
        expected.append(size)
        add(f"<Event xmlns='u'><System><EventID>0{i}</EventID></System><D Name='é'>a\nb 2>&1 &amp;</D></Event>")
    truncated.append(size)
    add("<Event>never closed\n")
    (tmp_path / "e.log").write_bytes(b"".join(parts))
    chunks = files.read_chunks(spark, str(tmp_path))
    got = records(formats.xml_events(chunks))
    assert sorted(ref for _, ref in got) == expected
    assert sorted(r["record_ref"] for r in framing.xml_truncated_events(chunks).collect()) == truncated
    first = json.loads(got["e.log", expected[0]]["record_json"])
    assert first == {"Event": {"xmlns": "u", "System": {"EventID": "00"}, "D": {"Name": "é", "#text": "a\nb 2>&1 &"}}}


def test_csv_rows_and_offsets_over_splits(spark, small_splits, tmp_path):
    rows = ["id,name,note"]
    for i in range(500):
        note = ["plain", 'say ""hi""', "two\nlines", "a,b", "x\r\ny\nz"][i % 5]
        rows.append(f'{i},"{note}",' + ['5" disk', '"q"tail', "", 'he "said" so'][i % 4])
    data = "\n".join(rows).encode() + b"\r\n"
    (tmp_path / "a.csv").write_bytes(data)
    (tmp_path / "b.csv").write_bytes(b"id,name\r\n1,x\r\n\r\n2\r\n3,y,z\r\n4,w")
    parsed = formats.csv(files.read_lines(spark, str(tmp_path)))
    got = records(parsed)

    text = data.decode()
    lines = text.splitlines(keepends=True)
    reader = csv.reader(iter([p for p in re.findall(r"[^\n]*\n", text)]))
    assert len(lines) > 500
    header = next(reader)
    offsets = [len("".join(re.findall(r"[^\n]*\n", text)[: reader.line_num]).encode())]
    expected = {}
    for row in reader:
        expected[offsets[-1]] = dict(zip(header, row, strict=True))
        offsets.append(len("".join(re.findall(r"[^\n]*\n", text)[: reader.line_num]).encode()))
    mine = {ref: json.loads(r["record_json"]) for (name, ref), r in got.items() if name == "a.csv"}
    assert mine == expected

    small = {ref: (r["record_json"], r["problem"] is not None) for (name, ref), r in got.items() if name == "b.csv"}
    assert {ref: bad for ref, (_, bad) in small.items()} == {9: False, 14: True, 16: True, 19: True, 26: False}
    assert json.loads(small[26][0]) == {"id": "4", "name": "w"}
    with pytest.raises(Exception, match="row width"):
        formats.checked(parsed).collect()


def test_csv_with_many_fields_in_one_line(spark, tmp_path):
    names = [f"c{i}" for i in range(20_000)]
    (tmp_path / "w.csv").write_text(",".join(names) + "\n" + ",".join(f'"{i}"' for i in range(20_000)) + "\n")
    (row,) = formats.csv(files.read_lines(spark, str(tmp_path))).collect()
    assert json.loads(row["record_json"]) == {n: str(i) for i, n in enumerate(names)}


AUDIT = """type=ADD_USER msg=audit(1700000111.125:61): pid=812 uid=0 msg='op=login acct="mia" res=failed'
type=PROCTITLE msg=audit(11/02/2024 21:40:07.125:5012) : proctitle=less notes.txt x
type=LOGIN msg=audit(1700000112.500:62): pid=1 old-auid=42 pid=2 type=OVER comm="a b" key=(null)

type=EOE msg=audit(1.2:3):
"""


def test_auditd_lines(spark, tmp_path):
    (tmp_path / "audit.log").write_text(AUDIT)
    got = [json.loads(r["record_json"]) for r in sorted(formats.auditd(files.read_lines(spark, str(tmp_path))).collect(), key=lambda r: r["record_ref"])]
    assert got == [
        {"type": "ADD_USER", "epoch": "1700000111.125", "audit_id": "61", "pid": "812", "uid": "0", "msg": 'op=login acct="mia" res=failed'},
        {"type": "PROCTITLE", "epoch": "11/02/2024 21:40:07.125", "audit_id": "5012", "proctitle": "less"},
        {"type": "OVER", "epoch": "1700000112.500", "audit_id": "62", "pid": "2", "old-auid": "42", "comm": "a b", "key": "(null)"},
        {"type": "EOE", "epoch": "1.2", "audit_id": "3"},
    ]
    assert list(got[2]) == ["type", "epoch", "audit_id", "pid", "old-auid", "comm", "key"]


def test_blank_but_not_empty_lines_are_a_problem_for_text_formats_only(spark, tmp_path):
    (tmp_path / "x.log").write_text('  \n{"a": 1}\n')
    lines = files.read_lines(spark, str(tmp_path))
    assert formats.json_lines(lines).count() == 1
    assert formats.auditd(lines).where("problem is not null").count() == 2
    with pytest.raises(Exception, match="no audit prefix"):
        formats.checked(formats.auditd(lines)).collect()
    # A later quality filter must not hide the error.
    with pytest.raises(Exception, match="no audit prefix"):
        classify.quality_filter(formats.checked(formats.auditd(lines))).collect()


def test_access_log_and_custom_patterns(spark, tmp_path):
    (tmp_path / "access.log").write_text(
        '10.20.30.40 - - [03/Feb/2021:18:05:44 +0000] "GET /a?b=c HTTP/1.1" 200 915 "-" "Mo\\"zilla"\n'
        'host.example.org - bob [03/Feb/2021:18:05:44 +0000] "-" 408 - "http://x/" "-"\n'
    )
    lines = files.read_lines(spark, str(tmp_path))
    first, second = (json.loads(r["record_json"]) for r in sorted(formats.grok(lines).collect(), key=lambda r: r["record_ref"]))
    assert first == {
        "clientip": "10.20.30.40", "ident": "-", "auth": "-", "timestamp": "03/Feb/2021:18:05:44 +0000", "verb": "GET",
        "request": "/a?b=c", "httpversion": "1.1", "rawrequest": None, "response": "200", "bytes": "915", "referrer": '"-"',
        "agent": '"Mo\\"zilla"',
    }
    assert (second["rawrequest"], second["verb"], second["bytes"], second["auth"]) == ("-", None, None, "bob")
    custom = formats.grok_fields(lines, r"%{NOTSPACE:who} %{GREEDYDATA:rest}").select("fields.*").collect()
    assert {r["who"] for r in custom} == {"10.20.30.40", "host.example.org"}
    assert formats.grok_fields(lines, r"%{IPV4:ip} %{INT:n}").where("problem is not null").count() == 2
    with pytest.raises(ValueError, match="unknown grok pattern"):
        formats.grok_regex("%{NOPE:x}")


def test_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"Records":\n [{"z": 1,\n "a": "x"}, 400, "{\\"s\\": 1}", null, {}]}')
    with gzip.open(tmp_path / "b.json.gz", "wb") as f:
        f.write(b'{"Records": [{"b": 2}]}')
    (tmp_path / "c.json").write_text('{"Records": []}')
    good = formats.checked(formats.json_array(files.read_texts(spark, str(tmp_path)))).collect()
    assert sorted((r["path"].rsplit("/", 1)[-1], r["record_ref"], r["record_json"], r["is_object"]) for r in good) == [
        ("a.json", 0, '{"z":1,"a":"x"}', True), ("a.json", 1, "400", False), ("a.json", 2, '"{\\"s\\": 1}"'.replace(" ", " "), False),
        ("a.json", 3, "null", False), ("a.json", 4, "{}", True), ("b.json.gz", 0, '{"b":2}', True),
    ]
    for text in ('{"x": 1}', "[1]", '{"Records": [1]} x', '{"Records": '):
        bad = spark.createDataFrame([("p", text)], "path string, content string")
        with pytest.raises(Exception, match="no Records list"):
            formats.checked(formats.json_array(bad)).collect()


def test_events_wrapper_counts_survivors(spark):
    text = '{"events":[{"message":"{\\"a\\": 1}"},{"@timestamp":"x"},{"m":"<1> raw"},{"message":"{}"},{"x":{"b":2}}]}'
    rows = spark.createDataFrame([("p", text)], "path string, content string")
    got = formats.events_wrapper(rows).orderBy("record_ref").collect()
    assert [(r["record_ref"], json.loads(r["record_json"])) for r in got] == [(0, {"a": 1}), (1, {}), (2, {"b": 2})]


def test_windows_events_skip_what_did_not_decode(spark):
    rows = [("p", 0, 0, "bad chunk"), ("p", 0, 1, '{"Event":{"System":{"EventRecordID":5000000000}}}'), ("p", 0, 2, '{"Event":{}}')]
    decoded = spark.createDataFrame(rows, "path string, block bigint, seq bigint, event string")
    got = formats.windows_events(decoded).orderBy("position").collect()
    assert [(r["record_ref"], r["problem"]) for r in got] == [(5000000000, None), (None, "no EventRecordID")]


def test_documents_and_lines_beyond_the_limits_of_the_parser(spark):
    number, name = "7" * 1200, "k" * 60_000
    documents = [
        ("many", json.dumps({"Records": [{"k": "v" * 20}] * 700_000}), 700_000),
        ("number", '{"Records": [{"n": ' + number + '}, 1]}', 2),
        ("name", json.dumps({name: 1, "Records": [{"a": 1, "b": 2}]}), 1),
    ]
    rows = spark.createDataFrame([d[:2] for d in documents], "path string, content string")
    found = formats.checked(formats.json_array(rows)).groupBy("path").agg(F.count("*"), F.sum("field_count")).collect()
    assert sorted(map(tuple, found)) == [("many", 700_000, 700_000), ("name", 1, 2), ("number", 2, 1)]

    events = '{"events": [{"message": "{\\"n\\": ' + number + '}"}, {"x": {"b": 2}}, {"message": "' + "y" * 900 + '"}]}'
    wrapped = spark.createDataFrame([("p", events), ("q", '{"events": [{"message": "' + "y" * 900 + '"}]}')], "path string, content string")
    got = formats.events_wrapper(wrapped).orderBy("record_ref").collect()
    assert [(r["path"], r["record_ref"], json.loads(r["record_json"])) for r in got] == [("p", 0, {"n": int(number)}), ("p", 1, {"b": 2})]
    usable = classify.has_normalizable_event(wrapped).collect()
    assert sorted(map(tuple, usable)) == [("p", True), ("q", False)]

    lines = [("f", 0, i, t) for i, t in enumerate(['{"n": ' + number + "}", json.dumps({"s": "x" * 21_000_000}), '{"n": ' + number + "} x"])]
    framed = spark.createDataFrame(lines, "path string, block bigint, seq bigint, line string")
    got = formats.json_lines(framed).orderBy("record_ref").collect()
    assert [(r["field_count"], r["is_object"], r["problem"]) for r in got] == [(1, True, None), (1, True, None), (None, False, "not a JSON value")]
    assert classify.is_json_lines(framed.where("seq < 2")).first()["json_lines"]

    event = json.dumps({"Event": {"System": {"EventRecordID": 7}, "EventData": {"x": "y" * 21_000_000}}})
    decoded = spark.createDataFrame([("p", 0, 0, event)], "path string, block bigint, seq bigint, event string")
    assert [tuple(r) for r in formats.windows_events(decoded).select("record_ref", "field_count").collect()] == [(7, 5)]


def test_resolve_gives_back_each_record(spark, tmp_path):
    (tmp_path / "audit.log").write_text(AUDIT)
    parsed = formats.auditd(files.read_lines(spark, str(tmp_path)))
    wanted = parsed.select("path", "record_ref").unionByName(parsed.select("path", (F.col("record_ref") + 1).alias("record_ref")))
    found = corpus.resolve_records(wanted, parsed)
    assert found.where("record_json is not null").count() == 4 and found.count() == 8
    with pytest.raises(Exception, match="not found"):
        corpus.resolve_records(wanted, parsed, strict=True).collect()


def test_content_rows_frame_like_files(spark, line_files):
    root, contents = line_files
    rows = spark.createDataFrame([(n, d) for n, d in contents.items() if "bom" not in n], "path string, content binary")
    got = framing.line_offsets(files.content_lines(rows)).where("path = 'tail.log'").collect()
    assert sorted(r["byte_offset"] for r in got) == line_starts(contents["tail.log"])


def test_checksums_of_small_and_streamed_files(spark, small_splits, line_files):
    root, contents = line_files
    # Readers do not list files without a single byte.
    expected = {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items() if d}
    for limit in (files.WHOLE_FILE_LIMIT, 1000):
        got = files.checksums(spark, str(root), limit=limit).collect()
        assert {r["path"].rsplit("/", 1)[-1]: (r["bytes"], r["checksum_sha256"]) for r in got} == expected


def test_invalid_utf8_is_reported_and_other_encodings_are_read(spark, tmp_path):
    (tmp_path / "l.log").write_bytes(AUDIT.splitlines()[0].encode() + b" x=\xe9\n" + b'{"a": "\xe9"}\n')
    lines = files.read_lines(spark, str(tmp_path))
    assert [r["problem"] for r in formats.auditd(lines).orderBy("record_ref").collect()] == ["not UTF-8", "not UTF-8"]
    assert formats.json_lines(lines).where("problem is null").count() == 0
    rows = formats.grok_fields(lines, "%{GREEDYDATA:all}", "ISO-8859-1").orderBy("record_ref").collect()
    assert rows[1]["fields"]["all"] == '{"a": "é"}' and rows[1]["record_ref"] == len(AUDIT.splitlines()[0]) + 5
    (tmp_path / "c").mkdir()
    (tmp_path / "c/l.csv").write_bytes("id,name\n1,é\n2,ü\n".encode("latin-1"))
    parsed = formats.csv(files.read_lines(spark, str(tmp_path / "c")), "ISO-8859-1").orderBy("record_ref").collect()
    assert [(r["record_ref"], json.loads(r["record_json"])["name"], r["problem"]) for r in parsed] == [(8, "é", None), (12, "ü", None)]
    assert formats.csv(files.read_lines(spark, str(tmp_path / "c"))).where("problem = 'not UTF-8'").count() == 2


def test_grok_items_with_a_type_are_refused():
    with pytest.raises(ValueError, match="unsupported grok item"):
        formats.grok_regex("%{INT:status:int}")
