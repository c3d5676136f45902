"""General grok names, the bound on CSV rows, blocks inside members, and looking at arriving files alone."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from logstrata.operators import formats, framing
from logstrata.plans.datasets import discover
from logstrata.sources import files

SAMPLES = {
    "EMAILADDRESS": (["a.b+c@mail.example.org"], ["a@", "a b@c"]),
    "BASE10NUM": (["-1.5", "42", ".5"], ["x", "1.2.3"]),
    "BASE16NUM": (["0xFF", "-0a1"], ["0xG"]),
    "BASE16FLOAT": (["0x1.8", "A.F"], ["1.8.9"]),
    "POSINT": (["10"], ["0", "01", "-1"]),
    "NONNEGINT": (["0", "007"], ["-1", "1.0"]),
    "QUOTEDSTRING": (['"a \\" b"', "'x'"], ['"a']),
    "UUID": (["00000000-aaaa-4BBB-8ccc-000000000001"], ["00000000-aaaa"]),
    "URN": (["urn:isbn:0451450523"], ["urn::x"]),
    "MAC": (["0011.2233.4455", "00-11-22-33-44-55", "00:11:22:33:44:55"], ["00:11:22:33:44"]),
    "HOSTPORT": (["h.example.org:80", "10.0.0.1:8080"], ["h:0", "h"]),
    "PATH": (["/usr/lib/x-1.2", r"C:\Windows\x", r"\\srv\share"], ["relative/x"]),
    "TTY": (["/dev/pts/3", "/dev/ttyS0"], ["/dev/sda"]),
    "URI": (["https://u:p@h:1/a?b=[1]#c", "ftp://h"], ["h/a"]),
    "URIPATHPARAM": (["/a/b?c=d&e"], ["a/b"]),
    "MONTH": (["Jan", "september"], ["Foo"]),
    "MONTHNUM": (["1", "12"], ["13", "0"]),
    "MONTHNUM2": (["01"], ["1"]),
    "DAY": (["Mon", "Wednesday"], ["Mo"]),
    "HOUR": (["0", "23"], ["24"]),
    "MINUTE": (["00", "59"], ["60", "5"]),
    "SECOND": (["60", "7.25", "59,999"], ["61"]),
    "DATE": (["12/31/2024", "31.12.2024", "1-2-24"], ["2024/13"]),
    "DATESTAMP": (["12/31/2024 23:59:01"], ["12/31/2024"]),
    "TIMESTAMP_ISO8601": (["2024-11-02T21:40:07.125+01:00", "2024-11-02 21:40Z"], ["2024-11-02"]),
    "DATESTAMP_RFC822": (["Sat Nov 02 2024 21:40:07 UTC"], ["Nov 02 2024"]),
    "DATESTAMP_RFC2822": (["Sat, 02 Nov 2024 21:40:07 +0100"], ["02 Nov 2024"]),
    "DATESTAMP_OTHER": (["Sat Nov 02 21:40:07 UTC 2024"], ["Sat Nov 02"]),
    "DATESTAMP_EVENTLOG": (["20241102214007"], ["2024-11-02"]),
    "SYSLOGTIMESTAMP": (["Nov  2 21:40:07"], ["2 Nov 21:40:07"]),
    "SYSLOGPROG": (["cron", "app/x[12]"], ["a b"]),
    "SYSLOGFACILITY": (["<13.6>"], ["<13>"]),
    "SYSLOGBASE": (["Nov  2 21:40:07 <1.2> h cron[7]:", "Nov 12 1:00:00 10.0.0.1 k:"], ["Nov 2 h k:"]),
    "LOGLEVEL": (["WARN", "warning", "Err", "SEVERE"], ["LOUD"]),
}


def test_grok_names(spark):
    rows = [(n, t, ok) for n, (good, bad) in SAMPLES.items() for ok, texts in ((True, good), (False, bad)) for t in texts]
    table = spark.createDataFrame(rows, "name string, text string, fits boolean")
    found = F.lit(None).cast("boolean")
    for name in SAMPLES:
        found = F.when(F.col("name") == name, F.col("text").rlike(formats.grok_regex(f"%{{{name}}}")[0])).otherwise(found)
    wrong = table.withColumn("found", found).where("fits <> found").collect()
    assert not wrong


def test_every_grok_name_is_known_and_expands():
    for name in formats.GROK:
        regex, _ = formats.grok_regex(f"%{{{name}}}")
        assert "%{" not in regex
    used = {n for body in formats.GROK.values() for n in re.findall(r"%\{(\w+)", body)}
    assert used <= set(formats.GROK)


def csv_lines(spark, text):
    lines = text.split("\n")
    return spark.createDataFrame([("f", i // 50, i, line) for i, line in enumerate(lines)], "path string, block long, seq long, line string")


def test_an_open_quote_does_not_gather_the_file(spark):
    good = "\n".join(f'{i},"x\ny"' for i in range(100))
    text = f'a,b\n{good}\n7,"open\n' + "\n".join(f"{i},z" for i in range(5000))
    records = formats.csv(csv_lines(spark, text), row_bytes=200)
    problems = records.where("problem is not null").collect()
    start = text.index('7,"open')
    assert [(r.record_ref, r.problem) for r in problems] == [(start, "row of more than 200 bytes, perhaps a quote left open")]
    assert records.where("problem is null").count() == 100
    joined = framing.csv_rows(csv_lines(spark, text), 200).where("too_long").first()
    assert 200 < len(joined.text) < 250
    with pytest.raises(Exception, match=f"record {start} of f - row of more than 200 bytes"):
        formats.checked(records).collect()
    # A long row within the bound is a record as before.
    whole = formats.csv(csv_lines(spark, 'a,b\n1,"' + "l\n" * 500 + '"')).collect()
    assert [r.problem for r in whole] == [None]


def test_quotes_over_many_blocks(spark):
    text = 'a,b\n1,"' + "\n".join(["in"] * 260) + '"\n2,"q""\n"\n3,x'
    got = [(r.record_ref, r.field_count) for r in formats.csv(csv_lines(spark, text)).orderBy("record_ref").collect()]
    assert got == [(4, 2), (text.index('2,"q'), 2), (text.index("3,x"), 2)]


def test_members_are_cut_into_blocks(spark):
    n = 2 * framing.BLOCK_ROWS + 7
    content = "\n".join(f"é{i}" for i in range(n)) + "\n"
    held = spark.createDataFrame([("m", content)], "path string, content string")
    lines = files.content_lines(held)
    assert [(r.block, r["count"]) for r in lines.groupBy("block").count().orderBy("block").collect()] == [(0, 8192), (1, 8192), (2, 7)]
    offsets = {r.seq: r.byte_offset for r in framing.line_offsets(lines).collect()}
    raw = content.encode()
    assert len(offsets) == n and all(raw[offsets[i] :].startswith(f"é{i}\n".encode()) for i in (0, 1, 8191, 8192, 9000, n - 1))
    events = "".join(f"<Event n='{i}'></Event>" for i in range(n))
    chunks = files.content_chunks(spark.createDataFrame([("x", events)], "path string, content string"))
    refs = sorted(r.record_ref for r in framing.xml_event_split(chunks).collect())
    assert refs == [m.start() for m in re.finditer("<Event ", events)]


def test_arriving_files_are_looked_at_alone(spark, tmp_path):
    pipeline = tmp_path / "packages/p/data_stream/d/_dev/test/pipeline"
    pipeline.mkdir(parents=True)
    for name in ("test-a.log", "test-b.log", "other.log"):
        (pipeline / name).write_text('{"a": 1}\n')
    names = lambda found: sorted(r.file_name.rsplit("/", 1)[1] for r in found.sources.select("file_name").collect())
    assert names(discover(spark, "elastic_fixtures", str(tmp_path))) == ["test-a.log", "test-b.log"]
    only = [str(pipeline / "test-b.log"), str(pipeline / "other.log")]
    assert names(discover(spark, "elastic_fixtures", str(tmp_path), only)) == ["test-b.log"]
    assert names(discover(spark, "elastic_fixtures", str(tmp_path), only[1:])) == []
    data = tmp_path / "s/datasets/T1"
    data.mkdir(parents=True)
    for name in ("one.json", "two.json"):
        (data / name).write_text('{"a": 1}\n')
    listed = "\n".join(f"- name: {n}\n  path: /datasets/T1/{n}.json\n  sourcetype: x" for n in ("one", "two"))
    (data / "manifest.yml").write_text(f"mitre_technique: [T1]\ndatasets:\n{listed}\n")
    root = str(tmp_path / "s")
    assert names(discover(spark, "splunk_attack_data", root)) == ["one.json", "two.json"]
    assert names(discover(spark, "splunk_attack_data", root, [str(data / "two.json")])) == ["two.json"]
    assert names(discover(spark, "splunk_attack_data", root, [str(data / "manifest.yml")])) == ["one.json", "two.json"]
