"""The log formats as data sources: any byte range, filters, and the records of the operators on the same files."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from logstrata.functions import jsontext
from logstrata.operators import formats
from logstrata.sources import files
from logstrata.sources.datasource import RangeReader, register


@pytest.fixture(scope="module")
def logs(tmp_path_factory):
    draw, folder = random.Random(1), tmp_path_factory.mktemp("logs")
    for name, n, ending in (("a.log", 120, "\n"), ("deep/b.log", 40, "\r\n"), ("deep/empty.log", 0, "\n")):
        lines = []
        for i in range(n):
            body = draw.choice(['comm="x y" pid=1 pid=2', "msg='op=PAM acct=\"ü\"' old-auid=4", "", "k.v=é n=\"a \\\" b\""])
            lines.append(draw.choice(["", f"type=T{i} msg=audit({draw.choice(['1700000000.337', '11/02/2024 21:40:07.125'])}:{i}) : {body}"]))
        (folder / name).parent.mkdir(exist_ok=True)
        (folder / name).write_bytes(ending.join(lines).encode())
    (folder / "_ignored").write_text("no audit line")
    return str(folder)


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    draw, folder = random.Random(2), tmp_path_factory.mktemp("events")
    pieces = []
    for i in range(150):
        pieces.append(draw.choice([
            f'<Event xmlns="urn:x"><System><EventID>0{i}</EventID></System><EventData><Data Name="c">a & b\n2&gt;1</Data></EventData></Event>',
            f"<Event><System><EventID>{i}</EventID>", "stray <Eventual/> text", "</Event>", f"<Event n='é{i}'/><Event>{i}</Event>", "<Event><broken</Event>", "\n",
        ]))
    (folder / "e.log").write_bytes("".join(pieces).encode())
    (folder / "f.log").write_bytes(b"<Event><a>1</a></Event>tail <Event><b>")
    return str(folder)


def rows(df):
    return sorted((r.path, r.record_ref, r.record_json, r.field_count) for r in df.collect())


@pytest.mark.parametrize("size", [257, 1 << 24])
def test_audit_lines_in_any_ranges(spark, logs, size):
    register(spark)
    records = formats.checked(formats.auditd(files.read_lines(spark, logs)))
    want = records.select("path", "record_ref", jsontext.record_to_json(F.col("record_json")).alias("record_json"), "field_count")
    got = spark.read.format("audit_log").option("rangeBytes", size).load(logs)
    assert rows(got) == rows(want) and got.count() > 50


@pytest.mark.parametrize("size", [263, 1 << 24])
def test_events_in_any_ranges(spark, events, size):
    register(spark)
    want = formats.xml_events(files.read_chunks(spark, events)).select("path", "record_ref", "record_json", "field_count")
    got = spark.read.format("event_xml").option("rangeBytes", size).load(events)
    assert rows(got) == rows(want) and got.count() > 20


def test_filters_leave_out_files_and_ranges(spark, logs):
    register(spark)
    table = spark.read.format("audit_log").option("rangeBytes", 200).load(logs)
    known = rows(table)
    path = known[0][0]
    refs = [r[1] for r in known if r[0] == path]
    picked = table.where((F.col("path") == path) & (F.col("record_ref") >= refs[3]) & (F.col("record_ref") < refs[9]))
    assert rows(picked) == [r for r in known if r[0] == path][3:9]
    assert picked.rdd.getNumPartitions() < table.rdd.getNumPartitions() / 3
    assert rows(table.where(F.col("record_ref") == refs[5])) == [r for r in known if r[1] == refs[5]]
    assert rows(table.where(F.col("path").isin(path, "nowhere"))) == [r for r in known if r[0] == path]
    assert rows(table.where((F.col("record_ref") > refs[5]) & F.col("record_json").contains("PAM"))) == [r for r in known if r[1] > refs[5] and "PAM" in r[2]]


def test_problems(spark, tmp_path):
    register(spark)
    (tmp_path / "x.log").write_bytes(b"type=A msg=audit(1:1): a=1\nnot an audit line\n\xff\xfe type=\ntype=B msg=audit(1:2): b=1")
    with pytest.raises(Exception, match="record 27 of .*x.log - no audit prefix"):
        spark.read.format("audit_log").load(str(tmp_path)).collect()
    left = spark.read.format("audit_log").option("mode", "dropmalformed").load(str(tmp_path)).collect()
    assert [re.search('"type": "(.)"', r.record_json)[1] for r in left] == ["A", "B"]
    with pytest.raises(ValueError, match="mode"):
        RangeReader({"path": str(tmp_path), "mode": "other"}, xml=False)
    with pytest.raises(Exception, match="FileNotFoundError"):
        spark.read.format("audit_log").load(str(tmp_path / "none")).collect()
