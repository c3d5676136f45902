"""Raw folders of the six datasets, ingested end to end."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from logstrata.operators import classify
from logstrata.plans import datasets
from logstrata.plans.ingest import Corpus, ingest_dataset, ingest_discovered
from logstrata.sources import archives, catalogs, files

VISIT = '10.20.30.40 - - [03/Feb/2021:18:05:44 +0000] "GET /shop HTTP/1.1" 200 915 "-" "-"\n'
KERNEL = "type=ADD_USER msg=audit(1700000123.250:77): pid=812 uid=5 res=0\n"
RECORD = '{"eventName": "A", "id": {"x": 1, "y": 2}}\n'
XML = "<Event xmlns='u'><System><EventID>4688</EventID></System><D Name='c'>a 2>&1</D></Event>\n"


def write_archive(path, members):
    packed = io.BytesIO()
    archive = zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED)
    for entry in members.items():
        archive.writestr(*entry)
    archive.close()
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(packed.getvalue())


def formats_of(found):
    return {r["file_name"]: r["format"] for r in found.sources.collect()}


def summary(df):
    r = df.first()
    return r["files_ingested"], r["files_skipped"], r["records_written"], r["records_dropped"]


def everything(corpus, spark):
    """All records by position, read back through index and shard files."""
    wanted = corpus.index().select("idx")
    return [json.loads(r["line"]) for r in corpus.fetch(wanted).orderBy("idx").collect()]


def test_archive_logs_folder(spark, tmp_path):
    write_archive(tmp_path / "b/two.zip", {"real.json": RECORD, "__MACOSX/._real.json": b"\x00junk"})
    write_archive(tmp_path / "a-b/one.zip", {"sh.log": KERNEL})
    write_archive(tmp_path / "a/zeek.zip", {"x/conn.log": RECORD * 2, "x/tsv.log": "#separator \\x09\n", "x/blank.log": "\n \n"})
    write_archive(tmp_path / "cap.zip", {"c.pcap": b"\x00\x01", "c.sha1sum": "x"})
    write_archive(tmp_path / "csv.zip", {"d.csv": "a,b\n"})
    found = datasets.discover(spark, "otrf", str(tmp_path))
    assert formats_of(found) == {
        "b/two/real.json": classify.JSON_LINES, "a-b/one/sh.log": classify.AUDITD, "a/zeek/x/conn.log": classify.JSON_LINES,
    }
    ordered = [r["file_name"] for r in found.sources.orderBy("ord").collect()]
    assert ordered == ["a/zeek/x/conn.log", "a-b/one/sh.log", "b/two/real.json"]
    row = found.sources.where("file_name = 'b/two/real.json'").first()
    assert row["labeled"] and row["license"] == "GPL-3.0" and row["checksum_sha256"] == hashlib.sha256(RECORD.encode()).hexdigest()


def test_several_json_files_in_one_archive_are_an_error(spark, tmp_path):
    write_archive(tmp_path / "bad.zip", {"a.json": "{}", "b.json": "{}"})
    with pytest.raises(Exception, match="several .json members"):
        datasets.discover(spark, "otrf", str(tmp_path)).sources.collect()


# One member for each branch of the path rule, then one that just misses each branch.
HOST_MEMBERS = {
    "gather/shop/logs/apache2/access_tls.log": VISIT,
    "gather/shop/logs/apache2/old.access.7": VISIT,
    "gather/shop/logs/horde/horde-access.log": VISIT,
    "gather/shop/logs/audit/audit.log": KERNEL,
    "gather/shop/logs/suricata/eve.json": RECORD,
    "gather/backup/logs/logstash/disks/metrics.jsonl": RECORD,
    "gather/shop/logs/apache2/ssl.log": VISIT,
    "gather/shop/logs/horde/access.log": VISIT,
    "gather/shop/logs/audit/audit.txt": KERNEL,
    "gather/shop/logs/suricata/fast.json": RECORD,
    "gather/backup/logs/logstash/disks/system.service.jsonl": RECORD,
    "gather/backup/logs/logstash/self.jsonl": RECORD,
    "gather/shop/conf/audit/audit.log": KERNEL,
    "facts/shop/logs/audit/audit.log": KERNEL,
}


def test_host_logs_ingest_and_rerun(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    write_archive(raw / "fox.zip", HOST_MEMBERS)
    assert summary(ingest_dataset(spark, "ait_lds", str(raw), out, shard_size=4)) == (6, 0, 6, 0)
    assert summary(ingest_dataset(spark, "ait_lds", str(raw), out, shard_size=4)) == (0, 6, 0, 0)
    # A new scenario continues the last shard and the numbering.
    write_archive(raw / "harrison.zip", HOST_MEMBERS)
    assert summary(ingest_dataset(spark, "ait_lds", str(raw), out, shard_size=4)) == (6, 6, 6, 0)

    corpus = Corpus(spark, out, "ait_lds")
    assert corpus.count() == 12
    index = corpus.index().orderBy("idx").collect()
    assert [r["idx"] for r in index] == list(range(12))
    assert [r["shard_id"] for r in index] == [0] * 4 + [1] * 4 + [2] * 4
    records = everything(corpus, spark)
    assert records[:6] == records[6:] and records[0]["eventName"] == "A"
    assert records[1]["clientip"] == "10.20.30.40" and records[1]["rawrequest"] is None
    ids = {r["id"]: r["source_id"] for r in corpus.dictionary().collect()}
    assert sorted(ids) == list(range(12))
    assert ids[0] == "ait_lds/fox/gather/backup/logs/logstash/disks/metrics.jsonl"
    assert all(ids[i].startswith("ait_lds/fox/") for i in range(6))
    wanted = spark.createDataFrame([(ids[7],), ("ait_lds/none",)], "source_id string")
    assert [r["idx"] for r in corpus.indices_for_source(wanted).collect()] == [7]
    joined = corpus.provenance().orderBy("idx").collect()
    assert len(joined) == 12 and joined[7]["source_id"] == ids[7] and joined[0]["license"] == "CC-BY-NC-SA-4.0"
    beyond = spark.createDataFrame([(-1,), (12,)], "idx bigint")
    assert {r["idx"]: r["line"] is None for r in corpus.fetch(beyond).collect()} == {-1: False, 12: True}


def test_shard_files_hold_the_bytes_the_index_names(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    write_archive(raw / "s.zip", {"gather/h/logs/suricata/eve.json": "".join(f'{{"a":{i},"b":"é{i}","c":[1],"d":null}}\n' for i in range(25))})
    ingest_dataset(spark, "ait_lds", str(raw), str(out), shard_size=10)
    corpus = Corpus(spark, str(out), "ait_lds")
    shards = {p.parent.name: p.read_bytes() for p in (out / "corpus/ait_lds/shards").rglob("part-*")}
    assert sorted(shards) == ["shard_id=0", "shard_id=1", "shard_id=2"]
    for r in corpus.index().collect():
        line = shards[f"shard_id={r['shard_id']}"][r["offset"] :].split(b"\n", 1)[0]
        value = {"a": r["idx"], "b": f"é{r['idx']}", "c": [1], "d": None}
        assert line.decode() == json.dumps(value)


def test_cloud_trail_folder(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    documents = {
        "logs/c00.json.gz": {"Records": [{"eventName": "A", "b": {"c": 1, "d": 2}}, {"eventName": "B"}]},
        "logs/c01.json.gz": {"Records": [{"eventName": "C", "b": {"c": 1, "d": [{"e": 1}]}}, 400]},
    }
    with tarfile.open(raw / "trail.tar", "w") as tf:
        for name, document in documents.items():
            data = gzip.compress(json.dumps(document).encode())
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tf.addfile(info, io.BytesIO(data))
        notes = tarfile.TarInfo("logs/notes.txt")
        notes.size = 1
        tf.addfile(notes, io.BytesIO(b"x"))
    out = str(tmp_path / "out")
    assert summary(ingest_dataset(spark, "flaws_cloud", str(raw), out)) == (2, 0, 2, 2)
    corpus = Corpus(spark, out, "flaws_cloud")
    manifest = {r["file_name"]: r for r in corpus.manifest().collect()}
    assert set(manifest) == {"trail/logs/c00.json", "trail/logs/c01.json"}
    assert manifest["trail/logs/c00.json"]["record_ref_type"] == "array_index"
    assert [r["eventName"] for r in everything(corpus, spark)] == ["A", "C"]


def test_vendor_fixtures_folder(spark, tmp_path):
    base = "packages/{}/data_stream/{}/_dev/test/pipeline/"
    contents = {
        base.format("okta", "system") + "test-b.log": RECORD + "\n" + RECORD,
        base.format("blue", "log") + "test-x.log": "plain text\n",
        base.format("mix", "log") + "test-x.log": RECORD + "Jan 1 host {}\n",
        base.format("auth0", "logs") + "test-a.json": json.dumps({"events": [{"message": RECORD}, {"json": {"p": 1, "q": 2, "r": 3, "s": 4}}]}),
        base.format("citrix", "logs") + "test-a.json": json.dumps({"events": [{"message": "<1> raw"}]}),
        base.format("auth0", "logs") + "test-a.json-expected.json": json.dumps({"events": [{"message": RECORD}]}),
        base.format("auth0", "logs") + "test-a-expected.json": json.dumps({"expected": []}),
        base.format("auth0", "logs") + "sub/test-c.log": RECORD,
        "docs/" + base.format("auth0", "logs") + "test-d.log": RECORD,
    }
    for name, text in contents.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    found = datasets.discover(spark, "elastic_fixtures", str(tmp_path))
    assert formats_of(found) == {
        base.format("okta", "system") + "test-b.log": classify.JSON_LINES,
        base.format("auth0", "logs") + "test-a.json": classify.EVENTS_WRAPPER,
    }
    # Line files are numbered before wrapped ones although their folder sorts later.
    assert [r["format"] for r in found.sources.orderBy("ord").collect()] == [classify.JSON_LINES, classify.EVENTS_WRAPPER]
    out = str(tmp_path / "out")
    assert summary(ingest_discovered(spark, "elastic_fixtures", found, out, minimum_fields=None)) == (2, 0, 4, 0)
    assert everything(Corpus(spark, out, "elastic_fixtures"), spark)[3] == {"p": 1, "q": 2, "r": 3, "s": 4}


MANIFEST = """\
author: Test
date: 2025-01-01
mitre_technique:
- T1234
datasets:
- name: trail
  path: /datasets/T1/d/trail.json
  sourcetype: aws:cloudtrail
- name: audit
  path: /datasets/T1/d/audit.log
  sourcetype: auditd
- name: win
  path: /datasets/T1/d/windows-security.log
  sourcetype: " XmlWinEventLog"
- name: gone
  path: /datasets/T1/d/gone.log
  sourcetype: auditd
- name: nopath
  sourcetype: auditd
- name: mail
  path: /datasets/T1/d/mail.log
  sourcetype: MSExchange:Management
"""


def test_attack_catalog_folder(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    folder = raw / "datasets/T1/d"
    folder.mkdir(parents=True)
    (folder / "one.yml").write_text(MANIFEST)
    (folder / "TEMPLATE.yml").write_text(MANIFEST.replace("audit.log", "mail.log"))
    (folder / "empty.yml").write_text("")
    # The same sample listed again, by a manifest without a technique.
    (folder / "two.yml").write_text("datasets:\n- path: datasets/T1/d/trail.json\n  sourcetype: o365\n- path: datasets/T1/d/k.log\n")
    (folder / "trail.json").write_text(RECORD * 3)
    (folder / "audit.log").write_text(KERNEL * 2)
    (folder / "windows-security.log").write_text(XML * 2 + "<Event broken")
    (folder / "mail.log").write_text(RECORD)
    (folder / "k.log").write_text("\n" + KERNEL)
    samples = catalogs.catalog_samples(files.read_texts(spark, str(raw / "datasets"), "*.yml"))
    assert samples.count() == 8
    assert {r["path"] for r in classify.missing_samples(samples, files.relative_names(files.list_files(spark, str(raw)), str(raw)).select(F.col("file_name").alias("path"))).collect()} == {"datasets/T1/d/gone.log"}
    assert {r["path"] for r in classify.sample_candidates(samples).collect()} >= {"datasets/T1/d/trail.json", "datasets/T1/d/gone.log"}

    assert summary(ingest_dataset(spark, "splunk_attack_data", str(raw), out)) == (4, 1, 8, 0)
    corpus = Corpus(spark, out, "splunk_attack_data")
    rows = {r["file_name"]: (r["labeled"], r["record_count"]) for r in corpus.manifest().collect()}
    assert rows == {
        "datasets/T1/d/trail.json": (True, 3), "datasets/T1/d/audit.log": (True, 2),
        "datasets/T1/d/windows-security.log": (True, 2), "datasets/T1/d/k.log": (False, 1),
    }
    records = everything(corpus, spark)
    assert [set(r) for r in records[5:7]] == [{"Event"}] * 2 and records[5]["Event"]["D"]["#text"] == "a 2>&1"


def test_windows_events_table(spark, tmp_path):
    listed = spark.createDataFrame(
        [("p/a.evtx", "p/a.evtx", 5, "c1"), ("p/b.txt", "p/b.txt", 5, "c2")],
        "path string, file_name string, bytes bigint, checksum_sha256 string",
    )
    event = '{"Event":{"System":{"EventID":1,"EventRecordID":%d},"EventData":{"User":"u"}}}'
    # Records keep the order of the file, whatever their ids are.
    events = spark.createDataFrame([("p/a.evtx", 0, event % 9), ("p/a.evtx", 1, "bad"), ("p/a.evtx", 2, event % 3)], "path string, seq bigint, event string")
    out = str(tmp_path / "out")
    assert summary(ingest_discovered(spark, "evtx_attack_samples", datasets.windows_events(listed, events), out)) == (1, 0, 2, 0)
    corpus = Corpus(spark, out, "evtx_attack_samples")
    assert [r["record_ref"] for r in corpus.index().orderBy("idx").collect()] == [9, 3]


def test_quarantine_keeps_good_records_and_lists_the_others(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    write_archive(raw / "s.zip", {"gather/h/logs/audit/audit.log": KERNEL + "garbage\n" + KERNEL})
    with pytest.raises(Exception, match="no audit prefix"):
        ingest_dataset(spark, "ait_lds", str(raw), out)
    # The failed run left nothing that is visible.
    assert Corpus(spark, out, "ait_lds").count() == 0
    assert summary(ingest_dataset(spark, "ait_lds", str(raw), out, mode="quarantine")) == (1, 0, 2, 0)
    problems = spark.read.parquet(f"{out}/corpus/ait_lds/problems").collect()
    assert [(r["record_ref"], r["problem"]) for r in problems] == [(len(KERNEL), "no audit prefix")]


def test_member_names_without_unpacking(spark, tmp_path):
    write_archive(tmp_path / "a.zip", {"d/x.json": "{}", "d/._x.json": ""})
    names = archives.member_names(files.read_contents(spark, str(tmp_path)))
    assert {r["member"] for r in names.collect()} == {"d/x.json", "d/._x.json"}
    assert classify.archive_candidates(names).count() == 1


def test_unknown_dataset(spark):
    with pytest.raises(LookupError, match="unknown dataset"):
        datasets.discover(spark, "nope", "/tmp")


def test_stream_ingests_arriving_files_once(spark, tmp_path):
    from logstrata.streaming.ingest import stream_ingest

    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream_ingest(spark, "ait_lds", str(raw), out, state).awaitTermination()
        return Corpus(spark, out, "ait_lds").count()

    write_archive(raw / "a.zip", {"gather/h/logs/audit/audit.log": KERNEL})
    assert run() == 1
    assert run() == 1
    write_archive(raw / "b.zip", {"gather/h/logs/audit/audit.log": KERNEL * 2})
    assert run() == 3
