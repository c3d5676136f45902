"""What keeps the work in proportion to the input: rows read once, few state calls, tasks by bytes, files put in place by tasks."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from logstrata.operators import eventtime, profile, shards, timejoins
from logstrata.operators.sessions import sessions
from logstrata.sources import archives, datasource
from logstrata.streaming.sessions import SourceSessions


@pytest.fixture
def counted(spark):
    """Rows, and how often one of them was made."""
    made = spark.sparkContext.accumulator(0)

    def touch(n):
        made.add(1)
        return n

    at = F.udf(touch, LongType()).asNondeterministic()
    rows = spark.range(60).select(F.concat(F.lit("h"), F.col("id") % 3).alias("host"), at("id").alias("at"), F.lit(1).alias("v"))
    return rows, made


def test_asof_join_makes_its_rows_once(spark, counted):
    rows, made = counted
    versions = spark.createDataFrame([("h0", 5, "a"), ("h1", 7, "b")], "host string, since long, version string")
    found = timejoins.asof_join(rows, versions, "at", "since", on=["host"], block_rows=5).collect()
    assert len(found) == 60 and sum(r.version is not None for r in found) == 36
    assert made.value == 60


def test_interval_join_makes_its_points_once(spark, counted):
    rows, made = counted
    spans = spark.createDataFrame([("h0", 5, 20, 1), ("h1", 7, 9, 2)], "host string, start long, end long, span long")
    found = timejoins.interval_join(rows, spans, "at", "start", "end", on=["host"], cell_points=2).collect()
    assert sorted((r.at, r.span) for r in found) == [(6, 1), (7, 2), (9, 1), (12, 1), (15, 1), (18, 1)]
    assert made.value == 60


def test_sessions_make_their_rows_once(counted):
    rows, made = counted
    assert len(sessions(rows, ["host"], "at", 2, ["v"], block_rows=5).collect()) == 60
    assert made.value == 60


def test_top_values_make_their_values_once(counted):
    rows, made = counted
    assert len(profile.top_values(rows, ["host"], "at", 2, counters=3).collect()) == 6
    assert made.value == 60


def test_lines_meet_the_formats_of_their_source_without_an_exchange(spark, capsys):
    lines = spark.createDataFrame([("p", 0, "msg=audit(1700000000.5:1)"), ("p", 0, ""), ("p", 0, None)], "path string, block long, line string")
    timed = eventtime.event_times(lines)
    timed.explain()
    assert "BroadcastHashJoin" in (plan := capsys.readouterr().out) and "SortMergeJoin" not in plan
    assert sorted(str(r.event_time) for r in timed.collect()) == ["2023-11-14 22:13:20.500000", "None", "None"]


def test_many_small_files_are_few_tasks(tmp_path):
    for n in range(100):
        (tmp_path / f"{n:03}.log").write_text("type=A msg=audit(1:2): a=b\n")
    reader = datasource.RangeReader({"path": str(tmp_path)}, xml=False)
    lots = reader.partitions()
    assert len(lots) == 2 and len({r.path for lot in lots for r in lot.ranges}) == 100
    assert len([row for lot in lots for row in reader.read(lot)]) == 100


def test_shard_files_are_put_in_place_by_their_tasks(spark, tmp_path, monkeypatch):
    given, option = {}, DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: given.update({k: v}) or option(self, k, v))
    sharded = spark.createDataFrame([(n, n // 3, f"line {n}") for n in range(9)], "idx long, shard_id int, line string")
    shards.write_shards(sharded, str(tmp_path / "out"))
    assert given["mapreduce.fileoutputcommitter.algorithm.version"] == "2"
    assert sorted(spark.read.text(str(tmp_path / "out")).select("shard_id", "value").collect()) == [(n // 3, f"line {n}") for n in range(9)]


def test_a_null_file_has_no_content(spark):
    import gzip

    files = spark.createDataFrame([("a.gz", gzip.compress(b"x")), ("b.gz", None)], "path string, content binary")
    assert sorted((r.path, r.content) for r in archives.gz_members(files).collect()) == [("a", b"x"), ("b", None)]


class Held:
    """A state that counts the calls of one source."""

    def __init__(self, calls):
        self.calls, self.held = calls, {}

    def __getattr__(self, name):
        def call(*given):
            self.calls.append(name)
            if name == "get":
                return self.held.get("all")
            if name == "exists":
                return "all" in self.held
            if name == "iterator":
                return list(self.held.items())
            if name in ("update", "put"):
                self.held["all"] = given[0]
            elif name == "updateValue":
                self.held[given[0]] = given[1]
            elif name == "removeKey":
                self.held.pop(given[0])
            elif name == "containsKey":
                return given[0] in self.held
            elif name == "clear":
                self.held.clear()

        return call

    def getCurrentWatermarkInMs(self):
        return 0


class Handle:
    def __init__(self):
        self.calls = []

    def getValueState(self, *_):
        return Held(self.calls)

    getListState = getMapState = getValueState

    def listTimers(self):
        return []

    def registerTimer(self, _):
        pass


def test_a_batch_takes_few_calls_to_the_state():
    processor, handle = SourceSessions(gap=2, delay=1_000, idle_ms=1), Handle()
    processor.init(handle)
    rows = pd.DataFrame({"ref": range(5_000), "at": [n * 5 for n in range(5_000)], "value": 1})
    (first,) = processor.handleInputRows(("s",), iter([rows[:3_000], rows[2_000:]]), Held([]))
    (again,) = processor.handleInputRows(("s",), iter([rows[4_800:], pd.DataFrame({"ref": [7_000, 7_001], "at": [24_994, 3], "value": [4, 4]})]), Held([]))
    assert len(handle.calls) < 40
    # The first 4,800 are closed; of the others nothing counts twice, one row joins the last of them and one is late.
    assert len(first) == 4_799 and first["rows"].eq(1).all()
    assert again["kind"].tolist() == ["late"] and again["ref"].tolist() == [7_001]
    assert processor.open.get()[-1] == (24_994, 24_995, 2, 5)
