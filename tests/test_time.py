"""Event times, joins over time, sessions and windows against plain Python, under any cut into blocks."""

from __future__ import annotations

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logstrata.operators.eventtime import event_times
from logstrata.operators.sessions import merged_panes, panes, sessions, windows_of_panes
from logstrata.operators.timejoins import asof_join, interval_join

UTC = dt.timezone.utc


def us(*parts, micro=0):
    return int(dt.datetime(*parts, tzinfo=UTC).timestamp()) * 1_000_000 + micro


def read(spark, lines):
    rows = [(p, i // 2, i, line) for i, (p, line) in enumerate(lines)]
    found = event_times(spark.createDataFrame(rows, "path string, block long, seq long, line string"))
    return {r.seq: (r.time_format, r.us, r.time_problem) for r in found.withColumn("us", F.unix_micros("event_time")).collect()}


NONE = (None, None, "no time of a known format")


def test_every_format_is_read(spark):
    lines = [
        ("a", "type=X msg=audit(1700000000.337:12): pid=1"),
        ("b", "type=X msg=audit(02/20/2025 13:07:46.504:118908) : x"),
        ("c", '1.2.3.4 - - [19/Jan/2022:07:46:29 -0130] "GET / HTTP/1.1" 200 1 "-" "-"'),
        ("d", '{"t": "2021-12-31T23:59:59.1234567+05:30"}'),
        ("e", '<TimeCreated SystemTime="2022-02-28 01:02:03Z"/>'),
        ("f", '{"FileTime": 132223104000000019}'),
        ("g", "nothing"),
        ("h", None),
        ("i", ""),
        ("j", "[31/Feb/2022:07:46:29 +0000]"),
        ("k", "2022-13-01T00:00:00Z"),
        ("l", "2022-01-01T00:00:60Z"),
        ("m", "2022-01-01T24:00:00Z"),
    ]
    assert [found for _, found in sorted(read(spark, lines).items())] == [
        ("audit_epoch", 1_700_000_000_337_000, None),
        ("month_first", us(2025, 2, 20, 13, 7, 46, micro=504_000), None),
        ("httpdate", us(2022, 1, 19, 9, 16, 29), None),
        ("iso", us(2021, 12, 31, 18, 29, 59, micro=123_456), None),
        ("iso", us(2022, 2, 28, 1, 2, 3), None),
        ("filetime", us(2020, 1, 1, micro=1), None),
        NONE,
        (None, None, None),
        *[NONE] * 5,
    ]


def test_votes_over_all_blocks_settle_a_source(spark):
    both = "msg=audit(03/04/2024 00:00:00:1) :"
    lines = [("us", both)] * 5 + [("us", "msg=audit(03/14/2024 00:00:00:1) :")]
    lines += [("eu", both)] * 5 + [("eu", "msg=audit(14/03/2024 00:00:00:1) :")] + [("eu", "seen 2020-01-01 00:00:00")]
    got = read(spark, lines)
    assert [got[i][1] for i in range(5)] == [us(2024, 3, 4)] * 5 and got[5][1] == us(2024, 3, 14)
    assert [got[i][1] for i in range(6, 11)] == [us(2024, 4, 3)] * 5 and got[11][1] == us(2024, 3, 14)
    assert got[12] == ("iso", us(2020, 1, 1), None)
    # The losing reading of a date is not used, even where it alone is valid.
    got = read(spark, [("x", "msg=audit(13/01/2024 00:00:00:1) :"), *[("x", "msg=audit(01/13/2024 00:00:00:1) :")] * 2])
    assert [got[i][0] for i in range(3)] == [None, "month_first", "month_first"]


def test_a_decoy_yields_to_the_format_of_the_source(spark):
    plain, decoy = "msg=audit(1700000000.001:1): x", 'msg=audit(1700000000.001:1): note="2001-01-01 00:00:00"'
    got = read(spark, [("a", plain), ("a", decoy), ("b", decoy), ("b", "2002-01-01 00:00:00"), ("b", "2002-01-01 00:00:00")])
    assert [got[i][0] for i in range(5)] == ["audit_epoch", "audit_epoch", "iso", "iso", "iso"]


POINTS = "key string, at long, id long"
SPANS = "key string, low long, high long, span long"


@pytest.mark.parametrize("cell_points", [3, 1_000_000])
@pytest.mark.parametrize("on", [["key"], []])
def test_interval_join(spark, cell_points, on):
    draw = random.Random(1)
    key = lambda: draw.choice(["hot", "hot", "a", "b", None])
    points = [(key(), draw.choice([draw.randrange(-5000, 5000), 7, None]), i) for i in range(400)] + [("hot", 7, 3), ("hot", 2**62, 900)]
    spans = [(key(), low := draw.randrange(-6000, 6000), low + draw.choice([-4, 0, 1, 2, 9, 100, 3000]), i) for i in range(120)]
    spans += [("hot", -(2**62), 2**62, 500), ("hot", 7, 8, 501), ("hot", 7, 8, 501), ("a", None, 9, 502), (None, 0, 9, 503)]
    names = [c for c in ("key",) if c in on]
    left, right = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)
    if not on:
        left, right = left.withColumnRenamed("key", "own"), right.drop("key")
    got = collections.Counter(tuple(r[c] for c in ("id", "span")) for r in interval_join(left, right, "at", "low", "high", names, cell_points).collect())
    want = collections.Counter(
        (i, s) for k, at, i in points for q, low, high, s in spans
        if at is not None and low is not None and low <= at < high and (not on or (k is not None and k == q))
    )
    assert got == want


def test_one_interval_over_the_whole_table_and_timestamps(spark):
    points = spark.range(5000).select("id", F.timestamp_micros(F.col("id") * 977 + 1_700_000_000_000_000).alias("at"))
    spans = points.agg(F.min("at").alias("low"), F.timestamp_micros(F.unix_micros(F.max("at")) + 1).alias("high"))
    held = interval_join(points, spans, "at", "low", "high", cell_points=50)
    assert held.count() == 5000 and held.columns == ["id", "at", "low", "high"]
    assert interval_join(points.limit(0), spans, "at", "low", "high").count() == 0
    assert interval_join(points, spans.limit(0), "at", "low", "high").count() == 0
    with pytest.raises(ValueError, match="rename"):
        interval_join(points, spans.withColumn("id", F.lit(1)), "at", "low", "high")
    with pytest.raises(ValueError, match="neither"):
        interval_join(points.withColumn("at", F.lit("x")), spans, "at", "low", "high")


@pytest.mark.parametrize("block_rows", [1, 4, 50, 200_000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_asof_join(spark, block_rows, inclusive):
    draw = random.Random(2)
    key = lambda: draw.choice(["hot"] * 4 + ["a", "b", None])
    rows = [(key(), draw.choice([draw.randrange(-300, 300), 5, None]), i) for i in range(300)] + [("hot", 5, 1)]
    versions = [(key(), draw.choice([draw.randrange(-200, 250), 5, None]), i % 17) for i in range(60)]
    left = spark.createDataFrame(rows, POINTS)
    right = spark.createDataFrame(versions, "key string, since long, version long")
    for within in (None, 20):
        got = collections.Counter(tuple(r) for r in asof_join(left, right, "at", "since", ["key"], inclusive, within, block_rows).collect())
        want = collections.Counter()
        for k, at, i in rows:
            fits = [(s, v) for q, s, v in versions if None not in (k, at, s) and q == k and (s <= at if inclusive else s < at)]
            best = max(fits, default=(None, None))
            want[k, at, i, *(best if best[0] is not None and (within is None or at - best[0] <= within) else (None, None))] += 1
        assert got == want


def test_asof_join_of_empty_tables(spark):
    rows = spark.createDataFrame([("a", 1, 1)], POINTS)
    versions = spark.createDataFrame([], "key string, since long, version long")
    assert [tuple(r) for r in asof_join(rows, versions, "at", "since", ["key"]).collect()] == [("a", 1, 1, None, None)]
    assert asof_join(rows.limit(0), versions, "at", "since", ["key"]).count() == 0


@pytest.mark.parametrize("block_rows", [1, 3, 40, 200_000])
def test_sessions_do_not_depend_on_the_cut(spark, block_rows):
    draw = random.Random(3)
    rows = [(draw.choice(["hot"] * 5 + ["a", "b", None]), draw.choice([draw.randrange(900), draw.randrange(120), None]), draw.choice([1, 2, None])) for _ in range(260)]
    rows += [("long", 10 * i, 1) for i in range(90)] + [("split", 0, None), ("split", 10, None), ("split", 21, 4)]
    want = []
    for key in {k for k, at, _ in rows if k is not None and at is not None}:
        own = sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: r[1])
        runs = [[own[0]]]
        for r in own[1:]:
            runs.append([r]) if r[1] - runs[-1][-1][1] > 10 else runs[-1].append(r)
        for n, run in enumerate(runs):
            known = [v for *_, v in run if v is not None]
            want.append((key, n, run[0][1], run[-1][1], len(run), sum(known) if known else None))
    found = sessions(spark.createDataFrame(rows, "key string, at long, v long").repartition(5), ["key"], "at", 10, ["v"], block_rows)
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert sessions(found.limit(0), ["key"], "start", 1).count() == 0


@pytest.mark.parametrize(("size", "slide"), [(40, 40), (40, 10), (40, 20), (30, 50), (10, 10)])
def test_windows_of_panes(spark, size, slide):
    draw = random.Random(4)
    rows = [(draw.choice(["hot"] * 5 + ["a", None]), draw.choice([draw.randrange(-200, 300), draw.randrange(1000), None]), draw.randrange(50)) for _ in range(150)]
    want = collections.defaultdict(list)
    for key, at, v in rows:
        for start in range(-400, 1100):
            if at is not None and start % slide == 0 and start <= at < start + size:
                want[key, start].append(v)
    parts = panes(spark.createDataFrame(rows, "key string, at long, v long"), ["key"], "at", 10, "v")
    halves = [panes(spark.createDataFrame(rows[a:b], "key string, at long, v long"), ["key"], "at", 10, "v") for a, b in ((0, 60), (60, 150))]
    for own in (parts, merged_panes(halves[0].union(halves[1]), ["key"])):
        got = {(r.key, r.start): tuple(r)[2:] for r in windows_of_panes(own, ["key"], 10, size, slide).collect()}
        assert got == {k: (len(v), sum(v), min(v), max(v)) for k, v in want.items()}
    with pytest.raises(ValueError, match="multiples"):
        windows_of_panes(parts, ["key"], 10, 25, 10)
