"""The stream's sessions against the batch operator, for any order of arrival, and its late rows against plain Python."""

from __future__ import annotations

import random

from logstrata.operators.sessions import sessions
from logstrata.streaming.sessions import merge, replay

SCHEMA = "source string, at long, ref long, value long"


def test_merge_joins_what_a_row_connects():
    assert merge([(0, 10, 2, 5), (25, 30, 1, 1)], [(15, 15, 1, 7), (20, 20, 1, 1), (50, 50, 1, 0)], 5) == [(0, 30, 5, 14), (50, 50, 1, 0)]


def rows_of(seed):
    draw = random.Random(seed)
    return [(draw.choice(["hot"] * 4 + ["a", "b"]), draw.randrange(3000), i, draw.choice([1, 2, None])) for i in range(300)]


def test_shuffled_batches_equal_the_batch_result(spark, tmp_path):
    rows = rows_of(1)
    want = {(r.source, r.start, r.end, r.rows, r.sum_value or 0) for r in sessions(spark.createDataFrame(rows, SCHEMA), ["source"], "at", 8, ["value"]).collect()}
    for seed in (2,):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        # The second batch brings rows of the first again.
        parts = [shuffled[:120], shuffled[60:200], shuffled[200:] + [(None, 1, 900, 1), ("a", None, 901, 1)]]
        found = replay(spark, [spark.createDataFrame(p, SCHEMA).repartition(3) for p in parts], str(tmp_path / str(seed)), gap=8, delay=10_000)
        got = found.collect()
        assert all(r.kind == "session" for r in got)
        assert sorted((r.source, r.start, r.end, r.rows, r.sum) for r in got) == sorted(want)


def test_late_rows_are_set_aside_by_the_clock_of_their_source(spark, tmp_path):
    rows = sorted(rows_of(4), key=lambda r: r[1])
    batches = [[r for r in rows if r[1] // 1000 == n and r[2] % 11] for n in range(3)]
    batches[2] += [r for r in rows if r[1] < 2000 and r[2] % 11 == 0]
    clock, kept, late = {}, [], set()
    for batch in batches:
        before = dict(clock)
        for r in batch:
            if r[0] in before and r[1] < before[r[0]] - 400:
                late.add((r[0], r[2]))
            else:
                kept.append(r)
            clock[r[0]] = max(clock.get(r[0], 0), r[1])
    assert late and len(kept) < len(rows)
    want = {(r.source, r.start, r.end, r.rows, r.sum_value or 0) for r in sessions(spark.createDataFrame(kept, SCHEMA), ["source"], "at", 8, ["value"]).collect()}
    got = replay(spark, [spark.createDataFrame(b, SCHEMA) for b in batches], str(tmp_path), gap=8, delay=400).collect()
    assert {(r.source, r.ref) for r in got if r.kind == "late"} == late
    assert {(r.source, r.start, r.end, r.rows, r.sum) for r in got if r.kind == "session"} == want
