"""Structure profiles, exact frequent values, grouping sets and corpus differences against plain Python."""

from __future__ import annotations

import collections
import json
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from logstrata.functions.jsonleaves import leaves
from logstrata.operators import profile, shards
from logstrata.operators.cubes import SKETCH_ERROR, all_sets, exact_cube, rollup_sets, sketch_cube
from logstrata.operators.difference import block_of, changed_blocks, corpus_diff, write_run


def test_leaves_of_any_shape():
    deep = "[" * 500 + "1" + "]" * 500
    assert leaves(json.loads(deep))[-1] == {"field": "[]" * 500, "type": 4, "value": "1"}
    got = {(x["field"], x["type"], x["value"]) for x in leaves({"a": {"b": [1, {"c": None}]}, "d": True, "": 2.5, "é": "ü"})}
    assert got == {
        ("a", 64, None), ("a.b", 32, None), ("a.b[]", 4, "1"), ("a.b[]", 64, None), ("a.b[].c", 1, "null"), ("d", 2, "true"), ("", 8, "2.5"), ("é", 16, '"ü"'),
    }
    assert leaves(7) == leaves({}) == leaves([]) == []


RECORDS = [
    ("x", 1, '{"id": 1, "tags": ["a", "b"], "v": null, "m": 1}'),
    ("x", 2, '{"id": 2.5, "tags": [], "v": null, "m": "s"}'),
    ("x", 3, '{"id": 3, "m": {"k": 1}}'),
    ("x", 4, "not json"),
    ("x", 5, None),
    ("y", 1, '{"id": "0", "on": true}'),
    ("y", 1, '{"id": "0", "on": null}'),
]


def profiled(rows):
    return {(r.source, r.field): tuple(r)[2:] for r in rows.collect()}


def test_structure_profile(spark):
    records = spark.createDataFrame(RECORDS, "source string, ref long, record_json string")
    want = {
        ("x", "id"): ("number", False, True, 3, 3, 3),
        ("x", "tags"): ("array", False, True, 2, 2, None),
        ("x", "tags[]"): ("string", False, True, 1, 2, 3),
        ("x", "v"): ("null", True, True, 2, 2, 4),
        ("x", "m"): ("mixed", False, True, 3, 3, 3),
        ("x", "m.k"): ("integer", False, True, 1, 1, 1),
        ("y", "id"): ("string", False, True, 1, 2, 3),
        ("y", "on"): ("boolean", True, True, 1, 2, 4),
    }
    for n in (1, 5):
        assert profiled(profile.structure_profile(records.repartition(n), ["source"], ["ref"])) == want
    assert profile.structure_profile(records.limit(0), ["source"], ["ref"]).count() == 0


def test_profiles_merge_in_any_grouping(spark):
    draw = random.Random(1)
    values = [None, 1, 2.5, True, "text", [], [1, "a"], {"k": 1}, {"k": None}]
    rows = [("s", i, json.dumps({f"f{draw.randrange(4)}": draw.choice(values) for _ in range(3)})) for i in range(60)]
    records = spark.createDataFrame(rows, "source string, ref long, record_json string")
    whole = profiled(profile.structure_profile(records, ["source"], ["ref"]))
    for cut in (1, 17, 44):
        parts = [profile.partial_profile(profile.field_values(records.where(c), ["source", "ref"]), ["source"], ["ref"]) for c in (F.col("ref") < cut, F.col("ref") >= cut)]
        merged = profile.merged_profiles(parts[1].union(parts[0]), ["source"])
        totals = records.groupBy("source").agg(F.count("*").alias("all_records"))
        assert profiled(profile.finished_profile(merged, totals, ["source"])) == whole


@pytest.mark.parametrize("counters", [1, 3, 20, 1000])
@pytest.mark.parametrize("k", [1, 4])
def test_top_values_are_exact(spark, monkeypatch, counters, k):
    monkeypatch.setattr(profile, "HELD", 30)
    draw = random.Random(2)
    rows = [("hot", f"v{int(draw.paretovariate(0.7)) % 300}") for _ in range(1500)] + [("flat", f"u{i % 400}") for i in range(900)]
    rows += [(None, draw.choice("ab")) for _ in range(40)] + [("one", "x"), ("none", None), ("hot", None)] + [(f"g{i}", "y") for i in range(70)]
    rows += [("tie", c) for c in "dcba" * 3]
    counted = collections.defaultdict(collections.Counter)
    for g, v in rows:
        if v is not None:
            counted[g][v] += 1
    want = {(g, n + 1, v, c) for g, own in counted.items() for n, (v, c) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:k])}
    found = profile.top_values(spark.createDataFrame(rows, "g string, v string").repartition(6), ["g"], "v", k, counters)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.fixture
def small_batches(spark):
    """Hand a task its rows in many batches, as it gets those of a large table."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "20")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("counters", [1, 3])
def test_a_lowered_summary_takes_further_batches(spark, monkeypatch, small_batches, counters):
    monkeypatch.setattr(profile, "HELD", 30)
    draw = random.Random(6)
    rows = [(g, f"v{int(draw.paretovariate(0.6)) % 200}") for g in ("hot", None) for _ in range(400)] + [("hot", None)]
    draw.shuffle(rows)
    values = spark.createDataFrame(rows, "g string, v string").repartition(2)
    true = collections.Counter(r for r in rows if r[1] is not None)
    low, error = collections.Counter(), collections.Counter()
    for r in profile.frequent_summaries(values, ["g"], "v", counters).collect():
        error[r.g] += r.less
        if r.value is not None:
            low[r.g, r.value] += r.n
    assert error["hot"] > 0 and error[None] > 0
    assert all(low[r] <= true[r] <= low[r] + error[r[0]] for r in true)
    want = {(g, n + 1, v, c) for g in ("hot", None) for n, ((_, v), c) in enumerate(sorted((x for x in true.items() if x[0][0] == g), key=lambda x: (-x[1], x[0][1]))[:4])}
    got = [tuple(r) for r in profile.top_values(values, ["g"], "v", 4, counters).collect()]
    assert len(got) == len(want) and set(got) == want


def test_summaries_bound_every_count(spark):
    draw = random.Random(3)
    rows = [("g", f"v{int(draw.paretovariate(0.5)) % 500}") for _ in range(3000)]
    parts = profile.frequent_summaries(spark.createDataFrame(rows, "g string, v string").repartition(7), ["g"], "v", 12).collect()
    low, error, true = collections.Counter(), sum(r.less for r in parts), collections.Counter(v for _, v in rows)
    for r in parts:
        if r.value is not None:
            low[r.value] += r.n
    assert len(parts) <= 7 * 13 and error > 0
    assert all(low[v] <= true[v] <= low[v] + error for v in true)


CUBE = "a string, b int, size long, item string"


def cube_rows():
    draw = random.Random(4)
    return [(draw.choice(["x", "x", "x", "y", None]), draw.choice([1, 2, None]), draw.choice([5, None]), draw.choice(["p", "q", "r", None])) for _ in range(200)]


@pytest.mark.parametrize("sets", [all_sets(["a", "b"]), rollup_sets(["a", "b"]), [["b"], ["b"], []]])
def test_exact_cube(spark, sets):
    rows = cube_rows()
    want = {}
    for own in {tuple(c in s for c in "ab") for s in sets}:
        groups = collections.defaultdict(list)
        for r in rows:
            groups[tuple(v if kept else None for v, kept in zip(r, own))].append(r)
        for key, held in groups.items():
            sizes = [r[2] for r in held if r[2] is not None]
            want[*key, 2 * (not own[0]) + (not own[1])] = (len(held), sum(sizes) if sizes else None, len({r[3] for r in held} - {None}))
    table = spark.createDataFrame(rows, CUBE)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in exact_cube(table, ["a", "b"], sets, ["size"], ["item"]).collect()}
    assert got == want
    assert exact_cube(table.limit(0), ["a", "b"], sets, ["size"], ["item"]).count() == 0
    with pytest.raises(ValueError, match="dimensions"):
        exact_cube(table, ["a", "b"], [["c"]], [], [])


def test_sketches_are_near_and_merge(spark):
    table = spark.range(40_000).select((F.col("id") % 3).alias("a"), (F.col("id") % 7).alias("b"), (F.col("id") % 9001).alias("item"))
    sets = all_sets(["a", "b"])
    near = {tuple(r)[:3]: tuple(r)[3:] for r in sketch_cube(table.repartition(5), ["a", "b"], sets, ["item"]).collect()}
    exact = {tuple(r)[:3]: tuple(r)[3:] for r in exact_cube(table, ["a", "b"], sets, [], ["item"]).collect()}
    assert near.keys() == exact.keys()
    for key, (rows, items) in exact.items():
        assert near[key][0] == rows and abs(near[key][1] - items) <= 4 * SKETCH_ERROR * items + 1


DIFF = "path string, ref long, text string"


def stored(spark, tmp_path, name, rows, levels=2):
    path = str(tmp_path / name)
    write_run(spark.createDataFrame(rows, DIFF).repartition(3), ["path", "ref", "text"], path, levels)
    return path


def test_corpus_diff_reads_changed_blocks_only(spark, tmp_path):
    draw = random.Random(5)
    rows = [(draw.choice(["p", None, ""]), draw.choice([1, 2, None]), f"t{draw.randrange(90)}") for _ in range(400)]
    later = rows[5:] + rows[20:23] + [("p", 1, "new"), (None, None, None), (None, None, None)]
    draw.shuffle(later)
    left, right = stored(spark, tmp_path, "left", rows), stored(spark, tmp_path, "right", later)
    a, b = collections.Counter(rows), collections.Counter(later)
    want = {(*r, a[r], b[r]) for r in a | b if a[r] != b[r]}
    assert {tuple(r) for r in corpus_diff(spark, left, right, ["path", "ref", "text"]).collect()} == want
    # The records of equal blocks are not needed.
    changed = changed_blocks(*[spark.read.parquet(f"{p}/fingerprints") for p in (left, right)])
    table = spark.createDataFrame([r[:3] for r in want], DIFF)
    assert set(changed) == {r[0] for r in table.select(block_of(["path", "ref", "text"])).collect()}
    for path in (left, right):
        for folder in os.listdir(f"{path}/records"):
            if folder.startswith("block=") and int(folder[6:]) not in changed:
                shutil.rmtree(f"{path}/records/{folder}")
    assert {tuple(r) for r in corpus_diff(spark, left, right, ["path", "ref", "text"]).collect()} == want


def test_corpus_diff_of_equal_and_empty_runs(spark, tmp_path):
    rows = [("p", 1, "a"), ("p", 1, "a"), (None, 2, "")]
    left, same, none = stored(spark, tmp_path, "a", rows, 3), stored(spark, tmp_path, "b", rows[::-1], 3), stored(spark, tmp_path, "c", [], 3)
    columns = ["path", "ref", "text"]
    assert corpus_diff(spark, left, same, columns, 3).count() == 0
    assert {tuple(r) for r in corpus_diff(spark, left, none, columns, 3).collect()} == {("p", 1, "a", 2, 0), (None, 2, "", 1, 0)}
    assert {tuple(r) for r in corpus_diff(spark, none, left, columns, 3).collect()} == {("p", 1, "a", 0, 2), (None, 2, "", 0, 1)}
    assert corpus_diff(spark, none, none, columns, 3).count() == 0


def test_a_written_corpus_is_read_by_its_files(spark, tmp_path):
    rows = [(i, i // 4, f"s{i % 3}", 10 * i, f'{{"n": "{"é" * i}"}}') for i in range(10)]
    sharded = shards.shard_offsets(spark.createDataFrame(rows, "idx long, shard_id int, source_id string, record_ref long, line string"))
    names = spark.createDataFrame([(i, f"s{i}") for i in range(3)], "id int, source_id string")
    path = str(tmp_path / "corpus")
    shards.write_corpus(sharded, names, path)
    got = sorted((r.idx, r.shard_name, r.source_id, r.record_ref, r.line) for r in shards.read_corpus(spark, path).collect())
    assert got == [(i, f"{s:05}.jsonl", name, ref, line) for i, s, name, ref, line in rows]
    spark.read.parquet(f"{path}/index").where("idx <> 6").write.parquet(f"{path}/fewer")
    shutil.rmtree(f"{path}/index")
    os.rename(f"{path}/fewer", f"{path}/index")
    with pytest.raises(Exception, match="no index entry in shard 1"):
        shards.read_corpus(spark, path).collect()
