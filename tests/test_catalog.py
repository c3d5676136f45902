from __future__ import annotations

import random

from pyspark.sql import functions as F

from logstrata.operators import catalog, classify, ordering, shards

FILES = "dataset_id string, file_name string, checksum_sha256 string, ord bigint"


def in_sequence(files, manifest):
    """Ids and skips as a one-by-one ingest would decide them."""
    held, out = dict(manifest), []
    for name, checksum, _ in files:
        source_id = f"d/{name}"
        if source_id in held and held[source_id] != checksum:
            source_id += f"#{checksum[:8]}"
        out.append((source_id, source_id not in held))
        held.setdefault(source_id, checksum)
    return out


def test_ids_match_a_sequential_ingest(spark):
    rng = random.Random(7)
    checksums = [f"{rng.getrandbits(64):016x}" for _ in range(12)]
    # Same eight leading digits, different file: taken for the one already there.
    checksums.append(checksums[0][:8] + "f" * 8)
    names = [f"n{i}" for i in range(15)]
    # Names that look like the id some other file is given.
    names += [f"n{i}#{c[:8]}" for i in (3, 4, 5) for c in checksums[:6]]
    files = [(rng.choice(names), rng.choice(checksums), i) for i in range(400)]
    manifest = {"d/n1": checksums[3], "d/n2": checksums[0], f"d/n2#{checksums[4][:8]}": checksums[4], "d/gone": "x"}
    df = spark.createDataFrame([("d", *f) for f in files], FILES)
    known = spark.createDataFrame(list(manifest.items()), "source_id string, checksum_sha256 string")
    marked = catalog.mark_new(catalog.assign_source_id(df, known), known).orderBy("ord").collect()
    assert [(r["source_id"], r["is_new"]) for r in marked] == in_sequence(files, manifest)


def test_collision_report_names_the_second_file(spark):
    df = spark.createDataFrame([("d", "a", "c" * 64, 0), ("d", "a", "e" * 64, 1), ("d", "b", "c" * 64, 2)], FILES)
    report = catalog.collision_report(catalog.assign_source_id(df, catalog.empty_manifest(spark)))
    assert [tuple(r) for r in report.collect()] == [("d", "a", "d/a#eeeeeeee")]


def test_upsert_keeps_the_first_position_and_the_last_row(spark):
    schema = "source_id string, n int, version bigint"
    first = spark.createDataFrame([("b", 1, 0), ("a", 1, 1)], schema)
    later = spark.createDataFrame([("b", 2, 2), ("c", 2, 3), ("b", 3, 4)], schema)
    merged = catalog.manifest_upsert(first, later)
    assert [tuple(r) for r in catalog.manifest_sorted(merged, sort=False).collect()] == [("b", 3, 0), ("a", 1, 1), ("c", 2, 3)]
    assert [r["source_id"] for r in catalog.manifest_sorted(merged).collect()] == ["a", "b", "c"]


def test_path_order_compares_parts(spark):
    paths = ["a-b/x", "a/x", "a/b/c", "a/z", "a"]
    df = spark.createDataFrame([(p,) for p in paths], "path string").orderBy(catalog.path_order(F.col("path")))
    assert [r["path"] for r in df.collect()] == sorted(paths, key=lambda p: p.split("/"))


def test_ordered_prefix_is_exact_with_more_rows_than_boundaries(spark):
    rows = [(f"k{(i * 7919) % 5000:05d}", i % 9) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(7)
    got = {r["k"]: r["before"] for r in ordering.ordered_prefix(df, ["k"], F.col("n"), "before").collect()}
    total = 0
    for k, n in sorted(rows):
        assert got[k] == total
        total += n


def test_manifest_lists_files_without_records(spark):
    sources = spark.createDataFrame(
        [("d/a", "d", "a", "u", "l", "c1", 5, True, classify.JSON_LINES), ("d/b", "d", "b", "u", "l", "c2", 6, False, classify.JSON_ARRAY)],
        "source_id string, dataset_id string, file_name string, source_url string, license string, checksum_sha256 string, "
        "bytes bigint, labeled boolean, format string",
    )
    records = spark.createDataFrame([("d/a",), ("d/a",)], "source_id string")
    rows = {r["source_id"]: r for r in catalog.manifest_build(sources, records).collect()}
    assert rows["d/a"]["record_count"] == 2 and rows["d/b"]["record_count"] == 0
    assert rows["d/b"]["record_ref_type"] == "array_index" and len(rows["d/a"]["ingested_at"]) == 10
    assert list(rows["d/a"].asDict()) == catalog.MANIFEST_COLUMNS


def indexed(spark, n):
    """Records of files of seven records in blocks of three, numbered."""
    rows = [(f"s{i // 7:03d}", (i % 7) // 3, i % 7, f'{{"n":{i}}}') for i in range(n)]
    records = spark.createDataFrame(rows, "path string, block bigint, position bigint, record_json string").repartition(5)
    sources = records.select("path", F.concat(F.lit("d/"), "path").alias("source_id"), F.array("path").alias("source_ord"))
    return shards.global_index(records, sources.distinct())


def test_global_index_is_dense_and_ordered(spark):
    got = indexed(spark, 1000).collect()
    assert {r["record_json"]: r["idx"] for r in got} == {f'{{"n":{i}}}': i for i in range(1000)}
    assert {(r["path"], r["source_id"]) for r in got} == {(f"s{i:03d}", f"d/s{i:03d}") for i in range(143)}


def test_shards_roll_over_and_resume(spark):
    def assigned(first, last, held, n):
        frame = spark.range(n).select((F.col("id") + first).alias("idx"))
        return [r["shard_id"] for r in shards.shard_assign(frame, 2, first, last, held).orderBy("idx").collect()]

    assert assigned(0, None, 0, 5) == [0, 0, 1, 1, 2]
    assert assigned(5, 2, 1, 4) == [2, 3, 3, 4]
    assert assigned(4, 1, 2, 3) == [2, 2, 3]


def test_shard_offsets_are_those_of_the_written_lines(spark):
    lines = shards.shard_lines(shards.shard_assign(indexed(spark, 25), 10))
    rows = shards.shard_offsets(lines, 0, 100).orderBy("idx").collect()
    expected, at, shard = [], 100, 0
    for i in range(25):
        if i // 10 != shard:
            at, shard = 0, i // 10
        expected.append(at)
        at += len(f'{{"n": {i}}}') + 1
    assert [r["offset"] for r in rows] == expected


def test_dictionary_continues_existing_ids(spark):
    numbered = spark.createDataFrame([("z", 0), ("z", 1), ("b", 2), ("m", 3), ("b", 4)], "source_id string, idx bigint")
    existing = spark.createDataFrame([(0, "m"), (1, "q")], "id int, source_id string")
    assert {tuple(r) for r in shards.source_dictionary(numbered).collect()} == {(0, "z"), (1, "b"), (2, "m")}
    assert {tuple(r) for r in shards.source_dictionary(numbered, existing).collect()} == {(0, "m"), (1, "q"), (2, "z"), (3, "b")}


def test_one_hot_source_spreads_over_many_tasks(spark):
    """Blocks, not files, are the unit of work: the hot file's rows are ordered in bounded groups."""
    frame = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias("path"),
        F.col("id").alias("seq"),
        F.repeat(F.lit("x"), (F.col("id") % 11).cast("int")).alias("line"),
    )
    from logstrata.operators import framing

    framed = framing.line_offsets(framing.with_block(frame, span=1000))
    largest = framed.groupBy("path", "block").count().agg(F.max("count")).first()[0]
    assert largest <= 1000
    hot = {r["seq"]: r["byte_offset"] for r in framed.where("path = 'hot'").collect()}
    at = 0
    for i in sorted(hot):
        assert hot[i] == at
        at += i % 11 + 1
