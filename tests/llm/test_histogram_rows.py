"""Shards of repeated rows, and slots as ranks of the sorted order."""

from __future__ import annotations

from pyspark.sql import functions as F

from logstrata.llm import histogram_shards as module
from logstrata.llm.histogram_shards import histogram_shards


def gapless(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bulk_repeated_rows_are_cut(spark):
    single = spark.range(3000).select("id", F.concat(F.lit("text of "), "id").alias("text"))
    repeated = spark.range(3000).select(F.lit(7).cast("long").alias("id"), F.lit("the same row").alias("text"))
    rows = histogram_shards(single.union(repeated).repartition(5), shards=8, key="id").collect()
    sizes = {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
    assert len(rows) == 6000 and len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 40
    assert gapless(rows) and "_turn" not in rows[0].asDict()


def test_slots_are_ranks_of_the_order(spark, monkeypatch):
    monkeypatch.setattr(module, "CELL_ROWS", 10)
    docs = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("text"))
    docs = docs.union(docs.where("id < 40")).union(spark.createDataFrame([(None, None), (None, None), (None, "")], "id long, text string"))
    found = histogram_shards(docs, shards=4, key="id")
    content = F.coalesce("text", F.lit(""))
    rows = found.withColumns({"h": F.xxhash64("id", content), "l": F.xxhash64(content)}).collect()
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    keys = [(r.h % 2**64, r.l % 2**64) for r in ordered]
    assert keys == sorted(keys) and gapless(rows)
    # A hot text lies in all shards.
    assert {r.shard for r in rows if r.text == "hot"} == {0, 1, 2, 3}


def test_one_row_larger_than_all_others(spark):
    docs = spark.createDataFrame([(0, "x" * 100_000), *[(i, "y") for i in range(1, 50)]], "doc_id long, text string")
    rows = histogram_shards(docs, shards=3).collect()
    assert len(rows) == 50 and gapless(rows)
