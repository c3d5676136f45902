"""The pipeline on planted cases, stage by stage and as a whole."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest

from test_operators import sentence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    draw = random.Random(12)
    passage = sentence(draw, 40)
    item = sentence(draw, 30)
    texts = {i: sentence(draw, 120) for i in range(20)}
    texts[20], texts[21] = texts[3], texts[4].replace(texts[4].split()[50], "other", 1)
    texts[22] = f"{sentence(draw, 60)} {item} {sentence(draw, 9)}"
    texts[23], texts[24] = f"{sentence(draw, 70)} {passage} {sentence(draw, 50)}", f"{sentence(draw, 70)} {passage} {sentence(draw, 50)}"
    texts |= {25: None, 26: "", 27: "12 34 ..."}
    rows = [(i, t, "en" if i % 2 else None, "src", len(t or "")) for i, t in texts.items()]
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_keep_clean_documents_and_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    gone = [{25, 26, 27}, {20, 21}, set(), {22}]
    for (_, stage), lost in zip(corpus_pipeline.STAGES[:-1], gone):
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), SCHEMA)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(before) - set(after) == lost
        assert {i for i in after if after[i].text != before[i].text} <= {24}
    assert len(after[24].text) < 24 * 40 and after[24].n_chars == len(after[24].text)


def test_run(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == [*range(20), 23, 24]
    assert all(r.n_tokens == len(r.ids) > 0 for r in found)


def test_stages_take_empty_tables(spark, sf_dir):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
