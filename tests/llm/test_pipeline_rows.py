"""The pipeline's stages on rows without ids, repeated rows, columns with any name, foreign and very long texts."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest

from test_operators import sentence

EXTRA = ["content", "kept_text", "n_bytes", "score", "lang_pred", "ambiguous", "evidence", "_row", "_kept", "key", "node", "item", "kept", "component_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def row(i, text, lang="en"):
    return (i, text, lang, "src", len(text or ""), *[f"{c} of {i}" for c in EXTRA])


@pytest.fixture(scope="module")
def item():
    return sentence(random.Random(31), 30)


@pytest.fixture(scope="module")
def sf_dir(spark, item, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("rows"))
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def stage(spark, name, rows, sf_dir, n=3):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(n)
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    if name != "tokens":
        assert found.columns == docs.columns and found.schema.simpleString() == docs.schema.simpleString()
    return [tuple(r) for r in found.collect()]


def test_language_rejects_what_it_does_not_know(spark, sf_dir):
    draw = random.Random(1)
    good = [row(i, sentence(draw, 60, "ab" if i % 2 else "üß"), "en" if i % 2 else "de") for i in range(40)]
    good += [row(50, sentence(draw, 12), None), row(51, sentence(draw, 3000)), row(1, sentence(draw, 40)), good[3], row(None, sentence(draw, 30), None)]
    bad = [row(60, "Τα ελληνικά είναι μια γλώσσα που μιλιέται στην Ελλάδα", None), row(61, "日本語のテキストです。これは文章です", None)]
    bad += [row(62, "x 1 2 3 ### 9 9 4711 0815 ***", None), row(63, "12 34"), row(64, ""), row(65, None), row(None, " ")]
    assert sorted(stage(spark, "language", good + bad, sf_dir), key=repr) == sorted(good, key=repr)
    unlabelled = [(*r[:2], None, *r[3:]) for r in good + bad]
    left = stage(spark, "language", unlabelled, sf_dir)
    assert {r[0] for r in left} >= {60, 61, 62} and not {63, 64, 65} & {r[0] for r in left}


@pytest.mark.parametrize("n", [1, 4])
def test_near_copies_take_every_row_for_a_document(spark, sf_dir, n):
    draw = random.Random(2)
    texts = [sentence(draw, 80) for _ in range(4)]
    near = texts[0].split()
    near[40] = "changed"
    rows = [row(1, texts[0]), row(1, texts[0]), row(None, texts[0]), row(2, " ".join(near)), row(1, texts[1]), row(None, texts[2]), row(None, texts[2])]
    rows += [row(7, texts[3]), row(8, None), row(8, None), row(9, "")]
    left = stage(spark, "near_copies", rows, sf_dir, n)
    groups = [{texts[0], " ".join(near)}, {texts[1]}, {texts[2]}, {texts[3]}]
    assert [sum(r[1] in g for r in left) for g in groups] == [1, 1, 1, 1]
    assert sorted(repr(r) for r in left if not r[1]) == sorted(repr(r) for r in rows if not r[1])
    assert all(r in rows for r in left)


def test_near_copies_keep_the_smallest_id(spark, sf_dir):
    text = sentence(random.Random(3), 60)
    rows = [row(i, text) for i in (9, 4, 30)]
    assert stage(spark, "near_copies", rows, sf_dir) == [row(4, text)]


def test_repeats_with_any_columns_and_ids(spark, sf_dir):
    draw = random.Random(4)
    passage = sentence(draw, 60)
    heads = [sentence(draw, 30) for _ in range(4)]
    rows = [row(5, f"{heads[0]} {passage}"), row(9, f"{heads[1]} {passage}"), row(11, None), row(12, "")]
    left = {r[0]: r for r in stage(spark, "repeats", rows, sf_dir)}
    assert set(left) == {5, 9, 11, 12} and [left[i] for i in (5, 11, 12)] == [rows[0], *rows[2:]]
    assert left[9][1].startswith(heads[1]) and len(left[9][1]) < len(heads[1]) + 50 and left[9][4] == len(left[9][1]) and left[9][5:] == rows[1][5:]
    # Without usable ids one row keeps the passage and the others lose it; a row that is nothing but a copy goes.
    rows = [row(None, f"{heads[0]} {passage}"), row(None, f"{heads[1]} {passage}"), row(3, f"{heads[2]} {passage}"), row(3, passage)]
    texts = [r[1] for r in stage(spark, "repeats", rows, sf_dir, 1)]
    assert sum(passage in t for t in texts) == 1 and len(texts) in (3, 4)


def test_decontamination_judges_rows(spark, sf_dir, item):
    draw = random.Random(5)
    dirty = [row(None, f"{sentence(draw, 9)} {item} {sentence(draw, 9)}"), row(4, item), row(4, item), row(6, f"{sentence(draw, 20_000)} {item}")]
    clean = [row(4, sentence(draw, 50)), row(None, sentence(draw, 50)), row(7, None), row(8, ""), row(9, sentence(draw, 20_000))]
    assert sorted(stage(spark, "decontamination", dirty + clean, sf_dir), key=repr) == sorted(clean, key=repr)


def test_tokens_of_any_rows(spark, sf_dir):
    rows = [row(None, "a b"), row(1, "a b"), row(1, "a b"), row(2, None), row(3, "word " * 9000 + "y" * 40_000)]
    left = stage(spark, "tokens", rows, sf_dir)
    assert sorted(r[0] or 0 for r in left) == [0, 1, 1, 2, 3]
