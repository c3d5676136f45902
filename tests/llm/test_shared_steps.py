"""Buckets of windows and patterns with their classes written out."""

from __future__ import annotations

import collections

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex

from logstrata.llm import forced_bpe
from logstrata.llm.lots import from_blob, to_blob
from logstrata.llm.suffix_tree import LOT_LEVEL, SLICE_TEXTS, _bucket_order, _counted_windows, _slices, _token_runs, _window_runs, score_texts


def test_windows_with_the_same_first_bytes_share_a_bucket():
    keys = np.sort(np.random.default_rng(5).choice(1 << 22, 5_000, replace=False)).astype(np.int64)
    order, cuts = _bucket_order(keys, 16)
    assert sorted(order) == list(range(len(keys)))
    seen = {}
    for b in range(16):
        own = keys[order[cuts[b] : cuts[b + 1]]]
        assert (np.diff(own) > 0).all()
        for first in np.unique(own >> 16).tolist():
            assert seen.setdefault(first, b) == b
    assert len(set(seen.values())) > 8


def test_one_pass_gives_the_windows_and_tokens_of_every_text():
    texts = ["ab AB\tab", None, "", "ÿþ \u0130x", "ab ab ab", "\U0001f600\x7f"]
    fold = bytes.maketrans(b"\t\n\v\f\r" + bytes(range(65, 91)), b"     " + bytes(range(97, 123)))
    plain = [bytes(5) + (t or "").encode().translate(fold) + b"\0" for t in texts]
    want = [collections.Counter(int.from_bytes(p[i - 5 : i + 1], "big") for i in range(5, len(p))) for p in plain]
    part = pa.record_batch({"_text": pa.array(texts, pa.string()), "_learn": pa.array([True, True, False, True, False, True])})
    keys, first, owner = _window_runs(part, "_text")
    got = [collections.Counter() for _ in texts]
    for key, of_key in zip(keys.tolist(), np.split(owner, first[1:])):
        for t in of_key.tolist():
            got[t][key] += 1
    assert got == want and (np.diff(keys) > 0).all()
    learned = sum((want[i] for i in (0, 1, 3, 5)), collections.Counter())
    keys, counts = _counted_windows(pa.Table.from_batches([part, part]), "_text")
    assert dict(zip(keys.tolist(), counts.tolist())) == {k: 2 * learned[k] for w in want for k in w}
    keys, back, owner = _token_runs(part, "_text")
    assert np.bincount(owner, minlength=6).tolist() == [len((t or "").split()) + 1 for t in texts]
    assert len(keys) == 5 and len(set(back[owner == 4].tolist())) == 2


def test_a_slice_numbers_its_texts_in_16_bits(spark):
    n = SLICE_TEXTS + 3
    many = pa.table({"_text": pa.array([""] * n), "_learn": pa.array([True] * n)})
    assert [p.num_rows for p in _slices(many, "_text")] == [SLICE_TEXTS, 3]
    assert _counted_windows(many, "_text")[1].tolist() == [n]
    docs = spark.range(0, n, 1, 1).selectExpr("id", f"if(id < {n - 2}, '', 'ab ab') as text")
    rows = {r.id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in score_texts(docs, docs["id"] >= 0).collect()}
    assert len(rows) == n and len(set(rows.values())) == 2
    assert rows[0][:2] == (1, 1) and rows[n - 1][:2] == (3, 3) and rows[n - 1] == rows[n - 2]


def test_a_higher_level_packs_the_same_rows_into_less():
    draw = np.random.default_rng(6)
    words = ["".join(map(chr, draw.integers(97, 123, 6))) for _ in range(3_000)]
    rows = pa.table({"id": range(400), "text": [" ".join(draw.choice(words, 200)) for _ in range(400)]})
    plain, small = to_blob(rows), to_blob(rows, LOT_LEVEL)
    assert from_blob(plain).equals(rows) and from_blob(small).equals(rows)
    assert len(small) < 0.97 * len(plain)


def test_a_written_out_pattern_finds_the_same_words():
    rules = forced_bpe.read_rules(public_tokenizers.path("word_bpe_49k.json"))
    for pattern in (rules["pattern"], r"\p{Lu}+|[^\S\d]|\[|\w"):
        letters = "".join(chr(c) for c in range(1 << 16) if not 0xD800 <= c < 0xE000) + " It's [we'll] \x1c\x85 ²"
        assert forced_bpe.plain_pattern(pattern).findall(letters) == regex.findall(pattern, letters)
    own = forced_bpe.Cutter(rules)
    # Composed, the first is a letter above U+FFFF.
    assert own.words("\ufa6c a") == ["\U000242ee", "a"]
    assert own.code(["It's <|endoftext|>ß", ""]) == [(ids := own.encode(["It's <|endoftext|>ß"])[0], own.decode(np.frombuffer(ids, "<u4"))), (b"", "")]
