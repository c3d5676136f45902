"""Forced-boundary BPE, spelling variants and ranked search against plain Python on small tables with awkward rows."""

from __future__ import annotations

import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logstrata.llm import forced_bpe, lexical_search, spelling_variants

PATH = public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string, word string, doc string, n long, item int, score string, ids string, longer string"


def table(spark, texts, copies=()):
    rows = [(i, t, "w", "d", 7, 3, "s", "i", "l") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[i] for i in copies] + [(None, *rows[1][1:])], SCHEMA).repartition(3), rows + [rows[i] for i in copies] + [(None, *rows[1][1:])]


def words(draw, n, letters="abcdeé"):
    return ["".join(draw.choice(letters) for _ in range(draw.randint(3, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def bpe_texts():
    draw = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz''  0123<|>ΣσİßÉé́가漢字😀 \x85\x1c՘"
    texts = [None, "", " \n", "don't 'S RE'RE", "ΑΣ ΟΣ. Σ", "<|startoftext|>a<|endoftext|>B <|endoftext|", "é<|endoftext|>́"]
    texts += ["x" * 20_000, "abab" * 5_000 + " " + "\U0001E900" * 3, "ß" * 999, "tail " * 3_000]
    return texts + ["".join(draw.choice(letters) for _ in range(draw.randint(1, 70))) for _ in range(150)]


def test_forced_bpe(spark, tokenizer):
    docs, rows = table(spark, bpe_texts(), copies=[3, 0])
    got = collections.Counter()
    for r in forced_bpe.encode(docs, PATH).collect():
        got[r.doc_id, r.word, r.n_tokens, tuple(r.ids), r.ids_sha256, r.decoded, r.decoded_sha256] += 1
    want = collections.Counter()
    for i, t, w, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        want[i, w, len(ids), tuple(ids), digests[0], decoded, digests[1]] += 1
    assert got == want


def test_forced_bpe_knows_every_letter(tokenizer):
    own = forced_bpe.Cutter(forced_bpe.read_rules(PATH))
    letters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"x{c}{c} {c}1" for c in letters[i : i + 64]) for i in range(0, len(letters), 64)]
    for mine, theirs in zip(own.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(mine, "<u4").tolist() == theirs.ids


def test_forced_cuts_are_in_no_token():
    own = forced_bpe.Cutter(forced_bpe.read_rules(PATH))
    assert not own.joined[256:].any()
    held = set()
    letters = {x: b for b, x in enumerate(forced_bpe.byte_letters())}
    for token in own.rules["vocabulary"]:
        symbols = [letters[x] for x in token.removesuffix("</w>")]
        symbols[-1] += 256 * token.endswith("</w>")
        held |= set(zip(symbols, symbols[1:]))
    assert held == set(zip(*map(np.ndarray.tolist, np.nonzero(own.joined))))


def test_forced_bpe_decodes_and_refuses(spark, tokenizer, tmp_path):
    rows = spark.createDataFrame([(1, [320, 49407]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in forced_bpe.decode(rows, PATH).collect()} == {1: tokenizer.decode([320, 49407], skip_special_tokens=False), 2: "", 3: ""}
    given = json.load(open(PATH, encoding="utf-8"))
    given["model"]["dropout"] = 0.1
    (tmp_path / "other.json").write_text(json.dumps(given))
    with pytest.raises(ValueError, match="not a BPE"):
        forced_bpe.read_rules(str(tmp_path / "other.json"))
    assert forced_bpe.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variant_rows(counts: dict[str, int]) -> set:
    out, form = set(), {}
    links = {w: [v for v in counts if near(w, v)] for w in counts}
    for w in counts:
        best = min(links[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(links[w]), counts.get(form[w])))
    return out


@pytest.mark.parametrize("pairs", [1, 40, 4096])
def test_near_words_in_crowded_chunks(spark, pairs):
    draw = random.Random(3)
    own = {"Häuser" + w for w in words(draw, 150, "ab")} | {w + "ungen" for w in words(draw, 120, "ab")} | set(words(draw, 80)) | {"", "x", "a" * 300, "a" * 299, "a" * 298 + "b"}
    got = [(r.a, r.b) for r in spelling_variants.near_words(spark.createDataFrame([(w,) for w in own] + [(None,)], "word string"), pairs).collect()]
    assert len(got) == len(set(got))
    long_enough = [w for w in own if len(w) >= 2]
    assert set(got) == {(a, b) for a in long_enough for b in long_enough if near(a, b)}


def test_spelling_variants(spark):
    draw = random.Random(5)
    texts: list[str | None] = [None, "", " ", "Straße 123 straßen"]
    base = ["Wanderung", "wanderungen", "Äpfelchen", "mountain", "mountains", "abcabc"]
    for k in range(400):
        picked = [draw.choice(base) for _ in range(30)] + words(draw, 6, "abcß")
        if k % 9 == 0:
            picked += ["mauntain", "WANDERUNK", "mauntein"]
        texts.append(f"{k}, ".join(picked))
    texts.append("x" * 50_000 + " mountainz" * 20_000)
    docs, rows = table(spark, texts, copies=[5, 5, 3])
    counts: collections.Counter = collections.Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    want = variant_rows({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = [tuple(r) for r in spelling_variants.spelling_variants(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] for r in got) and any(r[1] and r[1] != r[2] for r in got)
    assert spelling_variants.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_roots_follow_long_chains(spark):
    names = [f"w{i:02}" for i in range(23)]
    forms = spark.createDataFrame(list(zip(names, names[1:])), "word string, form string")
    assert {r.word: r.root for r in spelling_variants.roots(forms).collect()} == dict.fromkeys(names[:-1], names[-1])


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    found = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    found = [(i, collections.Counter(t), len(t)) for i, t in found if t]
    size, length = len(found), sum(n for *_, n in found)
    df = collections.Counter(t for _, own, _ in found for t in own)
    out = []
    for item, text in items:
        asked = collections.Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, own, n in found:
            m = 75 + 25 * n * size // length
            score = sum(r * math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 12 * m)) for t, r in asked.items() if t in own)
            if score > 0:
                scores.append((-score, i is not None, i))
        out += [(item, place + 1, i, -s) for place, (s, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [1, 5, 20])
def test_search(spark, monkeypatch, k):
    monkeypatch.setattr(lexical_search, "HEAD_SHARE", 8)
    monkeypatch.setattr(lexical_search, "BUCKET", 16)
    monkeypatch.setattr(lexical_search, "SOME", 4)
    draw = random.Random(7)
    common, rare = words(draw, 12), words(draw, 300)
    texts: list[str | None] = [None, "", "?!", "É é 漢字 x1"]
    texts += [" ".join(draw.choice(common if draw.random() < 0.5 else rare) for _ in range(draw.randint(1, 90))) for _ in range(200)]
    texts += ["same words here " + rare[0]] * 40 + [" ".join(common * 900)]
    docs, rows = table(spark, texts, copies=[9, 9, 9])
    items = [(i, " ".join(draw.choice(common if draw.random() < 0.3 else rare) for _ in range(draw.randint(1, 25)))) for i in range(30)]
    items += [(40, None), (41, ""), (42, "..."), (43, "absent-from-all"), (44, "É é É"), (44, "É é É"), (None, rare[0] + " same, same words")]
    asked = spark.createDataFrame([(*r, "x", 1.0) for r in items], "item_id long, text string, rank string, score double")
    got = sorted((tuple(r) for r in lexical_search.search(docs, asked, k).collect()), key=repr)
    assert got == ranked([r[:2] for r in rows], items, k)


def test_search_in_blocks_and_empty_tables(spark, monkeypatch):
    rows = [(i, f"alpha beta{i % 3} gamma{i}") for i in range(9)]
    items = [(i, f"beta{i % 3} gamma{i} alpha") for i in range(6)]
    docs, asked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 40)
    assert sorted((tuple(r) for r in lexical_search.search(docs, asked).collect()), key=repr) == ranked(rows, items, 20)
    assert lexical_search.search(docs.limit(0), asked).count() == 0
    found = lexical_search.search(docs, asked.where(F.lit(False)))
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]
