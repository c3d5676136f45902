"""Every operator against plain Python on a small table with nulls, empty and long texts, ties, repeats and clashing names."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from logstrata.llm import bpe, language_codes, license_scan, suffix_dedup, toxicity_cnn
from logstrata.llm.components import components
from logstrata.llm.decontamination import best_part, contaminated
from logstrata.llm.histogram_shards import histogram_shards
from logstrata.llm.minhash_dedup import near_duplicates
from logstrata.llm.perplexity_rules import STATISTICS, quality_rules
from logstrata.llm.suffix_tree import score_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, size long, score string, component_id string, node string, _note string"


def sentence(draw: random.Random, words: int, kind: str = "ab") -> str:
    return " ".join("".join(draw.choice(kind + "elnost") for _ in range(draw.randint(2, 7))) for _ in range(words))


def corpus() -> list[tuple]:
    draw = random.Random(4)
    base, passage = sentence(draw, 70), sentence(draw, 20)
    texts: list[str | None] = [None, "", " \t\n", "One", "one", "two words", base, base, base.upper()]
    for k in range(14):  # near copies of one text
        words = base.split()
        words[5 * k % 60] = f"changed{k}"
        texts.append(" ".join(words))
    texts += [f"{sentence(draw, 15)}\n{passage} {sentence(draw, 9)}" for _ in range(12)]
    texts += [sentence(draw, 900, "uvw"), "x" * 3000, "ab " * 400, "é日本 naïve 😀" * 30, f"{passage}\n{passage}\n\n# * & <x> |\n# * & <x> |"]
    texts += [f"{sentence(draw, 30, 'ßüö')} Released under the MIT License.", f"intro\nReleased under the MIT License.\n{sentence(draw, 8)}"]
    rows = [(i, t, ("de", "en", None)[i % 3], 7, "s", "c", "n", "note") for i, t in enumerate(texts)]
    return rows + [rows[6], rows[0]]  # repeated rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None, size: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def test_near_duplicates(docs, rows, empty):
    sets = {r[0]: shingles(r[1], 3) for r in rows}
    group = {i: i for i in sets}

    def top(i):
        return i if group[i] == i else top(group[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    found = near_duplicates(docs, size=3, percent=85).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), top(r.doc_id), top(r.doc_id) == r.doc_id)
    assert near_duplicates(empty).count() == 0


def test_near_duplicates_without_keys_are_kept(spark):
    found = near_duplicates(spark.createDataFrame([(None, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string"), 3, 85)
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in found.collect()) == [(0, None, True), (1, 1, True), (2, 1, False)]


def test_near_duplicates_across_blocks(spark, monkeypatch):
    monkeypatch.setattr("logstrata.llm.minhash_dedup.BLOCK", 4)
    draw = random.Random(5)
    words = sentence(draw, 120).split()
    texts = []
    for k in range(30):
        own = list(words)
        own[k * 4] = f"other{k}"
        texts.append((k, " ".join(own)))
    found = near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 3, 85).collect()
    assert {r.component_id for r in found} == {0}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (50, 50)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_bpe_equals_the_library_and_round_trips(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(path))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r[0]: r[1] or "" for r in rows}
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    decoded = bpe.decode(coded.withColumnRenamed("decoded", "first"), path)
    found = decoded.collect()
    assert len(found) == len(rows)
    for r in found:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert bytes(r.decoded) == bytes(r.first) == texts[r.doc_id].encode()
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode(empty, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_long_words_and_odd_characters():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = bpe.read_ranks(path)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}
    )
    draw = random.Random(6)
    texts = ["a" * 700, "the" * 300, "".join(draw.choice("abcdethn") for _ in range(900)), "\x1c\x85 　x", "I'll don't  \n"]
    texts += ["".join(chr(c) for c in range(a, a + 400)) for a in range(0, 0xC000, 8000)]
    coder = bpe.Coder(tokens, public_tokenizers.PATTERN)
    coded = coder.encode(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(coded) == [t.encode() for t in texts]


def test_language_codes(spark, empty):
    draw = random.Random(7)
    kinds = {"aa": "qrt", "bb": "xyz", "cc": "éèà"}
    rows = [(i, sentence(draw, draw.randint(4, 40), kinds[k]), k) for i in range(150) for k in kinds]
    rows = [(3 * i + j, t, k) for j, k0 in enumerate(kinds) for i, t, k in rows if k == k0]
    rows += [(10_000, None, "aa"), (10_001, "12 .!", "aa"), (10_002, "", None), (10_003, "x" * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("old"))
    model = language_codes.fit(docs, F.col("doc_id") % 2 == 0)
    found = {r.doc_id: r for r in language_codes.identify(docs, model).collect()}
    held = [(found[i].lang_pred, k) for i, t, k in rows if i < 10_000 and i % 2]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert [found[i].lang_pred for i in (10_000, 10_001, 10_002)] == ["und"] * 3 and found[10_003].lang_pred in kinds
    nothing = language_codes.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language_codes.identify(docs, nothing).collect()} == {"und"}
    assert language_codes.identify(empty, model).count() == 0


@pytest.mark.parametrize("languages", [2, 4, 7, 20])
def test_codewords_differ(languages):
    code = language_codes.codewords(languages)
    assert len({tuple(c) for c in code.tolist()}) == languages


def removed(rows: list[tuple]) -> dict[int, bytes]:
    first: dict[bytes, int] = {}
    out = {}
    for i, text in sorted({r[0]: r[1] for r in rows}.items()):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        spans = [raw[k : k + 50] for k in range(len(raw) - 49)]
        for k, s in enumerate(spans):
            if first.get(s, i) < i:
                gone[k : k + 50] = b"\1" * 50
        for s in spans:
            first.setdefault(s, i)
        out[i] = bytes(gone)
    return out


@pytest.mark.parametrize("crowded", [4096, 2])
def test_suffix_dedup(docs, rows, empty, crowded, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    monkeypatch.setattr(suffix_dedup, "LOT_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 9000)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    monkeypatch.setattr(suffix_dedup, "SORTED", 4000)
    gone, texts = removed(rows), {r[0]: (r[1] or "").encode() for r in rows}
    found = suffix_dedup.remove_repeats(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        raw, mask = texts[r.doc_id], gone[r.doc_id]
        kept = bytes(b for b, m in zip(raw, mask) if not m)
        spans = len(re.findall(b"\1+", mask))
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.content)) == (len(raw), sum(mask), spans, kept)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_order_is_the_order_of_bytes():
    draw = np.random.Generator(np.random.PCG64(1))
    data = draw.integers(97, 99, 400).astype(np.uint8)
    begin = draw.integers(0, 380, 150)
    end = np.minimum(begin + draw.integers(1, 40, 150), 400)
    group = draw.integers(0, 4, 150).astype(np.uint64)
    order = suffix_dedup.sort_suffixes(suffix_dedup.PrefixHash(data), data, begin, end, group)
    keys = [(int(group[i]), data[begin[i] : end[i]].tobytes()) for i in order]
    assert keys == sorted(keys)


def test_contaminated(spark, empty):
    draw = random.Random(8)
    items = [(k, sentence(draw, 25).capitalize() + ".") for k in range(20)] + [(50, None), (51, ""), (52, "q z"), (53, "tiny item here")]
    texts: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, sentence(draw, 4000))]
    want = set()
    for k in range(20):
        words = items[k][1].split()
        words[7], words[18] = "xq", words[18] + "z"
        texts.append((100 + k, f"{sentence(draw, 60)} {items[k][1]} {sentence(draw, 30)}"))
        texts.append((200 + k, f"{sentence(draw, 10)}\n{' '.join(words).upper()}"))
        texts.append((300 + k, sentence(draw, 90)))
        want |= {(100 + k, k), (200 + k, k)}
    texts.append((400, f"{sentence(draw, 20)} tiny item here, {sentence(draw, 5)}"))
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item", F.lit("clash")).repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want | {(400, 53)}
    by_id = dict(texts)
    for r in found:
        if r.doc_id < 200:
            assert r.edits == 0 and by_id[r.doc_id].encode()[r.start : r.end].decode() in items[r.item_id][1]
    assert contaminated(empty, benchmark).count() == 0
    assert contaminated(docs, benchmark.limit(0)).count() == 0


def test_best_part_is_the_least_edit_distance():
    draw = random.Random(9)
    for _ in range(200):
        pattern = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 12)))
        text = bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 30)))
        line = [0] * (len(text) + 1)
        for i, a in enumerate(pattern, 1):
            new = [i]
            for j, b in enumerate(text, 1):
                new.append(min(line[j] + 1, new[-1] + 1, line[j - 1] + (a != b)))
            line = new
        assert best_part(pattern, text) == (min(line), line.index(min(line)))


def test_license_scan(docs, rows, empty):
    found = {(r.doc_id, r.license): (r.lines, r.passages, r.dice) for r in license_scan.license_scan(docs).collect()}
    texts = {r[0]: r[1] for r in rows}
    alone = next(i for i, t in texts.items() if t and t.startswith("intro"))
    inline = next(i for i, t in texts.items() if t and not t.startswith("intro") and "MIT" in t)
    assert found == {(alone, "MIT"): (1, 1, 1.0), (inline, "MIT"): (0, 1, 1.0)}
    assert license_scan.license_scan(empty).count() == 0


def test_quality_rules(docs, rows, empty):
    texts = {r[0]: r[1] or "" for r in rows}
    found = quality_rules(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        text = texts[r.doc_id]
        words = WORD.findall(text)
        lines = [line for line in text.split("\n") if WORD.search(line)]
        eight = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        cover = {j for i in range(len(words) - 7) if eight[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))
        assert tuple(r[c] for c in STATISTICS) == want
        assert r.base_failed == (len(words) < 20 or 100 * len(cover) > 30 * len(words))
        assert not (r.kept and r.base_failed)
    assert quality_rules(empty).count() == 0


def test_perplexity_tells_noise_from_language(spark):
    draw = random.Random(10)
    rows = [(i, sentence(draw, 200), "en") for i in range(120)]
    noise = "".join(chr(draw.randint(33, 126)) if draw.random() < 0.8 else " " for _ in range(1500))
    found = {r.doc_id: r for r in quality_rules(spark.createDataFrame([*rows, (999, noise, "en")], "doc_id long, text string, lang string")).collect()}
    assert not found[999].base_failed and not found[999].kept
    assert all(found[i].kept for i, _, _ in rows)


def test_toxicity_cnn(spark, empty):
    draw = random.Random(11)
    rows = []
    for i in range(900):
        words = sentence(draw, draw.randint(10, 60)).split()
        toxic = i % 6 == 0
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["vilething", "Vilethings!", "nastyword"])
        rows.append((i, " ".join(words), "en", int(toxic)))
    rows += [(2000, None, None, None), (2001, "", "en", None), (2002, sentence(draw, 5000), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").withColumn("predicted", F.lit("old"))
    model = toxicity_cnn.fit(docs, F.col("doc_id") % 3 != 1)
    found = {r.doc_id: r for r in toxicity_cnn.detect(docs, model).collect()}
    held = [(found[i].predicted, t) for i, _, _, t in rows if i < 2000 and i % 3 == 1]
    assert sum(p == 1 for p, t in held if t) >= 0.8 * sum(t for _, t in held)
    assert sum(p == 1 for p, t in held if not t) <= 0.05 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    assert toxicity_cnn.detect(empty, model).count() == 0
    unlabelled = toxicity_cnn.fit(docs.where("toxic is null"), F.lit(True))
    assert all(r.predicted == 0 for r in toxicity_cnn.detect(docs, unlabelled).collect())


def test_score_texts(docs, rows, empty):
    texts = {r[0]: r[1] or "" for r in rows}
    learned = [r for r in rows if r[0] % 3]
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts.items()}
    counts = collections.Counter(w for r in learned for w in tokens[r[0]])
    total, kinds = sum(counts.values()), len(counts)
    found = score_texts(docs, F.col("doc_id") % 3 != 0).collect()
    assert len(found) == len(rows)
    for r in found:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and -math.inf < r.score < 0
    assert score_texts(empty, F.lit(True)).count() == 0
    assert all(r.base_score == 0 for r in score_texts(docs.limit(3), F.lit(False)).collect())


def test_histogram_shards(docs, rows, empty):
    found = histogram_shards(docs, shards=4).collect()
    assert len(found) == len(rows)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    slots, bytes_in = collections.defaultdict(list), collections.Counter()
    for r in found:
        assert (r["size"], r.text_crc32, r.law) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "bytes")
        slots[r.shard].append(r.slot)
        bytes_in[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    largest = max(len(t) + 1 for t in texts.values())
    assert all(abs(bytes_in[k] - sum(bytes_in.values()) / 4) <= largest for k in range(4))
    assert histogram_shards(empty).count() == 0


def test_histogram_shards_cut_a_hot_group(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("t"), "id")).otherwise("same").alias("text"))
    found = histogram_shards(docs, shards=8).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    sizes = [r.n for r in found]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 20


@pytest.mark.parametrize("words", [7, 14, 40, 120])
def test_contaminated_finds_what_brute_force_finds(spark, words):
    draw = random.Random(words)
    items = [sentence(draw, words) for _ in range(60)]
    rows, want = [], {percent: set() for percent in (0, 10, 15, 20)}
    for percent, found in want.items():
        for k, item in enumerate(items):
            copy = list(item)
            for _ in range(len(item) * percent // 100):
                at, letter, kind = draw.randrange(len(copy)), draw.choice("abelnost "), draw.randrange(3)
                copy[at : at + (kind != 1)] = "" if kind == 2 else letter
            key, text = 100 * percent + k, f"{sentence(draw, 12)} {''.join(copy)} {sentence(draw, 9)}"
            rows.append((key, text))
            plain = " ".join(text.split()).encode()
            if best_part(item.encode(), plain)[0] <= len(item) * 20 // 100:
                found.add((key, k))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark).collect()}
    assert want[0] <= got
    for percent, found in want.items():
        assert len(found) >= 55 and len(found & got) >= (0.95 if percent < 20 else 0.9) * len(found)


def test_score_texts_keeps_a_rare_language_in_a_large_corpus(spark):
    draw = random.Random(15)
    rare = ["".join(draw.choice("ghkmp") for _ in range(5)) for _ in range(6)]
    texts = [" ".join(draw.choice(rare) for _ in range(40)) for _ in range(8)]
    texts += ["ab " * 700_000] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    small, large = (
        {r.doc_id: r.score for r in score_texts(part, F.col("doc_id") != 0).collect()} for part in (docs.where("doc_id < 8"), docs)
    )
    assert abs(large[0] - small[0]) < 0.02 * len(texts[0])


def test_score_texts_equals_a_plain_suffix_tree(docs, rows):
    fold = bytes.maketrans(b"\t\n\v\f\r" + bytes(range(65, 91)), b"     " + bytes(range(97, 123)))
    padded = {r[0]: bytes(5) + (r[1] or "").encode().translate(fold) + b"\0" for r in rows}
    nexts: dict[bytes, collections.Counter] = collections.defaultdict(collections.Counter)
    for r in rows:
        text = padded[r[0]]
        for i in range(5, len(text)) if r[0] % 3 else ():
            for depth in range(6):
                nexts[text[i - depth : i]][text[i]] += 1

    def diverges(context):
        own, above = nexts[context], nexts[context[1:]]
        n, n_above = sum(own.values()), sum(above.values())
        return n >= 32 and sum(c / n * math.log(c / n * n_above / above[b]) for b, c in own.items()) >= 0.01

    states = {context[k:] for context in list(nexts) if context and diverges(context) for k in range(len(context))} | {b""}

    def probability(context, letter):
        lower = probability(context[1:], letter) if context else 1 / 256
        if context not in states:
            return lower
        kinds, n = len(nexts[context]), sum(nexts[context].values())
        return (nexts[context][letter] + kinds * lower) / (n + kinds)

    for r in score_texts(docs, F.col("doc_id") % 3 != 0).collect():
        text = padded[r.doc_id]
        want = sum(math.log10(probability(text[i - 5 : i], text[i])) for i in range(5, len(text)))
        assert math.isclose(r.score, want, rel_tol=1e-5)


def test_contaminated_without_word_starts_and_short_items(spark):
    draw = random.Random(16)
    signs = [chr(c) for c in range(0x4E00, 0x4F00)]
    passage = "".join(draw.choice(signs) for _ in range(30))
    around = "".join(draw.choice(signs) for _ in range(80))
    texts = [(0, f"{around}{passage}{around}"), (1, around), (2, "so Q, z it is"), (3, "faq zoo"), (4, f"{around}豆腐{around}"), (5, None)]
    items = [(0, passage), (1, "q z"), (2, "豆腐"), (3, ""), (4, "?")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.edits) for r in found} == {(0, 0, 0), (2, 1, 0), (4, 2, 0)}
