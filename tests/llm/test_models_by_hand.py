"""The models' arithmetic against plain Python: code decoding, convolutions, gradients, counts of n-grams."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logstrata.llm import language_codes, toxicity_cnn
from logstrata.llm.language_codes import LanguageCodes, codewords
from logstrata.llm.textblocks import flat, mix
from logstrata.llm.toxicity_cnn import ToxicityCnn, word_rows

TEXTS = ["The cat, the dog!", "die Katze und der Hund", "el gato y el perro", "", "7 + 7", "x", "Straße der Hunde " * 30, "the the the"]


def grams_by_hand(text):
    """Hashed n-grams of a folded text between zero bytes, the same function of the same bytes, one at a time."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    folded = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in raw)
    out = []
    for size in language_codes.ORDERS:
        for i in range(len(folded) - size + 1):
            number = int.from_bytes(folded[i : i + size], "big") + (size << 40)
            out.append(int(mix(np.array([number], np.uint64))[0] >> np.uint64(64 - language_codes.BITS)))
    return out


def test_language_decoding(spark):
    learn = [(i, t, lang) for i, (t, lang) in enumerate(zip(TEXTS[:3] + TEXTS[6:], ["en", "de", "es", "de", "en"]))] + [(9, TEXTS[0], None)]
    docs = spark.createDataFrame(learn + [learn[1]], "doc_id long, text string, lang string").repartition(2)
    model = language_codes.fit(docs, F.lit(True))
    counts = {k: collections.Counter() for k in ("de", "en", "es")}
    for _, t, lang in [*learn, learn[1]]:
        if lang:
            counts[lang].update(grams_by_hand(t))
    size = 1 << language_codes.BITS
    share = {k: lambda g, c=c: (c[g] + 0.05) / (sum(c.values()) + 0.05 * size) for k, c in counts.items()}
    names, code = ["de", "en", "es"], codewords(3)
    assert model.languages == names

    def weight(bit, g):
        yes, no = ([share[n](g) for n, row in zip(names, code) if row[bit] == s] for s in (1, -1))
        return math.log((sum(yes) / len(yes)) / (sum(no) / len(no)))

    found, score, second = model.decode(*flat(pa.array(TEXTS)))
    bits = model.evidence(*flat(pa.array(TEXTS)), found)
    for i, text in enumerate(TEXTS):
        grams = grams_by_hand(text)
        evidence = [sum(weight(b, g) for g in grams) / language_codes.OVERLAP for b in range(code.shape[1])]
        losses = [sum(float(np.logaddexp(0, -e * row[b])) * model.importance[b] for b, e in enumerate(evidence)) for row in code]
        belief = [math.exp(-code.shape[1] / 2 * (x - min(losses))) for x in losses]
        ranked = sorted(((b / sum(belief), -k) for k, b in enumerate(belief)), reverse=True)
        assert found[i] == -ranked[0][1]
        assert math.isclose(score[i], ranked[0][0], rel_tol=1e-3) and math.isclose(second[i], ranked[1][0], rel_tol=1e-2, abs_tol=1e-9)
        own = sum(math.log2(share[names[found[i]]](g) * size) for g in grams) / max(len(grams), 1)
        assert math.isclose(bits[i], own, rel_tol=1e-4, abs_tol=1e-6)


def sample():
    draw = random.Random(3)
    bad, good = ["idiot", "stupid fool", "awful moron"], ["tree", "river bank", "small house here"]
    texts = [" ".join(draw.choice(good + (bad if i % 3 == 0 else [])) for _ in range(6)) + (" idiot" if i % 3 == 0 else "") for i in range(30)]
    return texts, np.array([int(i % 3 == 0) for i in range(30)])


def rows_of(texts):
    rows, first = word_rows(*flat(pa.array(texts)))
    return [rows[a:b] for a, b in zip(first[:-1], first[1:])]


def forward(model, words, table=None, filters=None, bias=None, out=None, shift=None):
    """One text's logit by nested loops in doubles; zero rows lie behind the text."""
    table, filters = model.table if table is None else table, model.filters if filters is None else filters
    bias, out, shift = model.bias if bias is None else bias, model.out if out is None else out, model.shift if shift is None else shift
    known = {int(r): i + 1 for i, r in enumerate(model.rows)}
    vectors = [sum(np.asarray(table[known.get(int(r), 0)], float) for r in word) for word in words]
    vectors += [np.zeros(toxicity_cnn.DIM)] * max(toxicity_cnn.WIDTHS)
    total, unit = float(shift), 0
    for kernel in filters:
        # Every word and every zero row behind the text is a place; what reaches beyond it is zero.
        padded = vectors + [np.zeros(toxicity_cnn.DIM)] * len(kernel)
        for f in range(toxicity_cnn.FILTERS):
            top = max(sum(float(padded[i + j] @ np.asarray(kernel[j, :, f], float)) for j in range(len(kernel))) for i in range(len(vectors)))
            total += float(out[unit]) * max(top + float(bias[unit]), 0.0)
            unit += 1
    return total


def test_convolutions_by_hand():
    texts, labels = sample()
    model = ToxicityCnn()
    model.train(rows_of(texts), labels)
    asked = [*texts[:5], "unknown words only", "", "idiot", "tree idiot tree " * 9]
    rows, first = word_rows(*flat(pa.array(asked)))
    logits = model.logits(rows, first)
    for words, logit in zip(rows_of(asked), logits):
        assert math.isclose(forward(model, words), logit, rel_tol=1e-3, abs_tol=1e-4)
    assert logits[7] > logits[5]


@pytest.mark.parametrize("part", ["out", "bias", "shift", "filters", "table"])
def test_the_first_step_follows_the_gradient(monkeypatch, part):
    monkeypatch.setattr(toxicity_cnn, "EPOCHS", 1)
    texts, labels = sample()
    rows = rows_of(texts)
    trained, before = ToxicityCnn(), ToxicityCnn()
    trained.train(rows, labels)
    # The same draws give the parameters from which the only batch started.
    before.rows = np.unique(np.concatenate(rows))
    before.table = before.draw.normal(0, 0.1, (len(before.rows) + 1, toxicity_cnn.DIM)).astype(np.float32)
    before.table[0] = 0
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))

    def loss(**changed):
        logits = np.array([forward(before, w, **changed) for w in rows])
        return float((weight * (np.logaddexp(0, logits) - labels * logits)).mean())

    def moved(index, value):
        own = [np.array(f, float) for f in before.filters] if part == "filters" else np.array(getattr(before, part), float)
        if part == "filters":
            own[index[0]][index[1:]] += value
        else:
            own[index] += value
        return {part: own}

    draw = random.Random(5)
    places = {
        "out": [(draw.randrange(24),) for _ in range(5)],
        "bias": [(draw.randrange(24),) for _ in range(5)],
        "shift": [()],
        "filters": [(k, draw.randrange(k + 1), draw.randrange(8), draw.randrange(8)) for k in range(3)],
        "table": [(1 + draw.randrange(len(before.rows)), draw.randrange(8)) for _ in range(4)],
    }[part]
    for index in places:
        gradient = (loss(**moved(index, 1e-4)) - loss(**moved(index, -1e-4))) / 2e-4
        want = 0.08 * gradient / math.sqrt(1e-6 + gradient**2)
        old, new = ((m.filters[index[0]][index[1:]] if part == "filters" else np.asarray(getattr(m, part))[index]) for m in (before, trained))
        assert abs(float(old) - float(new) - want) < 0.004
