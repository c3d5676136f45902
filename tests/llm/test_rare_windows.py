"""Perplexities against a whole Kneser-Ney model in plain Python, whatever part of it the tasks hold."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from logstrata.llm import perplexity_rules


def test_rare_windows_count_as_in_the_whole_model(spark, monkeypatch):
    """However few windows the tasks hold, every text has the perplexity of the whole Kneser-Ney model."""
    draw = random.Random(3)
    texts = [None, "", "a", "aa", *["".join(draw.choice("ab é") for _ in range(draw.randrange(80))) for _ in range(30)]]
    texts.append(texts[7])
    data = [b"\0" * 3 + (t or "").encode() + b"\0" for t in texts]
    counts = [Counter(d[i : i + 4] for d in data for i in range(len(d) - 3))]
    while len(counts) < 4:
        counts.append(Counter(g[1:] for g in counts[-1]))
    models = []
    for table in reversed(counts):
        n = [sum(c == k for c in table.values()) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2])
        less = [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.1), k - 0.1) if n[k] else 0.5 * k for k in (1, 2, 3)]
        total, left, p = Counter(), Counter(), {}
        for g, c in table.items():
            total[g[:-1]] += c
            left[g[:-1]] += less[min(c, 3) - 1]
        for g, c in table.items():
            lower = models[-1][g[1:]] if models else 1 / 256
            p[g] = (c - less[min(c, 3) - 1] + left[g[:-1]] * lower) / total[g[:-1]]
        models.append(p)
    want = [sum(-math.log(models[-1][d[i : i + 4]]) for i in range(len(d) - 3)) / (len(d) - 3) for d in data]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    for share in (0.0, 0.01, 2.0):
        monkeypatch.setattr(perplexity_rules, "LEAST_SHARE", share)
        found = {r.doc_id: r.log_perplexity for r in perplexity_rules.quality_rules(docs).collect()}
        assert [found[i] for i in range(len(texts))] == pytest.approx(want, rel=1e-5), share
