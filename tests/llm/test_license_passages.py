"""License passages inside lines and over line ends, against every run counted on its own."""

from __future__ import annotations

import random
import re

import pytest

from logstrata.llm.license_scan import TEMPLATES, license_scan


def words(text):
    return re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def pairs(own):
    return list(zip(own, own[1:]))


def brute(text, templates, threshold):
    out = {}
    for name, notice in templates.items():
        want, size = set(pairs(words(notice))), len(words(notice))
        lines, best, passages, last = 0, 0.0, 0, None
        for unit, is_line in [*((t, 1) for t in (text or "").split("\n")), (text, 0)]:
            own = set(pairs(words(unit)))
            dice = 2 * len(own & want) / (len(own) + len(want)) if own else 0
            if 100 * dice >= threshold - 1e-9:
                lines, best = lines + is_line, max(best, dice)
        own = pairs(words(text))
        for i in range(len(own) - size + 2):
            run = set(own[i : i + size - 1])
            dice = 2 * len(run & want) / (len(run) + len(want)) if run else 0
            if 100 * dice >= threshold - 1e-9:
                passages += last != i - 1
                best, last = max(best, dice), i
        if best:
            out[name] = (lines, passages, round(best, 9))
    return out


@pytest.mark.parametrize("threshold", [60, 80])
def test_passages_against_every_run(spark, threshold):
    draw = random.Random(6)
    templates = {"a": "one two three four five six seven", "b": "one two one two one two three", "c": "x y", "d": "one two three four zz yy xx ww vv uu tt"}
    kinds = "one two three four five six seven x y zz yy xx ww vv uu tt noise".split()
    texts = [None, "", "one", "x y", "x\ny", "one two\nthree four five. Six seven", "ONE two, one two one two three one two three four five six seven"]
    texts += [draw.choice([" ", "\n"]).join(draw.choice([templates["a"], templates["d"], *kinds]) for _ in range(draw.randint(1, 30))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {}
    for r in license_scan(docs, templates, threshold).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.lines, r.passages, round(r.dice, 9))
    assert got == {i: found for i, t in enumerate(texts) if (found := brute(t, templates, threshold))}


def wrapped(text, width):
    out, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            out.append(line)
            line = ""
        line += " " * bool(line) + word
    return "\n# ".join([*out, line])


def test_headers_and_texts_are_found_wherever_they_stand(spark):
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor " * 40
    gpl = wrapped(TEMPLATES["GPL-3.0-header"].replace("This program", "Frobnicate"), 60)
    texts = {
        0: f"{filler}\n# {gpl}\n{filler}",
        1: f"Copyright (c) 1999 Someone\n\n{wrapped(TEMPLATES['BSD-opening'], 50)}\n\n{filler}",
        2: f"{filler} released under the MIT license, {filler}",
        3: f"{filler}\n{wrapped(TEMPLATES['LGPL-2.1-header'], 70)}",
        4: f"{wrapped(TEMPLATES['MIT-text'], 72)}\n{filler}",
        5: filler,
        6: "this program is free and the license of the software is granted to any person under the terms of the license",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {}
    for r in license_scan(docs).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    assert "GPL-3.0-header" in found[0] and "BSD-opening" in found[1] and found[2] == {"MIT"}
    assert "LGPL-2.1-header" in found[3] and {"MIT-text", "MIT-permission"} <= found[4]
    assert 5 not in found and 6 not in found
