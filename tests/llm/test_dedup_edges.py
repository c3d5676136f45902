"""The edges that near-duplicate bands send to the components: few, and connecting the same."""

from __future__ import annotations

import random

from logstrata.llm.minhash_dedup import band_edges


def groups(nodes, edges):
    top = {n: n for n in nodes}

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in edges:
        top[root(a)] = root(b)
    return {frozenset(m for m in nodes if root(m) == root(n)) for n in nodes}


def test_band_edges_connect_what_the_bands_connect(spark):
    draw = random.Random(1)
    bands = [sorted({draw.randrange(400) for _ in range(draw.choice([1, 2, 3, 9]))}) for _ in range(160)]
    # A large cluster: most of its bands hold most of its nodes.
    bands += [[n for n in range(1000, 1300) if draw.random() < 0.9] for _ in range(40)]
    met = [(n, band[0]) for band in bands if len(band) > 1 for n in band]
    found = [(r.a, r.b) for r in band_edges(spark.createDataFrame(met, "node long, a long")).collect()]
    nodes = {n for n, _ in met}
    assert groups(nodes, found) == groups(nodes, met)
    assert len(found) == len(set(found)) and all(a < b for a, b in found)
    assert len([e for e in found if e[0] >= 1000]) < 2 * 300 < len({e for e in met if e[1] >= 1000 and e[0] != e[1]})


def test_band_edges_of_nothing(spark):
    assert band_edges(spark.createDataFrame([], "node long, a long")).count() == 0
