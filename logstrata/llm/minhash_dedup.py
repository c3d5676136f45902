"""MinHash near-duplicates with sequential Bayesian verification.

Texts with the same set of shingles become one node. Nodes that share a band of their signatures are candidates. A pair's
signatures are compared batch by batch; it is dropped as soon as the posterior chance that its similarity reaches the
threshold, given a flat prior, falls below ``MISS``. What survives is checked on the full sets, and links make components.

Candidates are gathered by connected clusters of bands. A small cluster is handled in one place with others; a large one is
cut into blocks of about ``BLOCK`` nodes or ``BLOCK_SHINGLES`` shingles, and each pair of blocks is a group of its own, so no group grows with a cluster.
Pairs already linked through others are not compared again, and only links leave a group: fewer than its nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstrata.llm.components import components
from logstrata.llm.textblocks import LOWER, PrefixHash, flat, mix, release, slices, windows, word_spans
from logstrata.session import materialize

ROWS = 5
BATCH = 32
MISS = 1e-9
BLOCK = 512
# A block holds about so many shingles at most, unless one text alone has more.
BLOCK_SHINGLES = 1 << 20
# Small clusters share a group of about so many nodes.
TOGETHER = 2000


def band_count(percent: int) -> int:
    """Bands of ``ROWS`` values so that a pair at the threshold shares none with a chance below 1e-8."""
    return math.ceil(math.log(1e-8) / math.log(1 - (percent / 100) ** ROWS))


def least_matches(percent: int, hashes: int) -> list[tuple[int, int]]:
    """After n compared values, the matches below which the posterior chance of reaching the threshold is under MISS.

    With a flat prior that chance is the chance of at most m successes in n + 1 draws at the threshold.
    """
    out, t = [], percent / 100
    for n in [*range(BATCH, hashes, BATCH), hashes]:
        chance, m = 0.0, -1
        while chance < MISS:
            m += 1
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle of ``size`` words; a text with fewer words is one shingle."""
    lower = LOWER[data]
    starts, ends, text = word_spans(lower, bounds)
    words = PrefixHash(lower).of(starts, ends)
    counts = np.bincount(text, minlength=len(bounds) - 1)
    full = windows(words, size)
    inside = text[: len(full)] == text[size - 1 :] if len(full) else np.zeros(0, bool)
    hashes, owner = [full[inside]], [text[: len(full)][inside]]
    first = np.searchsorted(text, np.arange(len(bounds) - 1))
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        value = np.full(len(short), n, np.uint64)
        for k in range(n):
            value = mix(value + words[first[short] + k] + np.uint64(size))
        hashes.append(value)
        owner.append(short)
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return hashes[order], owner[order]


class Signer:
    """Signatures of sets of 64-bit values: minima under seeded xor-multiply permutations of 32 bits."""

    def __init__(self, hashes: int):
        draw = np.random.Generator(np.random.PCG64(17))
        self.flips = draw.integers(0, 1 << 32, hashes, dtype=np.uint32)
        self.factors = draw.integers(0, 1 << 31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(self, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A row for each run of values that begins at ``first``; runs are not empty."""
        short = (values >> np.uint64(32)).astype(np.uint32)
        out = np.empty((len(first), len(self.flips)), np.uint32)
        for k, (flip, factor) in enumerate(zip(self.flips, self.factors)):
            out[:, k] = np.minimum.reduceat((short ^ flip) * factor, first)
        return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    bands = signatures.shape[1] // ROWS
    keys = np.repeat(np.arange(bands, dtype=np.uint64)[None], len(signatures), axis=0)
    for r in range(ROWS):
        keys = mix(keys + signatures[:, r : bands * ROWS : ROWS].astype(np.uint64))
    return keys


def links_of(signatures: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of all pairs that share a band, survive the batches, and reach the threshold exactly."""
    n, out = len(sets), []
    keys, steps = band_keys(signatures), least_matches(percent, signatures.shape[1])
    sizes = np.array([len(s) for s in sets])
    component, members = np.arange(n), {i: [i] for i in range(n)}
    for q in range(n - 1):
        others = np.arange(q + 1, n)
        others = others[component[others] != component[q]]
        others = others[(np.minimum(sizes[others], sizes[q]) * 100 >= percent * np.maximum(sizes[others], sizes[q]))]
        others = others[(keys[others] == keys[q]).any(1)]
        matches, done = np.zeros(len(others), np.int64), 0
        for upto, least in steps:
            matches += (signatures[others, done:upto] == signatures[q, done:upto]).sum(1)
            alive = matches >= least
            others, matches, done = others[alive], matches[alive], upto
        others = others[np.argsort(-matches, kind="stable")]
        while len(others):
            chosen, others = others[:64], others[64:]
            joined = np.concatenate([sets[i] for i in chosen])
            at = np.minimum(np.searchsorted(sets[q], joined), sizes[q] - 1)
            first = np.concatenate(([0], np.cumsum(sizes[chosen])[:-1]))
            common = np.add.reduceat((sets[q][at] == joined).astype(np.int64), first)
            for p in chosen[100 * common >= percent * (sizes[chosen] + sizes[q] - common)]:
                if component[p] != component[q]:
                    out.append((q, int(p)))
                    small, large = sorted((component[p], component[q]), key=lambda c: len(members[c]))
                    component[members[small]] = large
                    members[large] += members.pop(small)
            others = others[component[others] != component[q]]
    return out


def band_edges(met: DataFrame) -> DataFrame:
    """``(a, b)`` edges that connect what ``(node, a)`` connects, ``a`` being the smallest node of a band that holds ``node``.

    A node is tied to the least of its bands' smallest nodes only, and those to each other in a chain. Nodes of one cluster
    share most of these chains, so a cluster sends about one edge a node instead of one for each band of a node. A node has
    no more such neighbours than a signature has bands.
    """
    # Pairs travel as they are: sets of them, put together before the exchange, would take several times the room.
    of_node = met.select("node", "a").repartition("node").groupBy("node").agg(F.array_sort(F.collect_set("a")).alias("least"))
    after = F.slice("least", F.lit(2), F.size("least"))
    pairs = F.arrays_zip(F.slice("least", F.lit(1), F.size("least") - 1).alias("a"), after.alias("b"))
    chain = of_node.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    tied = of_node.select(F.col("least")[0].alias("a"), F.col("node").alias("b")).where(F.col("a") != F.col("b"))
    return tied.union(chain).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for each row of ``docs``.

    Two texts are linked if 100 * shared shingles reach ``percent`` of the union; ``component_id`` is the smallest key
    reachable over links. A text without words has no shingles and is linked with nothing, as is a row without a key, whose
    component is null and which is kept. Rows that share a key count as one document. Empty tables give empty results.
    """
    hashes = band_count(percent) * ROWS
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(hashes)
        for part in slices(batches, "text"):
            data, bounds = flat(part.column("text"))
            values, owner = shingles(data, bounds, size)
            texts = len(bounds) - 1
            _, distinct = np.unique(mix(values + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
            distinct.sort()
            values, owner = values[distinct], owner[distinct]
            counts = np.bincount(owner, minlength=texts)
            present = np.flatnonzero(counts)
            first = np.searchsorted(owner, present)
            sums, blobs = np.zeros((2, texts), np.uint64), [None] * texts
            if len(present):
                for i in range(2):
                    sums[i, present] = np.add.reduceat(mix(values + np.uint64(i + 1)), first)
                for row, keys in zip(present.tolist(), band_keys(signer.sign(values, first))):
                    blobs[row] = keys.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(counts), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array(blobs, pa.binary())],
                names=["key", "n_shingles", "h1", "h2", "keys"],
            )

    signed = materialize(source.mapInArrow(sign, f"key {kind}, n_shingles long, h1 long, h2 long, keys binary"), "signatures")
    worded = signed.where((F.col("n_shingles") > 0) & F.col("key").isNotNull())
    nodes = worded.groupBy("h1", "h2").agg(F.min("key").alias("node"), F.first("keys").alias("keys"), F.max("n_shingles").alias("n_shingles"))
    nodes = materialize(nodes, "nodes")

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys = np.frombuffer(b"".join(part.column("keys").to_pylist()), np.uint64).reshape(part.num_rows, -1)
                node = part.column("node").take(pa.array(np.repeat(np.arange(part.num_rows), keys.shape[1])))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), node], names=["band", "node"])

    bands = nodes.select("node", "keys").mapInArrow(banded, f"band long, node {kind}")
    shared = bands.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("last")).where(F.col("a") < F.col("last"))
    clusters = components(band_edges(shared.join(bands, "band").select("node", "a"))).withColumnRenamed("component", "cluster")
    sizes = nodes.select("node", F.col("n_shingles").alias("own"))
    sized = clusters.join(sizes, "node").groupBy("cluster").agg(F.count("*").alias("nodes"), F.sum("own").alias("held"))
    whole = (F.col("nodes") <= 2 * BLOCK) & (F.col("held") <= 2 * BLOCK_SHINGLES)
    blocks = F.least("nodes", F.greatest(F.ceil(F.col("nodes") / BLOCK), F.ceil(F.col("held") / BLOCK_SHINGLES))).cast("int")
    sized = materialize(sized.withColumn("blocks", F.when(whole, 1).otherwise(blocks)), "sizes")
    placed = clusters.join(sized, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = materialize(placed.select("node", "cluster", "blocks", "block"), "clusters")
    small = sized.where(F.col("blocks") == 1).agg(F.sum("nodes"), F.sum("held")).first()
    groups = max(1, -(-(small[0] or 0) // TOGETHER), -(-(small[1] or 0) // BLOCK_SHINGLES))
    # Texts meet their place in one way at every size: by an exchange, without a sort.
    wanted = source.join(placed.hint("shuffle_hash"), F.col("key") == F.col("node")).select("node", "cluster", "blocks", "block", "text").dropDuplicates(["node", "text"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(hashes)
        for part in slices(batches, "text"):
            values, owner = shingles(*flat(part.column("text")), size)
            order = np.lexsort((values, owner))
            values, owner = values[order], owner[order]
            new = np.concatenate(([True], (np.diff(owner) != 0) | (values[1:] != values[:-1])))
            values, owner = values[new], owner[new]
            first = np.searchsorted(owner, np.arange(part.num_rows + 1))
            whole = np.flatnonzero(np.diff(first))
            signatures = signer.sign(values, first[whole])
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c).take(pa.array(whole)) for c in ("node", "cluster", "blocks", "block")),
                    pa.array([s.tobytes() for s in signatures], pa.binary()),
                    pa.array([values[first[i] : first[i + 1]].tobytes() for i in whole], pa.binary()),
                ],
                names=["node", "cluster", "blocks", "block", "signature", "shingles"],
            )

    sets = wanted.mapInArrow(collect, f"node {kind}, cluster {kind}, blocks int, block int, signature binary, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = sets.select("*", other.alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    place = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(groups))).otherwise(F.xxhash64("cluster", low, high))
    paired = paired.select(place.alias("place"), "cluster", "node", "signature", "shingles")

    def link(group: pa.Table) -> pa.Table:
        group = group.sort_by([("cluster", "ascending"), ("node", "ascending")])
        cluster = group.column("cluster").to_numpy()
        node, signatures, found = group.column("node"), group.column("signature"), group.column("shingles")
        cuts = np.concatenate(([0], np.flatnonzero(cluster[1:] != cluster[:-1]) + 1, [len(cluster)]))
        a, b = [], []
        for begin, end in zip(cuts[:-1], cuts[1:]):
            own = np.frombuffer(b"".join(signatures.slice(begin, end - begin).to_pylist()), np.uint32).reshape(end - begin, -1)
            full = [np.frombuffer(s, np.uint64) for s in found.slice(begin, end - begin).to_pylist()]
            for p, q in links_of(own, full, percent):
                a.append(begin + p)
                b.append(begin + q)
        release()
        return pa.table({"a": node.take(pa.array(a, pa.int64())), "b": node.take(pa.array(b, pa.int64()))})

    links = paired.groupBy("place").applyInArrow(link, f"a {kind}, b {kind}")
    reached = components(links)
    known = nodes.join(reached, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("component_id"))
    single = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("key"))
    result = signed.select("key", "n_shingles", "h1", "h2").join(known, ["h1", "h2"], "left")
    result = result.select(F.col("key").alias(key), "n_shingles", F.when(F.col("key").isNotNull(), single).alias("component_id"))
    return result.withColumn("kept", F.col(key).isNull() | (F.col(key) == F.col("component_id")))
