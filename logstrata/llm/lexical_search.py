"""Ranked lexical search: the best documents of each item, by norm buckets over impact vectors.

A document is a vector of impacts over the terms that any item holds, an item a vector of repeats. Every task orders its
documents by length of vector and cuts them into buckets. An item passes over a bucket when its own length times the
bucket's largest cannot reach the item's threshold (Cauchy-Schwarz). In a bucket that may reach it, the item's few weightiest
coordinates are added up first; they and Cauchy-Schwarz on the remaining ones bound each document. What survives is
scored again in 64-bit integers.

Thresholds start from the longest vectors of the whole table, found by a histogram of lengths, and rise within each task.
A task sends at most ``k`` rows an item, so nothing depends on how the documents are dealt, and no text is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logstrata.llm.textblocks import release, slices
from logstrata.session import materialize

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

# Items are taken in blocks of so many bytes of text: what a task holds of them is bounded, whatever the table.
BLOCK_BYTES = 8 << 20
LOT_POSTINGS = 1 << 20
BUCKET = 512
# A bucket ends early where lengths have fallen by this share and it has some documents.
FALL, SOME = 0.8, 64
FOCUS = 5
# The longest vectors that set the first thresholds: one document in so many.
HEAD_SHARE = 64
# Bounds are kept in doubles; a document this close below the threshold is scored all the same.
SLACK = 1e-9

VECTORS = "doc long, n long, terms array<int>, tfs array<int>"
HITS = "item int, doc long, score long"


def terms(text: bytes) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case."""
    return TERM.findall(text.lower())


def term_vectors(docs: DataFrame, vocabulary: list[bytes], doc_id: str, text: str) -> DataFrame:
    """``(doc, n, terms, tfs)`` of every text with a term: all its terms counted, those of the vocabulary by number."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            doc, n, ids, tfs, bounds = [], [], [], [], [0]
            for d, t in zip(part.column("_doc").to_pylist(), part.column("_text").cast(pa.large_binary()).to_pylist()):
                words = terms(t or b"")
                if not words:
                    continue
                own = Counter(filter(number.__contains__, words))
                doc.append(d)
                n.append(len(words))
                ids.extend(map(number.__getitem__, own))
                tfs.extend(own.values())
                bounds.append(len(ids))
            at = pa.array(bounds, pa.int32())
            columns = [pa.array(doc, pa.int64()), pa.array(n, pa.int64())]
            columns += [pa.ListArray.from_arrays(at, pa.array(v, pa.int32())) for v in (ids, tfs)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "terms", "tfs"])

    source = docs.select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text"))
    return source.mapInArrow(count, VECTORS)


def corpus_counts(vectors: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms with repeats, and the number of documents that hold each term of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, all_terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            docs += batch.num_rows
            all_terms += int(batch.column("n").to_numpy().sum())
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(held)
        term, df = np.concatenate(([-2, -1], some)), np.concatenate(([docs, all_terms], held[some]))
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(df, pa.int64())], names=["term", "df"])

    # As many rows as the items of one block have terms.
    found = vectors.mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    total = dict(zip(found.column("term").to_pylist(), found.column("df").to_pylist()))
    return total.get(-2, 0), total.get(-1, 0), np.array([total.get(i, 0) for i in range(size)], np.int64)


@dataclass
class Items:
    """The items of a block as sparse vectors; each item's coordinates by falling weight."""

    terms: np.ndarray
    repeats: np.ndarray
    bounds: np.ndarray
    weights: np.ndarray
    documents: int
    length: int

    def __post_init__(self) -> None:
        squares = np.add.reduceat(np.append(self.repeats.astype(float) ** 2, 0), self.bounds[:-1]) * (np.diff(self.bounds) > 0)
        self.norms = np.sqrt(squares)
        self.focus = np.minimum(self.bounds[:-1] + FOCUS, self.bounds[1:])
        rest = [float((self.repeats[a:b].astype(float) ** 2).sum()) for a, b in zip(self.focus, self.bounds[1:])]
        self.rest = np.sqrt(rest)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def impacts(self, doc_terms: np.ndarray, tfs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The weight of each posting: what one repeat of its term in an item adds to the score."""
        m = 75 + (25 * n * self.documents) // self.length
        return self.weights[doc_terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m))


def make_items(texts: list[list[bytes]], vocabulary: list[bytes], documents: int, length: int, df: np.ndarray) -> Items:
    number = {t: i for i, t in enumerate(vocabulary)}
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    ids, repeats, bounds = [], [], [0]
    for words in texts:
        own = sorted(((number[t], r) for t, r in Counter(words).items()), key=lambda x: (-int(weights[x[0]]) * x[1], x[0]))
        ids += [i for i, _ in own]
        repeats += [r for _, r in own]
        bounds.append(len(ids))
    return Items(np.array(ids, np.int64), np.array(repeats, np.int64), np.array(bounds, np.int64), weights, documents, length)


class Best:
    """The ``k`` best documents of each item so far: highest score first, then lowest id, null ids before all."""

    def __init__(self, thresholds: np.ndarray, k: int):
        self.least = thresholds.copy()
        self.k = k
        self.scores = [np.zeros(0, np.int64) for _ in thresholds]
        self.docs = [np.zeros(0, np.int64) for _ in thresholds]

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate((self.scores[item], scores)), np.concatenate((self.docs[item], docs))
        order = np.lexsort((docs, -scores))[: self.k]
        self.scores[item], self.docs[item] = scores[order], docs[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], scores[order[-1]])


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and which range each is of."""
    sizes = ends - starts
    of = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(of)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes), of


class Vectors:
    """The impact vectors of a lot, longest first."""

    def __init__(self, items: Items, doc: np.ndarray, n: np.ndarray, doc_terms: np.ndarray, tfs: np.ndarray, sizes: np.ndarray):
        self.items, self.doc = items, doc
        self.of = np.repeat(np.arange(len(doc)), sizes)
        self.terms = doc_terms
        self.impacts = items.impacts(doc_terms, tfs, np.repeat(n, sizes))
        self.norms = np.sqrt(np.bincount(self.of, weights=self.impacts.astype(float) ** 2, minlength=len(doc)))
        self.bounds = np.concatenate(([0], np.cumsum(sizes)))

    def buckets(self, low: float, high: float) -> Iterator[np.ndarray]:
        """Documents with lengths from ``low`` to below ``high``, by falling length, in buckets."""
        order = np.argsort(-self.norms, kind="stable")
        falling = self.norms[order]
        first = int(np.searchsorted(-falling, -high, "right"))
        last = int(np.searchsorted(-falling, -low, "right"))
        while first < last:
            end = max(int(np.searchsorted(-falling, -FALL * falling[first], "right")), first + SOME)
            end = min(end, first + BUCKET, last)
            yield order[first:end]
            first = end

    def search(self, low: float, high: float, best: Best) -> None:
        items = self.items
        for bucket in self.buckets(low, high):
            norms = self.norms[bucket]
            alive = np.flatnonzero(items.norms * norms[0] * (1 + SLACK) >= best.least)
            if not len(alive):
                continue
            rows, of = _ranges(self.bounds[bucket], self.bounds[bucket + 1])
            order = np.argsort(self.terms[rows], kind="stable")
            by_term, of, impacts = self.terms[rows][order], of[order], self.impacts[rows][order]
            starts, ends = np.searchsorted(by_term, items.terms, "left"), np.searchsorted(by_term, items.terms, "right")
            for i in alive.tolist():
                self._item(i, bucket, norms, of, impacts, starts, ends, best)

    def _item(self, i, bucket, norms, of, impacts, starts, ends, best) -> None:
        items, least = self.items, best.least[i]
        first, focus, last = items.bounds[i], items.focus[i], items.bounds[i + 1]
        rows, term = _ranges(starts[first:focus], ends[first:focus])
        weight = impacts[rows].astype(float)
        some = np.bincount(of[rows], weights=weight * items.repeats[first:focus][term], minlength=len(bucket))
        squares = np.bincount(of[rows], weights=weight**2, minlength=len(bucket))
        bound = some + items.rest[i] * np.sqrt(np.maximum(norms**2 * (1 + SLACK) - squares, 0))
        near = bound * (1 + SLACK) >= least
        if not near.any():
            return
        rows, term = _ranges(starts[first:last], ends[first:last])
        kept = near[of[rows]]
        rows, term = rows[kept], term[kept]
        scores = np.zeros(len(bucket), np.int64)
        np.add.at(scores, of[rows], impacts[rows] * items.repeats[first:last][term])
        hits = np.flatnonzero(scores >= least)
        if len(hits):
            best.add(i, scores[hits], self.doc[bucket[hits]])


# A null id takes the place before all others.
NO_ID = np.iinfo(np.int64).min


def _lots(batches: Iterable[pa.RecordBatch], items: Items) -> Iterator[Vectors]:
    """Impact vectors of the batches in lots of a bounded number of postings, or one document."""

    def lot(held: list[pa.RecordBatch]) -> Vectors:
        table = pa.Table.from_batches(held).combine_chunks()
        doc = table.column("doc").fill_null(NO_ID).to_numpy()
        lists = table.column("terms").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        tfs = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
        return Vectors(items, doc, table.column("n").to_numpy(), lists.flatten().to_numpy().astype(np.int64), tfs, sizes)

    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            held.append(part)
            size += len(part.column("terms").flatten())
            if size >= LOT_POSTINGS:
                yield lot(held)
                held, size = [], 0
    if held:
        yield lot(held)
    release()


def _step(norm: np.ndarray) -> np.ndarray:
    """Lengths of vectors on a scale where a step is a ninth."""
    return np.floor(np.log(np.maximum(norm, 1)) * 8).astype(np.int64)


def head_length(vectors: DataFrame, items: Items) -> float:
    """A length that at least one document in ``HEAD_SHARE`` reaches."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps: Counter = Counter()
        for lot in _lots(batches, items):
            step, n = np.unique(_step(lot.norms[lot.norms > 0]), return_counts=True)
            steps.update(dict(zip(step.tolist(), n.tolist())))
        yield pa.RecordBatch.from_arrays([pa.array(list(steps), pa.int64()), pa.array(list(steps.values()), pa.int64())], names=["step", "n"])

    # A few hundred steps at most: lengths lie between 1 and 2^63.
    found = vectors.mapInArrow(count, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()
    want, seen = sum(r["n"] for r in found) / HEAD_SHARE, 0
    for step, n in sorted(((r["step"], r["n"]) for r in found), reverse=True):
        seen += n
        if seen >= want:
            return math.exp(step / 8) * (1 - SLACK)
    return 1.0


def _hits(vectors: DataFrame, items: Items, thresholds: np.ndarray, low: float, high: float, k: int) -> DataFrame:
    """The ``k`` best of each item in every task, among vectors of a length from ``low`` to below ``high``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(thresholds, k)
        for lot in _lots(batches, items):
            lot.search(low, high, best)
        docs = np.concatenate([*best.docs, np.zeros(0, np.int64)])
        columns = [
            pa.array(np.repeat(np.arange(len(items)), [len(d) for d in best.docs]), pa.int32()),
            pa.array(docs, pa.int64(), mask=docs == NO_ID),
            pa.array(np.concatenate([*best.scores, np.zeros(0, np.int64)]), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc", "score"])

    return vectors.mapInArrow(search, HITS)


def best_of(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item with their ``rank``."""
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    return hits.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, texts: list[list[bytes]], k: int, doc_id: str, text: str) -> DataFrame | None:
    """``(item, doc, score, rank)`` for the items of one block, numbered as they come; None if no document has a term."""
    vocabulary = sorted({t for words in texts for t in words})
    vectors = materialize(term_vectors(docs, vocabulary, doc_id, text), "vectors")
    documents, length, df = corpus_counts(vectors, len(vocabulary))
    if not documents:
        return None
    items = make_items(texts, vocabulary, documents, length, df)
    vectors = vectors.where(F.size("terms") > 0)
    least = np.ones(len(items), np.int64)
    cut = head_length(vectors, items)
    head = materialize(best_of(_hits(vectors, items, least, cut, math.inf, k), k), "head")
    for r in head.where(F.col("rank") == k).select("item", "score").collect():  # one row an item of the block
        least[r["item"]] = max(least[r["item"]], r["score"])
    rest = _hits(vectors, items, least, 0.0, cut, k)
    return best_of(head.select("item", "doc", "score").union(rest), k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every row of ``items`` with a score above 0.

    Terms, weights and scores are those of the module's contract: rare terms weigh more, repeats in a document add less and
    less, and long documents pay for their length. Ids of documents are integers. Every row of ``items`` is an item of its
    own, repeated rows included, and takes its rows under its ``item_id``, null or not. Every row of ``docs`` is a document
    of its own; rows that share an id each take a place. Null and empty texts have no term: such an item has no rows, such
    a document is never found and does not count. Equal scores go by ascending id, nulls first. Other columns are ignored.
    Empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = materialize(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("_row")), "items")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = spark.createDataFrame([], f"item_id {rows.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    for block in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("_row"), F.lit(blocks)) == block).orderBy("_row").toArrow()
        texts = [terms((t or "").encode()) for t in own.column("text").to_pylist()]
        if not any(texts):
            continue
        found = search_block(docs, texts, k, doc_id, text)
        if found is None:
            break
        names = spark.createDataFrame(list(zip(range(len(texts)), own.column("item_id").to_pylist())), f"item int, item_id {rows.schema['item_id'].dataType.simpleString()}")
        out = out.union(found.join(names, "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score"))
    return out
