"""Windows of a few bytes inside texts, and their counts over a corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstrata.llm.textblocks import flat, slices

FLUSH = 1 << 20


def padded(data: np.ndarray, bounds: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``before`` zero bytes ahead of each and one behind; and the new bounds."""
    texts = len(bounds) - 1
    out = np.zeros(len(data) + texts * (before + 1), np.uint8)
    new = bounds + np.arange(texts + 1) * (before + 1)
    at = np.arange(len(data)) + np.repeat(np.arange(texts) * (before + 1) + before, np.diff(bounds))
    out[at] = data
    return out, new


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """The big-endian number of every ``size`` consecutive bytes."""
    n = max(len(data) - size + 1, 0)
    out = np.zeros(n, np.int64)
    for k in range(size):
        out = out << 8 | data[k : k + n]
    return out


def inside_texts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Marks the windows of ``size`` bytes that lie inside one padded text."""
    inside = np.ones(max(bounds[-1] - size + 1, 0), bool)
    for k in range(1, size):
        cut = bounds[1:-1] - k
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    return inside


def counted_grams(docs: DataFrame, text: str, size: int, fold: np.ndarray | None = None) -> DataFrame:
    """``(gram, n)`` of all ``size``-byte windows of the padded texts, summed in tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in slices(batches, text):
            data, bounds = flat(part.column(text))
            data, bounds = padded(data if fold is None else fold[data], bounds, size - 1)
            own, n = np.unique(grams(data, size)[inside_texts(bounds, size)], return_counts=True)
            both = np.concatenate((keys, own))
            keys, back = np.unique(both, return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate((counts, n)), minlength=len(keys)).astype(np.int64)
            if len(keys) > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["gram", "n"])
                keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["gram", "n"])

    return docs.select(text).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
