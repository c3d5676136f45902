"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is a run of letters, lower-cased; hashes of the word and of its first five and seven bytes pick three of 2^20
embedding rows, whose sum stands for it, so that inflected forms share what they have in common. Filters of one, two and three words run
over the whole text, each keeps its maximum, and a logistic unit reads the maxima. Training takes at most ``SAMPLE``
labelled texts, those first in a hash order; a fifth of them is set aside to calibrate the score, and a threshold for each
language. Rows of words that the sample never showed are zero, so unknown words say nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata.llm.language_codes import FOLD
from logstrata.llm.textblocks import PrefixHash, flat, mix, slices, word_spans

SAMPLE = 6000
ROWS_BITS = 20
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
STEMS = (5, 7)
EPOCHS = 10
THRESHOLD = 0.3


def word_rows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The embedding rows of every word, and where each text's words begin (one more than texts)."""
    folded = FOLD[data]
    starts, ends, text = word_spans(folded, bounds)
    prefix = PrefixHash(folded)
    parts = [prefix.of(starts, ends), *(mix(prefix.of(starts, np.minimum(ends, starts + n)) + np.uint64(n)) for n in STEMS)]
    rows = np.stack([(p >> np.uint64(64 - ROWS_BITS)).astype(np.int32) for p in parts], axis=1)
    return rows, np.searchsorted(text, np.arange(len(bounds)))


class ToxicityCnn:
    """Parameters, forward pass and training steps."""

    def __init__(self, seed: int = 8):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.rows = np.zeros(0, np.int32)
        self.table = np.zeros((1, DIM), np.float32)
        self.filters = [draw.normal(0, 0.5, (width, DIM, FILTERS)).astype(np.float32) for width in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = draw.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.shift, self.slope, self.offset = np.float32(-2.0), 1.0, 0.0
        self.thresholds: dict[str, float] = {}
        self.draw = draw

    def _local(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the table of known rows; 0, a row of zeros, for all others."""
        at = np.minimum(np.searchsorted(self.rows, rows), max(len(self.rows) - 1, 0))
        return np.where(self.rows[at] == rows, at + 1, 0).astype(np.int32) if len(self.rows) else np.zeros(rows.shape, np.int32)

    @staticmethod
    def _spaced(local: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with zero rows behind each text, so that no filter reaches into the next one."""
        gap, texts = max(WIDTHS), len(first) - 1
        out = np.zeros((len(local) + gap * texts, local.shape[1]), np.int32)
        out[np.arange(len(local)) + gap * np.repeat(np.arange(texts), np.diff(first))] = local
        return out, first + gap * np.arange(texts + 1)

    def _pooled(self, local: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The words and, for each width, the values of its filters at every word."""
        words = sum(self.table[local[:, i]] for i in range(local.shape[1]))
        for kernel in self.filters:
            n = len(words) - len(kernel) + 1
            values = sum(words[j : j + n] @ kernel[j] for j in range(len(kernel)))
            values = np.concatenate((values, np.zeros((len(words) - n, FILTERS), np.float32)))
            for j in range(1, len(kernel)):
                # From here a filter would reach into the next text; rows of zeros before it give the same value, zero.
                values[first[1:] - j] = 0
            yield values

    def logits(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        local, first = self._spaced(self._local(rows), first)
        maxima = np.concatenate([np.maximum.reduceat(v, first[:-1], axis=0) for v in self._pooled(local, first)], axis=1)
        return np.maximum(maxima + self.bias, 0) @ self.out + self.shift

    def score(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.logits(rows, first).astype(np.float64) + self.offset)))

    def train(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        if len(set(labels.tolist())) < 2:
            self.shift = np.float32(20.0 * (2 * labels.mean() - 1)) if len(labels) else np.float32(-20.0)
            self.out[:] = 0
            return
        self.rows = np.unique(np.concatenate(texts))
        self.table = self.draw.normal(0, 0.1, (len(self.rows) + 1, DIM)).astype(np.float32)
        self.table[0] = 0
        local = [self._local(t) for t in texts]
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        squares = {name: 1e-6 for name in ("table", "out", "bias", "shift", *range(len(WIDTHS)))}
        squares["table"] = np.full(self.table.shape, 1e-6, np.float32)

        def step(name, parameter, gradient, rate=0.08):
            squares[name] = squares[name] + gradient**2
            return parameter - rate * gradient / np.sqrt(squares[name])

        for _ in range(EPOCHS):
            order = self.draw.permutation(len(texts))
            for begin in range(0, len(order), 32):
                chosen = order[begin : begin + 32]
                sizes = [len(local[i]) for i in chosen]
                joined, first = self._spaced(np.concatenate([local[i] for i in chosen]), np.concatenate(([0], np.cumsum(sizes))))
                tops, maxima = [], []
                for values in self._pooled(joined, first):
                    top = np.stack([values[a:b].argmax(0) + a for a, b in zip(first[:-1], first[1:])])
                    tops.append(top)
                    maxima.append(values[top, np.arange(FILTERS)])
                hidden = np.concatenate(maxima, axis=1) + self.bias
                active = np.maximum(hidden, 0)
                error = (1 / (1 + np.exp(-(active @ self.out + self.shift))) - labels[chosen]) * weight[chosen] / len(chosen)
                into = error[:, None] * self.out * (hidden > 0)
                self.out = step("out", self.out, active.T @ error).astype(np.float32)
                self.bias = step("bias", self.bias, into.sum(0)).astype(np.float32)
                self.shift = np.float32(step("shift", self.shift, error.sum()))
                at, changes = [], []
                for k, (kernel, top) in enumerate(zip(self.filters, tops)):
                    back = into[:, k * FILTERS : (k + 1) * FILTERS]
                    gradient = np.zeros_like(kernel)
                    for j in range(len(kernel)):
                        words = joined[top + j]
                        gradient[j] = np.einsum("tfd,tf->df", self.table[words].sum(2), back)
                        change = (back[:, :, None] * kernel[j].T[None]).reshape(-1, DIM)
                        for part in range(words.shape[2]):
                            at.append(words[:, :, part].ravel())
                            changes.append(change)
                    self.filters[k] = step(k, kernel, gradient).astype(np.float32)
                touched, where = np.unique(np.concatenate(at), return_inverse=True)
                sums = np.zeros((len(touched), DIM), np.float32)
                np.add.at(sums, where, np.concatenate(changes))
                squares["table"][touched] += sums**2
                self.table[touched] -= 0.08 * sums / np.sqrt(squares["table"][touched])
                self.table[0] = 0

    def calibrate(self, texts: list[np.ndarray], labels: np.ndarray, languages: list[str | None]) -> None:
        """Fit slope and offset by Newton steps on smoothed targets, then the threshold of each language with the best F1."""
        if len(set(labels.tolist())) < 2:
            return
        first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        x = self.logits(np.concatenate(texts), first).astype(np.float64)
        ones = labels.sum()
        target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * x + b)))
            w = np.maximum(p * (1 - p), 1e-9)
            design = np.stack((x, np.ones_like(x)), 1)
            change = np.linalg.solve(design.T @ (design * w[:, None]) + 1e-3 * np.eye(2), design.T @ (target - p))
            a, b = a + np.clip(change[0], -0.5, 0.5), b + np.clip(change[1], -1, 1)
        self.slope, self.offset = max(a, 1e-3), b
        scores = 1 / (1 + np.exp(-(self.slope * x + self.offset)))
        for language in sorted({k for k in languages if k is not None}):
            own = np.array([k == language for k in languages])
            if labels[own].sum() >= 5:
                tried = np.arange(0.05, 1, 0.05)
                f1 = [2 * ((scores[own] >= t) & (labels[own] == 1)).sum() / max((scores[own] >= t).sum() + labels[own].sum(), 1) for t in tried]
                best = [t for t, f in zip(tried, f1) if f == max(f1)]
                self.thresholds[language] = float(min(best, key=lambda t: abs(t - THRESHOLD)))


def fit(docs: DataFrame, learn: Column, toxic: str = "toxic", key: str = "doc_id", text: str = "text", lang: str = "lang", labels: DataFrame | None = None) -> ToxicityCnn:
    """Train on the first ``SAMPLE`` labelled rows of ``docs``, in hash order of the key, where ``learn`` holds.

    The label is a column of ``docs``, or of ``labels`` under the same key. The sample is chosen on keys alone; only the
    texts below the hash that ends it are read for training. Rows with a null text, label or (with ``labels``) key are left
    out; repeated rows count each; with no row or one class only, the model scores alike everything it cannot tell.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows, first = word_rows(*flat(part.column("text")))
            blobs = [rows[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("place"), part.column("label"), part.column("lang"), pa.array(blobs, pa.binary())],
                names=["place", "label", "lang", "words"],
            )

    place = F.xxhash64(key)
    given = docs.where(learn & F.col(text).isNotNull())
    if labels is not None:
        labels = labels.where(F.col(toxic).isNotNull()).select(F.col(key).alias("_key"), F.col(toxic).alias("_toxic"), place.alias("_place"))

    def labelled(limit: int | None) -> DataFrame:
        rows = given if limit is None else given.where(place <= limit)
        if labels is None:
            return rows.where(F.col(toxic).isNotNull()).withColumn("_toxic", F.col(toxic))
        own = labels if limit is None else labels.where(F.col("_place") <= limit)
        return rows.join(own, F.col(key) == F.col("_key"))

    # At most 65,536 shares of the hash range; the first that together hold the sample.
    share = F.shiftright(place, 48)
    shares = labelled(None).groupBy(share.alias("share")).agg(F.count("*").alias("n")).collect()
    limit, seen = -1 << 63, 0
    for r in sorted(shares, key=lambda r: r["share"]):
        if seen < SAMPLE:
            limit, seen = (r["share"] + 1 << 48) - 1, seen + r["n"]
    rows = labelled(limit).select(place.alias("place"), F.col("_toxic").cast("int").alias("label"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sample = rows.orderBy("place", "text").limit(SAMPLE).mapInArrow(hashed, "place long, label int, lang string, words binary").toArrow()
    sample = sample.sort_by("place")
    texts = [np.frombuffer(b, np.int32).reshape(-1, 1 + len(STEMS)) for b in sample.column("words").to_pylist()]
    labels, languages = sample.column("label").to_numpy().astype(np.int64), sample.column("lang").to_pylist()
    aside = np.arange(len(texts)) % 5 == 4
    model = ToxicityCnn()
    model.train([t for t, a in zip(texts, aside) if not a], labels[~aside])
    model.calibrate([t for t, a in zip(texts, aside) if a], labels[aside], [k for k, a in zip(languages, aside) if a])
    return model


def detect(docs: DataFrame, model: ToxicityCnn, text: str = "text", lang: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` (score at or above 0.3) and ``over_language_threshold``.

    The score reads nothing but the text; null and empty texts get the score of a text without words. The last column holds
    the score against the threshold calibrated for the row's ``lang``, or 0.3 where there is none. ``carry`` names fewer
    columns to keep; columns that carry one of the new names are replaced.
    """
    new = ["score", "predicted", "over_language_threshold"]
    names = [c for c in (docs.columns if carry is None else carry) if c not in new]
    source = docs.select(*names, F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-2])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            score = model.score(*word_rows(*flat(part.column("_text"))))
            limits = np.array([model.thresholds.get(k, THRESHOLD) for k in part.column("_lang").to_pylist()])
            columns = [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(score >= limits)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-2], *columns], names=[*part.schema.names[:-2], *new])

    return source.mapInArrow(rate, f"{schema}score double, predicted int, over_language_threshold boolean")
