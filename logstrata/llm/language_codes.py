"""Language identification by error-correcting output codes over byte n-grams.

Every learned language gets a codeword; one binary n-gram classifier for each bit separates the languages whose codeword
has it set from the others. A classifier weighs an n-gram by the log odds of its share in the two groups, in which all
languages count alike; the counts come from all learning texts. A text's signed evidence for each bit is compared with all
codewords by logistic losses, weighted by how far the bit's two groups diverge; the language with the smallest sum wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata.llm.bytegrams import grams, inside_texts
from logstrata.llm.textblocks import LOWER, SPACE, flat, mix, slices

BITS = 16
ORDERS = (2, 3, 4)
# Neighbouring n-grams repeat each other's evidence; it is divided by so much before the losses.
OVERLAP = 12.0
AMBIGUOUS = 0.75
UNDETERMINED = "und"
# Letters keep their lower-case byte; other ASCII becomes a blank.
FOLD = np.where(((LOWER >= 97) & (LOWER <= 122)) | (LOWER >= 128), LOWER, np.uint8(32))


def _features(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: hashed n-grams, and the text number of each."""
    data = FOLD[data]
    for size in ORDERS:
        at = np.flatnonzero(inside_texts(bounds, size))
        hashed = mix(grams(data, size)[at].astype(np.uint64) + np.uint64(size << 40)) >> np.uint64(64 - BITS)
        yield hashed.astype(np.int32), np.searchsorted(bounds, at, "right") - 1


def codewords(languages: int) -> np.ndarray:
    """Distinct +1/-1 codewords: all splits of up to six languages, else the best of some seeded random codes."""
    if languages <= 1:
        return np.ones((languages, 1))
    if languages <= 6:
        bits = range(1, 1 << (languages - 1))
        return np.array([[1.0 if b >> i & 1 else -1.0 for b in bits] for i in range(languages)])
    length, draw = 10 * math.ceil(math.log2(languages)), np.random.Generator(np.random.PCG64(3))

    def distance(code: np.ndarray) -> int:
        apart = (length - code @ code.T) / 2
        return int((apart + np.eye(languages) * length).min())

    codes = [np.where(draw.random((languages, length)) < 0.5, 1.0, -1.0) for _ in range(64)]
    return max((c for c in codes if (np.abs(c.sum(0)) < languages).all()), key=distance, default=codes[0])


class LanguageCodes:
    """Classifiers of all bits over hashed n-grams, fitted from ``counts[language, n-gram]``."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        shares = (counts + 0.05) / (counts.sum(1, keepdims=True) + 0.05 * counts.shape[1])
        width = self.code.shape[1]
        self.weights, self.importance = np.zeros((1 << BITS, width), np.float32), np.ones(width)
        for bit in range(width if len(languages) > 1 else 0):
            yes, no = (shares[self.code[:, bit] == s].mean(0) for s in (1, -1))
            self.weights[:, bit] = np.log(yes / no)
            self.importance[bit] = ((yes - no) * np.log(yes / no)).sum()
        self.importance /= self.importance.sum() or 1
        self.bits = np.log2(shares * counts.shape[1]).astype(np.float32)

    def evidence(self, data: np.ndarray, bounds: np.ndarray, language: np.ndarray) -> np.ndarray:
        """Bits by which a text's n-grams are, on average, likelier in a language than drawn evenly; 0 without any."""
        texts = len(bounds) - 1
        total, n = np.zeros(texts), np.zeros(texts)
        for hashed, text in _features(data, bounds):
            total += np.bincount(text, weights=self.bits[language[text], hashed], minlength=texts)
            n += np.bincount(text, minlength=texts)
        return total / np.maximum(n, 1)

    def decode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, share of belief in it, and in the runner-up, of each text."""
        texts = len(bounds) - 1
        evidence = np.zeros((texts, self.code.shape[1]))
        for hashed, text in _features(data, bounds):
            present, first = np.unique(text, return_index=True)
            if len(present):
                evidence[present] += np.add.reduceat(self.weights[hashed], first, axis=0, dtype=np.float64)
        evidence /= OVERLAP
        losses = np.logaddexp(0, -evidence[:, None, :] * self.code[None]) @ self.importance
        belief = np.exp(-self.code.shape[1] / 2 * (losses - losses.min(1, keepdims=True)))
        belief /= belief.sum(1, keepdims=True)
        ranked = np.argsort(-belief, axis=1, kind="stable")
        rows = np.arange(texts)
        second = belief[rows, ranked[:, 1]] if belief.shape[1] > 1 else np.zeros(texts)
        return ranked[:, 0], belief[rows, ranked[:, 0]], second


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> LanguageCodes:
    """Count n-grams by language over all texts where ``learn`` holds; one dense row of counts for each language.

    Rows without a language are left out, a null text counts as empty, repeated rows count each. Without any language the
    model has none and tells nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for part in slices(batches, "text", 1 << 18):
            data, bounds = flat(part.column("text"))
            names, own = np.unique(np.array(part.column("lang").to_pylist(), object), return_inverse=True)
            sums = np.zeros(len(names) << BITS, np.int64)
            for hashed, text_number in _features(data, bounds):
                sums += np.bincount((own[text_number] << BITS) + hashed, minlength=len(sums))
            for i, name in enumerate(names):
                held[name] = held.get(name, 0) + sums[i << BITS : (i + 1) << BITS]
        for name, sums in held.items():
            seen = np.flatnonzero(sums)
            seen = seen if len(seen) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen)), pa.array(seen), pa.array(sums[seen])], names=["lang", "gram", "n"]
            )

    rows = docs.where(learn & F.col(lang).isNotNull()).select(F.coalesce(text, F.lit("")).alias("text"), F.col(lang).alias("lang"))
    counted = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages, own = np.unique(np.array(counted.column("lang").to_pylist(), object), return_inverse=True)
    counts = np.zeros((len(languages), 1 << BITS))
    counts[own, counted.column("gram").to_numpy()] = counted.column("n").to_numpy()
    return LanguageCodes(languages.tolist(), counts)


def letter_share(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The share of letters among the bytes of each text that are not blank; 0 without any."""
    letter, solid = np.concatenate(([0], np.cumsum(FOLD[data] != 32))), np.concatenate(([0], np.cumsum(~SPACE[data])))
    return np.diff(letter[bounds]) / np.maximum(np.diff(solid[bounds]), 1)


def identify(docs: DataFrame, model: LanguageCodes, text: str = "text", carry: list[str] | None = None, evidence: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

    With ``evidence`` also that of the predicted language (bits an n-gram; negative where chance does better), and
    ``letters``, the share of letters in what is not blank.

    A text that is null or has no letter, and any text for a model without languages, gets ``und`` with score 0. A text is
    ambiguous when the belief in its language is below ``AMBIGUOUS`` of that in the best two. Only the text decides. ``carry``
    names fewer columns to keep; columns that carry one of the new names are replaced.
    """
    new = ["lang_pred", "score", "ambiguous", *(["evidence", "letters"] if evidence else [])]
    names = [c for c in (docs.columns if carry is None else carry) if c not in new]
    source = docs.select(*names, F.col(text).alias("_text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-2])
    languages = np.array([*model.languages, UNDETERMINED], object)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", 1 << 18):
            texts, known = part.num_rows, part.column("_letters").to_numpy(zero_copy_only=False)
            best, score, second = np.full(texts, len(languages) - 1), np.zeros(texts), np.zeros(texts)
            if model.languages:
                data, bounds = flat(part.column("_text"))
                found, score, second = model.decode(data, bounds)
                best = np.where(known, found, best)
                score, second = np.where(known, score, 0.0), np.where(known, second, 0.0)
            columns = [pa.array(languages[best].tolist(), pa.string()), pa.array(score), pa.array(score < AMBIGUOUS * (score + second))]
            if evidence:
                data, bounds = flat(part.column("_text"))
                bits = model.evidence(data, bounds, found) if model.languages else np.zeros(texts)
                columns += [pa.array(bits), pa.array(letter_share(data, bounds))]
            yield pa.RecordBatch.from_arrays([*part.columns[:-2], *columns], names=[*part.schema.names[:-2], *new])

    return source.mapInArrow(decide, f"{schema + ', ' if schema else ''}lang_pred string, score double, ambiguous boolean" + (", evidence double, letters double" if evidence else ""))
