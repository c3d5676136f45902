"""Quality rules: word, line and repetition statistics, and perplexity bands of a modified Kneser-Ney byte model.

The model counts all 4-byte windows of all texts (each text between zero bytes). Counting, continuation counts, discounts
and the probability of every window are Spark aggregations and joins. Windows above ``LEAST_SHARE`` of the corpus become
sorted hash arrays that every task searches, at most 1 / LEAST_SHARE entries at any corpus size. The rarer ones, a small
part of any text, are asked for by a join and added to the sums of their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logstrata.llm.bytegrams import counted_grams, grams, inside_texts, padded
from logstrata.llm.textblocks import PrefixHash, flat, mix, per_text, slices, word_spans, windows
from logstrata.session import materialize

ORDER = 4
LEAST_SHARE = 2.0**-22
# The accepted band reaches so many interquartile ranges beyond the quartiles of the language, and so many standard errors
# of the text's own mean, since short texts scatter more.
BAND, ERRORS = 3.0, 2.0

SYMBOL = np.zeros(256, bool)
SYMBOL[np.frombuffer(b"[#*$%&|<>]"[1:-1], np.uint8)] = True


class HashArrays:
    """Values under sorted 64-bit hashes; an index by leading bits leaves a few entries to compare."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, salt: int):
        self.salt = np.uint64(salt)
        hashes = self._hash(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], np.append(values[order], np.nan).astype(np.float32)
        self.shift = np.uint64(64 - max(8, int(len(keys)).bit_length()))
        heads = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)
        self.first = np.searchsorted(self.hashes >> self.shift, heads).astype(np.int32)
        self.longest = int(np.diff(self.first).max(initial=0))

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return mix(keys.astype(np.uint64) + self.salt)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where it has none."""
        hashes = self._hash(keys)
        head = (hashes >> self.shift).astype(np.int64)
        at, out = self.first[head], np.full(len(keys), np.nan, np.float32)
        if not len(self.hashes):
            return out
        left = np.arange(len(keys))
        for _ in range(self.longest):
            here = np.minimum(at[left], len(self.hashes) - 1)
            hit = self.hashes[here] == hashes[left]
            out[left[hit]] = self.values[here[hit]]
            left = left[~hit]
            left = left[at[left] + 1 < self.first[head[left] + 1]]
            at[left] += 1
            if not len(left):
                break
        return out


def _smoothed(counts: DataFrame, order: int, lower: DataFrame | None) -> DataFrame:
    """``(gram, n, p)``: interpolated modified Kneser-Ney of one order, from its counts and the next lower order."""
    stats = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = ((stats[f"n{k}"] or 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    steps = [min(max(k - (k + 1) * y * b / a, 0.1), k - 0.1) if a else 0.5 * k for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    discount = F.when(F.col("n") == 1, steps[0]).when(F.col("n") == 2, steps[1]).otherwise(steps[2])
    # A context has 256 grams at most.
    context = Window.partitionBy(F.shiftright("gram", 8))
    total, left = F.sum("n").over(context), F.sum(discount).over(context)
    rows = counts.select("gram", "n", ((F.col("n") - discount) / total).alias("direct"), (left / total).alias("rest"))
    if lower is None:
        return rows.select("gram", "n", (F.col("direct") + F.col("rest") / 256).alias("p"))
    below = lower.select(F.col("gram").alias("_suffix"), F.col("p").alias("_lower"))
    rows = rows.join(below, F.col("gram").bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1)) == F.col("_suffix"))
    return rows.select("gram", "n", (F.col("direct") + F.col("rest") * F.col("_lower")).alias("p"))


def train(docs: DataFrame, text: str = "text") -> tuple[HashArrays, DataFrame]:
    """Negative log probability of the last byte of every window of the texts: arrays of the frequent ones, a table ``(gram, log)`` of the rest.

    Lower orders hold in how many left contexts a gram occurs.
    """
    counts = {ORDER: materialize(counted_grams(docs, text, ORDER), "grams")}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1)).alias("gram")
        counts[order] = materialize(counts[order + 1].groupBy(shorter).agg(F.count("*").alias("n")), "grams")
    model = None
    for order in range(1, ORDER + 1):
        model = _smoothed(counts[order], order, model)
    logs = materialize(model.select("gram", "n", (-F.log("p")).alias("log")), "logs")
    least = LEAST_SHARE * (logs.agg(F.sum("n")).first()[0] or 0)
    frequent = logs.where(F.col("n") >= least).select("gram", "log").toArrow()
    keys, values = (frequent.column(c).to_numpy() for c in ("gram", "log"))
    return HashArrays(keys, values, 0), logs.where(F.col("n") < least).select("gram", "log")


def text_statistics(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    texts = len(bounds) - 1
    owner = np.repeat(np.arange(texts), np.diff(bounds))
    starts, ends, text = word_spans(data, bounds)
    prefix = PrefixHash(data)
    lead = (data & 0xC0) != 0x80
    space = np.isin(data, np.frombuffer(b" \t\n\v\f\r", np.uint8))
    out = {"n_words": per_text(np.ones(len(text)), text, texts)}
    out["word_chars"] = np.bincount(owner[lead & ~space], minlength=texts)
    out["n_symbols"] = np.bincount(owner[SYMBOL[data]], minlength=texts)
    # Lines that hold a word, keyed by text and content.
    breaks = np.flatnonzero(data == 10)
    line_starts = np.union1d(bounds[:-1][np.diff(bounds) > 0], breaks[breaks + 1 < len(data)] + 1)
    line_ends = np.append(line_starts[1:], len(data))
    line_ends -= (line_ends > line_starts) & (data[line_ends - 1] == 10) if len(line_ends) else 0
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_text = np.searchsorted(bounds, line_starts, "right") - 1
    keys = mix(prefix.of(line_starts, line_ends) + line_text.astype(np.uint64))
    _, first = np.unique(keys, return_index=True)
    out["n_dup_lines"] = np.bincount(line_text, minlength=texts) - np.bincount(line_text[first], minlength=texts)
    # Words inside windows of eight that occur twice or more.
    eight = windows(prefix.of(starts, ends), 8)
    inside = np.flatnonzero(text[: len(eight)] == text[7:]) if len(eight) else np.zeros(0, np.int64)
    keys = mix(eight[inside] + text[inside].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hits = inside[order[twice]]
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, hits, 1)
    np.add.at(cover, hits + 8, -1)
    out["n_repeat_words"] = np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=texts)
    return {k: v.astype(np.int64) for k, v in out.items()}


def window_logs(frequent: HashArrays, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of each text the number of windows, its end included, and over the frequent ones the sum of their negative logs and of
    the squares; and the distinct other windows with their counts.
    """
    data, bounds = padded(data, bounds, ORDER - 1)
    at = np.flatnonzero(inside_texts(bounds, ORDER))
    own = grams(data, ORDER)[at]
    logs = frequent.get(own).astype(np.float64)
    text, texts = np.searchsorted(bounds, at, "right") - 1, len(bounds) - 1
    n = np.bincount(text, minlength=texts)
    rare = np.isnan(logs)
    logs[rare] = 0
    total, squares = np.bincount(text, weights=logs, minlength=texts), np.bincount(text, weights=logs * logs, minlength=texts)
    asked, counts = np.unique(text[rare] << 8 * ORDER | own[rare], return_counts=True)
    ends = np.searchsorted(asked >> 8 * ORDER, np.arange(texts + 1))
    pairs = pa.StructArray.from_arrays([pa.array(asked & ((1 << 8 * ORDER) - 1)), pa.array(counts.astype(np.int64))], names=["gram", "count"])
    return n, total, squares, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pairs)


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_rules(
    docs: DataFrame, band: float = BAND, text: str = "text", lang: str = "lang", carry: list[str] | None = None
) -> DataFrame:
    """``docs`` with the five counts, ``log_perplexity``, ``base_failed`` and ``kept``; ``carry`` names fewer columns to keep.

    A null text has no words. A language's band reaches ``band`` interquartile ranges beyond the quartiles of the
    log-perplexities of its texts that pass the base rules, and two standard errors of the text itself; a null ``lang`` is a language of its own. Rows keep their other
    columns; columns that carry one of the new names are replaced. An empty table gives an empty result.
    """
    frequent, rest = train(docs, text)
    new = [*STATISTICS, "log_perplexity", "base_failed", "kept"]
    names = [c for c in (docs.columns if carry is None else carry) if c not in new]
    source = docs.select(*names, F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            data, bounds = flat(part.column("_text"))
            found = text_statistics(data, bounds)
            *sums, asked = window_logs(frequent, data, bounds)
            columns = [*(pa.array(found[c]) for c in STATISTICS), *map(pa.array, sums), asked]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *columns], names=[*part.schema.names[:-1], *STATISTICS, "_n", "_sum", "_squares", "_asked"]
            )

    made = "_n long, _sum double, _squares double, _asked array<struct<gram: long, count: long>>"
    read = source.mapInArrow(judge, f"{kinds}, {', '.join(f'{c} long' for c in STATISTICS)}, {made}")
    # Written with their numbers, so that answers find their rows.
    read = materialize(read.withColumn("_row", F.monotonically_increasing_id()), "read")
    asked = read.where(F.size("_asked") > 0).select("_row", F.inline("_asked"))
    log = F.col("count") * F.col("log")
    answers = asked.join(rest, "gram").groupBy("_row").agg(F.sum(log).alias("_more"), F.sum(log * F.col("log")).alias("_more_squares"))
    n = F.greatest("_n", F.lit(1))
    mean = (F.col("_sum") + F.coalesce("_more", F.lit(0.0))) / n
    spread = (F.col("_squares") + F.coalesce("_more_squares", F.lit(0.0))) / n - F.col("log_perplexity") * F.col("log_perplexity")
    judged = read.drop("_asked").join(answers, "_row", "left").withColumn("log_perplexity", mean)
    judged = judged.withColumn("_error", F.sqrt(F.greatest(spread, F.lit(0.0)) / n))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = materialize(judged.withColumn("base_failed", failed), "judged")
    quartiles = judged.where(~F.col("base_failed")).groupBy(F.col("_lang").alias("_of")).agg(
        F.percentile_approx("log_perplexity", [0.25, 0.75], 10000).alias("_q")
    )
    low, high = F.col("_q")[0], F.col("_q")[1]
    # A row for each language, written first, so that Spark broadcasts it only after a look at its size.
    width = band * (high - low)
    bands = materialize(quartiles.select("_of", (low - width).alias("_least"), (high + width).alias("_most")), "bands")
    stray = ERRORS * F.col("_error")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("_least") - stray, F.col("_most") + stray), F.lit(False))
    joined = judged.join(bands, F.col("_lang").eqNullSafe(F.col("_of")), "left")
    return joined.select(*names, *STATISTICS, "log_perplexity", "base_failed", (~F.col("base_failed") & inside).alias("kept"))
