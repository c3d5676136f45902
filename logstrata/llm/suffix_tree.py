"""LM scoring: a probabilistic suffix tree over bytes, beside a smoothed unigram base.

The tree learns from the texts marked for it, lower-cased, white space folded to a blank, each between zero bytes. A
context of up to ``DEPTH`` bytes becomes a state if it was seen ``LEAST`` times, however large the corpus, and its next-byte
distribution diverges from that of its suffix by ``DIVERGENCE`` nats or more; suffixes of states are states. A state's
distribution is smoothed with that of its suffix (Witten-Bell), and each byte is scored in the state of the longest
suffix of what precedes it.

Neither the tree nor the token counts of the base gather in one place, as both grow with the corpus: lots of texts send
their distinct tokens and windows of ``DEPTH + 1`` bytes, with counts, to buckets of the hash space, which add up the counts
and answer each lot. Both tests of a context and the smoothing are Spark aggregations and joins over the distinct windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.llm.bytegrams import inside_texts, padded
from logstrata.llm.lots import bucket_count, from_blob, opened, pack
from logstrata.llm.textblocks import LOWER, SPACE, PrefixHash, flat, mix, per_text, release, slices, word_spans
from logstrata.session import materialize

DEPTH = 5
LEAST = 32
DIVERGENCE = 0.01
BUCKET_BYTES = 16 << 20
END = mix(np.zeros(1, np.uint64) + np.uint64(1))[0]
FOLD = np.where(SPACE, np.uint8(32), LOWER)
#: A window has 48 bits; the number of its text in a slice has the other 16.
SLICE_TEXTS = 1 << 16
SLICE_BYTES = 1 << 19
BATCH_ROWS = 2048
#: Lots are written once and sent once more, which is most of the disk.
LOT_LEVEL = 3


def _squeezed(values: np.ndarray) -> bytes:
    """Compressed with bytes of equal weight side by side."""
    width = values.dtype.itemsize
    return pa.compress(values.view(np.uint8).reshape(-1, width).T.tobytes(), codec="zstd", asbytes=True)


def _opened(blob: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    data = pa.decompress(blob, n * width, codec="zstd", asbytes=True)
    return np.frombuffer(data, np.uint8).reshape(width, n).T.copy().view(kind).ravel()


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """For what runs inside, texts go to Python ``BATCH_ROWS`` rows at a time: both sides hold a batch whole."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _freed(result: pa.Table) -> pa.Table:
    """What a function made of a group, all else that it held being handed back before the worker goes on or idles."""
    release()
    return result


def _slices(table: pa.Table, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``SLICE_TEXTS`` texts and ``SLICE_BYTES`` bytes, or one text."""
    for part in slices(table.to_batches(), text, SLICE_BYTES):
        for first in range(0, part.num_rows, SLICE_TEXTS):
            yield part.slice(first, SLICE_TEXTS)


def _windows(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Every byte and end with the ``DEPTH`` bytes before it, and the text number in the lower 16 bits."""
    texts, occurrences = len(bounds) - 1, np.diff(bounds) + 1
    data, bounds = padded(FOLD[data], bounds, DEPTH)
    inside = inside_texts(bounds, DEPTH + 1)
    # All windows are read at once, as overlapping numbers of eight bytes of which the last two make way for the text number.
    wide = np.ndarray(len(inside), ">u8", np.concatenate((data, np.zeros(2, np.uint8))), strides=(1,)).astype(np.uint64)[inside]
    wide &= ~np.uint64(SLICE_TEXTS - 1)
    wide |= np.repeat(np.arange(texts, dtype=np.uint64), occurrences)
    return wide


def _window_runs(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct windows of a slice, where each begins among all of them in that order, and the text number of all."""
    wide = _windows(*flat(part.column(text)))
    wide.sort()
    owner = wide.astype(np.uint16)
    wide >>= np.uint64(16)
    first = np.flatnonzero(np.concatenate(([True], wide[1:] != wide[:-1])))
    return wide[first].view(np.int64), first.astype(np.int32 if len(wide) < 1 << 31 else np.int64), owner


def _distinct(found: list[np.ndarray], kind: type) -> np.ndarray:
    """Sorted distinct values of some arrays."""
    keys = np.concatenate([np.zeros(0, kind), *found])
    keys.sort()
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)]]


def _added(found: list[tuple[np.ndarray, np.ndarray]], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of some arrays, and the sums of their counts."""
    if not found:
        return np.zeros(0, kind), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


def _counted_windows(table: pa.Table, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct windows of a lot and how often its learning texts hold them."""
    found, size, limit = [], 0, 1 << 20
    for part in _slices(table, text):
        keys, first, owner = _window_runs(part, text)
        learn = part.column("_learn").to_numpy(zero_copy_only=False).astype(np.int64)
        found.append((keys, np.add.reduceat(learn[owner], first)))
        size += len(keys)
        if size > limit:
            found = [_added(found, np.int64)]
            size = len(found[0][0])
            limit = max(limit, 2 * size)
    return _added(found, np.int64)


def _bucket_order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of sorted windows bucket by bucket, and where each bucket begins.

    The first four bytes decide: at most 65,536 windows share them, and in a bucket they lie close, so that steps are small.
    """
    bucket = (mix(keys.astype(np.uint64) >> np.uint64(16)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1).astype(np.uint64))


def _settled_windows(asked: pa.Table) -> pa.Table:
    """The distinct windows of a bucket and their counts over all lots."""
    rows = asked.select(["n", "keys", "counts"]).to_pylist()
    keys, back = np.unique(np.concatenate([np.cumsum(_opened(r["keys"], r["n"], np.int64)) for r in rows]), return_inverse=True)
    counts = np.concatenate([_opened(r["counts"], r["n"], np.uint32) for r in rows])
    counts = np.bincount(back, weights=counts, minlength=len(keys)).astype(np.int64)
    bucket = np.full(len(keys), asked.column("bucket")[0].as_py(), np.int64)
    return pa.table({"bucket": bucket, "gram": keys, "n": counts})


def _rounded(logs: np.ndarray) -> np.ndarray:
    """To 16 bits behind the leading one, an error below a 130,000th; the bits left out take no room."""
    bits = logs.astype(np.float32).view(np.uint32)
    return ((bits + np.uint32(1 << 6)) & ~np.uint32((1 << 7) - 1)).view(np.float32)


def _answered_windows(asked: pa.Table, known: pa.Table) -> pa.Table:
    """For each lot that asked a bucket, log10 of the probabilities of its windows' last bytes."""
    keys = known.column("gram").to_numpy()
    order = np.argsort(keys)
    keys, logs = keys[order], _rounded(known.column("log").to_numpy())[order]
    out = []
    for row in asked.select(["n", "keys"]).to_pylist():
        out.append(_squeezed(logs[np.searchsorted(keys, np.cumsum(_opened(row["keys"], row["n"], np.int64)))]))
    return pa.table({"lot": asked.column("lot"), "bucket": asked.column("bucket"), "n": asked.column("n"), "logs": pa.array(out, pa.binary())})


def grow(counts: DataFrame) -> DataFrame:
    """``(bucket, gram, log)``: log10 of the probability of each window's last byte in the state of what precedes it.

    ``counts`` has ``(bucket, gram, n)`` for all windows to score; ``n`` tells how often it was learned, if at all.
    """
    levels = {DEPTH: counts}
    for depth in range(DEPTH - 1, -1, -1):
        mask = (1 << 8 * (depth + 1)) - 1
        shorter = levels[depth + 1].groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("n").alias("n"))
        levels[depth] = materialize(shorter, "contexts")
    sums = {}
    for depth in range(DEPTH + 1):
        grouped = levels[depth].groupBy(F.shiftright("gram", 8).alias("context"))
        sums[depth] = grouped.agg(F.sum("n").alias("all"), F.sum((F.col("n") > 0).cast("long")).alias("kinds"))
    states: dict[int, DataFrame] = {}
    for depth in range(DEPTH, 0, -1):
        own = levels[depth].where("n > 0").select("gram", F.shiftright("gram", 8).alias("context"), "n")
        above = levels[depth - 1].select(F.col("gram").alias("short"), F.col("n").alias("above"))
        sums_above = sums[depth - 1].select(F.col("context").alias("shorter"), F.col("all").alias("all_above"))
        shorter = F.col("context").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1))
        paired = (
            own.join(sums[depth].where(F.col("all") >= LEAST), "context")
            .join(above, F.col("gram").bitwiseAND(F.lit((1 << 8 * depth) - 1)) == F.col("short"))
            .join(sums_above, shorter == F.col("shorter"))
        )
        share, share_above = F.col("n") / F.col("all"), F.col("above") / F.col("all_above")
        diverging = paired.groupBy("context").agg(F.sum(share * F.log(share / share_above)).alias("d")).where(F.col("d") >= DIVERGENCE)
        kept = diverging.select("context")
        if depth < DEPTH:
            kept = kept.union(states[depth + 1].select(F.col("context").bitwiseAND(F.lit((1 << 8 * depth) - 1)))).distinct()
        states[depth] = materialize(kept.join(sums[depth], "context"), "states")
    root = sums[0].first()
    total, kinds = (root["all"], max(root["kinds"], 1)) if root else (0, 1)
    scored = levels[0].select("gram", ((F.col("n") + kinds / 256) / (total + kinds)).alias("p"))
    for depth in range(1, DEPTH + 1):
        below = scored.select(F.col("gram").alias("short"), F.col("p").alias("lower"))
        rows = levels[depth].withColumn("context", F.shiftright("gram", 8)).join(states[depth], "context", "left")
        rows = rows.join(below, F.col("gram").bitwiseAND(F.lit((1 << 8 * depth) - 1)) == F.col("short"))
        smoothed = (F.col("n") + F.col("kinds") * F.col("lower")) / (F.col("all") + F.col("kinds"))
        own = ["bucket"] if depth == DEPTH else []
        scored = rows.select(*own, "gram", F.coalesce(smoothed, F.col("lower")).alias("p"))
    return scored.select("bucket", "gram", F.log10("p").alias("log"))


def _token_runs(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct token hashes of a slice, an end behind each text; which of them every token is, and its text number."""
    data, bounds = flat(part.column(text))
    lower = LOWER[data]
    starts, ends, owner = word_spans(lower, bounds)
    texts = len(bounds) - 1
    hashes = np.concatenate((PrefixHash(lower).of(starts, ends), np.full(texts, END, np.uint64)))
    keys, back = np.unique(hashes, return_inverse=True)
    return keys, back.astype(np.int32 if len(keys) < 1 << 31 else np.int64), np.concatenate((owner, np.arange(texts))).astype(np.uint16)


def _counted_tokens(table: pa.Table, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of a lot and how often its learning texts hold them."""
    found = []
    for part in _slices(table, text):
        keys, back, owner = _token_runs(part, text)
        learn = part.column("_learn").to_numpy(zero_copy_only=False)
        found.append((keys, np.bincount(back, weights=learn[owner], minlength=len(keys)).astype(np.int64)))
    return _added(found, np.uint64)


def score_texts(docs: DataFrame, learn: Column, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Texts where ``learn`` holds (null: not) train both models; all are scored. A null text is empty: one token, its end.
    With nothing to learn from, the base gives probability 1 to everything and the tree 1/256 to each byte. Tokens are told
    apart by a 64-bit hash. Columns of ``docs`` that carry one of the new names are replaced; repeated rows are scored each.
    """
    new = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    names = [c for c in docs.columns if c not in new]
    marked = docs.select(*names, F.col(text).alias("_text"), F.coalesce(learn, F.lit(False)).alias("_learn"))
    with _small_batches(docs.sparkSession):
        lots = pack(marked, "_text", level=LOT_LEVEL)
    buckets = bucket_count(lots, BUCKET_BYTES)
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot, rows in opened(batches):
            keys, counts = _counted_tokens(rows, "_text")
            cuts = np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                span = slice(cuts[b], cuts[b + 1])
                values = [[b], [lot], [keys[span].tobytes()], [_squeezed(counts[span].astype(np.uint32))]]
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["bucket", "lot", "keys", "counts"])

    def settle(asked: pa.Table) -> pa.Table:
        lots_here = asked.column("lot").to_pylist()
        keys = [np.frombuffer(k, np.uint64) for k in asked.column("keys").to_pylist()]
        counts = np.concatenate([_opened(c, len(k), np.uint32) for c, k in zip(asked.column("counts").to_pylist(), keys)])
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(back, weights=counts, minlength=len(distinct)).astype(np.int64)
        answers = np.split(sums[back], np.cumsum([len(k) for k in keys])[:-1])
        rest = [0] * (len(keys) - 1)
        return pa.table(
            {
                "lot": pa.array(lots_here, pa.int64()),
                "bucket": asked.column("bucket"),
                "n": pa.array([len(a) for a in answers], pa.int64()),
                "known": pa.array([_squeezed(a) for a in answers], pa.binary()),
                "tokens": pa.array([int(sums.sum()), *rest], pa.int64()),
                "kinds": pa.array([int((sums > 0).sum()), *rest], pa.int64()),
            }
        )

    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot, rows in opened(batches):
            keys, counts = _counted_windows(rows, "_text")
            order, cuts = _bucket_order(keys, buckets)
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[b] : cuts[b + 1]]
                blobs = _squeezed(np.diff(keys[own], prepend=0)), _squeezed(counts[own].astype(np.uint32))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                values = zip((b, lot, len(own), *blobs), kinds)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in values], names=["bucket", "lot", "n", "keys", "counts"])

    windows = materialize(lots.mapInArrow(ask_windows, "bucket long, lot long, n long, keys binary, counts binary"), "windows")
    counts = windows.groupBy("bucket").applyInArrow(lambda asked: _freed(_settled_windows(asked)), "bucket long, gram long, n long")
    grown = grow(materialize(counts, "contexts"))
    logs = windows.drop("counts").groupBy("bucket").cogroup(grown.groupBy("bucket"))
    logs = logs.applyInArrow(lambda asked, known: _freed(_answered_windows(asked, known)), "lot long, bucket long, n long, logs binary")

    asked = lots.mapInArrow(ask, "bucket long, lot long, keys binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(lambda asked: _freed(settle(asked)), "lot long, bucket long, n long, known binary, tokens long, kinds long")
    answers = materialize(answers, "token-counts")
    totals = answers.agg(F.sum("tokens"), F.sum("kinds")).first()
    tokens, kinds = totals[0] or 0, totals[1] or 0
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields[:-2])
    schema += ", n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def scored(packed: pa.Table, known: pa.Table) -> pa.Table:
        rows = from_blob(packed.column("blob")[0].as_buffer())
        # Tokens are made once; windows, which are more and which one plain sort makes, twice rather than kept.
        parts = [(part, *_token_runs(part, "_text")) for part in _slices(rows, "_text")]
        keys = _distinct([own for _, own, _, _ in parts], np.uint64)
        windows = _distinct([_window_runs(part, "_text")[0] for part, *_ in parts], np.int64)
        known = known.sort_by("bucket")

        def answers(column: str, kind: type) -> np.ndarray:
            own = known.filter(known.column(column).is_valid())
            return np.concatenate([_opened(v, n, kind) for v, n in zip(own.column(column).to_pylist(), own.column("n").to_pylist())])

        counts = answers("known", np.int64)
        logs = np.log10((counts + 1) / (tokens + kinds + 1))
        order, _ = _bucket_order(windows, buckets)
        window_logs = np.zeros(len(windows), np.float32)
        window_logs[order] = answers("logs", np.float32)
        out = []
        for part, own, back, owner in parts:
            texts, at = part.num_rows, np.searchsorted(keys, own)
            own_windows, first, of_text = _window_runs(part, "_text")
            runs = np.diff(first, append=len(of_text))
            score = np.bincount(of_text, weights=np.repeat(window_logs[np.searchsorted(windows, own_windows)], runs), minlength=texts)
            columns = [
                pa.array(per_text(np.ones(len(owner)), owner, texts)),
                pa.array(per_text((counts[at] > 0)[back], owner, texts)),
                pa.array(np.full(texts, tokens, np.int64)),
                pa.array(np.bincount(owner, weights=logs[at][back], minlength=texts)),
                pa.array(score),
            ]
            out.append(pa.RecordBatch.from_arrays([*part.columns[:-2], *columns], names=[*part.schema.names[:-2], *new]))
        return pa.Table.from_batches(out)

    answers = answers.select("lot", "bucket", "n", "known").unionByName(logs, allowMissingColumns=True)
    return lots.groupBy("lot").cogroup(answers.groupBy("lot")).applyInArrow(lambda packed, known: _freed(scored(packed, known)), schema)
