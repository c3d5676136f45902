"""Sessions of a stream, with late rows set aside: the batch operator's result for any order of arrival.

State is kept by source. A source's clock is the latest event time seen before a batch; rows older than that by more than
the allowed delay are late and go to quarantine. All others extend, join or open sessions, which stay open until the clock
says that no row that is still allowed can reach them. A source that goes quiet is closed by a timer on the arrival clock,
the stream's watermark, which also ends the life of all its state. Refs seen already are remembered while their row would be
allowed, so that a batch delivered twice counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from logstrata.operators.timeline import axis

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "source string, kind string, start long, end long, rows long, sum long, ref long"
DAY_MS = 86_400_000
# Rows of a source that are worked on at a time, and refs in one part of its state.
SLAB_ROWS = 1 << 20
PART_REFS = 1 << 16


def merge(sessions: list[tuple], rows: list[tuple], gap: int) -> list[tuple]:
    """Sessions ``(start, end, rows, sum)`` with further ``(at, at, 1, value)``, joined where steps are at most ``gap``."""
    out: list[tuple] = []
    for start, end, n, total in sorted([*sessions, *rows]):
        if out and start - out[-1][1] <= gap:
            last = out[-1]
            out[-1] = (last[0], max(last[1], end), last[2] + n, last[3] + total)
        else:
            out.append((start, end, n, total))
    return out


def collapsed(at: np.ndarray, value: np.ndarray, gap: int) -> list[tuple]:
    """Sessions ``(start, end, rows, sum)`` of rows alone."""
    order = np.argsort(at, kind="stable")
    at, value = at[order], value[order]
    # A step may be longer than a BIGINT holds.
    steps = at[1:].view(np.uint64) - at[:-1].view(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], steps > np.uint64(gap))))
    last = np.concatenate((first[1:], [len(at)])) - 1
    return list(zip(at[first].tolist(), at[last].tolist(), (last - first + 1).tolist(), np.add.reduceat(value, first).tolist()))


def _bounded(at: int) -> np.int64:
    return np.int64(max(at, np.iinfo(np.int64).min))


def _slabs(rows: Iterator[pd.DataFrame]) -> Iterator[list[np.ndarray]]:
    """Refs, times and values of the rows, so many at a time."""
    held, size = [], 0
    for part in rows:
        held.append([part[c].to_numpy(np.int64) for c in ("ref", "at", "value")])
        size += len(part)
        if size >= SLAB_ROWS:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


class SourceSessions(StatefulProcessor):
    """One source: its clock, its open sessions and the refs of rows that could still come again.

    Rows are worked on by slabs, and refs are kept in numbered parts of many, as a call to the state for each row costs
    more than all else.
    """

    def __init__(self, gap: int, delay: int, idle_ms: int):
        self.gap, self.delay, self.idle_ms = gap, delay, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "at long")
        self.open = handle.getListState("open", "start long, end long, rows long, sum long")
        self.seen = handle.getMapState("seen", "part int", "refs binary, ats binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        clock = self.clock.get()[0] if self.clock.exists() else None
        parts = [(part, *(np.frombuffer(v, np.int64) for v in held)) for (part,), held in self.seen.iterator()]
        # Sorted refs with their times, the earlier batches first.
        known = [(refs, ats) for _, refs, ats in parts]
        sessions = [tuple(s) for s in self.open.get()] if self.open.exists() else []
        late, latest = [], clock
        for ref, at, value in _slabs(rows):
            latest = int(at.max()) if latest is None else max(latest, int(at.max()))
            ref, first = np.unique(ref, return_index=True)
            new = np.ones(len(ref), bool)
            for refs, _ in known:
                place = np.minimum(np.searchsorted(refs, ref), len(refs) - 1)
                new &= refs[place] != ref
            ref, at, value = ref[new], at[first[new]], value[first[new]]
            if not len(ref):
                continue
            known.append((ref, at))
            behind = np.zeros(len(ref), bool) if clock is None else at < _bounded(clock - self.delay)
            late += ref[behind].tolist()
            if not behind.all():
                sessions = merge(sessions, collapsed(at[~behind], value[~behind], self.gap), self.gap)
        passed = latest - self.delay
        # A session ends for good when even the oldest row that is still allowed lies beyond its gap.
        closed = [s for s in sessions if s[1] + self.gap < passed]
        left = [s for s in sessions if s[1] + self.gap >= passed]
        self.open.put(left) if left else self.open.clear()
        self.clock.update((latest,))
        self._remember(known, _bounded(passed), len(parts))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + self.idle_ms)
        yield self._rows(key[0], closed, late)

    def _remember(self, known: list[tuple[np.ndarray, np.ndarray]], passed: np.int64, before: int) -> None:
        """Keep the refs of rows from ``passed`` on, sorted, in as many parts as they fill; ``before`` parts were held."""
        refs, ats = (np.concatenate([k[i] for k in known] or [np.zeros(0, np.int64)]) for i in range(2))
        kept = ats >= passed
        order = np.argsort(refs[kept])
        refs, ats = refs[kept][order], ats[kept][order]
        parts = -(-len(refs) // PART_REFS)
        for n in range(parts):
            span = slice(n * PART_REFS, (n + 1) * PART_REFS)
            self.seen.updateValue((n,), (refs[span].tobytes(), ats[span].tobytes()))
        for n in range(parts, before):
            self.seen.removeKey((n,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = [tuple(s) for s in self.open.get()] if self.open.exists() else []
        for state in (self.clock, self.open, self.seen):
            state.clear()
        yield self._rows(key[0], closed, [])

    def close(self) -> None:
        pass

    @staticmethod
    def _rows(source: str, closed: list[tuple], late: list[int]) -> pd.DataFrame:
        out = [(source, "session", *s, None) for s in closed] + [(source, "late", None, None, None, None, ref) for ref in late]
        return pd.DataFrame(out, columns=[c.split()[0] for c in OUTPUT.split(", ")]).astype(dict.fromkeys(["start", "end", "rows", "sum", "ref"], "Int64"))


def session_stream(
    rows: DataFrame, source: str, at: str, ref: str, value: str, arrived: str, gap: int, delay: int, idle_ms: int = DAY_MS
) -> DataFrame:
    """``(source, kind, start, end, rows, sum, ref)``: the closed sessions and the refs of the late rows of a stream.

    ``at`` is the event time (BIGINT or TIMESTAMP, as ``gap`` and ``delay`` count it), ``ref`` a BIGINT that is unique within its
    source, ``arrived`` a TIMESTAMP that grows from batch to batch. A source is closed when the arrival clock is ``idle_ms``
    beyond its last batch. Rows without a source, time or ref are left out; a null value adds nothing.
    """
    rows.sparkSession.conf.set(PROVIDER, ROCKS)
    own = rows.select(
        F.col(source).alias("source"), axis(rows, at).alias("at"), F.col(ref).cast("bigint").alias("ref"),
        F.coalesce(F.col(value).cast("bigint"), F.lit(0)).alias("value"), F.col(arrived).alias("arrived"),
    )
    own = own.where("source is not null and at is not null and ref is not null").withWatermark("arrived", "0 seconds")
    return own.groupBy("source").transformWithStateInPandas(SourceSessions(gap, delay, idle_ms), OUTPUT, "append", "eventTime")


def start_sessions(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what is closed or late to a table; handles what has arrived and stops."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replay(spark: SparkSession, batches: list[DataFrame], folder: str, **options) -> DataFrame:
    """What a stream makes of batches that arrive one after another, and of the quiet after them.

    A batch has the columns ``source, at, ref, value``; it is written below ``folder`` and handled before the next one is.
    """
    schema = "source string, at long, ref long, value long, arrived timestamp"
    hour = 3_600
    last = len(batches) * hour + 2 * options.get("idle_ms", DAY_MS) // 1000
    # A row without a source moves the arrival clock only; it comes twice, as timers follow the clock by one batch.
    quiet = [spark.createDataFrame([("", 0, n, 0)], "source string, at long, ref long, value long") for n in range(2)]
    for n, batch in enumerate([*batches, *quiet]):
        when = (n + 1) * hour if n < len(batches) else last + n
        batch.withColumn("arrived", F.timestamp_seconds(F.lit(when))).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        made = session_stream(stream, "source", "at", "ref", "value", "arrived", **options)
        start_sessions(made, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(OUTPUT).parquet(f"{folder}/out").where("source <> ''")
