"""Lots: rows packed into compressed blobs of bounded size, so that a corpus can meet what is known about it.

An operator that needs facts about the whole corpus for each text sends keys from lots to buckets, settles them there,
and sends the answers back to the lots that asked. A key that a third of all texts hold is sent once by each lot.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstrata.llm.textblocks import release, slices
from logstrata.session import materialize

LOT_BYTES = 8 << 20
SCHEMA = "lot long, size long, blob binary"


def pack(docs: DataFrame, text: str, lot_bytes: int = LOT_BYTES, level: int = 1) -> DataFrame:
    """All columns of ``docs`` in lots of at most ``lot_bytes`` of text (or one row), written to the shared folder.

    ``level`` is that of the compression: lots that travel again take less room with a higher one.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held, size, number = [], 0, 0

        def lot():
            blob = to_blob(pa.Table.from_batches(held), level)
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number], pa.int64()), pa.array([size], pa.int64()), pa.array([blob], pa.binary())],
                names=["lot", "size", "blob"],
            )

        for part in slices(batches, text, max(lot_bytes // 8, 1)):
            more = part.column(text).nbytes
            if held and size + more > lot_bytes:
                yield lot()
                held, size, number = [], 0, number + 1
            held.append(part)
            size += more
        if held:
            yield lot()

    return materialize(docs.mapInArrow(packed, SCHEMA), "lots")


def to_blob(table: pa.Table, level: int = 1) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_blob(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all()


def opened(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Lot number and rows, one lot at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("lot")[i].as_py(), from_blob(batch.column("blob")[i].as_buffer())
    release()


def bucket_count(lots: DataFrame, bytes_each: int) -> int:
    """As many buckets as the corpus has shares of ``bytes_each``: it grows with the input."""
    total = lots.agg(F.sum("size")).first()[0] or 0
    return max(1, -(-total // bytes_each))
