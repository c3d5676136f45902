"""Windows event log files, decoded by an optional third-party package."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

try:
    from evtx import PyEvtxParser
except ImportError:  # the decoder is optional; tables of decoded events need none
    PyEvtxParser = None


def decode_events(files: DataFrame) -> DataFrame:
    """``(path, seq, event)`` JSON texts of ``(path, content)`` event logs; bad chunks are skipped."""
    if PyEvtxParser is None:
        raise RuntimeError("decoding .evtx files needs the evtx package on every executor")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                entries = PyEvtxParser(io.BytesIO(content.as_py())).records_json()
                texts = [e["data"] for e in entries if isinstance(e, dict)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(texts), pa.string()), pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())],
                    names=["path", "seq", "event"],
                )

    return files.select("path", "content").mapInArrow(decode, "path string, seq bigint, event string")
