"""Archives and compressed files made from derived corpora, as input for the archive readers."""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def pack(files: DataFrame) -> DataFrame:
    """``(path, content)`` zip and tar archives from bounded groups of ``(archive, member, content)`` files."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, members in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                out = io.BytesIO()
                if path.endswith(".zip"):
                    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
                        for m in members:
                            zf.writestr(m["member"], m["content"])
                else:
                    with tarfile.open(fileobj=out, mode="w") as tf:
                        for m in members:
                            info = tarfile.TarInfo(m["member"])
                            info.size = len(m["content"])
                            tf.addfile(info, io.BytesIO(m["content"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([out.getvalue()], pa.binary())], names=["path", "content"]
                )

    member = F.struct("member", F.col("content").cast("binary").alias("content"))
    grouped = files.groupBy("archive").agg(F.sort_array(F.collect_list(member)).alias("members"))
    return grouped.mapInArrow(archives, "path string, content binary")


@F.arrow_udf(BinaryType())
def gzipped(contents: pa.Array) -> pa.Array:
    return pa.array([None if c is None else gzip.compress(c, mtime=0) for c in (v.as_buffer() for v in contents)], pa.binary())
