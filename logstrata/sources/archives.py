"""Members of zip and tar archives held as rows."""

from __future__ import annotations

import gzip
import io
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# At least one real data file by name, which is all that can be told of an
# encrypted archive; the same rule as classify.archive_candidates.
HAS_DATA_FILE = r"(?!(?:.*/)?__MACOSX/)(?:.*/)?(?!\._)[^/]*\.(?:json|log)"


def _clean(name: str) -> str:
    """Member path without parts that would leave the archive's folder."""
    return "/".join(p for p in name.split("/") if p not in ("", ".", ".."))


def _opened(archive: str, content: bytes):
    """``[(name, read)]`` of the regular files in an archive."""
    if archive.endswith(".zip"):
        zf = zipfile.ZipFile(io.BytesIO(content))
        return [(i.filename, lambda i=i: zf.read(i)) for i in zf.infolist() if not i.is_dir()]
    tf = tarfile.open(fileobj=io.BytesIO(content))
    return [(m.name, lambda m=m: tf.extractfile(m).read()) for m in tf.getmembers() if m.isfile()]


def member_names(archives: DataFrame) -> DataFrame:
    """``(archive, member)`` of ``(path, content)`` archives; nothing is decompressed."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = [name for name, _ in _opened(path, content.as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found), pa.string()), pa.array(found, pa.string())],
                    names=["archive", "member"],
                )

    return archives.select("path", "content").mapInArrow(names, "archive string, member string")


def archive_members(
    archives: DataFrame, wanted: str | None = None, opened_if: str | None = None, gunzip: bool = False
) -> DataFrame:
    """``(archive, member, content)``, one archive per row in, one member per row out.

    ``wanted`` limits the members by name; an archive is opened only when a name
    matches ``opened_if``; ``gunzip`` unpacks ``.gz`` members and drops that suffix.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                files = _opened(path, content.as_py())
                if opened_if and not any(re.fullmatch(opened_if, name) for name, _ in files):
                    continue
                for name, read in files:
                    if wanted and not re.fullmatch(wanted, name):
                        continue
                    data = read()
                    if gunzip and name.endswith(".gz"):
                        name, data = name[: -len(".gz")], gzip.decompress(data)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([_clean(name)]), pa.array([data], pa.binary())],
                        names=["archive", "member", "content"],
                    )

    return archives.select("path", "content").mapInArrow(members, "archive string, member string, content binary")


def gz_members(files: DataFrame) -> DataFrame:
    """``(path, content)`` files with gzip content, unpacked, without their ``.gz`` suffix."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = None if not content.is_valid else gzip.decompress(content.as_buffer())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.removesuffix(".gz")]), pa.array([data], pa.binary())],
                    names=["path", "content"],
                )

    return files.select("path", "content").mapInArrow(unpack, "path string, content binary")
