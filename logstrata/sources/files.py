"""Raw files as framed rows, whole texts or checksummed entries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.functions import pytext
from logstrata.functions.barrier import once
from logstrata.operators.framing import BLOCK_ROWS, EVENT_CLOSE

# A row holds at most 2 GB; larger files are hashed as a stream.
WHOLE_FILE_LIMIT = 1 << 30
# Up to this many paths are handed to a reader by name, so nothing else is
# scanned; beyond it the whole place is scanned and joined.
NAMED_PATHS = 100_000
# A writer's option: tasks put their files in place themselves, instead of the driver moving all of them one by one at the end.
# For folders that nobody reads before the write is over.
COMMIT_BY_TASKS = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


def literal(path: str) -> str:
    """Escape what a path reader would take for a wildcard."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def named_paths(wanted: DataFrame) -> list[str] | None:
    """The paths of a ``(path)`` table for a reader, or None when there are too many to name."""
    paths = [r["path"] for r in wanted.select("path").take(NAMED_PATHS + 1)]
    return [literal(p) for p in dict.fromkeys(paths)] if len(paths) <= NAMED_PATHS else None


def clean_path(path: Column) -> Column:
    """A file's path as written on disk: no scheme, no URL escapes."""
    plain = F.regexp_replace(path, r"\A[a-z][a-z0-9+.-]*:(?://(?=/)|(?=/))", "")
    return F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))


def _path() -> Column:
    return clean_path(F.col("_metadata.file_path")).alias("path")


def _reader(spark: SparkSession, glob: str | None = None):
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", glob) if glob else reader


def _framed(spark: SparkSession, paths, separator: str, name: str, glob: str | None) -> DataFrame:
    return (
        _reader(spark, glob)
        .option("lineSep", separator)
        .text(paths)
        .select(
            _path(),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            F.col("value").alias(name),
            F.col("_metadata.file_size").alias("file_size"),
        )
    )


def read_lines(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """``(path, block, seq, line, file_size)``: one row per physical line, split-parallel."""
    return _framed(spark, paths, "\n", "line", glob)


def read_chunks(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """``(path, block, seq, chunk, file_size)``: text between event closes, split-parallel."""
    return _framed(spark, paths, EVENT_CLOSE, "chunk", glob)


def read_texts(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """``(path, content)``: one row per document; compressed files are read as plain text."""
    return _reader(spark, glob).text(paths, wholetext=True).select(_path(), F.col("value").alias("content"))


def list_files(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """``(path, bytes)`` without reading any content."""
    files = _reader(spark, glob).format("binaryFile").load(paths)
    return files.select(_path(), F.col("length").alias("bytes"))


def read_contents(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """``(path, bytes, content BINARY)``."""
    files = _reader(spark, glob).format("binaryFile").load(paths)
    return files.select(_path(), F.col("length").alias("bytes"), "content")


def file_checksum(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def checksums(
    spark: SparkSession, paths, glob: str | None = None, limit: int = WHOLE_FILE_LIMIT, wanted: DataFrame | None = None
) -> DataFrame:
    """``(path, bytes, checksum_sha256)`` of every file, or of the ``wanted`` ``(path)`` only."""
    if wanted is not None:
        listed = named_paths(wanted)
        if listed == []:
            return spark.createDataFrame([], "path string, bytes bigint, checksum_sha256 string")
        if listed is None:
            return checksums(spark, paths, glob, limit).join(wanted.select("path"), "path", "left_semi")
        paths, glob = listed, None
    files = _reader(spark, glob).format("binaryFile").load(paths).withColumn("bytes", F.col("length"))
    small = files.where(F.col("bytes") <= limit).select(
        _path(), "bytes", file_checksum(F.col("content")).alias("checksum_sha256")
    )
    large = list_files(spark, paths, glob).where(F.col("bytes") > limit)
    listed = named_paths(large)
    if listed == []:
        return small
    lines = read_lines(spark, paths if listed is None else listed, glob if listed is None else None)
    streamed = stream_checksums(lines.where(F.col("file_size") > limit)).select("path", "checksum_sha256")
    return small.unionByName(large.join(streamed, "path"))


def stream_checksums(lines: DataFrame) -> DataFrame:
    """Checksum of files too large for one row.

    A digest is sequential, so a file's lines pass through one task in order, as
    a sorted stream that is never held in memory.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, size, done = None, 0, 0
        digest = hashlib.sha256()

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([digest.hexdigest()])], names=["path", "checksum_sha256"]
            )

        for batch in batches:
            for p, file_size, total, line in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if p != path:
                    if path is not None:
                        yield close()
                    path, size, done = p, file_size, 0
                    digest = hashlib.sha256()
                    if total - file_size in (-3, -2):
                        digest.update(b"\xef\xbb\xbf")
                        done = 3
                piece = (line + b"\n")[: size - done]
                digest.update(piece)
                done += len(piece)
        if path is not None:
            yield close()

    totals = lines.groupBy("path").agg(F.sum(F.octet_length("line") + 1).alias("total"))
    return (
        lines.join(totals, "path")
        .repartition("path")
        .sortWithinPartitions("path", "block", "seq")
        .select("path", "file_size", "total", F.col("line").cast("binary").alias("line"))
        .mapInArrow(digests, "path string, checksum_sha256 string")
    )


# --- files that already are rows ---------------------------------------------------


def content_lines(files: DataFrame) -> DataFrame:
    """Lines of files held as ``(path, content)`` rows, such as archive members."""
    pieces = F.split(F.col("content").cast("string"), "\n", -1)
    return _pieces(files, pieces, "line").where(~F.col("_tail") | (F.col("line") != "")).drop("_tail")


def content_chunks(files: DataFrame) -> DataFrame:
    """Text between event closes of files held as rows; the last piece has no close."""
    pieces = F.split(F.col("content").cast("string"), EVENT_CLOSE, -1)
    chunks = _pieces(files, pieces, "chunk")
    return chunks.withColumn("terminated", ~F.col("_tail")).drop("_tail")


def _pieces(files: DataFrame, pieces: Column, name: str) -> DataFrame:
    # The count is fixed before the pieces are spread, so that rows do not carry the whole list along.
    split = once(files.select("path", "content"), _pieces=pieces).drop("content")
    counted = once(split, _count=F.size("_pieces"))
    return counted.select("path", "_count", F.posexplode_outer("_pieces").alias("seq", name)).select(
        "path",
        # A member that holds a third of all lines is then worked on in as many places as it has blocks.
        F.floor(F.col("seq") / BLOCK_ROWS).cast("bigint").alias("block"),
        F.col("seq").cast("bigint").alias("seq"),
        name,
        (F.col("seq") == F.col("_count") - 1).alias("_tail"),
    )


def relative_names(files: DataFrame, root: str) -> DataFrame:
    """Add ``file_name``: the path below the dataset's root."""
    return files.withColumn("file_name", pytext.relative_to(F.col("path"), root))
