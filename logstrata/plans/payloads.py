"""Where the content of a dataset's files comes from, behind one small interface.

``lines``, ``chunks`` and ``texts`` return framed rows for the given ``(path)``
files only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata.operators import classify, formats
from logstrata.operators.framing import with_block
from logstrata.sources import files


class FilePayload:
    """Plain files below a folder."""

    def __init__(self, spark: SparkSession, root, glob: str | None = None):
        self.spark, self.root, self.glob = spark, root, glob

    def _read(self, reader, wanted: DataFrame) -> DataFrame:
        paths = files.named_paths(wanted)
        if paths == []:
            return reader(self.spark, self.root, self.glob).where(F.lit(False))
        if paths is not None:
            return reader(self.spark, paths)
        rows = reader(self.spark, self.root, self.glob)
        return rows.join(wanted.select("path"), "path", "left_semi")

    def lines(self, wanted: DataFrame) -> DataFrame:
        return self._read(files.read_lines, wanted)

    def chunks(self, wanted: DataFrame) -> DataFrame:
        return self._read(files.read_chunks, wanted)

    def texts(self, wanted: DataFrame) -> DataFrame:
        return self._read(files.read_texts, wanted)


class RowPayload:
    """Files held as ``(path, content)`` rows: archive members."""

    def __init__(self, contents: DataFrame):
        self.contents = contents

    def _wanted(self, wanted: DataFrame) -> DataFrame:
        return self.contents.join(wanted.select("path"), "path", "left_semi")

    def lines(self, wanted: DataFrame) -> DataFrame:
        return files.content_lines(self._wanted(wanted))

    def chunks(self, wanted: DataFrame) -> DataFrame:
        return files.content_chunks(self._wanted(wanted))

    def texts(self, wanted: DataFrame) -> DataFrame:
        return self._wanted(wanted).select("path", F.col("content").cast("string").alias("content"))


class EventTablePayload:
    """Decoded Windows events held as ``(path, seq, event)`` rows."""

    def __init__(self, events: DataFrame):
        self.events = events

    def decoded(self, wanted: DataFrame) -> DataFrame:
        return with_block(self.events.join(wanted.select("path"), "path", "left_semi"))


_PARSERS = {
    classify.JSON_LINES: ("lines", formats.json_lines),
    classify.AUDITD: ("lines", formats.auditd),
    classify.ACCESS_LOG: ("lines", formats.grok),
    classify.XML_EVENTS: ("chunks", formats.xml_events),
    classify.JSON_ARRAY: ("texts", formats.json_array),
    classify.EVENTS_WRAPPER: ("texts", formats.events_wrapper),
    classify.WINDOWS_EVENTS: ("decoded", formats.windows_events),
}


def parse_sources(payload, sources: DataFrame, kinds: tuple[str, ...], mode: str = "failfast") -> DataFrame:
    """Records of all ``sources`` ``(path, format)``, whatever their formats."""

    def one(kind: str) -> DataFrame:
        frames, parser = _PARSERS[kind]
        wanted = sources.where(F.col("format") == kind)
        return formats.checked(parser(getattr(payload, frames)(wanted)), mode).select(*formats.RECORD_COLUMNS)

    return reduce(DataFrame.unionByName, [one(k) for k in kinds])
