"""Log formats as data sources: ``spark.read.format("audit_log").load(path)`` and ``format("event_xml")``.

A reader plans byte ranges of files, so one large file is read by many tasks. A record belongs to the range that its first
byte lies in; a task reads on beyond its range until that record ends. Filters on ``path`` leave out files, and filters on
``record_ref`` leave out ranges before any byte is read; both are then done, others are left to Spark.

The refs, records and field counts are those of the operators on lines and chunks, which run in the JVM and are the faster
way for whole tables. This one needs no framing step and suits lookups by file and ref.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from xml.parsers import expat

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from logstrata.functions.strictjson import pairs
from logstrata.functions.xmltext import document

SCHEMA = "path string, record_ref bigint, record_json string, field_count int"
RANGE_BYTES = 16 << 20
READ_AHEAD = 1 << 16
# What opening a file costs, in bytes read.
OPEN_BYTES = 1 << 18
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

# Fixed formats, as the column functions have them.
AUDIT = re.compile(r"type=(\S+) msg=audit\((.+):(\d+)\)\s*:\s*(.*)\Z", re.S)
PAIR = re.compile(r"""(?<![\w.\-])([\w.\-]+)=("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|\S+)""", re.S)
START = re.compile(rb"<Event[ >]")
CLOSE = b"</Event>"
BARE_AMP = re.compile(rb"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)")


@dataclass
class Range:
    path: str
    start: int
    end: int


@dataclass
class Lot(InputPartition):
    """Ranges that one task reads: a whole one, or those of many small files."""

    ranges: list[Range]


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)


def _unquoted(value: str) -> str:
    return value[1:-1] if len(value) >= 2 and value[0] == value[-1] and value[0] in "\"'" else value


def audit_record(line: str) -> dict | None:
    """Fields of an audit line, the last of a repeated key; None without its prefix."""
    found = AUDIT.match(line)
    if not found:
        return None
    kind, epoch, number, rest = found.groups()
    return {"type": kind, "epoch": epoch, "audit_id": number} | {k: _unquoted(v) for k, v in PAIR.findall(rest)}


def event_record(event: bytes) -> dict | None:
    """Nested record of an event; None for a malformed one."""
    try:
        return document(BARE_AMP.sub(b"&amp;", event))
    except expat.ExpatError:
        return None


class _Bytes:
    """A file from one place on, read as far as it is asked for."""

    def __init__(self, stream, start: int):
        stream.seek(start)
        self.stream, self.start, self.held, self.ended = stream, start, bytearray(), False

    def more(self, size: int = READ_AHEAD) -> bool:
        """Read on; False at the end of the file."""
        if not self.ended:
            piece = self.stream.read(size)
            self.held += piece
            self.ended = not piece
        return not self.ended


def audit_lines(data: _Bytes, end: int, first: bool) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of every line that begins from the start of ``data`` on and before ``end``.

    Unless it is the file's ``first``, the range is read from one byte ahead, so that a line that begins at its edge is seen.
    """
    at = 0
    while not first and (cut := data.held.find(b"\n", at)) < 0:
        at = len(data.held)
        if not data.more():
            return
    at = 0 if first else cut + 1
    while data.start + at < end:
        searched = at
        while (cut := data.held.find(b"\n", searched)) < 0 and data.more():
            searched = max(len(data.held) - READ_AHEAD, at)
        stop = cut if cut >= 0 else len(data.held)
        if at == stop and cut < 0:
            return
        yield data.start + at, bytes(data.held[at:stop])
        if cut < 0:
            return
        at = cut + 1


def event_spans(data: _Bytes, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of every event that begins before ``end`` and closes before another one begins."""
    while data.start + len(data.held) < end + len(b"<Event ") and data.more():
        pass
    found = START.search(data.held)
    while found and data.start + found.start() < end:
        at = found.start()
        searched = at + 1
        while True:
            close, after = data.held.find(CLOSE, searched), START.search(data.held, searched)
            if close >= 0 or after or not data.more():
                break
            # A tag may have been cut by the end of what was read.
            searched = max(len(data.held) - READ_AHEAD - len(CLOSE), at + 1)
        if close >= 0 and (not after or after.start() > close):
            yield data.start + at, bytes(data.held[at : close + len(CLOSE)])
        found = after if after else START.search(data.held, at + 1)


class RangeReader(DataSourceReader):
    """Records of byte ranges."""

    def __init__(self, options: dict, xml: bool):
        # Names of options come in lower case.
        self.root, self.xml = options["path"], xml
        self.size = int(options.get("rangebytes", RANGE_BYTES))
        self.mode = options.get("mode", "failfast")
        if self.mode not in ("failfast", "dropmalformed") or self.size < 1:
            raise ValueError("mode is failfast or dropmalformed, rangeBytes is positive")
        self.paths: set[str] | None = None
        self.low, self.high = 0, 1 << 63

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column, value = getattr(f, "attribute", ()), getattr(f, "value", None)
            if column == ("path",) and isinstance(f, (EqualTo, In)):
                wanted = set(value) if isinstance(f, In) else {value}
                self.paths = wanted if self.paths is None else self.paths & wanted
            elif column == ("record_ref",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, value + (not isinstance(f, LessThan)))
            else:
                yield f

    def partitions(self) -> list[Lot]:
        system, root = _file_system(self.root)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        files = [f for f in found if f.is_file and not f.base_name.startswith(("_", ".")) and (self.paths is None or f.path in self.paths)]
        spans = [(f, at) for f in sorted(files, key=lambda f: f.path) for at in range(0, f.size, self.size)]
        ranges = [Range(f.path, at, min(at + self.size, f.size)) for f, at in spans if at < self.high and at + self.size > self.low]
        lots, held = [], self.size
        for r in ranges:
            cost = r.end - r.start + OPEN_BYTES
            if held + cost > self.size:
                lots.append(Lot([]))
                held = 0
            lots[-1].ranges.append(r)
            held += cost
        return lots

    def read(self, lot: Lot) -> Iterator[tuple]:
        system, _ = _file_system(self.root)
        for partition in lot.ranges:
            yield from self._records(system, partition)

    def _records(self, system: fs.FileSystem, partition: Range) -> Iterator[tuple]:
        with system.open_input_file(partition.path) as stream:
            first = partition.start == 0
            data = _Bytes(stream, partition.start if self.xml or first else partition.start - 1)
            spans = event_spans(data, partition.end) if self.xml else audit_lines(data, partition.end, first)
            for ref, raw in spans:
                if self.low <= ref < self.high and (self.xml or raw.strip(b"\r\n")):
                    record = event_record(raw) if self.xml else self._line(raw)
                    if record is not None:
                        yield partition.path, ref, json.dumps(record), pairs(record)
                    elif not self.xml and self.mode == "failfast":
                        raise ValueError(f"record {ref} of {partition.path} - no audit prefix")

    @staticmethod
    def _line(raw: bytes) -> dict | None:
        try:
            return audit_record(raw.rstrip(b"\r\n").decode())
        except UnicodeDecodeError:
            return None


class AuditLog(DataSource):
    """Audit lines; empty ones are skipped, others without the prefix fail the read or, with ``dropmalformed``, are left out."""

    @classmethod
    def name(cls) -> str:
        return "audit_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RangeReader:
        return RangeReader(dict(self.options), xml=False)


class EventXml(DataSource):
    """Event XML of any shape; truncated and malformed events are left out."""

    @classmethod
    def name(cls) -> str:
        return "event_xml"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RangeReader:
        return RangeReader(dict(self.options), xml=True)


def register(spark: SparkSession) -> None:
    """Make both formats known to a session, and let them take filters."""
    spark.conf.set(PUSHDOWN, "true")
    for source in (AuditLog, EventXml):
        spark.dataSource.register(source)
