"""Framing: exact byte offsets of lines, delimited chunks and multi-line CSV rows.

Every input is cut into blocks (``path, block``): the split a reader produced,
or a fixed span of row numbers. Blocks are small whatever the size of a file, so
a single file holding a third of all data still spreads over the cluster: rows
are ordered inside their block, and block totals alone are accumulated per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstrata.functions import pytext
from logstrata.functions.barrier import once
from logstrata.operators.ordering import block_prefix
from logstrata.session import materialize

EVENT_CLOSE = "</Event>"
# Fixed format: the start of an event tag, which takes attributes or ends at once.
EVENT_START = r"<Event[ >]"
BLOCK_ROWS = 8192


def with_block(rows: DataFrame, seq: str = "seq", span: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of consecutive row numbers, for rows that carry their position."""
    return rows.withColumn("block", F.floor(F.col(seq) / F.lit(span)).cast("bigint"))


def byte_offsets(rows: DataFrame, size: Column, separator: int) -> DataFrame:
    """Add ``byte_offset``: the summed ``size`` of all earlier rows of the same path.

    Readers drop a byte order mark. Rows that carry ``file_size`` show it: the
    file is then three bytes longer than its rows, whose last one may or may not
    have been closed by the separator.
    """
    sized = rows.withColumn("_size", size.cast("bigint"))
    on_disk = "file_size" in rows.columns
    known = F.max("file_size") if on_disk else F.lit(None).cast("bigint")
    totals = sized.groupBy("path", "block").agg(F.sum("_size").alias("_total"), known.alias("_file_size"))
    whole = F.sum("_total").over(Window.partitionBy("path")) - F.col("_file_size")
    bases = (
        block_prefix(totals, ["path"], "block", "_total", "_base")
        .withColumn("_lead", F.when(whole.isin(-3, separator - 3), 3).otherwise(0) if on_disk else F.lit(0))
        .select("path", "block", (F.col("_base") + F.col("_lead")).alias("_base"))
    )
    inside = Window.partitionBy("path", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sized.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(bases, ["path", "block"])
        .withColumn("byte_offset", F.col("_base") + F.col("_inside"))
        .drop("_size", "_inside", "_base")
    )


def line_offsets(lines: DataFrame) -> DataFrame:
    """Byte offset of every physical line, blank ones included."""
    return byte_offsets(lines, F.octet_length("line") + 1, 1)


def chunk_offsets(chunks: DataFrame) -> DataFrame:
    """Byte offset of every chunk cut at ``</Event>``, and whether that close was really there."""
    size = F.octet_length("chunk") + len(EVENT_CLOSE)
    placed = byte_offsets(chunks, size, len(EVENT_CLOSE))
    if "terminated" in chunks.columns:
        return placed
    return placed.withColumn("terminated", F.col("byte_offset") + size <= F.col("file_size"))


def _latin(chunk: str) -> Column:
    """One character per byte, so positions are byte positions for any content."""
    return F.decode(F.col(chunk).cast("binary"), "ISO-8859-1")


def xml_event_split(chunks: DataFrame) -> DataFrame:
    """Closed events as ``(path, block, record_ref, event BINARY)``.

    A close belongs to the last start before it; earlier starts in the same
    chunk were cut off, and a chunk without a close holds no event.
    """
    return (
        chunk_offsets(chunks)
        .where("terminated")
        .transform(lambda d: once(d, _latin=_latin("chunk")))
        .where(F.col("_latin").rlike(EVENT_START))
        .withColumn("_lead", F.length(F.regexp_extract("_latin", rf"(?s)\A(.*){EVENT_START}", 1)))
        .select(
            "path",
            "block",
            (F.col("byte_offset") + F.col("_lead")).alias("record_ref"),
            F.concat(
                F.substring(F.col("chunk").cast("binary"), F.col("_lead") + 1, F.octet_length("chunk")),
                F.lit(EVENT_CLOSE).cast("binary"),
            ).alias("event"),
        )
    )


def xml_truncated_events(chunks: DataFrame) -> DataFrame:
    """Refs of event starts that never get a close of their own."""
    mark = len("<Event")
    starts = (
        once(chunk_offsets(chunks), _pieces=F.split(_latin("chunk"), r"<Event(?=[ >])", -1))
        # The first piece precedes any start; the last start of a closed chunk is a whole event.
        .transform(lambda d: once(d, _cut=F.size("_pieces") - F.when(F.col("terminated"), 2).otherwise(1)))
        .where("_cut > 0")
        .select(
            "path",
            "byte_offset",
            "_cut",
            F.posexplode_outer(F.transform("_pieces", lambda p: F.length(p))).alias("_pos", "_len"),
        )
        .where("_pos < _cut")
    )
    upto = Window.partitionBy("path", "byte_offset").orderBy("_pos")
    position = F.sum("_len").over(upto) + F.col("_pos") * mark
    return starts.select("path", (F.col("byte_offset") + position).alias("record_ref"))


# --- CSV rows that may span lines -------------------------------------------------

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_OPEN_TAIL = r'"[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:{_QUOTED}[^,]*+|[^",][^,]*+|),)*+'
_STARTS_OUTSIDE = rf"(?s)\A{_FIELDS}{_OPEN_TAIL}\z"
_STARTS_INSIDE = rf'(?s)\A[^"]*+(?:""[^"]*+)*+(?:"[^,]*+,{_FIELDS}{_OPEN_TAIL})?+\z'


def _quote_steps(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``_flips`` and ``_fixed``, which tell the quote state before a row for either state before them all.

    A row maps the state before it to the state after it (``from_out``, ``from_in``): it keeps, flips or fixes the state. The
    state is that of the last row that fixed it, flipped once per flipping row since.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum(F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0)).over(w), F.lit(0))
    fixes = F.when(F.col("from_out") == F.col("from_in"), F.struct("_flips", F.col("from_out").alias("to")))
    return rows.withColumn("_flips", flips).withColumn("_fixed", F.last(fixes, ignorenulls=True).over(w))


def _open_after(start: Column) -> Column:
    """Is a quoted field open where a row with its steps begins, if ``start`` held before all?"""
    flipped = (F.col("_flips") - F.coalesce(F.col("_fixed._flips"), F.lit(0))) % 2 == 1
    return flipped != F.coalesce(F.col("_fixed.to"), start)


def csv_row_offsets(lines: DataFrame) -> DataFrame:
    """Add ``row_offset`` to every physical line: where the CSV row holding it begins."""
    shaped = (
        line_offsets(lines)
        .withColumn("_bare", pytext.chomp(F.col("line")))
        .withColumn("from_out", F.col("_bare").rlike(_STARTS_OUTSIDE))
        .withColumn("from_in", F.col("_bare").rlike(_STARTS_INSIDE))
        .drop("_bare")
    )
    # Written once: the steps are looked at per block and per line.
    stepped = materialize(_quote_steps(shaped, ["path", "block"], "seq"), "csv_steps")

    def after(start: bool) -> Column:
        return F.when(_open_after(F.lit(start)), F.col("from_in")).otherwise(F.col("from_out"))

    # The state after a block's last line, for either state before its first, is the step of the whole block.
    blocks = stepped.groupBy("path", "block").agg(F.max_by(F.struct(after(False).alias("from_out"), after(True).alias("from_in")), "seq").alias("_step"))
    entry = _quote_steps(blocks.select("path", "block", "_step.from_out", "_step.from_in"), ["path"], "block")
    entry = entry.select("path", "block", _open_after(F.lit(False)).alias("_entry"))
    stated = stepped.join(entry, ["path", "block"]).withColumn("opened", _open_after(F.col("_entry"))).drop("_flips", "_fixed")
    # Written once: the row starts are looked at per block and per line.
    starts = materialize(stated.withColumn("_start", F.when(~F.col("opened"), F.col("byte_offset"))), "csv_lines")
    last = starts.groupBy("path", "block").agg(F.max("_start").alias("_last"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("path", "block", F.max("_last").over(before).alias("_carried"))
    upto = Window.partitionBy("path", "block").orderBy("seq")
    return (
        starts.join(carried, ["path", "block"])
        .withColumn("row_offset", F.coalesce(F.max("_start").over(upto), F.col("_carried")))
        .drop("from_out", "from_in", "_entry", "opened", "_start", "_carried")
    )


# A row of more bytes than this is a problem, not a record: one stray quote would gather the rest of its file.
CSV_ROW_BYTES = 16 << 20


def csv_rows(lines: DataFrame, limit: int = CSV_ROW_BYTES) -> DataFrame:
    """One row per CSV record: ``(path, block, record_ref, text, too_long)``, lines joined again.

    Lines that begin more than ``limit`` bytes after their record are not joined; the record is then ``too_long``.
    """
    near = F.col("byte_offset") - F.col("row_offset") <= limit
    piece = F.when(near, F.struct("byte_offset", "line"))
    rows = (
        csv_row_offsets(lines)
        .groupBy("path", F.col("row_offset").alias("record_ref"))
        .agg(
            F.min("block").alias("block"),
            F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda x: x["line"]), "\n").alias("text"),
            F.bool_or(~near).alias("too_long"),
        )
    )
    return once(rows, record_ref=F.col("record_ref"))
