"""Event times: the formats of a source put to the vote over its blocks, then one UTC instant a line.

A line may hold several texts that look like a time, and ``03/04/2024`` reads both ways. Every block counts the lines that each
format can read; the sums over a source's blocks rank its formats, and a line is read by the first that fits. Of the two
readings of a numeric date a source uses only the one with more votes. The counts are one narrow row a block, and lines
meet them by ``(path, block)``, so a source that holds a third of all lines spreads like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstrata.functions.barrier import once
from logstrata.session import materialize

# Fixed formats, in the order that settles equal votes.
EPOCH = r"msg=audit\((\d{9,11})(?:\.(\d{1,6}))?:\d+\)"
HTTPDATE = r"\[(\d{1,2})/([A-Z][a-z]{2})/(\d{4}):(\d{2}):(\d{2}):(\d{2}) ([+-])(\d{2})(\d{2})\]"
FILETIME = r"(?:\A|[^\d.])(1[1-9]\d{16})(?:[^\d.]|\z)"
ISO = r"(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2}):(\d{2})(?:[.,](\d{1,9}))?(?:Z|([+-])(\d{2}):?(\d{2}))?"
AUDIT_DATE = r"msg=audit\((\d{1,2})/(\d{1,2})/(\d{4}) (\d{2}):(\d{2}):(\d{2})(?:\.(\d{1,6}))?:\d+\)"
# With the number of groups of each.
FIXED = [(EPOCH, 2), (HTTPDATE, 9), (FILETIME, 1), (ISO, 10), (AUDIT_DATE, 7)]
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
# Ticks of 100 ns between 1601-01-01 and 1970-01-01.
FILETIME_EPOCH = 116_444_736_000_000_000

FORMATS = ["audit_epoch", "httpdate", "filetime", "iso", "month_first", "day_first"]


def _int(text: Column) -> Column:
    return text.cast("int")


def _micros(fraction: Column) -> Column:
    """Digits after the decimal point as microseconds; further digits are cut off."""
    return F.coalesce(F.rpad(F.substring(fraction, 1, 6), 6, "0").try_cast("bigint"), F.lit(0))


def _instant(year: Column, month: Column, day: Column, clock: list[Column]) -> Column:
    """Microseconds since 1970 of a UTC date and time; null if there is no such one."""
    hour, minute, second = map(_int, clock)
    made = F.try_make_timestamp(_int(year), month, _int(day), hour, minute, second.cast("decimal(8,6)"), F.lit("UTC"))
    # A 60th second is not a second of its own here, nor the next minute.
    return F.when(second < 60, F.unix_micros(made))


def _offset(sign: Column, hours: Column, minutes: Column) -> Column:
    away = (_int(hours) * 60 + _int(minutes)).cast("bigint") * 60_000_000
    return F.coalesce(F.when(sign == "-", -away).otherwise(away), F.lit(0))


def matches(text: Column) -> Column:
    """The first match of each fixed format in a text, empty without one."""
    return F.array(*[F.regexp_extract(text, regex, 0) for regex, _ in FIXED])


def match_groups(found: Column) -> Column:
    """The groups of each match, null where there is none. A match is short, so the text itself is searched once a format."""
    held = []
    for i, (regex, n) in enumerate(FIXED):
        match = F.get(found, F.lit(i))
        held.append(F.when(match != "", F.array(*[F.regexp_extract(match, regex, k) for k in range(1, n + 1)])))
    return F.array(*held)


def candidates(groups: Column) -> Column:
    """What each of ``FORMATS`` reads in the groups of the matches, as microseconds since 1970 (UTC) or null."""
    own = [[F.nullif(F.get(F.get(groups, F.lit(i)), F.lit(k)), F.lit("")) for k in range(n)] for i, (_, n) in enumerate(FIXED)]
    seconds, fraction = own[0]
    epoch = seconds.cast("bigint") * 1_000_000 + _micros(fraction)
    day, name, year, *clock, sign, hours, minutes = own[1]
    month = F.array_position(F.array(*map(F.lit, MONTHS)), name).cast("int")
    http = _instant(year, month, day, clock) - _offset(sign, hours, minutes)
    (ticks,) = own[2]
    since = ticks.cast("bigint") - FILETIME_EPOCH
    file = F.call_function("div", since, F.lit(10).cast("bigint"))
    year, month, day, *clock, fraction, sign, hours, minutes = own[3]
    iso = _instant(year, _int(month), day, clock) + _micros(fraction) - _offset(sign, hours, minutes)
    first, second, year, *clock, fraction = own[4]
    dates = [_instant(year, _int(m), d, clock) + _micros(fraction) for m, d in ((first, second), (second, first))]
    return F.array(epoch, http, file, iso, *dates)


def source_formats(read: DataFrame) -> DataFrame:
    """``(path, block, formats)``: the formats of the block's source by falling votes, from lines with their ``_read``."""
    counts = read.groupBy("path", "block").agg(*[F.count(F.col("_read")[i]).alias(f) for i, f in enumerate(FORMATS)])
    whole = Window.partitionBy("path")
    votes = counts.select("path", "block", *[F.sum(f).over(whole).alias(f) for f in FORMATS])
    month_first = F.col("month_first") >= F.col("day_first")
    counted = [
        F.struct((-F.col(f)).alias("less"), F.lit(i).alias("format"))
        for i, f in enumerate(FORMATS[:4])
    ] + [F.struct((-F.greatest("month_first", "day_first")).alias("less"), F.when(month_first, 4).otherwise(5).alias("format"))]
    ranked = F.filter(F.array_sort(F.array(*counted)), lambda c: c["less"] < 0)
    return votes.select("path", "block", F.transform(ranked, lambda c: c["format"]).alias("_formats"))


def event_times(lines: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with ``event_time`` (TIMESTAMP), ``time_format`` and ``time_problem``.

    ``lines`` carries ``path`` (the source) and ``block``. A line that no format of its source reads has no time, and a
    problem that says so; a null line has neither. Zones in the text count; texts without one are UTC. Numeric dates that
    are valid both ways throughout a source are month first.
    """
    found = once(lines, _found=matches(F.col(line)))
    read = once(once(found, _found=match_groups(F.col("_found"))), _read=candidates(F.col("_found"))).drop("_found")
    # Written first, so that Spark sees whether the lines need an exchange to meet them.
    placed = read.join(materialize(source_formats(read), "formats"), ["path", "block"], "left")
    fits = F.filter("_formats", lambda f: F.get("_read", f).isNotNull())
    chosen = placed.withColumn("_format", F.get(fits, F.lit(0)))
    return chosen.select(
        *lines.columns,
        F.timestamp_micros(F.get("_read", "_format")).alias("event_time"),
        F.get(F.array(*map(F.lit, FORMATS)), "_format").alias("time_format"),
        F.when(F.col(line).isNotNull() & F.col("_format").isNull(), F.lit("no time of a known format")).alias("time_problem"),
    )
