"""Strict JSON checks, field counts and canonical layout.

Spark's parser does the work; only long texts that it refuses go to ``strictjson``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata.functions import strictjson
from logstrata.functions.barrier import bound, once

# Possessive quantifiers keep the matcher iterative, so very long strings are safe.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_MARK = "\x01"


def _finite(text: Column) -> Column:
    """Text with bare NaN and Infinity replaced by a number: log writers emit them, Spark rejects them."""
    marked = F.regexp_replace(text, rf"(?s)({_STRING})|-?(?:NaN|Infinity)", "$1" + _MARK)
    plain = F.regexp_replace(F.regexp_replace(marked, '"' + _MARK, '"'), _MARK, " 0 ")
    return F.when(F.contains(text, F.lit("NaN")) | F.contains(text, F.lit("Infinity")), plain).otherwise(text)


# What a JSON value can start with; a word must be the whole text.
_START = r"\A[ \t\r\n]*+(?:[\[{\"\-0-9]|(?:true|false|null|NaN|Infinity)[ \t\r\n]*+\z)"


def guarded(text: Column) -> Column:
    """Variant ``[value, guard]`` of a JSON text, null when it does not parse.

    Spark's parser ignores what follows a complete value, and text may close the
    list early. The guard is a digest of the text, which the text cannot hold, so
    finding it in second place proves that the text is exactly one value.
    """
    wrapped = F.concat(F.lit("["), _finite(text), F.lit(',"'), _guard(text), F.lit('"]'))
    return F.when(text.rlike(_START), F.try_parse_json(wrapped))


def _guard(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def is_guarded(variant: Column, text: Column) -> Column:
    """Does the ``guarded`` variant of a text prove it to be one JSON value?"""
    return F.coalesce(F.try_variant_get(variant, "$[1]", "string") == _guard(text), F.lit(False))


def is_parsed(text: Column) -> Column:
    """True when Spark's parser, with its limits, takes the whole text for one JSON value."""
    return is_guarded(guarded(text), text)


def is_json(text: Column) -> Column:
    """True when the whole text is exactly one JSON value, however long."""
    return strictjson.judged(F.when(is_parsed(text), 0), text).isNotNull()


def is_object(text: Column) -> Column:
    """For a valid JSON text: is it an object?"""
    return text.rlike(r"\A[ \t\r\n]*+\{")


def text_fields(canonical: Column) -> Column:
    """Key/value pairs at any depth of a JSON text without repeated keys; 0 for scalars.

    With every string blanked out, each remaining colon belongs to exactly one pair.
    """
    bare = F.regexp_replace(canonical, _STRING, "")
    return F.regexp_count(bare, F.lit(":"))


def variant_fields(variant: Column) -> Column:
    """Key/value pairs of a variant; writing it as text leaves one of each repeated key."""
    return text_fields(F.to_json(variant))


def count_fields(text: Column) -> Column:
    """Key/value pairs at any depth of a JSON text; 0 for scalars and for what is no JSON."""
    parsed = variant_fields(F.when(text.rlike(_START), F.try_parse_json(_finite(text))))
    return F.coalesce(strictjson.judged(parsed, text), F.lit(0)).cast("int")


def _escaped(text: Column) -> Column:
    """Everything beyond ASCII as escaped UTF-16 code units, one pass per distinct character."""

    def escape(ch: Column) -> Column:
        units = F.lower(F.hex(F.encode(ch, "UTF-16BE")))
        return F.regexp_replace(units, "(.{4})", r"\\u$1")

    foreign = F.array_distinct(F.regexp_extract_all(text, F.lit(r"[^\x00-\x7F]"), F.lit(0)))
    return F.aggregate(foreign, text, lambda done, ch: F.replace(done, ch, escape(ch)))


def record_to_json(text: Column) -> Column:
    """Shard layout of a JSON text: ``", "`` and ``": "`` separators, ASCII only, key order kept."""
    # One pass marks the end of every string, separator and blank; a mark cannot occur in valid JSON.
    spaced = F.regexp_replace(text, rf"(?s)({_STRING})|([,:])|[ \t\r\n]++", "$1$2" + _MARK)
    for found, written in (('"' + _MARK, '"'), ("," + _MARK, ", "), (":" + _MARK, ": "), (_MARK, "")):
        spaced = F.replace(spaced, F.lit(found), F.lit(written))
    return F.when(F.octet_length(text) == F.length(text), spaced).otherwise(bound(spaced, _escaped))


def quote(text: Column) -> Column:
    """A string as a JSON string token."""
    wrapped = F.to_json(F.array(text))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def element_text(raw: Column, typed: Column) -> Column:
    """JSON text of a nested value from its two readings.

    ``raw`` (read as string) keeps the key order but loses string quotes;
    ``typed`` (a variant written as text) keeps the type but sorts the keys.
    """
    return F.when(F.startswith(typed, F.lit('"')), typed).otherwise(F.coalesce(raw, F.lit("null")))


def elements(document: Column, key: str) -> Column:
    """The list under ``key`` as array<struct<text, typed>>, null if the parser finds none."""
    raw = F.from_json(document, f"`{key}` array<string>")[key]
    typed = F.from_json(document, f"`{key}` array<variant>")[key]
    typed = F.transform(typed, lambda v: F.to_json(v))
    pairs = F.transform(
        F.arrays_zip(raw.alias("r"), typed.alias("t")),
        lambda x: F.struct(element_text(x["r"], x["t"]).alias("text"), x["t"].alias("typed")),
    )
    return F.when(is_parsed(document), pairs)


def listed(documents: DataFrame, key: str) -> DataFrame:
    """Add ``elements``: the list under ``key`` of each ``content``, null if there is none."""
    text = F.col("content")
    found = once(documents, _found=elements(text, key))
    late = strictjson.records(strictjson.refused(F.col("_found"), text))
    return once(found, elements=F.coalesce("_found", late)).drop("_found")


def listed_events(documents: DataFrame) -> DataFrame:
    """Add ``elements``: the records of the usable events of each ``content``, null if it lists none.

    A document goes to Python as a whole when the parser finds no list in it, or
    nothing in an event that is long enough to exceed a limit.
    """
    text = F.col("content")
    found = once(documents, _found=elements(text, "events"))
    objects = F.filter("_found", lambda e: F.startswith(e["typed"], F.lit("{")))
    records = F.transform(objects, lambda e: F.struct(normalize_object(e["text"]).alias("text"), F.octet_length(e["text"]).alias("size")))
    read = once(found, _records=records).drop("_found")
    doubtful = F.exists("_records", lambda r: r["text"].isNull() & (r["size"] > strictjson.PARSED_BYTES))
    kept = F.transform(
        F.filter("_records", lambda r: r["text"].isNotNull()),
        lambda r: F.struct(r["text"].alias("text"), F.to_json(F.try_parse_json(r["text"])).alias("typed")),
    )
    sure = once(read, _kept=F.when(~doubtful, kept)).drop("_records")
    late = strictjson.event_records(strictjson.refused(F.col("_kept"), text))
    return once(sure, elements=F.coalesce("_kept", late)).drop("_kept")


WRAPPER_KEYS = strictjson.WRAPPER_KEYS


def _rebuilt(raw: Column, typed: Column) -> Column:
    """JSON text of the pairs of a map of variants, nested values as they were written."""
    pairs = F.transform(
        F.map_keys(typed),
        lambda k: F.concat(quote(k), F.lit(":"), element_text(F.element_at(raw, k), F.to_json(F.element_at(typed, k)))),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def normalize_object(event: Column) -> Column:
    """``normalize_event`` of a text known to be a JSON object."""
    dropped = list(WRAPPER_KEYS)
    read = F.struct(
        F.from_json(event, "map<string,string>").alias("raw"),
        F.map_filter(F.from_json(event, "map<string,variant>"), lambda k, _: ~k.isin(dropped)).alias("typed"),
    )

    def kept(x: Column) -> Column:
        # A string value reads as its decoded text, an object as its JSON text.
        only = F.element_at(x["raw"], F.get(F.map_keys(x["typed"]), F.lit(0)))
        unwrapped = bound(only, lambda t: F.when(is_object(t), F.when(is_parsed(t), t)))
        return F.when(F.size(x["typed"]) == 1, unwrapped).when(F.size(x["typed"]) > 1, _rebuilt(x["raw"], x["typed"]))

    return bound(read, kept)


def normalize_event(event: Column) -> Column:
    """Record text of one wrapped event, or null when the parser leaves nothing usable.

    Wrapper keys go; several remaining keys are kept as they are; a single one
    is unwrapped, decoding a JSON string, and must be an object.
    """
    return F.when(is_object(event), F.when(is_parsed(event), normalize_object(event)))


def normalized_events(rows: DataFrame, event: str) -> DataFrame:
    """Add ``record_json``: ``normalize_event`` of events of any length."""
    read = once(rows, _read=normalize_event(F.col(event)))
    late = strictjson.event_record(strictjson.refused(F.col("_read"), F.col(event)))
    return read.withColumn("record_json", F.coalesce("_read", late)).drop("_read")
