"""Key/value extraction for audit records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logstrata.functions.barrier import bound
from logstrata.functions.pytext import SPACE, capture

# Fixed formats: an audit line and its key=value pairs. The timestamp is any
# text, because exporters print it as an epoch or as a date.
AUDIT_PREFIX = rf"(?Us)\Atype=([^{SPACE}]+) msg=audit\((.+):(\p{{Nd}}+)\)[{SPACE}]*:[{SPACE}]*"
_KEY = r"[\p{L}\p{N}_.\-]"
_DOUBLE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SINGLE = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
KV_PAIR = rf"(?Us)(?<!{_KEY}){_KEY}++=(?:{_DOUBLE}|{_SINGLE}|[^{SPACE}]+)"

# A value, or a whole token, with at most one pair of outer quotes.
_OUTER_QUOTES = r"""(?s)\A(?:"(.*)"|'(.*)'|(.*))\z"""
_KEY_AND_QUOTES = r"""(?s)\A[^=]*+=(?:"(.*)"|'(.*)'|(.*))\z"""


def unquote(value: Column) -> Column:
    """Drop one matching pair of outer quotes."""
    return F.regexp_replace(value, _OUTER_QUOTES, "$1$2$3")


def _raw_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(KV_PAIR), F.lit(0))


def kv_tokens(text: Column) -> Column:
    """All ``key=value`` tokens in order, as array<struct<key, value>>, values still quoted."""

    def halves(token: Column) -> Column:
        key = F.substring_index(token, "=", 1)
        return F.struct(key.alias("key"), F.substring(token, F.length(key) + 2, F.length(token)).alias("value"))

    return F.transform(_raw_tokens(text), halves)


def kv_map(text: Column) -> Column:
    """The tokens of a text as a map of unquoted values; the last value of a repeated key wins."""
    return bound(
        _raw_tokens(text),
        lambda tokens: F.map_from_arrays(
            F.transform(tokens, lambda t: F.substring_index(t, "=", 1)),
            F.transform(tokens, lambda t: F.regexp_replace(t, _KEY_AND_QUOTES, "$1$2$3")),
        ),
    )


def audit_parts(line: Column) -> Column:
    """``[type, epoch, audit_id, tail]`` of an audit line, null without its prefix."""
    return capture(line, AUDIT_PREFIX + r"(.*)\z", 4)
