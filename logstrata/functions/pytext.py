"""Whitespace and naming helpers with the semantics the log formats assume."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace plus the four information separators, which enriched audit
# logs use between fields and which count as blanks when a line is stripped.
SPACE = r"\s\x1c-\x1f"
_STRIP = rf"(?U)\A[{SPACE}]++|[{SPACE}]++\z"
_HAS_TEXT = rf"(?U)[^{SPACE}]"
_HAS_ASCII_TEXT = r"[^ \t\n\x0B\f\r]"


def strip(text: Column) -> Column:
    """Remove surrounding Unicode whitespace."""
    return F.regexp_replace(text, _STRIP, "")


def has_text(text: Column) -> Column:
    """True when anything but Unicode whitespace is present."""
    return text.rlike(_HAS_TEXT)


def has_bytes(text: Column) -> Column:
    """True when anything but ASCII whitespace is present."""
    return text.rlike(_HAS_ASCII_TEXT)


def first_char(text: Column) -> Column:
    """First character that is not whitespace."""
    return F.regexp_extract(text, rf"(?Us)\A[{SPACE}]*+(.)", 1)


def chomp(line: Column) -> Column:
    """Remove trailing carriage returns and newlines."""
    return F.rtrim(line, F.lit("\r\n"))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """File extension with its dot, empty for names such as ``.json`` or ``a``."""
    return F.regexp_extract(basename(path), r"(?s)\A.+(\.[^.]+)\z", 1)


def stem_dir(path: Column) -> Column:
    """Archive path without its last extension: the folder its members live under."""
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]+\z", "")


def relative_to(path: Column, root: str) -> Column:
    """Path below ``root``."""
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.substring(path, len(prefix) + 1, 1 << 30)).otherwise(path)


def shard_name(shard_id: Column) -> Column:
    """``00042.jsonl``; ids beyond five digits are printed whole."""
    digits = shard_id.cast("string")
    return F.concat(F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits), F.lit(".jsonl"))


_SPLIT = "\x01"


def capture(text: Column, regex: str, groups: int) -> Column:
    """All groups of a whole-text match as an array, null without one; unmatched groups are empty.

    One replacement joins the groups with a control character. Text that itself
    contains it is taken apart group by group.
    """
    joined = F.split(F.regexp_replace(text, regex, _SPLIT.join(f"${i}" for i in range(1, groups + 1))), _SPLIT, -1)
    each = F.array(*[F.regexp_extract(text, regex, i) for i in range(1, groups + 1)])
    return F.when(F.contains(text, F.lit(_SPLIT)), F.when(text.rlike(regex), each)).otherwise(
        F.when(text.rlike(regex), joined) if groups == 1 else _sized(joined, groups)
    )


def _sized(parts: Column, groups: int) -> Column:
    return F.get(F.filter(F.array(parts), lambda p: F.size(p) == groups), F.lit(0))
