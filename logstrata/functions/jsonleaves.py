"""The values of a JSON text by their path, for records of any shape."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

# The types a value can have, one bit each, so that sets of types join by "or".
TYPES = ["null", "boolean", "integer", "double", "string", "array", "object"]
LEAVES = ArrayType(StructType().add("field", StringType()).add("type", IntegerType()).add("value", StringType()))


def type_bit(value) -> int:
    if value is None:
        return 1
    if isinstance(value, bool):
        return 2
    return {int: 4, float: 8, str: 16, list: 32, dict: 64}[type(value)]


_written = json.JSONEncoder(ensure_ascii=False).encode


def walk(record) -> Iterator[tuple[str, int, str | None]]:
    """``(field, type, value)`` of every value below the top, objects and lists included, once for each place; ``a.b[].c`` is a path.

    ``value`` is the JSON text of a scalar and null for the others. No recursion, so depth is bounded by memory alone.
    """
    open_values = [(None, record)]
    while open_values:
        path, at = open_values.pop()
        if path is not None:
            yield path, type_bit(at), None if isinstance(at, (dict, list)) else _written(at)
        if isinstance(at, dict):
            open_values.extend((k if path is None else f"{path}.{k}", v) for k, v in at.items())
        elif isinstance(at, list):
            open_values.extend((f"{path or ''}[]", v) for v in at)


def leaves(record) -> list[dict]:
    """The values that ``walk`` finds, in its order."""
    return [{"field": field, "type": kind, "value": value} for field, kind, value in walk(record)]


@F.arrow_udf(LEAVES)
def json_leaves(texts: pa.Array) -> pa.Array:
    """The values of each text; null for a null and for what is no JSON."""
    found, ends, known = [], [0], []
    for text in texts.to_pylist():
        try:
            found.extend([] if text is None else walk(json.loads(text)))
            known.append(text is not None)
        except (ValueError, RecursionError):
            del found[ends[-1] :]
            known.append(False)
        ends.append(len(found))
    columns = list(zip(*found)) or [()] * 3
    kinds = (pa.string(), pa.int32(), pa.string())
    values = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["field", "type", "value"])
    offsets = pa.array([e if k else None for e, k in zip(ends, [*known, True])], pa.int32())
    return pa.ListArray.from_arrays(offsets, values)
