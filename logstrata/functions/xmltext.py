"""XML helpers: entity repair in the JVM, arbitrary-shape conversion over Arrow batches."""

from __future__ import annotations

import json
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed format: an ampersand that does not start one of the XML entities.
BARE_AMP = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)"


def escape_bare_amp(text: Column) -> Column:
    return F.regexp_replace(text, BARE_AMP, "&amp;")


def _put(node: dict, name: str, value) -> None:
    if name not in node:
        node[name] = value
    elif isinstance(node[name], list):
        node[name].append(value)
    else:
        node[name] = [node[name], value]


def document(xml: bytes) -> dict:
    """Nested dict of one XML document.

    Attributes and children share a dict, repeats become lists, text beside
    either is kept under ``#text`` and an empty element is null.
    """
    root: dict = {}
    open_elements: list[tuple[dict, list[str]]] = [(root, [])]

    def start(name, attributes):
        open_elements.append((dict(attributes), []))

    def end(name):
        node, pieces = open_elements.pop()
        text = "".join(pieces).strip() or None
        if node and text:
            _put(node, "#text", text)
        _put(open_elements[-1][0], name, node or text)

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler = start
    parser.EndElementHandler = end
    parser.CharacterDataHandler = lambda data: open_elements[-1][1].append(data)
    parser.Parse(xml, True)
    return root


@F.arrow_udf(StringType())
def xml_to_json(documents: pa.Array) -> pa.Array:
    """JSON text of each XML document, null for a malformed one."""
    out = []
    for xml in documents.to_pylist():
        try:
            out.append(None if xml is None else json.dumps(document(xml)))
        except expat.ExpatError:
            out.append(None)
    return pa.array(out, pa.string())
