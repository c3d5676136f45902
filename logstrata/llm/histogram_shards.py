"""Histogram sort: exact splitters of a sorted order by counting bytes, then one exchange.

Rows are ordered by the pair (hash of id and text, hash of text), read as one unsigned 128-bit number, so that a group of
equal texts that holds a third of all rows lies spread over the order. The bytes below candidate boundaries are counted over
all rows; each round splits only the cells that still hold a splitter, 4096 ways, until every splitter is within
``tolerance`` of its target or the whole key is used. Rows that agree in id and text have one key; where they are too many to
lie on one side of a splitter, all rows are numbered in a written table and the number joins the key. No Python runs on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstrata.session import materialize

STEP = 12
# Rows of a shard are put in order by cells of about so many rows, leading bits of the key.
CELL_ROWS = 50_000
MOST_CELL_BITS = 24
_TOP = 1 << 64
_SIGN = -(1 << 63)


def _signed(value: int) -> int:
    return value - _TOP if value >= _TOP >> 1 else value


def _prefix(bits: int) -> list[Column]:
    """The leading ``bits`` of the 128-bit key, as one or two columns."""
    if bits <= 64:
        return [F.shiftrightunsigned("_high", 64 - bits)]
    return [F.col("_high"), F.shiftrightunsigned("_low", 128 - bits)]


def _splitters(keys: DataFrame, total: int, shards: int, tolerance: float) -> tuple[list[int], bool]:
    """Boundaries of the 128-bit key between shards: rows below the i-th hold i/shards of all bytes.

    The second value tells that one key alone keeps a boundary from its target, because many rows share it.
    """
    allowed = tolerance * total / shards
    open_cells = {i: (0, 0, 0) for i in range(1, shards)}  # splitter -> bits, prefix, bytes below the cell
    found: dict[int, int] = {}
    tied = False
    while open_cells:
        by_bits: dict[int, set[int]] = {}
        for bits, prefix, _ in open_cells.values():
            by_bits.setdefault(bits, set()).add(prefix)
        histogram: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        for bits, prefixes in by_bits.items():
            deeper = min(bits + STEP, 64 if bits < 64 else 128)
            rows = keys
            if 0 < bits <= 64:
                rows = rows.where(_prefix(bits)[0].isin([_signed(p) for p in prefixes]))
            elif bits:
                wanted = [(_prefix(bits)[0] == _signed(p >> (bits - 64))) & (_prefix(bits)[1] == p % (1 << (bits - 64))) for p in prefixes]
                rows = rows.where(F.expr("false") if not wanted else _any(wanted))
            parts = _prefix(deeper)
            names = [f"p{k}" for k in range(len(parts))]
            counted = rows.groupBy(*[c.alias(n) for n, c in zip(names, parts)]).agg(
                F.sum("_size").alias("n"), F.min("_high").alias("least"), F.max("_high").alias("most"), F.count(F.lit(1)).alias("rows")
            )
            for r in counted.collect():  # at most 4096 rows for each splitter
                value = r["p0"] % _TOP
                if len(parts) == 2:
                    value = value << (deeper - 64) | (r["p1"] % (1 << (deeper - 64)))
                cell, one_text = value, bits < 64 and r["least"] == r["most"]
                if one_text:
                    cell, depth = r["least"] % _TOP, 64
                else:
                    depth = deeper
                histogram.setdefault((bits, value >> (deeper - bits)), []).append((value, cell, depth, r["n"], r["rows"]))
        for i, (bits, prefix, below) in list(open_cells.items()):
            target, at = total * i / shards, below
            cells = sorted(histogram[bits, prefix])
            for _, cell, depth, n, many in cells:
                if at + n >= target:
                    break
                at += n
            tied |= depth == 128 and many > 1 and min(target - at, at + n - target) > allowed
            if target - at <= allowed or (depth == 128 and target - at <= at + n - target):
                found[i] = cell << (128 - depth)
            elif at + n - target <= allowed or depth == 128:
                found[i] = (cell + 1) << (128 - depth)
            else:
                open_cells[i] = (depth, cell, at)
                continue
            del open_cells[i]
    return [found[i] for i in sorted(found)], tied


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _at_or_above(boundary: int) -> Column:
    """Whether a row's key reaches the boundary, compared without sign."""
    if boundary >= 1 << 128:
        return F.lit(False)
    high, low = _signed((boundary >> 64) ^ (_TOP >> 1)), _signed((boundary % _TOP) ^ (_TOP >> 1))
    own_high, own_low = F.col("_high").bitwiseXOR(F.lit(_SIGN)), F.col("_low").bitwiseXOR(F.lit(_SIGN))
    return (own_high > high) | ((own_high == high) & (own_low >= low))


def _keyed(docs: DataFrame, key: str, text: str, turn: list[str]) -> DataFrame:
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(
        {
            "_size": F.octet_length(content).cast("long") + 1,
            "_crc": F.crc32(content.cast("binary")),
            "_high": F.xxhash64(F.col(key), content, *turn),
            "_low": F.xxhash64(content),
        }
    )


def histogram_shards(docs: DataFrame, shards: int = 8, tolerance: float = 0.0005, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``law`` (always ``bytes``), ``shard`` and ``slot``.

    A row weighs the bytes of its text plus 1; a null text counts as empty. Shards are runs of the sorted order whose sizes
    differ from an equal share by ``tolerance`` of it, or by one row where rows are larger than that. ``slot`` is a row's rank
    in the sorted order of its shard, from 0 without gaps; rows that repeat take neighbouring ranks in any order. Columns
    of ``docs`` that carry one of the new names are replaced. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("size", "text_crc32", "law", "shard", "slot")]
    keyed = _keyed(docs, key, text, [])
    keys = materialize(keyed.select("_size", "_high", "_low"), "shard-keys")
    total, rows = keys.agg(F.sum("_size"), F.count(F.lit(1))).first()
    boundaries, tied = _splitters(keys, total, shards, tolerance) if rows else ([], False)
    if tied:
        # Numbers are read from the written table, so every later reading sees the same.
        keyed = _keyed(materialize(docs.withColumn("_turn", F.monotonically_increasing_id()), "numbered"), key, text, ["_turn"])
        keys = materialize(keyed.select("_size", "_high", "_low"), "shard-keys")
        boundaries, _ = _splitters(keys, total, shards, tolerance)
    bits = min(max((rows // CELL_ROWS).bit_length(), 6), MOST_CELL_BITS)
    cell = F.shiftrightunsigned("_high", 64 - bits)
    shard = F.lit(0)
    for boundary in boundaries:
        shard = shard + _at_or_above(boundary).cast("int")
    counts = keys.groupBy(shard.alias("_to"), cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_to").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_to", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    sharded = keyed.withColumns({"_to": shard, "_cell": cell})
    # Hashes are ordered as unsigned numbers.
    order = [F.col(c).bitwiseXOR(F.lit(_SIGN)) for c in ("_high", "_low")]
    numbered = sharded.withColumn("_rank", F.row_number().over(Window.partitionBy("_to", "_cell").orderBy(*order)))
    placed = numbered.join(starts, ["_to", "_cell"])
    return placed.select(
        *kept,
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_to").cast("int").alias("shard"),
        (F.col("_start") + F.col("_rank") - 1).alias("slot"),
    )
