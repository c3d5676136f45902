"""Byte-level BPE encoding and decoding with DuckDB queries inside each partition.

A pre-token that is in the vocabulary is one id. All others become token-position rows: a recursive query joins
neighbours with the merge table and contracts each word's leftmost pair of least rank until no pair is left. Decoding joins
ids with the vocabulary and aggregates the pieces in order. Words met before are remembered, up to a bound.

Words beyond ``LONG`` bytes take the same steps from table to table, as the rows of a recursion add up. One step then
contracts occurrences of the least pair from the left up to the first one whose result forms a pair of lower rank, which
would come next; so the outcome is that of contracting one pair at a time. Words beyond ``ENDLESS`` bytes, whose tables would
not fit, go through a queue of their pairs in that same order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstrata.llm.textblocks import slices

LONG = 256
# Beyond this a word's tables would not fit into the database's memory.
ENDLESS = 1 << 15
DECODED = 1 << 16
REMEMBERED = 400_000
DUCKDB_MEMORY = "256MB"

# A slot is a token's place among all words. A word is done in the turn after its last pair; its rows then leave the recursion.
CONTRACT = """
with recursive step as (
  select word, slot, tok, nxt, false as done from pieces
  union all
  select t.word, t.slot, case when t.slot = best.spot then best.made else t.tok end,
         case when t.slot = best.spot then best.after else t.nxt end, best.word is null
  from (select * from step where not done) t left join (
    select l.word, min((c::bigint << 32) | l.slot) as least, (least & 4294967295)::int as spot, (least >> 32)::int as made,
           arg_min((r.slot::bigint << 32) | (r.nxt + 1), (c::bigint << 32) | l.slot) as other,
           (other >> 32)::int as gone, ((other & 4294967295) - 1)::int as after
    from step l join step r on l.nxt = r.slot join neighbours on pair = (l.tok::bigint << 32) | r.tok
    where not l.done
    group by l.word) best
  on t.word = best.word where t.slot is distinct from best.gone)
select word, list(tok order by slot) as ids from step where done group by word
"""

LONG_PAIRS = """
create or replace temp table pairs as
select *, min(c) over (partition by word) as least from (
  select word, pos, tok, lag(tok) over w as before, lead(tok) over w as nxt, lead(tok, 2) over w as later from long_pieces
  window w as (partition by word order by pos)) p
left join merges on a = tok and b = nxt
"""

LONG_STEP = """
create or replace temp table long_pieces as
with runs as (
  select word, pos, before, later, least, pos - row_number() over (partition by word order by pos) as run from pairs where c = least),
apart as (
  select * from (select *, row_number() over (partition by word, run order by pos) as place from runs) where place % 2 = 1 or run is null),
spots as (
  select word, pos, least, later, case when lag(pos) over (partition by word order by pos) = pos - 2 then least else before end as before
  from apart),
judged as (
  select s.word, s.pos, s.least, coalesce(x.c < s.least, false) or coalesce(y.c < s.least, false) as lower
  from spots s left join merges x on x.a = s.before and x.b = s.least left join merges y on y.a = s.least and y.b = s.later),
taken as (
  select j.word, j.pos, j.least from judged j
  left join (select word, min(pos) as stop from judged where lower group by word) using (word) where stop is null or j.pos <= stop)
select p.word, row_number() over (partition by p.word order by p.pos) - 1 as pos, coalesce(t.least, p.tok) as tok
from pairs p left join taken t on t.word = p.word and t.pos = p.pos
left join taken g on g.word = p.word and g.pos = p.pos - 1
where p.least is not null and g.word is null
"""

# A byte is the letter of its number, so pieces of characters are text too.
DECODE = "select text, array_to_string(list(letters order by pos), '') as letters from ids join vocabulary using (id) group by text"


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by id; the file is bounded by its vocabulary."""
    with open(path, "rb") as lines:
        ranks = {int(number): base64.b64decode(token) for token, number in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ids are not gapless from 0")
    return [ranks[i] for i in range(len(ranks))]


class Coder:
    """Vocabulary and merge table in an in-process database, and the words coded last."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.split = regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        merges = np.array(
            [
                (self.ranks[t[:i]], self.ranks[t[i:]], rank)
                for rank, t in enumerate(tokens)
                for i in range(1, len(t))
                if t[:i] in self.ranks and t[i:] in self.ranks
            ],
            np.int32,
        ).reshape(-1, 3)
        self.base = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": ""})
        self._table("merges", {c: merges[:, i] for i, c in enumerate("abc")})
        self._table("neighbours", {"pair": merges[:, 0].astype(np.int64) << 32 | merges[:, 1], "c": merges[:, 2]})
        self.merges = merges
        self.pairs: dict[int, int] | None = None
        self._table("vocabulary", {"id": np.arange(len(tokens), dtype=np.int32), "letters": [t.decode("latin-1") for t in tokens]})

    def _table(self, name: str, columns: dict) -> None:
        self.base.register("given", pa.table(columns))
        self.base.execute(f"create or replace temp table {name} as select * from given")
        self.base.unregister("given")

    @staticmethod
    def _rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return word, pos.astype(np.int32), lengths

    def contract(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        # Words of about equal length are done in about as many turns.
        short = sorted((i for i, w in enumerate(words) if len(w) <= LONG), key=lambda i: len(words[i]))
        for begin in range(0, len(short), 8192):
            own = short[begin : begin + 8192]
            word, pos, lengths = self._rows([words[i] for i in own])
            slot = word * (2 * LONG) + pos
            nxt = np.where(pos + 1 < np.repeat(lengths, lengths), slot + 1, -1).astype(np.int32)
            tok = self.single[np.frombuffer(b"".join(words[i] for i in own), np.uint8)]
            self.base.register("pieces", pa.table({"word": word, "slot": slot, "tok": tok, "nxt": nxt}))
            self._take(self.base.sql(CONTRACT).to_arrow_table(), own, out)
            self.base.unregister("pieces")
        long = [i for i, w in enumerate(words) if LONG < len(w) <= ENDLESS]
        for i, w in enumerate(words):
            if len(w) > ENDLESS:
                out[i] = self.merge(w)
        if long:
            word, pos, _ = self._rows([words[i] for i in long])
            tok = self.single[np.frombuffer(b"".join(words[i] for i in long), np.uint8)]
            self._table("long_pieces", {"word": word, "pos": pos, "tok": tok})
            while self.base.sql("select count(*) from long_pieces").fetchall()[0][0]:
                self.base.execute(LONG_PAIRS)
                done = "select word, list(tok order by pos) as ids from pairs where least is null group by word"
                self._take(self.base.sql(done).to_arrow_table(), long, out)
                self.base.execute(LONG_STEP)
        return out

    def merge(self, word: bytes) -> bytes:
        """The ids of one word beyond what tables in memory can hold, by a queue of its pairs, at about 60 bytes a byte."""
        if self.pairs is None:
            self.pairs = {int(a) << 32 | int(b): int(c) for a, b, c in self.merges}
        ids = array("i", self.single[np.frombuffer(word, np.uint8)].tobytes())
        n, made = len(ids), self.pairs.get
        right, left = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        queue = [c << 32 | i for i in range(n - 1) if (c := made(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            least = heapq.heappop(queue)
            c, i = least >> 32, least & 0xFFFFFFFF
            j = right[i]
            if ids[i] < 0 or j >= n or made(ids[i] << 32 | ids[j]) != c:
                continue
            ids[i], ids[j] = c, -1
            right[i] = after = right[j]
            if after < n:
                left[after] = i
            for at, other in ((left[i], i), (i, after)):
                if at >= 0 and other < n and (c := made(ids[at] << 32 | ids[other])) is not None:
                    heapq.heappush(queue, c << 32 | at)
        kept = np.frombuffer(ids, np.int32)
        return kept[kept >= 0].astype("<u4").tobytes()

    @staticmethod
    def _take(found: pa.Table, places: list[int], out: list[bytes]) -> None:
        ids = found.column("ids").combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        flat, bounds = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        for k, word in enumerate(found.column("word").to_pylist()):
            out[places[word]] = flat[bounds[k] : bounds[k + 1]].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        words = [self.split(t) for t in texts]
        missing = []
        for w in set().union(*words) - self.young.keys():
            if w in self.old:
                self.young[w] = self.old[w]
            else:
                missing.append(w)
        raw = [w.encode() for w in missing]
        whole = [self.ranks.get(r) for r in raw]
        coded = iter(self.contract([r for r, i in zip(raw, whole) if i is None]))
        for w, i in zip(missing, whole):
            self.young[w] = next(coded) if i is None else i.to_bytes(4, "little")
        return [b"".join(map(self.young.__getitem__, w)) for w in words]

    def decode(self, coded: list[bytes]) -> list[bytes]:
        # A long text is decoded in pieces, each an ordered aggregation of its own.
        pieces = [(t, c[i : i + 4 * DECODED]) for t, c in enumerate(coded) for i in range(0, len(c), 4 * DECODED)]
        found = [""] * len(pieces)
        for begin in range(0, len(pieces), 256):
            some = [c for _, c in pieces[begin : begin + 256]]
            sizes = np.array([len(c) // 4 for c in some])
            text = np.repeat(np.arange(begin, begin + len(some), dtype=np.int32), sizes)
            ids = np.frombuffer(b"".join(some), "<u4").astype(np.int32)
            self.base.register("ids", pa.table({"text": text, "pos": np.arange(len(text), dtype=np.int32), "id": ids}))
            table = self.base.sql(DECODE).to_arrow_table()
            self.base.unregister("ids")
            for t, letters in zip(table.column("text").to_pylist(), table.column("letters").to_pylist()):
                found[t] = letters
        out = [b""] * len(coded)
        for (t, _), letters in zip(pieces, found):
            out[t] += letters.encode("latin-1")
        return out


_coders: dict[str, Coder] = {}


def coder(tokens: list[bytes], pattern: str) -> Coder:
    """One coder for each vocabulary and pattern in a Python worker, which serves many tasks."""
    name = hashlib.sha256(repr((len(tokens), pattern)).encode() + b"\0".join(tokens)).hexdigest()
    if name not in _coders:
        _coders[name] = Coder(tokens, pattern)
    return _coders[name]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", carry: list[str] | None = None, content: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``content``, ``ids`` and ``decoded``.

    ``path`` is a rank file on the driver. Digests are of the ids as little-endian unsigned 32-bit integers and of the bytes
    that the ids decode to. A null text is empty. ``carry`` names fewer columns to keep; columns that carry one of the new
    names are replaced. Empty tables give empty results.
    """
    tokens = read_ranks(path)
    digests = ["n_tokens", "ids_sha256", "decoded_sha256"]
    names = [c for c in (docs.columns if carry is None else carry) if c not in (*digests, "ids", "decoded")]
    source = docs.select(*names, F.col(text).alias("_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    schema += "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if content else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokens, pattern)
        for part in slices(batches, "_text"):
            coded = own.encode([t or "" for t in part.column("_text").to_pylist()])
            decoded = own.decode(coded)
            sizes = np.array([len(c) // 4 for c in coded], np.int64)
            columns = {
                "n_tokens": pa.array(sizes),
                "ids_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
            }
            if content:
                bounds = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                columns |= {"ids": pa.ListArray.from_arrays(bounds, pa.array(ids)), "decoded": pa.array(decoded, pa.binary())}
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns.values()], names=[*part.schema.names[:-1], *columns])

    return source.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the bytes of the ids in order; null ids give no bytes. An unknown id fails."""
    tokens = read_ranks(path)
    source = rows.select(*[c for c in rows.columns if c != "decoded"])
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields) + "decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokens, "")
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                numbers = [np.array(i if i is not None else [], "<u4") for i in part.column(ids).to_pylist()]
                if max((n.max(initial=0) for n in numbers), default=0) >= len(tokens):
                    raise ValueError("id outside the vocabulary")
                decoded = own.decode([n.tobytes() for n in numbers])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], names=[*part.schema.names, "decoded"])

    return source.mapInArrow(run, schema)
