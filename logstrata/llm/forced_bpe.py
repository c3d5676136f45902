"""BPE with word ends, encoded by fragments between forced boundaries.

Each byte of a word is a symbol, its last byte another one. Two symbols that no token of the vocabulary holds next to each
other can never be merged over, so the place between them is a certain cut; behind a last byte there is always one. A stream
of words is cut at all such places by one table lookup a byte. Fragments are encoded on their own, each distinct one once,
and a text's ids are those of its fragments one after another.

The vocabulary, its pattern and its added tokens are read from the tokenizer's file.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstrata.llm.textblocks import slices

REMEMBERED = 200_000
LAST = 256  # a word's last byte is the symbol of the byte plus this


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 stands for itself, the others for letters from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {b: chr(b) for b in own}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(own)))
    return [letters[b] for b in range(256)]


def read_rules(path: str) -> dict:
    """Vocabulary, merges, pattern and added tokens of a tokenizer's file; a ValueError if it asks for another scheme."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    model, steps = given["model"], given["normalizer"].get("normalizers", [])
    pattern = [p["pattern"]["Regex"] for p in given["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split" and p["invert"]]
    suffix = model.get("end_of_word_suffix")
    plain = model["type"] == "BPE" and suffix and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
    plain = plain and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and len(pattern) == 1 and given["decoder"] is None
    if not plain or any(t[k] for t in given["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: not a BPE with word ends, lower case and no decoder")
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return {"vocabulary": model["vocab"], "merges": merges, "suffix": suffix, "pattern": pattern[0], "added": {t["content"]: t["id"] for t in given["added_tokens"]}}


def plain_pattern(pattern: str) -> re.Pattern:
    """A pattern of the ``regex`` library for texts without characters above U+FFFF: its classes are written out, so that Python's
    faster matcher takes it.
    """
    escape = r"\\(?:[pP]\{\^?\w+\}|[sSdDwW])"
    ranges = {}
    for kind in set(re.findall(escape, pattern)):
        # Surrogates are in no text.
        runs = regex.finditer(kind + "+", "".join(chr(c) for c in range(1 << 16) if not 0xD800 <= c < 0xE000))
        ranges[kind] = "".join(f"\\u{ord(r.group()[0]):04x}-\\u{ord(r.group()[-1]):04x}" for r in runs)
    out, inside = [], False
    for part in re.findall(escape + r"|\\.|.", pattern, re.S):
        if part in ranges:
            out.append(ranges[part] if inside else f"[{ranges[part]}]")
        else:
            inside = part == "[" or inside and part != "]"
            out.append(part)
    return re.compile("".join(out))


class Cutter:
    """Which symbols may stand next to each other inside a token, and the merges of what lies between the cuts."""

    def __init__(self, rules: dict):
        self.rules = rules
        letters = byte_letters()
        number = {letter: b for b, letter in enumerate(letters)}
        vocabulary, suffix = rules["vocabulary"], rules["suffix"]
        self.first_id = np.array([vocabulary[x] for x in letters] + [vocabulary[x + suffix] for x in letters], np.int32)
        self.joined = np.zeros((2 * LAST, 2 * LAST), bool)
        for token in vocabulary:
            ends = token.endswith(suffix)
            symbols = [number[x] for x in (token[: -len(suffix)] if ends else token)]
            if ends:
                symbols[-1] += LAST
            for a, b in zip(symbols, symbols[1:]):
                self.joined[a, b] = True
        # Pair of ids -> rank, made id.
        self.rank = {vocabulary[a] << 32 | vocabulary[b]: r for r, (a, b) in enumerate(rules["merges"])}
        self.made = [vocabulary[a + b] for a, b in rules["merges"]]
        self.tokens = {i: t for t, i in (vocabulary | rules["added"]).items()}
        self.split, self.split_any = plain_pattern(rules["pattern"]).findall, regex.compile(rules["pattern"]).findall
        added = sorted(rules["added"], key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        # Ids and tokens of a word.
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}
        self.fragments: dict[bytes, bytes] = {}
        self.seen: set[str] = set()
        self.strange: set[str] = set()
        self.library = None

    def words(self, text: str) -> list[str]:
        """The words of a text without added tokens: composed, in lower case, cut by the pattern."""
        if text.isascii():
            return self.split(text.lower())
        letters = set(text)
        if fresh := letters - self.seen:
            self.seen |= fresh
            self.strange |= {c for c in fresh if unicodedata.category(c) == "Cn"}
        if not self.strange.isdisjoint(letters):
            # Characters newer than this Python's tables: the library's own tables say what they are.
            if self.library is None:
                from tokenizers import Regex, normalizers, pre_tokenizers

                steps = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
                self.library = steps, pre_tokenizers.Split(Regex(self.rules["pattern"]), "removed", invert=True)
            return [w for w, _ in self.library[1].pre_tokenize_str(self.library[0].normalize_str(text))]
        # Letter by letter, so a sigma at a word's end has no form of its own.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # From U+F900 on some letters are composed to ones above U+FFFF.
        return (self.split if max(letters) < "\uf900" else self.split_any)(text)

    def merge(self, fragment: np.ndarray) -> bytes:
        """The ids of one fragment: the pair of least rank first, then the leftmost."""
        ids = array("i", self.first_id[fragment].tobytes())
        n, rank = len(ids), self.rank.get
        right, left = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            r, i = top >> 32, top & 0xFFFFFFFF
            j = right[i]
            if ids[i] < 0 or j >= n or rank(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], ids[j] = self.made[r], -1
            right[i] = after = right[j]
            if after < n:
                left[after] = i
                if (r := rank(ids[i] << 32 | ids[after])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if (before := left[i]) >= 0 and (r := rank(ids[before] << 32 | ids[i])) is not None:
                heapq.heappush(heap, r << 32 | before)
        out = np.frombuffer(ids, np.int32)
        return out[out >= 0].astype("<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, through the fragments of the stream of all of them."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw])
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint16)
        ends = np.cumsum(lengths)
        symbols[ends - 1] += LAST
        cuts = np.flatnonzero(~self.joined[symbols[:-1], symbols[1:]]) + 1
        starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(symbols)]))
        if len(self.fragments) > REMEMBERED:
            self.fragments = {}
        ids, known = [], self.fragments
        for a, b in zip(starts.tolist(), stops.tolist()):
            key = symbols[a:b].tobytes()
            if (own := known.get(key)) is None:
                own = known[key] = self.merge(symbols[a:b])
            ids.append(own)
        first = np.searchsorted(starts, np.concatenate(([0], ends))).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(first, first[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        return [ids for ids, _ in self.code(texts)]

    def code(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """The ids of each text, and the text they decode to."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        parts = [self.added.split(t) if self.added and "<" in t else [t] for t in texts]
        words = [[self.words(p) for p in part[::2]] for part in parts]
        missing = []
        for w in set().union(*(w for part in words for w in part)) - self.young.keys():
            if w in self.old:
                self.young[w] = self.old[w]
            else:
                missing.append(w)
        if missing:
            self.young.update((w, (ids, self.decode(np.frombuffer(ids, "<u4")))) for w, ids in zip(missing, self.encode_words(missing)))
        out, known = [], self.young.__getitem__
        for part, own in zip(parts, words):
            pairs = list(map(known, own[0]))
            for token, more in zip(part[1::2], own[1:]):
                number = self.rules["added"][token]
                pairs.append((number.to_bytes(4, "little"), self.tokens[number]))
                pairs += map(known, more)
            out.append((b"".join([ids for ids, _ in pairs]), " ".join([tokens for _, tokens in pairs])))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The tokens as the vocabulary writes them, with a blank between two: there is no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


_cutters: dict[str, Cutter] = {}


def cutter(rules: dict) -> Cutter:
    """One cutter for each set of rules in a Python worker, which serves many tasks."""
    name = hashlib.sha256(json.dumps(rules).encode()).hexdigest()
    if name not in _cutters:
        _cutters[name] = Cutter(rules)
    return _cutters[name]


def encode(docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None, content: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``content``, ``ids`` and ``decoded``.

    ``path`` is a tokenizer's file on the driver. Digests are of the ids as little-endian unsigned 32-bit integers and of the
    decoded text in UTF-8. Added tokens in a text are those tokens. A null text is empty; an empty one has no ids and decodes
    to nothing. Words of any length are merged in memory of about 60 bytes a byte. ``carry`` names fewer columns to keep;
    columns that carry one of the new names are replaced. Repeated rows are coded each. Empty tables give empty results.
    """
    rules = read_rules(path)
    new = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    names = [c for c in (docs.columns if carry is None else carry) if c not in new]
    source = docs.select(*names, F.col(text).alias("_forced_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    schema += "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if content else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cutter(rules)
        for part in slices(batches, "_forced_text"):
            coded = own.code([t or "" for t in part.column("_forced_text").to_pylist()])
            coded, decoded = ([pair[k] for pair in coded] for k in range(2))
            sizes = np.array([len(c) // 4 for c in coded], np.int64)
            columns = [
                pa.array(sizes),
                pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            ]
            if content:
                bounds = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                columns += [pa.ListArray.from_arrays(bounds, pa.array(ids)), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=[*part.schema.names[:-1], *new[: len(columns)]])

    return source.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the tokens of the ids, blanks between; null ids give an empty text. An unknown id fails."""
    rules = read_rules(path)
    source = rows.select(*[c for c in rows.columns if c != "decoded"])
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields) + "decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cutter(rules)
        for batch in batches:
            decoded = [own.decode(np.array(i if i is not None else [], np.int64)) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], names=[*batch.schema.names, "decoded"])

    return source.mapInArrow(run, schema)
