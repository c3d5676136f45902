"""Benchmark decontamination: random-walk embedding, bit-sampling LSH and exact edit verification.

Texts are lower-cased runs of letters and digits, one blank between them. Windows start at bytes whose next ``LEAD`` bytes
hash to a share of 1 in ``SPREAD``, which a copy of an item repeats wherever it lies, in any script. From such a byte a random
walk reads ``STEPS`` characters: at each step a random function of step and character decides whether to move on, so that
strings at a small edit distance soon walk in step. Each table has a walk, a sample of ``BITS`` of its steps and starts of its
own; windows that agree with an item in one sample are candidates.

Items are taken in classes of doubling size. Copies of a class's items are edited at random as far as allowed, and tables are
added until the share of copies found reaches ``TARGET``. A class that ``MOST_TABLES`` do not bring there, items without a
window and items below ``SHORT`` bytes are found without loss: of one piece more than the allowed edits, one is left as it is.

A candidate's part of the item, at most 64 bytes around the window, must lie in the text at a fitting edit distance; what is
left is verified by the exact edit distance between the item and the best part of the text, stretched by the allowed edits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstrata.llm.license_scan import FOLD
from logstrata.llm.textblocks import flat, mix, slices

PERCENT = 80
TARGET = 0.98
TRIALS = 1000
MOST_TABLES = 32
SPREAD = 4
LEAD = 3
STEPS = 24
BITS = 16
SHORTEST = 8
SHORT = 32
# A part of this many bytes fits one machine word; parts of an item start so many bytes apart.
PART, STRIDE = 64, 32
BLOCK_BYTES = 8 << 20


def normalised(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes with one blank behind each word, their bounds, and where each byte was."""
    folded = FOLD[data]
    word = folded != 32
    behind = np.concatenate(([False], word[:-1])) if len(word) else word
    behind[bounds[:-1][bounds[:-1] < len(word)]] = False
    kept = np.flatnonzero(word | behind)
    return folded[kept], np.searchsorted(kept, bounds), kept


class Walk:
    """A seeded walk over ``STEPS`` steps from its own share of the starts, and the key of its sample."""

    def __init__(self, seed: int):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.moves = draw.integers(0, 2, (STEPS, 256), dtype=np.uint8)
        self.sample = np.zeros(STEPS, bool)
        self.sample[draw.choice(STEPS, BITS, replace=False)] = True
        self.salt = np.uint64(draw.integers(1 << 63))

    def windows(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and key of each window; the last ones read zeros behind ``data``."""
        data = np.concatenate((data, np.zeros(STEPS, np.uint8)))
        lead = np.zeros(len(data) - STEPS, np.uint32)
        for k in range(LEAD):
            lead = lead << np.uint32(8) | data[k : k + len(lead)]
        lead = (lead ^ np.uint32(self.salt >> np.uint64(32))) * np.uint32(int(self.salt) & 0xFFFFFFFF | 1)
        lead = (lead ^ lead >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
        starts = np.flatnonzero(lead >> np.uint32(16) & np.uint32(SPREAD - 1) == 0)
        at, sums = starts.copy(), np.zeros(len(starts), np.uint64)
        for step in range(STEPS):
            letters = data[at]
            if self.sample[step]:
                sums = sums * np.uint64(0x100000001B3) + letters + np.uint64(1)
            at += self.moves[step][letters]
        return starts, at, mix(sums)


class Pieces:
    """Every ``size`` bytes as a key."""

    def __init__(self, size: int):
        self.size = size

    def windows(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.arange(max(len(data) - self.size + 1, 0))
        sums = np.zeros(len(starts), np.uint64)
        for k in range(self.size):
            sums = sums * np.uint64(0x100000001B3) + data[k : k + len(starts)] + np.uint64(1)
        return starts, starts + self.size, mix(sums)


class Table:
    """Sorted keys of one way to cut windows, with the item and the offset of each."""

    def __init__(self, way: Walk | Pieces, keys: np.ndarray, item: np.ndarray, offset: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.way, self.keys = way, keys[order]
        self.item, self.offset = item[order].astype(np.int32), offset[order].astype(np.int32)
        self.known = np.zeros(1 << 20, bool)
        self.known[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, item and offset in the item of each window that shares a key."""
        starts, _, keys = self.way.windows(data)
        near = np.flatnonzero(self.known[(keys >> np.uint64(44)).astype(np.int64)])
        low, high = np.searchsorted(self.keys, keys[near]), np.searchsorted(self.keys, keys[near], "right")
        many = high - low
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        return starts[np.repeat(near, many)], self.item[at], self.offset[at]


def best_part(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance between ``pattern`` and any part of ``text``, and where the first such part ends."""
    size = len(pattern)
    top, full = 1 << (size - 1), (1 << size) - 1
    places: dict[int, int] = {}
    for i, letter in enumerate(pattern):
        places[letter] = places.get(letter, 0) | 1 << i
    plus, minus, distance = full, 0, size
    best, end = size, 0
    for j, letter in enumerate(text, 1):
        same = places.get(letter, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        distance += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
        if distance < best:
            best, end = distance, j
    return best, end


def edited(text: bytes, edits: int, draw: np.random.Generator) -> bytes:
    """A copy with so many random replacements, insertions and deletions of bytes."""
    copy = bytearray(text)
    for kind, letter, place in zip(draw.integers(0, 3, edits), draw.integers(0, len(text), edits), draw.random(edits)):
        at = int(place * len(copy))
        copy[at : at + (kind != 1)] = b"" if kind == 2 else text[letter : letter + 1]
    return bytes(copy)


class Items:
    """Normalised items, the tables of their windows and the letters of their parts."""

    def __init__(self, ids: list, texts: list[bytes], percent: int):
        self.ids, self.texts = ids, texts
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.allowed = np.where(self.sizes < SHORTEST, 0, self.sizes * (100 - percent) // 100)
        rate = (100 - percent) / 100
        self.slack = np.where(self.sizes <= PART, self.allowed, 16)
        self.most = np.where(self.sizes <= PART, self.allowed, int(PART * rate + 3 * (PART * rate * (1 - rate)) ** 0.5))
        self._cut_parts()
        bounds = np.concatenate(([0], np.cumsum(self.sizes)))
        data = np.frombuffer(b"".join(texts), np.uint8)
        owner = np.repeat(np.arange(len(texts)), self.sizes)
        left = {c: self._trials(np.flatnonzero((self.sizes >= c) & (self.sizes < 2 * c))) for c in self._classes()}
        self.tables: list[Table] = []
        reached = np.zeros(len(texts), bool)
        for number in range(MOST_TABLES):
            if not left:
                break
            walk = Walk(number + 1)
            starts, ends, keys = walk.windows(data)
            own = np.flatnonzero(ends <= bounds[1:][owner[starts]])
            own = own[np.isin(self._class_of(self.sizes[owner[starts[own]]]), list(left))]
            item = owner[starts[own]]
            table = Table(walk, keys[own], item, starts[own] - bounds[:-1][item])
            self.tables.append(table)
            reached[item] = True
            for size, (copies, copy_bounds, whose, found) in list(left.items()):
                at, hit, _ = self._near(table, copies)
                text = np.searchsorted(copy_bounds, at, "right") - 1
                found[text[hit == whose[text]]] = True
                if found.mean() >= TARGET:
                    del left[size]
        rest = np.flatnonzero((self.sizes < SHORT) | ~reached | np.isin(self._class_of(self.sizes), list(left)))
        self._add_pieces(rest[self.sizes[rest] > 0])

    @staticmethod
    def _class_of(sizes: np.ndarray) -> np.ndarray:
        return 1 << np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)

    def _classes(self) -> list[int]:
        return np.unique(self._class_of(self.sizes[self.sizes >= SHORT])).tolist()

    def _trials(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Copies of items of a class, edited as far as allowed: bytes, bounds, whose they are, and which are found."""
        draw = np.random.Generator(np.random.PCG64(7))
        whose = np.resize(draw.permutation(members)[:TRIALS], max(TRIALS, 1))
        copies = [edited(self.texts[i], int(self.allowed[i]), draw) for i in whose]
        bounds = np.concatenate(([0], np.cumsum([len(c) for c in copies])))
        return np.frombuffer(b"".join(copies), np.uint8), bounds, whose, np.zeros(len(whose), bool)

    def _add_pieces(self, items: np.ndarray) -> None:
        cut: dict[int, list[tuple[bytes, int, int]]] = {}
        for i in items.tolist():
            pieces = int(self.allowed[i]) + 1
            size = len(self.texts[i]) // pieces
            cut.setdefault(size, []).extend((self.texts[i][k * size : (k + 1) * size], i, k * size) for k in range(pieces))
        for size, pieces in sorted(cut.items()):
            way = Pieces(size)
            _, _, keys = way.windows(np.frombuffer(b"".join(p for p, _, _ in pieces), np.uint8))
            self.tables.append(Table(way, keys[::size], *(np.array([p[k] for p in pieces], np.int64) for k in (1, 2))))

    def _cut_parts(self) -> None:
        """For each part, where each of 32 classes of letters stands in it."""
        counts = np.maximum(-(-(self.sizes - PART) // STRIDE), 0) + 1
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.letters = np.zeros((self.first[-1], 32), np.uint64)
        data = np.frombuffer(b"".join(self.texts), np.uint8)
        begins = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        item = np.repeat(np.arange(len(self.sizes)), counts)
        start = self._part_start(item, np.arange(self.first[-1]) - self.first[item])
        for k in range(PART):
            own = np.flatnonzero(k < self.sizes[item])
            self.letters[own, data[begins[item[own]] + start[own] + k] & 31] |= np.uint64(1 << k)

    def _part_start(self, item: np.ndarray, part: np.ndarray) -> np.ndarray:
        return np.maximum(np.minimum(part * STRIDE, self.sizes[item] - PART), 0)

    def _near(self, table: Table, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hits of a table whose part of the item lies around them at a fitting edit distance."""
        starts, item, offset = table.hits(data)
        padded = np.concatenate((data & 31, np.full(1, 31, np.uint8)))
        kept = [np.zeros(0, np.int64)]
        for low in range(0, len(starts), 1 << 13):
            span = slice(low, low + (1 << 13))
            kept.append(low + np.flatnonzero(self._fits(padded, starts[span], item[span], offset[span])))
        at = np.concatenate(kept)
        return starts[at], item[at], offset[at]

    def _fits(self, data: np.ndarray, starts: np.ndarray, item: np.ndarray, offset: np.ndarray) -> np.ndarray:
        part = np.clip((offset - 8) // STRIDE, 0, self.first[item + 1] - self.first[item] - 1)
        size = np.minimum(self.sizes[item], PART)
        slack = self.slack[item]
        at = starts - offset + self._part_start(item, part) - slack
        rows = (self.first[item] + part) * 32
        letters = self.letters.ravel()
        one, top = np.uint64(1), (size - 1).astype(np.uint64)
        plus, minus = np.full(len(at), ~np.uint64(0)), np.zeros(len(at), np.uint64)
        distance, best = size.copy(), size.copy()
        steps = size + 2 * slack
        for step in range(int(steps.max(initial=0))):
            place = at + step
            place = np.where((place < 0) | (place >= len(data)) | (step >= steps), len(data) - 1, place)
            same = letters[rows + data[place]]
            vertical = same | minus
            horizontal = (((same & plus) + plus) ^ plus) | same
            up, down = minus | ~(horizontal | plus), plus & horizontal
            distance += (up >> top & one).astype(np.int64) - (down >> top & one).astype(np.int64)
            up, down = up << one, down << one
            plus, minus = down | ~(vertical | up), up & vertical
            np.minimum(best, distance, out=best)
        return best <= self.most[item]

    def candidates(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (text, item, supposed start) of windows that fit, starts rounded down to 16."""
        found = [np.zeros((0, 3), np.int64)]
        for table in self.tables:
            starts, item, offset = self._near(table, data)
            text = np.searchsorted(bounds, starts, "right") - 1
            found.append(np.stack((text, item, (starts - offset) >> 4), 1))
        return np.unique(np.concatenate(found), axis=0)

    def places(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, begin, end) of the parts of texts to verify; candidates whose parts touch are one."""
        held: list[int] = []
        for text, item, place in self.candidates(data, bounds).tolist():
            allowed = int(self.allowed[item])
            begin, end = max(int(bounds[text]), place * 16 - allowed), min(int(bounds[text + 1]), place * 16 + 16 + len(self.texts[item]) + allowed)
            if held and held[:2] == [text, item] and begin - held[2] <= PART + allowed:
                held[3] = end
                continue
            if held:
                yield tuple(held)
            held = [text, item, begin, end]
        if held:
            yield tuple(held)


def _apart(pattern: bytes, data: np.ndarray, at: int, low: int, high: int) -> bool:
    """Whether no word goes on beyond an ASCII edge of the pattern at a place in a text."""
    before = at == low or data[at - 1] == 32 or pattern[0] >= 128
    return before and (at + len(pattern) >= high or data[at + len(pattern)] == 32 or pattern[-1] >= 128)


def _verified(items: Items, data: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
    """The best match of each text and item: edits, start and end."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, item, begin, stop in items.places(data, bounds):
        pattern = items.texts[item]
        held = best.get((text, item))
        if held and held[0] == 0:
            continue
        window = data[begin:stop].tobytes()
        exact = window.find(pattern)
        while len(pattern) < SHORTEST and exact >= 0 and not _apart(pattern, data, begin + exact, bounds[text], bounds[text + 1]):
            exact = window.find(pattern, exact + 1)
        if exact >= 0:
            best[text, item] = (0, begin + exact, begin + exact + len(pattern))
            continue
        if len(pattern) < SHORTEST:
            continue
        edits, end = best_part(pattern, window)
        if edits <= items.allowed[item] and (held is None or edits < held[0]):
            _, length = best_part(pattern[::-1], window[:end][::-1])
            best[text, item] = (edits, begin + end - length, begin + end)
    return best


def contaminated(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, key: str = "doc_id", item: str = "item_id", text: str = "text"
) -> DataFrame:
    """``(key, item, start, end, edits, similarity)``: the best place of each item in each text that holds it.

    A text holds an item if some part of it is at an edit distance of at most ``100 - percent`` percent of the item's
    normalised length. ``start`` and ``end`` are byte offsets in the text as it is. Null texts and items hold nothing; items
    of fewer than ``SHORTEST`` normalised bytes are held by exact copies that are not part of a longer ASCII word. Repeated rows give repeated rows. The items are taken in
    blocks of about ``BLOCK_BYTES``, each against all texts.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    asked = benchmark.where(F.col(text).isNotNull()).select(F.col(item).alias("item"), F.col(text).alias("text"))
    kind, item_kind = source.schema["key"].dataType.simpleString(), asked.schema["item"].dataType.simpleString()
    schema = f"key {kind}, item {item_kind}, start long, end long, edits long, similarity double"
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    result = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).toArrow()
        found = _search(source, rows, percent, schema)
        result = found if result is None else result.union(found)
    return result.withColumnsRenamed({"key": key, "item": item})


def _search(source: DataFrame, rows: pa.Table, percent: int, schema: str) -> DataFrame:
    data, bounds, _ = normalised(*flat(rows.column("text").combine_chunks()))
    texts = [data[a:b].tobytes().rstrip(b" ") for a, b in zip(bounds[:-1], bounds[1:])]
    ids = rows.column("item")
    chosen = [i for i, t in enumerate(texts) if t]
    items = Items([ids[i].as_py() for i in chosen], [texts[i] for i in chosen], percent)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, bounds, where = normalised(*flat(part.column("text")))
            raw = flat(part.column("text"))[1]
            out: list[tuple] = []
            for (text, item), (edits, start, end) in sorted(_verified(items, data, bounds).items()):
                last = where[end - 1] + 1 if end > start else where[start]
                similarity = 1 - edits / len(items.texts[item])
                out.append((text, items.ids[item], int(where[start] - raw[text]), int(last - raw[text]), edits, similarity))
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(pa.array(columns[0], pa.int64())),
                    pa.array(columns[1], rows.schema.field("item").type),
                    *(pa.array(c, pa.int64()) for c in columns[2:5]),
                    pa.array(columns[5], pa.float64()),
                ],
                names=["key", "item", "start", "end", "edits", "similarity"],
            )

    return source.mapInArrow(search, schema)
