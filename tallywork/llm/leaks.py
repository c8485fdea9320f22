"""Benchmark passages in documents: CGK embedding, bit sampling, exact edit distance.

Texts are sequences of lower-cased words. The CGK embedding walks over a sequence and
writes down the word it stands on; after each step a random bit, drawn for the step and
the word, says whether it moves on. Two sequences at a small edit distance soon walk in
step again after an edit, so their walks agree at most steps: edit distance has become
Hamming distance, and hashing a few sampled steps (bit sampling) finds neighbours.

Every benchmark item is indexed from its beginning and from a third and two thirds of
it, a long one at every half window, in a size class by the words from there on, up to
LONGEST; a walk for a class is as long as it takes to pass a window of that size. Each
word of each document starts a window. Independent walks with several samples of a few
steps each are tried, as many as the class needs (EFFORT), which sets the recall. What collides is verified exactly: the
least edit distance between the item and any stretch of the document near the window,
at most ``rate`` times the item's words.

Only windows that can match are walked: words that no item has count as edits, and a
window with more of them than a match may have is passed over. This loses nothing.

Items are searched in blocks of at most BLOCK_WORDS words, each shipped to the executors
once, so a benchmark of any size is whole; documents are not shuffled, and a document is
searched in one task whatever it shares with others.

Defined cases: null and empty texts hold no passage; items of fewer than MIN_WORDS words
are found without loss beside the index, by parts of which one must be whole, so those of one to four words as they are;
items without words are in no text; in scripts without blanks each character is a word; repeated items are each found; repeated rows
give equal rows; an empty benchmark or table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import slices, worker_state

MIN_WORDS = 8
#: The rest of an item from a third or two thirds on is indexed if it has so many words.
MIN_PART = 12
BLOCK_WORDS = 1_000_000
CHUNK = 8192
#: Windows are never longer than this class size: longer items are indexed at every half window instead.
LONGEST = 40
#: By class size, how many times the walks and the tables of the settings are tried, and how many steps fewer are sampled:
#: the edits that a short item may have leave a walk fewer steps that agree. Set by the recall measured at the full rate.
EFFORT = {8: (4, 1, 1), 12: (2.5, 1, 1), 18: (2, 0.6, 1), 27: (2, 0.5, 1), 40: (2, 0.5, 1)}

#: Scripts written without blanks (Thai, Lao, Burmese, Khmer, kana, Han), as first and last code points.
_UNSPACED = [(0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
             (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
_python_ranges = "".join(f"{chr(a)}-{chr(b)}" for a, b in _UNSPACED)
_java_ranges = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _UNSPACED)

# Only to size blocks of items.
_JAVA_WORD = rf"(?U)[{_java_ranges}]|[\w&&[^{_java_ranges}]]+"
_plain_word = re.compile(r"\w+")
_any_word = re.compile(rf"[^\W{_python_ranges}]+|(?=\w)[{_python_ranges}]")
_beyond = re.compile("[\u0e00-\u17ff\u3040-\U0003ffff]").search


def _pattern(text: str) -> re.Pattern:
    """A word is a run of word characters, or a single one in a script without blanks."""
    return _plain_word if text.isascii() or not _beyond(text) else _any_word


def words_of(text: str | None) -> list[str]:
    """The lower-cased words. Where a letter changes its length, words are cut first, so that borders stay as in the text."""
    if not text:
        return []
    low = text.lower()
    cut = _pattern(text).findall
    return cut(low) if len(low) == len(text) else [w.lower() for w in cut(text)]


def edit_search(pattern: list[int], stretch: list[int]) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to any part of ``stretch``, and where the first such part ends.

    Bit-parallel: the differences of one column of the distance table are two integers.
    """
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[int, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    up, down, distance = full, 0, size
    best, end = size, 0
    for k, c in enumerate(stretch, 1):
        equal = where.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        distance += bool(plus & top) - bool(minus & top)
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        if distance < best:
            best, end = distance, k
    return best, end


@dataclass(frozen=True)
class Settings:
    rate: float = 0.2
    walks: int = 2
    tables: int = 7
    sampled: int = 4
    seed: int = 7


class LeakIndex:
    """The items of one block, indexed; searches lists of texts."""

    def __init__(self, items: list[tuple], settings: Settings):
        self.settings = settings
        self.ids = [key for key, _ in items]
        words = [words_of(text) for _, text in items]
        self.number: dict[str, int] = {}
        self.items = [[self.number.setdefault(w, len(self.number) + 1) for w in ws] for ws in words]
        self.kinds = [frozenset(item) for item in self.items]
        random = np.random.default_rng(settings.seed)
        # Number 0 is any word that no item has, the last one the end of a sequence.
        self.end = len(self.number) + 1
        entries: dict[int, list[tuple[int, int]]] = {}
        for i, item in enumerate(self.items):
            if len(item) >= MIN_WORDS:
                for offset in self._offsets(len(item)):
                    entries.setdefault(self._class(len(item) - offset), []).append((i, offset))
        #: By length, the parts of short items: their factors, the entries by key, the sorted keys.
        self.parts = self._part_tables(np.random.default_rng(settings.seed + 1))
        self.classes = sorted(entries)
        # Words without any item that a window may have: for whole items as many as a match may have edits, and for
        # windows of longer ones half as many again as their share.
        self.allowed = {
            c: max(self._most(c if offset else min(len(self.items[i]), c * 3 // 2)) for i, offset in entries[c])
            for c in self.classes
        }
        self.steps = max((self._steps(c) for c in self.classes), default=0)
        #: By walk, as many steps as the classes that take it need.
        self.moves = []
        for walk in range(max((self._walks(c) for c in self.classes), default=0)):
            steps = max(self._steps(c) for c in self.classes if walk < self._walks(c))
            self.moves.append(random.integers(0, 2, size=(steps, self.end + 1), dtype=np.int8))
        #: By class and walk: sampled steps, their factors, a bit per key, the entries by key, the sorted keys.
        self.tables: dict[tuple[int, int], list[tuple]] = {}
        for c in self.classes:
            for walk in range(self._walks(c)):
                seen = self._walk_entries(walk, entries[c], self._steps(c))
                self.tables[c, walk] = [
                    self._table(random, c, seen, entries[c]) for _ in range(max(1, round(settings.tables * EFFORT[c][1])))
                ]

    def _table(self, random: np.random.Generator, c: int, seen: np.ndarray, entries: list[tuple[int, int]]) -> tuple:
        steps = self._sample(random, self._steps(c), max(1, self.settings.sampled - EFFORT[c][2]))
        factor = random.integers(1, 1 << 62, size=len(steps), dtype=np.int64) | 1
        keys = (seen[steps].astype(np.int64) * factor[:, None]).sum(axis=0)
        at: dict[int, list[tuple[int, int]]] = {}
        for key, entry in zip(keys.tolist(), entries, strict=True):
            at.setdefault(key, []).append(entry)
        # By a few bits of the key, 64 for each entry or so, whether it can be one of the keys.
        bits = np.zeros(min(1 << 18, max(1 << 12, 1 << (64 * len(entries)).bit_length())), dtype=bool)
        bits[(keys >> 44) & (len(bits) - 1)] = True
        return steps, factor, bits, at, np.array(sorted(at), dtype=np.int64)

    def _part_tables(self, random: np.random.Generator) -> dict[int, tuple]:
        """Items of fewer than MIN_WORDS words, in one part more than a match may have edits: one of them is found as it is."""
        pieces: dict[int, list[tuple[int, int]]] = {}
        for i, item in enumerate(self.items):
            if 0 < len(item) < MIN_WORDS:
                n = min(self._most(len(item)) + 1, len(item))
                edges = [len(item) * k // n for k in range(n + 1)]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    pieces.setdefault(b - a, []).append((i, a))
        tables = {}
        for size, entries in sorted(pieces.items()):
            factor = random.integers(1, 1 << 62, size=size, dtype=np.int64) | 1
            at: dict[int, list[tuple[int, int]]] = {}
            for i, a in entries:
                key = int((np.array(self.items[i][a : a + size], dtype=np.int64) * factor).sum())
                at.setdefault(key, []).append((i, a))
            tables[size] = factor, at, np.array(sorted(at), dtype=np.int64)
        return tables

    def _short_candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place, item, offset) of the parts of short items."""
        for size, (factor, at, keys) in self.parts.items():
            key = np.zeros(max(0, len(ids) - size + 1), dtype=np.int64)
            for k, f in enumerate(factor):
                key += ids[k : k + len(key)] * f
            for h in np.flatnonzero(np.isin(key, keys)).tolist():
                for entry in at[int(key[h])]:
                    yield (h, *entry)

    def _most(self, size: int) -> int:
        return int(self.settings.rate * size)

    @staticmethod
    def _class(size: int) -> int:
        """The largest class size not above ``size``: classes grow by half from MIN_WORDS."""
        c = MIN_WORDS
        while (following := c * 3 // 2) <= min(size, LONGEST):
            c = following
        return c

    @staticmethod
    def _offsets(size: int) -> list[int]:
        """Where an item's windows begin: thirds, or every half window if it is long."""
        if size < 2 * LONGEST:
            starts = {size // 3, 2 * size // 3}
        else:
            starts = {*range(0, size - LONGEST + 1, LONGEST // 2), size - LONGEST}
        return sorted({0} | {s for s in starts if size - s >= MIN_PART})

    @staticmethod
    def _steps(size: int) -> int:
        return int(1.6 * size)

    def _walks(self, c: int) -> int:
        return max(1, round(self.settings.walks * EFFORT[c][0]))

    def _sample(self, random: np.random.Generator, steps: int, k: int) -> np.ndarray:
        """``k`` sampled steps, one from each part of a random half or more of the walk."""
        width = int(random.integers(max(k, steps // 2), steps + 1))
        first = int(random.integers(0, steps - width + 1))
        edges = first + np.arange(k + 1) * width // k
        return np.array([random.integers(a, max(b, a + 1)) for a, b in zip(edges[:-1], edges[1:], strict=True)])

    def _walk_entries(self, walk: int, entries: list[tuple[int, int]], steps: int) -> np.ndarray:
        flat, starts = [], []
        for i, offset in entries:
            starts.append(len(flat))
            flat += self.items[i][offset : offset + steps + 1] + [self.end] * (steps + 1)
        return self._walk(walk, np.array(flat, dtype=np.int32), np.array(starts, dtype=np.int64), steps)

    def _walk(self, walk: int, ids: np.ndarray, starts: np.ndarray, steps: int) -> np.ndarray:
        """The words that the walks from ``starts`` stand on, a row per step."""
        out = np.empty((steps, len(starts)), dtype=np.int32)
        at = starts.astype(np.int64)
        for j in range(steps):
            np.take(ids, at, out=out[j], mode="clip")
            at += self.moves[walk][j][out[j]]
        return out

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place, item, offset) of colliding windows of a long sequence, which may hold several documents."""
        yield from self._short_candidates(ids)
        if not self.classes:
            return
        padded = np.concatenate([ids, np.full(max(self.steps, *self.classes) + 1, self.end, dtype=np.int32)])
        foreign = np.concatenate([[0], np.cumsum(padded == 0, dtype=np.int32)])
        for c in self.classes:
            within = foreign[c : c + len(ids)] - foreign[: len(ids)]
            places = np.flatnonzero(within <= self.allowed[c])
            for begin in range(0, len(places), CHUNK):
                part = places[begin : begin + CHUNK]
                for walk in range(self._walks(c)):
                    seen = self._walk(walk, padded, part, self._steps(c))
                    for steps, factor, bits, at, keys in self.tables[c, walk]:
                        key = seen[steps[0]] * factor[0]
                        for s, f in zip(steps[1:], factor[1:], strict=True):
                            key += seen[s] * f
                        hit = np.flatnonzero(bits[(key >> 44) & (len(bits) - 1)])
                        if len(hit):
                            for h in hit[np.isin(key[hit], keys)].tolist():
                                for entry in at[int(key[h])]:
                                    yield (int(part[h]), *entry)

    def _group(self, place: int, item: int, offset: int) -> int:
        """Beginnings of an item that lie within as many words as it may have edits are verified as one."""
        return (place - offset) // max(1, self._most(len(self.items[item])))

    def verify(self, doc: np.ndarray, place: int, item: int, offset: int) -> tuple[int, int, int] | None:
        """(distance, first word, word after) of the best match of an item near a place in one document; None if too far."""
        pattern = self.items[item]
        most = self._most(len(pattern))
        # All places of one group look at the same stretch.
        first = self._group(place, item, offset) * max(1, most)
        low = max(0, first - 2 * most)
        stretch = doc[low : max(0, first + len(pattern) + 3 * most)].tolist()
        # Each word that the stretch lacks takes an edit.
        if len(self.kinds[item].difference(stretch)) > most:
            return None
        distance, end = edit_search(pattern, stretch)
        if distance > most:
            return None
        back, length = edit_search(pattern[::-1], stretch[:end][::-1])
        return distance, low + end - length, low + end

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text (item number, distance, first word, word after): the best match of each item that it holds."""
        get = self.number.get
        docs = [np.array([get(w, 0) for w in words_of(t)], dtype=np.int32) for t in texts]
        gap = np.array([self.end], dtype=np.int32)
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        if not docs or not (self.classes or self.parts):
            return [[] for _ in texts]
        ids = np.concatenate([x for d in docs for x in (d, gap)])
        starts = np.cumsum([0] + [len(d) + 1 for d in docs])
        tried: set[tuple[int, int, int]] = set()
        for place, item, offset in self.candidates(ids):
            n = int(np.searchsorted(starts, place, side="right")) - 1
            local = place - int(starts[n])
            group = (n, item, self._group(local, item, offset))
            if group in tried:
                continue
            tried.add(group)
            old = found[n].get(item)
            if old is not None and old[0] == 0:
                continue
            match = self.verify(docs[n], local, item, offset)
            if match is not None and (old is None or match < old):
                found[n][item] = match
        return [[(i, *m) for i, m in sorted(f.items())] for f in found]


def _ship(spark: SparkSession, block: DataFrame, settings: Settings):
    """The items of one block, at most BLOCK_WORDS words or so, as a broadcast."""
    rows = sorted(((r.key, r.text) for r in block.collect()), key=lambda r: (str(r[0]), r[1]))
    return spark.sparkContext.broadcast((uuid.uuid4().hex, rows, settings))


def _index(shipped) -> LeakIndex:
    """Built once per Python worker and block."""
    name, rows, settings = shipped.value
    return worker_state(name, lambda: LeakIndex(rows, settings))


def _searched(index: LeakIndex, texts: list[str | None]) -> Iterator[tuple[int, tuple[int, int, int, int]]]:
    """(position, match) over some texts."""
    for n, matches in enumerate(index.search(texts)):
        for match in matches:
            yield n, match


def _plain(key, whole_number: bool):
    return key if key is None or whole_number else str(key)


def _char_span(text: str, first: int, after: int) -> tuple[int, int]:
    """Words to code points."""
    start = end = 0
    for k, m in enumerate(_pattern(text).finditer(text)):
        if k == first:
            start = m.start()
        if k == after - 1:
            end = m.end()
            break
    return start, end


def _item_blocks(items: DataFrame, key: str, text: str) -> list[DataFrame]:
    """The items in blocks of BLOCK_WORDS words or so, by hash."""
    size = items.agg(F.coalesce(F.sum(F.regexp_count(F.lower(F.col(text)), F.lit(_JAVA_WORD))), F.lit(0))).first()[0]
    n = -(-2 * int(size) // BLOCK_WORDS) if size > BLOCK_WORDS else 1
    chosen = items.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    return [chosen.where(F.pmod(F.xxhash64("key", "text"), F.lit(n)) == b) for b in range(n)]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    key: list[str],
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per document row and item found in it: the key columns, item_id, distance, item_words, start, end (code points).

    item_id is a long for whole numbers and a string for all other types.
    """
    spark = docs.sparkSession
    names = ["item_id", "distance", "item_words", "start", "end"]
    kept = [f for f in docs.schema.fields if f.name in key]
    out = []
    for f in kept:
        if f.name in names:
            raise ValueError(f"key column {f.name} has the name of a result column")
    whole_numbers = isinstance(items.schema[item_key].dataType, T.IntegralType)
    schema = T.StructType(
        [*kept, T.StructField("item_id", T.LongType() if whole_numbers else T.StringType())]
        + [T.StructField(n, T.LongType()) for n in names[1:]]
    )
    kinds = [pa.int64() if whole_numbers else pa.string(), *(pa.int64() for _ in names[1:])]
    for block in _item_blocks(items, item_key, item_text):
        shipped = _ship(spark, block, settings)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            index = _index(shipped)
            for batch in slices(batches):
                values = batch.column(text).to_pylist()
                which, found = [], []
                for n, (item, distance, first, after) in _searched(index, values):
                    which.append(n)
                    found.append((_plain(index.ids[item], whole_numbers), distance, len(index.items[item]), *_char_span(values[n], first, after)))
                if which:
                    take = pa.array(which, pa.int64())
                    columns = [batch.column(f.name).take(take) for f in kept]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, *(pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds))], [*(f.name for f in kept), *names]
                    )

        needed = list(dict.fromkeys([*(f.name for f in kept), text]))
        out.append(docs.select(*needed).mapInArrow(run, schema))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def drop_leaking(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """``docs`` without the rows that hold a passage."""
    for block in _item_blocks(items, item_key, item_text):
        shipped = _ship(docs.sparkSession, block, settings)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            index = _index(shipped)
            for batch in slices(batches):
                values = batch.column(text).to_pylist()
                clean = np.ones(len(values), dtype=bool)
                clean[[n for n, _ in _searched(index, values)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
