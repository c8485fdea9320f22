"""Byte-level BPE without merging: longest matches, backtracking and pair compatibility.

The merge procedure of byte-level BPE has one result per piece of text. A sequence of
tokens is that result exactly if every two neighbours are compatible, that is, if
merging the bytes of both together gives these two tokens again. So the encoder takes
the longest token at each place (all matches of a piece come from one pass of an
Aho-Corasick automaton over the piece, its bytes read as Latin-1), keeps it if it is
compatible with the token before, else tries the next shorter one, and steps back when
none fits. A place that has failed is never tried again, so a piece takes linear time.

Defined cases: null text is encoded as empty text (no ids); unknown bytes cannot occur,
since a byte-level vocabulary has all 256; a column that already has the output's name
is replaced; every other column passes through.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import CACHE_ENTRIES, slices, worker_state

_NO_LIMIT = 1 << 62
_NO_IDS = np.zeros(0, dtype=np.int32)
_IDS = T.ArrayType(T.IntegerType())
#: Pieces longer than this are encoded each time instead of being remembered.
CACHED_PIECE = 48
#: Pieces remembered in one of two generations.
PIECES = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line. Bounded by the vocabulary, not by the corpus."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """Encodes and decodes with one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.pieces = regex.compile(pattern).findall
        most = max(ranks.values()) + 1
        self.text: list[str] = [""] * most
        for token, rank in ranks.items():
            self.text[rank] = token.decode("latin-1")
        self.rank = {self.text[rank]: rank for rank in ranks.values()}
        missing = [b for b in range(256) if chr(b) not in self.rank]
        if missing:
            raise ValueError(f"vocabulary has no token for bytes {missing}")
        self.automaton = ahocorasick.Automaton()
        for text, rank in self.rank.items():
            if len(text) > 1:  # a byte's own token is known without a search
                self.automaton.add_word(text, (rank, len(text) - 1))
        self.byte = [self.rank[chr(b)] for b in range(256)]
        self.automaton.make_automaton()
        self.shorter = [self._longest_prefix(text) for text in self.text]
        self.halves = [(rank, rank) for rank in range(most)]
        for rank in sorted(self.rank.values()):
            self.halves[rank] = self._split(rank)
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        # For decoding: all tokens in one array of bytes, and where each begins.
        self.size = np.array([len(text) for text in self.text], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer("".join(self.text).encode("latin-1"), dtype=np.uint8)

    def _longest_prefix(self, text: str) -> int | None:
        """The longest token that begins ``text`` and is not all of it."""
        return next((self.rank[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.rank), None)

    def _split(self, rank: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one; itself twice if merges never make it."""
        text = self.text[rank]
        left = self.shorter[rank]
        while left is not None:
            right = self.rank.get(text[len(self.text[left]) :])
            if right is not None and left < rank and right < rank and self._compatible(left, right, rank):
                return left, right
            left = self.shorter[left]
        return rank, rank

    def _compatible(self, left: int, right: int, limit: int = _NO_LIMIT) -> bool:
        """Would merging the bytes of both leave these two tokens?

        Undoes the merges of both sides, the latest first. If at some moment the two parts
        that touch could have merged before the merge that was just undone, BPE would have
        joined them across the border.
        """
        text, rank, halves = self.text, self.rank, self.halves
        while True:
            joined = rank.get(text[left] + text[right])
            if joined is not None and joined < limit:
                return False
            # Of equal ranks the one further left merges first, so the right side's limit is one higher.
            for side in (0, 1) if left > right else (1, 0):
                part = right if side else left
                inner = halves[part][0] if side else halves[part][1]
                if inner != part:
                    limit = part + side
                    left, right = (left, inner) if side else (inner, right)
                    break
            else:
                return True

    def _learn_pair(self, left: int, right: int) -> bool:
        if len(self.fits) >= CACHE_ENTRIES:
            self.fits.clear()
        found = self.fits[left << 32 | right] = self._compatible(left, right)
        return found

    def encode_piece(self, raw: bytes) -> list[int]:
        """Token ids of one piece, given as UTF-8."""
        piece = raw.decode("latin-1")
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest = [*map(self.byte.__getitem__, raw)]
        for end, (rank, before) in self.automaton.iter(piece) if self.automaton else ():
            longest[end - before] = rank  # matches come by their ends, so the last one from a place is the longest
        open_at = bytearray(b"\x01" * (size + 1))
        done: list[int] = []
        at, token = 0, longest[0]
        text, shorter, fits = self.text, self.shorter, self.fits
        while True:
            end = at + len(text[token])
            if open_at[end]:
                if done:
                    fit = fits.get(done[-1] << 32 | token)
                    if fit is None:
                        fit = self._learn_pair(done[-1], token)
                else:
                    fit = True
                if fit:
                    done.append(token)
                    if end == size:
                        return done
                    at, token = end, longest[end]
                    continue
            token = shorter[token]
            while token is None:  # nothing fits here: close the place and shorten the token before
                open_at[at] = 0
                last = done.pop()
                at -= len(text[last])
                token = shorter[last]

    def _learn(self, piece: str) -> bytes:
        """Encode a piece and remember it; two generations of memory, so that common pieces stay."""
        found = self.known.get(piece) or self.earlier.get(piece)
        if found is None:
            found = array("i", self.encode_piece(piece.encode())).tobytes()
        if len(piece) <= CACHED_PIECE:
            if len(self.known) >= PIECES:
                self.earlier, self.known = self.known, {}
            self.known[piece] = found
        return found

    def encode_packed(self, text: str) -> bytes:
        """The token ids of a text as 32-bit integers."""
        pieces = self.pieces(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._learn(pieces[i])
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype=np.int32).tolist()

    def decode_packed(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.repeat(self.start[ids] - (ends - size), size) + np.arange(total)]

    def decode(self, ids) -> bytes:
        return self.decode_packed(np.asarray(ids, dtype=np.int64)).tobytes()


def joined(ids: Column) -> Column:
    """The decimal ids joined by commas, as bytes."""
    return F.array_join(ids.cast("array<string>"), ",").cast("binary")


def _encoded(coder: ByteBpe, texts: pa.Array) -> pa.Array:
    packed = [coder.encode_packed(v) if v else b"" for v in texts.to_pylist()]
    ends = np.cumsum([0, *map(len, packed)]) // 4
    values = np.frombuffer(b"".join(packed), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _decoded(coder: ByteBpe, lists: pa.Array) -> pa.Array:
    ids = [v.values.to_numpy() if v.is_valid else _NO_IDS for v in lists]
    ends = np.cumsum([0, *(int(coder.size[x].sum()) for x in ids)], dtype=np.int32)
    data = coder.decode_packed(np.concatenate(ids)) if ids else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(data)])


class Codec:
    """A vocabulary shipped to the executors once; encodes and decodes columns."""

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        self.pattern = pattern
        self.key = (ranks_path, pattern, len(ranks))
        self.ranks = spark.sparkContext.broadcast(ranks)

    def _run(self, df: DataFrame, work, added: list[tuple[str, T.DataType]]) -> DataFrame:
        """Adds columns that ``work`` (coder, batch) makes, a few rows at a time."""
        key, ranks, pattern = self.key, self.ranks, self.pattern
        names = [name for name, _ in added]
        taken = {name.lower() for name in names}
        kept = [f for f in df.schema.fields if f.name.lower() not in taken]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = worker_state(key, lambda: ByteBpe(ranks.value, pattern))  # one per Python worker
            for batch in slices(batches):
                columns = [batch.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, *work(coder, batch)], [*(f.name for f in kept), *names])

        return df.mapInArrow(run, T.StructType([*kept, *(T.StructField(*x) for x in added)]))

    def encode(self, df: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """Adds ``ids``, the token ids of every whole text, as array<int>."""
        return self._run(df, lambda coder, batch: [_encoded(coder, batch.column(text))], [(ids, _IDS)])

    def decode(self, df: DataFrame, ids: str = "ids", out: str = "decoded") -> DataFrame:
        """Adds ``out``, the bytes that the ids stand for; a null list gives no bytes."""
        return self._run(df, lambda coder, batch: [_decoded(coder, batch.column(ids))], [(out, T.BinaryType())])

    def round_trip(self, df: DataFrame, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
        """``encode`` and then ``decode`` of the ids, in one Python worker."""

        def work(coder: ByteBpe, batch: pa.RecordBatch) -> list[pa.Array]:
            encoded = _encoded(coder, batch.column(text))
            return [encoded, _decoded(coder, encoded)]

        return self._run(df, work, [(ids, _IDS), (out, T.BinaryType())])
