"""Exact similarity join on sets of word n-grams, by partitioning the universe.

Two sets of sizes s and l whose Jaccard similarity reaches the threshold differ in at most
H = (1 - t) / (1 + t) * (s + l) elements. For each band of sizes the universe of n-gram
hashes is divided into more than H segments; a pair within the threshold then agrees
exactly on at least one segment (pigeonhole), so each set is indexed by what it has in each
segment. A set belongs to the band of its size, and to the next one if a partner may be there.

Allocation by cost: with the counts of all index entries, a segment whose entries collide
too often may be left out (threshold -1) if another one of its band, with the fewest
collisions, is raised to threshold 1: there, sets are indexed by their one-deletion
neighbourhoods too and pairs that differ by one element meet. What a segment gives up the
other one makes good, so the pigeonhole argument stays.

Segments in which a set has nothing are not indexed, since they would bring together
everything; bands have a few segments to spare for that. A set that has too many such
gaps is marked, and only the gaps of marked sets are indexed, for all sets.

No group is gathered or expanded into its pairs. Exact copies are one class. In each index
bucket all members are first compared with one pivot only; verified links give
components; then only members of different components are compared, those outside a bucket's most
frequent component with all, in blocks of bounded size inside a task, behind a lower bound of the difference from
parity sketches. Every
surviving pair is verified on the n-gram sets (64-bit hashes of the n-grams). The complete
mode compares and verifies all members of a bucket in such blocks, whatever their component.

What many unrelated sets have alone in a segment, and gaps, make buckets that grow with the corpus, and their pairs
with its square. A set agrees with a partner on more segments than one if it has more than it needs; so before members
of a bucket are compared, each set leaves its most crowded buckets, as many as it can spare.

Defined cases: null or empty texts have no n-grams and are linked with nothing; a text of
fewer words than n has one n-gram, all of it; repeated rows are one document; rows with a
null id are not linked, their component is null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import free_name, slices, store, worker_state
from tallywork.llm.components import components

#: Lists of ids up to so many rows are broadcast; longer ones are joined by shuffle.
BROADCAST_IDS = 500_000
#: Members of a bucket that meet in one block.
BLOCK = 1024
#: Buckets of more members are crowded: sets that meet their partners elsewhere too leave them.
CROWD = 32
#: Pairs are compared by sketch in portions of about so many.
PAIRS_AT_ONCE = 100_000
_CONTENT_BITS_N = 40
_CONTENT_BITS = np.uint64(_CONTENT_BITS_N)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashed n-gram sets of texts."""

    def __init__(self, n: int):
        self.n = n

    def __call__(self, text: bytes | None) -> np.ndarray:
        """The sorted distinct n-gram hashes of a UTF-8 text; bytes.lower() and bytes.split() know ASCII only, as wanted."""
        words = text.lower().split() if text else []
        if not words:
            return np.zeros(0, dtype=np.uint64)
        # Hashing a word takes no longer than looking it up.
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        width = min(self.n, len(words))
        with np.errstate(over="ignore"):
            state = np.full(len(words) - width + 1, width, dtype=np.uint64)
            for k in range(width):
                state = _mix(state * _M1 + hashes[k : len(hashes) - width + k + 1])
        state.sort()
        return state[_begins(state)]


def _begins(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1))


class Bands:
    """Size bands and their segments for a threshold of ``percent`` in the hundred."""

    def __init__(self, percent: int, growth: float = 1.5):
        self.percent, self.growth = percent, growth
        self.tops = [1]  # the largest size of each band
        self.first = [0]  # the number of each band's first segment
        self.segments = [0]

    def most_apart(self, s: int, l: int) -> int:
        """In how many elements sets of these sizes may differ and still be similar."""
        return (100 - self.percent) * (s + l) // (100 + self.percent)

    def _extend(self) -> None:
        top = max(self.tops[-1] + 1, int(self.tops[-1] * self.growth))
        apart = self.most_apart(top, top)
        self.first.append(self.first[-1] + self.segments[-1])
        self.segments.append(ceil(1.06 * apart) + 4 if apart else 0)  # sets that may not differ at all are copies
        self.tops.append(top)

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            self._extend()
        return int(np.searchsorted(self.tops, size))

    def bands_of(self, size: int) -> list[int]:
        """The bands in which a set of this size is indexed: its own, and those of its larger partners."""
        largest = size * 100 // self.percent
        return [b for b in range(self.band(size), self.band(max(largest, size)) + 1) if self.segments[b]]

    def needed(self, size: int, band: int) -> int:
        """The weight of segments that guarantees a match with any partner in this band."""
        return self.most_apart(size, min(self.tops[band], size * 100 // self.percent)) + 1

    def sketch_words(self, band: int) -> int:
        """64-bit words of a parity sketch that tells differences around the limit apart."""
        words = 4
        while words * 64 < 4 * self.most_apart(self.tops[band], self.tops[band]):
            words *= 2
        return words


def _content(sums: np.ndarray) -> np.ndarray:
    """The content bits of keys, never all 0."""
    return np.maximum(_mix(sums) >> (np.uint64(64) - _CONTENT_BITS), np.uint64(1))


def index_keys(elements: np.ndarray, bands: Bands, levels: dict[int, int]) -> tuple[list[int], list[int], bool]:
    """Keys of a set, keys of its gaps, and whether the set is marked as having too many. ``levels``: segments not at threshold 0."""
    keys, gaps, spare = _index_keys(elements, bands, levels)
    return keys.tolist(), gaps.tolist(), any(x < 0 for *_, x in spare)


def _index_keys(
    elements: np.ndarray, bands: Bands, levels: dict[int, int]
) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Keys of a set, keys of its gaps, and for each band its first segment, the one after its last, and the weight to spare.

    The weight to spare is what the set has in the band beyond what it needs to meet every partner; a set that has too many
    gaps lacks some. The content bits of a gap's key, and of no other, are 0.
    """
    keys: list[np.ndarray] = []
    gaps: list[np.ndarray] = []
    spare: list[tuple[int, int, int]] = []
    size = len(elements)
    with np.errstate(over="ignore"):
        values = _mix(elements ^ _M1)
        for band in bands.bands_of(size):
            m, first = bands.segments[band], bands.first[band]
            # Short numbers are sorted by their digits.
            segment = (_mix(elements + np.uint64(band)) % np.uint64(m)).astype(np.uint16 if m <= 1 << 16 else np.int64)
            order = np.argsort(segment, kind="stable")
            segment, value = segment[order], values[order]
            starts = _begins(segment)
            present = segment[starts].astype(np.int64)
            count = np.diff(starts, append=size)
            total = np.add.reduceat(value, starts)
            place = (np.uint64(first) + present.astype(np.uint64)) << _CONTENT_BITS
            level = np.zeros(len(present), dtype=np.int64)
            if levels:
                level = np.array([levels.get(first + int(p), 0) for p in present], dtype=np.int64)
            key = (place | _content(total)).astype(np.int64)
            keys.append(key[level >= 0])
            for i in np.flatnonzero((level > 0) & (count > 1)):
                less = total[i] - value[starts[i] : starts[i] + count[i]]
                keys.append(np.unique(place[i] | _content(less)).astype(np.int64))
            weight = np.where(level < 0, 0, np.where((level > 0) & (count > 1), 2, 1)).sum()
            spare.append((first, first + m, int(weight) - bands.needed(size, band)))
            missing = np.ones(m, dtype=bool)
            missing[present] = False
            gaps.append((first + np.flatnonzero(missing)) << _CONTENT_BITS_N)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    every = np.concatenate(keys)
    return np.unique(every) if levels else every, np.concatenate(gaps), spare


def parity_sketch(elements: np.ndarray, words: int) -> np.ndarray:
    """Parities of the elements' counts by hash: two sketches differ in at most as many bits as the sets in elements."""
    bits = np.bincount((elements % np.uint64(words * 64)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)


def _tools(n: int, percent: int) -> tuple[Shingler, Bands]:
    """Kept per Python worker: the bands made."""
    return worker_state(("jaccard", n, percent), lambda: (Shingler(n), Bands(percent)))


_BANDS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("first", "until", "spare")]))
_INDEX = (
    "id {0}, n long, h1 long, h2 long, keys array<long>, gaps array<long>, marked boolean, "
    f"bands {_BANDS.simpleString()}, sketch array<long>"
)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    """A list of longs for each row."""
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def index_sets(docs: DataFrame, text: str, key: str, n: int, percent: int, levels: dict[int, int]) -> DataFrame:
    """One row per document: the size of its set, two hashes of the whole set, index keys and parity sketch."""
    kind = docs.schema[key].dataType.simpleString()
    slim = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bands = _tools(n, percent)
        for batch in slices(batches):
            sizes, h1, h2, keys, gaps, marks, spares, sketches = [], [], [], [], [], [], [], []
            for value in batch.column("text"):
                s = shingles(value.as_py())
                k, g, spare = _index_keys(s, bands, levels)
                for sums, x in zip((h1, h2), set_hashes(s), strict=True):
                    sums.append(x)
                sizes.append(len(s))
                keys.append(k)
                gaps.append(g)
                marks.append(any(x < 0 for *_, x in spare))
                spares.append([dict(zip(("first", "until", "spare"), x, strict=True)) for x in spare])
                top = bands.bands_of(len(s))[-1:] if len(s) else []
                sketches.append(parity_sketch(s, bands.sketch_words(top[0])).view(np.int64) if top else s[:0].view(np.int64))
            of_bands = pa.list_(pa.struct([(name, pa.int64()) for name in ("first", "until", "spare")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 _lists(keys), _lists(gaps), pa.array(marks, pa.bool_()), pa.array(spares, of_bands), _lists(sketches)],
                ["id", "n", "h1", "h2", "keys", "gaps", "marked", "bands", "sketch"],
            )

    return slim.mapInArrow(run, _INDEX.format(kind))


def sets_of(docs: DataFrame, text: str, n: int, percent: int) -> DataFrame:
    """(n, h1, h2, elements): the n-gram hashes of each text, known by the same three numbers as in the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, _ = _tools(n, percent)
        for batch in slices(batches):
            found = [shingles(v.as_py()) for v in batch.column("text")]
            sums = [set_hashes(s) for s in found]
            values = _lists([s.view(np.int64) for s in found])
            whole = [pa.array(x, pa.int64()) for x in (map(len, found), (x for x, _ in sums), (x for _, x in sums))]
            yield pa.RecordBatch.from_arrays([*whole, values], ["n", "h1", "h2", "elements"])

    slim = docs.select(F.col(text).cast("binary").alias("text"))
    return slim.mapInArrow(run, "n long, h1 long, h2 long, elements array<long>")


def set_hashes(elements: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    with np.errstate(over="ignore"):
        return tuple(int(_mix(elements ^ salt).sum(dtype=np.uint64).astype(np.int64)) for salt in (_M2, _M3))


def _near(
    sizes: np.ndarray, words: np.ndarray, values: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int
) -> np.ndarray:
    """Which of the pairs of members (a[i], b[i]) may be similar, by size and by parity sketch.

    ``words`` has the length of each member's sketch, ``values`` all sketches, one after the other.
    """
    low, high = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    keep = 100 * low >= percent * high
    common = np.minimum(words[a], words[b])
    starts = np.cumsum(words) - words
    for w in np.unique(common[keep]):
        at = np.flatnonzero(keep & (common == w))
        step = max(1, (PAIRS_AT_ONCE * 8) // int(max(words[a[at]].max(), words[b[at]].max(), 1)))
        for begin in range(0, len(at), step):
            some = at[begin : begin + step]
            apart = np.bitwise_count(
                _folded(a[some], int(w), words, starts, values) ^ _folded(b[some], int(w), words, starts, values)
            ).sum(axis=1, dtype=np.int64)
            keep[some] = apart <= (100 - percent) * (low[some] + high[some]) // (100 + percent)
    return keep


def _folded(members: np.ndarray, w: int, words: np.ndarray, starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sketches of ``members`` as ``w`` words would have given them, a row each."""
    out = np.zeros((len(members), w), dtype=np.uint64)
    for have in np.unique(words[members]):
        at = np.flatnonzero(words[members] == have)
        whole = values[starts[members[at]][:, None] + np.arange(have)]
        while whole.shape[1] > w:
            half = whole.shape[1] // 2
            whole = whole[:, :half] ^ whole[:, half:]
        out[at] = whole
    return out


def _sketches(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The length of each sketch, and all of them one after the other."""
    return np.diff(column.offsets.to_numpy()).astype(np.int64), column.flatten().to_numpy().view(np.uint64)


def _pairs_within(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i before j, of every two equal values in a sorted array, in portions."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.repeat(np.r_[starts[1:], len(group)], np.diff(np.r_[starts, len(group)]))
    first, held, n = np.arange(len(group)), [], 0
    for distance in range(1, len(group)):
        first = first[first + distance < ends[first]]
        if not len(first):
            break
        held.append((first, first + distance))
        n += len(first)
        if n >= PAIRS_AT_ONCE:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _pairs_in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs that may be similar, of different components, among rows with the same bucket and block; sorted input per task."""

    def pairs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key, low, high, ids, side, label, sizes = (
            batch.column(c).to_numpy() for c in ("key", "low", "high", "id", "side", "label", "n")
        )
        words, values = _sketches(batch.column("sketch"))
        for i, j in _pairs_within(_numbered_groups(key, low, high)):
            # Of two blocks, only members of one and the other are compared.
            wanted = (label[i] != label[j]) & ((low[i] == high[i]) | (side[i] != side[j]))
            i, j = i[wanted], j[wanted]
            near = _near(sizes, words, values, i, j, percent)
            if near.any():
                a, b = ids[i[near]], ids[j[near]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            group = _numbered_groups(*(batch.column(c).to_numpy() for c in ("key", "low", "high")))
            last = int(np.searchsorted(group, group[-1])) if len(group) else 0  # the last group may go on
            begun = [batch.slice(last)] if last < batch.num_rows else []
            if held and len(group) and not _same_group(held[-1], batch):
                yield from pairs(_joined(held))
                held = []
            if last:
                yield from pairs(_joined([*held, batch.slice(0, last)]))
                held = []
            held += begun
        if held:
            yield from pairs(_joined(held))

    return rows.mapInArrow(run, "a long, b long")


def _numbered_groups(*columns: np.ndarray) -> np.ndarray:
    """Numbers that grow where any of the columns changes."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    changes = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.r_[0, np.cumsum(changes)]


def _same_group(before: pa.RecordBatch, after: pa.RecordBatch) -> bool:
    return all(before.column(c)[-1] == after.column(c)[0] for c in ("key", "low", "high"))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def _bounded(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


@dataclass(frozen=True)
class Classes:
    """The distinct sets: (n, h1, h2, rep, node), where node is the number by which a set is known and rep its smallest id."""

    table: DataFrame
    collided: DataFrame | None

    @staticmethod
    def of(indexed: DataFrame) -> Classes:
        whole = ["n", "h1", "h2"]
        grouped = indexed.where("n > 0 AND id IS NOT NULL").groupBy(*whole).agg(F.min("id").alias("rep"))
        table = store(grouped, "jaccard-classes")
        # h1 tells sets apart but for a few in 10^10; those few are renumbered.
        collided = store(
            table.groupBy("h1").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h1"), "jaccard-collided"
        )
        found = Classes(table, None if collided.isEmpty() else collided)
        return Classes(found.numbered(table), found.collided)

    def numbered(self, table: DataFrame) -> DataFrame:
        """``table`` (with n, h1, h2) with the column node."""
        if self.collided is None:
            return table.withColumn("node", F.col("h1"))
        known = _bounded(self.collided).select(F.col("h1").alias("h1_"))
        node = F.when(F.col("h1_").isNull(), F.col("h1")).otherwise(F.xxhash64("n", "h1", "h2"))
        return table.join(known, F.col("h1") == F.col("h1_"), "left").withColumn("node", node).drop("h1_")


def _verified(
    docs: DataFrame, text: str, key: str, n: int, percent: int, classes: Classes, pairs: DataFrame
) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    reps = store(classes.table.join(nodes, "node", "left_semi").select(F.col("rep").alias(key)).distinct(), "jaccard-reps")
    chosen = docs.join(_bounded(reps), key, "left_semi")
    sets = store(
        classes.numbered(sets_of(chosen, text, n, percent)).select("node", "elements").dropDuplicates(["node"]),
        "jaccard-sets",
    )
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(100 * shared >= percent * (F.size("x") + F.size("y") - shared))
        .select("a", "b")
    )


def _segment(key: str = "key") -> Column:
    return F.shiftrightunsigned(key, _CONTENT_BITS_N)


def _needed_in(crowded: DataFrame, about: DataFrame, raised: bool) -> DataFrame:
    """The rows of ``crowded`` (members of crowded buckets, with the columns key, members and id) that sets cannot do without.

    A set leaves out as many of a band's buckets as it has weight to spare there, in an order that is the same for all sets,
    the most crowded first. Of the keys that two partners share the last in this order stays in both: a set that left it
    out would have left out all, and so more than it could spare. Gaps are needed by sets without weight to spare only.
    """
    bands = about.select("id", F.explode("bands").alias("band")).select("id", "band.*")
    segment = _segment()
    placed = crowded.join(bands, "id").where((F.col("first") <= segment) & (segment < F.col("until")))
    is_gap = F.col("key").bitwiseAND(F.lit((1 << _CONTENT_BITS_N) - 1)) == 0
    order = Window.partitionBy("id", "first", is_gap).orderBy(F.desc("members"), "key")
    weight = F.row_number().over(order) * (2 if raised else 1)  # a key of a raised segment may stand for 2
    needed = F.when(is_gap, F.col("spare") < 0).otherwise(F.col("spare") < weight)
    return placed.withColumn("needed", needed).where("needed").select(crowded.columns)


def _costs(buckets: DataFrame, members: DataFrame, about: DataFrame) -> DataFrame:
    """(segment, cost): how many pairs the buckets of each segment bring together."""
    held = _needed_in(members.where(F.col("members") > CROWD).select("key", "members", "id"), about, raised=False)
    crowds = held.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    pairs = F.col("members").cast("double") * (F.col("members") - 1) / 2
    return (
        buckets.where(F.col("members") <= CROWD)
        .select("key", "members")
        .unionByName(crowds)
        .groupBy(_segment().alias("segment"))
        .agg(F.sum(pairs).alias("cost"))
    )


def _levels(counts: DataFrame, n_sets: int, bands: Bands) -> dict[int, int]:
    """Segments to leave out (-1) and to raise (1), from the collisions of every segment.

    ``counts`` has a row per segment with collisions; as many as the longest text asks for,
    however many documents there are.
    """
    cost = {int(r.segment): float(r.cost) for r in counts.collect()}
    if not cost:
        return {}
    levels: dict[int, int] = {}
    longest = max(cost)
    while bands.first[-1] + bands.segments[-1] <= longest:
        bands._extend()
    for first, m in zip(bands.first, bands.segments, strict=True):
        ranked = sorted(range(first, first + m), key=lambda s: -cost.get(s, 0.0))
        raised = 10.0 * n_sets  # entries that a one-deletion neighbourhood adds
        for hot, cheap in zip(ranked, reversed(ranked), strict=True):
            # Leaving out the hot one must save more than raising the cheap one costs.
            if hot == cheap or cost.get(hot, 0.0) <= 4 * cost.get(cheap, 0.0) + raised:
                break
            levels[hot], levels[cheap] = -1, 1
    return levels


def link_documents(
    docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 3, percent: int = 90, complete: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(key, n_shingles, component_id) of every row, and the verified links (a, b) between different texts.

    Links are those needed to tell the components, at least one per pair of them that touches. With ``complete`` they
    are all pairs of different sets that reach the threshold, each set under its smallest id, and the rows have
    n_links too: how many other documents, known by id and set, are similar, copies among them.
    """
    rows, links = _linked(docs, text, key, n, percent, complete)
    return rows.drop("h1", "h2"), links


def _linked(
    docs: DataFrame, text: str, key: str, n: int, percent: int, complete: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``link_documents``, with the two hashes of each row's set."""
    indexed = store(index_sets(docs, text, key, n, percent, {}), "jaccard-index")
    classes = Classes.of(indexed)

    def sets_in(table: DataFrame) -> DataFrame:
        """Every document's entries under the number of its set, so that copies merge map side and nothing is joined."""
        return classes.numbered(table.where("n > 0 AND id IS NOT NULL")).drop("id").withColumnRenamed("node", "id")

    def entries(table: DataFrame) -> DataFrame:
        """(key, id): all index keys, and the gaps of segments in which a marked set has one."""
        own = table.select("id", F.explode("keys").alias("key"))
        gaps = table.select("id", "marked", F.explode("gaps").alias("key"))
        wanted = gaps.where("marked").select("key").distinct()
        return own.unionByName(gaps.select("id", "key").join(wanted, "key", "left_semi").select("id", "key"))

    def contested(table: DataFrame) -> DataFrame:
        """Keys of two sets or more, each with a pivot; counted map side first.

        The pivot is the least member in an order of the key's own, so that the many buckets of
        a large group of similar sets have many pivots, and a set that one of them misses meets others.
        """
        mask = F.xxhash64("key")
        place = F.col("id").bitwiseXOR(mask)
        grouped = entries(table).groupBy("key").agg(
            F.min(place).alias("least"), F.max(place).alias("most"), F.count(F.lit(1)).alias("members")
        )
        found = grouped.where("least < most").select("key", F.col("least").bitwiseXOR(mask).alias("pivot"), "members")
        return store(found, "jaccard-buckets")

    def index_of(table: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Contested buckets, their members, and what is known of these."""
        sets = sets_in(table)
        buckets = contested(sets)
        members = store(
            entries(sets).join(buckets, "key").select("key", "pivot", "members", "id").distinct(), "jaccard-members"
        )
        about = store(
            sets.select("id", "n", "bands", "sketch")
            .join(members.select("id").distinct(), "id", "left_semi")
            .dropDuplicates(["id"]),
            "jaccard-about",
        )
        return buckets, members, about

    buckets, members, about = index_of(indexed)
    levels = _levels(_costs(buckets, members, about), classes.table.count(), Bands(percent))
    if levels:
        buckets, members, about = index_of(store(index_sets(docs, text, key, n, percent, levels), "jaccard-index"))

    if complete:
        # Everyone with everyone in the same bucket.
        links, labelled = None, members.select("key", "members", "id", F.col("id").alias("label"))
    else:
        # First, everyone with the pivots of its buckets.
        star = members.where("id <> pivot").select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b"))
        star = star.distinct()
        star = store(_sketched(star, about, percent), "jaccard-pairs")
        links = store(_verified(docs, text, key, n, percent, classes, star), "jaccard-links")
        # Then, members of different components within the buckets that still hold several.
        found = members.select("key", "members", "id").join(components(links), "id", "left")
        labelled = found.select("key", "members", "id", F.coalesce("component", "id").alias("label"))
    several = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
    labelled = store(labelled.join(several, "key", "left_semi"), "jaccard-open")
    # Of a crowded bucket only the sets that cannot do without it stay.
    crowded = labelled.where(F.col("members") > CROWD)
    held = store(_needed_in(crowded, about, raised=bool(levels)), "jaccard-crowds")
    labelled = labelled.where(F.col("members") <= CROWD).unionByName(held)
    # In a bucket the members of its most frequent label are compared with all others, not with each other.
    open_keys = (
        labelled.groupBy("key", "label")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("key")
        .agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("all"))
        .where(F.col("all") > F.col("top.c"))
        .select(
            "key",
            F.col("top.label").alias("most"),
            F.ceil(F.col("top.c") / F.lit(BLOCK)).cast("int").alias("most_blocks"),
            F.ceil((F.col("all") - F.col("top.c")) / F.lit(BLOCK)).cast("int").alias("blocks"),
        )
    )
    # Blocks of the most frequent label have negative numbers, those of the others count from 0.
    is_most = F.col("label") == F.col("most")
    side = F.when(is_most, -1 - F.pmod(F.hash("id"), F.col("most_blocks"))).otherwise(F.pmod(F.hash("id"), F.col("blocks")))
    begin = F.when(is_most, 0).otherwise(-F.col("most_blocks"))
    # Sketches are fetched for the members of open buckets only.
    rest = (
        labelled.join(open_keys, "key")
        .join(about, "id")
        .withColumn("side", side)
        .withColumn("other", F.explode(F.sequence(begin, F.col("blocks") - 1)))
        .select(
            "key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
            "id", "side", "label", "n", "sketch",
        )
    )
    dealt = rest.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "id")
    more = store(_pairs_in_blocks(dealt, percent).distinct(), "jaccard-pairs")
    verified = _verified(docs, text, key, n, percent, classes, more)
    links = store(verified if links is None else links.unionByName(verified), "jaccard-links")

    # From sets back to documents: a component is known by the smallest id of its sets.
    found = components(links).withColumnRenamed("id", "node")
    placed = store(
        classes.table.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "jaccard-placed"
    )
    smallest = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    reached = placed.join(smallest, "component").select("n", "h1", "h2", "component_id")
    rows = indexed.select("id", "n", "h1", "h2").join(reached, ["n", "h1", "h2"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).when(F.col("id").isNotNull(), F.col("component_id"))
    named = classes.table.select("node", "rep")
    between = (
        links.join(named.select(F.col("node").alias("a"), F.col("rep").alias("x")), "a")
        .join(named.select(F.col("node").alias("b"), F.col("rep").alias("y")), "b")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )
    wanted = [F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), "h1", "h2"]
    if complete:
        rows = rows.join(_link_counts(indexed, classes, links), ["n", "h1", "h2"], "left")
        wanted.append(F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"))
    return rows.select(*wanted), between


def _link_counts(indexed: DataFrame, classes: Classes, links: DataFrame) -> DataFrame:
    """(n, h1, h2, n_links): the other documents of each set, and those of the sets linked to it."""
    whole = ["n", "h1", "h2"]
    documents = indexed.where("n > 0 AND id IS NOT NULL").select("id", *whole).distinct()
    sizes = classes.table.join(documents.groupBy(*whole).agg(F.count(F.lit(1)).alias("size")), whole).select(
        "node", *whole, "size"
    )
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (
        both.join(sizes.select(F.col("node").alias("b"), "size"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("size").alias("linked"))
    )
    n_links = F.col("size") - 1 + F.coalesce("linked", F.lit(0))
    return sizes.join(linked, "node", "left").select(*whole, n_links.alias("n_links"))


def _sketched(pairs: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and parity sketches do not rule out."""
    left = about.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = about.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.concatenate([batch.column(c).to_numpy() for c in ("na", "nb")])
            words, values = (np.concatenate(x) for x in zip(*(_sketches(batch.column(c)) for c in ("sa", "sb")), strict=True))
            first = np.arange(batch.num_rows)
            keep = _near(sizes, words, values, first, first + batch.num_rows, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def _with_sets(docs: DataFrame, text: str, n: int, percent: int, names: list[str]) -> DataFrame:
    """``docs`` with the size and the two hashes of each row's set, in columns of these names."""
    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, T.LongType()) for name in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, _ = _tools(n, percent)
        for batch in slices(batches):
            found = [shingles(v.as_py()) for v in batch.column(text).cast(pa.binary())]
            whole = [(len(s), *set_hashes(s)) for s in found]
            added = [pa.array([w[i] for w in whole], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return docs.mapInArrow(run, schema)


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id. Of repeated rows one stays.

    Rows with an id that occurs again are judged each by its own text.
    """
    rows, _ = _linked(docs, text, key, n, percent)
    rows = store(rows, "jaccard-rows")
    others = store(
        rows.where(F.col(key) != F.col("component_id")).select(key, "n_shingles", "h1", "h2").distinct(), "jaccard-others"
    )
    again = store(
        rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key),
        "jaccard-again",
    )
    if again.isEmpty():
        return docs.join(_bounded(others.select(key)), key, "left_anti").select(*docs.columns)
    once = docs.join(_bounded(again), key, "left_anti").join(_bounded(others.select(key).distinct()), key, "left_anti")
    # Rows with an id that occurs again: one of each text. The row number is limited before the shuffle.
    whole = [free_name(name, docs.columns) for name in ("n__", "h1__", "h2__")]
    gone = others.join(_bounded(again), key, "left_semi").toDF(key, *whole)
    repeated = _with_sets(docs.join(_bounded(again), key, "left_semi").select(*docs.columns), text, n, percent, whole)
    left = repeated.join(_bounded(gone), [key, *whole], "left_anti")
    place = free_name("place", docs.columns)
    order = Window.partitionBy(key, F.xxhash64(text)).orderBy(F.lit(0))
    first = left.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return once.select(*docs.columns).unionByName(first.select(*docs.columns))
