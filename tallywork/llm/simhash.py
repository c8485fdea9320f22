"""SimHash near-duplicates: whole texts to 64-bit fingerprints, compared exactly in tiles.

A text's fingerprint has a bit where more than half of its word shingles, repeats included,
have it in their XXH64. Fingerprints link at ``radius`` or fewer differing bits. Equal
fingerprints are one row from then on, however many documents have them.

Tiles. The fingerprint is cut into equal parts, and the population counts of the parts name
its tile. A differing bit changes one count by one, so the counts of two linked fingerprints
differ by ``radius`` or less in sum: only such tile pairs are compared, all others are
skipped. The number of parts is the least for which an average tile of random fingerprints
fits a block of ``tile_rows``, so the work for each fingerprint stays bounded while the corpus grows;
tiles with more rows are cut into several blocks. A task gets pairs of blocks and compares
them with numpy, exclusive-or and bit counts, a slice of rows at a time. Nothing is sampled
and no partner is skipped: every pair within the radius is met in exactly one block pair.

Links. A block pair gives back a spanning forest of its links, never more links than
fingerprints, so a large group of near copies does not become all its pairs. Components of
all forests are those of all links.

Defined cases: a text that is null or has no words has fingerprint zero and links like any
other; one with fewer words than a shingle is one shingle; repeated rows stay, each with
its own text's fingerprint, and an id that names several texts does not link them; rows
with a null id take part, but a component is named by its smallest id that is not null
(null if it has none); an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import slices, store
from tallywork.llm.components import components

BITS = 64
SEED = 42
RADIUS = 3
TILE_ROWS = 2048
#: A worker takes the words of about so many bytes of a long text at a time.
PART_BYTES = 1 << 20
#: Comparisons in one numpy step, and rows of a list that may be broadcast (at most 24 bytes each).
STEP_PAIRS, BROADCAST_ROWS = 1 << 20, 1_000_000
#: A fingerprint with more than one row in so many is joined by broadcast; there are fewer of them than this number.
HEAVY_SHARE = 1000

_blank = re.compile(rb"[\x20\x09-\x0D]").search


def _parts(text: bytes, part_bytes: int) -> Iterator[bytes]:
    """Pieces of a text that end at blanks."""
    begin = 0
    while begin < len(text):
        end = begin + part_bytes
        at = _blank(text, end) if end < len(text) else None
        end = at.start() if at else len(text)
        yield text[begin:end]
        begin = end


def bit_counts(text: bytes, words: int, part_bytes: int = PART_BYTES) -> tuple[np.ndarray, int]:
    """For each bit how many shingles of a UTF-8 text have it set, lowest bit first, and the number of shingles."""
    counts, n = np.zeros(BITS, dtype=np.int64), 0
    hashed = xxhash.xxh64_intdigest
    carried: list[bytes] = []

    def add(hashes: list[int]) -> None:
        nonlocal n
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts[:] += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)

    for part in _parts(text, part_bytes):
        found = carried + part.lower().split()  # bytes: A-Z only, and the six ASCII blanks
        if len(found) < words:
            carried = found
            continue
        joined = b" ".join(found)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ends = np.cumsum(lengths + 1) - 1
        begins = (ends - lengths)[: len(found) - words + 1].tolist()
        add([hashed(joined[a:b], SEED) for a, b in zip(begins, ends[words - 1 :].tolist(), strict=True)])
        carried = found[len(found) - words + 1 :] if words > 1 else []
    if n == 0 and carried:
        add([hashed(b" ".join(carried), SEED)])
    return counts, n


def fingerprint(text: bytes | None, words: int = 3, part_bytes: int = PART_BYTES) -> int:
    """The fingerprint as a signed 64-bit number, as Spark has it."""
    counts, n = bit_counts(text or b"", words, part_bytes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, print) of every row; the texts are read once and not shuffled."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [fingerprint(v.as_py(), words) for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(prints, pa.int64())], ["key", "print"])

    key_type = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {key_type}, print long")


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")


def parts_for(n: int, tile_rows: int = TILE_ROWS) -> int:
    """The least number of parts for which an average tile of ``n`` random fingerprints fits a block."""
    for parts in (1, 2, 4, 8):
        # A count of w random bits has the variance w / 4; 2 to the power of its entropy is about sqrt(2 pi e w / 4).
        if n <= tile_rows * math.sqrt(2 * math.pi * math.e * (BITS // parts) / 4) ** parts:
            return parts
    return 16


def _tile(fingerprint: Column, parts: int, radius: int) -> Column:
    """The population counts of the parts as the digits of one number; the base leaves room for ``radius`` more or less."""
    width = BITS // parts
    mask = F.lit((1 << width) - 1 if width < BITS else -1).cast("long")
    total = F.lit(0).cast("long")
    for i in range(parts):
        part = F.shiftrightunsigned(fingerprint, width * i).bitwiseAND(mask)
        total = total * (width + 1 + 2 * radius) + F.bit_count(part) + radius
    return total


def _near_tiles(parts: int, radius: int) -> list[int]:
    """What to add to a tile's number for each tile that is near it, itself included, each pair from one side only."""
    base = BITS // parts + 1 + 2 * radius
    found = [0]
    for distance in range(1, radius + 1):
        for changed in range(1, min(distance, parts) + 1):
            for where in itertools.combinations(range(parts), changed):
                for by in itertools.product(range(-distance, distance + 1), repeat=changed):
                    if 0 not in by and sum(map(abs, by)) == distance:
                        total = sum(d * base**w for d, w in zip(by, where, strict=True))
                        if total > 0:
                            found.append(total)
    return found


def _hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give both ends of every pair the same root in ``label``, which stays fully compressed."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label[:] = jumped


def block_links(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two blocks of distinct fingerprints, or inside one if they are the same."""
    both = left if same else np.concatenate([left, right])
    label = np.arange(len(both))
    rows = max(1, STEP_PAIRS // max(1, len(right)))
    for begin in range(0, len(left), rows):
        off = np.bitwise_count(left[begin : begin + rows, None] ^ right[None, :])
        i, j = np.nonzero(off <= radius)
        _hook(label, i + begin, j if same else j + len(left))
    linked = np.flatnonzero(label != np.arange(len(both)))
    return both[linked], both[label[linked]]


def links(prints: DataFrame, radius: int = RADIUS, parts: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): links between the distinct fingerprints in ``print`` whose components are those of all links within the radius."""
    spark = prints.sparkSession
    total = prints.count()
    parts = parts or parts_for(total, tile_rows)
    placed = prints.select("print", _tile(F.col("print"), parts, radius).alias("tile"))
    large = (
        placed.groupBy("tile")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > tile_rows)
        .select("tile", F.ceil(F.col("n") / tile_rows).alias("blocks"))
    )
    if total // tile_rows <= BROADCAST_ROWS:  # no more tiles than that can be large
        large = F.broadcast(large)
    blocks = store(
        placed.join(large, "tile", "left")
        .groupBy("tile", F.pmod(F.xxhash64("print"), F.coalesce("blocks", F.lit(1))).alias("block"))
        .agg(F.collect_list("print").alias("prints")),  # about tile_rows of them
        "simhash-tiles",
    )
    names = blocks.select("tile", "block")
    near = F.explode(F.transform(F.array(*map(F.lit, _near_tiles(parts, radius))), lambda d: d + F.col("tile")))
    other = names.select(F.col("tile").alias("tile_b"), F.col("block").alias("block_b"))
    pairs = store(
        names.select("tile", "block", near.alias("tile_b"))
        .join(other, "tile_b")
        .where((F.col("tile") != F.col("tile_b")) | (F.col("block") <= F.col("block_b"))),
        "simhash-pairs",
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pairs.count() // 256)
    second = blocks.select(F.col("tile").alias("tile_b"), F.col("block").alias("block_b"), F.col("prints").alias("right"))
    # A fixed number of tasks: comparing costs far more than its bytes, by which small partitions would be merged.
    joined = (
        pairs.join(blocks, ["tile", "block"])
        .repartition(tasks, "tile_b", "block_b")
        .join(second, ["tile_b", "block_b"])
        .select(
            (F.col("tile").eqNullSafe(F.col("tile_b")) & (F.col("block") == F.col("block_b"))).alias("same"),
            F.col("prints").alias("left"),
            "right",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            same = batch.column("same").to_pylist()
            for k in range(batch.num_rows):
                left, right = (
                    batch.column(c)[k].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in ("left", "right")
                )
                a, b = block_links(left, right, radius, same[k])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 3,
    radius: int = RADIUS,
    parts: int | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(key, fingerprint, component_id) for every row."""
    rows = store(fingerprints(docs, key, text, words), "simhash-prints")
    classes = store(
        rows.groupBy("print").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-classes"
    )
    found = links(classes.select("print"), radius, parts, tile_rows)
    # A node is a fingerprint under its smallest id, ids before null, so the smallest node of a component has its smallest id.
    node = F.struct(F.col("first").isNull().alias("nameless"), "first", "print")
    named = classes.select("print", node.alias("node"))
    ends = found.join(named.select(F.col("print").alias("a"), F.col("node").alias("x")), "a").join(
        named.select(F.col("print").alias("b"), F.col("node").alias("y")), "b"
    )
    labels = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    moved = labels.select(F.col("id.print").alias("print"), F.col("component.first").alias("smallest"))
    result = store(
        classes.join(moved, "print", "left").select("print", F.coalesce("smallest", "first").alias("component_id"), "n"),
        "simhash-components",
    )
    total = rows.count()
    heavy = F.col("n") > total / HEAVY_SHARE
    few = F.broadcast(result.where(heavy).select("print", "component_id"))  # fewer rows than HEAVY_SHARE
    most = result.where(~heavy).select("print", "component_id")
    # Copies of a frequent fingerprint stay where they are; no other one has more than a thousandth of all rows.
    labelled = rows.join(few, "print").unionByName(rows.join(few, "print", "left_anti").join(most, "print"))
    return labelled.select(F.col("key").alias(key), hex_digits(F.col("print")).alias("fingerprint"), "component_id")
