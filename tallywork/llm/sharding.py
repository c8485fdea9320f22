"""Shards balanced in bytes, tokens and rows at once, by vector bin packing.

Rows with equal texts form a group and stay together as far as the balance allows. A
group has a vector (bytes, tokens, rows). Groups are placed one after the other, the one with
the largest share of a shard in any dimension first, each in the shard whose residual capacity
has the highest dot product with the group's vector, among the shards that have room for it in
all three dimensions; if none has, in the one that it overfills least. What is
left uneven by then is evened out by exchanges: two shards swap an item each, or one gives
one away, as long as that lowers the sum of squared deviations, in which bytes weigh most.

What is placed is bounded, whatever the corpus: a group that is heavier than a shard
divided by ``fine`` is an item of its own (there are fewer than shards * fine of them),
the others are bundled by a hash of the text into shards * fine bundles, which are placed like
groups, and a group heavier than a whole shard is split by row into pieces of half a shard, since no
placement could balance it whole. Only the items' sums come to the driver; rows never do.

Slots are counted per piece of an item, so no task numbers more rows than
``slot_rows`` or so, however many rows a shard has. Pieces and parts are dealt by row, so
rows that all have one key and one text are split as well.

Defined cases: a null text has size 8 and no tokens, and forms one group with the other
null texts; repeated rows are placed and numbered one by one; an empty table gives an
empty result. Columns of the input that clash with an output column are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import WORD, store, utf8_bytes

ROW_BYTES = 8
#: In exchanges: the weight of a deviation in bytes, tokens and rows, the gain below which none is made, and how many
#: there are at most for each shard; pairs of items are looked at in blocks of so many rows.
DIMENSION_WEIGHTS, LEAST_GAIN, EXCHANGES, PAIR_ROWS = (5.0, 1.0, 1.0), 1e-12, 50, 512
OUTPUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def dot_product_packing(items: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row of ``items`` (bytes, tokens, rows)."""
    total = items.sum(axis=0)
    shares = items / np.where(total > 0, total / shards, 1.0)  # of the capacity of a shard
    load = np.zeros((shards, items.shape[1]))
    placed = np.zeros(len(items), dtype=np.int64)
    for i in np.argsort(-shares.max(axis=1, initial=0), kind="stable"):
        item, residual = shares[i], 1.0 - load
        room = (residual >= item).all(axis=1)
        if room.any():
            best = int(np.where(room, residual @ item, -np.inf).argmax())
        else:
            best = int((load + item).max(axis=1).argmin())
        load[best] += item
        placed[i] = best
    return exchanged(shares, placed, shards)


def exchanged(shares: np.ndarray, placed: np.ndarray, shards: int, weights: tuple[float, ...] = DIMENSION_WEIGHTS) -> np.ndarray:
    """The placement after exchanges between the most uneven shards and those that are uneven the other way.

    At most EXCHANGES for each shard; an exchange looks at all pairs of items of two shards, in blocks.
    """
    shares, placed = shares * weights, placed.copy()
    sums = [np.bincount(placed, weights=shares[:, k], minlength=shards) for k in range(shares.shape[1])]
    off = np.stack(sums, axis=1) - shares.sum(axis=0) / shards

    def exchange(a: int, b: int) -> bool:
        """The best exchange between two shards, if any lowers the squares."""
        of_a, of_b = np.flatnonzero(placed == a), np.flatnonzero(placed == b)
        gives, takes = (np.vstack([shares[of], np.zeros(shares.shape[1])]) for of in (of_a, of_b))  # zeros: nothing
        apart = off[a] - off[b]
        # Moving d from a to b changes the sum of squares by 2 |d|^2 - 2 d (off[a] - off[b]), with d = give - take.
        cost_b = (takes * takes).sum(axis=1) + takes @ apart
        least, best = -LEAST_GAIN, None
        for begin in range(0, len(gives), PAIR_ROWS):
            part = gives[begin : begin + PAIR_ROWS]
            change = ((part * part).sum(axis=1) - part @ apart)[:, None] + cost_b - 2 * part @ takes.T
            at = int(change.argmin())
            if change.flat[at] < least:
                least, best = change.flat[at], (begin + at // len(takes), at % len(takes))
        if best is None:
            return False
        i, j = best
        off[a] -= gives[i] - takes[j]
        off[b] += gives[i] - takes[j]
        if i < len(of_a):
            placed[of_a[i]] = b
        if j < len(of_b):
            placed[of_b[j]] = a
        return True

    for _ in range(EXCHANGES * shards):
        uneven = np.argsort(-(off * off).sum(axis=1), kind="stable")[:3]
        if not any(exchange(a, b) for a in uneven for b in np.argsort(off @ off[a], kind="stable")[:4] if a != b):
            break
    return placed


def shard_documents(
    docs: DataFrame,
    shards: int = 24,
    text: str = "text",
    key: str = "doc_id",
    fine: int = 512,
    slot_rows: int = 1_000_000,
) -> DataFrame:
    """``key`` and the columns of OUTPUT for every row; the text itself is read once and never shuffled."""
    value = F.col(text)
    rows = store(
        docs.select(
            F.col(key).alias("key"),
            (utf8_bytes(value) + F.lit(ROW_BYTES)).alias("size"),
            F.coalesce(F.crc32(value.cast("binary")), F.lit(0)).cast("long").alias("crc"),
            F.coalesce(F.regexp_count(value, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
            F.xxhash64(value).alias("content"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    group = ["content", "size", "crc"]
    groups = store(
        rows.groupBy(*group).agg(
            F.sum("size").alias("g_bytes"), F.sum("tokens").alias("g_tokens"), F.count(F.lit(1)).alias("g_rows")
        ),
        "shard-groups",
    )
    total = groups.agg(F.sum("g_bytes")).first()[0] or 0
    capacity = max(1.0, total / shards)
    heavy = groups.where(F.col("g_bytes") > F.lit(capacity / fine)).select(
        *group,
        F.when(
            (F.col("g_bytes") > F.lit(capacity)) & (F.col("g_rows") > 1),
            F.least(F.col("g_rows"), F.ceil(F.col("g_bytes") / F.lit(capacity / 2))),
        )
        .otherwise(F.lit(1))
        .cast("int")
        .alias("pieces"),
    )
    bundles = shards * fine
    # heavy has fewer rows than shards * fine, by the bound on its bytes.
    located = rows.join(F.broadcast(heavy), group, "left").select(
        "key",
        "size",
        "crc",
        "tokens",
        "row",
        F.when(F.col("pieces").isNull(), F.pmod("content", F.lit(bundles)))
        .otherwise(F.xxhash64("content", "size", "crc", F.pmod(F.xxhash64("row"), F.col("pieces"))))
        .alias("item"),
    )
    sums = (
        located.groupBy("item")
        .agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
        .collect()  # at most 2 * shards * fine items and their pieces, whatever the corpus
    )
    sums.sort(key=lambda r: (-r.b, r.item))
    placed = dot_product_packing(np.array([[r.b, r.t, r.n] for r in sums], dtype=float).reshape(-1, 3), shards)
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [(r.item, int(s), max(1, -(-r.n // slot_rows))) for r, s in zip(sums, placed, strict=True)],
        "item long, shard int, parts int",
    )
    chunked = located.join(F.broadcast(plan), "item").select(
        "key", "size", "crc", "row", "shard", "item", F.pmod(F.xxhash64("row", F.lit(1)), F.col("parts")).alias("part")
    )
    chunk = ["shard", "item", "part"]
    # Counts per chunk come to one window per shard: as many rows as the shard has chunks.
    before = Window.partitionBy("shard").orderBy("item", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*chunk)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*chunk, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    )
    within = Window.partitionBy(*chunk).orderBy("key", "crc", "size", "row")
    return (
        chunked.withColumn("place", F.row_number().over(within))
        .join(offsets, chunk)
        .select(
            F.col("key").alias(key),
            F.col("size").cast("long").alias("size"),
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("first_slot") + F.col("place") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
