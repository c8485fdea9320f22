"""Exact distinct counts that can be added up: bitmaps over a dense numbering of keys.

Distinct counts of two loads cannot be added, bitmaps can: a load stores, per group, which keys it has
seen, 32,768 of them in one bitmap of 4 KB, and any set of loads is counted from their bitmaps alone. A
hot group has as many bitmaps as there are ranges of keys, so it is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywork.sources.tables import write_once


def dense_ids(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, id): a number from 0 without gaps for every non-null key; keys in ``known`` keep the number they have.

    Each task numbers the keys it has; only the number of keys per task meets in one place.
    """
    new, start = keys.where(F.col(key).isNotNull()).select(key).distinct(), 0
    if known is not None:
        last = known.agg(F.max("id")).first()[0]
        start = 0 if last is None else last + 1
        new = new.join(known, key, "left_anti")
    placed = write_once(new.withColumn("_at", F.monotonically_increasing_id()), "dense-ids")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_at") - F.shiftleft("_part", 33)
    ids = placed.join(F.broadcast(offsets), "_part").select(key, (place + F.col("_offset") + start).alias("id"))
    return ids if known is None else known.select(key, "id").unionByName(ids)


def id_bitmaps(rows: DataFrame, group: Sequence[str], id_: str, *sums: Column) -> DataFrame:
    """(group, bucket, bits, sums): the ids of each group as bitmaps; a null id sets no bit but its row counts in the sums."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id_) + 1)).alias("bits")
    return rows.groupBy(*group, F.bitmap_bucket_number(F.col(id_) + 1).alias("bucket")).agg(bits, *sums)


def merged_bitmaps(loads: Sequence[DataFrame], group: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Several loads as one: bitmaps are united, sums added."""
    both = reduce(DataFrame.unionByName, loads)
    return both.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), *(F.sum(s).alias(s) for s in sums))


def counted_bitmaps(bitmaps: DataFrame, group: Sequence[str], count: str, sums: Sequence[str] = ()) -> DataFrame:
    """(group, count, sums): how many ids each group has."""
    return bitmaps.groupBy(*group).agg(
        F.sum(F.bitmap_count("bits")).cast("bigint").alias(count), *(F.sum(s).cast("bigint").alias(s) for s in sums)
    )
