"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per non-null key: the one with the greatest ``order``, NULLs last.

    ``tiebreak`` decides between rows with equal key and order, smallest first; by
    default it is every other column, which makes the result the same on every run.
    Pass ``()`` where (key, order) is known to be unique: columns nobody reads
    afterwards are then not shuffled.

    Spark limits the row number before the shuffle as well (WindowGroupLimit), so a
    task sends at most one row per key and a hot key costs no more than any other.
    A table stored in buckets of the key (``sources.snapshots``) is not shuffled at all.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in (key, order)]
    window = W.partitionBy(key).orderBy(F.col(order).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak])
    ranked = df.filter(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(window))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")
