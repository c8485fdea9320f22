"""Rank within large partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rank_descending(df: DataFrame, partition: str, order: str, rank: str) -> DataFrame:
    """Add RANK() by ``order`` descending within ``partition``: ties share, gaps follow.

    A row's rank is one more than the number of rows with a greater value, so the
    window runs over the distinct values and their counts and not over the rows.
    Where ``order`` is itself a row count, N rows have at most sqrt(2N) of those.
    """
    per_value = df.groupBy(F.col(partition).alias("_p"), F.col(order).alias("_o")).agg(F.count(F.lit(1)).alias("_n"))
    above = W.partitionBy("_p").orderBy(F.col("_o").desc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    ranks = per_value.select("_p", "_o", (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias(rank))
    same = F.col(partition).eqNullSafe(F.col("_p")) & F.col(order).eqNullSafe(F.col("_o"))
    return df.join(ranks, same).drop("_p", "_o")
