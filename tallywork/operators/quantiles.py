"""Exact quantiles and basic statistics per group, without gathering a group in one task.

``sketched_quantiles`` reads its input twice and shuffles hardly any of it; ``group_quantiles`` reads it once
and shuffles the count of every distinct value. The first suits stored tables, the second input that takes
work to derive. Both give the same result.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.sources.tables import write_once

# Size of a sketch, and what is added to a wanted rank on both sides, as a share of the values: so many times the
# error that 99 of 100 sketches of this size keep.
SKETCH_K = 2048
MARGIN = 3.0
# Steps into which a sketch's ranks are divided.
GRID = 256
# Values inside a bracket, distinct ones at most, that a group's last step sorts; and groups that are broadcast.
INSIDE_VALUES = 2_000_000
BROADCAST_GROUPS = 100_000

# Buckets per factor e of the value: a bucket spans under half a percent.
BUCKETS_PER_E = 256
# Equal ranges into which an opened bucket is divided.
RANGES = 65_536


def _bucket(value: Column, per_e: int) -> Column:
    """A bucket number that never falls as the value rises, known from the value alone."""
    x = value.cast("double")
    size = F.floor(F.log1p(F.abs(x)) * per_e)
    signed = F.when(x < 0, -size - 1).otherwise(size)
    # Never NULL, and Spark is told so: a null filter on one use of the counts would keep
    # the other from reusing their shuffle.
    return F.coalesce(F.when(F.isnan(x), F.lit(2**63 - 1)).otherwise(signed), F.lit(0))


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    min_count: int = 1,
    buckets_per_e: int = BUCKETS_PER_E,
    ranges: int = RANGES,
) -> DataFrame:
    """Per group: n, total, lowest, highest, and linearly interpolated quantiles of ``value``.

    ``probs`` names each quantile's column. NULL values are left out, a NULL key is
    a group of its own, and groups with fewer than ``min_count`` values are dropped.
    Quantiles are doubles; lowest and highest keep the type. The total adds up
    value times count: exact for integers and for decimals of up to 19 digits; wider ones
    keep at least six digits after the point (decimal(38,10) sums as decimal(38,6)).

    1. Equal values are counted before the shuffle, so a value shared by a third of
       all rows is one row per task; (group, value) pairs spread a hot group out.
    2. The counts are summed by value bucket. A group has a bounded number of
       buckets; their running totals tell which buckets hold the wanted ranks.
    3. Those buckets are divided into ``ranges`` equal ranges between their lowest and
       highest value, whose running totals tell which ranges hold the ranks.
    4. Only those ranges are opened: a running count inside each finds the values.

    So no task meets more values than a range holds: of a million distinct values in one
    bucket, about sixteen, and of 10^12 about 16 million.
    """
    group = F.struct(*keys).alias("g")  # one non-null join key, equal also where a key is NULL
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(group, F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("b", _bucket(F.col("v"), buckets_per_e))
    )

    per_bucket = counts.groupBy("g", "b").agg(
        F.sum("c").alias("bucket_n"),
        F.sum(F.col("v") * F.col("c").cast("decimal(18,0)")).alias("bucket_total"),
        F.min("v").alias("bucket_low"),
        F.max("v").alias("bucket_high"),
    )
    whole = W.partitionBy("g").orderBy("b").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.partitionBy("g").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    placed = per_bucket.select(
        "g",
        "b",
        "bucket_n",
        "bucket_low",
        "bucket_high",
        F.coalesce(F.sum("bucket_n").over(before), F.lit(0)).alias("start"),
        F.sum("bucket_n").over(whole).alias("n"),
        F.sum("bucket_total").over(whole).alias("total"),
        F.min("bucket_low").over(whole).alias("lowest"),
        F.max("bucket_high").over(whole).alias("highest"),
    )
    positions = {name: p * (F.col("n") - 1) for name, p in probs.items()}
    ranks = [f(position).cast("bigint") for position in positions.values() for f in (F.floor, F.ceil)]
    holds_rank = [(F.col("start") <= r) & (r < F.col("start") + F.col("bucket_n")) for r in ranks]
    wanted = placed.filter((F.col("n") >= min_count) & reduce(Column.__or__, holds_rank)).drop("bucket_n")

    # As doubles, since that is what a quantile is; values that are one double need not be told apart.
    low, high = F.col("bucket_low").cast("double"), F.col("bucket_high").cast("double")
    share_of_range = (F.col("x") - low) / (high - low)
    number = F.when(
        (high > low) & (high - low < float("inf")), F.least(F.floor(share_of_range * ranges), F.lit(ranges - 1))
    ).otherwise(F.lit(0))
    opened = (
        counts.select("g", "b", F.col("v").cast("double").alias("x"), "c")
        .join(wanted, ["g", "b"])
        .withColumn("r", F.coalesce(number, F.lit(0)))
    )
    carried = ["n", "total", "lowest", "highest"]
    per_range = opened.groupBy("g", "b", "r", "start", *carried).agg(F.sum("c").alias("range_n"))
    earlier = W.partitionBy("g", "b").orderBy("r").rowsBetween(W.unboundedPreceding, -1)
    begun = per_range.withColumn("start", F.col("start") + F.coalesce(F.sum("range_n").over(earlier), F.lit(0)))
    holds_rank = [(F.col("start") <= r) & (r < F.col("start") + F.col("range_n")) for r in ranks]
    ranges_wanted = begun.filter(reduce(Column.__or__, holds_rank)).select("g", "b", "r", "start", *carried)
    running = W.partitionBy("g", "b", "r").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = (
        opened.select("g", "b", "r", "x", "c")
        .join(ranges_wanted, ["g", "b", "r"])
        .withColumn("upto", F.col("start") + F.sum("c").over(running))
    )

    def at(rank: Column) -> Column:
        inside = (F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(inside, F.col("x")))

    quantiles = []
    for name, position in positions.items():
        low, high = at(F.floor(position).cast("bigint")), at(F.ceil(position).cast("bigint"))
        share = F.max(position - F.floor(position))
        quantiles.append(F.when((share == 0) | (low == high), low).otherwise(low + share * (high - low)).alias(name))
    out = ranked.groupBy("g", "n", "total", "lowest", "highest").agg(*quantiles)
    return out.select("g.*", "n", "total", "lowest", "highest", *probs)


def sketch_margin(k: int) -> float:
    """The error of a KLL sketch's rank, as a share of its values, times MARGIN."""
    return MARGIN * 2.296 / k**0.9723


def _grid(sketch: Column) -> Column:
    """The sketch's quantiles at GRID equal steps; a step is asked for by its place, since ranks must be constants there."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit(i / GRID) for i in range(GRID + 1))))


def _bracket(grid: Column, low: Column, high: Column, m: Column, margin: float) -> Column:
    """(low, high) between which the values of two ranks, from 0, of m values must lie."""
    below, above = F.floor(((low + 1) / m - margin) * GRID), F.ceil(((high + 1) / m + margin) * GRID)
    inf = F.lit(float("inf"))
    return F.struct(
        F.when(below >= 0, F.get(grid, below.cast("int"))).otherwise(-inf).alias("low"),
        F.when(above <= GRID, F.get(grid, above.cast("int"))).otherwise(inf).alias("high"),
    )


def sketched_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    min_count: int = 1,
    k: int = SKETCH_K,
    inside_values: int = INSIDE_VALUES,
) -> DataFrame:
    """``group_quantiles`` for a stored table: n, total, lowest, highest and exact quantiles of ``value`` per group.

    1. One pass: count, total, range and a mergeable sketch (KLL) per group. The sketch gives a bracket for each wanted
       quantile, wide enough that it holds the quantile in all but about one of 10^13 cases.
    2. One pass: values outside all brackets are only counted, values inside are counted one by one. The
       counts in order tell which value has the wanted rank. Only sketches and what is
       inside the brackets, about a sixtieth of the values for each quantile, is shuffled.

    Where a group is so large that a bracket would hold more than ``inside_values``, a further pass sketches the inside
    of each bracket first. If a rank is not in its bracket after all, the query stops and can be run again: no
    wrong value is ever given. The total adds up integers and decimals exactly, in 38 digits.
    """
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    fraction = df.schema[value].dataType
    summed = "decimal(20,0)" if whole else f"decimal(38,{fraction.scale})" if isinstance(fraction, T.DecimalType) else "double"
    margin = sketch_margin(k)
    rows = df.filter(F.col(value).isNotNull()).select(
        F.struct(*keys).alias("g"), F.col(value).alias("v"), F.col(value).cast("double").alias("x")
    )
    ranks = [(F.floor(p * (F.col("n") - 1)).cast("bigint"), F.ceil(p * (F.col("n") - 1)).cast("bigint")) for p in probs.values()]
    # NaN is the greatest value, which for a bracket is as good as infinity.
    ordered = F.when(F.isnan("x"), F.lit(float("inf"))).otherwise(F.col("x"))
    stats = rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("v").cast(summed)).alias("total"),
        F.min("v").alias("lowest"),
        F.max("v").alias("highest"),
        F.kll_sketch_agg_double(ordered, F.lit(k)).alias("sketch"),
    )
    # A group of few values is all inside.
    begun = stats.where(F.col("n") >= min_count).withColumn("grid", F.when(F.col("n") > k, _grid(F.col("sketch"))))
    opened = F.struct(F.lit(-float("inf")).alias("low"), F.lit(float("inf")).alias("high"))
    n = F.col("n")
    found = [F.when(n > k, _bracket(F.col("grid"), low, high, n, margin)).otherwise(opened) for low, high in ranks]
    seen = Observation(uuid.uuid4().hex)
    brackets = begun.withColumn("brackets", F.array(*found)).drop("sketch", "grid")
    groups = write_once(brackets.observe(seen, F.count(F.lit(1)).alias("n"), F.max("n").alias("most")), "quantile-brackets")
    n_groups, most = seen.get["n"], seen.get["most"] or 0
    join = F.broadcast if n_groups <= BROADCAST_GROUPS else lambda table: table
    width = 2 * (margin + 1 / GRID)
    while most * width > inside_values:
        met = rows.select("g", ordered.alias("x")).join(join(groups.select("g", "brackets")), "g")
        groups = _narrowed(met, groups, ranks, k, margin)
        most = most * width

    brackets = [F.get("brackets", F.lit(j)) for j in range(len(ranks))]
    inside = reduce(Column.__or__, [F.coalesce(F.col("x").between(b["low"], b["high"]), F.lit(False)) for b in brackets])
    inside = inside | F.isnan("x")
    passed = reduce(Column.__add__, [F.coalesce(F.col("x") > b["high"], F.lit(False)).cast("int") for b in brackets])
    # Values between two brackets are in one stretch, so the least of them stands for all in the order.
    counts = (
        rows.join(join(groups.select("g", "brackets")), "g")
        .groupBy("g", F.when(inside, F.col("x")).alias("x"), F.when(~inside, passed).alias("gap"))
        .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("place"))
    )
    in_order = W.partitionBy("g").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    all_rows = W.partitionBy("g").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = counts.withColumn("upto", F.sum("c").over(in_order)).withColumn("n", F.sum("c").over(all_rows))

    def at(rank: Column) -> Column:
        holds = (F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto")) & F.col("gap").isNull()
        missed = F.raise_error(F.lit("a quantile is outside the bracket of its sketch: run the query again")).cast("double")
        return F.coalesce(F.max(F.when(holds, F.col("x"))), missed)

    quantiles = []
    for (name, p), (low, high) in zip(probs.items(), ranks, strict=True):
        lower, upper, position = at(low), at(high), p * (F.col("n") - 1)
        share = F.max(position - F.floor(position))
        quantiles.append(F.when((share == 0) | (lower == upper), lower).otherwise(lower + share * (upper - lower)).alias(name))
    found = ranked.groupBy("g").agg(*quantiles)
    facts = groups.select("g", "n", "total", "lowest", "highest")
    return found.join(join(facts), "g").select("g.*", "n", "total", "lowest", "highest", *probs)


def _narrowed(rows: DataFrame, groups: DataFrame, ranks: Sequence[tuple[Column, Column]], k: int, margin: float) -> DataFrame:
    """``groups`` with brackets inside the ones they have, from a sketch of the values (g, x, brackets) in each."""
    brackets = [F.get("brackets", F.lit(j)) for j in range(len(ranks))]
    sums = []
    for j, b in enumerate(brackets):
        within = F.when(F.col("x").between(b["low"], b["high"]), F.col("x"))
        sums += [
            F.count_if(F.col("x") < b["low"]).alias(f"below{j}"),
            F.count(within).alias(f"m{j}"),
            F.kll_sketch_agg_double(within, F.lit(k)).alias(f"sketch{j}"),
        ]
    counted = rows.groupBy("g").agg(*sums)
    counted = counted.withColumns({f"grid{j}": F.when(F.col(f"m{j}") > k, _grid(F.col(f"sketch{j}"))) for j in range(len(ranks))})
    nearer = []
    for j, (low, high) in enumerate(ranks):
        below, m, wide = F.col(f"below{j}"), F.col(f"m{j}"), brackets[j]
        low, high = low - below, high - below
        new = _bracket(F.col(f"grid{j}"), low, high, m, margin)
        clipped = F.struct(F.greatest(new["low"], wide["low"]).alias("low"), F.least(new["high"], wide["high"]).alias("high"))
        # A rank that is not there is found out in the last step; the wider bracket stays then.
        nearer.append(F.when((m > k) & (low >= 0) & (high < m), clipped).otherwise(wide))
    narrowed = groups.join(counted, "g").withColumn("brackets", F.array(*nearer)).select(*groups.columns)
    return write_once(narrowed, "quantile-brackets")
