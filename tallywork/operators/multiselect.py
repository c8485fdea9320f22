"""Delimited multi-select answers: one row per item, and counts per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.text import mentions


def explode_items(df: DataFrame, have: str, item: str, keep: Sequence[str]) -> DataFrame:
    """One row per non-empty, space-trimmed item of ``have``; rows without items vanish.

    The outer form is used because Spark would otherwise infer a size filter from
    the explode and split the text twice; the item filter drops the same rows.
    """
    parts = df.select(*keep, F.explode_outer(F.split(F.col(have), ";")).alias("_part"))
    return parts.withColumn(item, F.trim("_part")).drop("_part").filter(F.col(item) != "")


def explode_multiselect(
    df: DataFrame, have: str, want: str, item: str, keep: Sequence[str], match: str = "substring"
) -> DataFrame:
    """``explode_items`` plus ``wants_to_continue``: is the item among the wanted ones?

    ``match="substring"`` looks for the item anywhere in the wanted text, whatever
    the case, so 'Java' is found in 'JavaScript'; ``"exact"`` compares whole items.
    """
    if match not in ("substring", "exact"):
        raise ValueError(f"match must be 'substring' or 'exact', not {match!r}")
    # Lowered or split once per answer, before it is repeated per item.
    wanted = F.lower(F.col(want)) if match == "substring" else F.split(_tidy(F.col(want)), ";")
    items = explode_items(df.withColumn("_wanted", wanted), have, item, [*keep, "_wanted"])
    if match == "substring":
        flag = mentions(F.col("_wanted"), F.col(item))
    else:
        flag = F.coalesce(F.array_contains(F.col("_wanted"), F.col(item)), F.lit(False))
    return items.select(*keep, item, flag.alias("wants_to_continue"))


def trimmed_items(have: Column) -> Column:
    """The items that ``explode_items`` makes rows of, as an array in their row."""
    return F.array_remove(F.split(_tidy(have), ";"), "")


def item_flags(have: Column, want: Column) -> Column:
    """What ``explode_multiselect`` says of each of these items by substring, in their order."""
    wanted = F.lower(want)
    plain = F.transform(trimmed_items(have), lambda x: F.coalesce(F.contains(wanted, F.lower(x)), F.lit(False)))
    # As in mentions(): only a list with LIKE's special characters has items that need a pattern.
    special = have.contains("%") | have.contains("_") | have.contains("\\")
    return F.when(special, F.transform(trimmed_items(have), lambda x: mentions(wanted, x))).otherwise(plain)


def _tidy(c: Column) -> Column:
    """Text without spaces around its items; text that has none is left alone unread by the regex."""
    spaced = c.contains("; ") | c.contains(" ;")
    return F.trim(F.when(spaced, F.regexp_replace(c, r"(?<! ) ++(?=;)|(?<=;) ++", "")).otherwise(c))


def item_flag_counts(df: DataFrame, lists: Sequence[tuple[str, str, str]]) -> DataFrame:
    """How often each item occurs, by list, by first mention in its row, and by wanted or not.

    ``lists`` holds (tag, have column, want column). Result: tag, item, is_first,
    is_wanted, n: at most four rows per item, whatever the input size. The sum of n
    over ``is_first`` is the number of rows that name the item, so where a row is a
    respondent, respondents are counted without shuffling (item, respondent) pairs.

    All lists are read in one pass. Sorting the items of a row puts repeats side by
    side; only then does a row compare each item with the one before it.
    """
    stacked = F.stack(F.lit(len(lists)), *[c for t, h, w in lists for c in (F.lit(t), F.col(h), F.col(w))])
    long = df.select(stacked.alias("tag", "have", "want")).filter(F.col("have").isNotNull())
    sorted_items = F.sort_array(F.split(_tidy(F.col("have")), ";"))
    long = long.select("tag", F.lower("want").alias("wanted"), sorted_items.alias("items"))
    items = long.select("tag", "wanted", "items", F.posexplode_outer("items").alias("pos", "item"))
    flagged = items.filter(F.col("item") != "").select(
        "tag",
        "item",
        (~F.get("items", F.col("pos") - 1).eqNullSafe(F.col("item"))).alias("is_first"),
        mentions(F.col("wanted"), F.col("item")).alias("is_wanted"),
    )
    return flagged.groupBy("tag", "item", "is_first", "is_wanted").agg(F.count(F.lit(1)).alias("n"))
