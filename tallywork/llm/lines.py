"""Removal of lines that many sites share, by the number of distinct sites of each line.

The sites of each line are gathered in a HyperLogLog sketch, merged map side first, so a
line that a third of all rows carry costs a task one sketch. Where the estimate is well
above or below the limit it decides; lines near the limit get an exact distinct count.
Boilerplate, i.e. a line on as many sites as its limit or more, is removed everywhere but in the
document with the smallest id that has it, so no content leaves the corpus altogether
and copied documents do not all vanish.

The limit follows the corpus and the line: a share of the corpus's sites, less for lines of
more words, between a least and a most (``Spread``). A short line repeats by chance, so it needs
many sites; a passage of fifty words does not, so two sites are enough in a small corpus.

A line is known by a 64-bit hash of its text without outer blanks. The work for a text grows
with its lines: what goes is a list of places, and the rest is put together in one pass.

Defined cases: blank lines are never boilerplate and stay; a null text stays null; a null
site is one nameless site; rows with a null id never count as first; repeated rows are
cleaned alike; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import WORD, free_name, store

# Fixed value: the six ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Spread:
    """Lines of at least ``words`` words are boilerplate from ``share`` of the sites on, but not below ``least`` or above ``most``."""

    words: int
    share: float
    least: int
    most: int

    def limit(self, sites: int) -> int:
        return min(max(self.least, math.ceil(round(self.share * sites, 6))), self.most)


#: Lines of few words, of a sentence or more, and whole passages.
SPREADS = (Spread(1, 0.4, 3, 10), Spread(8, 0.25, 3, 10), Spread(50, 0.1, 2, 10))
SKETCH_LOG_SIZE = 12
#: Lists of boilerplate lines up to so many rows (16 bytes each) are broadcast; longer ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def line_key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(BLANKS)))


def _bounded(lines: DataFrame) -> DataFrame:
    """A stored list of lines, marked for broadcast if it is short enough."""
    return F.broadcast(lines) if lines.count() <= BROADCAST_ROWS else lines


def count_sites(site: Column) -> Column:
    return F.count_distinct(F.coalesce(site.cast("string"), F.lit("")))


def boilerplate(lines: DataFrame) -> DataFrame:
    """(line, first) of the lines on at least ``limit`` sites; ``lines`` has columns id, site, line, limit."""
    limit = F.col("limit")
    band = F.greatest(F.lit(1.0), limit * (5 * 1.04 / 2 ** (SKETCH_LOG_SIZE / 2)))
    spread = store(
        lines.groupBy("line")
        .agg(
            F.hll_sketch_agg("site", F.lit(SKETCH_LOG_SIZE)).alias("sites"),
            F.min("id").alias("first"),
            F.max("limit").alias("limit"),
        )
        .select("line", "first", "limit", F.hll_sketch_estimate("sites").alias("about"))
        .where(F.col("about") >= limit - band),
        "line-spread",
    )
    near = spread.where(F.col("about") <= limit + band).select("line", "first")
    exact = (
        lines.join(_bounded(near), "line")
        .groupBy("line")
        .agg(F.count_distinct("site").alias("n"), F.min("first").alias("first"), F.max("limit").alias("limit"))
        .where(F.col("n") >= limit)
        .select("line", "first")
    )
    return store(spread.where(F.col("about") > limit + band).select("line", "first").unionByName(exact), "boilerplate")


def remove_boilerplate(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    site: str = "source",
    spreads: Sequence[Spread] = SPREADS,
    counts: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """``docs`` with cleaned texts; ``counts`` names two added columns: lines before, and lines removed.

    ``spreads`` say from how many sites on a line is boilerplate; of those that fit its words the one with most words counts.
    """
    value = F.col(text)
    whole, bad, id_, content_ = (free_name(n, docs.columns) for n in ("whole__", "bad__", "id__", "content__"))
    n_sites = docs.agg(count_sites(F.col(site))).first()[0]
    every = F.split(value, "\n", -1)
    blank = lambda x: F.btrim(x, F.lit(BLANKS)) == ""

    def limit(words: Column) -> Column:
        # Lines of fewer words than any spread asks for stay.
        tiers = sorted(spreads, key=lambda t: -t.words)
        return F.coalesce(*(F.when(words >= t.words, F.lit(t.limit(n_sites))) for t in tiers))

    keyed = F.transform(
        F.filter(every, lambda x: ~blank(x)),
        lambda x: F.struct(line_key(x).alias("line"), limit(F.regexp_count(x, F.lit(WORD))).alias("limit")),
    )
    lines = (
        docs.select(
            F.col(key).alias("id"),
            F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
            F.explode(keyed).alias("at"),
        )
        .select("id", "site", "at.line", "at.limit")
        .where("limit IS NOT NULL")
    )
    found = boilerplate(lines)
    # The text is hashed before its lines become rows, not once for each of them.
    places = docs.select(
        F.col(key).alias("id"),
        F.xxhash64(value).alias("content"),
        F.transform(every, lambda x: F.when(~blank(x), line_key(x))).alias("keys"),
    ).select("id", "content", F.posexplode("keys").alias("place", "line"))
    hits = (
        places.join(_bounded(found), "line")
        .where(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
        .groupBy(F.col("id").alias(id_), F.col("content").alias(content_))
        .agg(F.collect_set("place").alias(bad))  # at most the lines of one text
    )
    marked = docs.withColumn(whole, F.xxhash64(value))
    joined = marked.join(hits, F.col(key).eqNullSafe(F.col(id_)) & (F.col(whole) == F.col(content_)), "left")
    n_all = F.coalesce(F.size(every), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(bad))
    # The lambda binds the lines and the places that stay, so that neither is made again for each line.
    bound = F.array(F.struct(every.alias("lines"), kept.alias("places")))
    rest = F.transform(bound, lambda s: F.array_join(F.transform(s["places"], lambda i: F.get(s["lines"], i)), "\n"))
    out = {
        text: F.when(F.col(bad).isNull(), value).otherwise(F.get(rest, F.lit(0))),
        counts[0]: F.when(value.isNull(), 0).otherwise(n_all).cast("long"),
        counts[1]: F.when(F.col(bad).isNull(), 0).otherwise(F.size(bad)).cast("long"),
    }
    return joined.withColumns(out).drop(whole, bad, id_, content_)
