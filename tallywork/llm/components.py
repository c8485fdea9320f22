"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id that can be reached.

    Links and labels stay distributed; each round is written to the shared folder. A round
    takes over the smallest label among the neighbours and then the label of that label, so
    the rounds grow with the logarithm of the longest way, not with its length.
    """
    both = store(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), F.col("c").alias("other")), "b")
        lower = near.groupBy("a").agg(F.min("other").alias("other"))
        taken = labels.join(lower, "a").select("a", "c", F.least("c", "other").alias("d"))
        jumped = taken.join(labels.select(F.col("a").alias("d"), F.col("c").alias("e")), "d").select(
            "a", F.least("d", "e").alias("c"), (F.least("d", "e") < F.col("c")).alias("moved")
        )
        stored = store(jumped, "labels")
        labels = stored.select("a", "c")
        if not stored.agg(F.bool_or("moved")).first()[0]:
            return labels.select(F.col("a").alias("id"), F.col("c").alias("component"))
