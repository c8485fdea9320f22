"""Distinct counts by bitmaps against plain ones: hot groups, several loads, nulls, repeats."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallywork.operators.bitmaps import counted_bitmaps, dense_ids, id_bitmaps, merged_bitmaps
from tallywork.plans import marts


def test_ids_are_dense_and_stay(spark):
    first = dense_ids(spark.range(0, 5000, 1, 7).selectExpr("if(id % 5 = 0, null, concat('k', id % 3000)) AS k"), "k")
    ids = {r.k: r.id for r in first.collect()}
    assert sorted(ids.values()) == list(range(len(ids))) and len(ids) == 2400
    both = dense_ids(spark.range(2000, 6000).selectExpr("concat('k', id) AS k"), "k", first)
    more = {r.k: r.id for r in both.collect()}
    assert sorted(more.values()) == list(range(len(more))) and more.items() >= ids.items()
    assert dense_ids(first.limit(0), "k").count() == 0
    one = dense_ids(spark.createDataFrame([("a",)], "k string"), "k")
    assert sorted(map(tuple, dense_ids(spark.createDataFrame([("b",), ("a",)], "k string"), "k", one).collect())) == [("a", 0), ("b", 1)]
    assert sorted(r.id for r in dense_ids(first.select("k").limit(3), "k", first.limit(0)).collect()) == [0, 1, 2]


def test_counts_equal_distinct_counts_over_loads(spark):
    """A hot group with a third of the rows over more ids than one bitmap holds; ids that come again in other loads."""
    rows = spark.range(150_000).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 11)) AS g", "(id * 7919) % 90000 AS id", "id % 4 AS load")
    rows = rows.unionByName(spark.createDataFrame([("nobody", None, 0), ("hot", None, 1)], "g string, id long, load long"))
    loads = [id_bitmaps(rows.where(F.col("load") == k), ["g"], "id", F.count(F.lit(1)).alias("n")) for k in range(4)]
    whole = merged_bitmaps(loads, ["g"], ["n"])
    assert whole.where("g = 'hot'").count() >= 3  # spread by range of ids
    got = {r.g: (r.users, r.n) for r in counted_bitmaps(whole, ["g"], "users", ["n"]).collect()}
    want = rows.groupBy("g").agg(F.countDistinct("id").alias("users"), F.count(F.lit(1)).alias("n"))
    assert got == {r.g: (r.users, r.n) for r in want.collect()}
    assert got["nobody"] == (0, 1)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_usage_of_loads_equals_usage_of_all_rows(spark, order):
    answers = ["C;Java", "Java", "C; C", "", None, "Rust;C"]
    rows = [
        (f"r{i % 40}" if i % 9 else None, answers[i % 6], answers[(i + 2) % 6], answers[(i + 1) % 6], answers[(i + 4) % 6], i % 3)
        for i in range(240)
    ]
    columns = "response_id string, language_have_worked string, language_want_work string, database_have_worked string, database_want_work string, load int"
    table = spark.createDataFrame(rows, columns)
    ids, loads = None, []
    for load in order:
        new = table.where(F.col("load") == load)
        ids = dense_ids(new, "response_id", ids)
        loads.append(marts.usage_load(new, ids))
    stg = table.selectExpr("*", "'X' AS country", "1 AS years_code_pro", "2 AS comp_total_usd", "'d' AS dev_type")
    want = marts.exploded_usage(marts.languages_exploded(stg), "language", "Language").unionByName(
        marts.exploded_usage(marts.databases_exploded(stg), "database_name", "Database")
    )
    got = marts.loads_usage(loads).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
