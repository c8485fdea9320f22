"""Dedupe, quantiles and ranks on small tables with known results."""

import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywork.operators.dedupe import latest_per_key
from tallywork.operators import quantiles
from tallywork.operators.quantiles import group_quantiles, sketched_quantiles
from tallywork.operators.ranking import rank_descending
from tallywork.plans import marts
from tallywork.registry.queries import bucketed

QUARTILES = marts.QUARTILES


def narrowing(df, keys, value, probs, min_count=1):
    """Small sketches and few values inside, so that brackets are narrowed several times."""
    return sketched_quantiles(df, keys, value, probs, min_count, k=200, inside_values=40)


WAYS = pytest.mark.parametrize("way", [group_quantiles, sketched_quantiles, narrowing])


def interpolated(values, p):
    values = sorted(values)
    position = p * (len(values) - 1)
    low = int(position)
    high = min(low + 1, len(values) - 1)
    return float(values[low]) + (position - low) * (float(values[high]) - float(values[low]))


def test_latest_row_wins_and_nulls_come_last(spark):
    rows = [("k", 1, "a"), ("k", 2, "b"), ("k", None, "c"), (None, 9, "d"), ("n", None, "z"), ("n", None, "y")]
    got = latest_per_key(spark.createDataFrame(rows, "key string, ts int, v string"), "key", "ts").collect()
    assert sorted(tuple(r) for r in got) == [("k", 2, "b"), ("n", None, "y")]


def test_ties_are_broken_the_same_way_whatever_the_partitioning(spark):
    rows = [(f"k{i % 7}", i % 2, f"v{i * 37 % 100}", None if i % 5 else "w") for i in range(400)]
    df = spark.createDataFrame(rows, "key string, ts int, v string, w string")
    results = {
        tuple(sorted(str(tuple(r)) for r in latest_per_key(part, "key", "ts").collect()))
        for part in (df.coalesce(1), df.repartition(8), df.repartition(5, "v"), df.orderBy(F.desc("v")))
    }
    assert len(results) == 1
    assert len(results.pop()) == 7


def test_buckets_give_the_same_rows_also_with_a_hot_key(spark):
    # one key holds a third of the rows, some repeat once, some are NULL
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 9000).cast("string"))
    df = spark.range(10_000).select(key.alias("key"), (F.col("id") % 40).alias("ts"), F.col("id").alias("v"))
    expected = Counter(map(tuple, latest_per_key(df, "key", "ts").collect()))
    got = latest_per_key(bucketed(df, "t", "key"), "key", "ts")
    assert got.columns == df.columns
    assert Counter(map(tuple, got.collect())) == expected


@WAYS
@pytest.mark.parametrize("dtype", ["decimal(18,10)", "double", "bigint"])
def test_quantiles_against_sorting(spark, dtype, way):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        kind = rng.random()
        # a third of all values are one value of one group; others are spread, negative, tiny or NULL
        if kind < 0.33:
            key, value = "hot", 50_000
        elif kind < 0.4:
            value = None
        elif kind < 0.7:
            value = rng.randint(-3000, 3000)
        else:
            value = rng.randint(0, 10**7)
        rows.append((key, i % 3 or None, value))
    df = spark.createDataFrame(rows, "k string, m int, value bigint").withColumn("value", F.col("value").cast(dtype))
    got = way(df, ["k", "m"], "value", QUARTILES | {"p0": 0.0, "p100": 1.0}).collect()
    groups = defaultdict(list)
    for k, m, v in rows:
        if v is not None:
            groups[k, m].append(v)
    assert len(got) == len(groups)
    for r in got:
        values = groups[r.k, r.m]
        assert (r.n, float(r.lowest), float(r.highest)) == (len(values), min(values), max(values))
        assert float(r.total) == sum(values)
        for name, p in (QUARTILES | {"p0": 0.0, "p100": 1.0}).items():
            assert r[name] == pytest.approx(interpolated(values, p), rel=1e-15, abs=1e-12)


@pytest.mark.parametrize("buckets_per_e", [1, 256, 10**6])
def test_quantiles_do_not_depend_on_the_buckets(spark, buckets_per_e):
    values = [1_000_000 + i / 1000 for i in range(997)]
    df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
    row = group_quantiles(df, ["k"], "v", QUARTILES, buckets_per_e=buckets_per_e).first()
    assert [row[name] for name in QUARTILES] == [interpolated(values, p) for p in QUARTILES.values()]


def test_a_hot_bucket_is_divided(spark):
    """A million distinct values inside one bucket: no range that is opened holds more than a few of them."""
    df = spark.range(2_000_000).select((F.col("id") % 2).alias("k"), ((F.col("id") / 2).cast("long") / 1e6 + 1e9).alias("v"))
    result = group_quantiles(df, ["k"], "v", QUARTILES)
    want = [pytest.approx(interpolated([i / 1e6 + 1e9 for i in range(1_000_000)], p)) for p in QUARTILES.values()]
    for row in result.collect():
        assert [row[name] for name in QUARTILES] == want
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"windowspecdefinition\(g#\d+, b#\d+L?, r#\d+L?, x#", plan)


def test_total_says_how_exact_it_is(spark):
    df = spark.createDataFrame([("g", "10000.0000000005"), ("g", "0.0000000001")], "k string, v string")
    for kind, total in (("decimal(18,10)", "10000.0000000006"), ("decimal(38,10)", "10000.000000")):
        row = group_quantiles(df.withColumn("v", F.col("v").cast(kind)), ["k"], "v", QUARTILES).first()
        assert str(row.total) == total


@WAYS
def test_quantiles_with_nan_and_infinities(spark, way):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([("g", v) for v in (1.0, inf, -inf, nan, 3.0)], "k string, v double")
    row = way(df, ["k"], "v", {"low": 0.0, "mid": 0.5, "high": 0.75}).first()
    assert (row.n, row.low, row.mid, row.high) == (5, -inf, 3.0, inf)


@WAYS
def test_quantiles_of_many_nans_and_infinities(spark, way):
    odd = "CASE id % 4 WHEN 0 THEN double('nan') WHEN 1 THEN double('inf') WHEN 2 THEN -double('inf') ELSE double(id) END"
    df = spark.range(8000).selectExpr("'g' AS k", f"{odd} AS v")
    row = way(df, ["k"], "v", {"a": 0.1, "b": 0.3, "c": 0.6, "d": 0.7, "e": 0.9}).first()
    # Each quarter: below all numbers, the numbers 3, 7, ... in order, above them, and NaN at last.
    assert (row.a, row.c, row.d) == (-float("inf"), float("inf"), float("inf")) and row.e != row.e
    assert row.b == pytest.approx(3 + 4 * (0.3 * 7999 - 2000))


def test_a_quantile_outside_its_bracket_stops_the_query(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MARGIN", -40.0)  # brackets on the wrong side of their rank
    df = spark.range(20_000).selectExpr("'g' AS k", "id AS v")
    with pytest.raises(Exception, match="outside the bracket"):
        sketched_quantiles(df, ["k"], "v", QUARTILES).collect()


def test_sketched_quantiles_of_values_in_any_order(spark):
    """A third of all rows one value, the rest distinct, in sorted, reversed and mixed order, in one hot group and many small ones."""
    value = "if(id % 3 = 0, 777.0D, double(id) * 1.5)"
    df = spark.range(90_000).selectExpr("if(id % 9 < 8, 'hot', concat('g', id % 900)) AS k", f"{value} AS v")
    want = {tuple(r) for r in group_quantiles(df, ["k"], "v", QUARTILES).collect()}
    for ordered in (df.orderBy("v"), df.orderBy(F.desc("v")), df.repartition(11), df.coalesce(1)):
        assert {tuple(r) for r in sketched_quantiles(ordered, ["k"], "v", QUARTILES).collect()} == want


@WAYS
def test_total_of_big_integers_does_not_overflow(spark, way):
    df = spark.createDataFrame([("g", 2**62), ("g", 2**62), ("g", 5)], "k string, v long")
    assert way(df, ["k"], "v", QUARTILES).first().total == 2**63 + 5


@WAYS
def test_small_groups_are_left_out_on_request(spark, way):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [r.k for r in way(df, ["k"], "v", QUARTILES, min_count=2).collect()] == ["a"]
    assert way(df.filter("v > 5"), ["k"], "v", QUARTILES).count() == 0


def test_rank_shares_and_skips(spark):
    df = spark.createDataFrame([("t", "a", 5), ("t", "b", 5), ("t", "c", 1), ("u", "d", 1)], "p string, x string, n long")
    got = {r.x: r["rank"] for r in rank_descending(df, "p", "n", "rank").collect()}
    assert got == {"a": 1, "b": 1, "c": 3, "d": 1}


def test_rank_equals_the_window_function(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["p", "q", None]), i, rng.choice([None, *range(20)])) for i in range(500)]
    df = spark.createDataFrame(rows, "p string, i int, n long")
    df.createOrReplaceTempView("ranked_input")
    expected = spark.sql("SELECT *, cast(rank() OVER (PARTITION BY p ORDER BY n DESC NULLS FIRST) AS bigint) r FROM ranked_input")
    got = rank_descending(df, "p", "n", "r")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))
    assert got.schema["r"].dataType == expected.schema["r"].dataType


def staging(spark, rows):
    columns = "country string, years_code_pro decimal(38,6), dev_type string, remote_work string, org_size string, comp_total_usd decimal(38,10)"
    return spark.createDataFrame(rows, columns)


def test_salary_segments(spark):
    pays = ["10000", "20000", "30000", "5000000", "40000.005"]
    rows = [("X", Decimal(3), "dev", None, "big", Decimal(p)) for p in pays]
    rows += [("X", Decimal(3), "dev", None, "big", Decimal(p)) for p in ("9999.99", "5000000.01")]  # out of range
    rows += [(None, Decimal(3), "dev", None, "big", Decimal(20000))] * 6  # no country
    rows += [("Y", None, "dev", "Remote", "big", Decimal(20000))] * 4  # too few
    got = marts.salary_segments(staging(spark, rows)).collect()
    assert [r.asDict() for r in got] == [
        {
            "country": "X",
            "experience_band": "2-4 years",
            "dev_type": "dev",
            "remote_work": None,
            "org_size": "big",
            "respondent_count": 5,
            "avg_salary_usd": 1020000.0,
            "median_salary_usd": 30000.0,
            "p25_salary_usd": 20000.0,
            "p75_salary_usd": 40000.01,
            "min_salary_usd": 10000.0,
            "max_salary_usd": 5000000.0,
        }
    ]


def test_display_orders(spark):
    df = spark.createDataFrame([("Y", 1), ("X", 3), ("A", 3)], "country string, respondent_count long")
    assert [r.country for r in marts.by_respondents(df).collect()] == ["A", "X", "Y"]


def test_ai_sentiment_share_is_all_or_nothing_by_default(spark):
    columns = "country string, dev_type string, ai_select string, ai_sent string, ai_threat string, job_sat string"
    rows = [("X", "d", "Yes", None, "Yes", "8"), ("X", "d", "Yes", None, "yes!", "7"), ("X", "d", "Yes", None, None, "x")] * 3
    rows += [("X", "d", None, None, "Yes", "1")] * 5  # neither question answered
    stg = spark.createDataFrame(rows, columns)
    got = {r.ai_threat: (r.respondent_count, r.avg_job_satisfaction, r.pct_see_ai_as_threat) for r in marts.ai_sentiment(stg).collect()}
    assert got == {"Yes": (3, 8.0, 100.0), "yes!": (3, 7.0, 100.0), None: (3, None, 0.0)}
    share = marts.ai_sentiment(stg, marts.SENTIMENT_KEYS[:-1]).first()
    assert (share.respondent_count, share.avg_job_satisfaction, share.pct_see_ai_as_threat) == (9, 7.5, 66.7)
