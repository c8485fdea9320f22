"""Cleaning, number and band expressions on the edge rows where engines differ."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywork.functions import numeric, text
from tallywork.plans import marts
from tallywork.plans.staging import cast_losses, pay_number, years_number
from tallywork.sources.ingest import clean_strings, null_tokens
from tallywork.sources.schemas import CSV_NULLS, RAW_SCHEMA


def column(spark, values, name="c"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def values(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_sentinels_are_nulled_after_trimming_and_by_case(spark):
    given = ["  NA ", "N/A", "na", "NaN", "nan", "None", "none", "   ", "", None, " a b ", "\tx  \x1c"]
    expected = [None, None, "na", None, None, None, "none", None, None, None, "a b", "x"]
    assert [r.c for r in clean_strings(column(spark, given)).orderBy("i").collect()] == expected


def test_strip_removes_what_python_strips(spark):
    odd = [chr(i) for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000]
    given = [f"{c}a{c}b{c}" for c in odd]
    assert values(column(spark, given), text.strip(F.col("c"))) == [g.strip() for g in given]


def test_reader_nulls_match_before_trimming(spark):
    given = [*CSV_NULLS, " null", "<NA> ", "Null"]
    got = [r.c for r in null_tokens(column(spark, given)).orderBy("i").collect()]
    assert got == [None] * len(CSV_NULLS) + [" null", "<NA> ", "Null"]
    both = [r.c for r in clean_strings(null_tokens(column(spark, given))).orderBy("i").collect()]
    assert both == [None] * len(CSV_NULLS) + ["null", "<NA>", "Null"]


def test_cleaning_leaves_other_types_alone(spark):
    df = spark.createDataFrame([(1, 2.5, " x ")], "i int, d double, s string")
    cleaned = clean_strings(df)
    assert cleaned.dtypes == df.dtypes
    assert tuple(cleaned.first()) == (1, 2.5, "x")


def test_years_phrases(spark):
    given = ["Less than 1 year", "More than 50 years", "7", "7.5", None, "about 5", "less than 1 year"]
    expected = [0, 51, 7, Decimal("7.5"), None, None, None]
    assert values(column(spark, given), years_number("c")) == expected


def test_pay_text(spark):
    given = ["$85,000.50 EUR", "n/a", "-5", "1e5", "1.2.3", ".", "85.000,50", "", None, "9" * 40]
    expected = [Decimal("85000.50"), None, 5, 100000, None, None, Decimal("85.00050"), None, None, None]
    assert values(column(spark, given), pay_number("c")) == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("make,bad", [(pay_number, "1.2.3"), (years_number, "about 5")])
def test_fail_mode_stops_on_text_that_is_no_number(spark, make, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = column(spark, ["7", None, "1234.5"])
        assert values(good, make("c", "fail")) == values(good, make("c"))
        with pytest.raises(Exception, match="not a number"):
            column(spark, ["7", bad]).select(make("c", "fail")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_unknown_error_mode(spark):
    with pytest.raises(ValueError):
        pay_number("c", "ignore")


def test_cast_losses_counts_values_that_become_null(spark):
    raw = spark.createDataFrame(
        [
            {"response_id": "1", "years_code": "about 5", "years_code_pro": "7.5", "comp_total": "1.2.3"},
            {"response_id": "2", "years_code": "Less than 1 year", "years_code_pro": "x", "comp_total": "n/a"},
            {"response_id": "3", "years_code": None, "years_code_pro": "y", "comp_total": None},
        ],
        RAW_SCHEMA,
    )
    assert {r.column_name: r.row_count for r in cast_losses(raw).collect()} == {
        "years_code": 1,
        "years_code_pro": 2,
        "comp_total": 1,
        "job_sat": 0,
    }


def test_exponents_are_written_out_for_csv_input(spark):
    given = ["1e5", "1.5E3", "2e-2", "1e99", "85000", "1e5 EUR", "e5", None, "1e5\n"]
    expected = ["100000", "1500", "0.0200000000", "1e99", "85000", "1e5 EUR", "e5", None, "1e5\n"]
    assert values(column(spark, given), text.expand_exponent(F.col("c"))) == expected


def test_exponents_that_do_not_fit_are_no_numbers(spark):
    given = ["12e300", "9999e40", "1e28", "1e5", "-2.5e3", "1e5 EUR", "85,000"]
    df = column(spark, given)
    number = text.money_number(F.col("c"), "decimal(38,10)")
    assert [None if v is None else float(v) for v in values(df, number)] == [None, None, None, 1e5, 2.5e3, 15.0, 85000.0]
    raw = spark.createDataFrame([{"comp_total": c, "job_sat": "9" * (i * 9)} for i, c in enumerate(given)], RAW_SCHEMA)
    lost = {r.column_name: r.row_count for r in cast_losses(raw).collect()}
    assert (lost["comp_total"], lost["job_sat"]) == (3, 2)
    with pytest.raises(Exception, match="not a number"):
        df.select(text.money_number(F.col("c"), "decimal(38,10)", "fail")).collect()


def test_long_satisfaction_texts_count(spark):
    df = column(spark, ["8", "1" * 19, "2" * 30, "x"])
    mean = (8 + int("1" * 19) + int("2" * 30)) / 3
    assert df.select(marts.mean_if_numeric(F.col("c"))).first()[0] == pytest.approx(mean)
    with pytest.raises(Exception, match="not a number"):
        column(spark, ["9" * 39]).select(marts.mean_if_numeric(F.col("c"), on_error="fail")).collect()


def test_experience_band_edges(spark):
    df = column(spark, [None, "1", "1.99", "2", "4.99", "5", "10", "19.9", "20", "51"])
    expected = "Unknown,0-1 years,0-1 years,2-4 years,2-4 years,5-9 years,10-19 years,10-19 years,20+ years,20+ years"
    assert values(df, marts.experience_band(years_number("c"))) == expected.split(",")


def test_band_needs_a_label_per_bound(spark):
    with pytest.raises(ValueError):
        numeric.band(F.lit(1), [1, 2], ["a", "b"], "none")


def test_percent_rounds_halves_up_and_divides_by_zero_to_null(spark):
    df = spark.createDataFrame([(0, 1, 8), (1, 7, 16), (2, 1, 3), (3, 1, 2000), (4, 5, 0)], "i int, a long, b long")
    got = values(df, numeric.percent(F.col("a"), F.col("b")).cast("string"))
    assert got == ["12.5", "43.8", "33.3", "0.1", None]


def test_mean_counts_only_digit_texts(spark):
    df = column(spark, ["8", "7", "8.0", "NA", None, "7\n", "-3", "", "0"])
    assert df.select(marts.mean_if_numeric(F.col("c"))).first()[0] == 5.0
    assert column(spark, ["x", None]).select(marts.mean_if_numeric(F.col("c"))).first()[0] is None
