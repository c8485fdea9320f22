"""Checks and tests, on good input and on input made to fail each of them."""

import pytest
from pyspark.sql import functions as F

from tallywork.operators.multiselect import explode_multiselect
from tallywork.plans import marts, quality
from tallywork.sources.schemas import RAW_SCHEMA


def raw_rows(spark, rows):
    return spark.createDataFrame([{name: row.get(name) for name in RAW_SCHEMA.names} for row in rows], RAW_SCHEMA)


def counts(report):
    return {r.check_name: r.row_count for r in report.collect()}


def test_six_checks(spark):
    raw = raw_rows(
        spark,
        [
            {"response_id": None, "country": "X", "comp_total": "1", "years_code_pro": "7"},
            {"response_id": None, "country": None, "comp_total": "1", "years_code_pro": "7.5"},
            {"response_id": "1", "country": "X", "comp_total": None, "years_code_pro": "Less than 1 year"},
            {"response_id": "1", "country": "X", "comp_total": None, "years_code_pro": "about 5"},
            {"response_id": "1", "country": "X", "comp_total": "", "years_code_pro": None},
            {"response_id": "2", "country": "X", "comp_total": "1", "years_code_pro": "More than 50 years"},
        ],
    )
    report = quality.with_severity(quality.run_checks(raw))
    assert counts(report) == {
        "null_response_id": 2,
        "duplicate_response_id": 2,  # "1", and NULL as a key of its own
        "null_country": 1,
        "null_comp_total": 2,
        "invalid_years_code_pro": 2,  # "7.5" and "about 5"
        "total_rows_loaded": 6,
    }
    severity = {r.check_name: r.severity for r in report.collect()}
    assert severity.pop("total_rows_loaded") == "info"
    assert set(severity.values()) == {"warn"}


def test_checks_on_clean_and_on_empty_input(spark):
    clean = raw_rows(spark, [{"response_id": str(i), "country": "X", "comp_total": "1"} for i in range(5)])
    report = quality.with_severity(quality.run_checks(clean)).collect()
    assert {r.check_name: r.row_count for r in report if r.row_count} == {"total_rows_loaded": 5}
    assert {r.severity for r in report} == {"info"}
    empty = counts(quality.run_checks(clean.limit(0)))
    assert len(empty) == 6 and set(empty.values()) == {0}


def layers(spark, broken):
    def table(columns, good, bad):
        return spark.createDataFrame([good, bad if broken else good], columns)

    exploded = "response_id string, {} string, wants_to_continue boolean"
    staging = spark.createDataFrame([("1",), ("1",), (None,)] if broken else [("1",), ("2",)], "response_id string")
    return {
        "raw": table("response_id string", ("1",), (None,)),
        "staging": staging,
        "languages": table(exploded.format("language"), ("1", "a", True), (None, None, None)),
        "databases": table(exploded.format("database_name"), ("1", "a", False), (None, None, True)),
        "salary": table("respondent_count long", (5,), (None,)),
        "adoption": table("tech_name string, tech_type string", ("a", "Language"), (None, "Tool")),
        "sentiment": table("respondent_count long", (5,), (None,)),
    }


def test_thirteen_tests_pass_on_good_layers(spark):
    results = quality.run_tests(layers(spark, broken=False)).collect()
    assert len(results) == len({r.test_name for r in results}) == 13
    assert all(r.failures == 0 and not r.should_warn and not r.should_error for r in results)


def test_tests_fail_on_broken_layers(spark):
    results = quality.run_tests(layers(spark, broken=True)).collect()
    passed = {r.test_name for r in results if r.failures == 0}
    # a NULL flag is no value outside the list, and a tech_type is there in every row
    assert passed == {"accepted_values.languages.wants_to_continue", "not_null.adoption.tech_type"}
    assert all(r.should_warn == r.should_error == (r.failures != 0) for r in results)


def test_accepted_booleans_can_fail(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (None,)], "flag boolean")
    assert quality.failing_values(df, "flag", (True, False)).count() == 0
    assert [tuple(r) for r in quality.failing_values(df, "flag", (True,)).collect()] == [(False, 2)]


def test_failures_count_distinct_values_not_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "v string")
    test = quality.TableTest("t", "v", "accepted_values", ("a",))
    assert quality.run_tests({"t": df}, [test]).first().failures == 2


def test_counts_of_exploded_layers_make_only_what_they_look_at(spark):
    """Wishes are looked for by the one test about them; its count is that of the exploded rows, also where some are bad."""
    rows = [("1", "C; Java ;a_b;;x\\\\", "java;axb;c"), ("2", " ;C", None), ("3", None, "C"), (None, "C;C", "D"), ("5", "a%;", "abc")]
    df = spark.createDataFrame(rows, "response_id string, language_have_worked string, language_want_work string")
    tests = [
        quality.TableTest("languages", "response_id", "not_null"),
        quality.TableTest("languages", "language", "not_null"),
        quality.TableTest("languages", "wants_to_continue", "accepted_values", (True,)),
    ]
    taken = quality.test_counts("staging", tests)
    assert [t.name for t in tests if "lower" in str(taken[t.name])] == [tests[2].name]
    exploded = explode_multiselect(df, *marts.LANGUAGE[1:], "language", ["response_id"])
    expected = exploded.selectExpr(
        "count_if(response_id IS NULL)", "count_if(language IS NULL)", "count_if(NOT wants_to_continue)"
    ).first()
    got = df.select(*(taken[t.name] for t in tests)).first()
    assert tuple(got) == tuple(expected) and got[2] > 0


def test_counts_of_wishes_that_must_not_be_null(spark):
    test = quality.TableTest("languages", "wants_to_continue", "not_null")
    df = spark.createDataFrame([("C;Java", "C"), (None, "C"), ("a_b", None)], "language_have_worked string, language_want_work string")
    assert df.select(quality.test_counts("staging", [test])[test.name]).first()[0] == 0


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        quality.run_tests({"t": spark.range(1)}, [quality.TableTest("t", "id", "odd")])


def test_hot_key_is_one_duplicate(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    check = quality.Check("twice", "DUPLICATE_KEY", "", key="k")
    assert quality.run_checks(df, [check]).first().row_count == 1
