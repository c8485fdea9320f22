"""The whole run from CSV to test results, twice into the same folder."""

import csv
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallywork.__main__ import main
from tallywork.plans import marts, pipeline
from tallywork.sources.schemas import ISSUES_SCHEMA, SURVEY_COLUMNS
from tallywork.sources.tables import scratch_dir

AT = datetime(2024, 7, 1)


def survey(path, n):
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, list(SURVEY_COLUMNS), restval="NA")
        writer.writeheader()
        for i in range(n):
            row = {
                "ResponseId": i,
                "Country": "X" if i % 2 else "Y",
                "DevType": "dev",
                "YearsCode": "More than 50 years",
                "YearsCodePro": i % 30,
                "CompTotal": f"${20000 + i}",
                "LanguageHaveWorkedWith": "C;Java" if i % 3 else "C",
                "LanguageWantToWorkWith": "JavaScript",
                "DatabaseHaveWorkedWith": "SQLite",
                "DatabaseWantToWorkWith": "SQLite;Other" if i % 4 else "NA",
                "AISelect": "Yes",
                "AIThreat": "No",
                "JobSat": 8,
            }
            writer.writerow(row)
        writer.writerow({"ResponseId": 0, "Country": "X"})
    return str(path)


@pytest.mark.parametrize("runs", [1, 2])
def test_run(spark, tmp_path, runs):
    for n in range(runs):
        tables = pipeline.run(spark, survey(tmp_path / f"s{n}.csv", 300 - 50 * n), str(tmp_path / "out"), AT)
    n = 300 if runs == 1 else 250
    assert tables["raw"].count() == n + 1
    assert tables["staging"].count() == n

    issues = {r.check_name: (r.row_count, r.severity) for r in tables["issues"].collect()}
    assert issues["total_rows_loaded"] == (n + 1, "info")
    assert issues["duplicate_response_id"] == (1, "warn")
    assert issues["null_comp_total"] == (1, "warn")
    stored = pipeline.table(spark, str(tmp_path / "out"), "issues")
    assert stored.columns == ISSUES_SCHEMA.names and {r.logged_at for r in stored.collect()} == {AT}

    adoption = {r.tech_name: r for r in marts.tech_adoption_ordered(tables["adoption"]).collect()}
    assert adoption["SQLite"].usage_rank == 1 and adoption["SQLite"].tech_type == "Database"
    assert adoption["Java"].retention_rate_pct == 100.0
    assert adoption["C"].total_users in (n, n - 1)  # the two rows of key 0 tie on their load time
    assert tables["salary"].count() > 0 and tables["sentiment"].count() > 0

    tests = tables["tests"].collect()
    assert len(tests) == 13 and all(t.failures == 0 for t in tests)


def test_steps_run_alone_and_bad_numbers_can_stop_the_build(spark, tmp_path):
    out = str(tmp_path / "out")
    source = survey(tmp_path / "s.csv", 120)
    with open(source, "a") as f:
        f.write("900,,,,,about 5" + ",NA" * 17 + "\n")
    pipeline.ingest(spark, source, out, AT)
    assert pipeline.check(spark, out, AT).count() == 6
    losses = pipeline.table(spark, out, "losses").collect()
    counted = {"years_code": 1, "years_code_pro": 0, "comp_total": 0, "job_sat": 0}
    assert {r.column_name: r.row_count for r in losses} == counted
    with pytest.raises(Exception, match="not a number"):
        pipeline.build(spark, out, on_error="fail")
    assert pipeline.build(spark, out)["staging"].filter("response_id = 900 AND years_code IS NULL").count() == 1
    assert pipeline.test(spark, out).filter("should_error").count() == 0


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    source, out = survey(tmp_path / "s.csv", 120), str(tmp_path / "out")
    for arguments in (["ingest", out, source], ["check", out], ["build", out], ["test", out], ["run", out, source]):
        monkeypatch.setattr("sys.argv", ["tallywork", *arguments])
        assert main() == 0
    shown = capsys.readouterr().out
    assert shown.count("total_rows_loaded") == 2 and shown.count("unique.staging.response_id") == 2
    monkeypatch.setattr("sys.argv", ["tallywork", "ingest", out])
    with pytest.raises(SystemExit):
        main()


def test_failing_tests_fail_the_command(spark, tmp_path, monkeypatch, capsys):
    out = str(tmp_path / "out")
    pipeline.run(spark, survey(tmp_path / "s.csv", 120), out, AT)
    adoption = pipeline.table(spark, out, "adoption").withColumn("tech_type", F.lit("Platform"))
    with pipeline.tables(spark, out).draft() as draft:
        draft.write("adoption", adoption)
    monkeypatch.setattr("sys.argv", ["tallywork", "test", out])
    assert main() == 1
    assert "accepted_values.adoption.tech_type" in capsys.readouterr().out


def test_a_failed_refresh_keeps_the_old_tables(spark, tmp_path):
    out = str(tmp_path / "out")
    source = survey(tmp_path / "s.csv", 120)
    pipeline.run(spark, source, out, AT)
    before = {name: sorted(map(str, pipeline.table(spark, out, name).collect())) for name in pipeline.LAYERS}
    broken = F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("lost half-way")).cast("long"))
    for layer in ("raw", "issues"):  # a load and a check that stop while they write
        with pytest.raises(Exception, match="lost half-way"):
            with pipeline.tables(spark, out).draft() as draft:
                draft.write(layer, spark.range(10).select(broken.alias("x")))
    bad = pipeline.table(spark, out, "raw")
    bad = bad.withColumn("job_sat", F.when(F.col("response_id") == "7", "9" * 40).otherwise(F.col("job_sat")))
    with pipeline.tables(spark, out).draft() as draft:
        draft.write("raw", bad)
    with pytest.raises(Exception, match="not a number"):  # staging is written by then, the last mart stops
        pipeline.build(spark, out, on_error="fail")
    for name in set(pipeline.LAYERS) - {"raw"}:
        assert sorted(map(str, pipeline.table(spark, out, name).collect())) == before[name]
    # No version is left that no snapshot names.
    named = {v.path for s in pipeline.tables(spark, out).snapshots() for v in s.tables.values()}
    assert {str(p.relative_to(out)) for p in (tmp_path / "out").rglob("v-*")} == named


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
