"""Sets of stored tables: commits as a whole, failures at every step, expiry, journals, buckets and observed counts."""

import json
import shutil

import pytest
from pyspark.sql import functions as F
from test_pipeline import AT, survey

from tallywork.operators.dedupe import latest_per_key
from tallywork.plans import pipeline, quality
from tallywork.sources import snapshots
from tallywork.sources.snapshots import Draft, TableSet
from tallywork.sources.tables import Files, read_table, scratch_dir, scratch_of_run, write_once, write_table


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x long")


def values(df):
    return sorted(r.x for r in df.collect())


def test_a_commit_changes_all_tables_and_readers_keep_theirs(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    assert tables.current().number == 0 and "a" not in tables.current()
    with tables.draft() as draft:
        draft.write("a", numbers(spark, 1))
        draft.write("b", numbers(spark, 2))
        assert tables.current().number == 0  # nothing is seen before the commit
    first = tables.current()
    pinned = first.read("a")
    with tables.draft() as draft:
        draft.write("a", numbers(spark, 10))
        assert values(draft.read("a")) == [10] and values(draft.read("b")) == [2]
    second = tables.current()
    assert (values(first.read("a")), values(pinned), values(second.read("a")), values(second.read("b"))) == ([1], [1], [10], [2])
    with pytest.raises(FileNotFoundError, match="no table 'c'"):
        second.read("c")


def test_old_versions_go_by_count(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path), {"a": "layer/a"})
    for n in range(5):
        with tables.draft() as draft:
            draft.write("a", numbers(spark, n))
    assert [s.number for s in tables.snapshots()] == [4, 5]
    assert len(list((tmp_path / "layer/a").iterdir())) == 2
    tables.expire(1)
    assert [values(s.read("a")) for s in tables.snapshots()] == [[4]]
    with pytest.raises(ValueError):
        tables.expire(0)


def test_a_cut_off_manifest_is_passed_over(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    with tables.draft() as draft:
        draft.write("a", numbers(spark, 1))
    whole = (tmp_path / "_snapshots/000000000001.json").read_text()
    for cut in (0, 1, len(whole) // 2, len(whole) - 10):
        (tmp_path / "_snapshots/000000000002.json").write_text(whole[:cut])
        assert tables.current().number == 1 and values(tables.current().read("a")) == [1]
    with tables.draft() as draft:
        draft.write("a", numbers(spark, 3))
    assert tables.current().number == 3 and [s.number for s in tables.snapshots()] == [1, 3]


def test_a_second_writer_stops(spark, tmp_path, monkeypatch):
    tables = TableSet(spark, str(tmp_path))
    draft = tables.draft()
    draft.write("a", numbers(spark, 1))
    monkeypatch.setattr(tables, "_manifests", lambda: [])  # it has not seen the other's commit
    with TableSet(spark, str(tmp_path)).draft() as other:
        other.write("a", numbers(spark, 2))
    with pytest.raises(Exception, match="(?i)exist"):
        draft.commit()
    assert values(TableSet(spark, str(tmp_path)).current().read("a")) == [2]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    bad = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("half-way")).cast("long")).alias("x"))
    for key in (None, "x"):
        with pytest.raises(Exception, match="half-way"), tables.draft() as draft:
            draft.write("good", numbers(spark, 1), key=key)
            draft.write("bad", bad, key=key)
        assert tables.current().number == 0 and list(tmp_path.rglob("v-*")) == []


def test_write_table_is_read_by_path(spark, tmp_path):
    path = str(tmp_path / "t")
    old = write_table(numbers(spark, 1, 2), path)
    write_table(old.select((F.col("x") * 10).alias("x")), path)  # a table may be made from itself
    assert values(read_table(spark, path)) == [10, 20] and values(old) == [1, 2]
    numbers(spark, 7).write.parquet(str(tmp_path / "plain"))
    assert values(read_table(spark, str(tmp_path / "plain"))) == [7]


# A build that dies


def contents(spark, out):
    snapshot = pipeline.tables(spark, out).current()
    return {name: sorted(map(str, snapshot.read(name).collect())) for name in snapshot.tables}


class Killed(BaseException):
    pass


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """The folder of a first run, and the files of that and of another one."""
    folder = tmp_path_factory.mktemp("loaded")
    first, second = survey(folder / "s1.csv", 150), survey(folder / "s2.csv", 120)
    pipeline.run(spark, first, str(folder / "out"), AT)
    return folder / "out", first, second


WRITES = ("raw", "issues", "losses", "staging", "salary", "adoption", "sentiment", "tests")


@pytest.mark.parametrize("dies_at", [*WRITES, "commit"])
def test_a_run_that_dies_at_any_step_is_gone_on_with(spark, tmp_path, loaded, monkeypatch, dies_at):
    folder, _, second = loaded
    out = str(shutil.copytree(folder, tmp_path / "out"))  # paths in a manifest are relative
    before = contents(spark, out)
    whole = Draft.write

    def dying(self, name, *args, **kwargs):
        if name == dies_at:
            raise Killed
        return whole(self, name, *args, **kwargs)

    with monkeypatch.context() as patch:
        if dies_at == "commit":
            patch.setattr(Draft, "commit", lambda self: (_ for _ in ()).throw(Killed()))
        else:
            patch.setattr(Draft, "write", dying)
        with pytest.raises(Killed):
            pipeline.run(spark, second, out)
    assert contents(spark, out) == before  # the earlier set, whole

    written = []
    with monkeypatch.context() as patch:
        patch.setattr(Draft, "write", lambda self, name, *a, **k: (written.append(name), whole(self, name, *a, **k))[1])
        result = pipeline.run(spark, second, out)
    steps = (("raw",), ("issues", "losses"), ("staging",), ("salary", "adoption", "sentiment"), ("tests",))
    begun = next((i for i, names in enumerate(steps) if dies_at in names), len(steps))
    assert written == [name for names in steps[begun:] for name in names]
    assert result["raw"].count() == 121 and result["tests"].filter("should_error").count() == 0
    assert len({r.loaded_at for r in result["raw"].collect()}) == 1
    assert not (tmp_path / "out/_journal").exists()
    named = {v.path for s in pipeline.tables(spark, out).snapshots() for v in s.tables.values()}
    assert {str(p.relative_to(out)) for p in (tmp_path / "out").rglob("v-*")} == named


def test_a_run_over_other_files_begins_anew(spark, tmp_path, loaded, monkeypatch):
    _, first, second = loaded
    out = str(tmp_path / "out")
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "write_marts", lambda *_: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            pipeline.run(spark, first, out, AT)
    assert pipeline.tables(spark, out).current().number == 0
    assert pipeline.run(spark, second, out, AT)["raw"].count() == 121


def test_a_damaged_journal_is_not_believed(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    draft = tables.draft(resume=True)
    draft.step("one", "k", lambda: draft.write("a", numbers(spark, 1)))
    entry = tmp_path / "_journal/one.json"
    entry.write_text(entry.read_text()[:-20])
    again = tables.draft(resume=True)
    again.step("one", "k", lambda: again.write("a", numbers(spark, 2)))
    assert values(again.commit().read("a")) == [2] and not (tmp_path / "_journal").exists()


# Buckets


def test_buckets_hold_all_rows_and_are_known_to_a_new_session(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    rows = spark.range(3000).selectExpr("if(id % 7 = 0, null, cast(id % 900 as string)) AS k", "id AS x", "cast(1.5 AS decimal(9,2)) AS d")
    with tables.draft() as draft:
        stored = draft.write("t", rows, key="k", buckets=4)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    version = tables.current().tables["t"]
    assert (version.key, version.buckets, version.even) == ("k", 4, True)
    spark.sql(f"DROP TABLE {version.name}")  # as in a session that has not read it yet
    again = latest_per_key(tables.current().read("t"), "k", "x")
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
    assert again.count() == 900
    tables.remove_version(version.path)
    assert not spark.catalog.tableExists(version.name)


def test_a_hot_bucket_is_not_read_by_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "SMALL_BUCKET", 0)
    tables = TableSet(spark, str(tmp_path))
    rows = spark.range(40_000).selectExpr("if(id % 2 = 0, 'hot', cast(id as string)) AS k", "uuid() AS x")
    with tables.draft() as draft:
        stored = draft.write("t", rows, key="k", buckets=16)
    assert not tables.current().tables["t"].even
    plan = latest_per_key(stored, "k", "x")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" not in plan and "WindowGroupLimit" in plan and "Exchange" in plan
    assert stored.count() == 40_000


# Observed counts


def test_counts_are_taken_while_a_layer_is_written(spark, loaded):
    """After the run, checks and tests of single rows read no layer; they equal those that scan."""
    snapshot = pipeline.tables(spark, str(loaded[0])).current()
    observed = {k: v for layer in quality.WRITTEN_WITH for k, v in snapshot.observed(layer).items()}
    layers = pipeline.layers_of(snapshot)
    assert len(observed) == 17  # five checks of rows, twelve tests
    for report in (
        quality.run_checks(layers["raw"], [c for c in quality.SURVEY_CHECKS if c.key is None], observed),
        quality.run_tests(layers, [t for t in quality.SURVEY_TESTS if t.kind != "unique"], observed),
    ):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and report.count() in (5, 12)
    whole = quality.run_tests(layers, observed=observed)
    assert whole._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1  # the unique test
    assert sorted(whole.collect()) == sorted(quality.run_tests(layers).collect())
    assert sorted(quality.run_checks(layers["raw"], observed=observed).collect()) == sorted(quality.run_checks(layers["raw"]).collect())


def test_observed_counts_of_bad_layers_equal_scans(spark, tmp_path):
    items = "language_have_worked string, language_want_work string, database_have_worked string, database_want_work string"
    staging = spark.createDataFrame(
        [(None, "a; b;;", "b", None, None), ("1", " ", "x", "q;r", None), (None, None, "x", "q", "q"), ("1", "c", None, "", "")],
        f"response_id string, {items}",
    ).selectExpr("*", "'X' AS country", "1L AS years_code_pro", "1L AS comp_total_usd", "'d' AS dev_type")
    adoption = spark.createDataFrame([("a", "Tool"), (None, "Tool"), ("b", "Odd"), ("c", "Language")], "tech_name string, tech_type string")
    tables = TableSet(spark, str(tmp_path))
    with tables.draft() as draft:
        draft.write("staging", staging, quality.test_counts("staging"), key="response_id")
        draft.write("adoption", adoption, quality.test_counts("adoption"))
        draft.write("empty", adoption.limit(0), quality.test_counts("adoption"))
    snapshot = tables.current()
    from tallywork.plans import marts

    stg = snapshot.read("staging")
    layers = {
        "staging": stg,
        "languages": marts.languages_exploded(stg),
        "databases": marts.databases_exploded(stg),
        "adoption": snapshot.read("adoption"),
    }
    tests = [t for t in quality.SURVEY_TESTS if t.layer in layers]
    observed = snapshot.observed("staging") | snapshot.observed("adoption")
    got = {r.test_name: r.failures for r in quality.run_tests(layers, tests, observed).collect()}
    assert got == {r.test_name: r.failures for r in quality.run_tests(layers, tests).collect()}
    assert got["not_null.languages.response_id"] == 2 and got["accepted_values.adoption.tech_type"] == 2
    assert set(snapshot.observed("empty").values()) == {0}


# Intermediate results


def test_scratch_of_a_run_is_removed(spark):
    before = set(Files(spark).names(scratch_dir(spark)))
    with scratch_of_run(spark):
        table = write_once(numbers(spark, 1, 2), "inside")
        assert values(table) == [1, 2]
        inside = set(Files(spark).names(scratch_dir(spark))) - before
        assert len(inside) == 1
    assert set(Files(spark).names(scratch_dir(spark))) == before
    kept = write_once(numbers(spark, 3), "outside")
    assert values(kept) == [3]


def test_scratch_must_be_named_on_a_cluster(spark, monkeypatch):
    class Elsewhere:
        class sparkContext:
            master = "yarn"

        class conf:
            get = staticmethod(lambda key, default=None: default)

    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        Elsewhere.sparkContext.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(Elsewhere)


def test_manifests_are_plain_text(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    with tables.draft() as draft:
        draft.write("a", numbers(spark, 1), {"rows": F.count(F.lit(1))})
    text = (tmp_path / "_snapshots/000000000001.json").read_text().rsplit("\n", 2)[0]
    assert json.loads(text)["tables"]["a"]["observed"] == {"rows": 1}
