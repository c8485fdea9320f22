"""What the plans must look like to hold at scale."""

import re

import pytest

from tallywork.operators.dedupe import latest_per_key
from tallywork.operators.quantiles import group_quantiles, sketched_quantiles
from tallywork.plans import marts, quality
from tallywork.plans.staging import stage
from tallywork.registry.queries import QUERIES, bucketed
from tallywork.sources.ingest import clean_strings, read_csv
from tallywork.sources.tables import write_table
from tallywork.survey_fixture import raw_survey

SF_DIR = "/root/testdata/sf0.001"


def executed(df):
    """The plan as finally run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return write_table(raw_survey(spark, SF_DIR), str(tmp_path_factory.mktemp("raw") / "t"))


@pytest.fixture(scope="module")
def stg(raw, tmp_path_factory):
    return write_table(stage(raw), str(tmp_path_factory.mktemp("stg") / "t"))


def scans(plan):
    return re.findall(r"FileScan parquet \[([^\]]*)\]", plan)


def test_dedupe_limits_rows_before_the_only_shuffle(raw):
    plan = executed(stage(raw))
    assert plan.count("Exchange hashpartitioning") == 1
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle
    assert "isnotnull(response_id" in before_shuffle


def test_dedupe_carries_only_the_columns_read(raw):
    narrow = stage(raw, tiebreak=()).select("response_id", "comp_total_usd")
    (columns,) = scans(executed(narrow))
    assert [c.split("#")[0] for c in columns.split(",")] == ["response_id", "comp_total", "loaded_at"]


def test_tables_in_buckets_of_the_key_need_no_shuffle_by_it(spark, raw):
    stored = bucketed(raw, "raw", "response_id")
    for df in (
        stage(stored),
        latest_per_key(stored, "response_id", "loaded_at"),
        quality.failing_duplicates(stored, "response_id"),
        stored.groupBy("response_id").count().where("count > 1"),
    ):
        plan = executed(df)
        assert "Exchange" not in plan and "Bucketed: true" in plan
    # The counts of a check or a test meet in one row, the groups before that do not move.
    for df in (quality.run_checks(stored, [quality.survey_check("duplicate_response_id")]),
               quality.run_tests({"staging": stored}, [quality.TableTest("staging", "response_id", "unique")])):
        assert "Exchange hashpartitioning" not in executed(df)
    assert sorted(map(str, stage(stored).collect())) == sorted(map(str, stage(raw).collect()))


def test_adoption_reads_four_columns_once_and_counts_before_the_shuffle(stg):
    plan = executed(marts.tech_adoption(stg))
    (columns,) = scans(plan)
    assert len(columns.split(",")) == 4
    assert "ReusedExchange" in plan
    assert "partial_count" in plan[plan.index("Exchange hashpartitioning(tag") :]


def test_salary_pushes_the_range_down_and_shuffles_what_is_inside_the_brackets(stg):
    plan = executed(marts.salary_segments(stg))
    (columns,) = [c for c in scans(plan) if "comp_total_usd" in c]
    assert len(columns.split(",")) == 6
    scan = plan[plan.index(f"FileScan parquet [{columns}") :]
    assert "10000" in scan.split("ReadSchema")[0]
    # The rows meet their brackets without a shuffle, and are counted by value or stretch before they are sent.
    assert "BroadcastHashJoin" in plan and plan.count("partial_count") >= 1
    # no aggregate that holds all values of a group
    assert "percentile" not in plan and "collect_" not in plan and "ObjectHashAggregate" not in plan


def test_sketched_quantiles_shuffle_a_small_part(spark):
    """What the second pass sends is far less than the distinct values, which the other way sends."""
    df = spark.range(400_000).selectExpr("id % 2 AS k", "double(hash(id)) AS v")

    def sent(result):
        plan = result._jdf.queryExecution()
        result.collect()
        text = plan.executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Exchange hashpartitioning" in text
        metrics, todo = [], [plan.executedPlan()]
        while todo:
            node = todo.pop()
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                node = node.executedPlan()
            while node.nodeName().endswith("QueryStage"):
                node = node.plan()
            if node.nodeName() == "Exchange":
                metrics.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        return sum(metrics)

    assert sent(sketched_quantiles(df, ["k"], "v", marts.QUARTILES)) < sent(group_quantiles(df, ["k"], "v", marts.QUARTILES)) / 4


def test_explode_needs_no_shuffle_and_one_pass(stg):
    plan = executed(marts.languages_exploded(stg))
    assert "Exchange" not in plan
    assert plan.count("split(") == 1


def test_checks_shuffle_only_the_key(raw):
    plan = executed(quality.run_checks(raw))
    assert sorted(len(c.split(",")) for c in scans(plan)) == [1, 4]
    assert plan.count("Exchange hashpartitioning") == 1


def test_quantiles_open_few_buckets(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    plan = executed(group_quantiles(lines, ["l_returnflag"], "l_extendedprice", marts.QUARTILES))
    assert "ReusedExchange" in plan and "SinglePartition" not in plan


def test_csv_blocks_shuffle_each_line_once(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('Id,Text\n' + '1,"two\nlines"\n2,one\n' * 50)
    plan = executed(read_csv(spark, str(path), "block"))
    # the text was read once to store the lines; they are shuffled by block, and by record to be put together
    assert "FileScan text" not in plan
    assert plan.count("Exchange hashpartitioning(file") == 2


@pytest.mark.parametrize("records", ["line", "block"])
def test_csv_takes_each_record_apart_once(spark, tmp_path, records):
    path = tmp_path / "a.csv"
    path.write_text("Id,Text\n" + "1,one\n \t\n2,two\n" * 50)
    df = read_csv(spark, str(path), records)
    assert executed(df).count("from_csv(") == 1
    assert df.count() == 100


def test_cleaning_runs_in_compiled_code(spark):
    texts = ["NA", " NA ", "\u3000NA\x1f", "", "  ", "\u00a0", "a b", " a  b\t", "x\u2028", "\x85y", "\u00e9", " \u00e9", "z\u00a0z", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    cleaned = clean_strings(df)
    assert "lambda" not in executed(cleaned)
    stripped = [t if t is None else t.strip() for t in texts]
    assert [r.c for r in cleaned.collect()] == [None if t in ("NA", "") else t for t in stripped]


@pytest.mark.parametrize("name", sorted(set(QUERIES)))
def test_no_query_leaves_spark_or_crosses_tables(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "LocalLimit", "Sample"):
        assert word not in plan
