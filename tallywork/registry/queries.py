"""One query per operator and per product, over the whole given tables.

Each takes (spark, sf_dir). The survey queries read the raw layer of
``survey_fixture``; the rest read the tables as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywork.functions.numeric import band
from tallywork.operators import multiselect
from tallywork.operators.bitmaps import dense_ids
from tallywork.operators.dedupe import latest_per_key
from tallywork.operators.quantiles import group_quantiles, sketched_quantiles
from tallywork.plans import catalog, marts, pipeline, quality
from tallywork.plans.staging import cast_losses, stage
from tallywork.sources import ingest
from tallywork.sources.schemas import RAW_SCHEMA, SURVEY_COLUMNS
from tallywork.sources.snapshots import TableSet
from tallywork.sources.tables import scratch_path, write_once, write_table
from tallywork.survey_fixture import raw_survey, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    # (response_id, loaded_at) is unique in the fixture, so no tiebreak has to be carried along.
    return stage(raw_survey(spark, sf_dir), tiebreak=())


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """The rows, stored in buckets of a key."""
    tables = TableSet(df.sparkSession, scratch_path(df.sparkSession, name))
    with tables.draft() as draft:
        draft.write(name, df, key=key)
    return draft.read(name)


def plain(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, the type in which SQL engines agree."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else c for c, t in df.dtypes])


# Ingest


@query
def select_rename(spark, sf_dir):
    names = {"o_orderkey": "order_id", "o_orderstatus": "status", "o_clerk": "clerk", "o_orderpriority": "priority"}
    return ingest.select_rename(read(spark, sf_dir, "orders"), names)


@query
def clean_sentinels(spark, sf_dir):
    """Every text column of the raw layer."""
    texts = raw_survey(spark, sf_dir, "uncleaned").select(*SURVEY_COLUMNS.values())
    return ingest.clean_strings(ingest.null_tokens(texts))


@query
def clean_documents(spark, sf_dir):
    """The cleaning step over the whole text of every document."""
    return ingest.clean_strings(ingest.null_tokens(read(spark, sf_dir, "documents").select("doc_id", "text", "lang")))


def written_as_csv(df: DataFrame, name: str) -> str:
    """A folder of CSV files, each with a header, in the shared folder."""
    path = f"{scratch_path(df.sparkSession, name)}/csv"
    keep_blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(**ingest.CSV_OPTIONS, **keep_blanks).option("header", True).csv(path)
    return path


@query
def csv_documents(spark, sf_dir):
    """Whole documents, whose texts span lines, through CSV files that are read in blocks."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return ingest.read_csv(spark, written_as_csv(documents, "documents"), "block")


@query
def csv_documents_auto(spark, sf_dir):
    """The same, the way of reading chosen by the content."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return ingest.read_csv(spark, written_as_csv(documents, "documents"))


@query
def csv_raw_layer(spark, sf_dir):
    """The raw layer loaded from CSV under the source's column names."""
    answers = raw_survey(spark, sf_dir, "uncleaned")
    source = answers.select(*[F.col(raw).alias(name) for name, raw in SURVEY_COLUMNS.items()])
    return ingest.load_raw(spark, written_as_csv(source, "survey"), datetime(2024, 7, 1))


@query
def raw_profile(spark, sf_dir):
    return raw_survey(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("response_id").alias("n_ids"),
        F.countDistinct("response_id").alias("n_distinct_ids"),
        F.count("country").alias("n_country"),
        F.count("comp_total").alias("n_comp"),
    )


@query
def replaced_table(spark, sf_dir):
    """A stored table after a full refresh."""
    path = scratch_path(spark, "refreshed")
    write_table(raw_survey(spark, sf_dir, "uncleaned").select("response_id", "country"), path)
    return write_table(raw_survey(spark, sf_dir).select("response_id", "country"), path)


# Staging


@query
def stg_dedup(spark, sf_dir):
    return latest_per_key(raw_survey(spark, sf_dir), "response_id", "loaded_at", ())


@query
def stg_dedup_stored(spark, sf_dir):
    """The same rows from a table stored in buckets of the key: nothing is shuffled any more."""
    return latest_per_key(bucketed(raw_survey(spark, sf_dir), "raw", "response_id"), "response_id", "loaded_at", ())


@query
def latest_event_per_user(spark, sf_dir):
    return latest_per_key(read(spark, sf_dir, "events"), "user_id", "ts", ("event_id",))


@query
def years_numeric(spark, sf_dir):
    return plain(staged(spark, sf_dir).select("response_id", "years_code", "years_code_pro"))


@query
def years_numeric_odd(spark, sf_dir):
    odd = stage(raw_survey(spark, sf_dir, "odd_years"), tiebreak=())
    return plain(odd.select("response_id", "years_code_pro"))


@query
def comp_numeric(spark, sf_dir):
    return plain(staged(spark, sf_dir).select("response_id", "comp_total_usd"))


@query
def comp_numeric_exponent(spark, sf_dir):
    """Pay in exponent form: a number where it fits, else NULL."""
    odd = stage(raw_survey(spark, sf_dir, "exponents"), tiebreak=())
    return plain(odd.select("response_id", "comp_total_usd"))


@query
def cast_losses_exponent(spark, sf_dir):
    return cast_losses(raw_survey(spark, sf_dir, "exponents"))


@query
def stg_survey(spark, sf_dir):
    return plain(staged(spark, sf_dir))


@query
def cast_losses_odd(spark, sf_dir):
    return cast_losses(raw_survey(spark, sf_dir, "odd_years"))


# Exploded layers


@query
def explode_multiselect(spark, sf_dir):
    return multiselect.explode_items(staged(spark, sf_dir), "language_have_worked", "item", ["response_id"])


@query
def wants_to_continue(spark, sf_dir):
    return multiselect.explode_multiselect(
        staged(spark, sf_dir), "database_have_worked", "database_want_work", "item", ["response_id"]
    )


@query
def wants_to_continue_exact(spark, sf_dir):
    return multiselect.explode_multiselect(
        staged(spark, sf_dir), "database_have_worked", "database_want_work", "item", ["response_id"], "exact"
    )


@query
def platforms_exploded(spark, sf_dir):
    return multiselect.explode_multiselect(
        staged(spark, sf_dir), "platform_have_worked", "platform_want_work", "platform", ["response_id"]
    )


@query
def languages_exploded(spark, sf_dir):
    return plain(marts.languages_exploded(staged(spark, sf_dir)))


@query
def databases_exploded(spark, sf_dir):
    return plain(marts.databases_exploded(staged(spark, sf_dir)))


# Salary


@query
def experience_band(spark, sf_dir):
    bands = staged(spark, sf_dir).select(marts.experience_band(F.col("years_code_pro")).alias("experience_band"))
    return bands.groupBy("experience_band").agg(F.count(F.lit(1)).alias("n"))


@query
def account_balance_band(spark, sf_dir):
    label = band(F.col("c_acctbal"), (0, 2500, 5000), ("debt", "low", "middle", "high"), "unknown")
    return read(spark, sf_dir, "customer").groupBy(label.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query
def salary_range_filter(spark, sf_dir):
    return plain(marts.in_pay_range(staged(spark, sf_dir)).select("response_id", "comp_total_usd"))


@query
def salary_percentiles(spark, sf_dir):
    """In one lazy plan, as the rows take work to derive."""
    rows = marts.in_pay_range(staged(spark, sf_dir))
    return group_quantiles(rows, ["country"], "comp_total_usd", marts.QUARTILES).select("country", *marts.QUARTILES)


@query
def price_percentiles(spark, sf_dir):
    cents = F.round(F.col("l_extendedprice") * 100).cast("decimal(18,0)")
    lines = read(spark, sf_dir, "lineitem").withColumn("cents", cents)
    keys = ["l_returnflag", "l_linestatus"]
    return sketched_quantiles(lines, keys, "cents", marts.QUARTILES).select(*keys, "n", *marts.QUARTILES)


def salary_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the salary mart reads of staging, stored."""
    return write_once(staged(spark, sf_dir).select(*marts.SALARY_INPUT), "staging")


@query
def salary_segments(spark, sf_dir):
    return marts.salary_segments(salary_staged(spark, sf_dir))


# Adoption


@query
def retention_rate(spark, sf_dir):
    """Over every exploded row of both lists: distinct respondents per language and per database."""
    stg = staged(spark, sf_dir)
    languages = marts.exploded_usage(marts.languages_exploded(stg), "language", "Language")
    return languages.unionByName(marts.exploded_usage(marts.databases_exploded(stg), "database_name", "Database"))


@query
def usage_from_loads(spark, sf_dir):
    """All answers, repeats among them, in two loads: each is counted once, and what they have stored is added up."""
    raw = raw_survey(spark, sf_dir)
    columns = [c for _, *lists in (marts.LANGUAGE, marts.DATABASE) for c in lists]
    rows = write_once(raw.select("response_id", (F.dayofweek("loaded_at") % 2).alias("load"), *columns), "answers")
    loads, ids = [], None
    for load in (0, 1):
        new = rows.where(F.col("load") == load)
        ids = write_once(dense_ids(new, "response_id", ids), "respondents")
        loads.append(write_once(marts.usage_load(new, ids), "usage"))
    return marts.loads_usage(loads)


@query
def item_usage(spark, sf_dir):
    """The same figures for all three lists in one pass over staging, without the distinct."""
    platform = ("Platform", "platform_have_worked", "platform_want_work")
    return marts.item_usage(staged(spark, sf_dir), (marts.LANGUAGE, marts.DATABASE, platform))


@query
def usage_rank(spark, sf_dir):
    return marts.tech_adoption(staged(spark, sf_dir)).select("tech_type", "tech_name", "total_users", "usage_rank")


@query
def tech_adoption(spark, sf_dir):
    return marts.tech_adoption(staged(spark, sf_dir))


ADOPTION_SQL = """
WITH used AS (
    SELECT language AS tech_name, 'Language' AS tech_type, response_id, wants_to_continue FROM {languages}
    UNION ALL
    SELECT database_name, 'Database', response_id, wants_to_continue FROM {databases}),
counted AS (
    SELECT tech_name, tech_type, count(DISTINCT response_id) AS total_users,
           count_if(wants_to_continue) AS want_to_continue_count,
           cast(round(cast(100 * count_if(wants_to_continue) AS decimal(38, 4)) / count(DISTINCT response_id), 1) AS double)
               AS retention_rate_pct
    FROM used GROUP BY tech_name, tech_type)
SELECT *, cast(rank() OVER (PARTITION BY tech_type ORDER BY total_users DESC) AS bigint) AS usage_rank
FROM counted WHERE total_users >= 100
"""


def published(spark: SparkSession, out: str) -> dict[str, str]:
    """Names of the layers below ``out`` in databases of their own."""
    return catalog.publish(spark, out, f"{out.rstrip('/').rsplit('/', 1)[-1].replace('-', '_')}_")


@query
def sql_adoption(spark, sf_dir):
    """The adoption mart written in SQL over the catalog's names."""
    out = scratch_path(spark, "sql")
    with pipeline.tables(spark, out).draft() as draft:
        draft.write("staging", staged(spark, sf_dir), key="response_id")
    return spark.sql(ADOPTION_SQL.format(**published(spark, out)))


def run_from_csv(spark: SparkSession, sf_dir: str) -> str:
    """The whole run, from CSV files of the survey to test results; where its tables are."""
    answers = raw_survey(spark, sf_dir, "uncleaned")
    source = answers.select(*[F.col(raw).alias(name) for name, raw in SURVEY_COLUMNS.items()])
    out = scratch_path(spark, "run")
    pipeline.run(spark, written_as_csv(source, "survey"), out, datetime(2024, 7, 1))
    return out


@query
def whole_run(spark, sf_dir):
    """The adoption mart that a whole run has stored."""
    return spark.table(published(spark, run_from_csv(spark, sf_dir))["adoption"])


@query
def whole_run_layers(spark, sf_dir):
    """Every layer of a whole run by its rows, and the tests by their failures."""
    names = published(spark, run_from_csv(spark, sf_dir))
    rows = [f"SELECT '{layer}' AS name, count(*) AS n FROM {names[layer]}" for layer in names]
    return spark.sql(" UNION ALL ".join([*rows, f"SELECT test_name, failures FROM {names['tests']}"]))


def places(ordered: DataFrame, order: list) -> DataFrame:
    """The rows with their place in the display order; a mart is a report, so its rows may meet."""
    return ordered.withColumn("place", F.row_number().over(Window.orderBy(*order)))


@query
def adoption_ordered(spark, sf_dir):
    mart = marts.tech_adoption_ordered(marts.tech_adoption(staged(spark, sf_dir)))
    return places(mart, marts.ADOPTION_ORDER).select("place", "tech_type", "tech_name")


@query
def salary_ordered(spark, sf_dir):
    mart = marts.by_respondents(marts.salary_segments(salary_staged(spark, sf_dir)))
    return places(mart, marts.respondent_order(mart)).select("place", *marts.SALARY_KEYS)


@query
def sentiment_ordered(spark, sf_dir):
    mart = marts.by_respondents(marts.ai_sentiment(staged(spark, sf_dir)))
    return places(mart, marts.respondent_order(mart)).select("place", *marts.SENTIMENT_KEYS)


# Sentiment


@query
def avg_if_numeric_long(spark, sf_dir):
    """Means over texts of up to thirty digits, exactly."""
    stg = stage(raw_survey(spark, sf_dir, "long_ratings"), tiebreak=())
    mean = marts.exact_mean_if_numeric(F.col("job_sat")).cast("decimal(38,2)").cast("string")
    return stg.groupBy("country").agg(mean.alias("avg_job_satisfaction"))


@query
def avg_if_numeric(spark, sf_dir):
    mean = marts.mean_if_numeric(F.col("job_sat")).alias("avg_job_satisfaction")
    return staged(spark, sf_dir).groupBy("country").agg(mean)


@query
def ai_sentiment(spark, sf_dir):
    return marts.ai_sentiment(staged(spark, sf_dir))


@query
def ai_threat_share(spark, sf_dir):
    """The sentiment mart without ai_threat among its keys, so that the share can vary."""
    return marts.ai_sentiment(staged(spark, sf_dir), marts.SENTIMENT_KEYS[:-1])


# Quality


def one_check(key: str, name: str, variant: str = "base") -> None:
    def run(spark, sf_dir):
        report = quality.run_checks(raw_survey(spark, sf_dir, variant), [quality.survey_check(name)])
        return report.select("check_name", "row_count")

    QUERIES[key] = run


one_check("dq_null_key", "null_response_id")
one_check("dq_duplicate_key", "duplicate_response_id")
one_check("dq_null_country", "null_country")
one_check("dq_null_comp", "null_comp_total")
one_check("dq_invalid_format", "invalid_years_code_pro", "odd_years")
one_check("dq_total_rows", "total_rows_loaded")


@query
def dq_report(spark, sf_dir):
    return quality.run_checks(raw_survey(spark, sf_dir))


@query
def dq_severity(spark, sf_dir):
    return quality.with_severity(quality.run_checks(raw_survey(spark, sf_dir, "odd_years")))


@query
def issues_stored(spark, sf_dir):
    """The issues table as the check step stores it, but for the time."""
    out = scratch_path(spark, "checked")
    raw = raw_survey(spark, sf_dir).withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))
    with pipeline.tables(spark, out).draft() as draft:
        pipeline.write_raw(draft, raw.select(*RAW_SCHEMA.names))
    pipeline.check(spark, out)
    return pipeline.table(spark, out, "issues").drop("logged_at")


ORDER_CHECKS = (
    quality.Check("null_customer", "MISSING_DIMENSION", "Orders without customer", where="o_custkey IS NULL"),
    quality.Check("repeated_customer", "DUPLICATE_KEY", "Customers with several orders", key="o_custkey"),
    quality.Check("odd_priority", "FORMAT_INCONSISTENCY", "Priority not urgent", where="o_orderpriority RLIKE '^[^1]'"),
    quality.Check("orders", quality.AUDIT, "All orders"),
)


@query
def dq_orders(spark, sf_dir):
    return quality.with_severity(quality.run_checks(read(spark, sf_dir, "orders"), ORDER_CHECKS))


@query
def test_not_null(spark, sf_dir):
    return quality.failing_nulls(raw_survey(spark, sf_dir), "response_id")


@query
def test_unique(spark, sf_dir):
    return quality.failing_duplicates(raw_survey(spark, sf_dir), "response_id")


@query
def test_accepted_values(spark, sf_dir):
    return quality.failing_values(raw_survey(spark, sf_dir), "remote_work", ["Remote"])


def layers_over(raw: DataFrame, stg: DataFrame, adoption: DataFrame) -> dict[str, DataFrame]:
    return {
        "raw": raw,
        "staging": stg,
        "languages": marts.languages_exploded(stg),
        "databases": marts.databases_exploded(stg),
        "salary": marts.salary_segments(stg),
        "adoption": write_once(adoption, "adoption"),
        "sentiment": marts.ai_sentiment(stg),
    }


@query
def test_results(spark, sf_dir):
    raw = write_once(raw_survey(spark, sf_dir), "raw")
    stg = write_once(stage(raw), "staging")
    return quality.run_tests(layers_over(raw, stg, marts.tech_adoption(stg)))


@query
def test_results_broken(spark, sf_dir):
    """Staging without its filter and dedupe, and an adoption mart with a third type: the tests must count that."""
    raw = write_once(raw_survey(spark, sf_dir), "raw")
    stg = write_once(stage(raw, latest=lambda df, *_: df), "staging")
    platform = ("Platform", "platform_have_worked", "platform_want_work")
    adoption = marts.rank_usage(marts.item_usage(stg, (marts.LANGUAGE, marts.DATABASE, platform)))
    return quality.run_tests(layers_over(raw, stg, adoption))
