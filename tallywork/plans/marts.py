"""Exploded layers and the three marts. Stored tables keep no order; ``*_ordered`` is for display."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.numeric import band, percent, ratio
from tallywork.functions.text import to_decimal
from tallywork.operators import bitmaps
from tallywork.operators.multiselect import explode_multiselect, item_flag_counts
from tallywork.operators.quantiles import sketched_quantiles
from tallywork.operators.ranking import rank_descending
from tallywork.sources.schemas import SATISFACTION_TYPE

# Pay range, group thresholds, experience bands.
PAY_RANGE = (10_000, 5_000_000)
MIN_SALARY_GROUP = 5
MIN_TECH_USERS = 100
MIN_SENTIMENT_GROUP = 3
EXPERIENCE_BOUNDS = (2, 5, 10, 20)
EXPERIENCE_LABELS = ("0-1 years", "2-4 years", "5-9 years", "10-19 years", "20+ years")
EXPERIENCE_UNKNOWN = "Unknown"

LANGUAGE = ("Language", "language_have_worked", "language_want_work")
DATABASE = ("Database", "database_have_worked", "database_want_work")
QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}
SALARY_KEYS = ("country", "experience_band", "dev_type", "remote_work", "org_size")
# The columns of staging that the salary mart reads.
SALARY_INPUT = ("country", "years_code_pro", "dev_type", "remote_work", "org_size", "comp_total_usd")
ADOPTION_ORDER = ["tech_type", "usage_rank", "tech_name"]
SENTIMENT_KEYS = ("country", "dev_type", "ai_select", "ai_sent", "ai_threat")


def languages_exploded(stg: DataFrame, match: str = "substring") -> DataFrame:
    keep = ["response_id", "country", "years_code_pro", "comp_total_usd", "dev_type"]
    return explode_multiselect(stg, *LANGUAGE[1:], "language", keep, match)


def databases_exploded(stg: DataFrame, match: str = "substring") -> DataFrame:
    keep = ["response_id", "country", "dev_type", "years_code_pro"]
    return explode_multiselect(stg, *DATABASE[1:], "database_name", keep, match)


def experience_band(c: Column) -> Column:
    return band(c, EXPERIENCE_BOUNDS, EXPERIENCE_LABELS, EXPERIENCE_UNKNOWN)


def in_pay_range(stg: DataFrame, low: int = PAY_RANGE[0], high: int = PAY_RANGE[1]) -> DataFrame:
    """Rows with a country and with pay inside the inclusive range."""
    return stg.filter(F.col("comp_total_usd").between(low, high) & F.col("country").isNotNull())


def salary_segments(stg: DataFrame, min_count: int = MIN_SALARY_GROUP) -> DataFrame:
    """Pay by country, experience, role, remote work and size: count, mean, exact quartiles, range.

    Reads ``stg`` twice, so it should be a stored table.
    """
    rows = in_pay_range(stg).select(
        "country",
        experience_band(F.col("years_code_pro")).alias("experience_band"),
        "dev_type",
        "remote_work",
        "org_size",
        F.col("comp_total_usd").cast("decimal(18,10)").alias("pay"),  # the range fits: eight bytes, not sixteen
    )
    stats = sketched_quantiles(rows, SALARY_KEYS, "pay", QUARTILES, min_count)
    return stats.select(
        *SALARY_KEYS,
        F.col("n").alias("respondent_count"),
        _double(ratio(F.col("total"), F.col("n"), 2)).alias("avg_salary_usd"),
        F.round("median", 2).alias("median_salary_usd"),
        F.round("p25", 2).alias("p25_salary_usd"),
        F.round("p75", 2).alias("p75_salary_usd"),
        _double(F.round("lowest", 2)).alias("min_salary_usd"),
        _double(F.round("highest", 2)).alias("max_salary_usd"),
    )


def item_usage(stg: DataFrame, lists: Sequence[tuple[str, str, str]] = (LANGUAGE, DATABASE)) -> DataFrame:
    """Users, wish to continue and retention per item; ``stg`` has one row per respondent.

    Users are distinct respondents, wishes are mentions: an item repeated inside one
    answer counts twice among the wishes, so retention can exceed 100 percent.
    """
    counts = item_flag_counts(stg, lists)
    users = F.sum(F.when(F.col("is_first"), F.col("n")))
    wishes = F.coalesce(F.sum(F.when(F.col("is_wanted"), F.col("n"))), F.lit(0))
    usage = counts.groupBy(F.col("item").alias("tech_name"), F.col("tag").alias("tech_type")).agg(
        users.alias("total_users"), wishes.alias("want_to_continue_count")
    )
    return _with_retention(usage)


def exploded_usage(exploded: DataFrame, item: str, tech_type: str) -> DataFrame:
    """The same from an exploded layer, in which a respondent may have come from several rows.

    Respondents are first reduced to one row per (item, respondent), so a popular
    item is spread over all tasks.
    """
    per_person = exploded.groupBy(F.col(item).alias("tech_name"), "response_id").agg(
        F.count_if("wants_to_continue").alias("w")
    )
    usage = per_person.groupBy("tech_name").agg(
        F.count("response_id").alias("total_users"), F.sum("w").alias("want_to_continue_count")
    )
    return _with_retention(usage.withColumn("tech_type", F.lit(tech_type)))


def usage_load(rows: DataFrame, ids: DataFrame, lists: Sequence[tuple[str, str, str]] = (LANGUAGE, DATABASE)) -> DataFrame:
    """What one load of answers adds to the usage of items: bitmaps of respondents and wishes, by type and item.

    ``ids`` numbers the respondents of all loads (``dense_ids``); a respondent may have several rows and come in several loads.
    """
    numbered = rows.join(ids, "response_id", "left")
    parts = [
        explode_multiselect(numbered, have, want, "tech_name", ["id"]).withColumn("tech_type", F.lit(tag)) for tag, have, want in lists
    ]
    wishes = F.count_if("wants_to_continue").alias("wishes")
    return bitmaps.id_bitmaps(reduce(DataFrame.unionByName, parts), ["tech_type", "tech_name"], "id", wishes)


def loads_usage(loads: Sequence[DataFrame]) -> DataFrame:
    """Users, wish to continue and retention per item over any loads of ``usage_load``, none of which is read again."""
    group = ["tech_type", "tech_name"]
    whole = bitmaps.merged_bitmaps(loads, group, ["wishes"])
    usage = bitmaps.counted_bitmaps(whole, group, "total_users", ["wishes"])
    return _with_retention(usage.withColumnRenamed("wishes", "want_to_continue_count"))


def _with_retention(usage: DataFrame) -> DataFrame:
    rate = percent(F.col("want_to_continue_count"), F.col("total_users"))
    return usage.select(
        "tech_name", "total_users", "want_to_continue_count", _double(rate).alias("retention_rate_pct"), "tech_type"
    )


def tech_adoption(stg: DataFrame, min_users: int = MIN_TECH_USERS) -> DataFrame:
    """Languages and databases with enough users, ranked by users within their type."""
    return rank_usage(item_usage(stg), min_users)


def rank_usage(usage: DataFrame, min_users: int = MIN_TECH_USERS) -> DataFrame:
    return rank_descending(usage.filter(F.col("total_users") >= min_users), "tech_type", "total_users", "usage_rank")


def tech_adoption_ordered(mart: DataFrame) -> DataFrame:
    return mart.orderBy(*ADOPTION_ORDER)


def respondent_order(mart: DataFrame) -> list:
    return [F.desc("respondent_count"), *(c for c in (*SALARY_KEYS, *SENTIMENT_KEYS[2:]) if c in mart.columns)]


def by_respondents(mart: DataFrame) -> DataFrame:
    """Display order of the salary and sentiment marts: biggest group first."""
    return mart.orderBy(*respondent_order(mart))


def satisfaction_number(c: Column, on_error: str = "null") -> Column:
    r"""The number of a text that is digits only, up to 38 of them; NULL for any other text.

    ``\z`` and not ``$``: the latter also matches before a final newline.
    """
    return to_decimal(F.when(c.rlike(r"^[0-9]+\z"), c), SATISFACTION_TYPE, on_error)


def exact_mean_if_numeric(c: Column, digits: int = 2, on_error: str = "null") -> Column:
    """Mean over the texts that are digits only, as a decimal; the others do not count."""
    number = satisfaction_number(c, on_error)
    return ratio(F.sum(number), F.count(number), digits)


def mean_if_numeric(c: Column, digits: int = 2, on_error: str = "null") -> Column:
    return _double(exact_mean_if_numeric(c, digits, on_error))


def ai_sentiment(
    stg: DataFrame,
    keys: Sequence[str] = SENTIMENT_KEYS,
    min_count: int = MIN_SENTIMENT_GROUP,
    on_error: str = "null",
) -> DataFrame:
    """Groups by country, role and attitude: count, job satisfaction, share that sees AI as a threat.

    With ai_threat among the keys, as by default, the share is 0 or 100.
    """
    answered = stg.filter((F.col("ai_select").isNotNull() | F.col("ai_sent").isNotNull()) & F.col("country").isNotNull())
    n = F.count(F.lit(1))
    threat = percent(F.count_if(F.col("ai_threat").ilike("%Yes%")), n)
    return (
        answered.groupBy(*keys)
        .agg(
            n.alias("respondent_count"),
            mean_if_numeric(F.col("job_sat"), on_error=on_error).alias("avg_job_satisfaction"),
            _double(threat).alias("pct_see_ai_as_threat"),
        )
        .filter(F.col("respondent_count") >= min_count)
    )


def _double(c: Column) -> Column:
    return c.cast("double")
