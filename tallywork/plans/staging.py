"""Staging: the latest row per response, with numbers as numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.text import money_number, phrase_number
from tallywork.operators.dedupe import latest_per_key
from tallywork.sources.schemas import PAY_TYPE, SATISFACTION_TYPE, YEARS_TYPE

# Answers in words and the years they stand for.
YEARS_PHRASES = {"Less than 1 year": 0, "More than 50 years": 51}

# The columns of the staging layer.
STAGING_COLUMNS = (
    "response_id", "main_branch", "age", "remote_work", "ed_level", "years_code", "years_code_pro", "country",
    "currency", "dev_type", "org_size", "industry", "language_have_worked", "language_want_work",
    "database_have_worked", "database_want_work", "platform_have_worked", "platform_want_work", "ai_select",
    "ai_sent", "ai_threat", "job_sat", "comp_total_usd", "loaded_at",
)


def years_number(column: str, on_error: str = "null") -> Column:
    return phrase_number(F.col(column), YEARS_PHRASES, YEARS_TYPE, on_error)


def pay_number(column: str, on_error: str = "null") -> Column:
    """Pay as a number in the respondent's own currency: no rate is applied, whatever the name says."""
    return money_number(F.col(column), PAY_TYPE, on_error)


def stage(
    raw: DataFrame, on_error: str = "null", tiebreak: Sequence[str] | None = None, latest=latest_per_key
) -> DataFrame:
    """The staging layer. See ``latest_per_key`` for ``tiebreak``, ``to_decimal`` for ``on_error``.

    ``latest`` is the way duplicates are removed.
    """
    rows = latest(raw, "response_id", "loaded_at", tiebreak)
    numbers = {
        "years_code": years_number("years_code", on_error),
        "years_code_pro": years_number("years_code_pro", on_error),
        "comp_total_usd": pay_number("comp_total", on_error),
    }
    return rows.select(*[numbers[c].alias(c) if c in numbers else c for c in STAGING_COLUMNS])


def cast_losses(raw: DataFrame) -> DataFrame:
    """How many raw values staging or a mart turns into NULL because they are no number or do not fit, per column."""

    def lost(column: str, number: Column, had_text: Column) -> Column:
        return F.count_if(had_text & number.isNull()).alias(column)

    digits = F.regexp_replace("comp_total", "[^0-9.]", "")
    rated = F.col("job_sat").rlike(r"^[0-9]+\z")
    return raw.select(
        lost("years_code", years_number("years_code"), F.col("years_code").isNotNull()),
        lost("years_code_pro", years_number("years_code_pro"), F.col("years_code_pro").isNotNull()),
        lost("comp_total", pay_number("comp_total"), digits != ""),
        lost("job_sat", F.col("job_sat").try_cast(SATISFACTION_TYPE), rated),
    ).unpivot([], ["years_code", "years_code_pro", "comp_total", "job_sat"], "column_name", "row_count")
