"""Declared schemas and the source-to-target column contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column -> raw column.
SURVEY_COLUMNS = {
    "ResponseId": "response_id",
    "MainBranch": "main_branch",
    "Age": "age",
    "RemoteWork": "remote_work",
    "EdLevel": "ed_level",
    "YearsCode": "years_code",
    "YearsCodePro": "years_code_pro",
    "DevType": "dev_type",
    "OrgSize": "org_size",
    "Country": "country",
    "Currency": "currency",
    "CompTotal": "comp_total",
    "LanguageHaveWorkedWith": "language_have_worked",
    "LanguageWantToWorkWith": "language_want_work",
    "DatabaseHaveWorkedWith": "database_have_worked",
    "DatabaseWantToWorkWith": "database_want_work",
    "PlatformHaveWorkedWith": "platform_have_worked",
    "PlatformWantToWorkWith": "platform_want_work",
    "AISelect": "ai_select",
    "AISent": "ai_sent",
    "AIThreat": "ai_threat",
    "JobSat": "job_sat",
    "Industry": "industry",
}

# Texts that mean "no answer", compared after trimming.
SENTINELS = ("NA", "N/A", "nan", "NaN", "None", "")

# Fields a default CSV reader takes as null, compared before trimming.
CSV_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Names and types of the raw layer and of the issues table.
RAW_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in SURVEY_COLUMNS.values()]
    + [T.StructField("loaded_at", T.TimestampNTZType())]
)

ISSUES_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("issue_type", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("details", T.StringType()),
        T.StructField("logged_at", T.TimestampNTZType()),
    ]
)

YEARS_TYPE = "decimal(38,6)"
PAY_TYPE = "decimal(38,10)"
SATISFACTION_TYPE = "decimal(38,0)"
