"""The registered queries as plain SQL over the given tables.

Written apart from the Spark plans: distinct counts, window ranks and percentile
functions where the package uses other ways. Ratios are rounded in whole numbers,
since doubles would round some halves down.
"""

from __future__ import annotations

from tallywork.sources.schemas import CSV_NULLS, SENTINELS, SURVEY_COLUMNS
from tallywork.survey_fixture import raw_survey_ctes

# Years in words, and the upper bounds of the experience bands.
_YEARS_IN_WORDS = {"Less than 1 year": 0, "More than 50 years": 51}
_BANDS = {"0-1 years": 2, "2-4 years": 5, "5-9 years": 10, "10-19 years": 20}

_PHRASES = ", ".join(f"'{phrase}'" for phrase in _YEARS_IN_WORDS)


def _years(column: str) -> str:
    words = " ".join(f"WHEN '{phrase}' THEN {years}" for phrase, years in _YEARS_IN_WORDS.items())
    return f"coalesce(CASE {column} {words} END, TRY_CAST({column} AS DECIMAL(38,6)))"


# A pay in exponent form is that number without its sign; of any other text the digits and dots count.
_PAY = (
    "TRY_CAST(CASE WHEN regexp_full_match(comp_total, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)[eE][+-]?[0-9]+') "
    "THEN ltrim(comp_total, '+-') ELSE regexp_replace(comp_total, '[^0-9.]', '', 'g') END AS DECIMAL(38,10))"
)

_AS_IS = (
    "main_branch, age, remote_work, ed_level, country, currency, dev_type, org_size, industry, "
    "language_have_worked, language_want_work, database_have_worked, database_want_work, "
    "platform_have_worked, platform_want_work, ai_select, ai_sent, ai_threat, job_sat, loaded_at"
)

_STAGING = (
    ", latest AS (SELECT * FROM raw WHERE response_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY loaded_at DESC NULLS LAST) = 1), "
    f"stg AS (SELECT response_id, {_years('years_code')} AS years_code, {_years('years_code_pro')} AS years_code_pro, "
    f"{_PAY} AS comp_total_usd, {_AS_IS} FROM latest)"
)


def from_raw(sql: str, variant: str = "base") -> str:
    return f"{raw_survey_ctes(variant)} {sql}"


def from_staging(sql: str, variant: str = "base", ctes: str = "") -> str:
    return f"{raw_survey_ctes(variant)}{_STAGING}{ctes} {sql}"


def exploded(kind: str, item: str, keep: str) -> str:
    """A CTE named after ``kind`` with one row per item."""
    return (
        f", parts_{kind} AS (SELECT {keep}, {kind}_want_work AS want, "
        f"unnest(string_split({kind}_have_worked, ';')) AS part FROM stg), "
        f"{kind} AS (SELECT {keep}, trim(part, ' ') AS {item}, "
        f"coalesce(want ILIKE '%' || trim(part, ' ') || '%', false) AS wants_to_continue "
        f"FROM parts_{kind} WHERE trim(part, ' ') <> '')"
    )


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator for whole numbers not below zero, rounded half up."""
    scale = 10**digits
    return (
        f"CAST((2 * {scale} * CAST({numerator} AS HUGEINT) + {denominator}) // (2 * {denominator}) AS DOUBLE) / {scale}"
    )


def usage(kind: str, item: str, tag: str) -> str:
    rate = half_up("100 * count(*) FILTER (WHERE wants_to_continue)", "count(DISTINCT response_id)", 1)
    return (
        f"SELECT {item} AS tech_name, count(DISTINCT response_id) AS total_users, "
        f"count(*) FILTER (WHERE wants_to_continue) AS want_to_continue_count, "
        f"{rate} AS retention_rate_pct, '{tag}' AS tech_type FROM {kind} GROUP BY {item}"
    )


_LANGUAGES = exploded("language", "language", "response_id, country, years_code_pro, comp_total_usd, dev_type")
_DATABASES = exploded("database", "database_name", "response_id, country, dev_type, years_code_pro")
_PLATFORMS = exploded("platform", "platform", "response_id")

_BAND = (
    "CASE WHEN years_code_pro IS NULL THEN 'Unknown' "
    + " ".join(f"WHEN years_code_pro < {bound} THEN '{label}'" for label, bound in _BANDS.items())
    + " ELSE '20+ years' END"
)
_IN_RANGE = "comp_total_usd BETWEEN 10000 AND 5000000 AND country IS NOT NULL"


def quartiles(value: str, suffix: str = "", digits: int | None = None) -> str:
    def one(p: str, name: str) -> str:
        q = f"percentile_cont({p}) WITHIN GROUP (ORDER BY CAST({value} AS DOUBLE))"
        return (q if digits is None else f"round({q}, {digits})") + f" AS {name}{suffix}"

    return ", ".join(one(p, name) for p, name in (("0.25", "p25"), ("0.5", "median"), ("0.75", "p75")))


_SALARY_KEYS = "country, experience_band, dev_type, remote_work, org_size"
_MEAN_PAY = half_up("sum(CAST(comp_total_usd * 100 AS BIGINT))", "(100 * count(*))", 2)
_SALARY = (
    f"SELECT {_SALARY_KEYS}, count(*) AS respondent_count, {_MEAN_PAY} AS avg_salary_usd, "
    f"{quartiles('comp_total_usd', '_salary_usd', 2)}, "
    "CAST(round(min(comp_total_usd), 2) AS DOUBLE) AS min_salary_usd, "
    "CAST(round(max(comp_total_usd), 2) AS DOUBLE) AS max_salary_usd "
    f"FROM (SELECT *, {_BAND} AS experience_band FROM stg WHERE {_IN_RANGE}) banded "
    f"GROUP BY {_SALARY_KEYS} HAVING count(*) >= 5"
)

_ADOPTION_CTES = (
    _LANGUAGES
    + _DATABASES
    + f", used AS ({usage('language', 'language', 'Language')} UNION ALL {usage('database', 'database_name', 'Database')}), "
    "adoption AS (SELECT *, rank() OVER (PARTITION BY tech_type ORDER BY total_users DESC) AS usage_rank "
    "FROM used WHERE total_users >= 100)"
)

_DIGITS = "regexp_full_match(job_sat, '[0-9]+')"
_JOB_SAT = (
    f"CASE WHEN count(*) FILTER (WHERE {_DIGITS}) = 0 THEN NULL ELSE "
    + half_up(
        f"sum(CASE WHEN {_DIGITS} THEN TRY_CAST(job_sat AS DECIMAL(38,0)) END)", f"count(*) FILTER (WHERE {_DIGITS})", 2
    )
    + " END AS avg_job_satisfaction"
)


def sentiment(keys: str) -> str:
    threat = half_up("100 * count(*) FILTER (WHERE ai_threat ILIKE '%Yes%')", "count(*)", 1)
    return (
        f"SELECT {keys}, count(*) AS respondent_count, {_JOB_SAT}, {threat} AS pct_see_ai_as_threat FROM stg "
        f"WHERE (ai_select IS NOT NULL OR ai_sent IS NOT NULL) AND country IS NOT NULL GROUP BY {keys} HAVING count(*) >= 3"
    )


_SENTIMENT = sentiment("country, dev_type, ai_select, ai_sent, ai_threat")

# Names, types and texts of the checks. Beside them, the rows that each counts over raw.
_CHECKS = {
    "null_response_id": ("NULL_PRIMARY_KEY", "Rows with null response_id", "response_id IS NULL"),
    "duplicate_response_id": ("DUPLICATE_KEY", "Distinct response_ids appearing more than once", None),
    "null_country": ("MISSING_DIMENSION", "Rows with null country", "country IS NULL"),
    "null_comp_total": ("MISSING_METRIC", "Rows with null comp_total", "comp_total IS NULL"),
    "invalid_years_code_pro": (
        "FORMAT_INCONSISTENCY",
        "years_code_pro not null, not special literals, contains non-numeric characters",
        f"years_code_pro IS NOT NULL AND years_code_pro NOT IN ({_PHRASES}) AND regexp_matches(years_code_pro, '[^0-9]')",
    ),
    "total_rows_loaded": ("AUDIT", "Total rows in raw.survey_responses", "true"),
}
_REPEATED = "SELECT count(*) FILTER (WHERE n > 1) FROM (SELECT count(*) AS n FROM raw GROUP BY response_id) keys"


def _count(name: str) -> str:
    where = _CHECKS[name][2]
    return f"SELECT count(*) FROM raw WHERE {where}" if where else _REPEATED


def one_check(name: str, variant: str = "base") -> str:
    return from_raw(f"SELECT '{name}' AS check_name, ({_count(name)}) AS row_count", variant)


_REPORT = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, '{kind}' AS issue_type, ({_count(name)}) AS row_count, '{details}' AS details"
    for name, (kind, details, _) in _CHECKS.items()
)
_SEVERITY = "CASE WHEN row_count > 0 AND issue_type <> 'AUDIT' THEN 'warn' ELSE 'info' END AS severity"

_ORDER_CHECKS = (
    "SELECT 'null_customer' AS check_name, 'MISSING_DIMENSION' AS issue_type, "
    "(SELECT count(*) FROM orders WHERE o_custkey IS NULL) AS row_count, 'Orders without customer' AS details "
    "UNION ALL SELECT 'repeated_customer', 'DUPLICATE_KEY', (SELECT count(*) FROM (SELECT o_custkey FROM orders "
    "GROUP BY o_custkey HAVING count(*) > 1) twice), 'Customers with several orders' "
    "UNION ALL SELECT 'odd_priority', 'FORMAT_INCONSISTENCY', "
    "(SELECT count(*) FROM orders WHERE regexp_matches(o_orderpriority, '^[^1]')), 'Priority not urgent' "
    "UNION ALL SELECT 'orders', 'AUDIT', (SELECT count(*) FROM orders), 'All orders'"
)



def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_SPACES = " || ".join(f"chr({i})" for i in range(0x3001) if chr(i).isspace())


def cleaned(column: str) -> str:
    trimmed = f"trim({column}, {_SPACES})"
    return f"CASE WHEN {column} NOT IN ({_listed(CSV_NULLS)}) AND {trimmed} NOT IN ({_listed(SENTINELS)}) THEN {trimmed} END AS {column}"


def _failures(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS test_name, count(*) AS failures FROM ({sql}) failing"


def _not_null(layer: str, table: str, column: str) -> str:
    return _failures(f"not_null.{layer}.{column}", f"SELECT {column} FROM {table} WHERE {column} IS NULL")


def _accepted(layer: str, table: str, column: str, values: str) -> str:
    return _failures(
        f"accepted_values.{layer}.{column}",
        f"SELECT {column}, count(*) AS n FROM {table} GROUP BY {column} HAVING {column} NOT IN ({values})",
    )


_TESTS = " UNION ALL ".join(
    [
        _not_null("raw", "raw", "response_id"),
        _failures(
            "unique.staging.response_id",
            "SELECT response_id FROM stg WHERE response_id IS NOT NULL GROUP BY response_id HAVING count(*) > 1",
        ),
        _not_null("staging", "stg", "response_id"),
        _not_null("languages", "language", "response_id"),
        _not_null("languages", "language", "language"),
        _accepted("languages", "language", "wants_to_continue", "true, false"),
        _not_null("databases", "database", "response_id"),
        _not_null("databases", "database", "database_name"),
        _not_null("salary", "salary", "respondent_count"),
        _not_null("adoption", "adoption", "tech_name"),
        _not_null("adoption", "adoption", "tech_type"),
        _accepted("adoption", "adoption", "tech_type", "'Language', 'Database'"),
        _not_null("sentiment", "sentiment", "respondent_count"),
    ]
)
_MARTS = _ADOPTION_CTES + f", salary AS ({_SALARY}), sentiment AS ({_SENTIMENT})"

_STAGING_OUT = (
    f"SELECT response_id, CAST(years_code AS DOUBLE) AS years_code, CAST(years_code_pro AS DOUBLE) AS years_code_pro, "
    f"CAST(comp_total_usd AS DOUBLE) AS comp_total_usd, {_AS_IS} FROM stg"
)
_LOST_YEARS = "{0} IS NOT NULL AND {0} NOT IN (" + _PHRASES + ") AND TRY_CAST({0} AS DECIMAL(38,6)) IS NULL"
_LOST = " UNION ALL ".join(
    f"SELECT '{column}' AS column_name, count(*) FILTER (WHERE {test}) AS row_count FROM raw"
    for column, test in (
        ("years_code", _LOST_YEARS.format("years_code")),
        ("years_code_pro", _LOST_YEARS.format("years_code_pro")),
        ("comp_total", f"regexp_matches(comp_total, '[0-9.]') AND {_PAY} IS NULL"),
        ("job_sat", "regexp_full_match(job_sat, '[0-9]+') AND TRY_CAST(job_sat AS DECIMAL(38,0)) IS NULL"),
    )
)

# The mean of whole numbers as text with two decimals, rounded half up in whole numbers.
_CENTS = "(200 * total + n) // (2 * n)"
_EXACT_MEAN = (
    f"CASE WHEN n > 0 THEN CAST({_CENTS} // 100 AS VARCHAR) || '.' || lpad(CAST(({_CENTS}) % 100 AS VARCHAR), 2, '0') END"
)


def _ranked(mart: str, keys: str) -> str:
    """The groups of a mart with their place: the biggest first, then by key."""
    order = ", ".join(f"{key} NULLS FIRST" for key in keys.split(", "))
    return f"SELECT row_number() OVER (ORDER BY respondent_count DESC, {order}) AS place, {keys} FROM ({mart}) mart"


_ALL_ROWS = _STAGING.replace(
    "SELECT * FROM raw WHERE response_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY loaded_at DESC NULLS LAST) = 1",
    "SELECT * FROM raw",
)
_THREE_TYPES = _MARTS.replace(
    "), adoption AS", f" UNION ALL {usage('platform', 'platform', 'Platform')}), adoption AS", 1
)

# A whole run loads the cleaned texts at one time, so equal keys are told apart by their texts alone.
_TEXTS = tuple(SURVEY_COLUMNS.values())
_TIDY = f"SELECT {', '.join(cleaned(c) for c in _TEXTS)}, TIMESTAMP '2024-07-01 00:00:00' AS loaded_at FROM raw"
_RUN = f", tidy AS ({_TIDY})" + _STAGING.replace(
    "SELECT * FROM raw WHERE response_id IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY loaded_at DESC NULLS LAST) = 1",
    "SELECT * FROM tidy WHERE response_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY "
    + ", ".join(f"{c} NULLS LAST" for c in _TEXTS if c != "response_id")
    + ") = 1",
)
_RUN_LAYERS = " UNION ALL ".join(
    [
        *(
            f"SELECT '{name}' AS name, count(*) AS n FROM {table}"
            for name, table in (
                ("raw", "tidy"), ("staging", "stg"), ("languages", "language"), ("databases", "database"),
                ("salary", "salary"), ("adoption", "adoption"), ("sentiment", "sentiment"),
            )
        ),
        "VALUES ('issues', 6), ('losses', 4), ('tests', 13)",
        f"SELECT test_name, failures FROM ({_TESTS.replace('FROM raw ', 'FROM tidy ')}) tests",
    ]
)


ORACLE: dict[str, str] = {
    "select_rename": (
        "SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS clerk, "
        "o_orderpriority AS priority FROM orders"
    ),
    "clean_sentinels": from_raw(f"SELECT {', '.join(cleaned(c) for c in SURVEY_COLUMNS.values())} FROM raw", "uncleaned"),
    "clean_documents": f"SELECT doc_id, {cleaned('text')}, {cleaned('lang')} FROM documents",
    "csv_documents": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents",
    "csv_documents_auto": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents",
    "replaced_table": from_raw("SELECT response_id, country FROM raw"),
    "csv_raw_layer": from_raw(
        f"SELECT {', '.join(cleaned(c) for c in SURVEY_COLUMNS.values())}, TIMESTAMP '2024-07-01 00:00:00' AS loaded_at FROM raw",
        "uncleaned",
    ),
    "raw_profile": from_raw(
        "SELECT count(*) AS n_rows, count(response_id) AS n_ids, count(DISTINCT response_id) AS n_distinct_ids, "
        "count(country) AS n_country, count(comp_total) AS n_comp FROM raw"
    ),
    "stg_dedup": from_staging("SELECT * FROM latest"),
    "stg_dedup_stored": from_staging("SELECT * FROM latest"),
    "latest_event_per_user": (
        "SELECT * FROM events WHERE user_id IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1"
    ),
    "years_numeric": from_staging(
        "SELECT response_id, CAST(years_code AS DOUBLE) AS years_code, CAST(years_code_pro AS DOUBLE) AS years_code_pro "
        "FROM stg"
    ),
    "years_numeric_odd": from_staging(
        "SELECT response_id, CAST(years_code_pro AS DOUBLE) AS years_code_pro FROM stg", "odd_years"
    ),
    "comp_numeric": from_staging("SELECT response_id, CAST(comp_total_usd AS DOUBLE) AS comp_total_usd FROM stg"),
    "comp_numeric_exponent": from_staging(
        "SELECT response_id, CAST(comp_total_usd AS DOUBLE) AS comp_total_usd FROM stg", "exponents"
    ),
    "cast_losses_exponent": from_raw(_LOST, "exponents"),
    "stg_survey": from_staging(_STAGING_OUT),
    "cast_losses_odd": from_raw(_LOST, "odd_years"),
    "explode_multiselect": from_staging("SELECT response_id, language AS item FROM language", ctes=_LANGUAGES),
    "wants_to_continue": from_staging(
        "SELECT response_id, database_name AS item, wants_to_continue FROM database", ctes=_DATABASES
    ),
    "wants_to_continue_exact": from_staging(
        "SELECT response_id, trim(part, ' ') AS item, "
        "coalesce(list_contains(string_split(want, ';'), trim(part, ' ')), false) AS wants_to_continue "
        "FROM parts_database WHERE trim(part, ' ') <> ''",
        ctes=_DATABASES,
    ),
    "platforms_exploded": from_staging("SELECT * FROM platform", ctes=_PLATFORMS),
    "languages_exploded": from_staging(
        "SELECT response_id, country, CAST(years_code_pro AS DOUBLE) AS years_code_pro, "
        "CAST(comp_total_usd AS DOUBLE) AS comp_total_usd, dev_type, language, wants_to_continue FROM language",
        ctes=_LANGUAGES,
    ),
    "databases_exploded": from_staging(
        "SELECT response_id, country, dev_type, CAST(years_code_pro AS DOUBLE) AS years_code_pro, database_name, "
        "wants_to_continue FROM database",
        ctes=_DATABASES,
    ),
    "experience_band": from_staging(f"SELECT {_BAND} AS experience_band, count(*) AS n FROM stg GROUP BY 1"),
    "account_balance_band": (
        "SELECT CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 2500 "
        "THEN 'low' WHEN c_acctbal < 5000 THEN 'middle' ELSE 'high' END AS band, count(*) AS n FROM customer GROUP BY 1"
    ),
    "salary_range_filter": from_staging(
        f"SELECT response_id, CAST(comp_total_usd AS DOUBLE) AS comp_total_usd FROM stg WHERE {_IN_RANGE}"
    ),
    "salary_percentiles": from_staging(
        f"SELECT country, {quartiles('comp_total_usd')} FROM stg WHERE {_IN_RANGE} GROUP BY country"
    ),
    "price_percentiles": (
        f"SELECT l_returnflag, l_linestatus, count(*) AS n, {quartiles('round(l_extendedprice * 100)')} "
        "FROM lineitem GROUP BY l_returnflag, l_linestatus"
    ),
    "salary_segments": from_staging(_SALARY),
    "retention_rate": from_staging(
        f"{usage('language', 'language', 'Language')} UNION ALL {usage('database', 'database_name', 'Database')}",
        ctes=_LANGUAGES + _DATABASES,
    ),
    "usage_from_loads": (
        f"{raw_survey_ctes()}{_ALL_ROWS}{_LANGUAGES}{_DATABASES} {usage('language', 'language', 'Language')} "
        f"UNION ALL {usage('database', 'database_name', 'Database')}"
    ),
    "item_usage": from_staging(
        f"{usage('language', 'language', 'Language')} UNION ALL {usage('database', 'database_name', 'Database')} "
        f"UNION ALL {usage('platform', 'platform', 'Platform')}",
        ctes=_LANGUAGES + _DATABASES + _PLATFORMS,
    ),
    "usage_rank": from_staging(
        "SELECT tech_type, tech_name, total_users, usage_rank FROM adoption", ctes=_ADOPTION_CTES
    ),
    "tech_adoption": from_staging("SELECT * FROM adoption", ctes=_ADOPTION_CTES),
    "sql_adoption": from_staging("SELECT * FROM adoption", ctes=_ADOPTION_CTES),
    "whole_run": f"{raw_survey_ctes('uncleaned')}{_RUN}{_ADOPTION_CTES} SELECT * FROM adoption",
    "whole_run_layers": f"{raw_survey_ctes('uncleaned')}{_RUN}{_MARTS} {_RUN_LAYERS}",
    "avg_if_numeric": from_staging(f"SELECT country, {_JOB_SAT} FROM stg GROUP BY country"),
    "ai_sentiment": from_staging(_SENTIMENT),
    "avg_if_numeric_long": from_staging(
        f"SELECT country, {_EXACT_MEAN} AS avg_job_satisfaction FROM (SELECT country, count(*) FILTER (WHERE {_DIGITS}) AS n, "
        f"sum(CASE WHEN {_DIGITS} THEN CAST(job_sat AS HUGEINT) END) AS total FROM stg GROUP BY country) sums",
        "long_ratings",
    ),
    "adoption_ordered": from_staging(
        "SELECT row_number() OVER (ORDER BY tech_type, usage_rank, tech_name) AS place, tech_type, tech_name FROM adoption",
        ctes=_ADOPTION_CTES,
    ),
    "salary_ordered": from_staging(_ranked(_SALARY, _SALARY_KEYS)),
    "sentiment_ordered": from_staging(_ranked(_SENTIMENT, "country, dev_type, ai_select, ai_sent, ai_threat")),
    "ai_threat_share": from_staging(sentiment("country, dev_type, ai_select, ai_sent")),
    "dq_null_key": one_check("null_response_id"),
    "dq_duplicate_key": one_check("duplicate_response_id"),
    "dq_null_country": one_check("null_country"),
    "dq_null_comp": one_check("null_comp_total"),
    "dq_invalid_format": one_check("invalid_years_code_pro", "odd_years"),
    "dq_total_rows": one_check("total_rows_loaded"),
    "dq_report": from_raw(_REPORT),
    "issues_stored": from_raw(_REPORT),
    "dq_severity": from_raw(f"SELECT *, {_SEVERITY} FROM ({_REPORT}) report", "odd_years"),
    "dq_orders": f"SELECT *, {_SEVERITY} FROM ({_ORDER_CHECKS}) report",
    "test_not_null": from_raw("SELECT response_id FROM raw WHERE response_id IS NULL"),
    "test_unique": from_raw(
        "SELECT response_id AS unique_field, count(*) AS n_records FROM raw WHERE response_id IS NOT NULL "
        "GROUP BY response_id HAVING count(*) > 1"
    ),
    "test_accepted_values": from_raw(
        "SELECT remote_work AS value_field, count(*) AS n_records FROM raw GROUP BY remote_work "
        "HAVING remote_work NOT IN ('Remote')"
    ),
    "test_results": from_staging(
        f"SELECT test_name, failures, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM ({_TESTS}) tests",
        ctes=_MARTS,
    ),
    "test_results_broken": (
        f"{raw_survey_ctes()}{_ALL_ROWS}{_PLATFORMS}{_THREE_TYPES} SELECT test_name, failures, failures <> 0 AS should_warn, "
        f"failures <> 0 AS should_error FROM ({_TESTS}) tests"
    ),
}
