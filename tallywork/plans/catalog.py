"""The layers under names of SQL: stored tables of the current snapshot, and the exploded layers as views.

Names are views over the tables of one snapshot; publishing again after a build moves them all to the
new one. A query that runs goes on with the tables it began with, as long as their snapshot is kept.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallywork.plans import pipeline
from tallywork.sources.snapshots import register_version

# Database and name of each stored layer, and of the two views.
TABLES = {
    "raw": ("raw", "survey_responses"),
    "staging": ("staging", "stg_survey_responses"),
    "salary": ("marts", "mart_salary_analytics"),
    "adoption": ("marts", "mart_tech_adoption"),
    "sentiment": ("marts", "mart_ai_sentiment"),
    "issues": ("dwh", "dq_issues"),
    "losses": ("dwh", "cast_losses"),
    "tests": ("dwh", "test_results"),
}
VIEWS = {
    "languages": ("intermediate", "int_languages_exploded"),
    "databases": ("intermediate", "int_databases_exploded"),
}
# What the views keep of staging, the lists they explode, and what they call an item.
_EXPLODED = {
    "languages": ("response_id, country, years_code_pro, comp_total_usd, dev_type", "language", "language"),
    "databases": ("response_id, country, dev_type, years_code_pro", "database", "database_name"),
}


def exploded_sql(staging: str, layer: str) -> str:
    """An exploded layer as Spark SQL over a staging table: one row per item, and whether it is mentioned among the wanted ones."""
    keep, kind, item = _EXPLODED[layer]
    # As in mentions(): LIKE only for items with its special characters, where a backslash before any other character is dropped.
    pattern = r"regexp_replace(concat('%', lower(item), '%'), r'(?s)(\\[%_\\])|\\(.)', '$1$2')"
    special = r"contains(item, '%') OR contains(item, '_') OR contains(item, r'\')"
    mentioned = f"CASE WHEN {special} THEN lower(want) LIKE {pattern} ELSE contains(lower(want), lower(item)) END"
    return (
        f"SELECT {keep}, item AS {item}, coalesce({mentioned}, false) AS wants_to_continue FROM ("
        f"SELECT {keep}, {kind}_want_work AS want, trim(BOTH ' ' FROM part) AS item FROM {staging} "
        f"LATERAL VIEW OUTER explode(split({kind}_have_worked, ';')) parts AS part) WHERE item <> ''"
    )


def publish(spark: SparkSession, out: str, prefix: str = "") -> dict[str, str]:
    """Create or move the names of all layers below ``out``; ``prefix`` goes before each database. Returns layer to name."""
    snapshot = pipeline.tables(spark, out).current()
    names = {layer: (f"{prefix}{database}", name) for layer, (database, name) in {**TABLES, **VIEWS}.items()}
    for database in {database for database, _ in names.values()}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = {}
    for layer in TABLES:
        if layer in snapshot:
            made[layer] = ".".join(names[layer])
            source = register_version(spark, snapshot.root, snapshot.tables[layer])
            spark.sql(f"CREATE OR REPLACE VIEW {made[layer]} AS SELECT * FROM {source}")
    if "staging" in made:
        for layer in VIEWS:
            made[layer] = ".".join(names[layer])
            spark.sql(f"CREATE OR REPLACE VIEW {made[layer]} AS {exploded_sql(made['staging'], layer)}")
    return made
