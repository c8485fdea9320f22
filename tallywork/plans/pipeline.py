"""The whole run: load, check, build, test. Each step reads stored tables, so it can run on its own."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tallywork.plans import marts, quality
from tallywork.plans.staging import cast_losses, stage
from tallywork.sources.ingest import load_raw, timestamp
from tallywork.sources.schemas import ISSUES_SCHEMA
from tallywork.sources.snapshots import Draft, Snapshot, TableSet
from tallywork.sources.tables import scratch_of_run

LAYERS = {
    "raw": "raw/survey_responses",
    "staging": "staging/survey_responses",
    "salary": "marts/salary_analytics",
    "adoption": "marts/tech_adoption",
    "sentiment": "marts/ai_sentiment",
    "issues": "quality/issues",
    "losses": "quality/cast_losses",
    "tests": "quality/test_results",
}
KEY = "response_id"


def tables(spark: SparkSession, out: str) -> TableSet:
    return TableSet(spark, out, LAYERS)


def table(spark: SparkSession, out: str, layer: str) -> DataFrame:
    """A layer as of now; later refreshes do not change what it reads."""
    return tables(spark, out).current().read(layer)


def now() -> datetime:
    return datetime.now(timezone.utc)


def layers_of(snapshot: Snapshot) -> dict[str, DataFrame]:
    """Every layer under test, the exploded ones as views."""
    stored = {name: snapshot.read(name) for name in ("raw", "staging", "salary", "adoption", "sentiment")}
    views = {
        "languages": marts.languages_exploded(stored["staging"]),
        "databases": marts.databases_exploded(stored["staging"]),
    }
    return stored | views


def layers(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    return layers_of(tables(spark, out).current())


def write_raw(draft: Draft, raw: DataFrame) -> DataFrame:
    """The raw layer in buckets of its key; the row checks and tests are counted on the way."""
    counts = quality.check_counts(quality.SURVEY_CHECKS) | quality.test_counts("raw")
    return draft.write("raw", raw, counts, key=KEY)


def write_issues(draft: Draft, at: datetime) -> None:
    raw = draft.read("raw")
    report = quality.run_checks(raw, observed=draft.now().observed("raw")).withColumn("logged_at", timestamp(at))
    draft.write("issues", report.select(*ISSUES_SCHEMA.names))
    draft.write("losses", cast_losses(raw))


def write_staging(draft: Draft, on_error: str) -> DataFrame:
    """Staging in buckets of its key, which come from those of the raw layer without a shuffle of its own.

    The tests of the exploded layers, which are views of staging, are counted here as well.
    """
    return draft.write("staging", stage(draft.read("raw"), on_error), quality.test_counts("staging"), key=KEY, arranged=True)


def write_marts(draft: Draft, on_error: str) -> None:
    stg = draft.read("staging")
    draft.write("salary", marts.salary_segments(stg), quality.test_counts("salary"))
    draft.write("adoption", marts.tech_adoption(stg), quality.test_counts("adoption"))
    draft.write("sentiment", marts.ai_sentiment(stg, on_error=on_error), quality.test_counts("sentiment"))


def write_tests(draft: Draft) -> None:
    snapshot = draft.now()
    observed = {k: n for layer in quality.WRITTEN_WITH if layer in snapshot for k, n in snapshot.observed(layer).items()}
    draft.write("tests", quality.run_tests(layers_of(snapshot), observed=observed))


def ingest(
    spark: SparkSession, src: str | Sequence[str], out: str, at: datetime | None = None, records: str = "auto"
) -> DataFrame:
    """Full refresh of the raw layer; every row carries the same load time."""
    with scratch_of_run(spark), tables(spark, out).draft() as draft:
        write_raw(draft, load_raw(spark, src, at or now(), records))
    return draft.read("raw")


def check(spark: SparkSession, out: str, at: datetime | None = None) -> DataFrame:
    """Replace the issues table with the counts over the raw layer. Findings never stop the run.

    Beside it, the number of texts that staging will turn into NULL, per column.
    """
    with tables(spark, out).draft() as draft:
        write_issues(draft, at or now())
    return quality.with_severity(draft.read("issues"))


def build(spark: SparkSession, out: str, on_error: str = "null") -> dict[str, DataFrame]:
    """Staging and the marts.

    Staging is written once, since four consumers read it; the exploded layers stay views over
    it. All tables become current together, so a build that fails half-way changes none of them.
    """
    with scratch_of_run(spark), tables(spark, out).draft() as draft:
        write_staging(draft, on_error)
        write_marts(draft, on_error)
    return {name: draft.read(name) for name in ("staging", "salary", "adoption", "sentiment")}


def test(spark: SparkSession, out: str) -> DataFrame:
    """Run the declared tests and store their results."""
    with tables(spark, out).draft() as draft:
        write_tests(draft)
    return draft.read("tests")


def run(
    spark: SparkSession,
    src: str | Sequence[str],
    out: str,
    at: datetime | None = None,
    records: str = "auto",
    on_error: str = "null",
) -> dict[str, DataFrame]:
    """Load, check, build, test, in that order; returns every stored table.

    All tables of a run become current together at its end. A run that died is gone on with by the next
    one over the same files with the same parameters: steps that were complete are not repeated, and the
    load time is that of the first try. Files are told apart by name, length and time.
    """
    paths = [src] if isinstance(src, str) else list(src)
    draft = tables(spark, out).draft(resume=True)
    parameters: Mapping[str, str] = {
        "files": draft.tables.files.fingerprint(paths),
        "paths": json.dumps(paths),
        "at": at.isoformat() if at else "",
        "records": records,
        "on_error": on_error,
    }
    key = hashlib.sha256(json.dumps(parameters, sort_keys=True).encode()).hexdigest()
    moment = datetime.fromisoformat(draft.recall("at", key, (at or now()).isoformat()))
    with scratch_of_run(spark):
        draft.step("ingest", key, lambda: write_raw(draft, load_raw(spark, src, moment, records)))
        draft.step("check", key, lambda: write_issues(draft, moment))
        draft.step("staging", key, lambda: write_staging(draft, on_error))
        draft.step("marts", key, lambda: write_marts(draft, on_error))
        draft.step("test", key, lambda: write_tests(draft))
        snapshot = draft.commit()
    found = {name: snapshot.read(name) for name in LAYERS}
    return found | {"issues": quality.with_severity(found["issues"])}
