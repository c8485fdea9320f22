"""Quality counts on the raw layer and declarative tests on every layer.

Counts of single rows need no scan of their own: ``check_counts`` and ``test_counts`` are aggregates to be
observed while a layer is written, and ``run_checks`` and ``run_tests`` take what was observed.
Only repeated keys, and values outside a list once there are any, are looked for in the layer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.operators.multiselect import item_flags, trimmed_items
from tallywork.plans import marts
from tallywork.plans.staging import YEARS_PHRASES

AUDIT = "AUDIT"


@dataclass(frozen=True)
class Check:
    """A count over a table: of rows that meet ``where`` (None: all rows), or of repeated ``key`` values."""

    name: str
    issue_type: str
    details: str
    where: str | None = None
    key: str | None = None


_PHRASES = ", ".join(f"'{p}'" for p in YEARS_PHRASES)

# Names, types and texts of the six checks.
SURVEY_CHECKS = (
    Check("null_response_id", "NULL_PRIMARY_KEY", "Rows with null response_id", where="response_id IS NULL"),
    Check(
        "duplicate_response_id",
        "DUPLICATE_KEY",
        "Distinct response_ids appearing more than once",
        key="response_id",
    ),
    Check("null_country", "MISSING_DIMENSION", "Rows with null country", where="country IS NULL"),
    Check("null_comp_total", "MISSING_METRIC", "Rows with null comp_total", where="comp_total IS NULL"),
    Check(
        "invalid_years_code_pro",
        "FORMAT_INCONSISTENCY",
        "years_code_pro not null, not special literals, contains non-numeric characters",
        where=f"years_code_pro NOT IN ({_PHRASES}) AND years_code_pro RLIKE '[^0-9]'",
    ),
    Check("total_rows_loaded", AUDIT, "Total rows in raw.survey_responses"),
)


def survey_check(name: str) -> Check:
    return next(c for c in SURVEY_CHECKS if c.name == name)


def _where(check: Check) -> Column:
    return F.expr(check.where) if check.where else F.lit(True)


def check_counts(checks: Sequence[Check] = SURVEY_CHECKS) -> dict[str, Column]:
    """The row checks as aggregates, by check name."""
    return {c.name: F.count_if(_where(c)) for c in checks if c.key is None}


def _known(df: DataFrame, counts: Mapping[str, int], name: str, count: str) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(k).alias(name), F.lit(n).cast("long").alias(count)) for k, n in counts.items()))
    return df.sparkSession.range(0, 1, 1, 1).select(F.inline(rows))  # one task, nothing is sent to it


def run_checks(
    df: DataFrame, checks: Sequence[Check] = SURVEY_CHECKS, observed: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per check: check_name, issue_type, row_count, details.

    Row conditions are taken from ``observed`` (by check name) or counted, all in one scan. Only a repeated-key
    check groups, and reads its key column alone: on a layer in buckets of the key nothing is shuffled, else
    equal keys, NULL among them, are counted before they are sent, so a hot key is one row per task.
    """
    parts = []
    known = {c.name: observed[c.name] for c in checks if c.key is None and c.name in (observed or {})}
    if known:
        parts.append(_known(df, known, "check_name", "row_count"))
    counted = [c for c in checks if c.key is None and c.name not in known]
    if counted:
        counts = df.select(*[F.count_if(_where(c)).alias(c.name) for c in counted])
        parts.append(counts.unpivot([], [f"`{c.name}`" for c in counted], "check_name", "row_count"))
    for check in checks:
        if check.key is not None:
            repeated = df.groupBy(check.key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
            parts.append(repeated.select(F.lit(check.name).alias("check_name"), F.count(F.lit(1)).alias("row_count")))
    counts = reduce(DataFrame.unionByName, parts)
    facts = F.create_map(*[x for c in checks for x in (F.lit(c.name), F.struct(F.lit(c.issue_type), F.lit(c.details)))])
    fact = facts[F.col("check_name")]
    return counts.select("check_name", fact["col1"].alias("issue_type"), "row_count", fact["col2"].alias("details"))


def with_severity(report: DataFrame) -> DataFrame:
    """Add severity: warn where something was counted and the check is no audit, else info."""
    warn = (F.col("row_count") > 0) & (F.col("issue_type") != AUDIT)
    return report.withColumn("severity", F.when(warn, "warn").otherwise("info"))


def failing_nulls(df: DataFrame, column: str) -> DataFrame:
    """not_null: the failing rows."""
    return df.select(column).filter(F.col(column).isNull())


def failing_duplicates(df: DataFrame, column: str) -> DataFrame:
    """unique: values that occur more than once; NULL passes."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counts.agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def failing_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """accepted_values: values outside the list, with their counts; NULL passes."""
    outside = df.filter(~F.col(column).isin(*values))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


@dataclass(frozen=True)
class TableTest:
    """A test on one column of a layer: "not_null", "unique" or "accepted_values"."""

    layer: str
    column: str
    kind: str
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}.{self.layer}.{self.column}"

    def failures(self) -> Column | None:
        """The number of failing rows as an aggregate, for the kinds that need no grouping of their own."""
        column = F.col(self.column)
        if self.kind == "not_null":
            return F.count_if(column.isNull())
        if self.kind == "accepted_values":
            return F.count_distinct(F.when(~column.isin(*self.values), column))
        return None

    def failing(self, df: DataFrame) -> DataFrame:
        if self.kind == "not_null":
            return failing_nulls(df, self.column)
        if self.kind == "unique":
            return failing_duplicates(df, self.column)
        if self.kind == "accepted_values":
            return failing_values(df, self.column, self.values)
        raise ValueError(f"unknown test kind {self.kind!r}")


# The thirteen tests.
SURVEY_TESTS = (
    TableTest("raw", "response_id", "not_null"),
    TableTest("staging", "response_id", "unique"),
    TableTest("staging", "response_id", "not_null"),
    TableTest("languages", "response_id", "not_null"),
    TableTest("languages", "language", "not_null"),
    TableTest("languages", "wants_to_continue", "accepted_values", (True, False)),
    TableTest("databases", "response_id", "not_null"),
    TableTest("databases", "database_name", "not_null"),
    TableTest("salary", "respondent_count", "not_null"),
    TableTest("adoption", "tech_name", "not_null"),
    TableTest("adoption", "tech_type", "not_null"),
    TableTest("adoption", "tech_type", "accepted_values", ("Language", "Database")),
    TableTest("sentiment", "respondent_count", "not_null"),
)


# The stored layer with which a layer is written: the exploded ones are views of staging.
EXPLODED = {"languages": marts.LANGUAGE[1:] + ("language",), "databases": marts.DATABASE[1:] + ("database_name",)}
WRITTEN_WITH = ("raw", "staging", "salary", "adoption", "sentiment")


def test_counts(layer: str, tests: Sequence[TableTest] = SURVEY_TESTS) -> dict[str, Column]:
    """The not_null and accepted_values tests of a layer, and of the views over it, as aggregates, by test name.

    They count failing rows. Of accepted values that is more than the distinct values that such a test
    reports, but it is 0 for both or for neither.
    """

    def bad(test: TableTest, column: Column) -> Column:
        return column.isNull() if test.kind == "not_null" else ~column.isin(*test.values)

    def some_bad(test: TableTest, values: Column) -> Column:
        """Whether an array may hold a bad value: a search for what it does not hold is NULL if there is a NULL in it."""
        if test.kind == "not_null":
            return values.isNotNull() & F.array_contains(values.cast("array<string>"), "").isNull()
        return F.size(reduce(F.array_remove, test.values, values)) > 0

    counts = {}
    for test in tests:
        if test.kind == "unique":
            continue
        if test.layer == layer:
            counts[test.name] = F.count_if(bad(test, F.col(test.column)))
        elif layer == "staging" and test.layer in EXPLODED:
            have, want, item = EXPLODED[test.layer]
            # Each test makes only what it looks at, and goes through the elements one by one only where one is bad.
            items = trimmed_items(F.col(have))
            if test.column in (item, "wants_to_continue"):
                values = items if test.column == item else item_flags(F.col(have), F.col(want))
                rows = F.when(some_bad(test, values), F.size(F.filter(values, lambda x: bad(test, x))))
            else:
                rows = F.when(bad(test, F.col(test.column)), F.size(items))
            counts[test.name] = F.sum(F.coalesce(rows, F.lit(0)))
    return counts


def run_tests(
    layers: dict[str, DataFrame], tests: Sequence[TableTest] = SURVEY_TESTS, observed: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per test: test_name, failures (rows its failing query returns), should_warn, should_error.

    Tests whose count was ``observed`` (``test_counts``, by test name) read nothing, but for
    accepted values of which some are outside the list: those are looked up. The other not_null and
    accepted_values tests of a layer share one scan: of the latter, a failing row is a distinct value outside
    the list. Layers that take work to derive should be stored first: a unique test reads its layer again.
    """
    seen = observed or {}
    known = {t.name: seen[t.name] for t in tests if t.name in seen and (t.kind == "not_null" or seen[t.name] == 0)}
    parts = []
    if known:
        parts.append(_known(next(iter(layers.values())), known, "test_name", "failures"))
    left = [t for t in tests if t.name not in known]
    for layer in dict.fromkeys(t.layer for t in left):
        df = layers[layer]
        counted = [(t, failures) for t in left if t.layer == layer and (failures := t.failures()) is not None]
        if counted:
            counts = df.select(*[failures.alias(t.name) for t, failures in counted])
            parts.append(counts.unpivot([], [f"`{t.name}`" for t, _ in counted], "test_name", "failures"))
        for test in left:
            if test.layer == layer and test.failures() is None:
                count = F.count(F.lit(1)).alias("failures")
                parts.append(test.failing(df).select(F.lit(test.name).alias("test_name"), count))
    failed = F.col("failures") != 0
    results = reduce(DataFrame.unionByName, parts)
    return results.select("test_name", "failures", failed.alias("should_warn"), failed.alias("should_error"))
