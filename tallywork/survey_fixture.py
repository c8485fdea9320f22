"""A raw survey layer derived from order tables, one response per order.

Every order and every line is used; remainders of the keys only vary the answers.
An order's lines are one answer's text, so by definition they meet in one row. The
column expressions are SQL text that Spark and ANSI SQL engines both read, so that
tests can derive the same input in either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_K, _C = "o_orderkey", "o_custkey"
_AMOUNT = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"


def _years(number: str) -> str:
    return (
        f"CASE {number} % 53 WHEN 0 THEN 'Less than 1 year' WHEN 51 THEN 'More than 50 years' "
        f"WHEN 52 THEN NULL ELSE CAST({number} % 53 AS STRING) END"
    )


def _choice(modulus: int, upto: int, first: str, rest: str) -> str:
    """NULL for residue 0, ``first`` for residues up to ``upto``, else ``rest``."""
    return f"CASE WHEN {_K} % {modulus} = 0 THEN NULL WHEN {_K} % {modulus} <= {upto} THEN '{first}' ELSE '{rest}' END"


# Columns that need no list; copy is 1 in the later copy of a tenth of the orders.
COLUMNS = {
    "response_id": f"CASE WHEN {_K} % 997 = 5 THEN NULL ELSE CAST({_K} AS STRING) END",
    "main_branch": _choice(7, 3, "I am a developer by profession", "I am learning to code"),
    "age": _choice(11, 5, "25-34 years old", "35-44 years old"),
    "remote_work": f"CASE {_K} % 3 WHEN 0 THEN 'Remote' WHEN 1 THEN 'Hybrid' END",
    "ed_level": _choice(23, 9, "Bachelor", "Master"),
    "years_code": _years(f"({_C} + 3)"),
    "years_code_pro": _years(_C),
    "dev_type": "c_mktsegment",
    "org_size": f"CASE {_K} % 2 WHEN 0 THEN '20 to 99' ELSE '100 to 499' END",
    "country": f"CASE WHEN {_C} % 41 = 7 THEN NULL ELSE n_name END",
    "currency": _choice(17, 8, "USD", "EUR"),
    "comp_total": (
        f"CASE WHEN copy = 1 THEN '50000' WHEN {_K} % 13 = 0 THEN NULL WHEN {_K} % 13 = 1 THEN 'n/a' "
        f"WHEN {_K} % 13 = 2 THEN '$' || {_AMOUNT} ELSE {_AMOUNT} END"
    ),
    "ai_select": f"CASE {_K} % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Yes' ELSE 'No' END",
    "ai_sent": _choice(5, 2, "Favorable", "Indifferent"),
    "ai_threat": _choice(6, 2, "Yes", "No"),
    "job_sat": f"CASE WHEN {_K} % 12 = 11 THEN 'NA' ELSE CAST({_K} % 12 AS STRING) END",
    "industry": _choice(19, 9, "Software", "Finance"),
    "loaded_at": "CASE WHEN copy = 1 THEN o_orderdate + INTERVAL '1' DAY ELSE o_orderdate END",
}

# List columns: the line column joined by ';' in line order, and the lines that count.
LISTS = {
    "language_have_worked": ("p_type", None),
    "language_want_work": ("p_type", "l_returnflag = 'R'"),
    "database_have_worked": ("p_brand", None),
    "database_want_work": ("p_brand", "l_discount > 0.05"),
    "platform_have_worked": ("l_returnflag", None),
    "platform_want_work": ("l_linestatus", None),
}
LIST_ORDER = ("l_linenumber", "p_type", "p_brand", "l_returnflag", "l_linestatus")

# Variants of the fixture: columns to replace, in terms of the column itself.
VARIANTS = {
    "base": {},
    "odd_years": {"years_code_pro": f"CASE WHEN {_K} % 101 = 3 THEN 'about 5' ELSE years_code_pro END"},
    "exponents": {
        "comp_total": (
            f"CASE {_K} % 29 WHEN 3 THEN '12e300' WHEN 5 THEN '9999e40' WHEN 7 THEN '1e28' WHEN 11 THEN '1e5' "
            "ELSE comp_total END"
        )
    },
    "long_ratings": {
        "job_sat": (
            f"CASE {_K} % 17 WHEN 3 THEN '1234567890123456789' WHEN 5 THEN '123456789012345678901234567890' "
            "ELSE job_sat END"
        )
    },
    "uncleaned": {
        "country": "'  ' || country || ' '",
        "ai_sent": f"CASE WHEN {_K} % 7 = 3 THEN ' NA' ELSE ai_sent END",
        "job_sat": f"CASE WHEN {_K} % 7 = 4 THEN '' ELSE job_sat END",
    },
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_survey(spark: SparkSession, sf_dir: str, variant: str = "base") -> DataFrame:
    """The raw layer. No join names a broadcast side: Spark picks one by its measured size."""
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    line = F.struct(*LIST_ORDER, (F.col("l_discount") > 0.05).alias("discounted"))
    tests = {"l_returnflag = 'R'": lambda x: x["l_returnflag"] == "R", "l_discount > 0.05": lambda x: x["discounted"]}

    def joined(column: str, test: str | None):
        kept = F.filter("lines", tests[test]) if test else F.col("lines")
        return F.nullif(F.array_join(kept[column], ";"), F.lit(""))

    lists = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    lists = lists.select("l_orderkey", *[joined(c, t).alias(name) for name, (c, t) in LISTS.items()])
    copies = F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    orders = (
        read(spark, sf_dir, "orders")
        .join(read(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(read(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(lists, F.expr("o_orderkey = l_orderkey"), "left")
        .withColumn("copy", F.explode(copies))
    )
    base = orders.select("o_orderkey", *[F.expr(sql).alias(name) for name, sql in COLUMNS.items()], *LISTS)
    changes = VARIANTS[variant]
    return base.select(*[F.expr(changes.get(c, c)).alias(c) for c in base.columns if c != "o_orderkey"])


def raw_survey_ctes(variant: str = "base") -> str:
    """The same as SQL common table expressions, the last of them named ``raw``."""
    order = ", ".join(LIST_ORDER)
    lists = ", ".join(
        f"string_agg({c}, ';' ORDER BY {order})" + (f" FILTER (WHERE {t})" if t else "") + f" AS {name}"
        for name, (c, t) in LISTS.items()
    )
    columns = ", ".join(f"{sql} AS {name}" for name, sql in COLUMNS.items())
    names = [*COLUMNS, *LISTS]
    changed = ", ".join(f"{VARIANTS[variant][c]} AS {c}" if c in VARIANTS[variant] else c for c in names)
    return (
        f"WITH lists AS (SELECT l_orderkey, {lists} FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey), "
        "copies AS (SELECT *, 0 AS copy FROM orders UNION ALL SELECT *, 1 AS copy FROM orders WHERE o_orderkey % 10 = 0), "
        f"base AS (SELECT o_orderkey, {columns}, {', '.join(LISTS)} FROM copies JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey LEFT JOIN lists ON o_orderkey = l_orderkey), "
        f"raw AS (SELECT {changed} FROM base)"
    )
