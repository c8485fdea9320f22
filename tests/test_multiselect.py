"""Exploding, the continue flag, and counts per item against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallywork.operators.multiselect import explode_items, explode_multiselect, item_flag_counts
from tallywork.plans import marts


def answers(spark, rows):
    return spark.createDataFrame([(str(i), h, w) for i, (h, w) in enumerate(rows)], "response_id string, have string, want string")


def flag(spark, have, want, match="substring"):
    rows = explode_multiselect(answers(spark, [(have, want)]), "have", "want", "item", ["response_id"], match).collect()
    return [r.wants_to_continue for r in rows]


def ilike(text, item):
    """text ILIKE '%item%', read character by character."""
    if text is None:
        return False
    out, chars = [], iter("%" + item.lower() + "%")
    for c in chars:
        if c == "\\":
            out.append(re.escape(next(chars)))
        else:
            out.append({"%": ".*", "_": "."}.get(c, re.escape(c)))
    return re.fullmatch("".join(out), text.lower(), re.DOTALL) is not None


def items_of(have):
    return [p.strip(" ") for p in (have or "").split(";") if p.strip(" ")]


def test_items_are_trimmed_and_empty_ones_vanish(spark):
    df = answers(spark, [("a; ;a", None), ("", None), (None, None), (" ; ;", None), ("\tb ;c", None)])
    rows = explode_items(df, "have", "item", ["response_id"]).collect()
    assert sorted((r.response_id, r.item) for r in rows) == [("0", "a"), ("0", "a"), ("4", "\tb"), ("4", "c")]


@pytest.mark.parametrize(
    "have,want,expected",
    [
        ("Java", "JavaScript", True),
        ("java", "Go;JAVA", True),
        ("C", "Rust", False),
        ("a_c", "xabcx", True),
        ("a%c", "xabbbcx", True),
        ("a\\\\b", "za\\b", True),
        ("a\\b", "zab", True),
        ("a\\b", "za\\b", False),
        ("a\\", "za%", True),
        ("a\\", "zab", False),
        ("a\\_", "a_", True),
        ("a\\_", "ab", False),
        ("a\\\nb%", "a\nb", True),
        ("x", None, False),
        ("x", "", False),
        ("É", "é;y", True),
    ],
)
def test_continue_flag(spark, have, want, expected):
    assert flag(spark, have, want) == [expected]
    assert ilike(want, have) == expected


def test_exact_match(spark):
    assert flag(spark, "Java;C++", "JavaScript; C++ ;x", "exact") == [False, True]
    assert flag(spark, "Java", None, "exact") == [False]
    with pytest.raises(ValueError):
        flag(spark, "Java", "Java", "fuzzy")


def random_rows(n, seed):
    rng = random.Random(seed)
    parts = ["a", "b", "ab", " a", "b ", "", " ", "A", "a_b", "a%", "\\a", "x\\", "é", "b  b", "  ab  "]
    def make():
        return rng.choice([None, ""]) if rng.random() < 0.1 else ";".join(rng.choices(parts, k=rng.randint(1, 8)))
    return [(make(), make()) for _ in range(n)]


def test_flags_against_plain_python(spark):
    rows = random_rows(1500, 1)
    got = explode_multiselect(answers(spark, rows), "have", "want", "item", ["response_id"]).collect()
    expected = Counter((str(i), item, ilike(w, item)) for i, (h, w) in enumerate(rows) for item in items_of(h))
    assert Counter(tuple(r) for r in got) == expected


def test_counts_per_item_against_plain_python(spark):
    rows = random_rows(1500, 2)
    df = answers(spark, rows).withColumn("have2", F.col("want")).withColumn("want2", F.col("have"))
    got = marts.item_usage(df, [("L", "have", "want"), ("D", "have2", "want2")]).collect()
    users, wishes = defaultdict(set), Counter()
    for i, (h, w) in enumerate(rows):
        for tag, have, want in (("L", h, w), ("D", w, h)):
            for item in items_of(have):
                users[tag, item].add(i)
                wishes[tag, item] += ilike(want, item)
    assert {(r.tech_type, r.tech_name): (r.total_users, r.want_to_continue_count) for r in got} == {
        k: (len(v), wishes[k]) for k, v in users.items()
    }


def test_one_pass_counts_equal_distinct_counts(spark):
    df = answers(spark, random_rows(800, 3))
    one_pass = marts.item_usage(df, [("L", "have", "want")])
    exploded = explode_multiselect(df, "have", "want", "language", ["response_id"])
    distinct = marts.exploded_usage(exploded, "language", "L")
    assert sorted(map(tuple, one_pass.collect())) == sorted(map(tuple, distinct.collect()))
    # where respondents do repeat, only the distinct form counts each once
    twice = marts.exploded_usage(exploded.unionByName(exploded), "language", "L")
    assert sorted(r.total_users for r in twice.collect()) == sorted(r.total_users for r in distinct.collect())


def test_retention_may_exceed_one_hundred(spark):
    row = marts.item_usage(answers(spark, [("a;a", "a")]), [("L", "have", "want")]).first()
    assert (row.total_users, row.want_to_continue_count, row.retention_rate_pct) == (1, 2, 200.0)


def test_long_runs_of_blanks_and_items(spark):
    blanks = "a" + " " * 200_000 + "b; c"
    many = ";".join(f"i{k}" for k in range(50_000))
    counts = item_flag_counts(answers(spark, [(blanks, "c"), (many, "i7")]), [("L", "have", "want")])
    assert counts.agg(F.sum("n")).first()[0] == 2 + 50_000
    assert counts.filter("item = 'c' AND is_wanted").count() == 1
