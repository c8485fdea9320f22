"""URL filters: fixed rules first, and logistic regression on hashed character n-grams for the rest.

Features of a URL are the distinct character n-grams of its host and of its path, each
with a mark of where it stands, hashed to a fixed number of buckets. The model is
trained by full-batch gradient descent from a small labelled URL table, whose size is
a documented bound; each step is one DataFrame aggregation, and only the weights, as many
as there are buckets, pass through the driver. Scores are plain column expressions.

Defined cases: a null URL, or one without ``://``, has an empty host and path, matches no
rule and is scored like any other; without labelled rows, or with one label only, the
model's score is that label's share, 0.5 without rows; a probability of exactly 0.5 allows.
Repeated rows are judged alike, extra columns pass through, clashing ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import store

# Hosts are lower-cased in the ASCII letters only.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BUCKETS = 4096
GRAMS = (3, 4)
#: At most so many labelled URLs train the model.
MAX_LABELLED = 4000


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))
    return urls.withColumns(
        {
            "host": F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.lit("")),
            "path": F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")),
        }
    )


def with_rule(parts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict``: of the (verdict, host/path) rules that fit, the longest; null if none does."""
    longest_first = sorted(rules, key=lambda r: -len(r[1]))

    def fits(place: str) -> Column:
        host, slash, path = place.partition("/")
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        return own & F.startswith(F.col("path"), F.lit(slash + path))

    def first(value) -> Column:
        return F.coalesce(*(F.when(fits(rule[1]), F.lit(value(rule))) for rule in longest_first))

    return parts.withColumns({"rule": first(lambda r: r[1]), "rule_verdict": first(lambda r: r[0])})


def features(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """The distinct buckets of the n-grams of host and path."""

    def grams(text: Column, mark: str, n: int) -> Column:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        # One pass for any length; a gram never begins inside a character of two UTF-16 units.
        every = F.regexp_extract_all(marked, F.lit(rf"(?s)(?=([^\x{{D800}}-\x{{DFFF}}].{{{n - 1}}}))"), F.lit(1))
        found = F.when(F.char_length(marked) < n, F.array(marked)).otherwise(every)
        return F.transform(found, lambda g: F.pmod(F.xxhash64(F.lit(mark), g), F.lit(buckets)).cast("int"))

    return F.array_distinct(F.concat(*(grams(c, m, n) for c, m in ((host, "h"), (path, "p")) for n in GRAMS)))


def _doubles(values: list[float]) -> Column:
    """One literal that folds to an array of doubles."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _probability(found: Column, weights: list[float], bias: float) -> Column:
    w = _doubles(weights)
    total = F.aggregate(found, F.lit(0.0), lambda a, f: a + F.get(w, f))
    return 1 / (1 + F.exp(-(F.lit(bias) + total / F.sqrt(F.size(found)))))


class UrlModel:
    """Weights of the hashed n-grams; ``probability`` scores host and path columns."""

    def __init__(self, weights: list[float], bias: float):
        self.weights, self.bias = weights, bias

    def probability(self, host: Column, path: Column) -> Column:
        return _probability(features(host, path, len(self.weights)), self.weights, self.bias)


def train(
    labelled: DataFrame,
    max_labelled: int = MAX_LABELLED,
    buckets: int = BUCKETS,
    steps: int = 30,
    rate: float = 4.0,
    shrink: float = 1e-4,
) -> UrlModel:
    """Fit to a labelled table (host, path, label 0 or 1), at most ``max_labelled`` distinct URLs of it, lowest hashes first."""
    rows = (
        labelled.where("label IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("label").cast("double").alias("label"))
        .orderBy(F.xxhash64("host", "path"), "host", "path")
        .limit(max_labelled)
    )
    sample = store(
        rows.repartition(8, "host", "path").select("label", features(F.col("host"), F.col("path"), buckets).alias("f")),
        "url-labels",
    )
    count, positive = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if count == 0 or positive in (0, count):
        share = 0.5 if count == 0 else min(max(positive / count, 1e-6), 1 - 1e-6)
        return UrlModel([0.0] * buckets, math.log(share / (1 - share)))
    weights, bias = [0.0] * buckets, math.log(positive / (count - positive))
    squares, bias_square = [1e-8] * buckets, 1e-8  # Adagrad: each weight has its own step
    for _ in range(steps):
        error = (_probability(F.col("f"), weights, bias) - F.col("label")).alias("error")
        slopes = (
            sample.select(error, "f")
            .select(F.col("error"), (F.col("error") / F.sqrt(F.size("f"))).alias("e"), F.explode(F.concat("f", F.array(F.lit(-1)))).alias("b"))
            .groupBy("b")
            .agg(F.sum("e").alias("e"), F.sum("error").alias("error"))
            .collect()  # one row per bucket at most
        )
        for b, e, whole in slopes:
            if b < 0:
                g = whole / count
                bias_square += g * g
                bias -= rate * g / math.sqrt(bias_square)
            else:
                g = e / count + shrink * weights[b]
                squares[b] += g * g
                weights[b] -= rate * g / math.sqrt(squares[b])
        rate *= 0.93
    return UrlModel(weights, bias)


def judge(urls: DataFrame, rules: list[tuple[str, str]], model: UrlModel, url: str = "url") -> DataFrame:
    """Adds host, path, rule, block_probability (of the model, also where a rule decides) and verdict."""
    found = with_rule(with_parts(urls, url), rules)
    p = model.probability(F.col("host"), F.col("path"))
    return (
        found.withColumn("block_probability", p)
        .withColumn(
            "verdict",
            F.coalesce(F.col("rule_verdict"), F.when(F.col("block_probability") > 0.5, "block").otherwise("allow")),
        )
        .drop("rule_verdict")
    )
