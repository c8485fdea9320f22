"""Weak supervision for text quality: rules vote, expectation-maximisation weighs them.

Each rule looks at counts of a whole text and votes good (+1), bad (-1) or abstains (0).
No rule decides alone. A two-class model with rules independent given the class is
fitted to the votes of all documents by expectation-maximisation: it estimates each
rule's distribution of votes among good and among bad documents and the share of good
ones, and gives a posterior probability per document. A document is kept if it is at
least ``keep_at``.

The votes of a document are one of at most 3^rules patterns, so the documents are
counted by pattern (map side first) and only these counts meet on the driver, whatever
the corpus. Priors keep every rule better than chance, so the classes cannot swap.

Defined cases: null and empty texts have no words and fail the base rule; a text whose
rules all abstain gets the prior; an empty table gives an empty result; other
columns pass through, and those that have the name of a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import WORD, slices, store, worker_state

WINDOW = 8
# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",  # the base counts
    "n_lines", "n_letters", "n_upper", "n_digits", "n_run_words", "n_distinct_words", "n_symbol_words", "n_upper_words",
)

_words = re.compile(WORD).findall
_LETTER, _UPPER, _DIGIT, _SYMBOL = 1, 2, 4, 8
_symbol = re.compile("[" + re.escape(SYMBOLS) + "]").search


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of WINDOW words that occur twice or more; ``ids`` has equal numbers for equal words."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    # Rank pairs, then pairs of pairs, then those: equal numbers for equal windows, without hashing.
    rank, width = ids.astype(np.int64), 1
    while width < WINDOW:
        both = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        _, rank, counts = np.unique(both, return_inverse=True, return_counts=True)
        if len(counts) == len(both):
            return 0
        width *= 2
    twice = counts[rank] > 1
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _make_kinds() -> np.ndarray:
    """For every code point, what kinds of character it is; a megabyte."""
    return np.array(
        [
            c.isalpha() * _LETTER + c.isupper() * _UPPER + c.isdigit() * _DIGIT + (c in SYMBOLS) * _SYMBOL
            for c in map(chr, range(0x110000))
        ],
        dtype=np.uint8,
    )


def character_kinds(text: str) -> tuple[int, int, int, int]:
    """Letters, capitals, digits and symbols in a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    counts = np.bincount(worker_state("character kinds", _make_kinds)[codes], minlength=16)
    kind = np.arange(16)
    return tuple(int(counts[(kind & bit) > 0].sum()) for bit in (_LETTER, _UPPER, _DIGIT, _SYMBOL))


def count_text(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one whole text."""
    words = _words(text) if text else []
    if not words:
        return (0,) * len(COUNTS)
    letters, capitals, digits, symbols = character_kinds(text)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip("\t\n\x0b\x0c\r "):
            lines += 1
            dup += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        symbols,
        dup,
        repeated_words(ids),
        lines,
        letters,
        capitals,
        digits,
        int((ids[1:] == ids[:-1]).sum()),
        len(number),
        sum(map(bool, map(_symbol, words))) if symbols else 0,
        sum(map(str.isupper, words)) if capitals else 0,
    )


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, and the COUNTS of the whole text as longs."""
    kept = [f for f in docs.schema.fields if f.name != text]
    names = list(COUNTS)
    schema = T.StructType([*kept, *(T.StructField(c, T.LongType()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = np.array([count_text(v.as_py()) for v in batch.column(text)], dtype=np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), *(pa.array(rows[:, i]) for i in range(len(names)))],
                [*(f.name for f in kept), *names],
            )

    return docs.mapInArrow(run, schema)


#: Rules by name: a measure, where it votes good, and where it votes bad ({v} is the measure); else the rule abstains.
#: Most rules know one kind of bad text only and have nothing to say of others, so they never vote good.
RULES = {
    "symbols": ("n_symbols / n_words", "{v} <= 0.02", "{v} >= 0.1"),
    "marked_words": ("n_symbol_words / n_words", "false", "{v} >= 0.1"),
    "letters": ("n_letters / word_chars", "{v} >= 0.9", "{v} <= 0.85"),
    "repeats": ("n_repeat_words / n_words", "false", "{v} >= 0.3"),
    "runs": ("n_run_words / n_words", "false", "{v} >= 0.2"),
    "shouting": ("n_upper / greatest(n_letters, 1)", "false", "{v} >= 0.4"),
    "shouted_words": ("n_upper_words / n_words", "false", "{v} >= 0.4"),
    "word_length": ("word_chars / n_words", "{v} BETWEEN 3.5 AND 9.0", "{v} < 2.0 OR {v} > 20.0"),
    "digits": ("n_digits / word_chars", "false", "{v} >= 0.4"),
    "dup_lines": ("n_dup_lines / n_lines", "false", "{v} >= 0.5"),
    "variety": ("n_distinct_words / sqrt(n_words)", "{v} >= 3.0", "{v} <= 1.5"),
}


def _vote(measure: str, good: str, bad: str) -> Column:
    """A text without words gets no vote."""
    v = f"({measure})"
    return F.expr(
        f"CAST(CASE WHEN n_words = 0 THEN 0 WHEN {bad.format(v=v)} THEN -1 WHEN {good.format(v=v)} THEN 1 ELSE 0 END AS TINYINT)"
    )


def votes(counts: DataFrame) -> DataFrame:
    """One tinyint column per rule, named vote_<rule>."""
    return counts.withColumns({f"vote_{name}": _vote(*rule) for name, rule in RULES.items()})


def fit_label_model(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior_good: float = 0.85, strength: float = 0.05
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of good for each pattern, and each rule's vote distribution by class (rule, class, vote).

    ``patterns`` has a row per vote pattern with entries -1, 0, 1; ``counts`` how often it
    occurs. The priors count as ``strength`` times the documents: they say that a vote is
    right more often than wrong, which fixes which class is good.
    """
    n_rules = patterns.shape[1]
    weight = counts.astype(float)
    total = max(weight.sum(), 1.0)
    is_vote = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)  # pattern, rule, vote
    pseudo = strength * total * np.array([[0.4, 0.4, 0.2], [0.02, 0.49, 0.49]])  # class (bad, good), vote
    table = np.broadcast_to(pseudo / pseudo.sum(axis=1, keepdims=True), (n_rules, 2, 3)).copy()
    good = prior_good
    for _ in range(rounds):
        like = np.einsum("prv,rcv->pc", is_vote, np.log(table))
        like += np.log([1 - good, good])
        like -= like.max(axis=1, keepdims=True)
        post = np.exp(like)
        post /= post.sum(axis=1, keepdims=True)
        mass = post * weight[:, None]
        found = np.einsum("pc,prv->rcv", mass, is_vote) + pseudo[None]
        table = found / found.sum(axis=2, keepdims=True)
        good = float((mass[:, 1].sum() + strength * total * prior_good) / (total + strength * total))
    return post[:, 1], table


def rule_accuracies(patterns: np.ndarray, counts: np.ndarray, posterior: np.ndarray) -> list[tuple[str, int, float | None]]:
    """(rule, votes, accuracy): how often each rule votes, and how often it is right by the model; None if it never votes."""
    found = []
    for k, name in enumerate(RULES):
        right = np.where(patterns[:, k] > 0, posterior, 1 - posterior)
        voting = np.where(patterns[:, k] != 0, counts, 0)
        votes_ = int(voting.sum())
        found.append((name, votes_, float((right * voting).sum() / votes_) if votes_ else None))
    return found


@dataclass(frozen=True)
class LabelModel:
    """The posterior probability of good for every vote pattern that occurs, and what the model thinks of each rule."""

    patterns: DataFrame
    rules: DataFrame
    keep_at: float

    def judged(self, voted: DataFrame) -> DataFrame:
        """Adds ``quality`` (the posterior), ``base_failed`` and ``kept`` to a table with the COUNTS and votes."""
        failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
        return (
            voted.join(F.broadcast(self.patterns), [f"vote_{name}" for name in RULES], "left")  # at most 3^rules rows
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("quality") >= F.lit(self.keep_at)))
        )


def fit(voted: DataFrame, keep_at: float = 0.5) -> LabelModel:
    """Fit the label model to the votes of a whole table."""
    names = [f"vote_{name}" for name in RULES]
    seen = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3^rules rows
    patterns = np.array([[r[c] for c in names] for r in seen], dtype=np.int64).reshape(-1, len(names))
    counts = np.array([r.n for r in seen], dtype=float)
    posterior, _ = fit_label_model(patterns, counts)
    spark = voted.sparkSession
    rules = spark.createDataFrame(rule_accuracies(patterns, counts, posterior), "rule string, votes long, accuracy double")
    rows = [(*map(int, p), float(q)) for p, q in zip(patterns, posterior, strict=True)]
    kind = ", ".join(f"{c} tinyint" for c in names) + ", quality double"
    return LabelModel(spark.createDataFrame(rows, kind), rules, keep_at)


def judge(docs: DataFrame, text: str = "text", keep_at: float = 0.5) -> DataFrame:
    """Every column but the text, with the COUNTS, the votes, ``quality`` (posterior), ``base_failed`` and ``kept``."""
    docs = docs.drop(*{*COUNTS, *(f"vote_{name}" for name in RULES), "quality", "base_failed", "kept"} - {text})
    voted = store(votes(text_counts(docs, text)), "quality-votes")
    return fit(voted, keep_at).judged(voted)


def keep_good(docs: DataFrame, text: str = "text", keep_at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are.

    The texts are counted twice, once for the model and once for the verdict, rather than stored with their counts.
    """
    model = fit(votes(text_counts(docs.select(F.col(text).alias("text")))), keep_at)
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return model.judged(votes(text_counts(rows))).where("kept").select("row.*")
