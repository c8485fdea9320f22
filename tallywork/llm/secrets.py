"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its whole content. A ledger
says which (blob, rules version) pairs have been scanned and what was found. A scan
reads one row per blob that the ledger lacks for the wanted rules, gives back what it
found as rows to append to the ledger, and joins all findings of the blobs back to every path that
has them. Copies are therefore scanned once, and a new set of rules scans all blobs once more, for these
rules only: findings of several versions are read from the ledger together.

Spans come from Spark's own regular expressions: the matches of a pattern and the gaps
between them alternate, so running sums of their lengths, a window over the matches of one rule in one
blob, are the places, in code points, end exclusive. A match can be dropped only after it
was found (its group too short), so that it still uses up its text.

Defined cases: null content is the empty blob; repeated rows get the same findings
each; an empty table gives an empty result; rules without a match give empty lists;
a ledger that does not exist yet counts as empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import store


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts (0: the match), and the length from which a match counts."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in the order in which ties are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Public formats of further credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
)
RULES = BASE_RULES + MORE_RULES
BASE_VERSION, MORE_VERSION, RULES_VERSION = "base3", "more5", "base3+more5"
LEDGER = "blob string, rules string, spans array<struct<kind:string,start:long,end:long>>"

#: Lists of blobs up to so many rows (an address of 64 characters and a path each) are broadcast; longer ones are joined by shuffle.
BROADCAST_BLOBS = 100_000

_NO_SPANS = "CAST(array() AS array<struct<kind:string,start:long,end:long>>)"


def _lengths(text: Column, rule: Rule) -> Column:
    """For each match of a rule the code points of the gap before it, of the match, and of the part that counts."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    found = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(gaps) - 1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    lengths = F.transform(found, lambda x: F.struct(*(F.char_length(x[c]).cast("long").alias(c) for c in ("gap", "hit", "part"))))
    return F.when(F.regexp_like(text, pattern), lengths)


def blob_spans(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of the blobs (blob, content) with findings: by start, then by the order of the rules, then by end.

    Work and memory grow with the matches: each is a row, and only those of one rule in one blob are summed up in order.
    """
    per_rule = F.array(*(F.struct(F.lit(i).alias("rule"), _lengths(F.col("content"), rule).alias("hits")) for i, rule in enumerate(rules)))
    with_hits = blobs.select("blob", F.explode(F.filter(per_rule, lambda r: r["hits"].isNotNull())).alias("r"))
    hits = with_hits.select("blob", "r.rule", F.posexplode("r.hits").alias("number", "hit"))
    hits = hits.dropDuplicates(["blob", "rule", "number"])  # a blob may come in several rows that are all alike
    upto = Window.partitionBy("blob", "rule").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("hit.gap") + F.col("hit.hit")).over(upto)
    least = F.element_at(F.array(*(F.lit(rule.least) for rule in rules)), F.col("rule") + 1)
    kind = F.array(*(F.lit(rule.kind) for rule in rules))
    placed = hits.withColumn("end", end).where(F.col("hit.part") >= least)
    span = F.struct((F.col("end") - F.col("hit.hit")).alias("start"), "rule", "end")
    listed = placed.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("found"))  # the findings of one text
    named = lambda s: F.struct(F.get(kind, s["rule"]).alias("kind"), s["start"], s["end"])
    return listed.select("blob", F.transform("found", named).alias("spans"))


def ordered(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """By start, then by the order of the rules, then by end."""
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    keyed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(kinds, s["kind"]).alias("rule"), s["end"], s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"]))


def address(versions: DataFrame, path: list[str], content: str = "text") -> DataFrame:
    """The paths and the address of each version's content, without the content."""
    return versions.select(*path, _blob(content).alias("blob"))


def _blob(content: str) -> Column:
    return F.sha2(F.coalesce(F.col(content), F.lit("")), 256)


def _bounded(blobs: DataFrame) -> DataFrame:
    return F.broadcast(blobs) if blobs.count() <= BROADCAST_BLOBS else blobs


def scan(
    versions: DataFrame,
    path: list[str],
    content: str = "text",
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    rules_version: str = RULES_VERSION,
    with_versions: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """All paths with their findings, and the new rows for the ledger (LEDGER), already stored.

    ``path`` names the columns that tell versions apart. Findings of the rules versions ``with_versions``, which
    the ledger has from earlier scans, are listed together with those of ``rules_version``.
    """
    spark = versions.sparkSession
    known = spark.createDataFrame([], LEDGER) if ledger is None else ledger
    seen = known.where(F.col("rules") == rules_version)
    paths = store(address(versions, path, content), "secret-paths")
    # One row per blob: any of its paths will do, so the smallest. Counted map side first, however many copies.
    one = paths.groupBy("blob").agg(F.min(F.struct(*path)).alias("at"), F.count(F.lit(1)).alias("rows"))
    unseen = store(one.join(seen.select("blob"), "blob", "left_anti"), "secret-unseen")
    read = versions.select(*path, F.coalesce(F.col(content), F.lit("")).alias("content"), _blob(content).alias("blob"))
    first = F.lit(True)
    for c in path:
        first &= F.col(c).eqNullSafe(F.col("at_")[c])
    if seen.isEmpty():
        # A blob of one row is scanned where it lies; only of the others a row must be chosen.
        copied = unseen.where("rows > 1").select(F.col("blob").alias("blob_"), F.col("at").alias("at_"))
        once = read.join(_bounded(copied), F.col("blob") == F.col("blob_"), "left").where(F.col("blob_").isNull() | first)
    else:
        # Joined on blob and path, so the copies of a blob are spread over all tasks and only one of them is scanned.
        wanted_rows = unseen.select(F.col("blob").alias("blob_"), F.col("at").alias("at_"))
        once = read.join(_bounded(wanted_rows), (F.col("blob") == F.col("blob_")) & first, "left_semi")
    found = blob_spans(once, rules)
    new = store(
        unseen.select("blob")
        .join(found, "blob", "left")
        .select("blob", F.lit(rules_version).alias("rules"), F.coalesce("spans", F.expr(_NO_SPANS)).alias("spans")),
        "secret-ledger",
    )
    wanted = known.where(F.col("rules").isin(rules_version, *with_versions)).unionByName(new).where(F.size("spans") > 0)
    if with_versions:
        listed = wanted.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # a row for each version
        # Written, so that the join below shuffles plain rows, of which adaptive execution can split a blob with many paths.
        wanted = store(listed.select("blob", ordered(F.col("spans")).alias("spans")), "secret-findings")
    # Blobs with findings are joined to all their paths; a blob with very many copies is split by adaptive execution.
    everywhere = paths.join(wanted.select("blob", "spans"), "blob", "left").select(
        *path, "blob", F.coalesce("spans", F.expr(_NO_SPANS)).alias("spans")
    )
    return everywhere, new


def span_list(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
