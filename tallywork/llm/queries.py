"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import bpe, chat, divergence, jaccard, leaks, lines, merkle, quality, secrets, sharding, simhash, toxicity, urls
from tallywork.llm.common import reach_workers, sha256_hex, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_vector_packing(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


@query
def op2_site_spread(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")


# The rules of the URL query.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@query
def op3_ngram_logistic(spark, sf_dir):
    """The rules label the URLs that they decide; a bounded table of those trains the model for all others."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    decided = urls.with_rule(urls.with_parts(pages), URL_RULES).where("rule IS NOT NULL")
    model = urls.train(decided.select("host", "path", (F.col("rule_verdict") == "block").cast("int").alias("label")))
    return urls.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "block_probability")


@query
def op4_weak_supervision(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judge(docs).select(*base, "quality")


@query
def op5_noisy_or(spark, sf_dir):
    """Learns from the labelled rows that are not held out; scores all rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(F.col("toxic").isNotNull() & ~held_out)
    model = toxicity.learn(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.transform("offending", lambda s: F.struct(s["start"], s["end"])).alias("offending"),
    )


@query
def op6_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    codec = bpe.Codec(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return codec.round_trip(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_hex(bpe.joined(F.col("ids"))).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op8_prefix_targets(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], rows.schema)
    return chat.conversation_digests(chat.format_conversations(rows.unionByName(extra)))


@query
def op9_blob_ledger(spark, sf_dir):
    """Two steps of the ledger: the base rules, then five more as a version of their own, which scans no base rule again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, ledger = secrets.scan(docs, ["doc_id"], rules=secrets.BASE_RULES, rules_version=secrets.BASE_VERSION)
    found, _ = secrets.scan(
        docs, ["doc_id"], "text", ledger, secrets.MORE_RULES, secrets.MORE_VERSION, with_versions=(secrets.BASE_VERSION,)
    )
    base = [rule.kind for rule in secrets.BASE_RULES]
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(of_kind(kind).alias(f"n_{kind}") for kind in base),
        sha256_hex(secrets.span_list(F.filter("spans", lambda s: s["kind"].isin(*base)))).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
    )


@query
def op10_cgk_leaks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks.find_leaks(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])


@query
def op7_universe_partition(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, _ = jaccard.link_documents(docs, n=3, percent=90)
    return rows


@query
def op11_tiled_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, radius=3)


@query
def op12_length_bucketed_audit(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@query
def op13_slot_pivot_manifest(spark, sf_dir):
    return merkle.prove_documents(table(spark, sf_dir, "documents"))
