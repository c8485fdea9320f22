"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. All stages but the last return the columns
of documents; extra columns of the input pass through them.

Defined cases: every stage takes null columns, empty texts, repeated rows and empty tables
as its operator does. Rows with a null id have no name to be kept under as one of a group
of similar documents, so the near-duplicate stage keeps them all.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import bpe, jaccard, leaks, lines, quality
from tallywork.llm.common import free_name, reach_workers, sha256_hex, table
from tallywork.sources.files import Files
from tallywork.sources.tables import scratch_of_run, scratch_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Near-duplicates: five words, and a Jaccard similarity of 80 in the hundred or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Long passages go from ten sites on only: those that copies of a document share must stay for the near-duplicate stage to see.
LINE_SPREADS = (lines.Spread(1, 0.4, 3, 10), lines.Spread(50, 1.0, 10, 10))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised model, or the base rule, rejects go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay in one document only; documents of which nothing else is left go."""
    counts = (free_name("n_lines", docs.columns), free_name("n_removed", docs.columns))
    cleaned = lines.remove_boilerplate(docs, spreads=LINE_SPREADS, counts=counts)
    emptied = (F.col(counts[1]) > 0) & (F.btrim(F.col("text"), F.lit(lines.BLANKS)) == "")
    kept = cleaned.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        chars = F.when(F.col(counts[1]) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays: the one with the smallest id, once."""
    return jaccard.keep_one(docs, n=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return leaks.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the whole text, their number, and digests of the ids and of the decoded bytes."""
    codec = bpe.Codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return codec.round_trip(docs.select("doc_id", "text")).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_hex(bpe.joined(F.col("ids"))).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the fitted label model nor byte-level BPE; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next one reads it; what a stage needed goes when it is done."""
    reach_workers(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_of_run(spark):
            made = stage(spark, docs, sf_dir)
            made.write.mode("append").parquet(path)
        if before:
            Files(spark).remove(before)
        docs, before = spark.read.schema(made.schema).parquet(path), path
    return docs
