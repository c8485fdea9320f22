"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's probability is a logistic function of the sum of the weights of its words;
a document is toxic if at least one sentence is (noisy-or), so its probability is one
minus the product of the sentences' complements. The weights are trained on document
labels alone through that product, and afterwards tell which sentences offend. A sentence
without any learnt feature has the probability 0, in training and after, so that no number
of harmless sentences makes a text toxic: length alone says nothing.

A word has three hashed features: itself and its first four and five letters, so that
forms of a word that were not seen in training still count.

Training takes a bounded sample of the labelled rows: the rows with the lowest hash of the
text, of each label at most ``MAX_DOCS`` rows and ``MAX_WORDS`` words; whole texts, never
parts. Everything else runs over all rows.

Defined cases: a null or empty text, or one without words or learnt features, scores 0;
labels that are null are ignored; without labels, or with one label only, every score is
0; extra columns pass through.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.llm.common import CACHE_ENTRIES, WORD, slices, worker_state

BUCKETS = 1 << 17
MAX_DOCS = 2500
MAX_WORDS = 800_000
START_BIAS = -6.0
#: A feature is learnt if the documents of the sample show by this much (log-likelihood ratio) that it goes with toxicity.
#: A lower threshold learns more forms and more chance finds: on sf0.01 10 instead of 15 finds one more of 18 held-out toxic
#: documents and flags 3 instead of 0 of 95 clean ones.
EVIDENCE = 15.0

_sentence = re.compile(r"[^.!?\n]+").finditer
_word = re.compile(r"\w+").findall


def word_features(word: str) -> tuple[int, ...]:
    parts = [word, "4" + word[:4], "5" + word[:5]]
    return tuple(crc32(p.encode()) % BUCKETS for p in parts)


def evidence(clean: np.ndarray, toxic: np.ndarray, n_clean: float, n_toxic: float) -> np.ndarray:
    """Log-likelihood ratio that a feature's share is higher among toxic documents; 0 where it is not."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))

    share = (clean + toxic) / (n_clean + n_toxic)
    ratio = 2 * (
        part(toxic, share * n_toxic) + part(n_toxic - toxic, (1 - share) * n_toxic)
        + part(clean, share * n_clean) + part(n_clean - clean, (1 - share) * n_clean)
    )
    return np.where(toxic * n_clean > clean * n_toxic, ratio, 0.0)


def train(texts: list[str], labels: list[int], steps: int = 80, rate: float = 0.5, shrink: float = 1e-4) -> np.ndarray:
    """Weights of all buckets, and the bias last. Balances the two labels; deterministic."""
    known: dict[str, tuple[int, ...]] = {}
    flat: list[int] = []
    sentence_at: list[int] = []
    doc_at: list[int] = []
    kept: list[int] = []
    for text, label in zip(texts, labels, strict=True):
        start = len(sentence_at)
        for s in _sentence(text.lower()):
            words = _word(s[0])
            if words:
                sentence_at.append(len(flat))
                for w in words:
                    flat.extend(known.get(w) or known.setdefault(w, word_features(w)))
        if len(sentence_at) > start:
            doc_at.append(start)
            kept.append(label)
    y = np.array(kept, dtype=float)
    model = np.zeros(BUCKETS + 1)
    if not kept or y.min() == y.max():
        model[-1] = -np.inf
        return model
    f = np.array(flat, dtype=np.int64)
    of_sentence = np.repeat(np.arange(len(sentence_at)), np.diff([*sentence_at, len(f)]))
    of_doc = np.repeat(np.arange(len(doc_at)), np.diff([*doc_at, len(sentence_at)]))
    known_in = np.unique(f * len(y) + of_doc[of_sentence])
    with_label = [
        np.bincount((part := known_in[y[known_in % len(y)] == v]) // len(y), minlength=BUCKETS) for v in (0, 1)
    ]
    learnt = evidence(*with_label, len(y) - y.sum(), y.sum()) >= EVIDENCE
    used = learnt[f]
    if not used.any():
        model[-1] = -np.inf
        return model
    f, of_sentence = f[used], of_sentence[used]
    # Only sentences with a learnt feature, and documents with such a sentence, can move a weight.
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    kept_sentences, of_sentence = np.unique(of_sentence, return_inverse=True)
    kept_docs, doc_at, of_doc = np.unique(of_doc[kept_sentences], return_index=True, return_inverse=True)
    y, weight = y[kept_docs], weight[kept_docs]
    sentences = len(kept_sentences)
    model[-1] = START_BIAS
    squares = np.full(BUCKETS + 1, 1e-8)
    for _ in range(steps):
        z = np.bincount(of_sentence, weights=model[f], minlength=sentences) + model[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), doc_at))  # of a document: no sentence offends
        # Slope of the log loss by a sentence's z: p for clean documents, -p * clean / (1 - clean) for toxic ones.
        slope = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * weight
        by_sentence = p * slope[of_doc]
        g = np.bincount(f, weights=by_sentence[of_sentence], minlength=BUCKETS + 1).astype(float)
        g[:-1] += shrink * model[:-1] / len(y)
        g[-1] = by_sentence.sum()
        squares += g * g
        model -= rate * g / np.sqrt(squares)
    return model


def bounded_sample(labelled: DataFrame, text: str, label: str, max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS) -> DataFrame:
    """At most ``max_docs`` rows and ``max_words`` words of each label; whole texts."""
    parts = []
    for value in (0, 1):
        one = labelled.where(F.col(label) == value).select(
            F.col(text).alias("text"), F.lit(value).alias("label"), F.xxhash64(text).alias("h"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).alias("n"),
        )
        few = one.where(F.col("n") <= max_words).orderBy("h", "text").limit(max_docs)
        before = F.sum("n").over(Window.orderBy("h", "text").rowsBetween(Window.unboundedPreceding, 0))
        parts.append(few.withColumn("total", before).where(F.col("total") <= max_words).select("text", "label"))
    return parts[0].unionByName(parts[1])



def score(
    docs: DataFrame, model: np.ndarray, text: str = "text", offending_at: float = 0.5, out: tuple[str, str] = ("score", "offending")
) -> DataFrame:
    """Adds the document's probability and its offending sentences, as array of (start, end, probability) in code points."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model.astype(np.float32))
    name = ("toxicity", uuid.uuid4().hex)
    span = T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("probability", T.DoubleType())]
    )
    kept = [f for f in docs.schema.fields if f.name.lower() not in {o.lower() for o in out}]
    schema = T.StructType([*kept, T.StructField(out[0], T.DoubleType()), T.StructField(out[1], T.ArrayType(span))])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shipped.value
        bias = float(weights[-1])
        sums: dict[str, float | None] = worker_state(name, dict)

        def of_word(w: str) -> float | None:
            """The weights of a word's learnt features; None if it has none."""
            if w not in sums:
                if len(sums) >= CACHE_ENTRIES:
                    sums.clear()
                learnt = [float(weights[i]) for i in word_features(w) if weights[i]]
                sums[w] = sum(learnt) if learnt else None
            return sums[w]

        def one(value: str | None) -> tuple[float, list[tuple[int, int, float]]]:
            if not value or bias == -np.inf:
                return 0.0, []
            places, z = [], []
            low = value.lower()
            same = len(low) == len(value)  # a few letters change their length in lower case
            for s in _sentence(low if same else value):
                words = _word(s[0] if same else s[0].lower())
                learnt = [v for v in map(of_word, words) if v is not None]
                if learnt:
                    places.append(s.span())
                    z.append(sum(learnt) + bias)
            if not z:
                return 0.0, []
            p = 1 / (1 + np.exp(-np.clip(np.array(z), -500, 500)))
            whole = -np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())
            return float(whole), [(*places[i], float(p[i])) for i in np.flatnonzero(p >= offending_at)]

        for batch in slices(batches):
            found = [one(v.as_py()) for v in batch.column(text)]
            spans = [[{"start": a, "end": b, "probability": p} for a, b, p in s] for _, s in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array([x for x, _ in found], pa.float64()), pa.array(spans, kind)],
                [*(f.name for f in kept), *out],
            )

    return docs.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> np.ndarray:
    """Train on a bounded sample of the documents that ``labels`` (key, label) names.

    The ids are chosen first, at most MAX_DOCS of each label, so that they can be broadcast and no text is shuffled.
    """
    chosen = [
        labels.where(F.col(label) == value).select(key, label).distinct().orderBy(F.xxhash64(key), key).limit(MAX_DOCS)
        for value in (0, 1)
    ]
    sample = docs.select(key, text).join(F.broadcast(chosen[0].unionByName(chosen[1])), key)
    rows = bounded_sample(sample, text, label).collect()  # bounded by MAX_DOCS and MAX_WORDS of each label
    rows.sort(key=lambda r: (r.text, r.label))
    return train([r.text for r in rows], [r.label for r in rows])
