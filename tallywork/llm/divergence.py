"""Source divergence audit: which terms and sources set a source apart from its language.

Terms are runs of ASCII letters and other code points from 128 on, lower-cased in A-Z only. A
language keeps the ``V`` terms that occur in at least ``min_docs`` of its documents. With N
the occurrences of kept terms, a term that occurs ``count`` times has the integer probability
p = 1 + floor(10^9 * (count + 2) / (N + 2 V)) in a source, and q likewise in another source or
in the whole language; (p - q)^2 / (p + q), rounded down, says how far apart they are.

Counting. A task takes the UTF-8 bytes of two megabytes of texts at a time and finds all terms with
numpy. Terms are packed by length: up to eight bytes are one unsigned 64-bit word, up to sixteen two
words, highest byte first; these are radix-sorted, sixteen bits a pass, and equal neighbours
are counted as runs. Longer terms go to buckets by length (17 to 32 bytes, 33 to 64, ...) that are
sorted as bytes. So a term leaves a task once per source and slice, and Spark adds up.
A text longer than a slice is counted in parts that are merged before its terms count as one document.

Comparing. Sources of a language are compared over blocks of kept terms and pairs of blocks of
sources, a dense matrix of bounded size each, whose partial sums Spark adds up. A term that both
sources lack adds the same everywhere, so it is counted and not stored.

All arithmetic is on integers; products beyond 64 bits are decimals of 38 digits.

Defined cases: a null text, language or source is ''; every row is a document of its own,
repeated ones and those without an id as well; a text without terms still makes its (language, source)
occur; a language without kept terms has pairs of value 0 and no term rows; a language
with one source has no pairs; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import release_memory, store

# The term limit, the scale of probabilities, what is added to a count, the ranks of part 'term'.
MIN_DOCS, SCALE, ADDED, TOP = 10, 1_000_000_000, 2, 10

#: Bytes of text in one slice of a task; terms and sources in one block of the comparison.
SLICE_BYTES, BLOCK_TERMS, BLOCK_SOURCES = 2 << 20, 1024, 256

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Terms:
    """Packed terms of one length bucket: key columns, highest first, and for each its document and how often it counts."""

    keys: list[np.ndarray]
    doc: np.ndarray
    times: np.ndarray

    def take(self, at: np.ndarray) -> Terms:
        return Terms([k[at] for k in self.keys], self.doc[at], self.times[at])


def find_terms(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and row of every term in the lower-cased bytes of several texts, which end at ``ends``."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _LETTER[data]
    begins_at, ends_at = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    border = ends[(ends > 0) & (ends < len(data))]
    border = border[inside[border + 1] & inside[border]]  # terms of two texts that touch
    begins_at[border], ends_at[border] = True, True
    begin = np.flatnonzero(begins_at)
    return begin, np.flatnonzero(ends_at) - begin, np.searchsorted(ends, begin, side="right")


def pack(data: np.ndarray, begin: np.ndarray, length: np.ndarray, doc: np.ndarray) -> dict[int, Terms]:
    """Terms by the most bytes of their bucket: 8, 16, 32, 64, ..."""
    buckets = {}
    for words in (1, 2):
        chosen = np.flatnonzero((length <= 8 * words) & (length > 8 * (words - 1)))
        if len(chosen):
            at, n = begin[chosen], length[chosen]
            keys = [np.zeros(len(at), dtype=np.uint64) for _ in range(words)]
            for k in range(8 * words):
                has = np.flatnonzero(n > k)
                keys[k // 8][has] |= data[at[has] + k].astype(np.uint64) << np.uint64(56 - 8 * (k % 8))
            buckets[8 * words] = Terms(keys, doc[chosen], np.ones(len(at), dtype=np.int64))
    long = np.flatnonzero(length > 16)
    most = 1 << np.ceil(np.log2(length[long])).astype(np.int64)
    for size in np.unique(most).tolist():
        chosen = long[most == size]
        texts = [data[b : b + n].tobytes() for b, n in zip(begin[chosen].tolist(), length[chosen].tolist(), strict=True)]
        buckets[size] = Terms([np.array(texts, dtype=f"S{size}")], doc[chosen], np.ones(len(chosen), dtype=np.int64))
    return buckets


def _sorted(numbers: np.ndarray, order: np.ndarray) -> np.ndarray:
    """``order``, sorted stably by unsigned numbers, sixteen bits a pass; a pass in which all are equal is left out."""
    for shift in range(0, numbers.dtype.itemsize * 8, 16):
        digit = (numbers >> numbers.dtype.type(shift)).astype(np.uint16)
        if digit.min() != digit.max():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_counts(terms: Terms, group: np.ndarray) -> tuple[Terms, np.ndarray]:
    """One entry per (group of the document, term) with its occurrences, and how many documents have it.

    ``doc`` must ascend and ``group``, by document, must ascend with it; ``doc`` of the result is a run's first.
    """
    order = np.arange(len(terms.doc))
    for key in reversed(terms.keys):
        order = order[np.argsort(key[order], kind="stable")] if key.dtype.kind == "S" else _sorted(key, order)
    order = _sorted(group[terms.doc].astype(np.uint32), order)
    terms = terms.take(order)
    of = group[terms.doc]
    starts = np.ones(len(order), dtype=bool)
    starts[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in terms.keys], of[1:] != of[:-1])
    another = starts.copy()
    another[1:] |= terms.doc[1:] != terms.doc[:-1]
    first = np.flatnonzero(starts)
    runs = terms.take(first)
    runs.times = np.add.reduceat(terms.times, first)
    return runs, np.add.reduceat(another.astype(np.int64), first)


def unpack(keys: list[np.ndarray]) -> pa.Array:
    """Terms as text again."""
    if keys[0].dtype.kind != "S":
        keys = [np.stack(keys, axis=1).astype(">u8").reshape(-1).view(f"S{8 * len(keys)}")]
    return pa.array(keys[0].tolist(), pa.binary()).cast(pa.string())


def _lowered(text: bytes) -> np.ndarray:
    return _LOWER[np.frombuffer(text, dtype=np.uint8)]


def _long_text(text: bytes, slice_bytes: int) -> dict[int, Terms]:
    """The distinct terms of one long text with their counts, part by part."""
    data, merged, begin, alone = np.frombuffer(text, dtype=np.uint8), {}, 0, np.zeros(1, dtype=np.int64)
    while begin < len(data):
        end = min(begin + slice_bytes, len(data))
        while end < len(data) and _LETTER[data[end]]:  # never inside a term
            end += 1
        part = _LOWER[data[begin:end]]
        at, length, row = find_terms(part, np.array([len(part)]))
        for size, terms in pack(part, at, length, row).items():
            if size in merged:
                old = merged[size]
                terms = Terms(
                    [np.concatenate(k) for k in zip(old.keys, terms.keys, strict=True)],
                    np.concatenate([old.doc, terms.doc]),
                    np.concatenate([old.times, terms.times]),
                )
            merged[size] = run_counts(terms, alone)[0]
        begin = end
    return merged


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents with the term, summed up."""
    empty = F.lit("")
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), empty).alias("lang"),
        F.coalesce(F.col(source).cast("string"), empty).alias("source"),
        F.coalesce(F.col(text), empty).cast("binary").alias("text"),
    )
    names = ["lang", "source", "term", "n", "docs"]

    def emit(buckets: dict[int, Terms], groups: list[tuple[str, str]], group: np.ndarray) -> Iterator[pa.RecordBatch]:
        for terms in buckets.values():
            runs, having = run_counts(terms, group)
            of = pa.array(group[runs.doc])
            columns = [pa.array([g[k] for g in groups], pa.string()).take(of) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, unpack(runs.keys), pa.array(runs.times), pa.array(having)], names)

    def counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """A slice of rows of about slice_bytes."""
        pairs = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
        groups = sorted(set(pairs))
        number = {g: i for i, g in enumerate(groups)}
        texts = [v.as_py() for v in batch.column("text")]
        if len(texts) == 1 and len(texts[0]) > slice_bytes:
            yield from emit(_long_text(texts[0], slice_bytes), groups, np.zeros(1, dtype=np.int64))
            return
        order = sorted(range(len(pairs)), key=lambda i: number[pairs[i]])
        data = _lowered(b"".join(texts[i] for i in order))
        ends = np.cumsum([len(texts[i]) for i in order])
        group = np.array([number[pairs[i]] for i in order], dtype=np.int64)
        yield from emit(pack(data, *find_terms(data, ends)), groups, group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, size = 0, 0
            for i, v in enumerate(batch.column("text")):
                n = v.as_buffer().size
                if i > begin and size + n > slice_bytes:
                    yield from counted(batch.slice(begin, i - begin))
                    begin, size = i, 0
                size += n
            if begin < batch.num_rows:
                yield from counted(batch.slice(begin))
        release_memory()

    found = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)); 0 without kept terms."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    above = wide(F.lit(SCALE), 10) * wide(count + ADDED, 20)
    below = wide(total + ADDED * kept, 20)
    return F.when(kept > 0, F.call_function("div", above, F.when(below > 0, below)) + 1).otherwise(F.lit(0).cast("long"))


def _partial_sums(table: pa.Table) -> pa.Table:
    """One block of terms for the sources of one or two blocks: what it adds to the value of each pair."""
    sources = table.column("source").combine_chunks().dictionary_encode()
    terms = table.column("term").combine_chunks().dictionary_encode()
    n_sources, n_terms = len(sources.dictionary), len(terms.dictionary)
    who = sources.indices.to_numpy()
    what = terms.indices.fill_null(n_terms).to_numpy()  # the last column: a term that the source lacks
    p = table.column("p").to_numpy()
    lacking = what == n_terms
    dense = np.zeros((n_sources, n_terms + 1), dtype=np.int64)
    dense[who[lacking]] = p[lacking][:, None]
    dense[who, what] = p
    side = np.zeros(n_sources, dtype=np.int64)
    side[who] = table.column("block").to_numpy()
    # The first block counts all kept terms as lacking; each block takes back those that it has.
    times = np.ones(n_terms + 1, dtype=np.int64)
    times[-1] = pc.max(table.column("kept")).as_py() - n_terms
    one_block = table.column("b1")[0].as_py() == table.column("b2")[0].as_py()
    a, b, value = [], [], []
    for i in range(n_sources):
        others = np.arange(i + 1, n_sources)
        if not one_block:
            others = others[side[others] != side[i]]
        if len(others):
            both = dense[i] + dense[others]
            apart = dense[i] - dense[others]
            values = (apart * apart // np.maximum(both, 1)) @ times
            a += [i] * len(others) + others.tolist()
            b += others.tolist() + [i] * len(others)
            value += values.tolist() * 2
    name = sources.dictionary
    lang = pa.array([table.column("lang")[0].as_py()] * len(a), pa.string())
    return pa.table(
        {"lang": lang, "source": name.take(pa.array(a, pa.int64())), "item": name.take(pa.array(b, pa.int64())), "value": pa.array(value, pa.int64())}
    )


def pair_values(cells: DataFrame, groups: DataFrame, block_terms: int = BLOCK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language.

    ``cells``: lang, source, term, p of kept terms that occur; ``groups``: lang, source, p0 (of a term that
    does not occur), kept (terms of the language).
    """
    per_lang = groups.groupBy("lang").agg(
        F.max(F.greatest(F.ceil(F.col("kept") / block_terms), F.lit(1))).alias("term_blocks"),
        F.ceil(F.count(F.lit(1)) / block_sources).alias("source_blocks"),
    )
    block = F.pmod(F.xxhash64("source"), F.col("source_blocks"))
    present = cells.join(per_lang, "lang").select(
        "lang", "source", "term", "p", F.lit(0).cast("long").alias("kept"), block.alias("block"), "source_blocks",
        F.pmod(F.xxhash64("term"), F.col("term_blocks")).alias("chunk"),
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1))
    absent = groups.join(per_lang, "lang").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "kept",
        block.alias("block"), "source_blocks", every.alias("chunk"),
    )
    # The absent terms of the whole language count in the first block of terms only.
    absent = absent.withColumn("kept", F.when(F.col("chunk") == 0, F.col("kept")).otherwise(0))
    rows = present.unionByName(absent).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("source_blocks") - 1)))
    rows = rows.select(
        "lang", "chunk", F.least("block", "with").alias("b1"), F.greatest("block", "with").alias("b2"), "source", "term", "p", "kept", "block"
    )
    parts = rows.groupBy("lang", "chunk", "b1", "b2").applyInArrow(
        lambda table: _partial_sums(table), "lang string, source string, item string, value long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    slice_bytes: int = SLICE_BYTES,
    block_terms: int = BLOCK_TERMS,
    block_sources: int = BLOCK_SOURCES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' ranks all other sources, part 'term' the ``top`` terms that stand out."""
    counts = store(term_counts(docs, text, lang, source, slice_bytes), "audit-counts")
    terms = store(
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .select("lang", "term", "lang_n"),
        "audit-terms",
    )
    cells = store(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "audit-cells")
    of_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    empty = F.lit("")
    occurring = docs.select(
        F.coalesce(F.col(lang).cast("string"), empty).alias("lang"), F.coalesce(F.col(source).cast("string"), empty).alias("source")
    ).distinct()
    groups = store(
        occurring.join(of_lang, "lang", "left")
        .join(of_group, ["lang", "source"], "left")
        .na.fill(0, ["kept", "lang_total", "total"])
        .withColumn("p0", _probability(F.lit(0), F.col("total"), F.col("kept"))),
        "audit-groups",
    )
    scored = cells.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        _probability(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    pairs = pair_values(scored.select("lang", "source", "term", "p"), groups.select("lang", "source", "p0", "kept"), block_terms, block_sources)
    apart = F.col("p") - F.col("q")
    standing_out = scored.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.call_function("div", apart * apart, F.col("p") + F.col("q")).alias("value")
    )
    ranks = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.withColumn("rank", ranks).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    return ranked(pairs, "pair").unionByName(ranked(standing_out, "term").where(F.col("rank") <= top))
