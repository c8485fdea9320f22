"""SimHash near-duplicates, the source divergence audit and the Merkle manifest on small and odd tables."""

import collections
import random
import sys
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from test_edges import ROWS, SCHEMA  # noqa: E402

from tallywork.llm import divergence, merkle, simhash  # noqa: E402
from tallywork.llm.oracle import ORACLE  # noqa: E402

ODD = [
    *ROWS,
    (13, "Écoute ÉCOUTE écoute naïve 日本語日本語日本語日本語 x\x00y", "fr", "a", 3),
    (14, "Donaudampfschifffahrtsgesellschaftskapitän " * 3 + "a" * 5000, "de", "", 3),
    (14, "line\n\nline\n", "de", None, 3),
    (15, "exactly8 eightlet eightlets sixteenletterssx seventeenletterss", "de", "b", None),
    (16, "A\nb\nC", "", "b", -4),
]
TEXT = st.text(alphabet="aBz é日\n\t,", max_size=40)


def table(rows):
    columns = list(zip(*rows, strict=True))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})


def by_sql(rows, sql):
    connection = duckdb.connect()
    connection.register("documents", table(rows))
    result = connection.execute(sql)
    return [d[0] for d in result.description], collections.Counter(result.fetchall())


# SimHash


@settings(max_examples=200, deadline=None)
@given(TEXT, st.sampled_from([1, 3, 7, 1 << 20]))
def test_fingerprint_equals_brute_force_in_parts_of_any_size(text, part_bytes):
    assert simhash.fingerprint(text.encode(), 3, part_bytes) % 2**64 == brute.simhash(text)


def test_odd_rows_equal_brute_force(spark):
    rows = simhash.near_duplicates(spark.createDataFrame(ODD, SCHEMA)).collect()
    want = brute.simhash_components([(r[0], r[1]) for r in ODD])
    assert collections.Counter(map(tuple, rows)) == collections.Counter(want)
    assert {r.fingerprint for r in rows if r.doc_id in (4, 5, 6)} == {"0" * 16}
    assert {r.component_id for r in rows if r.doc_id in (4, 5, 6)} == {4}  # without words, linked like any other


@pytest.mark.parametrize(("parts", "tile_rows"), [(1, 8), (1, 4096), (2, 8), (4, 4), (8, 16), (16, 16)])
def test_links_are_whole_for_any_tiling(spark, parts, tile_rows):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(20)] + [0, 2**64 - 1]
    prints = {p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for p in centres for _ in range(12)}
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(signed, "print long"), 3, parts, tile_rows).collect()
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        root[find(b % 2**64)] = find(a % 2**64)
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                assert find(a) == find(b)
    # A link joins only what links of three bits or fewer join.
    near = collections.defaultdict(set)
    for a in prints:
        near[a] = {b for b in prints if (a ^ b).bit_count() <= 3}
    for p in prints:
        seen, todo = {p}, [p]
        while todo:
            todo += (new := near[todo.pop()] - seen)
            seen |= new
        assert {q for q in prints if find(q) == find(p)} == seen


def test_a_group_of_near_copies_gives_a_forest_not_all_pairs():
    near = np.array([1 << b for b in range(64)] + [3 << b for b in range(63)], dtype=np.uint64)
    a, b = simhash.block_links(near, near, 3, True)
    assert len(a) == len(near) - 1 and len(set(a.tolist())) == len(a)


def test_tiles_grow_finer_with_the_corpus():
    found = [simhash.parts_for(n) for n in (0, 1000, 30_000, 250_000, 5_000_000, 100_000_000, 10**13)]
    assert found == sorted(found) and found[0] == 1 and found[-1] == 16
    assert len(simhash._near_tiles(1, 3)) == 4 and len(simhash._near_tiles(2, 3)) == 13


def test_an_id_with_several_texts_does_not_link_them(spark):
    rows = [(5, "one two three four five"), (5, "quite another text of other words"), (9, "one two three four five")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.component_id for r in got] == [5, 5, 5] and len({r.fingerprint for r in got}) == 2


def test_a_long_text_is_read_in_parts(spark):
    text = " ".join(f"w{i % 5000}" for i in range(400_000))
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    counts, n = simhash.bit_counts(text.encode(), 3, 1 << 30)
    parts, m = simhash.bit_counts(text.encode(), 3, 1 << 16)
    assert n == m == 399_998 and (counts == parts).all()
    assert simhash.near_duplicates(rows).first().component_id == 1


# Divergence


@pytest.mark.parametrize("settings_", [{}, {"slice_bytes": 64, "block_terms": 3, "block_sources": 2}])
def test_audit_of_odd_rows_equals_sql(spark, settings_):
    rows = ODD * 3 + [(20 + i, f"gemeinsam wort{i % 3} {'Haus ' * (i % 5)}", "de", f"s{i % 7}", 1) for i in range(60)]
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA), **settings_)
    columns, want = by_sql(rows, ORACLE["op12_length_bucketed_audit"])
    assert collections.Counter(map(tuple, got.select(*columns).collect())) == want
    assert {k[2] for k in want} == {"pair", "term"}


def test_no_kept_terms_and_single_sources(spark):
    rows = [(1, "a b", "en", "x", 1), (2, "", "en", "y", 1), (3, "alone", "fr", "x", 1)]
    got = sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


@pytest.mark.parametrize("slice_bytes", [1, 50, 1 << 20])
def test_term_counts_equal_brute_force(spark, slice_bytes):
    rows = ODD + [(30, " ".join(f"wort{chr(97 + i % 26)}" * (1 + i % 9) for i in range(3000)), "de", "z", 1)]
    got = divergence.term_counts(spark.createDataFrame(rows, SCHEMA), slice_bytes=slice_bytes).collect()
    assert {(r.lang, r.source, r.term): (r.n, r.docs) for r in got} == brute.term_counts([(r[2], r[3], r[1]) for r in rows])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.text(alphabet="aZé日 -", max_size=60)), min_size=1, max_size=6))
def test_packed_runs_equal_counts(docs):
    docs.sort(key=lambda d: d[0])
    texts = [divergence._lowered(t.encode()) for _, t in docs]
    data, ends = np.concatenate(texts), np.cumsum([len(t) for t in texts])
    group = np.array([g for g, _ in docs])
    got = {}
    for terms in divergence.pack(data, *divergence.find_terms(data, ends)).values():
        runs, having = divergence.run_counts(terms, group)
        for term, d, n, k in zip(divergence.unpack(runs.keys).to_pylist(), runs.doc, runs.times, having, strict=True):
            assert (group[d], term) not in got
            got[group[d], term] = (n, k)
    want = brute.term_counts([(str(g), "", t) for g, t in docs])
    assert got == {(int(lang), term): v for (lang, _, term), v in want.items()}


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    n, total, kept = 9 * 10**15, 9 * 10**17, 10**9
    p = spark.range(1).select(divergence._probability(F.lit(n), F.lit(total), F.lit(kept))).first()[0]
    assert p == 1 + 10**9 * (n + 2) // (total + 2 * kept)


# Manifest


@pytest.mark.parametrize("rows", [ODD, ODD * 2, ODD[:1], [(i, f"text\n{i}", "en", "hot" if i % 3 else f"s{i}", i) for i in range(200)]])
def test_manifest_of_odd_rows_equals_sql(spark, rows):
    got = merkle.prove_documents(spark.createDataFrame(rows, SCHEMA))
    columns, want = by_sql(rows, ORACLE["op13_slot_pivot_manifest"])
    assert collections.Counter(map(tuple, got.select(*columns).collect())) == want
    assert len({r.root for r in got.collect()}) == 1


def test_any_change_is_noticed(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(50)]
    root = merkle.prove_documents(spark.createDataFrame(rows, SCHEMA)).first().root
    for change in ((7, "text 7 ", "en", "s1", 7), (7, "text 7", None, "s1", 7), (7, "text 7", "en", "s2", 7), (7, "text 7", "en", "s1", None)):
        changed = [change if r[0] == 7 else r for r in rows]
        assert merkle.prove_documents(spark.createDataFrame(changed, SCHEMA)).first().root != root


def test_rows_that_are_all_alike_are_numbered_in_several_tasks(spark):
    rows = spark.range(0, 3000, numPartitions=8).selectExpr("1L AS doc_id", "'=a' AS g", "'x' AS leaf")
    placed = merkle.place_in_group(rows, "g", ["doc_id", "leaf"], "test-places")
    assert sorted(r.place for r in placed.collect()) == list(range(3000))
    assert {r.n for r in placed.collect()} == {3000}


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_fanout_is_a_parameter(spark, fanout):
    rows = [(i, "a\nb" if i % 2 else "ab", "en", f"s{i % 4}", i) for i in range(60)]
    got = merkle.prove_documents(spark.createDataFrame(rows, SCHEMA), fanout).collect()
    assert len(got) == 60 and len({r.root for r in got}) == 1
    assert any(not r.verified for r in got) and all(r.verified for r in got if r.doc_id % 2 == 0)
