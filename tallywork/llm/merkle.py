"""Merkle manifest of a dataset: one root for all rows, and for every row the proof that it is in it.

A leaf is the SHA-256 of a row's fields; the leaves of a source, in the order of their ids,
are hashed ``fanout`` by ``fanout`` until one is left, and the sources' subroots, in the
order of their names, likewise until one root is left.

Slot pivot. A node's place divided by the fanout is its parent, the rest its slot. One
aggregation per level spreads the children of each parent into ``fanout`` columns, by
conditional aggregates. The columns one after the other hash to the parent; the same columns
without a child's own one are its siblings. So on the way back from the root each parent
hands every child what stands left and right of it, in front of what the parent got itself.

Places. Rows are range-partitioned and sorted by (source, id), numbered inside each
partition and written; the offset of a partition in its source comes from counts per
(partition, source). No source, however large, is sorted or numbered in one task, and no
level is gathered: a parent has ``fanout`` children, whatever the source. There are as many
levels as the largest source needs, and each is written, so a lost executor costs tasks of one level.

Defined cases: a null field is `-`; rows without a source are a source of their own, before
all others ('' is another one); rows with equal ids are ordered by their leaves, null ids come
first; repeated rows are leaves of their own; a null id is never chosen for tampering;
an empty table gives an empty result; other columns than the named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import sha256_hex, store

# The fields of a leaf, in order, and the number of children of a node.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3


def encoded(value: Column) -> Column:
    """A field's bytes in a leaf: their number, a colon, and the value; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return sha256_hex(F.concat(*map(encoded, fields)))


def _group_key(source: Column) -> Column:
    """A text that is never null, equal where sources are, and in their order with null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def place_in_group(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``place`` (from 0 in each group, by ``order``) and ``n`` (rows of the group); written to the shared folder."""
    salt = "_salt"  # rows that are alike everywhere else need not go to one task
    dealt = rows.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(group, *order, salt)
    stored = store(
        dealt.sortWithinPartitions(group, *order, salt).withColumn("_at", F.monotonically_increasing_id()).drop(salt), name
    )
    stored = stored.withColumn("_part", F.shiftright("_at", 33))
    counts = store(stored.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")), f"{name}-parts")
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    sizes = counts.groupBy(group).agg(F.sum("_rows").alias("n"))
    return (
        stored.join(offsets.join(sizes, group), [group, "_part"])
        .withColumn("place", F.col("_at") - F.col("_first") + F.col("_offset"))
        .drop("_at", "_part", "_first", "_offset")
    )


def _slots(fanout: int) -> list[str]:
    return [f"c{s}" for s in range(fanout)]


def levels(leaves: DataFrame, name: str, fanout: int = FANOUT) -> list[DataFrame]:
    """The parents of each level from the lowest up: g, place, n (parents in the group), h, and the children c0, c1, ...

    ``leaves``: g, place, n, h. A group of one leaf has no parents; a group ends with the level at which n is 1.
    """
    found: list[DataFrame] = []
    nodes = leaves.select("g", "place", "n", "h")
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        slot = F.col("place") % fanout
        parents = (
            nodes.where("n > 1")
            .groupBy("g", "n", F.expr(f"place div {fanout}").alias("parent"))
            .agg(*(F.max(F.when(slot == s, F.col("h"))).alias(c) for s, c in enumerate(_slots(fanout))))
            .select(
                "g",
                F.col("parent").alias("place"),
                F.ceil(F.col("n") / fanout).alias("n"),
                sha256_hex(F.concat(*(F.coalesce(c, F.lit("")) for c in _slots(fanout)))).alias("h"),
                *_slots(fanout),
            )
        )
        found.append(store(parents, f"{name}-{len(found) + 1}"))
        nodes, most = found[-1], -(-most // fanout)
    return found


def tops(leaves: DataFrame, parents: Sequence[DataFrame]) -> DataFrame:
    """(g, h) of what remains of each group."""
    remaining = leaves.select("g", "n", "h")
    for level in parents:
        remaining = remaining.unionByName(level.select("g", "n", "h"))
    return remaining.where("n = 1").select("g", "h")


def hand_down(given: DataFrame, parents: Sequence[DataFrame], single: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(g, place, path, ...) for every leaf: the siblings from its own level up to its group's top, then ``given``'s path.

    ``given``: g, path (array of (left, right)) and columns that all rows of the group get;
    ``single``: leaves (g, n) of which groups of one are taken.
    """
    carried = [c for c in given.columns if c not in ("g", "path")]
    step = lambda left, right: F.struct(left.alias("left"), right.alias("right"))
    join = lambda names: F.concat(F.lit(""), *(F.coalesce(c, F.lit("")) for c in names))
    nodes: DataFrame | None = None
    for level in reversed(parents):
        begun = level.where("n = 1").select("g", "place").join(given, "g").select("g", "place", "path", *carried)
        nodes = begun if nodes is None else nodes.unionByName(begun)
        cs = _slots(fanout)
        child = lambda s: F.struct(
            (F.col("place") * fanout + s).alias("place"),
            F.col(cs[s]).isNotNull().alias("there"),
            F.concat(F.array(step(join(cs[:s]), join(cs[s + 1 :]))), F.col("path")).alias("path"),
        )
        nodes = (
            nodes.join(level.select("g", "place", *cs), ["g", "place"])
            .select("g", *carried, F.explode(F.array(*(child(s) for s in range(fanout)))).alias("child"))
            .where("child.there")
            .select("g", "child.place", "child.path", *carried)
        )
    alone = single.where("n = 1").select("g", F.lit(0).cast("long").alias("place")).join(given, "g")
    alone = alone.select("g", "place", "path", *carried)
    return alone if nodes is None else nodes.unionByName(alone)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, s: sha256_hex(F.concat(s["left"], h, s["right"])))


def proof_digest(path: Column) -> Column:
    return sha256_hex(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(leaves: DataFrame, source: str, order: Sequence[str], fanout: int = FANOUT) -> DataFrame:
    """Adds subroot, root and path to rows that have a column ``leaf``; the siblings on the path are of the given leaves.

    The rows come back with the columns of ``leaves`` without ``source``.
    """
    keep = [c for c in leaves.columns if c != source]
    rows = leaves.withColumn("g", _group_key(F.col(source))).drop(source)
    placed = store(place_in_group(rows, "g", [*order, "leaf"], "merkle-rows").withColumn("h", F.col("leaf")), "merkle-leaves")
    lower = levels(placed, "merkle-level", fanout)
    subroots = store(tops(placed, lower), "merkle-subroots").select(F.lit("").alias("g"), F.col("g").alias("name"), "h")
    sources = store(place_in_group(subroots, "g", ["name"], "merkle-sources"), "merkle-tops")
    upper = levels(sources, "merkle-top-level", fanout)
    path = "CAST(array() AS array<struct<left:string,right:string>>)"
    root = tops(sources, upper).select("g", F.expr(path).alias("path"), F.col("h").alias("root"))
    above = hand_down(root, upper, sources.select("g", "n"), fanout)
    given = sources.join(above, ["g", "place"]).select(F.col("name").alias("g"), "path", F.col("h").alias("subroot"), "root")
    paths = hand_down(store(given, "merkle-sources-paths"), lower, placed.select("g", "n"), fanout)
    return placed.select("g", "place", *keep).join(paths, ["g", "place"]).select(*keep, "subroot", "root", "path")


def prove_documents(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """A tamper test of the manifest of ``docs`` (columns FIELDS): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows with an even CRC-32 of their decimal id are checked with a text that has lost its newlines.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even & F.contains("text", F.lit("\n")), leaf_hash([*fields[:-1], changed]))
    leaves = docs.select("doc_id", "source", leaf_hash(fields).alias("leaf"), tampered.alias("tampered"))
    proved = manifest(leaves, "source", ["doc_id"], fanout)
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
