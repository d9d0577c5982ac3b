"""SimHash near-duplicates: fingerprints, a binary trie self-join within a Hamming budget, and groups of linked texts.

Equal fingerprints are one leaf of the trie, so copies never pair with each other.  The trie is joined with itself level
by level: a frontier of node pairs (a, b) with the bits they differ in so far; each step goes down some bits on both
sides at once, adds the bits in which the children differ, and drops a pair as soon as it exceeds the budget or its
partner doesn't exist.  Down to depth ``log2(leaves)`` nodes have many children; below, a node holds about one leaf, so
the last step takes the leaves themselves down and meets their partners' leaves.  Work grows as leaves * log2(leaves) ** budget, never with the square of a
group of copies.

Defined results: null and blank texts have fingerprint zero and are linked like any other; fewer than three words are
one shingle; documents without an id belong to their group but are never its representative; repeated rows get the
same group; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strokelab.llm.common import materialize

SEED = 42
BITS = 64
CHUNK = 1 << 16
LEAVES = 10_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint (unsigned) of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)), len(words) - shingle + 1
    counts, left = np.zeros(BITS, np.int64), n
    while left:
        m = min(left, CHUNK)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)) if m == left else _take(grams, m), np.uint64, m)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        left -= m
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def _take(grams: Iterator[bytes], m: int) -> Iterator[int]:
    for _ in range(m):
        yield xxhash.xxh64_intdigest(next(grams), SEED)


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.array([fingerprint(t.as_py()) for t in b.column(1)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["_key", "fp"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key, fp`` (fp: the fingerprint as a signed long), one row per document."""
    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(_fingerprints, f"_key {kind}, fp long")


def flips(bits: int, budget: int) -> list[tuple[int, int]]:
    """(mask, bits set) of all masks of so many bits with at most ``budget`` set."""
    return [(sum(1 << i for i in at), n) for n in range(budget + 1) for at in combinations(range(bits), n)]


def trie_self_join(leaves: DataFrame, fp: str = "fp", budget: int = 2, step: int = 9) -> DataFrame:
    """Pairs ``u < v`` of distinct fingerprints (signed longs) that differ in 1 to ``budget`` bits, each pair once."""
    n = leaves.count()
    dense = min(BITS - 2, max(1, math.floor(math.log2(max(2, n)))))
    node_at = lambda depth: F.shiftrightunsigned(F.col(fp), BITS - depth) if depth else F.lit(0).cast("long")

    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("k")) for m, k in flips(step, budget)])

    def reach(children: DataFrame, keep: str, down: int) -> DataFrame:
        """For each child (``node``) of a: the children of b that what is left of the budget still reaches."""
        left = lambda m: (m["mask"] < (1 << down)) & (m["k"] <= budget - F.col("differ"))
        out = children.select("a", "b", "differ", "node", keep, F.explode(F.filter(masks, left)).alias("m"))
        low = F.col("node").bitwiseAND((1 << down) - 1).bitwiseXOR(F.col("m.mask"))
        partner = F.shiftleft("b", down).bitwiseOR(low)
        # Below one node each pair of children comes from its smaller side only.
        return out.where((F.col("a") != F.col("b")) | (F.col("node") <= partner)).select(
            F.col(keep).alias("a"), partner.alias("b"), (F.col("differ") + F.col("m.k")).alias("differ"), (F.col("node") == partner).alias("same")
        )

    pairs = leaves.sparkSession.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("differ"))
    depth = 0
    while dense - depth > step:
        depth += step
        nodes = materialize(leaves.select(node_at(depth).alias("node")).distinct(), "nodes")
        children = nodes.join(pairs, F.shiftrightunsigned("node", step) == F.col("a")).withColumn("_keep", F.col("node"))
        pairs = materialize(reach(children, "_keep", step).join(nodes.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b", "differ"), "pairs")
    # A leaf becomes some hundred rows of masks: dealt out by leaves, not by the bytes of their small table.
    dealt = leaves.repartition(max(1, math.ceil(n / LEAVES)), F.col(fp))
    children = dealt.select(F.col(fp).alias("fa"), node_at(depth).alias("a"), node_at(dense).alias("node")).join(pairs, "a")
    left = reach(children, "fa", dense - depth).withColumnRenamed("a", "fa")
    right = leaves.select(F.col(fp).alias("fb"), node_at(dense).alias("_b"))
    rest = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb")).bitwiseAND((1 << (BITS - dense)) - 1))
    hit = (left["b"] == right["_b"]) & (left["differ"] + rest <= budget) & (~left["same"] | (F.col("fa") < F.col("fb")))
    return left.join(right, hit).select(F.least("fa", "fb").alias("u"), F.greatest("fa", "fb").alias("v"))


def connected(edges: DataFrame) -> DataFrame:
    """Groups of linked nodes as ``node, root`` (root: the smallest node; roots map to themselves).

    Alternates two star steps: every larger neighbour of a node, then every smaller one, is tied to the node's smallest
    neighbour.  Only minima are aggregated; a join brings the links of a node to one task, where they pass in order of the
    node and none is kept.  Links may stand either way round and more than once; a node's link with itself, or with null, ties
    nothing.  A round lowers some node's smallest neighbour or leaves stars, which the next one leaves as they are: so it ends,
    after a number of rounds that grows with the logarithm of the longest chain, and is never cut short.
    """
    seen = Observation()
    edges = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v").distinct()
    edges = materialize(edges.observe(seen, F.max(F.lit(True)).alias("moved")), "edges")
    while seen.get["moved"]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v", (F.col("m") < F.col("u")).alias("moved")).groupBy("u", "v").agg(F.max("moved").alias("moved"))
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        seen = Observation()
        small = large.join(least, "v").observe(seen, F.max(F.col("moved") | (F.col("m") < F.col("u"))).alias("moved"))
        small = small.select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("u").alias("v")), F.struct(F.col("m").alias("u"), F.col("v")))).alias("e"))
        edges = materialize(small.select("e.u", "e.v").where("u < v").distinct(), "edges")
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = 2) -> DataFrame:
    """Per document: key, fingerprint (16 hex digits), component_id (smallest key reachable), n_links of its fingerprint."""
    prints = materialize(fingerprints(docs, key, text), "prints")
    leaves = materialize(prints.groupBy("fp").agg(F.min("_key").alias("least")), "leaves")
    links = materialize(trie_self_join(leaves.select("fp"), "fp", budget), "links")
    groups = materialize(connected(links), "groups")
    member = groups.join(leaves, groups["node"] == leaves["fp"]).select("node", "root", "least")
    named = groups_named(member)
    degree = links.select(F.col("u").alias("node")).union(links.select(F.col("v").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    by_print = materialize(
        leaves.join(named, leaves["fp"] == named["node"], "left")
        .drop("node")
        .join(degree, leaves["fp"] == degree["node"], "left")
        .select("fp", F.coalesce("name", "least").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")),
        "by_print",
    )
    return prints.join(by_print, "fp").select(
        F.col("_key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links"
    )


def groups_named(member: DataFrame) -> DataFrame:
    """``node, name``: the smallest ``least`` of all members of the node's group."""
    names = member.groupBy("root").agg(F.min("least").alias("name"))
    return member.select("node", "root").join(names, "root").select("node", "name")
