"""Near copies by similarity, against all pairs."""

import random
from collections import Counter

import corpus_pipeline as cp
from test_llm import DOCS, pairs, text_of

from strokelab.llm import simhash


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def kept(rows):
    """Smallest ids of the groups that all pairs at similarity 0.8 make."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n) and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = {d: lo if r == hi else r for d, r in root.items()}
    return {d for d, r in root.items() if d == r}


def edited(text, *at):
    return " ".join("new" if i in at else w for i, w in enumerate(text.split()))


def test_stage_takes_near_copies(spark):
    t = text_of(3, 204)
    chain = [edited(t, *range(10, 10 + 40 * n, 40)) for n in range(6)]  # each is like the next, the ends aren't
    rows = [(i, x) for i, x in enumerate([*chain, edited(t, 2, 5, 100, 150, 190), *[text_of(40 + i, 60) for i in range(20)], "a b", "A  b", "a c", None, " "])]
    rows += [(100 + i, edited(text_of(9, 300), 7 * i, 11 * i + 3)) for i in range(25)]
    docs = spark.createDataFrame([(d, x, "en", "a", 1) for d, x in rows], DOCS)
    assert {r["doc_id"] for r in cp.near_duplicates(spark, docs, "").collect()} == kept(rows)
    assert (simhash.fingerprint(t) ^ simhash.fingerprint(chain[2])).bit_count() > 2
    assert cp.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_stage_on_the_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = [r["doc_id"] for r in cp.near_duplicates(spark, docs, small).collect()]
    assert sorted(got) == sorted(kept(pairs(docs))) and 177 not in got


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    a, b, c, d = (text_of(i, 80) for i in (1, 2, 3, 4))
    rows = [(2, a), (5, a), (5, b), (5, b), (7, c), (7, d), (9, d), (None, d), (None, text_of(6, 80)), (None, text_of(6, 80)), (None, text_of(7, 80))]
    docs = spark.createDataFrame([(i, x, "en", "a", 1) for i, x in rows], DOCS)
    for n in (1, 5):
        got = Counter((r["doc_id"], r["text"]) for r in cp.near_duplicates(spark, docs.repartition(n), "").collect())
        assert got == Counter([(2, a), (5, b), (7, c), (7, d), (None, text_of(6, 80)), (None, text_of(7, 80))])
    other = spark.createDataFrame([(1, a, "en", "x", 1), (1, a, "fr", "y", 1)], DOCS)
    assert len({tuple(cp.near_duplicates(spark, other.repartition(n), "").first()) for n in (1, 2, 3)}) == 1


def test_star_steps_give_the_groups_of_union_find(spark):
    rng = random.Random(3)
    ids = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(400)]
    edges = [tuple(sorted(rng.sample(ids[:200], 2))) for _ in range(120)]  # a forest of many groups
    edges += [tuple(sorted((ids[200], x))) for x in ids[201:300]]  # a hub
    edges += [tuple(sorted(p)) for p in zip(ids[300:], ids[301:], strict=False)]  # a chain
    of = {x: x for e in edges for x in e}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        of[b] = a
    got = {tuple(r) for r in simhash.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(x, root(x)) for x in of}


def test_links_either_way_round_are_all_taken(spark):
    links = [(5, 3), (3, 5), (9, 5), (2, 9), (2, 9), (-7, -7), (None, 2), (20, 21), (30, 20), (40, 40), (40, 41)]
    got = sorted(map(tuple, simhash.connected(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == [(2, 2), (3, 2), (5, 2), (9, 2), (20, 20), (21, 20), (30, 20), (40, 40), (41, 40)]
    chain = [(i + 1, i) for i in range(300)]  # every link from the larger node to the smaller
    assert {tuple(r) for r in simhash.connected(spark.createDataFrame(chain, "u long, v long")).collect()} == {(i, 0) for i in range(301)}
    assert simhash.connected(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0
