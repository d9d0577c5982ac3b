"""The divergence audit against a plain version, in small blocks and tiles, and on awkward tables."""

from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from strokelab.llm import divergence

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TERM = regex.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
A_Z = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_docs, top):
    """rows: (text, lang, source)."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        words = TERM.findall((text or "").translate(A_Z))
        groups[lang or ""].add(source or "")
        n[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, k in docs[lang].items() if k >= min_docs]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(n[lang, s]) for s in sources}
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            term = sorted((q[t] - p[s][t], t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t])[:top]
            for part, items in (("pair", pair), ("term", term)):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(items)}
    return out


def texts(n):
    words = [f"{a}{b}" for a in "kmnpré" for b in ("a", "E", "io", "ñu", "日")]
    return [(" ".join(words[(i * 7 + j * j * (i % 5)) % len(words)] for j in range(i % 23)), ("en", "fr", None)[i % 3], None if i % 11 == 0 else f"s{i * i % 9}") for i in range(n)]


AWKWARD = [
    (None, None, None),
    ("", "en", "empty"),
    ("12 345 !!", "en", "no terms"),
    ("rare", "de", "a"),
    ("rare Rare", "de", "b"),
    ("x" * 3_000_000 + " ka " + "ka me " * 400_000, "en", "s1"),
    ("A_B[C]d e\x00f@g`h{i\x7fj ÀB ſK", "en", "s1"),
]


@pytest.mark.parametrize("min_docs", [1, 3])
def test_audit(spark, min_docs):
    rows = texts(150) + AWKWARD + AWKWARD[-1:]
    docs = spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], DOCS).repartition(3)
    clashing = docs.select("*", *[F.lit(1).alias(c) for c in ("term", "n", "docs", "part", "item", "value", "rank", "block", "at", "words", "terms", "tile", "size", "low")])
    got = divergence.audit(clashing, min_docs=min_docs, top=4, block_terms=5, columns=2, tile_sources=2)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain(rows, min_docs, 4)


def test_production_sizes_give_the_same(spark):
    rows = texts(400)
    docs = spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], DOCS)
    assert {tuple(r) for r in divergence.audit(docs).collect()} == plain(rows, 30, 50)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_counts_pass_on_early(spark):
    rows = texts(60)
    docs = spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], DOCS)
    few, many = (sorted(map(tuple, divergence.term_counts(docs, max_terms=m).collect())) for m in (1, 10**6))
    assert few == many and sum(r[3] for r in few) == sum(len(TERM.findall(t)) for t, _, _ in rows)


def test_shares_are_exact_for_large_counts(spark):
    big = 10**17 + 3
    row = spark.createDataFrame([(big, big * 9, 10**9)], "n long, words long, terms long").select(divergence.share(F.col("n"), F.col("words"), F.col("terms")).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 5) // (9 * big + 5 * 10**9)
    assert not isinstance(row["p"], Decimal)


def test_difference_meets_all_ends():
    rng = np.random.default_rng(1)
    for size in (1, 2, 9, 40):
        for _ in range(50):
            whole = [rng.integers(0, 3, size) for _ in range(2)]
            runs = []
            for column in whole:
                first = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
                runs.append((first, column[first]))
            assert divergence.difference(*runs, size) == int(np.abs(whole[0] - whole[1]).sum())


def test_terms_of_equal_counts_lie_together(spark):
    rows = [(f"s{s}", f"t{t}", 1 + (t % 3) * (s + 1)) for s in range(4) for t in range(60)]
    kept = spark.createDataFrame([("en", s, t, n, 0, s == "s0") for s, t, n in rows], "lang string, source string, term string, n long, total long, lead boolean")
    placed = [r["term"] for r in divergence.ordered_vocabulary(kept, 1 << 20, 2).orderBy("block", "at").collect()]
    kinds = [int(t[1:]) % 3 for t in placed]
    assert sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) == 2
