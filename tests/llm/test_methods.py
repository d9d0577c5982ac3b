"""Whole queries of the link graph, toxicity, decontamination and licences against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import DOCS, text_of

from strokelab.llm import decontaminate, licenses, toxicity, url_graph


def judged(pages, rules=url_graph.RULES, damping=0.85, factor=1.0):
    """(host, path, rule, verdict) of (id, url, html), with PageRank by 300 plain rounds."""

    def parts(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        return (m[1].translate(brute.A_Z), m[2]) if m else ("", "")

    def rule_of(host, path):
        fits = [(len(h + p), h + p, kind) for kind, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    rows = {i: (*parts(u), *rule_of(*parts(u))) for i, u, _ in pages}
    links = Counter()
    for i, _, html in pages:
        for u in re.findall(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)""", html or ""):
            src, dst = rows[i][0], parts(re.sub("^//", "http://", u))[0]
            if src and dst and src != dst:
                links[src, dst] += 1

    def rank(kind, edges):
        n, good = Counter(r[0] for r in rows.values()), Counter(r[0] for r in rows.values() if r[3] == kind)
        w = {h: good[h] / n[h] for h in good if h}
        out = Counter()
        for (s, _), k in edges.items():
            out[s] += k
        x = {h: (1 - damping) * v for h, v in w.items()}
        for _ in range(300):
            new = defaultdict(float, {h: (1 - damping) * v for h, v in w.items()})
            for (s, d), k in edges.items():
                new[d] += damping * x.get(s, 0.0) * k / out[s]
            x = new
        return x

    trust, distrust = rank("allow", links), rank("block", Counter({(d, s): k for (s, d), k in links.items()}))
    return {i: (h, p, rule, v or ("block" if distrust.get(h, 0.0) > factor * trust.get(h, 0.0) else "allow"), trust.get(h, 0.0), distrust.get(h, 0.0)) for i, (h, p, rule, v) in rows.items()}


def test_urls_over_a_planted_graph(spark):
    rng = random.Random(4)
    hosts = [f"h{i}.{'example.com net org io'.split()[i % 4]}" for i in range(40)]
    pages = []
    for i in range(300):
        path = rng.choice(["/en/7", "/de/1", "/es/2", "/fr/3", "/"])
        linked = "".join(f"<a class=x href='{rng.choice(['http:', '', 'HTTPS:'])}//{rng.choice(hosts)}/p'>t</a>" for _ in range(rng.randint(0, 3)))
        pages.append((i, f"https://{rng.choice(hosts)}{path}?q#f", linked))
    pages += [(300, None, None), (301, "http://chain0.io/", "<a href=//chain1.io/>")] + [(301 + i, f"http://chain{i}.io/", f"<a href=//chain{i + 1}.io/>") for i in range(1, 40)] + [(350, "http://x.net/de/1", "<a href='//chain0.io/'>")]
    df = spark.createDataFrame(pages + pages[:3], "page_id long, url string, html string").withColumn("rank", F.lit(1)).withColumn("trust", F.lit(1))
    got = url_graph.judge_urls(df).collect()
    assert len(got) == len(pages) + 3
    want = judged(pages + [(1000 + i, u, h) for i, (_, u, h) in enumerate(pages[:3])])
    for r in got:
        h, p, rule, verdict, trust, distrust = want[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (h, p, rule)
        assert math.isclose(r["trust"], trust, abs_tol=1e-5) and math.isclose(r["distrust"], distrust, abs_tol=1e-5)
        assert r["verdict"] == verdict or abs(trust - distrust) < 1e-5
    assert {r["page_id"]: r["trust"] for r in got}[340] > 0  # forty links away from a seed


def toxic_scores(docs, labels, k=15, significance=24.0, ordinary=0.02, prefixes=(4, 5, 6, 7), smooth=0.5):
    def terms(text):
        words = Counter(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.A_Z)))
        out = Counter(words)
        for w, n in words.items():
            for p in prefixes:
                if len(w) > p:
                    out[w[:p] + "*"] += n
        return out

    bags = [terms(t) for _, t in docs]
    of = {}
    for (d, _), bag, t in zip(docs, bags, [t for _, t in docs], strict=True):
        last = "\U0010ffff" if t is None else t  # a null is the example only where there is nothing else
        if d in labels and zlib.crc32(str(d).encode()) % 5 and (d not in of or last < of[d][0]):
            of[d] = (last, bag)
    seen = [Counter(), Counter()]
    for d, (_, bag) in of.items():
        seen[labels[d]].update(bag.keys())
    n, p = len(of), sum(labels[d] for d in of)
    gain = {}
    for t in seen[0] | seen[1]:
        a, c = seen[1][t], seen[0][t]
        b, e = p - a, n - p - c
        below = (a + b) * (c + e) * (a + c) * (b + e)
        r = n * (a * e - b * c) ** 2 / below / significance if below and a + c >= 5 else 0
        told = math.sqrt(r) * min(1, r * r)
        gain[t] = (told if told > 2 * ordinary else 0) if t.endswith("*") else ordinary + told
    vocabulary = {t for t in gain if gain[t]}  # every word of an example, and the prefixes that tell
    held = Counter(t for bag in bags for t in bag.keys() & vocabulary)
    idf = {t: gain[t] * (math.log((1 + len(docs)) / (1 + held[t])) + 1) for t in vocabulary}
    at = {t: i for i, t in enumerate(sorted(vocabulary))}

    def vector(bag):
        v = np.zeros(len(at))
        for t in bag.keys() & vocabulary:
            v[at[t]] = (1 + math.log(bag[t])) * idf[t]
        size = math.sqrt(float(v @ v))
        return v / size if size else v

    prior = p / n
    bare = [labels[d] for d, (_, bag) in of.items() if not bag.keys() & vocabulary]
    examples = [(vector(bag), labels[d]) for d, (_, bag) in of.items() if bag.keys() & vocabulary]
    matrix, y = np.array([v for v, _ in examples]), np.array([x for _, x in examples])
    out = []
    for (d, _), bag in zip(docs, bags, strict=True):
        if not bag.keys() & vocabulary:
            out.append((sum(bare) + smooth * prior) / (len(bare) + smooth))
            continue
        cos = matrix @ vector(bag)
        kth = np.sort(cos)[::-1][min(k, len(cos)) - 1]
        near = (cos >= kth - 1e-9) & (cos > 0)
        w = (cos[near] / cos.max()) ** 2 if near.any() else cos[near]
        out.append((w @ y[near] + smooth * prior) / (w.sum() + smooth) if near.any() else prior)
    return out, len(vocabulary)


@pytest.mark.parametrize("ids", ["long", "string"])
def test_toxicity_whole(spark, ids):
    bad = ("idiots", "scumbag", "moronic", "trash")
    rows = [(i, text_of(i, 30) + (f" {bad[i % 4]} {bad[i * 7 % 3]} {text_of(i + 1, 5)}" if i % 5 == 0 or i % 11 == 0 else ""), "en", "a", 1) for i in range(500)]
    rows += [(7, "a second text of seven with trash", "en", "a", 1), (20, None, "en", "a", 1), (900, None, "en", "a", 1), (901, "", "en", "a", 1)]
    labels = {i: int(i % 5 == 0) for i in range(400)}
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1)).withColumn("_y", F.lit(1))
    table = spark.createDataFrame(list(labels.items()) + [(950, 1), (None, 1)], "doc_id long, toxic int")
    if ids == "string":
        docs, table = (d.withColumn("doc_id", F.col("doc_id").cast("string")) for d in (docs, table))
    got = sorted((str(r["doc_id"]), round(r["score"], 9)) for r in toxicity.score(docs, table).collect())
    scores, n = toxic_scores([(i, t) for i, t, *_ in rows], labels)
    assert n >= 4 and got == sorted((str(i), round(float(s), 9)) for (i, *_), s in zip(rows, scores, strict=True))


def test_toxicity_is_calibrated(spark):
    """Labels that a word only makes likelier: mean scores of held-out texts meet the rate of their labels."""
    rng = random.Random(8)
    odds = {"awful": 0.8, "rude": 0.5, "odd": 0.2, "": 0.03}
    kinds = [rng.choice(list(odds)) for _ in range(3000)]
    rows = [(i, f"{text_of(i, 12)} {k}", "en", "a", 1) for i, k in enumerate(kinds)]
    labels = [(i, int(rng.random() < odds[k])) for i, k in enumerate(kinds)]
    got = toxicity.score(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    for kind, rate in odds.items():
        mine = [r["score"] for r in got if kinds[r["doc_id"]] == kind]
        assert abs(sum(mine) / len(mine) - rate) < 0.12


def test_banded_alignment_is_exact():
    rng = random.Random(6)
    for _ in range(300):
        passage = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 40)))
        text = list("".join(rng.choice("abcd ") for _ in range(rng.randint(0, 60))))
        at = rng.randint(0, len(text))
        near = list(passage)
        for _ in range(rng.randint(0, 4)):
            j = rng.randint(0, len(near))
            near[j : j + rng.randint(0, 1)] = rng.choice(["", "x", "a"])
        text = "".join(text[:at] + near + text[at:])
        want = brute.edits(passage, text)
        got = decontaminate.aligned(passage, text, 5, -len(passage) - 1, len(text) + 1)
        assert (got[0] if got else None) == (want if want <= 5 else None)
        if got:  # the end is that of an occurrence with so many edits, also in a band around it only
            assert brute.edits(passage, text[: got[1]][-len(passage) - 5 :]) == got[0]
            middle = got[1] - len(passage)
            again = decontaminate.aligned(passage, text, 5, middle - 5, middle + 5)
            assert again and again[0] == want


def test_short_passages_and_repeated_grams(spark):
    items = [(1, "ab cd"), (2, "x"), (3, "-" * 300), (4, "nine nine"), (5, "exactly10!"), (6, " \n "), (7, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "zz AB  cd yy", "", "", 0), (2, "xab cdx", "", "", 0), (3, "-" * 60_000, "", "", 0), (4, "nine nine nine", "", "", 0), (5, "so exactly10! it is x", "", "", 0), (6, None, "", "", 0), (7, "exactly11!", "", "", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("edits", F.lit(1))
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 1, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0), (5, 2, 0)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench, block_chars=100).collect()) == [2, 6, 7]


def test_licence_texts_score_higher_than_a_sentence(spark):
    mit = next(t for t in licenses.TEMPLATES if len(t) > 4)
    body = " ".join(p for p, _ in mit[1:])
    rows = [
        (1, f"Copyright 2020 Someone. {body.upper()}", "", "", 0),
        (2, f"word {mit[1][0]} other", "", "", 0),
        (3, f"{mit[2][0]} {mit[3][0]}", "", "", 0),  # clauses without the grant name no licence
        (4, "\n".join(p.replace(" copies", " copys") for p, _ in mit[1:]), "", "", 0),
        (5, "a gnu is a general, public and free animal of the plains", "", "", 0),
        (6, None, "", "", 0),
        (6, "", "", "", 0),
    ] + [(10 + i, text_of(i, 50), "", "", 0) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("label", F.lit(1)).withColumn("word", F.lit(1))
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert [got[i]["labels"] for i in (1, 2, 3, 4, 5, 6)] == ["mit", "mit", "", "mit", "", ""]
    assert got[1]["score"] > 0.99 > got[4]["score"] > 0.8 > got[2]["score"] > 0.1
    own = (("house", ("the owner of this house grants nothing to nobody", ("grants nothing",))),)
    assert [r["labels"] for r in licenses.scan(spark.createDataFrame([(1, "The owner of this house grants nothing to nobody!", "", "", 0)], DOCS), templates=own).collect()] == ["house"]


def test_every_notice_is_found_with_a_word_changed():
    """Recall of the index against reading every place: passages with one word replaced, anywhere in a text."""
    rng = random.Random(3)
    index = licenses.RareIndex({"the": 900, "and": 800, "of": 700}, 1000)
    found = asked = 0
    for i, (template, passage, must) in enumerate(index.passages):
        for _ in range(20):
            words = list(passage)
            words[rng.randrange(len(words))] = b"changed"
            text = text_of(i, 30).encode().lower().split() + words + text_of(i + 1, 30).encode().lower().split()
            same = sum(index.idf[w] for p, w in enumerate(passage) if words[p] == w)
            if must and same >= index.agree * index.weight[i] and all(licenses.places(words, p) for p in must):
                asked += 1
                found += index.labels[template] in index.matches(text)
    assert asked > 100 and found >= 0.9 * asked
