"""Host verdicts against a plain version of the beta-binomial fit."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_llm import DOCS, text_of

from strokelab.llm import host_quality


def verdicts(counts, odds=4.0, certainty=1.645):
    """host -> (rate, rejected) for host -> (documents, failures)."""
    n, f = sum(c for c, _ in counts.values()), sum(b for _, b in counts.values())
    m = f / n
    between = sum(c * (b / c - m) ** 2 for c, b in counts.values())
    free = len(counts) - 1
    below = (n - sum(c * c for c, _ in counts.values()) / n - free) * m * (1 - m)
    r = (between - free * m * (1 - m)) / below if below else 0
    weight = min(n, max(2, 1 / r - 1)) if r > 0 else n
    most = odds * m / (1 - m + odds * m)
    out = {}
    for h, (c, b) in counts.items():
        rate = (b + m * weight) / (c + weight)
        out[h] = rate, rate - certainty * math.sqrt(rate * (1 - rate) / (c + weight + 1)) > most
    return out


CASES = {
    "one bad host": {"a": (400, 12), "b": (300, 8), "c": (500, 20), "bad": (120, 90)},
    "few rows are no proof": {"a": (400, 12), "b": (300, 8), "tiny": (2, 2), "none": (3, 0)},
    "alike": {"a": (100, 5), "b": (100, 5), "c": (100, 5)},
    "one host": {"a": (10, 4)},
    "nothing fails": {"a": (10, 0), "b": (5, 0)},
    "all fail": {"a": (10, 10), "b": (5, 5)},
}


@pytest.mark.parametrize("case", CASES)
def test_host_verdicts(spark, case):
    counts = CASES[case]
    rows = [(h, i < b) for h, (c, b) in counts.items() for i in range(c)]
    stats = spark.createDataFrame(rows, "h string, bad boolean")
    got = {r["_host"]: (r["host_rate"], r["host_rejected"]) for r in host_quality.host_verdicts(stats, "h", "bad", 4.0, 1.645).collect()}
    want = verdicts(counts)
    assert got.keys() == want.keys()
    for h, (rate, rejected) in want.items():
        assert math.isclose(got[h][0], rate, abs_tol=1e-9) and got[h][1] == rejected
    assert {h for h, (_, x) in want.items() if x} == ({"bad"} if case == "one bad host" else set())


def test_rows_of_a_rejected_host_go(spark):
    rows = [(i, text_of(i, 40), "en", f"h{i % 3}", 1) for i in range(120)] + [(200 + i, "few words", "en", "spam", 1) for i in range(40)] + [(300 + i, text_of(300 + i, 40), "en", "spam", 1) for i in range(5)]
    rows += [(400, text_of(7, 40), "en", None, 1), (400, text_of(7, 40), "en", None, 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("_failed", F.lit("x")).withColumn("_host", F.lit("spam"))
    kept = host_quality.kept_rows(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([*range(120), 400, 400])
    assert {r["doc_id"] for r in host_quality.judge(docs).where("kept").collect()} == {*range(120), 400}
