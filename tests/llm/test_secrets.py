"""Grammars of credentials: whole values, and formats without digits."""

import random

import pytest
from test_llm import DOCS, text_of

from strokelab.llm import secrets

RNG = random.Random(2)


def some(letters, n):
    return "".join(RNG.choice(letters) for _ in range(n))


FORMATS = {
    "a sign and lower case after character 24": lambda: some("ABCDEFGHJKLMNP23456789", 30) + "-" + some("ghjkmnpqrstvwxyz", 10),
    "no digit": lambda: some("BCDFGHJKLMNPQRSTVWXZ", 20),
    "twelve characters": lambda: some("ABCDEFGHJKLMNP23456789", 12),
}


@pytest.mark.parametrize("name", FORMATS)
def test_formats(spark, name):
    key = FORMATS[name]
    rows = [(i, f"api_key = {key()} and so on", "en", "a", 1) for i in range(80)] + [(200 + i, text_of(i, 300), "en", "a", 1) for i in range(20)]
    value = key()
    rows += [(900, f"my pass is {value} thanks", "en", "a", 1), (901, "internationalisation-2024-report and 2023-10-11-12-13-14-15 ----------------", "en", "a", 1)]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[900] == f"learned:11:{11 + len(value)}"
    assert got[901] == "" and not any(got[200 + i] for i in range(20))


def test_ends_count():
    machine = secrets.Automaton(["hd" * 20 + "U"] * 30 + ["ld" * 20 + "s"] * 30)
    assert machine.score("hd" * 20 + "U") > -3
    assert machine.score("hd" * 20 + "s") < -18 and machine.score("hd" * 20) < -18 and machine.score("hd" * 20 + "UU") < -18


def test_many_long_examples():
    secrets.Automaton([some("hlHUds", 512) for _ in range(300)] + ["d" * n for n in range(200, 512)])


HEX = "0123456789abcdef"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
SHAPES = {
    "fixed prefix": (lambda: "ghp_" + some(LETTERS, 36), ["ghq_" + some(LETTERS, 36), "ghp_" + some(LETTERS, 30), "ghp_" + some(LETTERS, 44)]),
    "groups": (lambda: "-".join(some(HEX, n) for n in (8, 4, 4, 4, 12)), [some(HEX, 36).replace("a", "-"), "-".join(some(HEX, n) for n in (8, 4, 4, 4, 11)), "-".join(some("xyz", n) for n in (8, 4, 4, 4, 12))]),
    "length": (lambda: some(HEX, 40), [some(HEX, 39), some(HEX, 41), some("ghijkl", 40)]),
}


@pytest.mark.parametrize("name", SHAPES)
def test_held_out_formats(name):
    make, others = SHAPES[name]
    pairs = {a << 8 | b: 1000 for a in b"etaoin shrdlu" for b in b"etaoin shrdlu"}
    grammar = secrets.Grammar({"assign": [make() for _ in range(300)]}, pairs)
    assert 1 < len(grammar.parts[0][0].next) <= 45  # states are merged, but the format is kept
    assert sum(grammar.accepts(make()) for _ in range(200)) >= 190
    assert not any(map(grammar.accepts, others)) and not grammar.accepts("the house on the hill")


def test_every_candidate_is_scored(spark):
    """The learned half against a plain version over all runs of all texts."""
    import re

    rows = [(i, f"{text_of(i, 30)} token={some(HEX, 40)} AKIA{some('ABCDEFGH234567', 16)} {some(HEX, 40)} x", "en", "a", 1) for i in range(60)]
    rows += [(100 + i, f"{some(HEX, 15)}A{some(HEX, 24)} key {some(LETTERS, 20)} AKIB{some('ABCDEFGH234567', 16)} {'AKIA' * 5}", "en", "a", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    grammar = secrets.fit(docs)
    for r in secrets.scan(docs).collect():
        text = dict((i, t) for i, t, *_ in rows)[r["doc_id"]]
        base = [s[:3] for s in secrets.base_spans(text)]
        more = [
            ("learned", m.start(), m.end())
            for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text)
            if m.end() - m.start() >= grammar.shortest and not any(s < m.end() and m.start() < e for _, s, e in base) and grammar.accepts(m[0])
        ]
        assert r["spans"] == secrets.written(sorted(base + more, key=lambda s: (s[1], [*secrets.KINDS, "learned"].index(s[0]))))


def test_tokens_of_dotted_parts(spark):
    key = lambda: f"eyJ{some(LETTERS, 17)}.eyJ{some(LETTERS, 27)}.{some(LETTERS, 24)}"
    rows = [(i, f"token={key()} and so on. {text_of(i, 30)}", "en", "a", 1) for i in range(120)]
    value, other = key(), key()
    rows += [(900, f"bearer {value}. Then see.{other}.html", "en", "a", 1), (901, "www.example.com/a.b.c and internationalisation.module.submodule.function.name", "en", "a", 1)]
    rows += [(902, f"{some('xyz', 20)}.{some('xyz', 30)}.{some('xyz', 24)} {value[:40]} {'a.' * 20_000}", "en", "a", 1)]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(rows, DOCS)).collect()}
    at = 7 + len(value) + len(". Then see.")
    assert got[900] == f"learned:7:{7 + len(value)},learned:{at}:{at + len(other)}"
    assert got[901] == "" and got[902] == ""
