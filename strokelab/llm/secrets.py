"""Secret scans: fixed base rules, and credentials that inferred grammars recognise by their format.

Credentials found by the base rules are the labelled examples.  A bounded sample of them (``max_examples`` distinct
values of at most ``max_chars`` characters, taken by hash) gives one prefix tree per kind over characters and character
classes; states are merged where their outcome frequencies are statistically compatible (ALERGIA, Hoeffding bound), which
leaves a small probabilistic automaton.  Values are learned whole, with their ends.  Every remaining candidate of every
text (a run of credential characters as long as the kind's shortest example; where examples hold dots inside, also runs of
as many parts between dots, longest first) is then scored by its likelihood per symbol under each automaton, end included, and
added where it reads like the examples and its characters are far less likely in the running text around
(``Background``: pairs of bytes of all texts outside the base spans).

Defined results: null and empty texts have no spans; repeated rows get the same spans; without any labelled example
only base spans are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: A credential candidate is a run of these characters.
RUN = "[A-Za-z0-9+/_=-]"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind as listed; code points, end exclusive."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, shortest: int, dots: int = 0) -> Iterator[list[tuple[int, int]]]:
    """All runs of credential characters of at least this length, each as its parts between single dots.

    Without ``dots``, the most that a credential holds inside, a run is one part.
    """
    if not dots:
        yield from ([m.span()] for m in re.finditer(f"{RUN}{{{shortest},}}", text))
        return
    part = re.compile(f"{RUN}+")
    for m in re.finditer(rf"{RUN}++(?:\.{RUN}++)*+", text):
        if m.end() - m.start() >= shortest:
            yield [p.span() for p in part.finditer(text, *m.span())]


#: Sets of characters, smaller ones first; a value's class is the first that holds all its letters and digits.
CLASSES = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower and digits": "0123456789abcdefghijklmnopqrstuvwxyz",
    "upper and digits": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "letters and digits": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
}
SIGNS = "+/_=.-"
_SETS = {name: frozenset(chars) for name, chars in CLASSES.items()}
#: A class and those that contain it, smallest first.
WIDER = {name: [other for other in _SETS if chars <= _SETS[other]] for name, chars in _SETS.items()}
_BITS = {name: math.log2(len(chars)) for name, chars in CLASSES.items()} | {"signs": math.log2(len(SIGNS))}


def class_of(value: str) -> str:
    used = set(value) - set(SIGNS)
    return next((name for name, chars in _SETS.items() if used <= chars), "letters and digits")


class Automaton:
    """Probabilistic automaton learned from strings by merging compatible states of their prefix tree.

    An arc of the tree is a character where at least ``least`` strings and the share ``literal`` of those that come so far
    go on with it (a fixed prefix, a dash); the others go on by the class of their whole value.
    """

    def __init__(self, strings: Iterable[str], alpha: float = 0.05, literal: float = 0.3, least: int = 20):
        self.alpha, self.apart = alpha, set()
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]  # arcs taken; "" is the end
        todo = [(0, 0, [(s, class_of(s)) for s in strings])]
        while todo:
            state, depth, group = todo.pop()
            going = [x for x in group if len(x[0]) > depth]
            if len(going) < len(group):
                self.count[state][""] = len(group) - len(going)
            often = Counter(s[depth] for s, _ in going)
            arcs: dict[str, list] = {}
            for x in going:
                c = x[0][depth]
                arcs.setdefault(c if often[c] >= max(least, literal * len(group)) else "signs" if c in SIGNS else x[1], []).append(x)
            for arc, part in sorted(arcs.items()):
                self.count[state][arc] = len(part)
                self.next[state][arc] = len(self.next)
                todo.append((len(self.next), depth + 1, part))
                self.next.append({})
                self.count.append(Counter())
        self._merge()
        self._compact()

    def _compatible(self, a: int, b: int) -> bool:
        """Outcomes of both states, and of all below them, are within the Hoeffding bound of each other.

        Pairs that lead to one beyond it are remembered until the next merger, so that long chains are walked once.
        """
        todo, above = [(a, b)], {(a, b): None}
        while todo:
            pair = a, b = todo.pop()
            ca, cb = self.count[a], self.count[b]
            na, nb = ca.total(), cb.total()
            if not na or not nb:
                continue
            bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if nb == 1 and bound > 1:  # and below b, a tree, it only grows
                continue
            if pair in self.apart or any(abs(ca[c] / na - cb[c] / nb) > bound for c in ca.keys() | cb.keys()):
                while pair is not None:
                    self.apart.add(pair)
                    pair = above[pair]
                return False
            na, nb = self.next[a], self.next[b]
            for c in na.keys() & nb.keys():
                if (below := (na[c], nb[c])) not in above:
                    above[below] = pair
                    todo.append(below)
        return True

    def _fold(self, a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if x == y:
                continue
            self.count[x] += self.count[y]
            for c, target in self.next[y].items():
                if c in self.next[x]:
                    todo.append((self.next[x][c], target))
                else:
                    self.next[x][c] = target

    def _merge(self) -> None:
        kept, fringe = [0], list(self.next[0].items())
        parents = {t: (0, c) for c, t in fringe}
        queue = [t for _, t in fringe]
        while queue:
            state = queue.pop(0)
            if self.next[parents[state][0]].get(parents[state][1]) != state:
                continue
            match = next((k for k in kept if self._compatible(k, state)), None)
            if match is None:
                kept.append(state)
                for c, t in self.next[state].items():
                    if t not in parents:
                        parents[t] = (state, c)
                        queue.append(t)
                continue
            self.apart.clear()
            before = {k: set(self.next[k].values()) for k in kept}
            self.next[parents[state][0]][parents[state][1]] = match
            self._fold(match, state)
            for k in kept:
                for c, t in self.next[k].items():
                    if t not in before[k] and t not in kept and t not in parents:
                        parents[t] = (k, c)
                        queue.append(t)

    def _compact(self) -> None:
        """Keep the states that can still be reached."""
        order, at = {0: 0}, [0]
        for state in at:
            for target in self.next[state].values():
                if target not in order:
                    order[target] = len(order)
                    at.append(target)
        self.next = [{c: order[t] for c, t in self.next[s].items()} for s in at]
        self.count = [self.count[s] for s in at]

    def score(self, value: str) -> float:
        """Log2 likelihood of the value and its end; -20 for a character that the automaton can't make there."""
        at, total, wider = 0, 0.0, WIDER[class_of(value)]
        for c in value:
            arcs = self.next[at]
            arc = c if c in arcs else next((x for x in (("signs",) if c in SIGNS else wider) if x in arcs), None)
            if arc is None:
                total -= 20.0
                continue
            total += math.log2(self.count[at][arc] / sum(self.count[at].values())) - _BITS.get(arc, 0.0)
            at = arcs[arc]
        ends = self.count[at][""]
        return total + (math.log2(ends / sum(self.count[at].values())) if ends else -20.0)


class Background:
    """Running text as pairs of bytes."""

    def __init__(self, pairs: dict[int, int]):
        counts = np.zeros((256, 256))
        for pair, n in pairs.items():
            counts[pair >> 8, pair & 255] = n
        self.bits = np.log2((counts + 0.5) / (counts.sum(1, keepdims=True) + 128))

    def score(self, value: str) -> float:
        raw = np.frombuffer(b" " + value.encode() + b" ", np.uint8)
        return float(self.bits[raw[:-1], raw[1:]].sum())


class Grammar:
    """Automata by kind of credential, with the likelihood a character that most of their own examples reach.

    A candidate must reach it, and be ``odds`` bits likelier than in running text.
    """

    def __init__(self, examples: dict[str, list[str]], pairs: dict[int, int], least: int = 20, quantile: float = 0.01, slack: float = 0.25, odds: float = 10.0):
        self.parts, self.background, self.odds = [], Background(pairs), odds
        for kind in KINDS:
            values = sorted(set(examples.get(kind, [])))
            if len(values) < least:
                continue
            machine = Automaton(values)
            scores = sorted(machine.score(v) / (len(v) + 1) for v in values)
            self.parts.append((machine, scores[int(quantile * (len(scores) - 1))] - slack, min(map(len, values))))
        self.shortest = min((shortest for _, _, shortest in self.parts), default=0)
        # A dot at an end is the sentence's.
        self.dots = max((v.strip(".").count(".") for values in examples.values() for v in values), default=0)

    def accepts(self, value: str) -> bool:
        likely = [score for machine, floor, shortest in self.parts if len(value) >= shortest and (score := machine.score(value)) / (len(value) + 1) >= floor]
        return bool(likely) and max(likely) >= self.background.score(value) + self.odds


def all_spans(text: str, grammar: Grammar) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans with those that the grammar adds (kind ``learned``; they overlap no base span)."""
    base = [s[:3] for s in base_spans(text)]
    extra = []
    if grammar.parts:
        # By start, each with the furthest end so far: a candidate overlaps one iff the last that starts before its end does.
        starts, ends = [s for _, s, _ in base], list(accumulate((e for *_, e in base), max))
        for parts in candidates(text, grammar.shortest, grammar.dots):
            at = 0
            while at < len(parts):
                # From the left, the most parts that read like one credential.
                for k in range(min(len(parts), at + grammar.dots + 1), at, -1):
                    start, end = parts[at][0], parts[k - 1][1]
                    before = bisect_left(starts, end)
                    if end - start >= grammar.shortest and not (before and ends[before - 1] > start) and grammar.accepts(text[start:end]):
                        extra.append(("learned", start, end))
                        at = k - 1
                        break
                at += 1
    order = {**{k: i for i, k in enumerate(KINDS)}, "learned": len(KINDS)}
    return base, sorted(base + extra, key=lambda s: (s[1], order[s[0]]))


def written(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: Iterable[tuple[str, int, int]], mark: str = "[secret]") -> str:
    """The text with every span (overlapping ones as one) replaced by a mark."""
    out, at = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], mark]
        at = e
    return "".join(out) + text[at:]


def _labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [(k, v) for t in b.column(0) for k, _, _, v in base_spans(t.as_py() or "")]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())], ["kind", "value"])


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbouring bytes (first * 256 + second) outside the base spans, and how often they stand."""
    for b in batches:
        counts = np.zeros(1 << 16, np.int64)
        for t in b.column(0):
            text = t.as_py() or ""
            raw = np.frombuffer(redact(text, [s[:3] for s in base_spans(text)], "  ").encode(), np.uint8)
            counts += np.bincount(raw[:-1].astype(np.int32) << 8 | raw[1:], minlength=1 << 16)
        at = counts.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["pair", "n"])


def fit(docs: DataFrame, text: str = "text", max_examples: int = 3000, max_chars: int = 512) -> Grammar:
    """Grammars from the base rules' own finds: at most ``max_examples`` distinct values of ``max_chars``, those of smallest hash."""
    found = docs.select(F.col(text)).mapInArrow(_labelled, "kind string, value string").where(F.length("value") <= max_chars)
    chosen = found.distinct().orderBy(F.xxhash64("kind", "value"), "kind", "value").limit(max_examples)
    examples: dict[str, list[str]] = {}
    for kind, value in chosen.collect():
        examples.setdefault(kind, []).append(value)
    pairs = docs.select(F.col(text)).mapInArrow(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return Grammar(examples, {r["pair"]: r["n"] for r in pairs.collect()})


def _scan(grammar: Grammar, keep_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                text = t.as_py()
                base, spans = all_spans(text or "", grammar)
                n = Counter(k for k, _, _ in base)
                row = [n["assign"], n["access"], n["hex"], hashlib.sha256(written(base).encode()).hexdigest(), written(spans)]
                rows.append(row + [redact(text, spans) if text else text] * keep_text)
            cols = list(zip(*rows, strict=True)) or [[]] * (5 + keep_text)
            kinds = [pa.int64()] * 3 + [pa.string()] * (2 + keep_text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *map(pa.array, cols, kinds)], ["_key", "n_assign", "n_access", "n_hex", "base_sha256", "spans"] + ["redacted"] * keep_text
            )

    return run


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", max_examples: int = 3000) -> DataFrame:
    """Per document: key, n_assign, n_access, n_hex, base_sha256, spans."""
    lean = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"_key {dict(docs.dtypes)[key]}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return lean.mapInArrow(_scan(fit(lean, "_text", max_examples), False), schema).withColumnRenamed("_key", key)


def redacted(docs: DataFrame, text: str = "text", max_examples: int = 3000) -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced."""
    grammar = fit(docs, text, max_examples)
    schema, at = docs.schema, docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t if t is None else redact(t, all_spans(t, grammar)[1]) for t in (x.as_py() for x in b.column(at))]
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(cols, list(b.schema.names))

    return docs.mapInArrow(run, schema)
