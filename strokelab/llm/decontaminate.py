"""Benchmark decontamination by the q-gram lemma.

A passage of m characters that occurs with at most k edits shares at least m - q + 1 - k*q of its q-grams with the text,
all on diagonals (text position - passage position) at most k apart.  Shared q-grams are counted in bands of diagonals
twice as wide as needed that overlap by half, so one band always holds them all; bands with enough of them are verified
by an alignment of the band's diagonals (and k more on both sides).  The edit budget is ``edit_rate`` of the passage's
length.  A passage shorter than a q-gram has no budget and is found where its words stand as whole words.

The benchmark is a query set: it is read in blocks of at most about ``block_chars`` characters, and each block is sent to
all tasks and run over all documents.  Texts are compared in lower case with runs of white space as one space.

Defined results: null and empty texts hold nothing; null and blank passages are not searched for; repeated
rows give repeated findings; an empty documents or benchmark table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strokelab.llm.common import materialize

U = np.uint64
TABLE_BITS = 22
TEXT_BLOCK = 1 << 20
PAIRS = 1 << 21


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def symbols(text: str) -> np.ndarray:
    """One byte per character, only for the q-gram filter: equal characters have equal bytes."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return (points ^ (points >> 8) ^ (points >> 16)).astype(np.uint8)


def grams(symbol: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram (8 <= q <= 16), read as two overlapping 8-byte words."""
    n = len(symbol) - q + 1
    if n <= 0:
        return np.empty(0, U)
    raw = symbol.tobytes()
    low, high = (np.ndarray((n,), "<u8", raw, at, (1,)) for at in (0, q - 8))
    return (low * U(0x9E3779B97F4A7C15)) ^ (high * U(0xC2B2AE3D27D4EB4F))


def aligned(passage: str, text: str, budget: int, low: int, high: int) -> tuple[int, int] | None:
    """(edits, end) of the passage's best occurrence in the text, if within the budget.

    Only cells on the diagonals ``low`` to ``high`` (text position - passage position) are filled, row by row.
    """
    at = text.find(passage, max(0, low), max(0, high) + len(passage))
    if at >= 0:
        return 0, at + len(passage)
    n, never = len(text), 1 << 30
    width = high - low + 1
    # The text as the band sees it, with nothing before and behind: cell (i, d) ends at text position i + low + d.
    seen = np.full(len(passage) + width, -1, np.int64)
    first, last = max(0, low), min(n, low + len(seen))
    if first < last:
        seen[first - low : last - low] = np.frombuffer(text[first:last].encode("utf-32-le"), np.uint32)
    place = low + np.arange(width)
    ramp = np.arange(width)
    row = np.where((place >= 0) & (place <= n), 0, never)
    for i, c in enumerate(passage, 1):
        new = row + (seen[i - 1 : i - 1 + width] != ord(c))
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])
        row = np.minimum.accumulate(new - ramp) + ramp
        row[(place + i < 0) | (place + i > n)] = never
        if row.min() > budget:
            return None
    best = int(row.argmin())
    return int(row[best]), len(passage) + low + best


class PassageIndex:
    """The q-grams of one block of passages, and the lemma's numbers for each."""

    def __init__(self, items: list[tuple[int, str]], q: int = 10, edit_rate: float = 0.08):
        named = sorted(((len(n) < q, i, n) for i, t in items if (n := normal(t))), key=lambda x: x[0])
        self.q, self.ids, self.passages = q, [i for _, i, _ in named], [n for *_, n in named]
        # Shorter passages than a q-gram come last; they are looked up as runs of whole words.
        self.short: dict[str, list[int]] = {}
        for at, (short, _, n) in enumerate(named):
            if short:
                self.short.setdefault(n, []).append(at)
        self.short_words = sorted({n.count(" ") + 1 for n in self.short})
        whole = [n for short, _, n in named if not short]
        sizes = np.array(list(map(len, whole)), np.int64)
        # The lemma needs at least one shared q-gram: short passages get a smaller budget.
        self.budget = np.minimum((sizes * edit_rate).astype(np.int64), (sizes - q) // q)
        self.need = sizes - q + 1 - self.budget * q
        self.least = int(self.need.min()) if len(sizes) else 0
        hashes = [grams(symbols(p), q) for p in whole]
        flat = np.concatenate([np.empty(0, U), *hashes])
        order = np.argsort(flat, kind="stable")
        self.keys, self.first = np.unique(flat[order], return_index=True)
        self.last = np.append(self.first[1:], len(flat))
        self.item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])[order] if hashes else np.empty(0, np.int64)
        self.position = np.concatenate([np.empty(0, np.int64), *[np.arange(len(h)) for h in hashes]])[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.keys >> U(64 - TABLE_BITS)).astype(np.int64)] = True

    def bands(self, text: str) -> list[tuple[int, int]]:
        """(passage, first diagonal of a band) with as many shared q-grams as the passage's budget asks for."""
        hashes = grams(symbols(text), self.q)
        at = np.flatnonzero(self.table[(hashes >> U(64 - TABLE_BITS)).astype(np.int64)])
        if len(at) < self.least or not len(self.keys):
            return []
        slot = np.searchsorted(self.keys, hashes[at])
        slot[slot == len(self.keys)] = 0
        real = self.keys[slot] == hashes[at]
        at, slot = at[real], slot[real]
        many = self.last[slot] - self.first[slot]
        # Pairs of places are made some at a time, so that a text and a passage of one repeated q-gram don't meet at once.
        part = np.cumsum(many) // PAIRS
        codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for cut in np.split(np.arange(len(at)), np.flatnonzero(np.diff(part)) + 1) if len(at) else []:
            n, s = many[cut], slot[cut]
            each = np.repeat(self.first[s], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item, diagonal = self.item[each], np.repeat(at[cut], n) - self.position[each]
            band = np.floor_divide(diagonal, self.budget[item] + 1)
            found, k = np.unique((np.concatenate([item, item]) << 40) + np.concatenate([band, band - 1]) + (1 << 30), return_counts=True)
            codes, back = np.unique(np.concatenate([codes, found]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, k]), len(codes)).astype(np.int64)
        which = codes >> 40
        good = counts >= self.need[which]
        return [(int(i), int(b) * int(self.budget[i] + 1)) for i, b in zip(which[good], (codes[good] & ((1 << 40) - 1)) - (1 << 30), strict=True)]

    def find(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text number, passage, edits, end in the normalised text): the best occurrence of each passage in each text."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        starts = ends - [len(t) + 1 for t in texts]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for i, diagonal in self.bands("\0".join(texts)):
            passage, k = self.passages[i], int(self.budget[i])
            low, high = diagonal - k, diagonal + 2 * (k + 1) + len(passage) + k
            # The band may touch two texts where their ends meet.
            for d in range(int(np.searchsorted(ends, max(0, low), "right")), len(texts)):
                if starts[d] >= high:
                    break
                if best.get((d, i), (k + 1, 0))[0] == 0:
                    continue
                found = aligned(passage, texts[d], k, low - int(starts[d]), low - int(starts[d]) + 4 * k + 2)
                if found and found[0] < best.get((d, i), (k + 1, 0))[0]:
                    best[d, i] = found
        for d, text in enumerate(texts if self.short else []):
            words = text.split(" ")
            for n in self.short_words:
                at = 0
                for j in range(len(words) - n + 1):
                    for i in self.short.get(" ".join(words[j : j + n]), ()):
                        best.setdefault((d, i), (0, at + len(self.passages[i])))
                    at += len(words[j]) + 1
        return sorted((d, i, *v) for (d, i), v in best.items())


def _blocks(texts: Iterable[str | None]) -> Iterator[list[str]]:
    group, n = [], 0
    for t in texts:
        group.append(normal(t))
        n += len(group[-1])
        if n >= TEXT_BLOCK:
            yield group
            group, n = [], 0
    if group:
        yield group


def found_in(index: PassageIndex, texts: Iterable[str | None]) -> Iterator[tuple[int, int, int, int]]:
    """``PassageIndex.find`` over any number of texts, some at a time; text numbers count through."""
    done = 0
    for group in _blocks(texts):
        for d, i, edits, end in index.find(group):
            yield done + d, i, edits, end
        done += len(group)


def _search(index: PassageIndex):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = list(found_in(index, (t.as_py() for t in b.column(1))))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array([d for d, *_ in hits], pa.int64())),
                    pa.array([index.ids[i] for _, i, *_ in hits], pa.int64()),
                    pa.array([e for *_, e, _ in hits], pa.int64()),
                    pa.array([len(index.passages[i]) for _, i, *_ in hits], pa.int64()),
                    pa.array([end for *_, end in hits], pa.int64()),
                ],
                ["_key", "item_id", "edits", "passage_chars", "end_char"],
            )

    return run


def blocks_of(benchmark: DataFrame, block_chars: int, **options) -> Iterator[PassageIndex]:
    """Indexes of the benchmark's blocks; each block is read on its own, so that no more than it is on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").alias("t")).where("t is not null")
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / block_chars))
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).orderBy("i", "t").collect()
        index = PassageIndex([tuple(r) for r in part], **options)
        if index.passages:
            yield index


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", block_chars: int = 4_000_000, **options
) -> DataFrame:
    """One row per document and passage found in it: key, item_id, edits, passage_chars, end_char."""
    lean = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"_key {dict(docs.dtypes)[key]}, item_id long, edits long, passage_chars long, end_char long"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in blocks_of(benchmark, block_chars, **options):
        # Each block's finds are written, so that its index is gone from the driver when the next one is read.
        out = out.union(materialize(lean.mapInArrow(_search(index), schema), "found"))
    return out.withColumnRenamed("_key", key)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_chars: int = 4_000_000, **options) -> DataFrame:
    """The same rows and columns without documents that hold a passage; filtered where they are read, with no shuffle."""
    at, schema = docs.columns.index(text), docs.schema

    def keep(index: PassageIndex):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                mask = np.ones(b.num_rows, bool)
                mask[[d for d, *_ in found_in(index, (t.as_py() for t in b.column(at)))]] = False
                yield b.filter(pa.array(mask))

        return run

    done = 0
    for index in blocks_of(benchmark, block_chars, **options):
        docs = (materialize(docs, "clean") if done else docs).mapInArrow(keep(index), schema)
        done += 1
    return docs
