"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded sample of labelled rows (``max_examples``, by hash of the id) gives the examples.  All their words are terms, and
so are prefixes of longer words that labels depend on.  A term's weight is its IDF over all documents times a gain: a small
one for every word (``ordinary``), and more the more the labels of the examples depend on the term.  So no text with a known
word is without neighbours, while common words don't drown the few that tell.

Examples with equal vectors are one entry with several votes.  Entries lie in blocks, and the largest weight of each term of high
gain in each block bounds its part of every cosine there.  What all other terms can add is at most the product of both vectors'
norms over them.  Texts become term numbers in one pass, of the examples too, and are packed there: the driver sees only the
packed examples, and sends the index without what tasks can derive from it.  Blocks are read by falling bound until no other can
reach the k-th nearest, and entries that can are completed over all their terms, so the neighbours are exact.  Of the high terms'
part the most frequent ones are a matrix product for many texts at once, rounded to single precision, for which bounds leave room;
the others' postings are read.  Votes are weighted by similarity, as against the nearest, and smoothed by the rate among all
examples, which keeps scores calibrated.

A term is a word, or a prefix with a mark that no word holds.

Defined results: null and empty texts, and those without any word of an example, get the rate of such examples; repeated rows
get the same score; of several texts of one labelled id the least one is the example, and it is toxic if any label says so; without labels every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.llm.common import materialize

_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
_FLUSH = 300_000
_CACHE = 150_000
CHUNK = 4096
PART = 1 << 20
MARK = b"*"
GROUP = 128
SLACK = 5e-5
POST = np.dtype([("entry", np.int32), ("share", np.float32)])


def heads(word: bytes, prefixes: tuple[int, ...]) -> list[bytes]:
    """Prefixes of a word (so many characters) that are shorter than itself."""
    if word.isascii():
        return [word[:p] for p in prefixes if len(word) > p]
    text = word.decode()
    return [text[:p].encode() for p in prefixes if len(text) > p]


def words(text: str | None) -> Counter:
    return Counter((text or "").encode().translate(_SPLIT).split())


def _by_label(prefixes: tuple[int, ...]):
    """Per term and task: how many toxic and how many other texts hold it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()

        def out() -> pa.RecordBatch:
            of = list(seen[0].keys() | seen[1].keys())
            b = pa.RecordBatch.from_arrays([pa.array(of, pa.binary()), *(pa.array([c[t] for t in of], pa.int64()) for c in (seen[1], seen[0]))], ["term", "pos", "neg"])
            for c in seen:
                c.clear()
            return b

        for b in batches:
            for t, y in zip(b.column(0), b.column(1), strict=True):
                of = words(t.as_py())
                seen[y.as_py()].update(of.keys() | {h + MARK for w in of for h in heads(w, prefixes)})
                if len(seen[0]) + len(seen[1]) > _FLUSH:
                    yield out()
        yield out()

    return run


def _gained(p: int, n: int, significance: float, ordinary: float, least: int):
    """Terms that count for something, with their gain."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pos, neg = (c.to_numpy() for c in b.columns[1:])
            gain = gains(~pc.ends_with(b.column(0), MARK).to_numpy(zero_copy_only=False), pos, neg, p, n, significance, ordinary, least)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(gain > 0)), pa.array(gain[gain > 0])], ["term", "gain"])

    return run


class Vocabulary:
    """Numbers of terms (columns term, gain): those of largest gain first."""

    def __init__(self, gained: pa.Table, prefixes: tuple[int, ...]):
        gained = gained.sort_by([("gain", "descending"), ("term", "ascending")]).combine_chunks()
        self.terms, self.gain, self.prefixes = gained["term"].combine_chunks(), gained["gain"].to_numpy(), tuple(sorted(prefixes))
        self.number: dict[bytes, int] | None = None

    def __len__(self) -> int:
        return len(self.terms)

    def learn(self) -> None:
        """Dictionaries of words and of prefixes: made where texts are read."""
        self.number = dict(zip(self.terms.to_pylist(), range(len(self.terms)), strict=True))
        own = {t[:-1]: self.number.pop(t) for t in [t for t in self.number if t.endswith(MARK)]}
        # Prefixes that lead to a known one have -1: a word's are looked up from the shortest until one leads nowhere.
        self.nodes = dict.fromkeys((h for t in own for h in heads(t, self.prefixes)), -1) | own
        self.least = min(self.prefixes, default=0)
        self.begun = {h[: self.least] for h in self.nodes}  # of so many bytes, not characters
        self.under: list = [None] * len(self.terms)  # a known word's prefixes, once looked up

    def prefixed(self, word: bytes) -> list[int]:
        """Numbers of the word's known prefixes."""
        of = []
        for h in heads(word, self.prefixes):
            i = self.nodes.get(h)
            if i is None:
                break
            if i >= 0:
                of.append(i)
        return of

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers, rising, and how often each occurs."""
        counted = words(text)
        if not len(self.terms) or not counted:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        if self.number is None:
            self.learn()
        every: list[int] = []
        often: list[int] = []
        number, under, begun, least = self.number.get, self.under, self.begun, self.least
        for w, n in counted.items():
            i = number(w)
            if i is not None:
                every.append(i)
                often.append(n)
                of = under[i]
                if of is None:
                    of = under[i] = self.prefixed(w) or ()
            else:
                of = self.prefixed(w) if w[:least] in begun else ()
            if of:
                every += of
                often += [n] * len(of)
        at, inverse = np.unique(np.array(every, np.int32), return_inverse=True)
        return at, np.bincount(inverse, often, len(at)).astype(np.int64)


def pack(at: np.ndarray, tf: np.ndarray) -> bytes:
    """Features in few bytes: two for a number (after how many share the rest of it), and as many as the largest count needs."""
    if not len(at):
        return b""
    shared = np.bincount(at >> 16).astype("<u4")
    width = np.min_scalar_type(int(tf.max())).itemsize
    return struct.pack("<IB", len(shared), width) + shared.tobytes() + (at & 0xFFFF).astype("<u2").tobytes() + tf.astype(f"<u{width}").tobytes()


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not packed:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    m, width = struct.unpack_from("<IB", packed)
    shared = np.frombuffer(packed, "<u4", m, 5)
    n, done = int(shared.sum()), 5 + 4 * m
    at = np.repeat(np.arange(m, dtype=np.int32) << 16, shared) | np.frombuffer(packed, "<u2", n, done)
    return at, np.frombuffer(packed, f"<u{width}", n, done + 2 * n).astype(np.int64)


def _packed(vocabulary: Broadcast):
    """Packed features of each text, the columns before it unchanged."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [pack(*vocabulary.value.features(t.as_py())) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(packed, pa.binary())], [*b.schema.names[:-1], "packed"])

    return run


def _featured(vocabulary: Broadcast):
    """Packed features of each text (_key, _text); then how many texts of the task hold each term, in compressed chunks of the vocabulary."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        total = np.zeros(-(-len(known) // CHUNK) * CHUNK, np.int64)
        rows, kind = 0, None
        names = ["_key", "packed", "chunk", "counts"]
        for b in batches:
            rows, kind = rows + b.num_rows, b.column(0).type
            packed = []
            for t in b.column(1):
                at, tf = known.features(t.as_py())
                total[at] += 1
                packed.append(pack(at, tf))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary()), pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())], names)
        if rows:
            parts = total.reshape(-1, CHUNK)
            some = [-1, *np.flatnonzero(parts.any(1)).tolist()]  # chunk -1: rows and tasks
            counts = [zlib.compress((parts[c] if c >= 0 else np.array([rows, 1])).tobytes(), 1) for c in some]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), kind), pa.nulls(len(some), pa.binary()), pa.array(some, pa.int32()), pa.array(counts, pa.binary())], names)

    return run


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the chunks that meet in a task."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for c, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            n = np.frombuffer(zlib.decompress(packed), np.int64)
            total[c] = total[c] + n if c in total else n
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.int64()))], ["chunk", "n"])


class BlockMaxIndex:
    """Labelled examples in blocks, with each high term's largest weight in each block."""

    def __init__(self, examples: Iterable[tuple], weight: np.ndarray, high: int, k: int, block: int = 64, smooth: float = 0.5, dense: int = 96, wide: int = 512, loose: float = 0.2, patience: int = 60_000):
        """``examples``: (key, term numbers, occurrences, label); terms below ``high`` have block bounds, ``dense`` of them columns.

        Texts of more than ``loose`` in other terms, and those for which block bounds leave more than ``patience`` terms of entries
        to complete, take ``wide`` columns of all terms and the postings of all others.
        Numbers of many postings are made a part at a time: only what is kept, of few bytes a posting, is there as a whole.
        """
        self.weight, self.high, self.k, self.block, self.smooth, self.dense, self.wide, self.loose, self.patience = weight, high, k, block, smooth, dense, wide, loose, patience
        votes: dict[tuple, list] = {}
        bare, total, toxic = [0, 0], 0, 0
        for key, at, tf, label in examples:
            total, toxic = total + 1, toxic + label
            if not len(at):
                bare[label] += 1
                continue
            v = votes.setdefault((at.astype(">i4").tobytes(), tf.astype(">u4").tobytes()), [0, 0, []])
            v[label] += 1
            v[2].append(key)
        self.prior = toxic / total if total else 0.5
        self.bare = (bare[1] + self.smooth * self.prior) / (sum(bare) + self.smooth)
        # Numbers rise by falling gain, so that entries of the same telling terms lie together.
        entries = sorted(votes.items())
        self.pos, self.all = np.array([v[1] for _, v in entries], float), np.array([v[0] + v[1] for _, v in entries], float)
        self.evidence = [sorted(v[2])[:3] for _, v in entries]
        self.n = n = len(entries)
        self.n_blocks = (n + block - 1) // block
        self.first = np.append(0, np.cumsum([len(k[0]) // 4 for k, _ in entries], dtype=np.int64))
        self.at = np.frombuffer(b"".join(k[0] for k, _ in entries), ">i4").astype(np.int32)
        tf = np.frombuffer(b"".join(k[1] for k, _ in entries), ">u4")
        del votes, entries
        often = np.unique(tf)
        self.values = 1 + np.log(often)  # occurrences as numbers of their distinct values
        self.code = np.empty(len(tf), np.min_scalar_type(max(len(often) - 1, 0)))
        for i in range(0, len(tf), PART):
            self.code[i : i + PART] = np.searchsorted(often, tf[i : i + PART])
        del tf
        norm, rest = np.zeros(n), np.zeros(n)
        for e in range(0, n, CHUNK):
            part = slice(self.first[e], self.first[min(n, e + CHUNK)])
            size = np.diff(self.first[e : e + CHUNK + 1])
            of = np.repeat(np.arange(len(size)), size)
            squares = (self.values[self.code[part]] * weight[self.at[part]]) ** 2
            norm[e : e + CHUNK] = np.bincount(of, squares, len(size))
            rest[e : e + CHUNK] = np.bincount(of, np.where(self.at[part] < high, 0, squares), len(size))
        self.norm = np.sqrt(norm)
        self.rest = np.sqrt(rest) / np.where(self.norm > 0, self.norm, 1)
        self.start = None

    def turn(self) -> None:
        """Postings by term, columns of the terms that most entries hold, and block bounds: made where texts are scored."""
        n, width = self.n, self.n_blocks * self.block
        order = np.argsort(self.at, kind="stable")
        self.packed = np.empty(len(order), np.int64)
        self.post = self.packed.view(POST)  # each posting's entry and its part of the entry's unit vector; joined as whole numbers
        self.post["entry"] = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.first))[order]
        for i in range(0, len(order), PART):
            of = order[i : i + PART]
            self.post["share"][i : i + PART] = self.values.take(self.code[of]) * self.weight[self.at[of]] / self.norm[self.post["entry"][i : i + PART]]
        del order
        self.start = np.append(0, np.cumsum(np.bincount(self.at, minlength=len(self.weight))))
        self.short = (self.at & 0xFFFF).astype(np.uint16)
        size = np.diff(self.start)
        self.column, self.parts = self.columns(np.argsort(-size[: self.high], kind="stable")[: self.dense])
        self.wide_column, self.wide_parts = self.columns(np.argsort(-size, kind="stable")[: self.wide])
        self.bound = np.zeros((self.high, self.n_blocks), np.float32)
        for i in np.flatnonzero(self.column[: self.high] < 0).tolist():
            post = self.post[self.start[i] : self.start[i + 1]]
            np.maximum.at(self.bound[i], post["entry"] // self.block, post["share"])
        self.bound *= np.float32(1 + 1e-6)
        # starts[i, b] is where block b of high term i begins.
        width += self.block
        edges = np.arange(self.high)[:, None] * width + np.arange(self.n_blocks + 1) * self.block
        self.starts = np.searchsorted(np.repeat(np.arange(self.high) * width, size[: self.high]) + self.post["entry"][: self.start[self.high]], edges).astype(np.int32)
        self.far = np.zeros(self.parts.shape[1], np.float32)
        self.far[:n] = self.rest
        self.query, self.asked = np.zeros(len(self.weight)), np.zeros(1 << 16, bool)

    def columns(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each term's column, or -1, and the columns."""
        column = np.full(len(self.weight), -1, np.int32)
        column[terms] = np.arange(len(terms))
        parts = np.zeros((len(terms), self.n_blocks * self.block), np.float32)
        for c, i in enumerate(terms.tolist()):
            post = self.post[self.start[i] : self.start[i + 1]]
            parts[c, post["entry"]] = post["share"]
        return column, parts

    def cosines(self, ids: np.ndarray) -> np.ndarray:
        """Cosines of these entries with ``query``; ``asked`` is set at the last 16 bits of its terms."""
        begin, end = self.first[ids], self.first[ids + 1]
        hit = np.flatnonzero(self.asked.take(np.concatenate([self.short[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)])))
        n = np.cumsum(end - begin)
        of = np.searchsorted(n, hit, "right")
        hit += (end - n)[of]
        return np.bincount(of, self.values.take(self.code.take(hit)) * self.query.take(self.at.take(hit)), len(ids)) / self.norm[ids]

    def summed(self, terms: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Sums of all entries over these terms' whole posting lists, each times the text's part."""
        if not len(terms):
            return np.zeros(self.n)
        start, end = self.start[terms], self.start[terms + 1]
        post = np.concatenate([self.packed[b:e] for b, e in zip(start.tolist(), end.tolist(), strict=True)]).view(POST)
        return np.bincount(post["entry"], post["share"] * np.repeat(part, end - start), self.n)

    def listed(self, terms: np.ndarray, part: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The same within these blocks only, one block after the other."""
        if len(blocks) * 8 > self.n_blocks:  # most of each list: read whole
            cos = np.zeros(self.n_blocks * self.block)
            cos[: self.n] = self.summed(terms, part)
            return cos.reshape(-1, self.block)[blocks].ravel()
        lo, hi = self.starts[terms[:, None], blocks], self.starts[terms[:, None], blocks + 1]
        some = np.nonzero(hi > lo)
        lo, n = lo[some], (hi - lo)[some]
        post = self.packed.take(np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())).view(POST)
        return np.bincount(np.repeat(some[1] * self.block, n) + post["entry"] % self.block, post["share"] * np.repeat(part[some[0]], n), len(blocks) * self.block)

    def nearest(self, at: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the k nearest votes, with all that tie with the last of them."""
        return self.nearest_of([(at, tf)])[0]

    def nearest_of(self, texts: list[tuple]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same of several texts, whose columns are multiplied together."""
        if self.start is None:
            self.turn()
        texts = [(at, (1 + np.log(tf)) * self.weight[at]) for at, tf in texts]
        texts = [(at, w / math.sqrt(float(w @ w))) for at, w in texts]
        found: list = [None] * len(texts)
        tell = [i for i, (at, w) in enumerate(texts) if float(np.sum(w[np.searchsorted(at, self.high) :] ** 2)) <= self.loose**2]
        for i, some in zip(tell, self.multiplied([texts[i] for i in tell], self.column, self.parts), strict=True):
            found[i] = self._nearest(*some, False)
        hard = [i for i, f in enumerate(found) if f is None]
        for i, some in zip(hard, self.multiplied([texts[i] for i in hard], self.wide_column, self.wide_parts), strict=True):
            found[i] = self._nearest(*some, True)
        return found

    @staticmethod
    def multiplied(texts: list[tuple], column: np.ndarray, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Texts with each entry's part of their cosines over the columns."""
        for some in batched(texts, GROUP):
            asked = np.zeros((len(some), len(parts)), np.float32)
            for i, (at, w) in enumerate(some):
                c = column[at]
                asked[i, c[c >= 0]] = w[c >= 0]
            yield from ((at, w, part) for (at, w), part in zip(some, asked @ parts, strict=True))

    def _nearest(self, at: np.ndarray, w: np.ndarray, reach: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """``reach``: each entry's part over the (wide) columns.  None where the bounds leave too much to complete and columns aren't wide."""
        self.query[at], self.asked[at & 0xFFFF] = w * self.weight[at], True
        found = self._by_blocks(at, w.astype(np.float32), reach, wide)
        self.query[at], self.asked[at & 0xFFFF] = 0, False
        return found

    def _by_blocks(self, at: np.ndarray, w: np.ndarray, reach: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray] | None:
        if wide:
            listed = self.wide_column[at] < 0
            reach[: self.n] += self.summed(at[listed], w[listed])
            reach = reach.reshape(-1, self.block)
            bounds = reach.max(1)
        else:
            m = int(np.searchsorted(at, self.high))
            listed = np.flatnonzero(self.column[at[:m]] < 0)
            top, part = at[listed], w[listed]
            reach += np.sqrt(w[m:] @ w[m:]) * self.far
            reach = reach.reshape(-1, self.block)
            bounds = reach.max(1) + part @ self.bound[top]
        order = np.argsort(-bounds, kind="stable")
        ids, sims, floor = np.empty(0, np.int64), np.empty(0), 0.0
        done, some = 0, 16
        # Blocks by falling bound: some first, then all that can still reach the k-th nearest.
        while done < len(order) and bounds[order[done]] > 0 and bounds[order[done]] >= floor - SLACK:
            blocks = order[done : done + some]
            blocks = blocks[bounds[blocks] >= floor - SLACK]
            done, some = done + some, self.n_blocks
            most = reach[blocks].ravel()
            if not wide:
                most = most + self.listed(top, part, blocks)
            able = np.flatnonzero((most > 0) & (most >= floor - SLACK))
            # The k largest bounds first, then all entries that can still reach the k-th nearest.
            split = np.argpartition(-most[able], self.k) if len(able) > self.k else np.arange(len(able))
            for new in (able[split[: self.k]], able[split[self.k :]]):
                new = new[most[new] >= floor - SLACK]
                if not len(new):
                    continue
                of = blocks[new // self.block] * self.block + new % self.block
                if not wide and (self.first[of + 1] - self.first[of]).sum() > self.patience:
                    return None
                full = self.cosines(of)
                near = (full > 0) & (full >= floor - 1e-12)
                ids, sims = np.append(ids, of[near]), np.append(sims, full[near])
                rank = np.lexsort((ids, -sims))
                ids, sims = ids[rank], sims[rank]
                last = int(np.searchsorted(np.cumsum(self.all[ids]), self.k))
                if last < len(ids):
                    floor = sims[last]
                    keep = sims >= floor - 1e-12
                    ids, sims = ids[keep], sims[keep]
        return ids, sims

    def scores(self, texts: list[tuple]) -> list[tuple[float, list]]:
        """Score and evidence of each text (term numbers, occurrences)."""
        some = [t for t in texts if len(t[0])] if self.n else []
        found = iter(self.nearest_of(some) if some else [])
        return [self.score(*next(found)) if self.n and len(at) else (self.bare, []) for at, _ in texts]

    def score(self, ids: np.ndarray, sims: np.ndarray) -> tuple[float, list]:
        """By the nearest entries and their cosines."""
        if not len(ids):
            return self.prior, []
        w = (sims / sims[0]) ** 2  # by the nearest: what all share with the text only by common words still votes
        score = (w @ self.pos[ids] + self.smooth * self.prior) / (w @ self.all[ids] + self.smooth)
        return float(min(1.0, max(0.0, score))), self.evidence[ids[0]]


def _score(index: Broadcast):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for b in batches:
            packed = b.column(1).to_pylist()
            keys = [xxhash.xxh128_digest(p) for p in packed]
            if len(kept) >= _CACHE:
                kept.clear()
            new = {key: p for key, p in zip(keys, packed, strict=True) if key not in kept}
            for part in batched(new.items(), 4 * GROUP):
                kept.update(zip((key for key, _ in part), index.value.scores([unpack(p) for _, p in part]), strict=True))
            scores, evidence = zip(*(kept[key] for key in keys), strict=True) if keys else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(b.column(0).type))], ["_key", "score", "evidence"])

    return run


def gains(whole: np.ndarray, pos: np.ndarray, neg: np.ndarray, p: int, n: int, significance: float, ordinary: float, least: int) -> np.ndarray:
    """What a term counts for: the root of its chi-squared by ``significance``, much less where that is under one.

    A word (``whole``) counts for ``ordinary`` more, a prefix for nothing up to twice that; nor does a term of fewer than ``least`` examples
    count for more than ``ordinary``.
    """
    a, c = pos.astype(float), neg.astype(float)
    b, d = p - a, (n - p) - c
    below = (a + b) * (c + d) * (a + c) * (b + d)
    strength = np.where(below > 0, n * (a * d - b * c) ** 2 / np.where(below > 0, below, 1), 0) / significance
    told = np.where(a + c >= least, np.sqrt(strength) * np.minimum(1, strength**2), 0)
    return np.where(whole, ordinary + told, np.where(told > 2 * ordinary, told, 0))


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0


def score(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_examples: int = 20_000,
    significance: float = 24.0,
    ordinary: float = 0.02,
    prefixes: tuple[int, ...] = (4, 5, 6, 7),
    k: int = 15,
) -> DataFrame:
    """Per document: key, held_out, score, predicted, evidence (ids of nearest examples)."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)[key]
    lean = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    usable = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_y")).where("_key is not null and _y in (0, 1)").where(~held_out(F.col("_key")))
    chosen = F.broadcast(usable.groupBy("_key").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_key"), "_key").limit(max_examples))  # two numbers each
    # One text per id: the least, where several rows share it.
    examples = materialize(lean.join(chosen, "_key").groupBy("_key").agg(F.min("_text").alias("_text"), F.max("_y").alias("_y")), "examples")

    by_label = examples.select("_text", "_y").mapInArrow(_by_label(prefixes), "term binary, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    totals = examples.agg(F.coalesce(F.sum("_y"), F.lit(0)).alias("p"), F.count(F.lit(1)).alias("n")).first()
    gained = by_label.mapInArrow(_gained(int(totals["p"]), int(totals["n"]), significance, ordinary, 5), "term binary, gain double").toArrow()  # a word and a number a term
    vocabulary = Vocabulary(gained, prefixes)
    gain, vocabulary.gain = vocabulary.gain, None
    del gained
    sent = spark.sparkContext.broadcast(vocabulary)

    featured = materialize(lean.mapInArrow(_featured(sent), f"_key {kind}, packed binary, chunk int, counts binary"), "features")
    parts = featured.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(_added, "chunk int, n array<long>")
    df, n_docs = np.zeros(-(-len(vocabulary) // CHUNK) * CHUNK), 0
    tasks = 0
    parts = parts.toArrow()  # a number a term
    for chunk, n in zip(parts["chunk"].to_pylist(), parts["n"], strict=True):
        if chunk < 0:
            n_docs, tasks = n.as_py()
        else:
            df[chunk * CHUNK : (chunk + 1) * CHUNK] = n.values.to_numpy()
    weight = (np.log((1 + n_docs) / (1 + df[: len(vocabulary)])) + 1) * gain
    high = int((gain >= 10 * ordinary).sum())
    del parts, df, vocabulary, gain
    rows = examples.select("_key", "_y", "_text").mapInArrow(_packed(sent), f"_key {kind}, _y int, packed binary").toArrow()  # at most max_examples
    index = BlockMaxIndex(((key.as_py(), *unpack(p.as_py()), y.as_py()) for key, y, p in zip(*rows.columns, strict=True)), weight, high, k)
    del rows
    sent = spark.sparkContext.broadcast(index)
    del index
    # Scoring takes longer than reading: where the parts read are fewer than the cores, texts are dealt anew.
    texts = featured.where("chunk is null").select("_key", "packed")
    cores = spark.sparkContext.defaultParallelism
    dealt = texts.repartition(cores) if tasks < cores else texts
    scored = dealt.mapInArrow(_score(sent), f"_key {kind}, score double, evidence array<{kind}>")
    return scored.select(
        F.col("_key").alias(key),
        F.coalesce(held_out(F.col("_key")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )
