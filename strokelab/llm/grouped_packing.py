"""Best-fit packing by linear grouping.

Documents up to the capacity stay whole; longer ones are cut into full pieces behind a shorter first one.  Lengths are whole
numbers up to the capacity, so a histogram of at most ``capacity`` rows says all that the packing needs:

1. Large lengths, sorted, are dealt into groups of equal cardinality and rounded up to each group's largest.
2. Column generation over these few sizes gives configurations (what one sequence holds) and how often to use each.
3. Actual documents take the slots: place r of a group, longest first, so that bins of equal contents are one range of bins.
4. What is left of the large ones and all small ones go best-fit, longest first, into the room that is left, again in whole
   ranges of equal bins.

The plan is a list of ranges (length, first rank, count, bins), whose size depends on the capacity and the number of groups,
not on the documents.  Workers number the pieces of their own partition by length; sums over (partition, length) make these
ranks global, and a lookup in the plan places each piece.

Defined results: a null or empty text is the end id alone; repeated rows and equal keys are packed like any others; a very
long text is cut like any other; further columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strokelab.llm.common import materialize
from strokelab.llm.packing import Encoder, vocabulary_path


class Placed(NamedTuple):
    """Pieces of one length with ranks from ``rank`` on: ``each`` of them a bin, from ``bin`` on, the first at ``offset``."""

    length: int
    rank: int
    count: int
    each: int
    bin: int
    offset: int


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length): whole up to the capacity; else full pieces behind a first one with the rest."""
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


def linear_groups(lengths: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int, int]]]:
    """Lengths (length, count), longest first, dealt into groups of equal cardinality: runs (length, first rank, count) each."""
    total = sum(n for _, n in lengths)
    k = min(groups, total)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(k)]
    at = g = 0
    for length, n in lengths:
        rank = 0
        while rank < n:
            while at == (g + 1) * total // k:
                g += 1
            take = min(n - rank, (g + 1) * total // k - at)
            out[g].append((length, rank, take))
            rank, at = rank + take, at + take
    return [x for x in out if x]


def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The fullest of worth that a sequence can hold: value and how often each size lies in it (unbounded knapsack)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i in np.flatnonzero(worth > 1e-12):
        s = int(sizes[i])
        for _ in range(capacity // s):
            with_it = best[:-s] + worth[i]
            better = np.flatnonzero(with_it > best[s:] + 1e-12)
            if not len(better):
                break
            best[s + better], last[s + better] = with_it[better], i
    counts, room = np.zeros(len(sizes)), capacity
    while last[room] >= 0:
        counts[last[room]] += 1
        room -= int(sizes[last[room]])
    return float(counts @ worth), counts


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 20_000) -> list[tuple[list[int], int]]:
    """(copies of each size, how many bins) by column generation; whole bins only, so a few pieces a size may be left over."""
    size, need = np.array(sizes), np.array(counts, float)
    basis = np.diag((capacity // size).astype(float))
    used = need / np.diag(basis)
    for _ in range(rounds):
        value, column = best_configuration(size, np.linalg.solve(basis.T, np.ones(len(size))), capacity)
        if value <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, column)
        # A column that lowers the number of bins lowers some basic one, as the bins needed can't fall without end.
        ratios = np.full(len(size), np.inf)
        np.divide(used, change, out=ratios, where=change > 1e-9)
        out = int(np.argmin(ratios))
        used = np.maximum(used - ratios[out] * change, 0)
        used[out] = ratios[out]
        basis[:, out] = column
    left, result = list(counts), []
    for i in np.argsort(-used):
        pattern = [int(v) for v in basis[:, i]]
        n = min([int(used[i] + 1e-6), *[left[g] // c for g, c in enumerate(pattern) if c]])
        if n > 0:
            result.append((pattern, n))
            left = [x - n * c for x, c in zip(left, pattern, strict=True)]
    return result


def _take(runs: list[tuple[int, int, int]], n: int) -> list[tuple[int, int, int]]:
    """The first n pieces of a group's runs, which lose them."""
    out = []
    while n:
        length, rank, count = runs.pop(0)
        t = min(n, count)
        out.append((length, rank, t))
        if t < count:
            runs.insert(0, (length, rank + t, count - t))
        n -= t
    return out


class Room:
    """Ranges of bins by the room that they have left; best fit is the least room that is enough."""

    def __init__(self, capacity: int):
        self.capacity, self.ranges, self.rooms = capacity, {}, []

    def add(self, room: int, first: int, n: int) -> None:
        if n and room:
            if room not in self.ranges:
                insort(self.rooms, room)
                self.ranges[room] = []
            self.ranges[room].append((first, n))

    def take(self, length: int) -> tuple[int, int, int] | None:
        """(room, first bin, bins) of a range with the least room for the length; it leaves."""
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, n = self.ranges[room].pop()
        if not self.ranges[room]:
            del self.ranges[room]
            self.rooms.pop(at)
        return room, first, n


def plan(counts: dict[int, int], capacity: int, groups: int = 384, small: int | None = None) -> list[Placed]:
    """Where the pieces of each length go; ``small`` is the longest length that isn't grouped (a third of the capacity)."""
    small = capacity // 3 if small is None else small
    out, bins, room = [], 0, Room(capacity)
    if full := counts.get(capacity, 0):
        out.append(Placed(capacity, 0, full, 1, 0, 0))
        bins = full
    dealt = linear_groups([(s, counts[s]) for s in sorted(counts, reverse=True) if small < s < capacity], groups)
    by_size: dict[int, list[tuple[int, int, int]]] = {}
    for runs in dealt:
        by_size.setdefault(runs[0][0], []).extend(runs)
    sizes = list(by_size)
    for pattern, n in configurations(sizes, [sum(c for _, _, c in by_size[s]) for s in sizes], capacity) if sizes else []:
        slots = [_take(by_size[s], n) for s, copies in zip(sizes, pattern, strict=True) for _ in range(copies)]
        done = 0
        while done < n:
            same = min(s[0][2] for s in slots)
            offset = 0
            for s in slots:
                (length, rank, _), *_ = _take(s, same)
                out.append(Placed(length, rank, same, 1, bins + done, offset))
                offset += length
            room.add(capacity - offset, bins + done, same)
            done += same
        bins += n
    rest = sorted([r for runs in by_size.values() for r in runs] + [(s, 0, n) for s, n in counts.items() if s <= small], key=lambda r: (-r[0], r[1]))
    for length, rank, n in rest:
        while n:
            found = room.take(length)
            if found is None:
                need = -(-n // (capacity // length))
                found, bins = (capacity, bins, need), bins + need
            left, first, m = found
            each = left // length
            whole = min(m, n // each)
            if whole:
                out.append(Placed(length, rank, whole * each, each, first, capacity - left))
                room.add(left - each * length, first, whole)
                rank, n, first, m = rank + whole * each, n - whole * each, first + whole, m - whole
            if m and n:  # fewer than fill one bin
                out.append(Placed(length, rank, n, n, first, capacity - left))
                room.add(left - n * length, first, 1)
                first, m, n = first + 1, m - 1, 0
            room.add(left, first, m)
    return out


def _cut(path: str, ranks_path: str, end_id: int, capacity: int):
    names = ["_key", "piece", "start", "length", "ids_crc32", "_part", "_rank"]
    kinds = [pa.int32()] + [pa.int64()] * 5

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end, part = Encoder(path, ranks_path), array("I", [end_id]).tobytes(), TaskContext.get().partitionId()
        ranks = [0] * (capacity + 1)
        for b in batches:
            cols: list[list] = [[] for _ in kinds]
            at_row = []
            for row, t in enumerate(b.column(1)):
                ids = memoryview(encode(t.as_py() or "") + end)
                for i, (start, size) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    at_row.append(row)
                    for c, v in zip(cols, (i, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), part, ranks[size]), strict=True):
                        c.append(v)
                    ranks[size] += 1
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at_row, pa.int64()))] + [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return run


def _place(ranges: list[Placed], names: list[str]):
    ordered = sorted(ranges)
    table = np.array(ordered, np.int64).reshape(-1, 6)
    starts = (table[:, 0] << 48) | table[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "_at"))
            at = table[np.searchsorted(starts, (length.astype(np.int64) << 48) | rank, side="right") - 1]
            i = rank - at[:, 1]
            places = [pa.array(at[:, 4] + i // at[:, 3]), pa.array(at[:, 5] + i % at[:, 3] * length)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names[:-2]], *places], names)

    return run


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    groups: int = 384,
    path: str | None = None,
    ranks_path: str | None = None,
) -> DataFrame:
    """Per piece: key, piece (int), start, length, ids_crc32, sequence_id, offset (long)."""
    kind = dict(docs.dtypes)[key]
    # Written once: ranks within a partition stay as they are, whatever is computed again later.
    pieces = materialize(
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
            _cut(path or vocabulary_path("json"), ranks_path or vocabulary_path("tiktoken"), end_id, capacity),
            f"_key {kind}, piece int, start long, length long, ids_crc32 long, _part long, _rank long",
        ),
        "pieces",
    )
    filled = pieces.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = filled.select("length", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in filled.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    names = ["_key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    ranked = pieces.join(before, ["length", "_part"]).select(*names[:5], (F.col("_before") + F.col("_rank")).alias("_at"))
    out = ranked.mapInArrow(_place(plan(counts, capacity, groups), names), f"_key {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("_key", key)
