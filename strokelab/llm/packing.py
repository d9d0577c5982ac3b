"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

A document's ids are cut into pieces whose lengths are reciprocals of the capacity: size ``capacity // k`` for class
k, for those k whose bins of exactly k such pieces waste at most ``max_waste`` ids.  A class is filled without looking
at any other: piece number i of class k lies in bin i // k.  Workers number the pieces of their own partition; the
offsets between partitions come from one small sum per (partition, class).  Only the pieces after a class's last full
bin (fewer than one bin of each class, whatever the input) are mixed with those of other classes.

Defined results: a null or empty text is the end id alone; repeated rows are packed like any others; a very long text
is cut like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strokelab.llm.common import materialize

def vocabulary_path(kind: str) -> str:
    """A file of the public byte-level BPE vocabulary: ``json`` (tokenizers) or ``tiktoken`` (the same as ranks)."""
    import public_tokenizers

    return public_tokenizers.path(f"byte_bpe_50k.{kind}")


def class_sizes(capacity: int, max_waste: int) -> list[int]:
    """Piece sizes, descending: capacity // k for every k whose k pieces leave at most max_waste ids of a bin empty."""
    return sorted({capacity // k for k in range(1, capacity + 1) if capacity - k * (capacity // k) <= max_waste} | {1}, reverse=True)


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    The ids are those of the vocabulary's tokenizers file.  The same vocabulary as ranks gives equal ids several times
    as fast; texts that hold the name of a special token go through the tokenizers file itself.
    """

    def __init__(self, path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if any(t in text for t in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return self.ranks.encode_to_numpy(text).astype("<u4").tobytes()


def pieces_of(n: int, sizes: list[int]) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the largest class size that fits, again and again."""
    out, at, ascending = [], 0, sizes[::-1]
    while at < n:
        size = ascending[bisect_right(ascending, n - at) - 1]
        for _ in range((n - at) // size if size == sizes[0] else 1):
            out.append((at, size))
            at += size
    return out


def _cut(path: str, ranks_path: str, end_id: int, sizes: list[int]):
    names = ["_key", "start", "length", "ids_crc32", "doc_tokens", "_part", "_rank"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end, part = Encoder(path, ranks_path), array("I", [end_id]).tobytes(), TaskContext.get().partitionId()
        ranks = dict.fromkeys(sizes, 0)
        for b in batches:
            cols: list[list] = [[] for _ in names]
            at_row = []
            for row, t in enumerate(b.column(1)):
                ids = encode(t.as_py() or "") + end
                n = len(ids) // 4
                view = memoryview(ids)
                for start, size in pieces_of(n, sizes):
                    at_row.append(row)
                    for c, v in zip(cols[1:], (start, size, zlib.crc32(view[4 * start : 4 * (start + size)]), n, part, ranks[size]), strict=True):
                        c.append(v)
                    ranks[size] += 1
            arrays = [b.column(0).take(pa.array(at_row, pa.int64()))] + [pa.array(c, pa.int64()) for c in cols[1:]]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    max_waste: int = 4,
    path: str | None = None,
    ranks_path: str | None = None,
) -> DataFrame:
    """Per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (all long but the key)."""
    sizes = class_sizes(capacity, max_waste)
    kind = dict(docs.dtypes)[key]
    schema = f"_key {kind}, start long, length long, ids_crc32 long, doc_tokens long, _part long, _rank long"
    # Written once: ranks within a partition stay as they are, whatever is computed again later.
    pieces = materialize(
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(_cut(path or vocabulary_path("json"), ranks_path or vocabulary_path("tiktoken"), end_id, sizes), schema),
        "pieces",
    )
    filled = pieces.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = filled.select(
        "length",
        "_part",
        F.coalesce(
            F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    placed = pieces.join(before, ["length", "_part"]).withColumn("_at", F.col("_before") + F.col("_rank"))
    # At most one row per class.
    totals = {r["length"]: r["n"] for r in filled.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ends = docs.sparkSession.createDataFrame(last_bins(totals, sizes, capacity), "length long, _at long, _last long, _place long")
    per_bin = (F.lit(capacity) / F.col("length")).cast("long")
    # A class's full bins get every len(sizes)-th number, so the classes never meet; mixed bins come after all of them.
    number = F.create_map(*[F.lit(x) for i, s in enumerate(sizes) for x in (s, i)])[F.col("length").cast("int")]
    full = F.floor(F.col("_at") / per_bin)
    return placed.join(F.broadcast(ends), ["length", "_at"], "left").select(
        F.col("_key").alias(key),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.coalesce("_last", full * len(sizes) + number).cast("long").alias("sequence_id"),
        F.coalesce("_place", (F.col("_at") - full * per_bin) * F.col("length")).cast("long").alias("offset"),
    )


def last_bins(totals: dict[int, int], sizes: list[int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, number, sequence, offset) of the pieces that fill no bin of their class: fewer than one bin per class.

    They are mixed, longest first, each into the first bin with room; their number depends on the capacity alone.
    """
    first = max((n // (capacity // s) for s, n in totals.items()), default=0) + 1
    room: list[int] = []
    out = []
    for s in sizes:
        n, k = totals.get(s, 0), capacity // s
        for at in range(n - n % k, n):
            b = next((i for i, r in enumerate(room) if r >= s), len(room))
            if b == len(room):
                room.append(capacity)
            out.append((s, at, (first + b) * len(sizes), capacity - room[b]))
            room[b] -= s
    return out
