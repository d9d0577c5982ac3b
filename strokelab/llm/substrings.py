"""Removal of repeated word spans (windows of ``length`` words whose words also start anywhere else).

Token k-mers (windows of ``length`` words) are the edges of a de Bruijn graph over the corpus, ``length - 1`` words are its
nodes.  Tasks write neighbouring windows with one anchor (the smallest 8-word hash in them) as one path, so that equal
windows lie in paths of equal anchor.  A path whose anchor is always continued alike is one edge; at anchors that continue
in different ways every window of the distinct paths is an edge of its own.  Edges that occur twice or more make up the
graph of repeats: in and out degrees of its nodes are counted, edges that meet in a node with one way in and one way out
are joined, and chains of them are compacted into unitigs by pointer doubling.  A unitig's words are read from the sources
of its edges at their coordinates; every span of a document that the graph calls repeated is then compared with its
unitig word by word before it is removed.

Paths and edges are known by 128 bits, rows by a hash of their id and text: rows of one hash would only offer each other
spans whose words differ.  Defined results: null and blank texts have no words; documents shorter than a
window lose nothing; repeated rows and copies are repeats of each other; documents without an id are judged like others; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strokelab.llm.common import materialize, split_by_keys

SEGMENT = 150_000
EDGE = ["anchor", "region", "copies", "size", "i", "edge", "head", "tail", "at"]
U = np.uint64


def _odd(seed: int) -> np.uint64:
    return U(xxhash.xxh64_intdigest(b"span", seed) | 1)


BASE = int(_odd(1))
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * _odd(2)
    x = (x ^ (x >> U(29))) * _odd(3)
    return x ^ (x >> U(32))


class Spans:
    """Hashes of any span of a word list: prefix sums of word hashes times powers of an odd base, modulo 2 ** 64."""

    _powers: tuple[np.ndarray, np.ndarray] | None = None

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        if Spans._powers is None or len(Spans._powers[0]) < n + 1:
            m = max(n + 1, SEGMENT + 1000)
            ups, downs = np.full(m, U(BASE)), np.full(m, U(BASE_INVERSE))
            ups[0] = downs[0] = U(1)
            Spans._powers = np.cumprod(ups), np.cumprod(downs)
        ups, self.downs = Spans._powers
        self.sums = np.zeros(n + 1, U)
        np.cumsum(hashes * ups[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.downs[start]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), U, len(words))


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value (leftmost of equal ones) in every window of ``width`` values."""
    at = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        span += step
    return at


def regions(hashes: np.ndarray, bounds: np.ndarray, length: int, k: int):
    """Regions of several word lists laid end to end; bounds: the number of each word's list.

    Returns first word, number of windows, anchor and region hash of each region.
    """
    none = np.empty(0, np.int64)
    if len(hashes) < length:
        return none, none, none.view(U), none.view(U)
    spans = Spans(hashes)
    at = np.arange(len(hashes) - k + 1)
    grams = mix(spans(at, at + k))
    best = window_minimum(grams, length - k + 1)
    inside = bounds[: len(best)] == bounds[length - 1 :]
    first = inside.copy()
    first[1:] &= (best[1:] != best[:-1]) | ~inside[:-1]
    start = np.flatnonzero(first)
    if not len(start):
        return none, none, none.view(U), none.view(U)
    ends = np.flatnonzero(inside & np.append((best[1:] != best[:-1]) | ~inside[1:], True))
    count = ends - start + 1
    region = spans(start, ends + length)
    shape = count.astype(U) * _odd(4) + (best[start] - start).astype(U) * _odd(5)
    return start, count, grams[best[start]], mix(region + shape)


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(row, offset, words): long texts in segments that share length - 1 words, so that no window is lost."""
    for row, t in enumerate(batch.column(1)):
        words = (t.as_py() or "").encode().split()
        for at in range(0, max(0, len(words) - length + 1), SEGMENT):
            yield row, at, words[at : at + SEGMENT + length - 1]


def _groups(pieces: Iterator, most: int = SEGMENT) -> Iterator[list]:
    group, n = [], 0
    for p in pieces:
        group.append(p)
        n += len(p[2])
        if n >= most:
            yield group
            group, n = [], 0
    if group:
        yield group


def _emit_regions(length: int, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for group in _groups(_pieces(b, length)):
                sizes = [len(w) for _, _, w in group]
                bounds = np.repeat(np.arange(len(group)), sizes)
                start, count, anchor, region = regions(word_hashes([w for _, _, ws in group for w in ws]), bounds, length, k)
                which = bounds[start]
                shift = np.array([at for _, at, _ in group]) - np.concatenate(([0], np.cumsum(sizes)[:-1]))
                row = pa.array(np.array([r for r, _, _ in group])[which])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(region.view(np.int64)), b.column(0).take(row), pa.array(((start + shift[which]) << 8) | count)],
                    ["anchor", "region", "_row", "at"],
                )

    return run


def asked_of(lists: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each struct of a batch's lists (null: none), and the structs' fields as arrays: not object by object."""
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    return rows, {f.name: c.to_numpy(zero_copy_only=False) for f, c in zip(flat.type, flat.flatten(), strict=True)}


def _emit_edges(length: int):
    """Edges of the asked paths of each text (_row, text, asked): a path as a whole, or each of its windows where its anchor
    branches.

    ``i, size``: first window of the edge in its path, and number of windows; ``head, tail``: the nodes at its ends.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = asked_of(b.column(2))
            first = np.searchsorted(rows, np.arange(b.num_rows + 1))
            at, n = x["at"] >> 8, x["at"] & 255
            parts: list[np.ndarray] = [np.empty((3, 0), U)]
            took: list[np.ndarray] = [np.empty((3, 0), np.int64)]
            for row, text in enumerate(b.column(1)):
                if first[row] == first[row + 1]:
                    continue
                spans = Spans(word_hashes((text.as_py() or "").encode().split()))
                path = np.arange(first[row], first[row + 1])
                path = path[at[path] + n[path] + length - 1 < len(spans.sums)]  # others are asked of another row
                branch = x["branch"][path]
                edges = np.where(branch, n[path], 1)
                path, begin = np.repeat(path, edges), np.cumsum(edges) - edges
                i = np.arange(len(path)) - np.repeat(begin, edges)
                start = at[path] + i
                stop = start + np.where(x["branch"][path], 1, n[path]) + length - 1
                parts.append(np.stack([spans(start, stop), spans(start, start + length - 1), spans(stop - length + 1, stop)]))
                took.append(np.stack([path, i, start]))
            whole, head, tail = np.concatenate(parts, axis=1)
            path, i, start = np.concatenate(took, axis=1)
            branch = x["branch"][path]
            edge = np.where(branch, mix(whole * _odd(6)).view(np.int64), x["region"][path])
            of = [x["anchor"][path], x["region"][path], x["copies"][path], np.where(branch, 1, n[path]), i, edge, head.view(np.int64), tail.view(np.int64), start]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows[path])), *map(pa.array, of)], ["_row", *EDGE])

    return run


def _emit_runs(length: int):
    """Words of runs (start, windows) of each text (text, asked): those of the first node, and one more for each window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, asked in zip(b.column(0), b.column(1), strict=True):
                words = (text.as_py() or "").encode().split()
                spans = Spans(word_hashes(words))
                for x in asked.as_py():
                    node = x["at"] + length - 1
                    if node > len(words) or spans(np.array([x["at"]]), np.array([node])).view(np.int64)[0] != x["head"]:  # asked of another row
                        continue
                    rows.append((x["anchor"], x["edge"], b" ".join(words[x["at"] : node]).decode(), b" ".join(words[node : node + x["size"]]).decode()))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(list(map(pa.array, cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))), ["anchor", "edge", "first", "more"])

    return run


def covered(words: list[bytes], spans: list[dict]) -> np.ndarray:
    """True for each word that lies in one of the spans (start, size, text) and equals the span's text there."""
    edge = [0] * (len(words) + 1)
    for x in spans:
        start, stop = x["start"], x["start"] + x["size"]
        if b" ".join(words[start:stop]) == x["text"].encode():
            edge[start] += 1
            edge[stop] -= 1
    return np.cumsum(edge[:-1]) > 0


def _strip(keep_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, digest, texts = [], [], [], []
            rows, x = asked_of(b.column(2))
            first = np.searchsorted(rows, np.arange(b.num_rows + 1)).tolist()
            spans = [{"start": a, "size": n, "text": t} for a, n, t in zip(x["start"].tolist(), x["size"].tolist(), x["text"], strict=True)]
            for row, text in enumerate(b.column(1)):
                words = (text.as_py() or "").encode().split()
                own = spans[first[row] : first[row + 1]]
                gone = covered(words, own) if own else np.zeros(len(words), bool)
                kept = b" ".join(compress(words, (~gone).tolist()) if gone.any() else words)
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    texts.append(kept.decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())] + [pa.array(texts, pa.string())] * keep_text,
                ["_key", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text,
            )

    return run


def compacted(edges: DataFrame) -> DataFrame:
    """Runs ``run, _row, at, windows, head, unitig, offset`` of edges ``anchor, edge, size, head, tail, _row, at`` (one source each).

    Edges that follow each other in the text of their source, with a node of one way in and one way out between them, are
    one run.  Runs of different sources are linked over such nodes in the same way, and chained by pointer doubling: in each
    round a run takes over what its predecessor knows, so that 2 ** k runs are behind it after k rounds.  A circle has no
    first run: it is opened at its smallest one.
    """
    node = F.col("head").alias("node")
    into, out = edges.select(F.col("tail").alias("node"), F.lit(1).alias("into"), F.lit(0).alias("out")), edges.select(node, F.lit(0).alias("into"), F.lit(1).alias("out"))
    plain = materialize(into.union(out).groupBy("node").agg(F.sum("into").alias("into"), F.sum("out").alias("out")).where("into = 1 and out = 1").select("node"), "plain")
    text = Window.partitionBy("_row").orderBy("at")
    follows = (F.lag(F.col("at") + F.col("size")).over(text) == F.col("at")) & F.col("node").isNotNull()
    numbered = edges.join(plain, F.col("head") == F.col("node"), "left").withColumn("_new", F.when(follows, 0).otherwise(1))
    numbered = numbered.withColumn("_run", F.sum("_new").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("_row", "_run").agg(
        F.min_by(F.struct("anchor", "edge"), "at").alias("run"), F.min("at").alias("at"), F.sum("size").alias("windows"), F.min_by("head", "at").alias("head"), F.max_by("tail", "at").alias("tail")
    )
    runs = materialize(runs.drop("_run"), "runs")
    ends = runs.join(plain, F.col("tail") == F.col("node")).select("node", F.col("run").alias("prev"), F.col("windows").alias("gap"))
    state = runs.join(ends, F.col("head") == F.col("node"), "left").select("run", F.when(F.col("prev") != F.col("run"), F.col("prev")).alias("prev"), "gap")
    first = materialize(state, "links")

    def chained(links: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
        """(run, unitig, offset) of all runs behind a first one, and (run, least) of the runs in circles."""
        nothing = F.lit(None).cast(links.schema["run"].dataType)
        done = links.where("prev is null").select("run", F.col("run").alias("unitig"), F.lit(0).cast("long").alias("offset"))
        left = links.where("prev is not null").select("run", "prev", F.col("gap").alias("offset"), F.least("run", "prev").alias("least"))
        steps, most = 1, 2 * n
        while n and steps <= most:
            known = done.select("run", nothing.alias("prev"), "unitig", "offset", nothing.alias("least")).union(left.select("run", "prev", nothing.alias("unitig"), "offset", "least"))
            known = known.select(F.col("run").alias("prev"), F.col("prev").alias("prev2"), "unitig", F.col("offset").alias("offset2"), F.col("least").alias("least2"))
            moved = left.join(known, "prev").select("run", F.col("prev2").alias("prev"), "unitig", (F.col("offset") + F.col("offset2")).alias("offset"), F.least("least", "least2").alias("least"))
            moved = materialize(moved, "moved")
            done = done.union(moved.where("prev is null").select("run", "unitig", "offset"))
            left = moved.where("prev is not null").drop("unitig")
            n, steps = left.count(), 2 * steps
        return done, left.select("run", "least")

    n = first.where("prev is not null").count()
    done, circles = chained(first, n)
    if n and not circles.isEmpty():
        is_first = F.col("run") == F.col("least")
        opened = circles.join(first, "run").select("run", F.when(~is_first, F.col("prev")).alias("prev"), "gap")
        done = done.union(chained(materialize(opened, "opened"), n)[0])
    return materialize(runs.join(done, "run").select("run", "_row", "at", "windows", "head", "unitig", "offset"), "unitigs")


def repeated_spans(docs: DataFrame, length: int = 35, k: int = 8) -> tuple[DataFrame, DataFrame]:
    """Spans ``_row, start, size, unitig, offset`` (in words) of texts ``_row, _text``, and the words of each ``unitig``."""
    rows = materialize(docs.select("_row", "_text").mapInArrow(_emit_regions(length, k), "anchor long, region long, _row long, at long"), "paths")
    distinct = materialize(rows.groupBy("anchor", "region").agg(F.count(F.lit(1)).alias("copies")), "distinct")
    branches = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1")
    marked = distinct.join(branches, "anchor", "left").where("copies > 1 or ways > 1").select("anchor", "region", "copies", F.col("ways").isNotNull().alias("branch"))
    marked = materialize(marked, "marked")
    some, _ = split_by_keys(rows, marked, ["anchor", "region"])  # paths that occur once, at an anchor of their own, end here
    found = materialize(some.join(marked, ["anchor", "region"]), "found")

    # One source of each path; its edges are read from the text there.
    asked = (
        found.groupBy("anchor", "region")
        .agg(F.min(F.struct("_row", "at")).alias("one"), F.first("copies").alias("copies"), F.first("branch").alias("branch"))
        .groupBy(F.col("one._row").alias("_row"))
        .agg(F.collect_list(F.struct("anchor", "region", F.col("one.at").alias("at"), "copies", "branch")).alias("asked"))
    )
    asked = materialize(asked, "asked")
    texts, _ = split_by_keys(docs, asked, ["_row"])  # texts that aren't asked for stay where they are
    sources = texts.join(asked, "_row").select("_row", "_text", "asked")
    members = materialize(sources.mapInArrow(_emit_edges(length), "_row long, " + ", ".join(f"{c} long" for c in EDGE)), "members")
    # A row that occurs twice emits its edges twice, and they do occur twice.
    edges = members.groupBy("anchor", "edge").agg(F.sum("copies").alias("n"), F.min(F.struct("_row", "at", "size", "head", "tail")).alias("s")).where("n > 1")
    edges = materialize(edges.select("anchor", "edge", "s.*"), "edges")
    runs = compacted(edges)

    # Words of the unitigs, at the coordinates of their runs.
    wanted = runs.groupBy("_row").agg(F.collect_list(F.struct("run.anchor", "run.edge", "at", "head", F.col("windows").alias("size"))).alias("asked"))
    wanted = materialize(wanted, "wanted")
    texts, _ = split_by_keys(docs, wanted, ["_row"])
    read = texts.join(wanted, "_row").select("_text", "asked").mapInArrow(_emit_runs(length), "anchor long, edge long, first string, more string")
    words = read.select(F.struct("anchor", "edge").alias("run"), "first", "more").dropDuplicates(["run"])
    parts = runs.join(words, "run").groupBy("unitig").agg(F.sort_array(F.collect_list(F.struct("offset", "first", "more"))).alias("p"))
    unitigs = parts.select("unitig", F.concat_ws(" ", F.col("p")[0]["first"], F.array_join(F.transform("p", lambda x: x["more"]), " ")).alias("words"))
    unitigs = materialize(unitigs, "words")

    # Where each path lies on the unitigs, and so where each document's paths do.
    runs_at = runs.select("_row", F.col("at").alias("_from"), (F.col("at") + F.col("windows")).alias("_to"), "unitig", (F.col("offset") - F.col("at")).alias("_shift"))
    placed = edges.join(runs_at, (edges["_row"] == runs_at["_row"]) & (edges["at"] >= F.col("_from")) & (edges["at"] < F.col("_to")))
    placed = placed.select("anchor", "edge", "unitig", (edges["at"] + F.col("_shift")).alias("offset"))
    repeated, _ = split_by_keys(members.select("anchor", "region", "i", "size", "edge"), edges, ["anchor", "edge"])
    lies = (
        repeated.join(placed, ["anchor", "edge"])
        .groupBy("anchor", "region", "unitig", (F.col("offset") - F.col("i")).alias("_shift"))
        .agg(F.min("i").alias("i"), F.max(F.col("i") + F.col("size")).alias("_to"))
    )
    pieces = found.join(lies, ["anchor", "region"]).select(
        "_row", (F.shiftright("at", 8) + F.col("i")).alias("start"), (F.col("_to") - F.col("i")).alias("windows"), "unitig", (F.col("_shift") + F.col("i")).alias("offset")
    )
    order = Window.partitionBy("_row").orderBy("start", "offset")
    before = lambda c: F.lag(c).over(order)
    at = F.col("offset") - F.col("start")
    goes_on = (before(F.col("start") + F.col("windows")) == F.col("start")) & (before("unitig") == F.col("unitig")) & (before(at) == at)
    pieces = pieces.repartition("_row").dropDuplicates().withColumn("_new", F.when(goes_on, 0).otherwise(1))
    pieces = pieces.withColumn("_span", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = pieces.groupBy("_row", "_span").agg(F.min("start").alias("start"), (F.sum("windows") + length - 1).alias("size"), F.first("unitig").alias("unitig"), F.min("offset").alias("offset"))
    return materialize(spans.drop("_span"), "spans"), unitigs


def strip_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 35, k: int = 8, keep_text: bool = False
) -> DataFrame:
    """Per document: key, n_words, n_removed, kept_sha256 and, if asked for, the kept text."""
    kind = dict(docs.dtypes)[key]
    lean = docs.select(F.col(key).alias("_key"), F.xxhash64(F.col(key), F.col(text)).alias("_row"), F.col(text).alias("_text"))
    spans, unitigs = repeated_spans(lean, length, k)
    some, rest = split_by_keys(lean, spans.select("_row").distinct(), ["_row"])
    # Each span gets its own words only, and goes where its text is.
    words = F.array_join(F.slice(F.split("words", " "), F.col("offset").cast("int") + 1, F.col("size").cast("int")), " ")
    told = spans.join(unitigs, "unitig").select("_row", F.struct("start", "size", words.alias("text")).alias("span")).groupBy("_row").agg(F.collect_list("span").alias("spans"))
    joined = some.join(told, "_row", "left").select("_key", "_text", "spans")
    joined = joined.union(rest.select("_key", "_text", F.lit(None).cast(joined.schema["spans"].dataType)))
    schema = f"_key {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return joined.mapInArrow(_strip(keep_text), schema).withColumnRenamed("_key", key)
