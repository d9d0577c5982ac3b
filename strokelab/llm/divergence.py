"""Source divergence audit on run-length columns.

Each source of a language gives every kept term a smoothed share of its words.  The vocabulary is put into an order that
brings terms of equal counts together, cut into blocks, and each source's counts in a block become runs (start, share).  Two
sources are compared by meeting the ends of their runs: the difference of shares times the length of each common stretch.
Terms that a source lacks form long runs, so a comparison costs the terms that the two hold, not the vocabulary.

Sources are dealt into tiles; one task compares two tiles in one block of the vocabulary, so neither a large vocabulary nor
many sources meet in one place.  Counts are summed per batch, per task and then per key.

Defined results: null text, language and source are empty strings; a text without terms still makes its group occur; a
language without kept terms gives pairs of value 0; repeated rows count each time; ties rank by the item's bytes; further
columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strokelab.llm.common import materialize

#: Bytes of terms as they are (A-Z lower-cased), all others as blanks.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CHUNK = 1 << 20


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, about a megabyte at a time."""
    at = 0
    while at < len(text):
        end = at + _CHUNK
        while end < len(text) and _TABLE[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_TABLE).split()
        at = end


def _counts(max_terms: int):
    names = ["lang", "source", "term", "n", "docs"]

    def emit(found: dict) -> pa.RecordBatch:
        rows = [(lang, source, term, n, docs[term]) for (lang, source), (total, docs) in found.items() for term, n in [*total.items(), (b"", 0)]]
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            for lang, source, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                total, docs = found.setdefault((lang, source), (Counter(), Counter()))
                seen = set()
                for words in _word_lists(t.as_py()):
                    total.update(words)
                    seen.update(words)
                docs.update(seen)
            if sum(len(total) for total, _ in found.values()) > max_terms:
                yield emit(found)
                found = {}
        if found:
            yield emit(found)

    return run


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", max_terms: int = 200_000) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; an empty term of no occurrences for every group.

    A task holds at most about ``max_terms`` counts besides those of one batch before it passes them on.
    """
    text_of = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(text_of(lang).alias("lang"), text_of(source).alias("source"), text_of(text).cast("binary").alias("text"))
    found = rows.mapInArrow(_counts(max_terms), "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(counts: DataFrame, min_docs: int = 30) -> DataFrame:
    """Counts of the terms that enough documents of a language hold, with the language's own (total); ``lead`` marks one row a term."""
    term = Window.partitionBy("lang", "term")
    marked = counts.select("lang", "source", "term", "n", F.sum("docs").over(term).alias("docs"), F.sum("n").over(term).alias("total"), (F.col("source") == F.min("source").over(term)).alias("lead"))
    return marked.where((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs")


def share(n: Column, words: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (words + 5 terms)), exact for any count."""
    wide = lambda c: c.cast("decimal(19,0)")
    top, bottom = (wide(n) + 5) * F.lit(1_000_000_000).cast("decimal(10,0)"), wide(words) + wide(terms) * 5
    return F.call_function("div", top, bottom) + 1


def ordered_vocabulary(kept: DataFrame, block_terms: int, columns: int) -> DataFrame:
    """(lang, term, block, at): terms of equal counts beside each other.

    The order is that of the counts in the ``columns`` groups of fewest distinct counts, then of the total; terms of the same
    counts in all groups share a mark and so always lie together.
    """
    terms = kept.where("term <> ''")
    narrow = terms.groupBy("lang", "source").agg(F.count_distinct("n").alias("kinds"))
    slots = narrow.withColumn("slot", F.row_number().over(Window.partitionBy("lang").orderBy("kinds", "source"))).where(F.col("slot") <= columns).drop("kinds")
    counts = [F.coalesce(F.sum(F.when(F.col("slot") == i, F.col("n"))), F.lit(0)).alias(f"c{i}") for i in range(1, columns + 1)]
    keyed = terms.join(slots, ["lang", "source"], "left").groupBy("lang", "term").agg(*counts, F.first("total").alias("total"), F.expr("bit_xor(xxhash64(source, n))").alias("mark"))
    order = ["lang", *[f"c{i}" for i in range(1, columns + 1)], "total", "mark", "term"]
    numbered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("lang", "term", F.monotonically_increasing_id().alias("_id"))
    # Written once: the numbers must not change when a task runs again.
    return materialize(numbered.select("lang", "term", F.floor(F.col("_id") / block_terms).alias("block"), (F.col("_id") % block_terms).cast("int").alias("at")), "vocabulary")


def _encode(rows: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Run-length columns: counts of a group in a block become starts and shares."""
    for part in rows:
        starts, shares = [], []
        for size, low, words, terms, at, n in zip(part["size"], part["low"], part["words"], part["terms"], part["ats"], part["ns"], strict=True):
            column = np.zeros(size, np.int64)
            if at is not None:
                column[np.asarray(at) - low] = n
            first = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])) if size else np.zeros(0, np.int64)
            starts.append(first)
            # Python numbers: exact for any count.
            shares.append([1 + 1_000_000_000 * (int(c) + 5) // (int(words) + 5 * int(terms)) for c in column[first]])
        yield pd.DataFrame({"lang": part["lang"], "block": part["block"], "source": part["source"], "size": part["size"], "tile": part["tile"], "tiles": part["tiles"], "starts": starts, "shares": shares})


def runs(kept: DataFrame, vocabulary: DataFrame, groups: DataFrame, tile_sources: int) -> DataFrame:
    """(lang, block, source, size, tile, tiles, starts, shares): every group in every block of its language, and in an empty one."""
    placed = kept.where("term <> ''").join(vocabulary, ["lang", "term"])
    columns = placed.groupBy("lang", "block", "source").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("c")).select("lang", "block", "source", F.col("c.at").alias("ats"), F.col("c.n").alias("ns"))
    blocks = vocabulary.groupBy("lang", "block").agg(F.count(F.lit(1)).cast("int").alias("size"), F.min("at").alias("low"))
    empty = groups.select("lang").distinct().select("lang", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("size"), F.lit(0).alias("low"))
    tiled = groups.withColumn("tiles", F.ceil(F.col("sources") / tile_sources).cast("int")).withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    whole = tiled.join(blocks.unionByName(empty), "lang").join(columns, ["lang", "block", "source"], "left")
    schema = "lang string, block long, source string, size int, tile int, tiles int, starts array<int>, shares array<long>"
    return whole.select("lang", "block", "source", "size", "low", "tile", "tiles", "words", "terms", "ats", "ns").mapInPandas(_encode, schema)


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int) -> int:
    """Sum of |p - q| over a block from the runs (starts, shares) of two groups."""
    if not size:
        return 0
    ends = np.union1d(a[0], b[0])
    p, q = (x[1][np.searchsorted(x[0], ends, side="right") - 1] for x in (a, b))
    return int((np.abs(p - q) * np.diff(ends, append=size)).sum())


def _compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Pairs of the sources of two tiles in one block, both ways."""
    lang, _, one, two = key
    part = part.sort_values("source")
    columns = [(s, t, (np.asarray(a, np.int64), np.asarray(p, np.int64))) for s, t, a, p in zip(part["source"], part["tile"], part["starts"], part["shares"], strict=True)]
    size, out = int(part["size"].iloc[0]), []
    for i, (s, t, a) in enumerate(columns):
        for other, u, b in columns[i + 1 :]:
            if one == two or t != u:
                value = difference(a, b, size)
                out += [(lang, s, other, value), (lang, other, s, value)]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"]).astype({"value": "int64"})


def pairs(encoded: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all pairs of sources of a language, both ways."""
    tiles = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least("tile", t).alias("one"), F.greatest("tile", t).alias("two")))
    dealt = encoded.select("lang", "block", "source", "size", "tile", "starts", "shares", F.explode(tiles).alias("t")).select("lang", "block", "source", "size", "tile", "starts", "shares", "t.one", "t.two")
    met = dealt.groupBy("lang", "block", "one", "two").applyInPandas(_compare, "lang string, source string, item string, value long")
    return met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = 30,
    top: int = 50,
    block_terms: int = 4096,
    columns: int = 8,
    tile_sources: int = 64,
) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for each other source, ``term`` rows for the ``top`` terms above the language's share."""
    kept = materialize(kept_counts(term_counts(docs, text, lang, source), min_docs), "counts")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_words"), F.sum(F.when(F.col("lead") & (F.col("term") != ""), 1).otherwise(0)).alias("terms"))
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    # One row a group: their number is that of the sources.
    groups = materialize(by_group.join(langs, "lang").join(by_group.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")), "lang"), "groups")
    vocabulary = ordered_vocabulary(kept, block_terms, columns)
    pair = pairs(runs(kept, vocabulary, groups, tile_sources))
    p, q = share(F.col("n"), F.col("words"), F.col("terms")), share(F.col("total"), F.col("lang_words"), F.col("terms"))
    term = kept.where("n > 0").join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank")).unionByName(
        term.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )
    return ranked.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
