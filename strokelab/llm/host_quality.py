"""Host-level quality rules, DataFrame functions only.

Every document is measured once (words, symbols, repeated lines, repeated 8-word windows).  Rule failures are
then summed per host, each host's failure rate is shrunk towards the corpus by a beta prior fitted to all hosts by
moments, and the host's verdict (its posterior rate is surely a multiple of the corpus rate, in odds) is joined back to its
documents.

Defined results: a null text has no words and fails the base rule; a null host is a host of its own; equal rows are
judged alike and all returned; an empty table gives an empty result; other columns of the input are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.llm.common import SPACE_CLASS, SPACES, let, materialize, words_column

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of 8 words found twice or more in the list, the first copy included."""

    def covered(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(order: Column) -> Column:
            same = F.filter(
                order,
                lambda x, i: (x["h"].eqNullSafe(F.get(order, i - 1)["h"])) | (x["h"].eqNullSafe(F.get(order, i + 1)["h"])),
            )
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(x - F.get(at, i - 1), F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

        return let(let(ranked, starts), total)

    def counted(ws: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, F.lit(WINDOW)))
        )
        return F.when(F.size(ws) <= WINDOW, F.lit(0).cast("long")).otherwise(
            let(
                windows,
                lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(hs)),
            )
        )

    return let(words, counted)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long) and base_failed."""
    body = F.coalesce(F.col(text), F.lit(""))

    def facts(ws: Column) -> Column:
        return F.struct(F.size(ws).cast("long").alias("n_words"), repeated_words(ws).alias("n_repeat_words"))

    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    measured = (
        docs.withColumn("_facts", let(words_column(F.col(text)), facts))
        .withColumn("n_words", F.col("_facts.n_words"))
        .withColumn("word_chars", F.length(F.translate(body, SPACES, "")).cast("long"))
        .withColumn("n_symbols", (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .withColumn("n_repeat_words", F.col("_facts.n_repeat_words"))
        .drop("_facts")
    )
    return measured.withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    )


def host_verdicts(stats: DataFrame, host: str, failed: str, odds: float, certainty: float) -> DataFrame:
    """One row per host: n_docs, n_failed, host_rate (shrunk) and host_rejected.

    The prior is Beta(a, b) with mean m, the pooled rate, fitted by moments: what host rates vary beyond the noise of
    binomial draws gives their correlation r, and a + b = 1 / r - 1 (no variation beyond noise: as many as all documents;
    2 at least).  A host is rejected where its posterior rate, less ``certainty`` deviations of the posterior, has more than
    ``odds`` times the odds of the corpus.
    """
    hosts = stats.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    n, square = F.col("n_docs").cast("double"), F.col("n_docs").cast("double") * F.col("n_docs")
    moments = hosts.agg(F.sum(n).alias("n"), F.sum("n_failed").alias("f"), F.sum(n * rate * rate).alias("q"), F.sum(square).alias("nn"), F.count(F.lit(1)).alias("k"))
    mean = F.try_divide("f", "n")
    one = mean * (1 - mean)
    between = F.col("q") - F.col("n") * mean * mean
    alike = F.try_divide(between - (F.col("k") - 1) * one, (F.col("n") - F.try_divide("nn", "n") - (F.col("k") - 1)) * one)
    weight = F.when(alike > 0, F.least(F.col("n"), F.greatest(F.lit(2.0), 1 / alike - 1))).otherwise(F.col("n"))
    limit = odds * mean / (1 - mean + odds * mean)
    prior = moments.select(mean.alias("_mean"), weight.alias("_weight"), limit.alias("_limit"))
    whole = F.col("n_docs") + F.col("_weight")
    spread = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (whole + 1))
    return (
        hosts.crossJoin(F.broadcast(prior))  # the prior is one row
        .withColumn("host_rate", (F.col("n_failed") + F.col("_mean") * F.col("_weight")) / whole)
        .withColumn("host_rejected", F.col("host_rate") - certainty * spread > F.col("_limit"))
        .drop("_mean", "_weight", "_limit")
    )


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", odds: float = 4.0, certainty: float = 1.645
) -> DataFrame:
    """Per document: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host, host_rate."""
    lean = docs.select(F.col(key).alias("_key"), F.col(host).alias("_src"), F.col(text).alias("_text"))
    # Measured once: the host totals and the join back both read the small written table, not the texts.
    stats = materialize(measure(lean, "_text").drop("_text"), "quality")
    verdicts = host_verdicts(stats, "_src", "base_failed", odds, certainty)
    joined = stats.join(verdicts, stats["_src"].eqNullSafe(verdicts["_host"]), "left")
    return joined.select(
        F.col("_key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False))).alias("kept"),
        F.col("_src").alias(host),
        "host_rate",
    )


def base_failure(text: Column) -> Column:
    """The base rule alone: fewer than 20 words, or over 30 % of them in repeated windows."""
    return let(words_column(text), lambda ws: (F.size(ws) < 20) | (100 * repeated_words(ws) > 30 * F.size(ws)))


def kept_rows(docs: DataFrame, text: str = "text", host: str = "source", odds: float = 4.0, certainty: float = 1.645) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that neither the base rule nor their host's verdict rejects.

    Texts are measured once: rows are written with their verdict (rejected ones without their text), and hosts are counted
    from the two small columns.
    """
    flag = "_failed"
    while flag in docs.columns:
        flag += "_"
    judged = docs.withColumn(flag, base_failure(F.col(text)))
    judged = materialize(judged.withColumn(text, F.when(~F.col(flag), F.col(text))), "judged")
    verdicts = host_verdicts(judged.select(F.col(host).alias("_src"), F.col(flag).alias("_bad")), "_src", "_bad", odds, certainty)
    rejected = materialize(verdicts.where("host_rejected").select("_host"), "hosts")
    return judged.where(~F.col(flag)).join(rejected, judged[host].eqNullSafe(rejected["_host"]), "left_anti").select(docs.columns)
