"""Registered queries of the corpus operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strokelab.llm import decontaminate, divergence, fill_middle, grouped_packing, host_quality, html_text, licenses, packing, secrets, simhash, substrings, toxicity, url_graph
from strokelab.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_quality.judge(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "source", F.round("host_rate", 6).alias("host_rate")
    )


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_graph.judge_urls(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("trust", 6).alias("trust"), F.round("distrust", 6).alias("distrust"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.strip_repeats(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(table(spark, sf_dir, "documents"))


def op13_grouped_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_packing.pack(table(spark, sf_dir, "documents"))


def queries() -> dict:
    ops = (
        op1_simhash,
        op2_html,
        op3_packing,
        op4_quality,
        op5_urls,
        op6_secrets,
        op7_decontaminate,
        op8_substrings,
        op9_licenses,
        op10_toxicity,
        op11_divergence,
        op12_fill_middle,
        op13_grouped_packing,
    )
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


_WORDS = r"""d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents)"""

_QUALITY = (
    "WITH "
    + _WORDS
    + r""",
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 7], ' ')) AS k FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM win WHERE k > 1) GROUP BY r),
m AS (SELECT d.r, doc_id, source, len(w) AS n_words, length(regexp_replace(t, '[ 	-
]+', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')))) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
h AS (SELECT source AS host, count(*) AS n, count(*) FILTER (base_failed) AS f FROM b GROUP BY 1),
p AS (SELECT sum(n)::DOUBLE AS n, sum(f) / sum(n) AS mean, sum(n * (f / n) ** 2) AS q, sum(n::DOUBLE * n) AS nn, count(*) AS k FROM h),
q AS (SELECT n, mean, (q - n * mean * mean - (k - 1) * mean * (1 - mean)) / nullif((n - nn / n - (k - 1)) * mean * (1 - mean), 0) AS alike FROM p),
w AS (SELECT mean, CASE WHEN alike > 0 THEN least(n, greatest(2.0::DOUBLE, 1 / alike - 1)) ELSE n END AS weight, 4 * mean / (1 - mean + 4 * mean) AS most FROM q),
u AS (SELECT host, n, weight, most, (f + mean * weight) / (n + weight) AS host_rate FROM h, w),
v AS (SELECT host, host_rate, host_rate - 1.645 * sqrt(host_rate * (1 - host_rate) / (n + weight + 1)) > most AS rejected FROM u)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  base_failed, NOT base_failed AND NOT coalesce(rejected, false) AS kept, source, round(host_rate, 6) AS host_rate FROM b LEFT JOIN v ON b.source IS NOT DISTINCT FROM v.host"""
)

_SUBSTRINGS = (
    "WITH "
    + _WORDS
    + r""",
win AS (SELECT r, i, count(*) OVER (PARTITION BY array_to_string(w[i:i + 34], ' ')) AS k FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM win WHERE k > 1)),
word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""
)


_DIVERGENCE = r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM c GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT g.lang, count(DISTINCT k.term) AS v FROM g LEFT JOIN k ON g.lang = k.lang GROUP BY g.lang),
n AS (SELECT lang, source, term, count(*) AS n FROM c SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
f AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n FROM g JOIN k ON g.lang = k.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
t AS (SELECT lang, term, sum(n) AS n FROM f GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM t JOIN v USING (lang)),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM f JOIN v USING (lang)),
a AS (SELECT g.lang, g.source, o.source AS item, coalesce(x.value, 0)::BIGINT AS value FROM g JOIN g AS o ON g.lang = o.lang AND g.source <> o.source LEFT JOIN
  (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) AS x ON x.lang = g.lang AND x.source = g.source AND x.item = o.source),
b AS (SELECT p.lang, p.source, p.term AS item, (p.p - q.q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM a
UNION ALL SELECT lang, source, 'term', item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM b QUALIFY rank <= 50"""

_FILL_MIDDLE = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
k AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM k),
s AS (SELECT *, array_to_string(u[1:i], '') AS p, array_to_string(u[i + 1:j], '') AS m, array_to_string(u[j + 1:], '') AS s FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM s)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars, sha256(o) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN o WHEN 'psm' THEN substr(o, 4, strpos(o, '<S>') - 4) || substr(o, strpos(o, '<M>') + 3) || substr(o, strpos(o, '<S>') + 3, strpos(o, '<M>') - strpos(o, '<S>') - 3)
    ELSE substr(o, strpos(o, '<P>') + 3, strpos(o, '<M>') - strpos(o, '<P>') - 3) || substr(o, strpos(o, '<M>') + 3) || substr(o, 4, strpos(o, '<P>') - 4) END) AS restored_sha256 FROM o"""


def oracle_sql() -> dict[str, str]:
    """SQL twins where SQL can express an operator; the others are tested against brute force (tests/llm)."""
    return {"op4_quality": _QUALITY, "op8_substrings": _SUBSTRINGS, "op11_divergence": _DIVERGENCE, "op12_fill_middle": _FILL_MIDDLE}
