"""The pipeline against a brute-force version on a small table, stage by stage."""

import brute
import corpus_pipeline as cp
from pyspark.sql import functions as F
from test_llm import DOCS, encoder, text_of
from test_similar import kept

from strokelab.llm import decontaminate
from strokelab.llm.common import table


def test_stages(spark, small):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = table(spark, small, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    bench = [decontaminate.normal(r["text"]) for r in table(spark, small, "benchmark").collect()]

    def step(i, d):
        out = cp.STAGES[i][1](spark, d, small)
        assert out.columns == docs.columns
        return spark.createDataFrame(out.collect(), docs.schema)

    one = step(0, docs)
    want = {d for d, t in rows.items() if not brute.quality(t)["base_failed"]}
    assert {r["doc_id"] for r in one.collect()} == want

    two = step(1, one)
    want = kept([(d, rows[d]) for d in want])
    assert {r["doc_id"] for r in two.collect()} == want

    three = step(2, two)
    want = {d for d in want if not any(b in decontaminate.normal(rows[d]) for b in bench)}
    assert {r["doc_id"] for r in three.collect()} == want

    four = step(3, three)
    texts = {r["doc_id"]: r["text"] for r in four.collect()}
    assert set(texts) == want
    for d, t in texts.items():
        spans = brute.secrets_base(rows[d])
        assert all(rows[d][s:e] not in t for _, s, e in spans) and (spans or t == rows[d])

    pieces = cp.STAGES[4][1](spark, four, small).collect()
    brute.check_packing(list(texts.items()), [r.asDict() for r in pieces], encoder())


def test_run(spark, small):
    assert cp.run(spark, small).where("offset + length > 1024").count() == 0


def test_rows_without_ids_and_repeats(spark, small):
    rows = [(None, text_of(1, 80), "en", None, 1), (1, text_of(2, 80), None, "a", None), (1, text_of(2, 80), None, "a", None), (2, text_of(2, 80), "en", "a", 1), (3, None, "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit(1))
    for _, stage in cp.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, small).collect(), docs.schema)
    assert sorted((r["doc_id"] or 0) for r in docs.collect()) == [0, 1]


def test_empty_table(spark, small):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert cp.STAGES[-1][1](spark, docs, small).count() == 0
