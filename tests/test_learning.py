"""Learning jobs on data whose answer is known."""

import pytest
from pyspark.sql import functions as F

from strokelab.operators import ml


@pytest.fixture(scope="module")
def data(spark):
    """Scores that the stroke statistics explain up to some noise; tiers that two scores explain."""
    u = lambda salt: F.pmod(F.xxhash64("sample_id", F.lit(salt)), F.lit(10_000)) / 10_000.0
    df = spark.range(600).select(F.col("id").alias("sample_id")).select("sample_id", *[(100 * u(c)).alias(c) for c in dict.fromkeys((*ml.FEATURES, *ml.SCORE_FEATURES))])
    df = df.withColumn("overall_score", 100 - F.col("timing_error_std") * 0.6 + F.col("velocity_mean") * 0.3 + 5 * u("noise"))
    mark = F.col("timing_accuracy") + F.col("hand_balance")
    return df.withColumn("skill_tier", F.when(mark < 70, "beginner").when(mark < 130, "intermediate").otherwise("advanced"))


def r2(data):
    return {n: ml.regression_metrics(p).first()["r2"] for n, p in ml.regress(data, list(ml.SCORE_FEATURES), "overall_score", "sample_id", trees=20).items()}


def test_scores_are_learned_from_the_strokes(data):
    assert not set(ml.SCORE_FEATURES) & set(ml.FEATURES) and "overall_score" not in ml.SCORE_FEATURES
    assert min(r2(data).values()) > 0.7


def test_shuffled_targets_are_not(spark, data):
    order = lambda salt: F.xxhash64("sample_id", F.lit(salt))
    rows = data.orderBy(order("a")).collect()
    scores = [r["overall_score"] for r in data.orderBy(order("b")).collect()]
    shuffled = spark.createDataFrame([{**r.asDict(), "overall_score": s} for r, s in zip(rows, scores, strict=True)], data.schema)
    assert max(r2(shuffled).values()) < 0.1


def test_importance_of_both_tasks(data):
    tier = ml.importances(data, list(ml.TIER_FEATURES), "skill_tier", trees=20)
    score = ml.importances(data, list(ml.SCORE_FEATURES), "overall_score", trees=20, regression=True)
    assert {n for n, _ in tier[:2]} == {"timing_accuracy", "hand_balance"} and "tempo_bpm" in dict(tier)
    assert [n for n, _ in score[:2]] == ["timing_error_std", "velocity_mean"]
    assert sum(v for _, v in score) == pytest.approx(1) and ml.meaningful(tier, ml.SENSIBLE) and not ml.meaningful(score, ml.SENSIBLE)


def test_utility_report(data):
    rows = ml.utility(data, data, trees=8, folds=2, sizes=(0.2, 0.6, 1.0))
    at = {(p, n): v for p, n, v in rows}
    assert at["summary", "best accuracy"] > 0.7 and at["summary", "best r2"] > 0.7 and rows[-1][:2] == ("verdict", "PASSED")
    assert {p for p, _ in at} == {f"{t} {x}" for t in ("tier", "score") for x in ("curve", "learnability", "importance")} | {"tier logistic", "tier forest", "score ridge", "score forest", "summary", "verdict"}
    assert at["summary", "all sensible"] == 0.0 and at["tier importance", "sensible"] == 1.0


def test_few_partitions_for_few_rows(data):
    assert ml._parted(data.repartition(9)).rdd.getNumPartitions() == 1
