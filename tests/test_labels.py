"""Formula tests with hand-computed values."""

import pytest
from pyspark.sql import functions as F

from strokelab.operators import labels

EVENT = "sample_id string, position int, index int, hand string, stroke_type string, is_grace_note boolean, intended_time_ms double, actual_time_ms double, intended_velocity int, actual_velocity int, diddle_position int, parent_stroke_index int"


def events(spark, errors, hands="RL", kind="tap", velocity=80):
    rows = [("s", i, i, hands[i % len(hands)], kind, False, i * 100.0, i * 100.0 + e, 80, velocity, None, None) for i, e in enumerate(errors)]
    return spark.createDataFrame(rows, EVENT)


def samples(spark, category="roll", tier="advanced", ids=("s",)):
    return spark.createDataFrame([(i, category, tier) for i in ids], "sample_id string, category string, skill_tier string")


def score(spark, errors, category="roll", **kw):
    s = labels.stroke_labels(events(spark, errors, **kw))
    return labels.exercise_scores(s, samples(spark, category)).first()


@pytest.mark.parametrize(("error", "want"), [(0.0, 92.4), (25.0, 50.0), (50.0, 7.6), (-25.0, 50.0)])
def test_accuracy(spark, error, want):
    assert score(spark, [error] * 8)["timing_accuracy"] == pytest.approx(want, abs=0.1)


def test_weights_sum_to_one():
    assert sum(labels.WEIGHTS.values()) == pytest.approx(1.0)


def test_single_hand_and_no_accents(spark):
    r = score(spark, [0.0] * 8, hands="R")
    assert (r["hand_balance"], r["weak_hand_index"], r["accent_accuracy"], r["accent_differentiation"]) == (100.0, 50.0, 100.0, 80.0)


def test_empty_sample_is_neutral(spark):
    s = labels.stroke_labels(events(spark, [0.0] * 4))
    r = labels.exercise_scores(s, samples(spark, ids=("s", "none"))).where("sample_id = 'none'").first()
    assert (r["timing_accuracy"], r["overall_score"], r["weak_hand_index"], r["flam_quality"]) == (0.0, 0.0, 50.0, None)


def test_short_roll_and_one_stroke(spark):
    assert score(spark, [0.0] * 3)["roll_sustain"] == 80.0
    r = score(spark, [0.0])
    assert (r["tempo_stability"], r["subdivision_evenness"]) == (100.0, 100.0)


def test_last_quarter_is_ceiled(spark):
    rows = [("s", i, i, "R", "tap", False, i * 100.0, i * 100.0, 80, v, None, None) for i, v in enumerate([10, 20, 0, 0, 0, 0, 0, 3, 4, 5])]
    s = labels.stroke_labels(spark.createDataFrame(rows, EVENT))
    assert labels.exercise_scores(s, samples(spark)).first()["roll_sustain"] == pytest.approx(4 / 15 * 100)


def test_grace_spacing_and_bounces(spark):
    rows = [
        ("s", 0, 0, "L", "grace", True, 70.0, 60.0, 40, 40, None, 1),
        ("s", 1, 1, "R", "buzz", False, 100.0, 100.0, 70, 70, None, None),
        ("s", 2, 5, "R", "buzz", True, 125.0, 125.0, 70, 60, None, 1),
        ("s", 3, 2, "L", "grace", True, 200.0, 200.0, 40, 40, None, None),
    ]
    s = {r["position"]: r for r in labels.stroke_labels(spark.createDataFrame(rows, EVENT)).collect()}
    assert (s[0]["flam_spacing_ms"], s[0]["timing_error_ms"]) == (40.0, 10.0)
    assert (s[2]["flam_spacing_ms"], s[2]["timing_error_ms"]) == (-25.0, -55.0)
    assert (s[1]["buzz_count"], s[2]["buzz_count"]) == (3, None)
    assert (s[3]["flam_spacing_ms"], s[3]["timing_error_ms"]) == (None, 0.0)


def test_measures_of_a_ragged_tail(spark):
    m = labels.measure_labels(labels.stroke_labels(events(spark, [1.0] * 9)), F.lit(8)).orderBy("index").collect()
    assert [(r["stroke_start"], r["stroke_end"], r["lr_velocity_ratio"]) for r in m] == [(0, 8, 1.0), (8, 9, None)]


def test_constant_errors_are_consistent(spark):
    r = labels.groove_report(labels.stroke_labels(events(spark, [0.0] * 8))).first()
    assert r["pattern_consistency"] == 1.0 and r["groove_feel_proxy"] == 1.0
    few = labels.groove_report(labels.stroke_labels(events(spark, [0.0] * 3))).first()
    assert (few["groove_feel_proxy"], few["pattern_consistency"], few["swing_ratio"]) == (0.5, 0.5, None)


def test_rounding_is_that_of_the_twins(spark):
    """Values at and beside ties, which Spark's own rounding takes by their decimal text."""
    import duckdb

    from strokelab.plans.q_labels import rounded

    values = [m / 1e6 / 36.0 for m in range(18, 400_000, 36)] + [-16.5848575, 59214.4158345, 0.5, -0.5, float("nan"), None]
    plain = lambda x: None if x is None else repr(x + 0.0)
    con = duckdb.connect()
    want = [plain(con.execute("SELECT round(?::DOUBLE, 6)", [v]).fetchone()[0]) for v in values]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    assert [plain(r["x"]) for r in rounded(df).orderBy("i").collect()] == want
    own = [plain(r["x"]) for r in df.select("i", F.round("x", 6).alias("x")).orderBy("i").collect()]
    assert own != want
