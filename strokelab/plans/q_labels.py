"""Queries of the label computation (O-A*), with SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strokelab.operators import labels
from strokelab.plans import fixtures as fx
from strokelab.schemas import OPTIONAL_SCORES, SCORES


def sql_round(x: Column, places: int = 6) -> Column:
    """Rounded as the SQL twins do it: the scaled double to a whole number.  Spark rounds the shortest decimal text instead, so that
    a value that lies just beside a tie goes another way."""
    return F.round(x * 10.0**places) / 10.0**places


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[(sql_round(F.col(c), places) + 0.0).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns])


def strokes(spark: SparkSession, d: str) -> DataFrame:
    return labels.stroke_labels(fx.events(spark, d))


def stroke_labels(spark: SparkSession, d: str) -> DataFrame:
    return rounded(strokes(spark, d).drop("event_id").withColumn("velocity_error", F.col("velocity_error").cast("int")))


def measure_labels(spark: SparkSession, d: str) -> DataFrame:
    return rounded(labels.measure_labels(strokes(spark, d), F.lit(8)))


def scores(spark: SparkSession, d: str) -> DataFrame:
    return labels.exercise_scores(strokes(spark, d), fx.samples(spark, d))


def exercise_scores(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scores(spark, d))


def scores_by_tier(spark: SparkSession, d: str) -> DataFrame:
    out = scores(spark, d).groupBy("skill_tier").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in ("timing_accuracy", "hand_balance", "overall_score")])
    return rounded(out, 5)


def groove_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(labels.groove_report(strokes(spark, d)))


def sample_rollup(spark: SparkSession, d: str) -> DataFrame:
    some = strokes(spark, d).where("sample_id % 17 <> 0")
    return rounded(labels.sample_rollup(some, fx.samples(spark, d), F.lit(8)))


def empty_scores(spark: SparkSession, d: str) -> DataFrame:
    """Samples without events get neutral scores (O-A16)."""
    some = strokes(spark, d).where("sample_id % 17 <> 0")
    out = labels.exercise_scores(some, fx.samples(spark, d)).where("sample_id % 17 = 0")
    return rounded(out.select("sample_id", "timing_accuracy", "weak_hand_index", "overall_score", "groove_feel_proxy", "flam_quality"))


def tier_confidence(spark: SparkSession, d: str) -> DataFrame:
    o = fx.scored_orders(spark, d)
    tier = F.when(F.col("sample_id") % 11 == 0, "unknown").otherwise(F.col("skill_tier"))
    return rounded(o.select("sample_id", labels.tier_confidence(F.col("score"), tier).alias("tier_confidence"), labels.tier_binary(F.col("skill_tier")).alias("tier_binary")))


#: Scores on top of STROKES_SQL and SAMPLES_SQL, as CTE ``ex``.
SCORES_SQL = (
    "WITH "
    + fx.STROKES_SQL.strip()
    + ","
    + fx.SAMPLES_SQL
    + """,
w AS (SELECT *, count(*) OVER p AS n_, avg(actual_velocity) OVER p AS mean_v, avg(raw_timing_error_ms) OVER p AS mean_raw_,
  lag(raw_timing_error_ms, 1) OVER o AS l1, lag(raw_timing_error_ms, 2) OVER o AS l2, lag(raw_timing_error_ms, 3) OVER o AS l3, lag(raw_timing_error_ms, 4) OVER o AS l4,
  actual_time_ms - lag(actual_time_ms) OVER o AS ioi, intended_time_ms - lag(intended_time_ms) OVER o AS grid,
  lead(actual_time_ms) OVER o - actual_time_ms AS nxt, lead(intended_time_ms) OVER o - intended_time_ms AS nxt_grid,
  lead(stroke_type) OVER o AS nt, lead(diddle_position) OVER o AS np
  FROM st WINDOW p AS (PARTITION BY sample_id), o AS (PARTITION BY sample_id ORDER BY position)),
w2 AS (SELECT *, CASE WHEN nxt_grid > 0 THEN nxt / nxt_grid END AS pair,
  CASE WHEN flam_spacing_ms BETWEEN 20 AND 40 THEN 100 WHEN flam_spacing_ms < 20 THEN greatest(0, 100 - (20 - flam_spacing_ms) * 5)
    WHEN flam_spacing_ms > 40 THEN greatest(0, 100 - (flam_spacing_ms - 40) * 3) END AS fq FROM w),
f AS (SELECT sample_id, count(*) AS n, avg(abs(timing_error_ms)) AS mean_abs, stddev_pop(timing_error_ms) AS sd_error,
  count(*) FILTER (NOT is_grace_note) AS n_straight, regr_slope(timing_error_ms, intended_time_ms) FILTER (NOT is_grace_note) * 1000 AS slope,
  stddev_pop(ioi / greatest(grid, 1)) AS sd_ratio, stddev_pop(actual_velocity) AS sd_v, avg(actual_velocity) FILTER (is_accent) AS accent_v,
  avg(actual_velocity) FILTER (stroke_type IN ('tap','buzz')) AS tap_v, avg(CASE WHEN actual_velocity > mean_v THEN 1.0 ELSE 0.0 END) FILTER (is_accent) AS accent_hit,
  avg(actual_velocity) FILTER (hand = 'L') AS left_v, avg(actual_velocity) FILTER (hand = 'R') AS right_v,
  avg(abs(timing_error_ms)) FILTER (hand = 'L') AS left_t, avg(abs(timing_error_ms)) FILTER (hand = 'R') AS right_t, avg(fq) AS flam,
  avg(abs(pair - 1)) FILTER (stroke_type = 'diddle' AND diddle_position = 1 AND nt = 'diddle' AND np = 2) AS double_dev,
  avg(actual_velocity) FILTER (position < floor(n_ / 4.0)) AS first_v, avg(actual_velocity) FILTER (position >= n_ - ceil(n_ / 4.0)) AS last_v,
  avg(abs(raw_timing_error_ms)) AS mean_abs_raw, avg(raw_timing_error_ms) AS mean_raw, max(abs(raw_timing_error_ms)) AS max_abs_raw, stddev_pop(raw_timing_error_ms) AS sd_raw,
  sum((raw_timing_error_ms - mean_raw_) * (l1 - mean_raw_)) AS a1, sum((raw_timing_error_ms - mean_raw_) * (l2 - mean_raw_)) AS a2,
  sum((raw_timing_error_ms - mean_raw_) * (l3 - mean_raw_)) AS a3, sum((raw_timing_error_ms - mean_raw_) * (l4 - mean_raw_)) AS a4,
  count(*) FILTER (position % 2 = 0 AND pair > 0.3 AND pair < 1.7) AS n_swing, avg(pair) FILTER (position % 2 = 0 AND pair > 0.3 AND pair < 1.7) AS mean_swing,
  stddev_pop(pair) FILTER (position % 2 = 0 AND pair > 0.3 AND pair < 1.7) AS sd_swing, avg(raw_timing_error_ms) FILTER (stroke_type = 'accent') AS accent_raw
  FROM w2 GROUP BY sample_id),
g0 AS (SELECT *, CASE WHEN n < 6 THEN 0.5 WHEN sd_raw = 0 THEN 1.0
    ELSE (abs(a1 / (n - 1)) + abs(a2 / (n - 2)) + abs(a3 / (n - 3)) + abs(a4 / (n - 4))) / 4 / (sd_raw * sd_raw) END AS pattern_consistency,
  CASE WHEN n >= 4 AND n_swing >= 2 AND sd_swing < 0.15 THEN mean_swing END AS swing_ratio, coalesce(accent_raw, 0) AS accent_timing_bias FROM f),
g AS (SELECT *, CASE WHEN n < 4 THEN 0.5 ELSE least(1.0, greatest(0, 1 - mean_abs_raw / 50) + pattern_consistency * 0.3
  + CASE WHEN swing_ratio > 0.55 AND swing_ratio < 0.75 THEN 0.1 ELSE 0 END) END AS groove_feel_proxy FROM g0),
x AS (SELECT *, 100 / (1 + exp((mean_abs - 25) / 10)) AS timing_accuracy, 100 / (1 + exp((sd_error - 15) / 8)) AS timing_consistency,
  CASE WHEN n_straight > 1 THEN greatest(0, 100 - abs(coalesce(slope, 0)) * 10) ELSE 100 END AS tempo_stability,
  CASE WHEN n > 1 THEN greatest(0, 100 - sd_ratio * 100) ELSE 100 END AS subdivision_evenness, greatest(0, 100 - sd_v * 2) AS velocity_control,
  CASE WHEN accent_v IS NULL OR tap_v IS NULL THEN 80 ELSE least(100, greatest(0, (accent_v - tap_v) / 127 * 20 * 8)) END AS accent_differentiation,
  coalesce(accent_hit * 100, 100) AS accent_accuracy,
  CASE WHEN left_v IS NULL OR right_v IS NULL THEN 100 ELSE 0.5 * 100 * least(left_v, right_v) / greatest(left_v, right_v)
    + 0.5 * (0.4 * 100 * least(left_t, right_t) / greatest(left_t, right_t, 1) + 0.6 * 100 / (1 + exp(((left_t + right_t) / 2 - 25) / 10))) END AS hand_balance,
  CASE WHEN left_v IS NULL OR right_v IS NULL OR left_t + right_t = 0 THEN 50 ELSE left_t / (left_t + right_t) * 100 END AS weak_hand_index FROM g),
ex AS (SELECT sm.sample_id, sm.skill_tier, timing_accuracy, timing_consistency, tempo_stability, subdivision_evenness, velocity_control, accent_differentiation, accent_accuracy,
  hand_balance, weak_hand_index, CASE WHEN category = 'flam' THEN coalesce(flam, 80) END AS flam_quality,
  CASE WHEN category IN ('diddle','roll') THEN coalesce(greatest(0, 100 - double_dev * 200), 80) END AS diddle_quality,
  CASE WHEN category = 'roll' THEN CASE WHEN x.n < 4 OR first_v = 0 THEN 80 ELSE least(100, last_v / first_v * 100) END END AS roll_sustain, groove_feel_proxy,
  0.2 * timing_accuracy + 0.15 * timing_consistency + 0.1 * tempo_stability + 0.1 * subdivision_evenness + 0.1 * velocity_control + 0.1 * accent_differentiation
  + 0.1 * accent_accuracy + 0.15 * hand_balance AS overall_score
  FROM sm JOIN x USING (sample_id))"""
)

CONFIDENCE = """CASE {t} WHEN 'beginner' THEN exp(-0.5 * (({s} - 34.3) / 6.6) ** 2) WHEN 'intermediate' THEN exp(-0.5 * (({s} - 45.7) / 10.1) ** 2)
  WHEN 'advanced' THEN exp(-0.5 * (({s} - 61.0) / 10.8) ** 2) WHEN 'professional' THEN exp(-0.5 * (({s} - 73.5) / 10.7) ** 2) ELSE 0.5 END"""
_EX = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in (*SCORES, *OPTIONAL_SCORES, "groove_feel_proxy"))


def queries() -> dict:
    return {
        "scores_by_tier": scores_by_tier,
        "a01_stroke_labels": stroke_labels,
        "a02_measure_labels": measure_labels,
        "a03_a17_exercise_scores": exercise_scores,
        "a16_empty_scores": empty_scores,
        "a18_a22_groove_report": groove_report,
        "a23_sample_rollup": sample_rollup,
        "p05_p06_tier_confidence": tier_confidence,
    }


def oracle_sql() -> dict[str, str]:
    with_strokes = "WITH " + fx.STROKES_SQL.strip()
    r = lambda c: f"round({c}, 6) AS {c}"
    return {
        "scores_by_tier": SCORES_SQL + " SELECT skill_tier, count(*) AS n, round(avg(timing_accuracy), 5) AS timing_accuracy, round(avg(hand_balance), 5) AS hand_balance, round(avg(overall_score), 5) AS overall_score FROM ex GROUP BY 1",
        "a01_stroke_labels": with_strokes
        + ' SELECT sample_id, position, "index", hand, stroke_type, is_grace_note, intended_velocity, actual_velocity, diddle_position, parent_stroke_index, velocity_error, is_accent, buzz_count, '
        + ", ".join(map(r, ("intended_time_ms", "actual_time_ms", "raw_timing_error_ms", "flam_spacing_ms", "timing_error_ms")))
        + " FROM st",
        "a02_measure_labels": with_strokes
        + """, m AS (SELECT sample_id, CAST(floor(position / 8.0) AS INTEGER) AS "index", min(position) AS stroke_start, max(position) + 1 AS stroke_end, avg(timing_error_ms) AS timing_mean_error_ms,
  stddev_pop(timing_error_ms) AS timing_std_ms, max(abs(timing_error_ms)) AS timing_max_error_ms, avg(actual_velocity) AS velocity_mean, stddev_pop(actual_velocity) AS velocity_std,
  avg(actual_velocity) FILTER (hand = 'L') AS lv, avg(actual_velocity) FILTER (hand = 'R') AS rv, avg(timing_error_ms) FILTER (hand = 'L') AS lt, avg(timing_error_ms) FILTER (hand = 'R') AS rt
  FROM st GROUP BY ALL) SELECT sample_id, "index", stroke_start, stroke_end, """
        + ", ".join(map(r, ("timing_mean_error_ms", "timing_std_ms", "timing_max_error_ms", "velocity_mean", "velocity_std")))
        + ", round(1 - velocity_std / velocity_mean, 6) AS velocity_consistency, round(lv / rv, 6) AS lr_velocity_ratio, round(lt - rt, 6) AS lr_timing_diff_ms FROM m",
        "a03_a17_exercise_scores": SCORES_SQL + f" SELECT sample_id, skill_tier, {_EX}, round({CONFIDENCE.format(t='skill_tier', s='overall_score')}, 6) AS tier_confidence FROM ex",
        "a16_empty_scores": "WITH " + fx.SAMPLES_SQL.strip() + " SELECT sample_id, 0.0::DOUBLE AS timing_accuracy, 50.0::DOUBLE AS weak_hand_index, 0.0::DOUBLE AS overall_score, 0.0::DOUBLE AS groove_feel_proxy, NULL::DOUBLE AS flam_quality FROM sm WHERE sample_id % 17 = 0",
        "a18_a22_groove_report": SCORES_SQL
        + """ SELECT sample_id, round(groove_feel_proxy, 6) AS groove_feel_proxy, round(pattern_consistency, 6) AS pattern_consistency, round(swing_ratio, 6) AS swing_ratio,
  round(accent_timing_bias, 6) AS accent_timing_bias, round(mean_raw, 6) AS mean_error_ms, round(sd_raw, 6) AS std_error_ms, round(max_abs_raw, 6) AS max_error_ms,
  concat_ws('; ', CASE WHEN groove_feel_proxy > 0.8 THEN 'Excellent groove or timing accuracy' WHEN groove_feel_proxy > 0.6 THEN 'Good groove feel'
    WHEN groove_feel_proxy > 0.4 THEN 'Moderate groove, some inconsistency' ELSE 'Inconsistent timing, lacking groove' END,
    CASE WHEN pattern_consistency > 0.5 THEN 'Systematic timing patterns detected' WHEN pattern_consistency < 0.2 THEN 'Random/erratic timing deviations' END,
    CASE WHEN swing_ratio > 0.6 THEN format('Swing feel detected (ratio: {:.2f})', swing_ratio) WHEN swing_ratio IS NOT NULL THEN 'Straight timing' END,
    CASE WHEN accent_timing_bias > 5 THEN 'Accents tend to be ahead the beat' WHEN accent_timing_bias < -5 THEN 'Accents tend to be behind the beat' END) AS interpretation FROM g""",
        "a23_sample_rollup": with_strokes
        + ","
        + fx.SAMPLES_SQL
        + """ SELECT sample_id, round(coalesce(max(actual_time_ms) / 1000 + 0.5, 0), 6) AS duration_sec, count(st.position) AS stroke_count, CAST(ceil(count(st.position) / 8.0) AS BIGINT) AS measure_count
  FROM sm LEFT JOIN (SELECT * FROM st WHERE sample_id % 17 <> 0) st USING (sample_id) GROUP BY sample_id""",
        "p05_p06_tier_confidence": "WITH "
        + fx.ORDERS_SQL.strip()
        + f" SELECT sample_id, round({CONFIDENCE.format(t='t', s='score')}, 6) AS tier_confidence, CASE WHEN skill_tier IN ('beginner','intermediate') THEN 'novice' ELSE 'skilled' END AS tier_binary FROM (SELECT *, CASE WHEN sample_id % 11 = 0 THEN 'unknown' ELSE skill_tier END AS t FROM so)",
    }
