"""Stroke, measure and exercise labels (O-A*): all work is keyed by the sample id, events are ordered by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Mean and spread of the overall score in each tier.
TIER_SCORES = {"beginner": (34.3, 6.6), "intermediate": (45.7, 10.1), "advanced": (61.0, 10.8), "professional": (73.5, 10.7)}
#: Weights of the overall score.
WEIGHTS = {
    "timing_accuracy": 0.2,
    "timing_consistency": 0.15,
    "tempo_stability": 0.1,
    "subdivision_evenness": 0.1,
    "velocity_control": 0.1,
    "accent_differentiation": 0.1,
    "accent_accuracy": 0.1,
    "hand_balance": 0.15,
}
IDEAL_SPACING_MS = 30.0


def sigmoid(x: Column, centre: float, scale: float) -> Column:
    """100 far below the centre, 50 at it, 0 far above."""
    return 100 / (1 + F.exp((x - centre) / scale))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def stroke_labels(events: DataFrame, key: str = "sample_id") -> DataFrame:
    """Events with corrected timing error, spacing, accent flag and bounce count (O-A01, O-J06, O-J07, O-P04).

    Only rows with a parent, and three columns of possible parents, take part in the self join; the full rows are
    shuffled once, to meet the facts found about them.
    """
    children = events.where(F.col("parent_stroke_index").isNotNull()).select(key, "index", "parent_stroke_index", "is_grace_note", "actual_time_ms")
    parents = events.select(F.col(key), F.col("index").alias("parent_stroke_index"), F.col("actual_time_ms").alias("_parent_ms"))
    spacing = children.where("is_grace_note").join(parents, [key, "parent_stroke_index"]).select(key, "index", (F.col("_parent_ms") - F.col("actual_time_ms")).alias("flam_spacing_ms"))
    counts = children.groupBy(key, F.col("parent_stroke_index").alias("index")).agg(F.count(F.lit(1)).alias("_children"))
    facts = spacing.join(counts, [key, "index"], "full_outer")
    raw = F.col("actual_time_ms") - F.col("intended_time_ms")
    return (
        events.join(facts, [key, "index"], "left")
        .withColumn("raw_timing_error_ms", raw)
        .withColumn("timing_error_ms", F.coalesce(F.col("flam_spacing_ms") - IDEAL_SPACING_MS, raw))
        .withColumn("velocity_error", F.col("actual_velocity") - F.col("intended_velocity"))
        .withColumn("is_accent", F.col("stroke_type") == "accent")
        .withColumn("buzz_count", F.when((F.col("stroke_type") == "buzz") & ~F.col("is_grace_note"), 1 + F.coalesce("_children", F.lit(0))))
        .drop("_children")
    )


def measure_labels(strokes: DataFrame, length: Column, key: str = "sample_id") -> DataFrame:
    """Eight statistics per block of ``length`` events (O-A02)."""
    left, right = (F.col("hand") == h for h in "LR")
    m = strokes.groupBy(key, F.floor(F.col("position") / length).cast("int").alias("index")).agg(
        F.min("position").alias("stroke_start"),
        (F.max("position") + 1).alias("stroke_end"),
        F.avg("timing_error_ms").alias("timing_mean_error_ms"),
        F.stddev_pop("timing_error_ms").alias("timing_std_ms"),
        F.max(F.abs("timing_error_ms")).alias("timing_max_error_ms"),
        F.avg("actual_velocity").alias("velocity_mean"),
        F.stddev_pop("actual_velocity").alias("velocity_std"),
        F.avg(F.when(left, F.col("actual_velocity"))).alias("_lv"),
        F.avg(F.when(right, F.col("actual_velocity"))).alias("_rv"),
        F.avg(F.when(left, F.col("timing_error_ms"))).alias("_lt"),
        F.avg(F.when(right, F.col("timing_error_ms"))).alias("_rt"),
    )
    both = F.col("_lv").isNotNull() & F.col("_rv").isNotNull()
    return (
        m.withColumn("velocity_consistency", F.when(F.col("velocity_mean") > 0, 1 - F.try_divide("velocity_std", "velocity_mean")).otherwise(0.0))
        .withColumn("lr_velocity_ratio", F.when(both, F.when(F.col("_rv") > 0, F.try_divide("_lv", "_rv")).otherwise(1.0)))
        .withColumn("lr_timing_diff_ms", F.when(both, F.col("_lt") - F.col("_rt")))
        .drop("_lv", "_rv", "_lt", "_rt")
    )


def _facts(strokes: DataFrame, key: str) -> DataFrame:
    """Everything that scores and groove need, in one pass of windows and one aggregation over a single shuffle."""
    order = Window.partitionBy(key).orderBy("position")
    whole = Window.partitionBy(key)
    raw, v = F.col("raw_timing_error_ms"), F.col("actual_velocity")
    s = strokes.select(
        "*",
        F.count(F.lit(1)).over(whole).alias("_n"),
        F.avg("actual_velocity").over(whole).alias("_mean_v"),
        F.avg(raw).over(whole).alias("_mean_raw"),
        F.stddev_pop(raw).over(whole).alias("_sd_raw"),
        *[F.lag(raw, k).over(order).alias(f"_lag{k}") for k in range(1, 5)],
        (F.col("actual_time_ms") - F.lag("actual_time_ms").over(order)).alias("_ioi"),
        (F.col("intended_time_ms") - F.lag("intended_time_ms").over(order)).alias("_grid"),
        (F.lead("actual_time_ms").over(order) - F.col("actual_time_ms")).alias("_next"),
        (F.lead("intended_time_ms").over(order) - F.col("intended_time_ms")).alias("_next_grid"),
        F.lead("stroke_type").over(order).alias("_next_type"),
        F.lead("diddle_position").over(order).alias("_next_place"),
    )
    left, right = (F.col("hand") == h for h in "LR")
    error, size = F.col("timing_error_ms"), F.abs("timing_error_ms")
    straight = ~F.col("is_grace_note")
    pair = F.try_divide("_next", F.when(F.col("_next_grid") > 0, F.col("_next_grid")))
    swing = F.when((F.col("position") % 2 == 0) & (pair > 0.3) & (pair < 1.7), pair)
    double = (F.col("stroke_type") == "diddle") & (F.col("diddle_position") == 1) & (F.col("_next_type") == "diddle") & (F.col("_next_place") == 2)
    gap = F.col("flam_spacing_ms")
    flam = F.when(gap.between(20, 40), 100.0).when(gap < 20, F.greatest(F.lit(0.0), 100 - (20 - gap) * 5)).when(gap > 40, F.greatest(F.lit(0.0), 100 - (gap - 40) * 3))
    first, last = F.floor(F.col("_n") / 4), F.col("_n") - F.ceil(F.col("_n") / 4)
    return s.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(size).alias("mean_abs"),
        F.stddev_pop(error).alias("sd_error"),
        F.count_if(straight).alias("n_straight"),
        (F.regr_slope(F.when(straight, error), F.when(straight, F.col("intended_time_ms"))) * 1000).alias("slope"),
        F.stddev_pop(F.col("_ioi") / F.greatest("_grid", F.lit(1.0))).alias("sd_ratio"),
        F.stddev_pop("actual_velocity").alias("sd_v"),
        F.avg(F.when(F.col("is_accent"), v)).alias("accent_v"),
        F.avg(F.when(F.col("stroke_type").isin("tap", "buzz"), v)).alias("tap_v"),
        F.avg(F.when(F.col("is_accent"), (v > F.col("_mean_v")).cast("double"))).alias("accent_hit"),
        F.avg(F.when(left, v)).alias("left_v"),
        F.avg(F.when(right, v)).alias("right_v"),
        F.avg(F.when(left, size)).alias("left_t"),
        F.avg(F.when(right, size)).alias("right_t"),
        F.avg(flam).alias("flam"),
        F.avg(F.when(double, F.abs(pair - 1))).alias("double_dev"),
        F.avg(F.when(F.col("position") < first, v)).alias("first_v"),
        F.avg(F.when(F.col("position") >= last, v)).alias("last_v"),
        F.avg(F.abs(raw)).alias("mean_abs_raw"),
        F.avg(raw).alias("mean_raw"),
        F.max(F.abs(raw)).alias("max_abs_raw"),
        F.stddev_pop(raw).alias("sd_raw"),
        *[F.sum((raw - F.col("_mean_raw")) * (F.col(f"_lag{k}") - F.col("_mean_raw"))).alias(f"lag{k}") for k in range(1, 5)],
        F.count(swing).alias("n_swing"),
        F.avg(swing).alias("mean_swing"),
        F.stddev_pop(swing).alias("sd_swing"),
        F.avg(F.when(F.col("stroke_type") == "accent", raw)).alias("accent_raw"),
    )


def _groove(f: DataFrame) -> DataFrame:
    """pattern_consistency, swing_ratio, accent_timing_bias, groove_feel_proxy (O-A18 to O-A21)."""
    var = F.col("sd_raw") * F.col("sd_raw")
    lags = [F.abs(F.try_divide(F.col(f"lag{k}"), F.col("n") - k)) for k in range(1, 5)]
    auto = F.try_divide((lags[0] + lags[1] + lags[2] + lags[3]) / 4, var)
    boost = F.when((F.col("swing_ratio") > 0.55) & (F.col("swing_ratio") < 0.75), 0.1).otherwise(0.0)
    feel = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.col("mean_abs_raw") / 50) + F.col("pattern_consistency") * 0.3 + boost)
    return (
        f.withColumn("pattern_consistency", F.when(F.col("n") < 6, 0.5).when(F.col("sd_raw") == 0, 1.0).otherwise(auto))
        .withColumn("swing_ratio", F.when((F.col("n") >= 4) & (F.col("n_swing") >= 2) & (F.col("sd_swing") < 0.15), F.col("mean_swing")))
        .withColumn("accent_timing_bias", F.coalesce("accent_raw", F.lit(0.0)))
        .withColumn("groove_feel_proxy", F.when(F.col("n") < 4, 0.5).otherwise(feel))
    )


def exercise_scores(strokes: DataFrame, samples: DataFrame, key: str = "sample_id") -> DataFrame:
    """One score row per sample, samples without events included (O-A03 to O-A16, O-A21, O-P06)."""
    f = _groove(_facts(strokes, key))
    both = F.col("left_v").isNotNull() & F.col("right_v").isNotNull()
    low_t, high_t = F.least("left_t", "right_t"), F.greatest(F.col("left_t"), F.col("right_t"), F.lit(1.0))
    even = 0.4 * 100 * F.try_divide(low_t, high_t) + 0.6 * sigmoid((F.col("left_t") + F.col("right_t")) / 2, 25, 10)
    level = 100 * F.try_divide(F.least("left_v", "right_v"), F.greatest("left_v", "right_v"))
    f = f.select(
        key,
        "n",
        sigmoid(F.col("mean_abs"), 25, 10).alias("timing_accuracy"),
        sigmoid(F.col("sd_error"), 15, 8).alias("timing_consistency"),
        F.when(F.col("n_straight") > 1, F.greatest(F.lit(0.0), 100 - F.abs(F.coalesce("slope", F.lit(0.0))) * 10)).otherwise(100.0).alias("tempo_stability"),
        F.when(F.col("n") > 1, F.greatest(F.lit(0.0), 100 - F.col("sd_ratio") * 100)).otherwise(100.0).alias("subdivision_evenness"),
        F.greatest(F.lit(0.0), 100 - F.col("sd_v") * 2).alias("velocity_control"),
        F.coalesce(clamp((F.col("accent_v") - F.col("tap_v")) / 127 * 20 * 8, 0.0, 100.0) + F.when(F.col("accent_v").isNull() | F.col("tap_v").isNull(), F.lit(None).cast("double")).otherwise(0.0), F.lit(80.0)).alias("accent_differentiation"),
        F.coalesce(F.col("accent_hit") * 100, F.lit(100.0)).alias("accent_accuracy"),
        F.when(both, 0.5 * level + 0.5 * even).otherwise(100.0).alias("hand_balance"),
        F.coalesce(F.when(both, F.try_divide(F.col("left_t") * 100, F.col("left_t") + F.col("right_t"))), F.lit(50.0)).alias("weak_hand_index"),
        F.coalesce("flam", F.lit(80.0)).alias("_flam"),
        F.coalesce(F.greatest(F.lit(0.0), 100 - F.col("double_dev") * 200), F.lit(80.0)).alias("_diddle"),
        F.when((F.col("n") < 4) | (F.col("first_v") == 0), 80.0).otherwise(F.least(F.lit(100.0), F.try_divide("last_v", "first_v") * 100)).alias("_roll"),
        "groove_feel_proxy",
    )
    zero = [c for c in WEIGHTS]
    joined = samples.select(key, "category", "skill_tier").join(f, key, "left")
    some = F.col("n").isNotNull()
    overall = sum((F.col(c) * w for c, w in WEIGHTS.items()), F.lit(0.0))
    out = joined.select(
        key,
        "skill_tier",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in zero],
        F.coalesce("weak_hand_index", F.lit(50.0)).alias("weak_hand_index"),
        F.when(some & (F.col("category") == "flam"), F.col("_flam")).alias("flam_quality"),
        F.when(some & F.col("category").isin("diddle", "roll"), F.col("_diddle")).alias("diddle_quality"),
        F.when(some & (F.col("category") == "roll"), F.col("_roll")).alias("roll_sustain"),
        F.coalesce("groove_feel_proxy", F.lit(0.0)).alias("groove_feel_proxy"),
    ).withColumn("overall_score", overall)
    return out.withColumn("tier_confidence", tier_confidence(F.col("overall_score"), F.col("skill_tier")))


def tier_confidence(score: Column, tier: Column) -> Column:
    """exp(-z^2/2) of the score in its tier's distribution; 0.5 for an unknown tier (O-P06)."""
    out = F.lit(0.5)
    for name, (mean, sd) in TIER_SCORES.items():
        z = (score - mean) / sd
        out = F.when(tier == name, F.exp(-0.5 * z * z)).otherwise(out)
    return out


def tier_binary(tier: Column) -> Column:
    """novice for the two lower tiers, else skilled (O-P05)."""
    return F.when(tier.isin("beginner", "intermediate"), "novice").otherwise("skilled")


def groove_report(strokes: DataFrame, key: str = "sample_id") -> DataFrame:
    """Groove numbers, timing statistics and a sentence about them (O-A18 to O-A22)."""
    g = _groove(_facts(strokes, key))
    feel, steady, swing, bias = (F.col(c) for c in ("groove_feel_proxy", "pattern_consistency", "swing_ratio", "accent_timing_bias"))
    # The report's sentences and their bounds.
    words = F.concat_ws(
        "; ",
        F.when(feel > 0.8, "Excellent groove or timing accuracy").when(feel > 0.6, "Good groove feel").when(feel > 0.4, "Moderate groove, some inconsistency").otherwise("Inconsistent timing, lacking groove"),
        F.when(steady > 0.5, "Systematic timing patterns detected").when(steady < 0.2, "Random/erratic timing deviations"),
        F.when(swing > 0.6, F.format_string("Swing feel detected (ratio: %.2f)", swing)).when(swing.isNotNull(), "Straight timing"),
        F.when(bias > 5, "Accents tend to be ahead the beat").when(bias < -5, "Accents tend to be behind the beat"),
    )
    return g.select(
        key,
        "groove_feel_proxy",
        "pattern_consistency",
        "swing_ratio",
        "accent_timing_bias",
        F.col("mean_raw").alias("mean_error_ms"),
        F.col("sd_raw").alias("std_error_ms"),
        F.col("max_abs_raw").alias("max_error_ms"),
        words.alias("interpretation"),
    )


def sample_rollup(strokes: DataFrame, samples: DataFrame, length: Column, key: str = "sample_id") -> DataFrame:
    """duration_sec, num_strokes, num_measures of every sample (O-A23)."""
    f = strokes.groupBy(key).agg(F.max("actual_time_ms").alias("_last"), F.count(F.lit(1)).alias("_n"))
    return samples.join(f, key, "left").select(
        key,
        F.coalesce(F.col("_last") / 1000 + 0.5, F.lit(0.0)).alias("duration_sec"),
        F.coalesce("_n", F.lit(0)).alias("stroke_count"),
        F.ceil(F.coalesce("_n", F.lit(0)) / length).alias("measure_count"),
    )
