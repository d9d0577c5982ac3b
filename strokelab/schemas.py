"""Table schemas, value domains and small readers' helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the label tables.
HANDS = ("L", "R")
STROKE_TYPES = ("tap", "accent", "grace", "diddle", "buzz")
CATEGORIES = ("roll", "diddle", "flam", "drag")
TIERS = ("beginner", "intermediate", "advanced", "professional")
SPLITS = ("train", "val", "test")



STROKES_DDL = (
    "sample_id string, position int, index int, hand string, stroke_type string, intended_time_ms double, actual_time_ms double, "
    "timing_error_ms double, raw_timing_error_ms double, intended_velocity int, actual_velocity int, velocity_error int, "
    "is_grace_note boolean, is_accent boolean, diddle_position int, flam_spacing_ms double, parent_stroke_index int, buzz_count int"
)
MEASURES_DDL = (
    "sample_id string, index int, stroke_start int, stroke_end int, timing_mean_error_ms double, timing_std_ms double, "
    "timing_max_error_ms double, velocity_mean double, velocity_std double, velocity_consistency double, lr_velocity_ratio double, "
    "lr_timing_diff_ms double"
)
SCORES = (
    "timing_accuracy",
    "timing_consistency",
    "tempo_stability",
    "subdivision_evenness",
    "velocity_control",
    "accent_differentiation",
    "accent_accuracy",
    "hand_balance",
    "weak_hand_index",
    "overall_score",
)
OPTIONAL_SCORES = ("flam_quality", "diddle_quality", "roll_sustain")
UNIT_SCORES = ("groove_feel_proxy", "tier_confidence")
EXERCISES_DDL = "sample_id string, " + ", ".join(f"{c} double" for c in SCORES + OPTIONAL_SCORES + UNIT_SCORES)
SAMPLES_DDL = (
    "sample_id string, profile_id string, rudiment_slug string, tempo_bpm int, duration_sec double, num_cycles int, skill_tier string, "
    "skill_tier_binary string, dominant_hand string, midi_path string, audio_path string, num_strokes int, num_measures int, "
    "soundfont string, augmentation_preset string, augmentation_group_id string"
)
DDL = {"samples": SAMPLES_DDL, "strokes": STROKES_DDL, "measures": MEASURES_DDL, "exercises": EXERCISES_DDL}
KEYS = {"samples": ["sample_id"], "strokes": ["sample_id", "index"], "measures": ["sample_id", "index"], "exercises": ["sample_id"]}


def optional_col(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed null where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN of floating columns becomes null (tables written by other tools mark missing integers so)."""
    kinds = dict(df.dtypes)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns])
