"""Scalar functions (O-P*): all are Columns of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.operators.numbering import numbered

#: Abbreviation of each tier in sample ids.
TIER_SHORT = {"beginner": "beg", "intermediate": "int", "advanced": "adv", "professional": "pro"}


def sample_id(tier: Column, number: Column, slug: Column, tempo: Column, soundfont: Column, preset: Column) -> Column:
    """Readable id ``pro003_single_paradiddle_120bpm_marching_lofi`` (O-P01).

    Unknown tiers are ``unk``, no soundfont is ``raw``, no preset ``clean``; a soundfont's name keeps 8 characters.
    """
    short = F.lit("unk")
    for name, s in TIER_SHORT.items():
        short = F.when(tier == name, s).otherwise(short)
    bare = F.regexp_replace(F.regexp_replace(soundfont, "_GM_GS|_GS", ""), "[_-]", "")
    font = F.coalesce(F.lower(F.substring(F.nullif(bare, F.lit("")), 1, 8)), F.lit("raw"))
    effect = F.coalesce(F.regexp_replace(F.lower(F.nullif(preset, F.lit(""))), "_", ""), F.lit("clean"))
    return F.concat_ws("_", F.format_string("%s%03d_%s_%dbpm", short, number.cast("int"), slug, tempo.cast("int")), font, effect)


def parse_sample_id(sid: Column) -> Column:
    """The fields of such an id; the tempo anchors the slug, which may hold underscores (O-P02)."""
    pattern = r"^([a-z]{3})(\d+)_(.+)_(\d+)bpm(?:_([a-z0-9]+))?(?:_([a-z0-9]+))?$"
    part = lambda i: F.nullif(F.regexp_extract(sid, pattern, i), F.lit(""))
    return F.struct(part(1).alias("tier"), part(2).cast("int").alias("number"), part(3).alias("slug"), part(4).cast("int").alias("tempo_bpm"), part(5).alias("soundfont"), part(6).alias("preset"))


def group_id(profile: Column, slug: Column, tempo: Column) -> Column:
    """O-P03."""
    return F.concat_ws("_", F.substring(profile.cast("string"), 1, 8), slug, tempo.cast("string"))


def tempo_penalty(tempo: Column, low: Column, high: Column, per_bpm: float = 0.01) -> Column:
    """1 inside the comfort range, growing by ``per_bpm`` for each beat outside it (O-P07)."""
    return F.when(tempo < low, 1 + (low - tempo) * per_bpm).when(tempo > high, 1 + (tempo - high) * per_bpm).otherwise(1.0)


def strokes_per_beat(n_strokes: Column, beats: Column) -> Column:
    return F.try_divide(n_strokes, beats)


def duration_sec(beats: Column, tempo: Column) -> Column:
    return F.try_divide(beats * 60.0, tempo)


def cycles_for(target_sec: Column, cycle_sec: Column) -> Column:
    """Whole cycles nearest to a duration, at least one; halves to even (O-P08)."""
    return F.greatest(F.lit(1), F.bround(F.try_divide(target_sec, cycle_sec), 0).cast("int"))


def sample_index(ms: Column, rate: int) -> Column:
    """O-P09: truncates towards zero."""
    return (ms * rate / 1000).cast("int")


def normal_error(ms: Column, scale: float = 50.0) -> Column:
    """O-P10."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ms / scale))


def ordinal(value: Column, order) -> Column:
    """Place of a value in a fixed order; null where it has none (O-P11)."""
    return (F.nullif(F.array_position(F.array(*map(F.lit, order)), value), F.lit(0)) - 1).cast("int")


def name_ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct names with their number in sorted order (O-P11); one row per name."""
    names = df.select(column).where(F.col(column).isNotNull()).distinct()
    return numbered(names, [column], "id").withColumn("id", F.col("id").cast("int"))


def with_name_id(df: DataFrame, column: str, out: str = "label_id") -> DataFrame:
    return df.join(name_ids(df, column).withColumnRenamed("id", out), column, "left")


def flag(condition: Column) -> Column:
    """O-P12."""
    return condition.cast("int")


def filled(c: Column, sentinel: float = -1.0) -> Column:
    """O-P13."""
    return F.coalesce(c, F.lit(sentinel))


def category_of(slug: Column) -> Column:
    """Category by part of the slug, in rule order (O-P14)."""
    has = lambda *parts: F.coalesce(slug.rlike("|".join(parts)), F.lit(False))
    return F.when(has("roll", "stroke"), "roll").when(has("diddle"), "diddle").when(has("flam"), "flam").when(has("drag", "ratamacue"), "drag").otherwise("other")


def display_name(slug: Column) -> Column:
    """O-P15."""
    return F.initcap(F.replace(slug, F.lit("_"), F.lit(" ")))


def valid_slug(slug: Column) -> Column:
    """O-P16."""
    return slug.rlike("^[a-z0-9_]+$")


def fingerprint(*columns: str) -> Column:
    """First 16 hex digits of the sha256 of the columns as JSON with sorted keys (O-P17)."""
    return F.substring(F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256), 1, 16)


def cache_key(*columns: Column) -> Column:
    """O-P18."""
    return F.md5(F.concat_ws("_", *[c.cast("string") for c in columns]))


def with_preset(df: DataFrame, presets: DataFrame, preset: str = "augmentation_preset", prefix: str = "aug_") -> DataFrame:
    """Parameters of each row's preset; a stage that is off gives nulls (O-P20).

    ``presets``: preset, and for every stage ``<stage>_enabled`` with parameters ``<stage>_<name>``; a fixed small table.
    """
    stages = [c.removesuffix("_enabled") for c in presets.columns if c.endswith("_enabled")]
    out = [F.col("preset").alias(preset)]
    for c in presets.columns:
        stage = next((s for s in stages if c.startswith(s + "_") and not c.endswith("_enabled")), None)
        if stage:
            out.append(F.when(F.col(f"{stage}_enabled"), F.col(c)).alias(prefix + c))
    return df.join(F.broadcast(presets.select(*out)), preset, "left")
