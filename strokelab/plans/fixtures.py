"""Label-shaped views over the driver tables (definitions: FIXTURES.md, part C), in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strokelab.schemas import TIERS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw performances: sample_id, position, hand, stroke_type, times, velocities, grace parents."""
    per = Window.partitionBy("sample_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("sample_id", F.col("user_id"))
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', cast(ts as timestamp_ntz))")
    kind = F.col("event_type")
    stroke = (
        F.when(kind == "view", "tap").when(kind == "click", "accent").when(kind == "purchase", "diddle").when(kind == "signup", "buzz").otherwise("grace")
    )
    e = e.select(
        "sample_id",
        "event_id",
        (F.row_number().over(per) - 1).alias("position"),
        (micros / 1e6 / 36.0).alias("t"),
        stroke.alias("stroke_type"),
        F.when(F.col("event_id") % 2 == 0, "R").otherwise("L").alias("hand"),
        F.least(F.lit(127), F.greatest(F.lit(1), F.floor("value"))).cast("int").alias("actual_velocity"),
    )
    after = Window.partitionBy("sample_id").orderBy("position").rowsBetween(1, Window.unboundedFollowing)
    grace = F.col("stroke_type") == "grace"
    parent = F.when(grace, F.first(F.when(~grace, F.struct("position", "t")), ignorenulls=True).over(after))
    e = e.withColumn("parent", parent).withColumn("is_grace_note", grace)
    grid = lambda t: F.floor(t / 100 + 0.5) * 100
    tied = F.col("parent").isNotNull()
    velocity = F.col("stroke_type")
    return e.select(
        "sample_id",
        "event_id",
        "position",
        F.col("position").alias("index"),
        "hand",
        "stroke_type",
        "is_grace_note",
        F.when(tied, grid(F.col("parent.t")) - 30).otherwise(grid(F.col("t"))).cast("double").alias("intended_time_ms"),
        F.when(tied, F.col("parent.t") - (10 + F.col("event_id") % 60)).otherwise(F.col("t")).alias("actual_time_ms"),
        F.when(velocity == "accent", 120).when(velocity == "grace", 40).when(velocity == "diddle", 75).when(velocity == "buzz", 70).otherwise(65).alias("intended_velocity"),
        "actual_velocity",
        F.when(F.col("stroke_type") == "diddle", F.col("position") % 2 + 1).alias("diddle_position"),
        F.col("parent.position").alias("parent_stroke_index"),
    )


EVENTS_SQL = """
e0 AS (SELECT user_id AS sample_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS position,
  (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 / 36.0 AS t,
  CASE event_type WHEN 'view' THEN 'tap' WHEN 'click' THEN 'accent' WHEN 'purchase' THEN 'diddle' WHEN 'signup' THEN 'buzz' ELSE 'grace' END AS stroke_type,
  CASE WHEN event_id % 2 = 0 THEN 'R' ELSE 'L' END AS hand, CAST(least(127, greatest(1, floor(value))) AS INTEGER) AS actual_velocity FROM events),
e1 AS (SELECT *, stroke_type = 'grace' AS is_grace_note,
  CASE WHEN stroke_type = 'grace' THEN first_value(CASE WHEN stroke_type <> 'grace' THEN position END IGNORE NULLS) OVER w END AS pp,
  CASE WHEN stroke_type = 'grace' THEN first_value(CASE WHEN stroke_type <> 'grace' THEN t END IGNORE NULLS) OVER w END AS pt
  FROM e0 WINDOW w AS (PARTITION BY sample_id ORDER BY position ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
ev AS (SELECT sample_id, event_id, position, position AS "index", hand, stroke_type, is_grace_note,
  CASE WHEN pt IS NOT NULL THEN floor(pt / 100 + 0.5) * 100 - 30 ELSE floor(t / 100 + 0.5) * 100 END AS intended_time_ms,
  CASE WHEN pt IS NOT NULL THEN pt - (10 + event_id % 60) ELSE t END AS actual_time_ms,
  CASE stroke_type WHEN 'accent' THEN 120 WHEN 'grace' THEN 40 WHEN 'diddle' THEN 75 WHEN 'buzz' THEN 70 ELSE 65 END AS intended_velocity,
  actual_velocity, CASE WHEN stroke_type = 'diddle' THEN position % 2 + 1 END AS diddle_position, pp AS parent_stroke_index FROM e1)"""

#: Stroke labels (O-A01) on top of EVENTS_SQL.
STROKES_SQL = (
    EVENTS_SQL
    + """,
kids AS (SELECT sample_id, parent_stroke_index AS p, count(*) AS n FROM ev WHERE parent_stroke_index IS NOT NULL GROUP BY ALL),
st AS (SELECT c.*, c.actual_time_ms - c.intended_time_ms AS raw_timing_error_ms,
  CASE WHEN c.is_grace_note AND p.position IS NOT NULL THEN p.actual_time_ms - c.actual_time_ms END AS flam_spacing_ms,
  CASE WHEN c.is_grace_note AND p.position IS NOT NULL THEN p.actual_time_ms - c.actual_time_ms - 30 ELSE c.actual_time_ms - c.intended_time_ms END AS timing_error_ms,
  c.actual_velocity - c.intended_velocity AS velocity_error, c.stroke_type = 'accent' AS is_accent,
  CASE WHEN c.stroke_type = 'buzz' AND NOT c.is_grace_note THEN 1 + coalesce(k.n, 0) END AS buzz_count
  FROM ev c LEFT JOIN ev p ON p.sample_id = c.sample_id AND p."index" = c.parent_stroke_index
  LEFT JOIN kids k ON k.sample_id = c.sample_id AND k.p = c."index")"""
)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per performance, with metadata derived from its id."""
    u = F.col("sample_id")
    counts = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("sample_id")).agg(F.count(F.lit(1)).alias("n"))
    profile = F.floor(u / 5).cast("long")
    return counts.select(
        "sample_id",
        profile.alias("profile_id"),
        F.element_at(F.array(*map(F.lit, TIERS)), (profile % 4 + 1).cast("int")).alias("skill_tier"),
        F.element_at(F.array(*map(F.lit, ("roll", "diddle", "flam", "drag"))), (u % 4 + 1).cast("int")).alias("category"),
        F.lit(8).alias("pattern_length"),
        (60 + u % 121).cast("int").alias("tempo_bpm"),
        F.element_at(F.array(F.lit(None).cast("string"), *map(F.lit, ("none", "gym", "lo_fi", "clean_studio"))), (u % 5 + 1).cast("int")).alias("augmentation_preset"),
        profile.cast("string").alias("augmentation_group_id"),
        (F.col("n") + F.when(u % 50 == 7, 1).otherwise(0)).alias("num_strokes"),
    )


SAMPLES_SQL = """
sm AS (SELECT sample_id, profile_id, ['beginner','intermediate','advanced','professional'][profile_id % 4 + 1] AS skill_tier,
  ['roll','diddle','flam','drag'][sample_id % 4 + 1] AS category, 8 AS pattern_length, CAST(60 + sample_id % 121 AS INTEGER) AS tempo_bpm,
  [NULL,'none','gym','lo_fi','clean_studio'][sample_id % 5 + 1] AS augmentation_preset, CAST(profile_id AS VARCHAR) AS augmentation_group_id,
  n + CASE WHEN sample_id % 50 = 7 THEN 1 ELSE 0 END AS num_strokes
  FROM (SELECT user_id AS sample_id, CAST(floor(user_id / 5) AS BIGINT) AS profile_id, count(*) AS n FROM events GROUP BY ALL))"""


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger dimension with one score per row: orders with their customers."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    top = o.agg(F.max("o_totalprice").alias("top"))  # one row
    seg = F.col("c_mktsegment")
    tier = F.when(seg == "AUTOMOBILE", "beginner").when(seg == "FURNITURE", "advanced").when(seg == "HOUSEHOLD", "professional").otherwise("intermediate")
    return (
        o.join(c, o["o_custkey"] == c["c_custkey"])
        .crossJoin(F.broadcast(top))
        .select(
            F.col("o_orderkey").alias("sample_id"),
            F.col("o_custkey").alias("profile_id"),
            tier.alias("skill_tier"),
            F.col("o_orderpriority").alias("rudiment_slug"),
            (F.col("o_totalprice") / F.col("top") * 100).alias("score"),
            (60 + F.col("o_orderkey") % 121).cast("int").alias("tempo_bpm"),
            F.element_at(F.array(F.lit(None).cast("string"), *map(F.lit, ("none", "gym", "lo_fi"))), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("augmentation_preset"),
            F.element_at(F.array(*map(F.lit, ("marching", "practice_pad", "concert"))), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("soundfont"),
        )
    )


ORDERS_SQL = """
so AS (SELECT o_orderkey AS sample_id, o_custkey AS profile_id,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'beginner' WHEN 'FURNITURE' THEN 'advanced' WHEN 'HOUSEHOLD' THEN 'professional' ELSE 'intermediate' END AS skill_tier,
  o_orderpriority AS rudiment_slug, o_totalprice / (SELECT max(o_totalprice) FROM orders) * 100 AS score, CAST(60 + o_orderkey % 121 AS INTEGER) AS tempo_bpm,
  [NULL,'none','gym','lo_fi'][o_orderkey % 4 + 1] AS augmentation_preset, ['marching','practice_pad','concert'][o_orderkey % 3 + 1] AS soundfont
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
