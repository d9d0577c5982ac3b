"""Window and sequence operators (O-W*), all within one sample at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strokelab.operators.numbering import numbered


def intervals(points: DataFrame, key: str = "sample_id", time: str = "time_ms") -> DataFrame:
    """Inter-onset intervals with their middle, in time order (O-W02)."""
    before = F.lag(time).over(Window.partitionBy(key).orderBy(time))
    return points.select(key, F.col(time).alias("time_ms"), (F.col(time) - before).alias("ioi_ms"), ((F.col(time) + before) / 2).alias("mid_ms")).where("ioi_ms is not null")


def interval_features(points: DataFrame, samples: DataFrame, key: str = "sample_id", time: str = "time_ms") -> DataFrame:
    """Mean, SD, CV of intervals and a tempo estimate; zeros with fewer than two points (O-W01)."""
    x = F.col("ioi_ms")
    f = intervals(points, key, time).groupBy(key).agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return samples.select(key).join(f, key, "left").select(
        key, zero(F.col("m")).alias("ioi_mean"), zero(F.col("s")).alias("ioi_sd"), zero(F.try_divide("s", "m")).alias("ioi_cv"), zero(F.try_divide(F.lit(60000.0), F.col("m"))).alias("tempo_bpm")
    )


def fold_islands(points: DataFrame, gap_ms: float, key: str, closer: Callable[[Column, Column], Column]) -> DataFrame:
    """Points (key, time_ms, strength) folded in time order: one nearer than the gap to the kept point is merged into it.

    ``closer(kept, point)`` says which of two such points stays.  A kept point is never later than the point before, so a gap
    of ``gap_ms`` or more between neighbours ends its reach: each sample is cut there and the islands are folded one by one,
    carrying the last kept point only.
    """
    w = Window.partitionBy(key).orderBy("time_ms", "strength")
    point = F.struct(F.col("time_ms").cast("double").alias("time_ms"), F.col("strength").cast("double").alias("strength"))
    cut = points.select(key, "time_ms", "strength", (F.col("time_ms") - F.lag("time_ms").over(w) >= gap_ms).cast("int").alias("_cut"))
    islands = cut.withColumn("_island", F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_island", F.coalesce("_island", F.lit(0)))
    folded = islands.groupBy(key, "_island").agg(F.sort_array(F.collect_list(point)).alias("_points"))

    def step(state: Column, p: Column) -> Column:
        last = state["last"]
        near = p["time_ms"] - last["time_ms"] < gap_ms
        return F.struct(F.when(near, state["done"]).otherwise(F.array_append(state["done"], last)).alias("done"), F.when(near, closer(last, p)).otherwise(p).alias("last"))

    start = F.struct(F.array().cast("array<struct<time_ms:double,strength:double>>").alias("done"), F.get("_points", F.lit(0)).alias("last"))
    kept = F.aggregate(F.slice("_points", F.lit(2), F.size("_points")), start, step, lambda state: F.array_append(state["done"], state["last"]))
    return folded.select(key, F.explode(F.when(F.size("_points") == 1, F.col("_points")).otherwise(kept)).alias("p")).select(key, "p.time_ms", "p.strength")


def merge_close(points: DataFrame, gap_ms: float = 20.0, key: str = "sample_id") -> DataFrame:
    """Points closer than the gap to the kept point become one, the stronger staying (O-W04)."""
    return fold_islands(points, gap_ms, key, lambda last, p: F.when(p["strength"] > last["strength"], p).otherwise(last))


def cycle_cuts(points: DataFrame, cycles: Column | None = None, key: str = "sample_id", time: str = "time_ms", tight_ms: float = 40.0, pad_ms: float = 50.0) -> DataFrame:
    """N near-equal cycles per sample: first and last point number and padded times (O-W05).

    A cut before a point that follows the one before by less than ``tight_ms`` moves one point on, so that grace notes stay
    with their stroke; where the next cut is there already, the cycle between them is empty (its last point is before its
    first).  Fewer than four points are one cycle; without ``cycles`` there are 2 to 6, of about seven points.  Cuts are
    looked up by their number, so no point meets a cycle.
    """
    w = Window.partitionBy(key).orderBy(time)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    wanted = F.greatest(F.lit(2), F.least(F.lit(6), F.floor(F.col("_n") / 7))) if cycles is None else F.greatest(F.lit(1), F.least("_n", "_wanted"))
    p = points.select(key, F.col(time).alias("_t"), (F.row_number().over(w) - 1).alias("_i"), n.alias("_n"), (F.col(time) - F.lag(time).over(w)).alias("_gap"), (F.lit(1) if cycles is None else cycles).alias("_wanted"))
    one = p.where("_i = 0").withColumn("_c", F.when(F.col("_n") < 4, 1).otherwise(wanted).cast("int"))
    cut = one.select(key, "_n", "_c", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)).alias("cycle"))
    cut = cut.select(key, "cycle", "_n", F.bround(F.col("cycle") * F.col("_n") / F.col("_c"), 0).cast("int").alias("_i"))
    tight = (F.col("cycle") > 0) & (F.col("_gap") < tight_ms)
    moved = cut.join(p.select(key, "_i", "_gap"), [key, "_i"]).withColumn("first", F.when(tight, F.least(F.col("_i") + 1, F.col("_n").cast("int") - 1)).otherwise(F.col("_i")))
    last = F.coalesce(F.lead("first").over(Window.partitionBy(key).orderBy("cycle")), F.col("_n")) - 1
    ends = moved.select(key, "cycle", "first", last.cast("int").alias("last"))
    at = lambda c: p.select(key, F.col("_i").alias(c), F.col("_t").alias(f"_t_{c}"))
    return ends.join(at("first"), [key, "first"]).join(at("last"), [key, "last"]).select(
        key, "cycle", "first", "last", F.greatest(F.lit(0.0), F.col("_t_first") - pad_ms).alias("start_ms"), (F.col("_t_last") + pad_ms).alias("end_ms")
    )


def velocity_decay(strokes: DataFrame, rate: float, position: str = "position", velocity: str = "actual_velocity") -> DataFrame:
    """Velocities times max(0.5, 1 - position * rate), kept in 1..127 and truncated (O-W06)."""
    factor = F.greatest(F.lit(0.5), 1 - F.col(position) * rate)
    return strokes.withColumn("decayed_velocity", F.greatest(F.lit(1), F.least(F.lit(127), (F.col(velocity) * factor).cast("int"))))


def gains(strokes: DataFrame, end_ms: Column, k: float = 0.7, key: str = "sample_id", time: str = "actual_time_ms", velocity: str = "actual_velocity") -> DataFrame:
    """Interval in which each event's gain holds, and the gain (1 - k) + k * v / 127 (O-W07)."""
    nxt = F.lead(time).over(Window.partitionBy(key).orderBy("position"))
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(end_ms, c))
    return strokes.select(key, "position", clamp(F.col(time)).alias("from_ms"), clamp(F.coalesce(nxt, end_ms)).alias("to_ms"), ((1 - k) + k * F.col(velocity) / 127).alias("gain"))


def drags(strokes: DataFrame, key: str = "sample_id") -> DataFrame:
    """Positions where two grace notes stand before a main stroke (O-W08)."""
    w = Window.partitionBy(key).orderBy("position")
    g = F.col("is_grace_note")
    return strokes.select(key, "position", (g & F.lead(g, 1).over(w) & ~F.lead(g, 2).over(w)).alias("_hit")).where("_hit").drop("_hit")


def grace_parents(events: DataFrame, key: str = "sample_id", cycle: str = "cycle") -> DataFrame:
    """Parent of each grace event: the next main event of the same cycle (O-W09)."""
    w = Window.partitionBy(key, cycle).orderBy("position").rowsBetween(1, Window.unboundedFollowing)
    return events.withColumn("parent", F.when(F.col("is_grace_note"), F.first(F.when(~F.col("is_grace_note"), F.col("position")), ignorenulls=True).over(w)))


def first_seen_numbers(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct values numbered by first appearance (O-W10); one row per value."""
    first = df.groupBy(column).agg(F.min(order).alias("_first"))
    return numbered(first, ["_first", column], "number").select(column, "number")
