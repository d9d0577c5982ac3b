"""Joins (O-J*): equi joins with a bounding key; ranges become time buckets or sweeps, greedy matching goes in rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strokelab.operators import windows
from strokelab.sources import shared


def with_dimension(fact: DataFrame, dimension: DataFrame, columns: list[str], key: str = "sample_id", how: str = "inner") -> DataFrame:
    """Facts with some columns of their dimension row (O-J01); Spark broadcasts the dimension where it is small."""
    return fact.join(dimension.select(key, *columns), key, how)


def with_scores(samples: DataFrame, exercises: DataFrame, allowed: list[str], key: str = "sample_id") -> DataFrame:
    """Every sample with the allowed scores that exist (O-J02)."""
    return samples.join(exercises.select(key, *[c for c in allowed if c in exercises.columns]), key, "left")


def three_way(samples: DataFrame, features: DataFrame, scores: DataFrame, key: str = "sample_id") -> DataFrame:
    """O-J03."""
    return samples.join(features, key).join(scores, key)


def with_ids(df: DataFrame, ids: DataFrame, key: str = "sample_id") -> DataFrame:
    """O-J04."""
    return df.join(ids.select(key), key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str = "sample_id") -> DataFrame:
    """Child keys without a parent, with their row counts (O-J05)."""
    return child.join(parent.select(key), key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def in_measures(strokes: DataFrame, measures: DataFrame, key: str = "sample_id", place: str = "index") -> DataFrame:
    """Events of each measure's half-open interval, once for every measure that holds them (O-J08).

    A sweep: the starts and ends of a sample's measures cut its line into segments, the segment that is open is carried along
    the events in order, and measures meet events by segment.  Rows grow with events, borders and results; measures that
    overlap are split at each other's borders.
    """
    m = shared.written(measures.select(F.col(key).alias("_key"), F.col("index").alias("measure"), "stroke_start", "stroke_end").where("stroke_start < stroke_end"))
    borders = m.select("_key", F.explode(F.array("stroke_start", "stroke_end")).alias("_at")).distinct()
    borders = borders.withColumn("_segment", F.row_number().over(Window.partitionBy("_key").orderBy("_at")))
    first, behind = (borders.select("_key", F.col("_at").alias(c), F.col("_segment").alias(f"_{c}")) for c in ("stroke_start", "stroke_end"))
    covered = m.join(first, ["_key", "stroke_start"]).join(behind, ["_key", "stroke_end"])
    covered = covered.select("_key", "measure", F.explode(F.sequence("_stroke_start", F.col("_stroke_end") - 1)).alias("_segment"))
    events = strokes.select(F.col(key).alias("_key"), F.col(place).alias("_at"), F.struct(*strokes.columns).alias("_row"))
    line = events.unionByName(borders, allowMissingColumns=True)
    # A border comes before the events at its place.
    open_now = F.last("_segment", ignorenulls=True).over(Window.partitionBy("_key").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0))
    placed = line.withColumn("_segment", open_now).where("_row is not null and _segment is not null")
    return placed.join(covered, ["_key", "_segment"]).select("_row.*", "measure")


def _buckets(time: Column, width: float) -> Column:
    b = F.floor(time / width)
    return F.explode(F.array(b - 1, b, b + 1))


def drop_resonance(points: DataFrame, window_ms: float = 25.0, ratio: float = 0.4, key: str = "sample_id") -> DataFrame:
    """Drop points within the window of another whose strength they reach less than ``ratio`` of (O-J09)."""
    p = points.withColumn("_bucket", F.floor(F.col("time_ms") / window_ms))
    strong = points.select(F.col(key).alias("_key"), F.col("time_ms").alias("_t"), F.col("strength").alias("_s"), _buckets(F.col("time_ms"), window_ms).alias("_near"))
    hit = (
        (p[key] == strong["_key"])
        & (p["_bucket"] == strong["_near"])
        & (F.abs(p["time_ms"] - strong["_t"]) < window_ms)
        & (p["strength"] < strong["_s"] * ratio)
    )
    return p.join(strong, hit, "left_anti").drop("_bucket")


def match_nearest(truth: DataFrame, detected: DataFrame, window_ms: float = 50.0, key: str = "sample_id", rounds: int = 3) -> DataFrame:
    """One-to-one matches (position, detected, distance) of points nearer than the window (O-J10).

    Strong truths choose first (equally strong ones by position), each the nearest point still free (the earlier of equally
    near ones).  ``truth``: key, position, time_ms, velocity; ``detected``: key, detected (its number in time order), time_ms.

    Instead of one choice after the other there are rounds over all candidates: a truth whose nearest free point has no
    stronger truth near it takes that point for good; a point that some truth would take is closed to all weaker ones.  The
    strongest truth left always gets its point, so rounds end; what a sample's points crowd decides their number, not how
    many points or samples there are.  ``rounds`` of them are one job, then what is left is written.
    """
    t = truth.select(F.col(key).alias("_key"), "position", F.struct((-F.col("velocity")).alias("v"), "position").alias("_turn"), F.col("time_ms").alias("_t"), F.floor(F.col("time_ms") / window_ms).alias("_b"))
    d = detected.select(F.col(key).alias("_k"), "detected", F.col("time_ms").alias("_d"), _buckets(F.col("time_ms"), window_ms).alias("_near"))
    distance = F.abs(F.col("_t") - F.col("_d"))
    near = t.join(d, (F.col("_key") == F.col("_k")) & (F.col("_b") == F.col("_near")) & (distance < window_ms))
    left = near.select("_key", "position", "_turn", "detected", distance.alias("distance"))
    left = left.withColumn("_match", F.lit(False))
    matches = None
    while True:
        # A pair that is matched is alone with its truth and its point, so further rounds leave it as it is.
        for _ in range(rounds):
            left = _match_round(left)
        step = shared.written(left)
        found = step.where("_match")
        matches = found if matches is None else matches.unionByName(found)
        left = step.where("not _match")
        if left.isEmpty():
            return matches.select(F.col("_key").alias(key), "position", "detected", "distance")


def _match_round(pairs: DataFrame) -> DataFrame:
    """One round over candidates (_key, position, _turn, detected, distance): marks matches, drops pairs that can't be any."""
    of_truth, of_point = Window.partitionBy("_key", "position"), Window.partitionBy("_key", "detected")
    wish = pairs.withColumn("_wish", F.row_number().over(of_truth.orderBy("distance", "detected")) == 1)
    asked = wish.withColumn("_first", F.min("_turn").over(of_point)).withColumn("_holder", F.min(F.when(F.col("_wish"), F.col("_turn"))).over(of_point))
    asked = asked.withColumn("_match", F.col("_wish") & (F.col("_turn") == F.col("_first")))
    # Weaker truths than the one that would take the point can't get it any more.
    kept = asked.where(F.col("_holder").isNull() | (F.col("_turn") <= F.col("_holder")))
    return kept.withColumn("_settled", F.max("_match").over(of_truth)).where("_match or not _settled").select("_key", "position", "_turn", "detected", "distance", "_match")


def supplement(truth: DataFrame, detected: DataFrame, curves: DataFrame, fps: float = 100.0, floor: float = 0.01, near_ms: float = 20.0, key: str = "sample_id") -> DataFrame:
    """Points to add where an event has no detection near it and the activation curve is high enough (O-J11).

    What is added counts as a detection for the events after it.  Events near a detection, and those where the curve is low,
    drop out by joins; among the others a gap of ``near_ms`` ends the reach of an addition, so each stretch without such a
    gap is folded by itself.
    """
    t = truth.select(F.col(key).alias("_key"), F.col("time_ms").cast("double").alias("_t"), F.floor(F.col("time_ms") / near_ms).alias("_b"))
    d = detected.select(F.col(key).alias("_k"), F.col("time_ms").alias("_d"), _buckets(F.col("time_ms"), near_ms).alias("_near"))
    free = t.join(d, (F.col("_key") == F.col("_k")) & (F.col("_b") == F.col("_near")) & (F.abs(F.col("_t") - F.col("_d")) < near_ms), "left_anti")
    # The curve of a sample is one row, so its events' times may be one too; it is read once, not once an event.  Spark takes
    # an array for a few bytes where it has no figures of a table, and would send all curves to every task: times are hashed.
    times = free.groupBy("_key").agg(F.collect_list("_t").alias("_times")).hint("shuffle_hash")
    c = curves.select(F.col(key).alias("_key"), F.col("activation").cast("array<double>").alias("_curve"))
    frame = lambda x: F.greatest(F.lit(0), F.least(F.bround(x / 1000 * fps, 0).cast("int"), F.size("_curve") - 1))
    read = times.join(c, "_key").select("_key", F.explode(F.transform("_times", lambda x: F.struct(x.alias("time_ms"), F.get("_curve", frame(x)).alias("strength")))).alias("p"))
    high = read.select("_key", "p.*").where(F.col("strength") >= floor)
    added = windows.fold_islands(high, near_ms, "_key", lambda last, p: last)
    return added.withColumnRenamed("_key", key)


def zip_by_time(a: DataFrame, b: DataFrame, key: str = "sample_id", order_a: list[str] | None = None, order_b: list[str] | None = None) -> DataFrame:
    """Positional join of two event lists per sample, for samples with equal counts (O-J12)."""
    order_a, order_b = order_a or ["time_ms"], order_b or ["time_ms"]

    def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
        w = Window.partitionBy(key)
        s = F.struct(*[c for c in df.columns if c != key]).alias(name)
        return df.select(key, F.row_number().over(w.orderBy(*order)).alias("rn"), F.count(F.lit(1)).over(w).alias(f"_n{name}"), s)

    x, y = numbered(a, order_a, "a"), numbered(b, order_b, "b")
    return x.join(y, [key, "rn"]).where("_na = _nb").drop("_na", "_nb")


def job_grid(*dimensions: DataFrame) -> DataFrame:
    """Cross product of dimension tables with a job id from all their columns (O-J13)."""
    out = dimensions[0]
    for d in dimensions[1:]:
        out = out.crossJoin(d)
    return out.withColumn("job_id", F.concat_ws("_", *[F.col(c).cast("string") for c in out.columns]))


def pending(expected: DataFrame, status: DataFrame, key: str = "id") -> DataFrame:
    """Expected ids that are neither completed nor failed (O-J14)."""
    return expected.join(status.where(F.col("status").isin("completed", "failed")).select(key), key, "left_anti")


def clean_augmented_pairs(df: DataFrame, clean: Column, group: str = "augmentation_group_id", key: str = "sample_id") -> DataFrame:
    """Each clean row of a group with all augmented rows of the group, where there are both (O-J15)."""
    g = df.groupBy(group).agg(
        F.sort_array(F.collect_list(F.when(clean, F.col(key)))).alias("_clean"), F.sort_array(F.collect_list(F.when(~clean, F.col(key)))).alias("augmented")
    )
    return g.where((F.size("_clean") > 0) & (F.size("augmented") > 0)).select(group, F.explode("_clean").alias("clean"), "augmented")


def with_split(df: DataFrame, splits: DataFrame, profile: str = "profile_id", default: str = "train") -> DataFrame:
    """The split of each row's profile; unknown profiles fall into the default (O-J16)."""
    return df.join(splits.select(profile, "split"), profile, "left").withColumn("split", F.coalesce("split", F.lit(default)))
