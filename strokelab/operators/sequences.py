"""Array, sequence and pattern operators (O-Q*), in built-in array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def padded(x: Column, n: Column | int, fill: Column) -> Column:
    """An array cut or filled up to n elements."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.concat(F.slice(x, F.lit(1), n), F.array_repeat(fill, F.greatest(F.lit(0), n - F.size(x)).cast("int")))


def mask(x: Column, n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.transform(F.sequence(F.lit(1), n), lambda i: (i <= F.size(x)).cast("int"))


def feature_matrix(strokes: DataFrame, features: list[str], n: int, key: str = "sample_id", order: str = "position", fill: float = 0.0) -> DataFrame:
    """Per sample: n rows of features in event order, a mask and the true length (O-Q01)."""
    row = F.struct(order, F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    rows = strokes.where(F.col(order) < n).groupBy(key).agg(F.transform(F.sort_array(F.collect_list(row)), lambda s: s["x"]).alias("_x"))
    size = strokes.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("length"))
    empty = F.array(*[F.lit(fill)] * len(features))
    return size.join(rows, key).select(key, padded(F.col("_x"), n, empty).alias("matrix"), mask(F.col("_x"), n).alias("mask"), F.least("length", F.lit(n)).alias("length"))


def _laid_out(hits: Column, frames: int) -> Column:
    """One value a frame from sorted hits (_f, _v) within the frames: the run of zeros before each hit, then its value.

    Frames and hits are each gone through once.
    """
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(hits, i - 1)["_f"])
    runs = F.transform(hits, lambda h, i: F.array_append(F.array_repeat(F.lit(0), h["_f"] - before(i) - 1), h["_v"]))
    return F.concat(F.flatten(runs), F.array_repeat(F.lit(0), F.lit(frames - 1) - F.coalesce(F.try_element_at(hits, F.lit(-1))["_f"], F.lit(-1))))


def _frame_values(strokes: DataFrame, value: Column, frames: int, frame_ms: float, key: str, time: str) -> DataFrame:
    """Per sample the values of its frames, of several events of a frame the latest one's."""
    per = strokes.groupBy(key, (F.col(time) / frame_ms).cast("int").alias("_f")).agg(value.alias("_v"))
    hits = F.sort_array(F.collect_list(F.when(F.col("_f").between(0, frames - 1), F.struct("_f", "_v"))))
    return per.groupBy(key).agg(hits.alias("_hits")).select(key, _laid_out(F.col("_hits"), frames).alias("targets"))


def onset_targets(strokes: DataFrame, frames: int, frame_ms: float, key: str = "sample_id", time: str = "actual_time_ms") -> DataFrame:
    """0/1 per frame: whether an event starts in it (O-Q02)."""
    return _frame_values(strokes, F.max(F.lit(1)), frames, frame_ms, key, time)


def hand_targets(strokes: DataFrame, frames: int, frame_ms: float, key: str = "sample_id", time: str = "actual_time_ms") -> DataFrame:
    """0 none, 1 left, 2 right per frame; the later stroke of a frame wins (O-Q03)."""
    return _frame_values(strokes, F.max_by(F.when(F.col("hand") == "L", 1).otherwise(2), "position"), frames, frame_ms, key, time)


def fixed_length(df: DataFrame, column: str, n: int, fill: float = 0.0) -> DataFrame:
    """Arrays of n elements with their length and attention mask (O-Q04)."""
    x = F.col(column)
    return df.withColumn("padded", padded(x, n, F.lit(fill).cast(df.schema[column].dataType.elementType))).withColumn("mask", mask(x, n)).withColumn("length", F.least(F.size(x), F.lit(n)))


def batch_length(df: DataFrame, column: str, batch: str, fill: float = 0.0) -> DataFrame:
    """Arrays padded to the longest of their batch (O-Q05)."""
    longest = df.groupBy(batch).agg(F.max(F.size(column)).alias("_longest"))
    kind = df.schema[column].dataType.elementType
    return df.join(longest, batch).withColumn("padded", padded(F.col(column), F.col("_longest"), F.lit(fill).cast(kind))).drop("_longest")


def peak_normal(x: Column, target: float = 1.0) -> Column:
    """Scaled to a peak; silence stays as it is (O-Q06).  A level of -3 dB is target 10 ** (-3 / 20)."""
    peak = F.array_max(F.transform(x, lambda v: F.abs(v).cast("double")))
    return F.when(peak > 0, F.transform(x, lambda v: v.cast("double") / peak * target)).otherwise(F.transform(x, lambda v: v.cast("double")))


def rms(x: Column) -> Column:
    n = F.size(x)
    return F.sqrt(F.try_divide(F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")), F.nullif(n, F.lit(0))))


def rms_envelope(x: Column, frame: int, hop: int) -> Column:
    """RMS of frames every hop; an array shorter than a frame is one frame (O-Q07)."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(x) - frame), F.lit(hop))
    return F.transform(starts, lambda i: rms(F.slice(x, i + 1, F.lit(frame))))


def frame_times(x: Column, hop: int, rate: float) -> Column:
    """Start in seconds of each frame of an envelope (O-Q07)."""
    return F.transform(x, lambda v, i: i * hop / rate)


def dynamics(x: Column) -> Column:
    """Mean, SD, max, min, range and CV of an envelope (O-Q08)."""
    n = F.nullif(F.size(x), F.lit(0))
    mean = F.try_divide(F.aggregate(x, F.lit(0.0), lambda a, v: a + v), n)
    square = F.try_divide(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v), n)
    sd = F.sqrt(F.greatest(F.lit(0.0), square - mean * mean))
    top, low = F.array_max(x), F.array_min(x)
    return F.struct(mean.alias("mean"), sd.alias("sd"), top.alias("max"), low.alias("min"), (top - low).alias("range"), F.coalesce(F.try_divide(sd, mean), F.lit(0.0)).alias("cv"))


def chunk_rms(x: Column, n: int) -> Column:
    """RMS of n equal chunks (O-Q09)."""
    size = F.floor(F.size(x) / n).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: rms(F.slice(x, i * size + 1, size)))


def mono(x: Column) -> Column:
    """Mean over channels of an array of frames (O-Q10)."""
    return F.transform(x, lambda c: F.try_divide(F.aggregate(c, F.lit(0.0), lambda a, v: a + v.cast("double")), F.nullif(F.size(c), F.lit(0))))


def z_rows(m: Column) -> Column:
    """Each row of a matrix to mean zero and deviation one; constant rows to zeros (O-Q11)."""

    def one(r: Column) -> Column:
        d = dynamics(F.transform(r, lambda v: v.cast("double")))
        return F.transform(r, lambda v: F.coalesce(F.try_divide(v.cast("double") - d["mean"], F.when(d["sd"] > 1e-12, d["sd"])), F.lit(0.0)))

    return F.transform(m, one)


def parse_sticking(df: DataFrame, sticking: str, accents: str | None = None, key: str = "id") -> DataFrame:
    """Event rows of a sticking text: R, L, and B as alternating hands from R; accents where the second text has ``>`` (O-Q12).

    Spaces are stripped; rows whose texts differ in length give no events and appear in no result.
    """
    s = F.upper(F.regexp_replace(sticking, r"\s", ""))
    a = F.regexp_replace(accents, " ", "") if accents else F.repeat(F.lit("."), F.length(s))
    base = df.select(key, s.alias("_s"), a.alias("_a")).where("length(_s) = length(_a) and length(_s) > 0")
    hands = base.select(key, "_a", F.posexplode(F.split("_s", "")).alias("position", "_c")).where("_c <> ''")
    nth_b = F.sum((F.col("_c") == "B").cast("int")).over(Window.partitionBy(key).orderBy("position"))
    hand = F.when(F.col("_c").isin("R", "L"), F.col("_c")).when(nth_b % 2 == 1, "R").otherwise("L")
    accent = F.substr(F.col("_a"), F.col("position") + 1, F.lit(1)) == ">"
    return hands.select(key, "position", hand.alias("hand"), F.when(accent, "accent").otherwise("tap").alias("stroke_type"))


def parse_token(token: Column) -> Column:
    """``(R)`` grace, ``R>`` or ``>R`` accent, else tap (O-Q13)."""
    hand = F.upper(F.regexp_extract(token, "([RLrl])", 1))
    kind = F.when(token.rlike(r"^\(.*\)$"), "grace").when(token.contains(">"), "accent").otherwise("tap")
    return F.struct(hand.alias("hand"), kind.alias("stroke_type"))


def positions_of(types: Column, kind: str) -> Column:
    """Indices of one stroke type in an array of types (O-Q14)."""
    return F.filter(F.transform(types, lambda x, i: F.when(x == kind, i)), lambda i: i.isNotNull())


def mirrored(hands: Column) -> Column:
    """Swapped hands (O-Q15)."""
    return F.transform(hands, lambda h: F.translate(h, "RL", "LR"))


def expected_grid(catalogue: DataFrame, tempos: DataFrame, cycles: int) -> DataFrame:
    """Every pattern at every tempo for a number of cycles: times, velocities and grace parents (O-Q16).

    ``catalogue``: slug, beats_per_cycle, pattern array<struct<hand, stroke_type, grace_offset>>; grace notes take the
    place of their main stroke less the offset (ms).
    """
    grace = F.col("stroke_type") == "grace"
    p = catalogue.select("slug", "beats_per_cycle", F.posexplode("pattern").alias("i", "s")).select("slug", "beats_per_cycle", "i", "s.*")
    w = Window.partitionBy("slug").orderBy("i")
    main = F.sum((~grace).cast("int")).over(w)
    slots = F.sum((~grace).cast("int")).over(Window.partitionBy("slug"))
    # A grace note belongs to the next main stroke, so it shares that stroke's slot.
    p = p.select("*", F.when(grace, main).otherwise(main - 1).alias("slot"), slots.alias("slots"), F.count(F.lit(1)).over(Window.partitionBy("slug")).alias("k"))
    velocity = F.when(F.col("stroke_type") == "accent", 120).when(grace, 40).when(F.col("stroke_type") == "diddle", 75).when(F.col("stroke_type") == "buzz", 70).otherwise(65)
    cycle_ms = F.col("beats_per_cycle") * 60000.0 / F.col("tempo_bpm")
    at = (F.col("cycle") + F.try_divide("slot", "slots")) * cycle_ms
    g = p.crossJoin(F.broadcast(tempos)).withColumn("cycle", F.explode(F.sequence(F.lit(0), F.lit(cycles - 1))))
    g = g.select("slug", "tempo_bpm", "cycle", (F.col("cycle") * F.col("k") + F.col("i")).alias("position"), "hand", "stroke_type", F.when(grace, at - F.coalesce("grace_offset", F.lit(30.0))).otherwise(at).alias("intended_time_ms"), velocity.alias("intended_velocity"), grace.alias("is_grace_note"))
    after = Window.partitionBy("slug", "tempo_bpm", "cycle").orderBy("position").rowsBetween(1, Window.unboundedFollowing)
    return g.withColumn("parent", F.when(F.col("is_grace_note"), F.first(F.when(~F.col("is_grace_note"), F.col("position")), ignorenulls=True).over(after)))


def bounces(events: DataFrame, n: Column, spacing_ms: Column, decay: float = 0.85, key: str = "sample_id") -> DataFrame:
    """Each ``buzz`` event followed by n - 1 fading sub-events right behind it; their index goes on after the largest (O-Q17)."""
    e = events.withColumn("_n", F.when(F.col("stroke_type") == "buzz", n).otherwise(1)).withColumn("_gap", spacing_ms)
    parts = e.withColumn("_j", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_n"), F.lit(1)) - 1)))
    sub = F.col("_j") > 0
    whole = Window.partitionBy(key)
    order = Window.partitionBy(key).orderBy("position", "_j")
    extra = F.sum(sub.cast("int")).over(order)
    return parts.select(
        key,
        (F.row_number().over(order) - 1).alias("position"),
        F.when(sub, F.max("position").over(whole) + extra).otherwise(F.col("position")).cast("int").alias("index"),
        "stroke_type",
        (F.col("actual_time_ms") + F.col("_j") * F.col("_gap")).alias("actual_time_ms"),
        F.greatest(F.lit(1), (F.col("actual_velocity") * F.pow(F.lit(decay), "_j")).cast("int")).alias("actual_velocity"),
        (F.col("is_grace_note") | sub).alias("is_grace_note"),
        F.when(sub, F.col("position")).cast("int").alias("parent_stroke_index"),
    )


def missing_ids(wanted: DataFrame, tables: dict[str, DataFrame], key: str = "sample_id") -> DataFrame:
    """Wanted ids that a table lacks (O-Q18)."""
    out = None
    for name, df in tables.items():
        part = wanted.select(key).join(df.select(key), key, "left_anti").withColumn("table", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def json_field(column: str, path: str, kind: str = "string") -> Column:
    """A field of a JSON text column (O-Q19)."""
    return F.get_json_object(F.col(column), path).try_cast(kind)
