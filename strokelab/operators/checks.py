"""Verification (O-V*): every check is one row ``check, passed, message, details``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.operators import joins, stats


def _row(df: DataFrame, check: str, passed: Column, message: Column, **details: Column) -> DataFrame:
    """From a one-row frame of facts."""
    entries = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(F.lit(check).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"), message.alias("message"), F.create_map(*entries).alias("details"))


def text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def ids_unique(samples: DataFrame, key: str = "sample_id") -> DataFrame:
    """O-V02."""
    f = samples.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("d"))
    return _row(f, "ids_unique", F.col("n") == F.col("d"), text(F.col("d"), " distinct of ", F.col("n")), duplicates=F.col("n") - F.col("d"))


def refs(child: DataFrame, parent: DataFrame, name: str, key: str = "sample_id") -> DataFrame:
    """No child without a parent (O-V03 to O-V05)."""
    f = joins.orphans(child, parent, key).agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return _row(f, f"{name}_refs", F.col("k") == 0, text(F.col("k"), " orphan ids"), orphan_ids=F.col("k"), orphan_rows=F.col("rows"))


def velocity_range(strokes: DataFrame, column: str = "actual_velocity", low: int = 1, high: int = 127, share: float = 0.999) -> DataFrame:
    """O-V06."""
    c = F.col(column)
    f = strokes.agg(F.avg(c.between(low, high).cast("double")).alias("r"), F.min(c).alias("lo"), F.max(c).alias("hi"))
    return _row(f, "velocity_range", F.col("r") >= share, text("min ", F.col("lo"), ", max ", F.col("hi")), in_range=F.round("r", 6))


def timing_range(strokes: DataFrame, column: str = "timing_error_ms") -> DataFrame:
    """Non-grace errors: none of 500 ms or more, and mean under 100 ms or at least 80 % within 200 ms (O-V07)."""
    e = F.abs(column)
    f = strokes.where("stroke_type <> 'grace'").agg(F.max(e).alias("top"), F.avg(e).alias("mean"), F.avg((e <= 200).cast("double")).alias("r"))
    passed = (F.col("top") < 500) & ((F.col("mean") < 100) | (F.col("r") >= 0.8))
    return _row(f, "timing_range", passed, F.lit("non-grace timing errors"), max=F.round("top", 4), mean=F.round("mean", 4), within_200=F.round("r", 6))


def score_ranges(exercises: DataFrame, columns: list[str], low: float = 0.0, high: float = 100.0) -> DataFrame:
    """O-V08."""
    pairs = ", ".join(f"'{c}', `{c}_lo`, `{c}_hi`" for c in columns)
    f = exercises.agg(*[x for c in columns for x in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))]).selectExpr(f"stack({len(columns)}, {pairs}) as (c, lo, hi)")
    bad = (F.col("lo") < low) | (F.col("hi") > high)
    g = f.agg(F.count_if(bad).alias("k"), F.concat_ws(",", F.sort_array(F.collect_list(F.when(bad, F.col("c"))))).alias("names"))
    return _row(g, "score_ranges", F.col("k") == 0, text(F.col("k"), " columns out of range"), columns=F.col("names"))


def counts_match(samples: DataFrame, child: DataFrame, recorded: str, name: str, key: str = "sample_id") -> DataFrame:
    """Recorded child counts equal the actual ones, missing being zero (O-V09, O-V10)."""
    n = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    j = samples.select(key, recorded).join(n, key, "left")
    f = j.agg(F.count_if(F.coalesce(F.col(recorded), F.lit(0)) != F.coalesce("_n", F.lit(0))).alias("k"), F.count(F.lit(1)).alias("n"))
    return _row(f, f"{name}_counts_match", F.col("k") == 0, text(F.col("k"), " of ", F.col("n"), " differ"), mismatches=F.col("k"))


def tier_order(df: DataFrame, metric: str, name: str, tolerance: float = 2.0) -> DataFrame:
    """O-V11, O-V12."""
    f = stats.tier_ordering(df, [metric], tolerance).agg(F.coalesce(F.max("tiers"), F.lit(0)).alias("tiers"), F.coalesce(F.every("passed"), F.lit(True)).alias("ok"))
    return _row(f, name, F.col("ok") | (F.col("tiers") < 2), text(F.col("tiers"), " tiers compared"), tolerance=F.lit(tolerance))


def pattern_correct(events: DataFrame, patterns: DataFrame, key: str = "sample_id", value: str = "hand", order: str = "position", name: str = "pattern_correct") -> DataFrame:
    """The first cycle of each sample equals its pattern; ``patterns``: key, pattern array (O-V13)."""
    longest = patterns.agg(F.max(F.size("pattern")).alias("_longest"))  # one row
    first = events.crossJoin(F.broadcast(longest)).where(F.col(order) < F.col("_longest"))
    seen = first.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda s: s[value]).alias("_seen"))
    j = patterns.join(seen, key).withColumn("_ok", F.slice("_seen", 1, F.size("pattern")) == F.col("pattern"))
    f = j.agg(F.count_if(~F.col("_ok")).alias("k"), F.count(F.lit(1)).alias("n"))
    return _row(f, name, F.col("k") == 0, text(F.col("k"), " of ", F.col("n"), " wrong"), wrong=F.col("k"))


def aligned(a: DataFrame, b: DataFrame, tolerance_ms: float = 5.0, share: float = 0.99, key: str = "sample_id") -> DataFrame:
    """Two event lists (time_ms, velocity) agree in time and velocity for at least ``share`` of the events (O-V14)."""
    z = joins.zip_by_time(a, b, key)
    near, same = F.abs(F.col("a.time_ms") - F.col("b.time_ms")) <= tolerance_ms, F.col("a.velocity") == F.col("b.velocity")
    f = z.agg(F.count(F.lit(1)).alias("n"), F.avg(near.cast("double")).alias("t"), F.avg(same.cast("double")).alias("v"))
    return _row(f, "lists_aligned", (F.col("t") >= share) & (F.col("v") >= share), text(F.col("n"), " events compared"), in_time=F.round("t", 6), same_velocity=F.round("v", 6))


def integrity(tables: dict[str, DataFrame], required: dict[str, list[str]], keys: dict[str, list[str]], parent: str = "samples", key: str = "sample_id") -> DataFrame:
    """Required columns, nulls in them, duplicates of the key and orphans, one row per table and finding (O-V01)."""
    out = []
    for name, df in tables.items():
        missing = sorted(set(required[name]) - set(df.columns))
        present = [c for c in required[name] if c in df.columns]
        one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in present])
        nulls = reduce(lambda a, b: a + b, [F.col(f"_{c}") for c in present], F.lit(0))
        out.append(_row(one, f"{name}_columns", F.lit(not missing), F.lit(f"missing: {','.join(missing)}"), missing=F.lit(len(missing))))
        out.append(_row(one, f"{name}_nulls", nulls == 0, text(nulls, " nulls in required columns"), rows=F.col("n")))
        if all(c in df.columns for c in keys[name]):
            d = df.groupBy(*keys[name]).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("k"))
            out.append(_row(d, f"{name}_duplicates", F.col("k") == 0, text(F.col("k"), " repeated keys"), repeated=F.col("k")))
        if name != parent and key in df.columns:
            out.append(refs(df, tables[parent], name, key))
    return reduce(DataFrame.unionByName, out)


def verify_all(checks: list[DataFrame]) -> DataFrame:
    """All checks as rows (O-V15)."""
    return reduce(DataFrame.unionByName, checks)


def summary(checks: DataFrame) -> DataFrame:
    """Counts of passed and failed checks and whether all passed (O-V15)."""
    return checks.agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.coalesce(F.every("passed"), F.lit(True)).alias("all_passed"))


def triage(checks: DataFrame, fatal: list[str]) -> DataFrame:
    """Failures as issue (fatal checks) or warning, with stop or go (O-V16)."""
    severity = F.when(F.col("passed"), "ok").when(F.col("check").isin(fatal), "issue").otherwise("warning")
    t = checks.withColumn("severity", severity)
    return t.agg(F.count_if(F.col("severity") == "issue").alias("issues"), F.count_if(F.col("severity") == "warning").alias("warnings")).withColumn("decision", F.when(F.col("issues") > 0, "stop").otherwise("go"))


def report_json(checks: DataFrame) -> DataFrame:
    """One JSON document of all checks and their counts (O-V17); checks are few rows by construction."""
    rows = F.sort_array(F.collect_list(F.struct("check", "passed", "message")))
    return checks.agg(F.to_json(F.struct(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), rows.alias("checks"))).alias("report"))


def split_sound(splits: DataFrame, profiles: DataFrame, profile: str = "profile_id") -> DataFrame:
    """Each profile is in exactly one split and all are assigned (O-V18)."""
    per = splits.groupBy(profile).agg(F.countDistinct("split").alias("n"))
    f = profiles.select(profile).distinct().join(per, profile, "left").agg(F.count_if(F.col("n") > 1).alias("several"), F.count_if(F.col("n").isNull()).alias("none"))
    return _row(f, "split_sound", (F.col("several") == 0) & (F.col("none") == 0), text(F.col("several"), " in several, ", F.col("none"), " in none"), unassigned=F.col("none"))


def signal_facts(df: DataFrame, samples: str = "samples", silence_db: float = -60.0, clip: float = 0.99) -> DataFrame:
    """Silence ratio, clip ratio, RMS dB and duration of a column of arrays (O-V19 to O-V22)."""
    x, n = F.col(samples), F.size(samples)
    share = lambda f: F.try_divide(F.size(F.filter(x, f)), F.nullif(n, F.lit(0)))
    power = F.try_divide(F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")), F.nullif(n, F.lit(0)))
    return (
        df.withColumn("silence_ratio", share(lambda v: F.abs(v) < 10 ** (silence_db / 20)))
        .withColumn("clip_ratio", share(lambda v: F.abs(v) >= clip))
        .withColumn("rms_db", 20 * F.log10(F.greatest(F.sqrt(power), F.lit(1e-10))))
    )


def signal_flags(df: DataFrame, samples: str = "samples", rate: str = "sample_rate", expected: str = "expected_sec") -> DataFrame:
    """Flags per row; RMS doesn't fail a row (O-V23)."""
    d = signal_facts(df, samples).withColumn("duration_sec", F.try_divide(F.size(samples), rate))
    return (
        d.withColumn("silent", F.coalesce(F.col("silence_ratio") > 0.8, F.lit(True)))
        .withColumn("clipped", F.coalesce(F.col("clip_ratio") > 0.001, F.lit(False)))
        .withColumn("rms_outlier", ~F.col("rms_db").between(-40, -6))
        .withColumn("wrong_duration", F.coalesce(F.abs(F.col("duration_sec") - F.col(expected)) > 0.5, F.lit(True)))
        .withColumn("failed", F.col("silent") | F.col("clipped") | F.col("wrong_duration"))
    )


def signal_summary(flags: DataFrame) -> DataFrame:
    """Roll-up of the flags; RMS passes with under 5 % outliers (O-V21, O-V23)."""
    n = lambda c: F.count_if(F.col(c)).alias(c)
    return flags.agg(
        F.count(F.lit(1)).alias("n"), n("silent"), n("clipped"), n("rms_outlier"), n("wrong_duration"), n("failed"), F.avg("rms_db").alias("rms_mean"), F.stddev_pop("rms_db").alias("rms_sd"),
        (F.avg(F.col("rms_outlier").cast("double")) < 0.05).alias("rms_passed"),
    )
