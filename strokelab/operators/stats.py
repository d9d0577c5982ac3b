"""Profiling and statistics (O-B*): aggregates per column and tier, correlations, ANOVA, literature comparison."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strokelab.operators import quantiles
from strokelab.schemas import TIERS


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _with_exact(df: DataFrame, aggregated: DataFrame, column: str, by: str | None, probs: dict[str, float]) -> DataFrame:
    """Aggregates of each group with its exact quantiles, found by ranges, in the place of columns of these names."""
    found = quantiles.exact(df, column, probs, [by] if by else [])
    rest = aggregated.drop(*probs)
    joined = rest.join(found.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by"))).drop("_by") if by else rest.crossJoin(F.broadcast(found))  # one row
    return joined.select(*aggregated.columns)


def distribution(df: DataFrame, column: str, by: str | None = None, name: str | None = None, approx: bool = False, ranges: bool = False) -> DataFrame:
    """n, mean, sd, min, max, p25, p50, p75, skewness and excess kurtosis of a column (O-B01, O-B02).

    Percentiles are exact.  Spark's own keep a group's distinct values in one buffer; for groups of very many ``ranges`` finds
    the same numbers by narrowing ranges in several passes, and ``approx`` takes approximate ones in one.
    """
    x = F.col(column)
    part = (lambda p: F.percentile_approx(x, F.lit(p), F.lit(10_000))) if approx else (lambda p: F.lit(None)) if ranges else (lambda p: F.percentile(x, F.lit(p)))
    n = F.count(x)
    out = df.groupBy(*([by] if by else [])).agg(
        n.alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("sd"),
        F.min(x).cast("double").alias("low"),
        F.max(x).cast("double").alias("high"),
        part(0.25).alias("p25"),
        part(0.5).alias("p50"),
        part(0.75).alias("p75"),
        F.when(n > 2, F.coalesce(F.skewness(x), F.lit(0.0))).otherwise(0.0).alias("skewness"),
        F.when(n > 3, F.coalesce(F.kurtosis(x), F.lit(0.0))).otherwise(0.0).alias("kurtosis"),
    )
    if ranges:
        out = _with_exact(df, out, column, by, QUARTILES)
    return out.withColumn("column", F.lit(name or column))


def dataset_stats(df: DataFrame, numeric: list[str], categorical: list[str], distinct: list[str], ranges: bool = False) -> DataFrame:
    """Tidy rows (kind, name, value_name, value): distributions, category counts and distinct counts (O-B03)."""
    parts = []
    for c in numeric:
        d = distribution(df, c, ranges=ranges)
        fields = [f for f in d.columns if f != "column"]
        pairs = ", ".join(f"'{f}', cast({f} as double)" for f in fields)
        parts.append(d.selectExpr("'distribution' as kind", "column as name", f"stack({len(fields)}, {pairs}) as (value_name, value)"))
    for c in categorical:
        parts.append(df.groupBy(F.col(c).cast("string").alias("value_name")).agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("count").alias("kind"), F.lit(c).alias("name"), "value_name", "value"))
    if distinct:
        pairs = ", ".join(f"'{c}', cast({c} as double)" for c in distinct)
        parts.append(df.agg(*[F.countDistinct(c).alias(c) for c in distinct]).selectExpr("'distinct' as kind", f"stack({len(distinct)}, {pairs}) as (name, value)").select("kind", "name", F.lit("distinct").alias("value_name"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tier_rank(tier: Column) -> Column:
    """0 for the lowest tier; null for an unknown one."""
    return F.nullif(F.array_position(F.array(*map(F.lit, TIERS)), tier), F.lit(0)) - 1


def tier_ordering(df: DataFrame, metrics: list[str], tolerance: float = 0.0, tier: str = "skill_tier") -> DataFrame:
    """Per metric: whether tier means rise with the tier, up to a tolerance; fewer than two tiers pass (O-B05, O-V11, O-V12)."""
    means = df.where(tier_rank(F.col(tier)).isNotNull()).groupBy(tier).agg(*[F.avg(m).alias(m) for m in metrics])
    pairs = ", ".join(f"'{m}', `{m}`" for m in metrics)
    tall = means.selectExpr(f"`{tier}` as tier", f"stack({len(metrics)}, {pairs}) as (metric, mean)")
    # At most one row per metric and tier here.
    nxt = F.lead("mean").over(Window.partitionBy("metric").orderBy(tier_rank(F.col("tier"))))
    return (
        tall.withColumn("_next", nxt)
        .groupBy("metric")
        .agg(
            F.count(F.lit(1)).alias("tiers"),
            F.coalesce(F.every(F.col("_next").isNull() | (F.col("_next") >= F.col("mean") - tolerance)), F.lit(True)).alias("passed"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("tier", F.round("mean", 6))))).alias("means"),
        )
    )


def correlation(a: Column, b: Column) -> Column:
    """Pearson's r over pairs where both are known; null for a constant column."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """All pairs a < b as rows (a, b, n, r), from one aggregation (O-B06); ``gram.correlations`` takes hundreds of columns."""
    pairs = list(combinations(columns, 2))
    flat = df.agg(
        *[correlation(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
        *[F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"n{i}") for i, (a, b) in enumerate(pairs)],
    )
    entries = ", ".join(f"'{a}', '{b}', n{i}, r{i}" for i, (a, b) in enumerate(pairs))
    return flat.selectExpr(f"stack({len(pairs)}, {entries}) as (a, b, n, r)")


def detrended(strokes: DataFrame, error: str = "timing_error_ms", key: str = "sample_id", order: str = "position", least: int = 3) -> DataFrame:
    """Residuals of a line fitted to each sample's errors by row number; samples under ``least`` events keep them raw (O-W03)."""
    w = Window.partitionBy(key)
    x = F.row_number().over(w.orderBy(order)) - 1
    s = strokes.withColumn("_x", x.cast("double"))
    n = F.count(error).over(w)
    slope = F.try_divide(F.covar_pop("_x", error).over(w), F.var_pop("_x").over(w))
    line = F.avg(error).over(w) + slope * (F.col("_x") - F.avg("_x").over(w))
    return s.withColumn("residual_ms", F.when(n < least, F.col(error)).otherwise(F.col(error) - line)).drop("_x")


#: Published ranges of detrended timing spread (ms) and of velocity variation per tier.
TIMING_RANGES = {"professional": (5.0, 15.0), "advanced": (8.0, 25.0), "intermediate": (20.0, 45.0), "beginner": (35.0, 80.0)}
VELOCITY_RANGES = {"professional": (0.05, 0.12), "advanced": (0.08, 0.18), "intermediate": (0.12, 0.25), "beginner": (0.18, 0.35)}
#: Metric pairs with the least correlation expected of them.
EXPECTED_CORRELATIONS = (
    ("timing_accuracy", "timing_consistency", 0.5),
    ("timing_accuracy", "hand_balance", 0.3),
    ("velocity_control", "accent_differentiation", 0.15),
    ("timing_accuracy", "overall_score", 0.6),
    ("hand_balance", "overall_score", 0.4),
)


def _range(tier: Column, ranges: dict, i: int) -> Column:
    out = F.lit(None).cast("double")
    for t, r in ranges.items():
        out = F.when(tier == t, r[i]).otherwise(out)
    return out


def timing_literature(strokes: DataFrame, samples: DataFrame, key: str = "sample_id", tier: str = "skill_tier") -> DataFrame:
    """Per tier: spread of detrended errors against its range, raw spread, count, grace spacing (O-B07)."""
    tiers = samples.select(key, tier)
    main = detrended(strokes.where("stroke_type <> 'grace'"), key=key).join(tiers, key)
    out = main.groupBy(tier).agg(F.stddev_pop("residual_ms").alias("value"), F.stddev_pop("timing_error_ms").alias("raw_sd"), F.count(F.lit(1)).alias("n"))
    grace = strokes.where("flam_spacing_ms is not null").join(tiers, key).groupBy(tier).agg(F.avg("flam_spacing_ms").alias("spacing_mean"), F.stddev_samp("flam_spacing_ms").alias("spacing_sd"))
    out = out.join(grace, tier, "left").withColumn("low", _range(F.col(tier), TIMING_RANGES, 0)).withColumn("high", _range(F.col(tier), TIMING_RANGES, 1))
    return out.withColumn("passed", F.col("value").between(F.col("low"), F.col("high")))


def velocity_literature(strokes: DataFrame, samples: DataFrame, key: str = "sample_id", tier: str = "skill_tier") -> DataFrame:
    """Per tier: mean and spread of per-sample velocity variation of plain strokes, pooled variation, accent mean (O-B08)."""
    v = F.col("actual_velocity").cast("double")
    plain = F.when(~F.col("stroke_type").isin("grace", "accent"), v)
    per = strokes.groupBy(key).agg(
        F.when((F.count(plain) > 1) & (F.avg(plain) > 0), F.try_divide(F.stddev_samp(plain), F.avg(plain))).alias("cv"),
        F.count(plain).alias("n"),
        F.sum(plain).alias("s"),
        F.sum(plain * plain).alias("q"),
        F.sum(F.when(F.col("stroke_type") == "accent", v)).alias("a"),
        F.count_if(F.col("stroke_type") == "accent").alias("na"),
    )
    n, mean = F.sum("n"), F.try_divide(F.sum("s"), F.sum("n"))
    var = F.try_divide(F.sum("q") - n * mean * mean, F.nullif(n - 1, F.lit(0)))
    out = per.join(samples.select(key, tier), key).groupBy(tier).agg(
        F.avg("cv").alias("value"),
        F.stddev_pop("cv").alias("cv_sd"),
        F.try_divide(F.sqrt(F.greatest(F.lit(0.0), var)), mean).alias("pooled_cv"),
        F.try_divide(F.sum("a"), F.nullif(F.sum("na"), F.lit(0))).alias("accent_mean"),
        F.count("cv").alias("samples"),
    )
    out = out.where("value is not null").withColumn("low", _range(F.col(tier), VELOCITY_RANGES, 0)).withColumn("high", _range(F.col(tier), VELOCITY_RANGES, 1))
    return out.withColumn("passed", F.col("value").between(F.col("low"), F.col("high")))


def expected_correlations(df: DataFrame, expected=EXPECTED_CORRELATIONS, tier: str = "skill_tier", least: int = 10, relaxed: float = -0.3) -> DataFrame:
    """Each expected pair with its r; under three tiers the bound is relaxed; too few pairs give no row (O-B09)."""
    columns = sorted({c for a, b, _ in expected for c in (a, b)})
    found = correlation_matrix(df, columns)
    tiers = df.agg(F.countDistinct(tier).alias("tiers"))  # one row
    rows = ", ".join(f"('{min(a, b)}', '{max(a, b)}', {float(r)})" for a, b, r in expected)
    want = df.sparkSession.sql(f"select * from values {rows} as t(a, b, at_least)").withColumn("at_least", F.col("at_least").cast("double"))
    return (
        found.join(F.broadcast(want), ["a", "b"])
        .crossJoin(F.broadcast(tiers))
        .where(F.col("n") >= least)
        .withColumn("passed", F.coalesce(F.col("r") >= F.when(F.col("tiers") < 3, relaxed).otherwise(F.col("at_least")), F.lit(False)))
        .drop("tiers")
    )


def anova(df: DataFrame, metrics: list[str], by: str = "skill_tier") -> DataFrame:
    """One-way F per metric from group counts, sums and squares (O-B10)."""
    pairs = ", ".join(f"'{m}', cast(`{m}` as double)" for m in metrics)
    tall = df.selectExpr(f"`{by}` as g", f"stack({len(metrics)}, {pairs}) as (metric, x)").where("x is not null and g is not null")
    g = tall.groupBy("metric", "g").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    t = g.groupBy("metric").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("m")).alias("s"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("q"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
    )
    between = F.col("q") - F.try_divide(F.col("s") * F.col("s"), F.col("n"))
    f = F.try_divide(between / F.nullif(F.col("k") - 1, F.lit(0)), F.col("within") / F.nullif(F.col("n") - F.col("k"), F.lit(0)))
    return t.select("metric", F.col("k").alias("groups"), "n", f.alias("f"), (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"))


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f): the regularised incomplete beta function by its continued fraction; for scalars of a report."""
    if f <= 0:
        return 1.0
    a, b, x = d2 / 2, d1 / 2, d2 / (d2 + d1 * f)

    def fraction(a: float, b: float, x: float) -> float:
        c, d, out = 1.0, 1 / max(1e-300, 1 - (a + b) * x / (a + 1)), 0.0
        out = d
        for m in range(1, 500):
            for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 / (1 + numerator * d or 1e-300)
                c = 1 + numerator / c or 1e-300
                out *= c * d
            if abs(c * d - 1) < 1e-14:
                break
        return out

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


def realism_report(timing: DataFrame, velocity: DataFrame, correlations: DataFrame) -> DataFrame:
    """Pass rates of the literature and correlation checks as rows (O-B11)."""
    part = lambda df, group: df.select(F.lit(group).alias("part"), "passed")
    rows = part(timing, "literature").unionByName(part(velocity, "literature")).unionByName(part(correlations, "correlation"))
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("checks"), (F.avg(F.coalesce("passed", F.lit(False)).cast("double")) * 100).alias("pass_rate"))


def per_group_summary(df: DataFrame, group: str, metric: str, pivot: str = "skill_tier", values=TIERS) -> DataFrame:
    """Per group: count, mean, sample SD, and a count for each pivot value (O-B12)."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("sd"), *[F.count_if(F.col(pivot) == v).alias(v) for v in values]
    )


def overview(df: DataFrame, metric: str, duration_sec: str | None = None, profile: str = "profile_id", group: str = "rudiment_slug") -> DataFrame:
    """One row of totals (O-B13)."""
    hours = F.sum(duration_sec) / 3600 if duration_sec else F.lit(None).cast("double")
    return df.agg(F.count(F.lit(1)).alias("samples"), F.countDistinct(profile).alias("profiles"), F.countDistinct(group).alias("groups"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("sd"), hours.alias("hours"))


def missing_values(df: DataFrame, column: str, expected: DataFrame) -> DataFrame:
    """Expected values that never occur (O-B14, O-U02)."""
    return expected.join(df.select(column).distinct(), column, "left_anti")


def shares(df: DataFrame, column: str, order: list[str] | None = None) -> DataFrame:
    """Count and percentage of each value; values of a fixed order first (O-B15, O-L03)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))  # one row
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(column)), F.lit(0)), F.lit(len(order) + 1)) if order else F.lit(0)
    return counts.crossJoin(F.broadcast(total)).select(column, "n", (F.col("n") / F.col("_t") * 100).alias("percent"), rank.cast("int").alias("place")).orderBy("place", column)


def subset_summary(df: DataFrame, columns: list[str], metric: str) -> DataFrame:
    """Counts by each column, null as its own key, beside the metric's mean, SD, minimum and maximum (O-B16)."""
    stats = [F.count(F.lit(1)).alias("n"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("sd"), F.min(metric).alias("low"), F.max(metric).alias("high")]
    out = None
    for c in columns:
        part = df.groupBy(F.col(c).cast("string").alias("value")).agg(*stats).withColumn("column", F.lit(c))
        out = part if out is None else out.unionByName(part)
    return out


def described(df: DataFrame, metric: str, by: str, ranges: bool = False) -> DataFrame:
    """count, mean, sample SD, minimum, quartiles, maximum by group (O-B17); ``ranges`` as in ``distribution``."""
    q = (lambda p: F.lit(None)) if ranges else (lambda p: F.percentile(F.col(metric), F.lit(p)))
    out = df.groupBy(by).agg(F.count(metric).alias("n"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("sd"), F.min(metric).alias("low"), q(0.25).alias("p25"), q(0.5).alias("p50"), q(0.75).alias("p75"), F.max(metric).alias("high"))
    return _with_exact(df, out, metric, by, QUARTILES) if ranges else out


def event_features(strokes: DataFrame, key: str = "sample_id") -> DataFrame:
    """Per-sample features of its events (O-B18)."""
    e, v = F.col("timing_error_ms"), F.col("actual_velocity")
    return strokes.groupBy(key).agg(
        F.avg(e).alias("error_mean"), F.stddev_samp(e).alias("error_sd"), F.max(F.abs(e)).alias("error_max"), F.avg(v).alias("velocity_mean"), F.stddev_samp(v).alias("velocity_sd"), F.max(v).alias("velocity_max"), F.count(F.lit(1)).alias("n")
    )


def histogram(df: DataFrame, column: str, bins: int, by: str) -> DataFrame:
    """Counts in equal bins between each group's minimum and maximum, the right edge inclusive (O-B20)."""
    ends = df.groupBy(by).agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    x = F.col(column)
    place = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide((x - F.col("lo")) * bins, F.col("hi") - F.col("lo")), F.lit(0.0))))
    return df.join(ends, by).groupBy(by, place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))


def box_plot(df: DataFrame, column: str, by: str, ranges: bool = False) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and the number of outliers (O-B21); ``ranges`` as in ``distribution``."""
    x = F.col(column)
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = quantiles.exact(df, column, probs, [by]) if ranges else df.groupBy(by).agg(*[F.percentile(x, F.lit(p)).alias(n) for n, p in probs.items()])
    quartiles = quartiles.withColumnRenamed(by, "_by")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return df.join(quartiles, F.col(by).eqNullSafe(F.col("_by"))).groupBy(by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"), F.min(F.when(inside, x)).alias("low_whisker"), F.max(F.when(inside, x)).alias("high_whisker"), F.count_if(~inside).alias("outliers")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (classes * count) for each class (O-B22)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"), F.count(F.lit(1)).alias("_k"))  # one row
    return counts.crossJoin(F.broadcast(total)).select(label, "n", (F.col("_t") / (F.col("_k") * F.col("n"))).alias("weight"))


def variants(df: DataFrame, group: str, key: str, preset: str) -> DataFrame:
    """Members of each variant group with their preset, sorted (O-B23)."""
    return df.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(F.col(key), F.col(preset)))).alias("members"))


def catalogue_groups(catalogue: DataFrame, categories: DataFrame, category: str = "category", slug: str = "slug") -> DataFrame:
    """Slugs of each category, empty categories included (O-B24)."""
    g = catalogue.groupBy(category).agg(F.sort_array(F.collect_list(slug)).alias("slugs"))
    return categories.join(g, category, "left").withColumn("slugs", F.coalesce("slugs", F.array().cast("array<string>")))


def progress(expected: DataFrame, status: DataFrame, key: str = "id", elapsed_sec: float = 0.0) -> DataFrame:
    """completed, failed, remaining, percent, rate and seconds to go, one row (O-B26)."""
    s = status.groupBy(key).agg(F.max_by("status", "updated_at").alias("status"))
    j = expected.select(key).distinct().join(s, key, "left")
    c = j.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"))
    left = F.col("total") - F.col("completed") - F.col("failed")
    rate = F.try_divide("completed", F.lit(elapsed_sec))
    return c.select("*", left.alias("remaining"), (F.try_divide("completed", "total") * 100).alias("percent"), rate.alias("rate"), F.try_divide(left, rate).alias("eta_sec"))
