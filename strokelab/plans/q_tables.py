"""Queries of filters (O-F*), joins (O-J*), profiling (O-B*) and set operations (O-U*), with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strokelab.operators import filters, gram, joins, quantiles, sampling, sequences, stats
from strokelab.plans import fixtures as fx
from strokelab.plans.q_labels import SCORES_SQL, rounded, scores, sql_round, strokes
from strokelab.schemas import TIERS

SO = "WITH " + fx.ORDERS_SQL.strip()
ST = "WITH " + fx.STROKES_SQL.strip()
SM = "WITH " + fx.SAMPLES_SQL.strip()
BOTH = ST + "," + fx.SAMPLES_SQL

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL twin."""

    def put(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


def orders(spark: SparkSession, d: str) -> DataFrame:
    return fx.scored_orders(spark, d)


# Filters


@query(SO + " SELECT sample_id FROM so WHERE augmentation_preset IS NULL OR augmentation_preset = 'none'")
def f01_clean(spark, d):
    return filters.clean(orders(spark, d)).select("sample_id")


@query(SO + " SELECT sample_id FROM so WHERE augmentation_preset IS NOT NULL AND augmentation_preset <> 'none'")
def f02_augmented(spark, d):
    return filters.augmented(orders(spark, d)).select("sample_id")


@query(SO + " SELECT sample_id FROM so WHERE skill_tier = 'advanced' AND soundfont = 'marching'")
def f03_equals(spark, d):
    return filters.equals(filters.equals(orders(spark, d), "skill_tier", "advanced"), "soundfont", "marching").select("sample_id")


@query(SO + " SELECT sample_id FROM so WHERE soundfont IN ('marching','concert')")
def f04_member(spark, d):
    return filters.member(orders(spark, d), "soundfont", ["marching", "concert"]).select("sample_id")


@query(SO + " SELECT sample_id FROM so WHERE score BETWEEN 20 AND 60 AND tempo_bpm BETWEEN 90 AND 120")
def f05_range(spark, d):
    return filters.within(filters.within(orders(spark, d), "score", 20, 60), "tempo_bpm", 90, 120).select("sample_id")


@query(SO + " SELECT sample_id FROM so WHERE contains(rudiment_slug, 'LOW')")
def f06_containing(spark, d):
    return filters.containing(orders(spark, d), "rudiment_slug", "LOW").select("sample_id")


@query(SCORES_SQL + " SELECT sample_id FROM ex WHERE timing_accuracy >= 50 AND flam_quality IS NOT NULL")
def f07_f08_applicable(spark, d):
    return filters.applicable(filters.within(scores(spark, d), "timing_accuracy", 50), "flam_quality").select("sample_id")


@query(SO + " SELECT sample_id FROM so WHERE augmentation_preset IS NULL AND skill_tier IN ('advanced','professional') AND soundfont = 'concert' AND score >= 40")
def f09_f10_conditions(spark, d):
    out = filters.where_all(orders(spark, d), {"augmentation_preset": None, "skill_tier": ["advanced", "professional"], "soundfont": "concert"})
    return filters.within(out, "score", 40).select("sample_id")


@query(SO + " SELECT sample_id FROM so WHERE score BETWEEN (SELECT quantile_cont(score, 0.01) FROM so) AND (SELECT quantile_cont(score, 0.99) FROM so)")
def f11_trim_outliers(spark, d):
    return filters.trim_outliers(orders(spark, d), "score", ranges=True).select("sample_id")


SPLIT_SQL = ", sp AS (SELECT profile_id, CASE WHEN profile_id % 10 < 7 THEN 'train' WHEN profile_id % 10 = 7 THEN 'val' WHEN profile_id % 10 = 8 THEN 'test' END AS split FROM (SELECT DISTINCT profile_id FROM so) WHERE profile_id % 10 < 9)"


def some_splits(df: DataFrame) -> DataFrame:
    m = F.col("profile_id") % 10
    return df.select("profile_id").distinct().where(m < 9).withColumn("split", F.when(m < 7, "train").when(m == 7, "val").otherwise("test"))


@query(SO + SPLIT_SQL + " SELECT sample_id FROM so SEMI JOIN (SELECT * FROM sp WHERE split = 'val') USING (profile_id)")
def f12_in_split(spark, d):
    o = orders(spark, d)
    return filters.in_split(o, some_splits(o), "validation").select("sample_id")


@query(SO + " SELECT sample_id, CASE WHEN soundfont = 'concert' THEN 'test' ELSE 'train' END AS domain_split FROM so WHERE soundfont IN ('marching','concert')")
def f13_held_out_domain(spark, d):
    return filters.held_out_domain(orders(spark, d), "soundfont", ["marching"], ["concert"]).select("sample_id", "domain_split")


@query(ST + " SELECT count(*) FILTER (stroke_type <> 'grace') AS timing, count(*) FILTER (stroke_type NOT IN ('grace','accent')) AS velocity, count(*) FILTER (is_grace_note AND flam_spacing_ms IS NOT NULL) AS grace FROM st")
def f14_f15_analysis_rows(spark, d):
    s = strokes(spark, d)
    rows = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return rows(filters.timing_rows(s), "timing").crossJoin(rows(filters.velocity_rows(s), "velocity")).crossJoin(rows(filters.grace_rows(s), "grace"))


# Joins


@query(BOTH + " SELECT skill_tier, count(*) AS n, round(avg(timing_error_ms), 6) AS mean_error FROM st JOIN sm USING (sample_id) GROUP BY 1")
def j01_with_tier(spark, d):
    s = joins.with_dimension(strokes(spark, d), fx.samples(spark, d), ["skill_tier"])
    return rounded(s.groupBy("skill_tier").agg(F.count(F.lit(1)).alias("n"), F.avg("timing_error_ms").alias("mean_error")))


@query(SCORES_SQL + " SELECT sm.sample_id, sm.tempo_bpm, round(overall_score, 6) AS overall_score, round(hand_balance, 6) AS hand_balance FROM sm LEFT JOIN (SELECT * FROM ex WHERE sample_id % 17 <> 0) USING (sample_id)")
def j02_with_scores(spark, d):
    some = scores(spark, d).where("sample_id % 17 <> 0")
    return rounded(joins.with_scores(fx.samples(spark, d), some, ["overall_score", "hand_balance", "no_such_score"]).select("sample_id", "tempo_bpm", "overall_score", "hand_balance"))


@query(SCORES_SQL + " SELECT sm.sample_id, tempo_bpm, round(e.m, 6) AS error_mean, round(overall_score, 6) AS overall_score FROM sm JOIN (SELECT sample_id, avg(timing_error_ms) AS m FROM st GROUP BY 1) e USING (sample_id) JOIN ex USING (sample_id)")
def j03_three_way(spark, d):
    out = joins.three_way(fx.samples(spark, d).drop("skill_tier"), stats.event_features(strokes(spark, d)), scores(spark, d))
    return rounded(out.select("sample_id", "tempo_bpm", "error_mean", "overall_score"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL")
def j04_with_ids(spark, d):
    ids = fx.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.with_ids(fx.table(spark, d, "lineitem"), ids, "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query(ST + " SELECT sample_id, count(*) AS n FROM st WHERE sample_id % 17 = 0 GROUP BY 1")
def j05_orphans(spark, d):
    return joins.orphans(strokes(spark, d), fx.samples(spark, d).where("sample_id % 17 <> 0"))


@query(ST + " SELECT sample_id, position, round(flam_spacing_ms, 6) AS flam_spacing_ms, buzz_count FROM st WHERE flam_spacing_ms IS NOT NULL OR buzz_count IS NOT NULL")
def j06_j07_parents(spark, d):
    return rounded(strokes(spark, d).where("flam_spacing_ms is not null or buzz_count is not null").select("sample_id", "position", "flam_spacing_ms", "buzz_count"))


@query(ST + " SELECT sample_id, CAST(floor(position / 8.0) AS INTEGER) AS measure, count(*) AS n, sum(actual_velocity) AS v FROM st GROUP BY ALL")
def j08_in_measures(spark, d):
    from strokelab.operators import labels

    s = strokes(spark, d)
    return joins.in_measures(s, labels.measure_labels(s, F.lit(8)), place="position").groupBy("sample_id", "measure").agg(F.count(F.lit(1)).alias("n"), F.sum("actual_velocity").alias("v"))


DETECTED_SQL = """, de AS (SELECT sample_id, event_id, row_number() OVER (PARTITION BY sample_id ORDER BY time_ms, event_id) - 1 AS detected, time_ms, strength FROM (
  SELECT sample_id, event_id, actual_time_ms + ((event_id * 7) % 61 - 30) AS time_ms, ((event_id * 13) % 100) / 100.0::DOUBLE AS strength FROM ev WHERE event_id % 10 <> 0))"""


def detections(spark: SparkSession, d: str) -> DataFrame:
    e = fx.events(spark, d).where("event_id % 10 <> 0")
    e = e.select("sample_id", "event_id", (F.col("actual_time_ms") + ((F.col("event_id") * 7) % 61 - 30)).alias("time_ms"), (((F.col("event_id") * 13) % 100) / 100.0).alias("strength"))
    return e.withColumn("detected", (F.row_number().over(Window.partitionBy("sample_id").orderBy("time_ms", "event_id")) - 1).cast("long"))


def truth(spark: SparkSession, d: str) -> DataFrame:
    return fx.events(spark, d).select("sample_id", F.col("position").cast("long").alias("position"), F.col("actual_time_ms").alias("time_ms"), F.col("actual_velocity").alias("velocity"))


@query("WITH " + fx.EVENTS_SQL.strip() + DETECTED_SQL + " SELECT sample_id, detected FROM de a WHERE NOT EXISTS (SELECT 1 FROM de b WHERE b.sample_id = a.sample_id AND abs(a.time_ms - b.time_ms) < 25 AND a.strength < b.strength * 0.4)")
def j09_drop_resonance(spark, d):
    return joins.drop_resonance(detections(spark, d)).select("sample_id", "detected")


_NEAR = """, c AS (SELECT e.sample_id, e.position, detected, abs(e.actual_time_ms - de.time_ms) AS distance, dense_rank() OVER (PARTITION BY e.sample_id ORDER BY e.actual_velocity DESC, e.position) AS turn FROM ev e JOIN de ON de.sample_id = e.sample_id AND abs(e.actual_time_ms - de.time_ms) < 50)"""


@query(
    "WITH RECURSIVE " + fx.EVENTS_SQL.strip() + DETECTED_SQL + _NEAR + """,
m AS (SELECT DISTINCT sample_id, 0::BIGINT AS turn, []::BIGINT[] AS taken, NULL::BIGINT AS position, NULL::BIGINT AS detected, NULL::DOUBLE AS distance FROM c UNION ALL
  SELECT sample_id, turn, CASE WHEN hit.detected IS NULL THEN taken ELSE list_append(taken, hit.detected) END, position, hit.detected, hit.distance FROM (
    SELECT m.sample_id, m.turn + 1 AS turn, any_value(m.taken) AS taken, any_value(c.position) AS position, min({'distance': c.distance, 'detected': c.detected}) FILTER (NOT list_contains(m.taken, c.detected)) AS hit
    FROM m JOIN c ON c.sample_id = m.sample_id AND c.turn = m.turn + 1 GROUP BY m.sample_id, m.turn))
SELECT sample_id, position, detected, round(distance, 6) AS distance FROM m WHERE detected IS NOT NULL"""
)
def j10_match_nearest(spark, d):
    return rounded(joins.match_nearest(truth(spark, d), detections(spark, d)))


@query(
    "WITH RECURSIVE " + fx.EVENTS_SQL.strip() + DETECTED_SQL + """,
f AS (SELECT DISTINCT sample_id, floor(actual_time_ms / 10) AS frame FROM ev),
c AS (SELECT sample_id, actual_time_ms AS t, row_number() OVER (PARTITION BY sample_id ORDER BY actual_time_ms) AS rn FROM ev SEMI JOIN f ON f.sample_id = ev.sample_id AND f.frame = greatest(0, least(7399, round_even(actual_time_ms / 1000 * 100, 0)))
  WHERE NOT EXISTS (SELECT 1 FROM de WHERE de.sample_id = ev.sample_id AND abs(de.time_ms - actual_time_ms) < 20)),
a AS (SELECT sample_id, rn, t AS last, true AS added FROM c WHERE rn = 1 UNION ALL
  SELECT c.sample_id, c.rn, CASE WHEN c.t - a.last >= 20 THEN c.t ELSE a.last END, c.t - a.last >= 20 FROM a JOIN c ON c.sample_id = a.sample_id AND c.rn = a.rn + 1)
SELECT sample_id, round(last, 6) AS time_ms, 0.5::DOUBLE AS strength FROM a WHERE added"""
)
def j11_supplement(spark, d):
    frames = (F.floor(F.col("actual_time_ms") / 10) * 10).cast("double")  # below zero is before the first one
    curve = sequences.onset_targets(fx.events(spark, d).withColumn("actual_time_ms", frames), 7400, 10.0)
    curve = curve.select("sample_id", F.transform("targets", lambda x: x * 0.5).cast("array<double>").alias("activation"))
    return rounded(joins.supplement(truth(spark, d), detections(spark, d), curve))


@query("WITH " + fx.EVENTS_SQL.strip() + """, a AS (SELECT sample_id, actual_time_ms AS t, row_number() OVER (PARTITION BY sample_id ORDER BY actual_time_ms, position) AS rn FROM ev),
b AS (SELECT sample_id, intended_time_ms AS t, row_number() OVER (PARTITION BY sample_id ORDER BY intended_time_ms, position) AS rn FROM ev WHERE sample_id % 17 <> 0)
SELECT sample_id, rn, round(a.t - b.t, 6) AS delta FROM a JOIN b USING (sample_id, rn)""")
def j12_zip_by_time(spark, d):
    e = fx.events(spark, d)
    a = e.select("sample_id", F.col("actual_time_ms").alias("time_ms"), "position")
    b = e.where("sample_id % 17 <> 0").select("sample_id", F.col("intended_time_ms").alias("time_ms"), "position")
    z = joins.zip_by_time(a, b, order_a=["time_ms", "position"], order_b=["time_ms", "position"])
    return rounded(z.select("sample_id", F.col("rn").cast("long").alias("rn"), (F.col("a.time_ms") - F.col("b.time_ms")).alias("delta")))


@query(SO + ", p AS (SELECT DISTINCT profile_id FROM so) SELECT profile_id, slug, tempo, concat_ws('_', profile_id, slug, tempo) AS job_id FROM p, (VALUES ('roll'),('drag'),('flam'),('diddle')) s(slug), (VALUES (60),(90),(120)) t(tempo)")
def j13_job_grid(spark, d):
    slugs = spark.sql("select * from values ('roll'), ('drag'), ('flam'), ('diddle') as s(slug)")
    tempos = spark.sql("select * from values 60, 90, 120 as t(tempo)")
    return joins.job_grid(orders(spark, d).select("profile_id").distinct(), slugs, tempos)


@query(SO + ", p AS (SELECT DISTINCT profile_id AS id FROM so) SELECT id FROM p WHERE id % 5 NOT IN (1, 3)")
def j14_pending(spark, d):
    ids = orders(spark, d).select(F.col("profile_id").alias("id")).distinct()
    status = ids.select("id", F.when(F.col("id") % 5 == 1, "completed").when(F.col("id") % 5 == 3, "failed").otherwise("running").alias("status"))
    return joins.pending(ids, status)


@query(SM + ", g AS (SELECT augmentation_group_id, list(sample_id ORDER BY sample_id) FILTER (augmentation_preset IS NULL OR augmentation_preset = 'none') AS c, list(sample_id ORDER BY sample_id) FILTER (augmentation_preset IS NOT NULL AND augmentation_preset <> 'none') AS augmented FROM sm GROUP BY 1) SELECT augmentation_group_id, unnest(c) AS clean, augmented FROM g WHERE len(c) > 0 AND len(augmented) > 0")
def j15_pairs(spark, d):
    s = fx.samples(spark, d)
    return joins.clean_augmented_pairs(s, filters.is_clean(s))


@query(SO + SPLIT_SQL + " SELECT sample_id, coalesce(split, 'train') AS split FROM so LEFT JOIN sp USING (profile_id)")
def j16_with_split(spark, d):
    o = orders(spark, d)
    return joins.with_split(o, some_splits(o)).select("sample_id", "split")


# Profiling

_DIST = """count({c}) AS n, round(avg({c}), 5) AS mean, round(stddev_pop({c}), 5) AS sd, round(min({c})::DOUBLE, 5) AS low, round(max({c})::DOUBLE, 5) AS high, round(quantile_cont({c}, 0.25), 5) AS p25,
round(quantile_cont({c}, 0.5), 5) AS p50, round(quantile_cont({c}, 0.75), 5) AS p75,
round(CASE WHEN count({c}) > 2 THEN coalesce((avg({c} ** 3) - 3 * avg({c}) * avg({c} ** 2) + 2 * avg({c}) ** 3) / nullif(stddev_pop({c}) ** 3, 0), 0) ELSE 0 END, 5) AS skewness,
round(CASE WHEN count({c}) > 3 THEN coalesce(kurtosis_pop({c}), 0) ELSE 0 END, 5) AS kurtosis, '{c}' AS "column" """


@query(SO + f" SELECT {_DIST.format(c='score')} FROM so")
def b01_distribution(spark, d):
    return rounded(stats.distribution(orders(spark, d), "score", ranges=True), 5)


@query(SO + f" SELECT skill_tier, {_DIST.format(c='score')} FROM so GROUP BY 1")
def b02_distribution_by_tier(spark, d):
    return rounded(stats.distribution(orders(spark, d), "score", "skill_tier", ranges=True), 5)


@query(
    SO
    + f""", dd AS (SELECT {_DIST.format(c='score')} FROM so), dt AS (SELECT {_DIST.format(c='tempo_bpm')} FROM so), bo AS (SELECT * FROM dd UNION ALL SELECT * FROM dt)
SELECT 'distribution' AS kind, "column" AS name, value_name, value FROM (SELECT "column", n::DOUBLE AS n, mean, sd, low, high, p25, p50, p75, skewness, kurtosis FROM bo) UNPIVOT (value FOR value_name IN (n, mean, sd, low, high, p25, p50, p75, skewness, kurtosis))
UNION ALL SELECT 'count', 'skill_tier', skill_tier, count(*)::DOUBLE FROM so GROUP BY skill_tier
UNION ALL SELECT 'count', 'augmentation_preset', augmentation_preset, count(*)::DOUBLE FROM so GROUP BY augmentation_preset
UNION ALL SELECT 'distinct', 'profile_id', 'distinct', count(DISTINCT profile_id)::DOUBLE FROM so UNION ALL SELECT 'distinct', 'rudiment_slug', 'distinct', count(DISTINCT rudiment_slug)::DOUBLE FROM so"""
)
def b03_dataset_stats(spark, d):
    return rounded(stats.dataset_stats(orders(spark, d), ["score", "tempo_bpm"], ["skill_tier", "augmentation_preset"], ["profile_id", "rudiment_slug"], ranges=True), 5)


@query(SO + SPLIT_SQL + " SELECT split, count(*) AS n FROM so LEFT JOIN sp USING (profile_id) GROUP BY 1")
def b04_split_counts(spark, d):
    o = orders(spark, d)
    return o.join(some_splits(o), "profile_id", "left").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


_RANK = "CASE tier WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1 WHEN 'advanced' THEN 2 ELSE 3 END"


@query(
    SCORES_SQL
    + f""", t AS (SELECT skill_tier AS tier, avg(timing_accuracy) AS timing_accuracy, avg(hand_balance) AS hand_balance FROM ex GROUP BY 1),
u AS (SELECT tier, metric, mean FROM t UNPIVOT (mean FOR metric IN (timing_accuracy, hand_balance))), v AS (SELECT *, lead(mean) OVER (PARTITION BY metric ORDER BY {_RANK}) AS nx FROM u)
SELECT metric, count(*) AS tiers, bool_and(nx IS NULL OR nx >= mean) AS passed FROM v GROUP BY 1"""
)
def b05_tier_ordering(spark, d):
    return stats.tier_ordering(scores(spark, d), ["timing_accuracy", "hand_balance"]).drop("means")


_CM = ["hand_balance", "overall_score", "timing_accuracy", "timing_consistency", "velocity_control"]


@query(SCORES_SQL + " " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, round(corr({a}, {b}), 6) AS r FROM ex" for i, a in enumerate(_CM) for b in _CM[i + 1 :]))
def b06_correlation_matrix(spark, d):
    return rounded(stats.correlation_matrix(scores(spark, d), _CM))


@query(SO + " SELECT skill_tier, quantile_cont(score, 0.01) AS p01, quantile_cont(score, 0.373) AS odd, quantile_cont(score, 0.5) AS p50, quantile_cont(score, 0.999) AS p999 FROM so GROUP BY 1".replace("quantile_cont(score, ", "round(quantile_cont(score, ").replace(") AS p", "), 6) AS p").replace(") AS odd", "), 6) AS odd"))
def b01_quantiles_by_ranges(spark, d):
    return rounded(quantiles.exact(orders(spark, d), "score", {"p01": 0.01, "odd": 0.373, "p50": 0.5, "p999": 0.999}, ["skill_tier"]))


_LINES = {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey", "l_linenumber": "l_linenumber", "l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "discount": "nullif(l_discount, 0)", "tax": "nullif(l_tax, 0)"}
_LINES_SQL = ", ".join(f"{x}::DOUBLE AS {c}" for c, x in _LINES.items())


@query(f"WITH li AS (SELECT {_LINES_SQL} FROM lineitem) " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, round(corr({a}, {b}), 6) + 0.0 AS r FROM li" for i, a in enumerate(_LINES) for b in list(_LINES)[i + 1 :]))
def b06_all_columns(spark, d):
    li = fx.table(spark, d, "lineitem").selectExpr(*[f"{x} AS {c}" for c, x in _LINES.items()])
    return gram.correlations(li).withColumn("r", sql_round(F.col("r"), 6) + 0.0)


_DETREND = """, nn AS (SELECT st.*, skill_tier, row_number() OVER (PARTITION BY sample_id ORDER BY position) - 1 AS x FROM st JOIN sm USING (sample_id) WHERE stroke_type <> 'grace'),
rs AS (SELECT *, CASE WHEN count(*) OVER p < 3 THEN timing_error_ms ELSE timing_error_ms - avg(timing_error_ms) OVER p - covar_pop(x, timing_error_ms) OVER p / nullif(var_pop(x) OVER p, 0) * (x - avg(x) OVER p) END AS residual_ms
  FROM nn WINDOW p AS (PARTITION BY sample_id))"""


@query(
    BOTH
    + _DETREND
    + """, g AS (SELECT skill_tier, avg(flam_spacing_ms) AS spacing_mean, stddev_samp(flam_spacing_ms) AS spacing_sd FROM st JOIN sm USING (sample_id) GROUP BY 1),
r AS (SELECT skill_tier, stddev_pop(residual_ms) AS v, stddev_pop(timing_error_ms) AS raw_sd, count(*) AS n FROM rs GROUP BY 1),
l(skill_tier, low, high) AS (VALUES ('professional', 5.0::DOUBLE, 15.0::DOUBLE), ('advanced', 8.0, 25.0), ('intermediate', 20.0, 45.0), ('beginner', 35.0, 80.0))
SELECT skill_tier, round(v, 6) AS value, round(raw_sd, 6) AS raw_sd, n, round(spacing_mean, 6) AS spacing_mean, round(spacing_sd, 6) AS spacing_sd, low, high, v BETWEEN low AND high AS passed FROM r JOIN g USING (skill_tier) JOIN l USING (skill_tier)"""
)
def b07_timing_literature(spark, d):
    return rounded(stats.timing_literature(strokes(spark, d), fx.samples(spark, d)))


@query(
    BOTH
    + """, pv AS (SELECT sample_id, skill_tier, CASE WHEN count(*) > 1 THEN stddev_samp(actual_velocity) / avg(actual_velocity) END AS cv FROM st JOIN sm USING (sample_id) WHERE stroke_type NOT IN ('grace','accent') GROUP BY ALL),
po AS (SELECT skill_tier, stddev_samp(actual_velocity) / avg(actual_velocity) AS pooled FROM st JOIN sm USING (sample_id) WHERE stroke_type NOT IN ('grace','accent') GROUP BY 1),
ac AS (SELECT skill_tier, avg(actual_velocity) AS am FROM st JOIN sm USING (sample_id) WHERE stroke_type = 'accent' GROUP BY 1),
r AS (SELECT skill_tier, avg(cv) AS v, stddev_pop(cv) AS cv_sd, count(cv) AS samples FROM pv GROUP BY 1),
l(skill_tier, low, high) AS (VALUES ('professional', 0.05::DOUBLE, 0.12::DOUBLE), ('advanced', 0.08, 0.18), ('intermediate', 0.12, 0.25), ('beginner', 0.18, 0.35))
SELECT skill_tier, round(v, 6) AS value, round(cv_sd, 6) AS cv_sd, round(pooled, 6) AS pooled_cv, round(am, 6) AS accent_mean, samples, low, high, v BETWEEN low AND high AS passed FROM r JOIN po USING (skill_tier) JOIN ac USING (skill_tier) JOIN l USING (skill_tier)"""
)
def b08_velocity_literature(spark, d):
    return rounded(stats.velocity_literature(strokes(spark, d), fx.samples(spark, d)))


@query(
    SCORES_SQL
    + """, wants(a, b, at_least) AS (VALUES ('timing_accuracy','timing_consistency',0.5::DOUBLE), ('hand_balance','timing_accuracy',0.3), ('accent_differentiation','velocity_control',0.15), ('overall_score','timing_accuracy',0.6), ('hand_balance','overall_score',0.4)),
c(a, b, n, r) AS (SELECT 'timing_accuracy','timing_consistency', count(*), corr(timing_accuracy, timing_consistency) FROM ex UNION ALL SELECT 'hand_balance','timing_accuracy', count(*), corr(hand_balance, timing_accuracy) FROM ex
  UNION ALL SELECT 'accent_differentiation','velocity_control', count(*), corr(accent_differentiation, velocity_control) FROM ex UNION ALL SELECT 'overall_score','timing_accuracy', count(*), corr(overall_score, timing_accuracy) FROM ex
  UNION ALL SELECT 'hand_balance','overall_score', count(*), corr(hand_balance, overall_score) FROM ex)
SELECT a, b, n, round(r, 6) AS r, at_least, r >= at_least AS passed FROM c JOIN wants USING (a, b)"""
)
def b09_expected_correlations(spark, d):
    return rounded(stats.expected_correlations(scores(spark, d)))


@query(
    SCORES_SQL
    + """, u AS (SELECT skill_tier AS g, metric, x FROM ex UNPIVOT (x FOR metric IN (timing_accuracy, hand_balance, overall_score))), a AS (SELECT metric, g, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM u GROUP BY ALL),
t AS (SELECT metric, count(*) AS k, sum(n) AS n, sum(n * m * m) - sum(n * m) ** 2 / sum(n) AS b, sum(n * v) AS w FROM a GROUP BY 1)
SELECT metric, k AS "groups", n::BIGINT AS n, round((b / (k - 1)) / (w / (n - k)), 5) AS f, k - 1 AS df_between, (n - k)::BIGINT AS df_within FROM t"""
)
def b10_anova(spark, d):
    return rounded(stats.anova(scores(spark, d), ["timing_accuracy", "hand_balance", "overall_score"]), 5)


@query(
    "SELECT part, count(*) AS checks, round(avg(passed::INTEGER) * 100, 6) AS pass_rate FROM ("
    + " UNION ALL ".join(f"SELECT '{part}' AS part, passed FROM ({SQL[q]})" for part, q in (("literature", "b07_timing_literature"), ("literature", "b08_velocity_literature"), ("correlation", "b09_expected_correlations")))
    + ") GROUP BY 1"
)
def b11_realism_report(spark, d):
    s, m, x = strokes(spark, d), fx.samples(spark, d), scores(spark, d)
    return rounded(stats.realism_report(stats.timing_literature(s, m), stats.velocity_literature(s, m), stats.expected_correlations(x)))


@query(SO + " SELECT rudiment_slug, count(*) AS n, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS sd, " + ", ".join(f"count(*) FILTER (skill_tier = '{t}') AS {t}" for t in TIERS) + " FROM so GROUP BY 1")
def b12_per_group_summary(spark, d):
    return rounded(stats.per_group_summary(orders(spark, d), "rudiment_slug", "score"))


@query(SO + " SELECT count(*) AS samples, count(DISTINCT profile_id) AS profiles, count(DISTINCT rudiment_slug) AS \"groups\", round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS sd, round(sum(tempo_bpm) / 3600.0, 6) AS hours FROM so")
def b13_overview(spark, d):
    return rounded(stats.overview(orders(spark, d), "score", "tempo_bpm"))


@query("SELECT * FROM (VALUES ('9-NEVER')) t(rudiment_slug)")
def b14_u02_missing(spark, d):
    expected = orders(spark, d).select("rudiment_slug").distinct().unionByName(spark.sql("select '9-NEVER' as rudiment_slug"))
    return stats.missing_values(orders(spark, d), "rudiment_slug", expected)


@query(SO + " SELECT skill_tier, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM so), 6)::DOUBLE AS percent, (CASE skill_tier WHEN 'professional' THEN 1 WHEN 'advanced' THEN 2 WHEN 'intermediate' THEN 3 ELSE 4 END)::INTEGER AS place FROM so GROUP BY 1")
def b15_l03_shares(spark, d):
    return rounded(stats.shares(orders(spark, d), "skill_tier", ["professional", "advanced", "intermediate", "beginner"]))


@query(SO + " " + " UNION ALL ".join(f"SELECT {c} AS value, count(*) AS n, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS sd, round(min(score), 6) AS low, round(max(score), 6) AS high, '{c}' AS \"column\" FROM so GROUP BY 1" for c in ("skill_tier", "soundfont", "augmentation_preset")))
def b16_subset_summary(spark, d):
    return rounded(stats.subset_summary(orders(spark, d), ["skill_tier", "soundfont", "augmentation_preset"], "score"))


@query(SO + " SELECT skill_tier, count(score) AS n, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS sd, round(min(score), 6) AS low, round(quantile_cont(score, 0.25), 6) AS p25, round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.75), 6) AS p75, round(max(score), 6) AS high FROM so GROUP BY 1")
def b17_described(spark, d):
    return rounded(stats.described(orders(spark, d), "score", "skill_tier", ranges=True))


@query(ST + " SELECT sample_id, round(avg(timing_error_ms), 6) AS error_mean, round(stddev_samp(timing_error_ms), 6) AS error_sd, round(max(abs(timing_error_ms)), 6) AS error_max, round(avg(actual_velocity), 6) AS velocity_mean, round(stddev_samp(actual_velocity), 6) AS velocity_sd, max(actual_velocity) AS velocity_max, count(*) AS n FROM st GROUP BY 1")
def b18_event_features(spark, d):
    return rounded(stats.event_features(strokes(spark, d)))


@query(ST + " SELECT sample_id, CAST(floor(position / 8.0) AS INTEGER) AS measure, count(*) AS n, count(*) FILTER (is_accent) AS accents, count(*) FILTER (is_grace_note) AS graces, round(avg(CASE WHEN hand = 'R' THEN 100.0 ELSE 0 END), 6)::DOUBLE AS right_percent FROM st GROUP BY ALL")
def b19_measure_summary(spark, d):
    s = strokes(spark, d).withColumn("measure", F.floor(F.col("position") / 8).cast("int"))
    return rounded(s.groupBy("sample_id", "measure").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_accent").alias("accents"), F.count_if("is_grace_note").alias("graces"), F.avg(F.when(F.col("hand") == "R", 100.0).otherwise(0.0)).alias("right_percent")))


@query(SO + ", e AS (SELECT skill_tier, min(score) AS lo, max(score) AS hi FROM so GROUP BY 1) SELECT skill_tier, CAST(least(9, floor((score - lo) * 10 / (hi - lo))) AS INTEGER) AS bin, count(*) AS n, round(any_value(lo), 6) AS lo, round(any_value(hi), 6) AS hi FROM so JOIN e USING (skill_tier) GROUP BY ALL")
def b20_histogram(spark, d):
    return rounded(stats.histogram(orders(spark, d), "score", 10, "skill_tier"))


@query(SO + """, q AS (SELECT skill_tier, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.75) AS q3 FROM so GROUP BY 1)
SELECT skill_tier, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3, round(min(score) FILTER (score >= q1 - 1.5 * (q3 - q1)), 6) AS low_whisker, round(max(score) FILTER (score <= q3 + 1.5 * (q3 - q1)), 6) AS high_whisker,
count(*) FILTER (score < q1 - 1.5 * (q3 - q1) OR score > q3 + 1.5 * (q3 - q1)) AS outliers FROM so JOIN q USING (skill_tier) GROUP BY 1""")
def b21_box_plot(spark, d):
    return rounded(stats.box_plot(orders(spark, d), "score", "skill_tier", ranges=True))


@query(SO + " SELECT skill_tier, count(*) AS n, round((SELECT count(*) FROM so) / (4.0 * count(*)), 6)::DOUBLE AS weight FROM so GROUP BY 1")
def b22_class_weights(spark, d):
    return rounded(stats.class_weights(orders(spark, d), "skill_tier"))


@query(SM + " SELECT augmentation_group_id, list(sample_id || ':' || coalesce(augmentation_preset, '-') ORDER BY sample_id) AS members FROM sm GROUP BY 1")
def b23_variants(spark, d):
    v = stats.variants(fx.samples(spark, d), "augmentation_group_id", "sample_id", "augmentation_preset")
    return v.withColumn("members", F.transform("members", lambda m: F.concat_ws(":", m["sample_id"].cast("string"), F.coalesce(m["augmentation_preset"], F.lit("-")))))


@query("SELECT c.category, coalesce(list(p_brand ORDER BY p_brand) FILTER (p_brand IS NOT NULL), []) AS slugs FROM (VALUES ('ECONOMY'),('STANDARD'),('NOTHING')) c(category) LEFT JOIN (SELECT DISTINCT p_type, p_brand FROM part) ON p_type = category GROUP BY 1")
def b24_catalogue_groups(spark, d):
    catalogue = fx.table(spark, d, "part").select(F.col("p_type").alias("category"), F.col("p_brand").alias("slug")).distinct()
    return stats.catalogue_groups(catalogue, spark.sql("select * from values ('ECONOMY'), ('STANDARD'), ('NOTHING') as t(category)"))


@query(SO + SPLIT_SQL + ", t AS (SELECT DISTINCT profile_id, skill_tier FROM so) SELECT s.split, r.skill_tier, count(t.profile_id) AS n FROM (VALUES ('train'),('val'),('test')) s(split) CROSS JOIN (VALUES ('beginner'),('intermediate'),('advanced'),('professional')) r(skill_tier) LEFT JOIN (SELECT * FROM sp JOIN t USING (profile_id)) t ON t.split = s.split AND t.skill_tier = r.skill_tier GROUP BY ALL")
def b25_split_stats(spark, d):
    o = orders(spark, d)
    return sampling.split_stats(some_splits(o).join(o.select("profile_id", "skill_tier").distinct(), "profile_id"))


@query(SO + ", p AS (SELECT DISTINCT profile_id AS id FROM so), s AS (SELECT count(*) AS total, count(*) FILTER (id % 5 = 1) AS completed, count(*) FILTER (id % 5 = 3) AS failed FROM p) SELECT total, completed, failed, total - completed - failed AS remaining, round(completed * 100.0 / total, 6)::DOUBLE AS percent, round(completed / 60.0, 6)::DOUBLE AS rate, round((total - completed - failed) / (completed / 60.0), 6)::DOUBLE AS eta_sec FROM s")
def b26_progress(spark, d):
    ids = orders(spark, d).select(F.col("profile_id").alias("id")).distinct()
    status = ids.select("id", F.when(F.col("id") % 5 == 1, "completed").when(F.col("id") % 5 == 3, "failed").otherwise("running").alias("status"), F.lit(1).alias("updated_at"))
    return rounded(stats.progress(ids, status, elapsed_sec=60.0))


# Set operations


@query("SELECT c_custkey AS k, 'c' AS side FROM customer UNION ALL SELECT s_suppkey, 's' FROM supplier")
def u01_union(spark, d):
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("c").alias("side"))
    return c.unionByName(fx.table(spark, d, "supplier").select(F.lit("s").alias("side"), F.col("s_suppkey").alias("k")))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def u03_intersect(spark, d):
    return fx.table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(fx.table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


def queries() -> dict:
    return Q


def oracle_sql() -> dict[str, str]:
    return SQL
