"""Queries of scalars (O-P*), windows (O-W*), sequences (O-Q*), sampling (O-L*) and checks (O-V*), with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from strokelab.functions import scalars, table_functions
from strokelab.operators import audit, checks, labels, sampling, sequences, stats, windows
from strokelab.plans import fixtures as fx
from strokelab.plans.q_labels import SCORES_SQL, rounded, scores, sql_round, strokes
from strokelab.plans.q_tables import BOTH, DETECTED_SQL, SM, SO, SPLIT_SQL, ST, detections, orders, some_splits
from strokelab.schemas import TIERS
from strokelab.sources.shared import written

Q: dict = {}
SQL: dict[str, str] = {}
EV = "WITH " + fx.EVENTS_SQL.strip()


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL twin."""

    def put(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


# Scalars

_ID = """CASE skill_tier WHEN 'beginner' THEN 'beg' WHEN 'intermediate' THEN 'int' WHEN 'advanced' THEN 'adv' ELSE 'pro' END || lpad((profile_id % 1000)::VARCHAR, 3, '0') || '_' || lower(replace(rudiment_slug, ' ', '_')) || '_' || tempo_bpm || 'bpm_' || substr(replace(soundfont, '_', ''), 1, 8) || '_' || coalesce(replace(augmentation_preset, '_', ''), 'clean')"""


def _sid():
    return scalars.sample_id(F.col("skill_tier"), F.col("profile_id") % 1000, F.lower(F.replace("rudiment_slug", F.lit(" "), F.lit("_"))), F.col("tempo_bpm"), F.col("soundfont"), F.col("augmentation_preset"))


@query(SO + f" SELECT sample_id, {_ID} AS sid FROM so")
def p01_sample_id(spark, d):
    return orders(spark, d).select("sample_id", _sid().alias("sid"))


@query(SO + " SELECT sample_id, CASE skill_tier WHEN 'beginner' THEN 'beg' WHEN 'intermediate' THEN 'int' WHEN 'advanced' THEN 'adv' ELSE 'pro' END AS tier, (profile_id % 1000)::INTEGER AS number, lower(replace(rudiment_slug, ' ', '_')) AS slug, tempo_bpm, substr(replace(soundfont, '_', ''), 1, 8) AS soundfont, coalesce(replace(augmentation_preset, '_', ''), 'clean') AS preset FROM so")
def p02_parse_sample_id(spark, d):
    return orders(spark, d).select("sample_id", scalars.parse_sample_id(_sid()).alias("f")).select("sample_id", "f.*")


@query(SO + " SELECT sample_id, substr(profile_id::VARCHAR, 1, 8) || '_' || rudiment_slug || '_' || tempo_bpm AS group_id FROM so")
def p03_group_id(spark, d):
    return orders(spark, d).select("sample_id", scalars.group_id(F.col("profile_id"), F.col("rudiment_slug"), F.col("tempo_bpm")).alias("group_id"))


@query(SO + " SELECT sample_id, round(CASE WHEN tempo_bpm < 80 THEN 1 + (80 - tempo_bpm) * 0.01 WHEN tempo_bpm > 140 THEN 1 + (tempo_bpm - 140) * 0.01 ELSE 1 END, 6)::DOUBLE AS penalty, round(240.0 / tempo_bpm, 6)::DOUBLE AS duration, greatest(1, round_even(20 / (240.0::DOUBLE / tempo_bpm), 0))::INTEGER AS cycles, round(8 / 4.0, 6)::DOUBLE AS per_beat FROM so")
def p07_p08_tempo(spark, d):
    t = F.col("tempo_bpm")
    dur = scalars.duration_sec(F.lit(4.0), t)
    return rounded(orders(spark, d).select("sample_id", scalars.tempo_penalty(t, F.lit(80), F.lit(140)).alias("penalty"), dur.alias("duration"), scalars.cycles_for(F.lit(20.0), dur).alias("cycles"), scalars.strokes_per_beat(F.lit(8), F.lit(4.0)).alias("per_beat")))


@query(EV + " SELECT sample_id, position, trunc(actual_time_ms * 22050 / 1000)::INTEGER AS idx, round(greatest(-1, least(1, (actual_time_ms - intended_time_ms) / 50)), 6) AS error FROM ev")
def p09_p10_alignment(spark, d):
    e = fx.events(spark, d)
    return rounded(e.select("sample_id", "position", scalars.sample_index(F.col("actual_time_ms"), 22050).alias("idx"), scalars.normal_error(F.col("actual_time_ms") - F.col("intended_time_ms")).alias("error")))


@query(SO + " SELECT sample_id, (CASE skill_tier WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1 WHEN 'advanced' THEN 2 ELSE 3 END)::INTEGER AS tier_id, (dense_rank() OVER (ORDER BY rudiment_slug) - 1)::INTEGER AS label_id, (skill_tier = 'professional')::INTEGER AS is_top FROM so")
def p11_p12_encodings(spark, d):
    o = scalars.with_name_id(orders(spark, d), "rudiment_slug")
    return o.select("sample_id", scalars.ordinal(F.col("skill_tier"), fx.TIERS).alias("tier_id"), "label_id", scalars.flag(F.col("skill_tier") == "professional").alias("is_top"))


@query(SCORES_SQL + " SELECT sample_id, round(coalesce(flam_quality, -1), 6)::DOUBLE AS flam, flam_quality IS NOT NULL AS applies FROM ex")
def p13_filled(spark, d):
    return rounded(scores(spark, d).select("sample_id", scalars.filled(F.col("flam_quality")).alias("flam"), F.col("flam_quality").isNotNull().alias("applies")))


@query("SELECT p_partkey, CASE WHEN regexp_matches(s, 'roll|stroke') THEN 'roll' WHEN contains(s, 'diddle') THEN 'diddle' WHEN contains(s, 'flam') THEN 'flam' WHEN regexp_matches(s, 'drag|ratamacue') THEN 'drag' ELSE 'other' END AS category, regexp_matches(s, '^[a-z0-9_]+$') AS valid, array_to_string(list_transform(string_split(replace(s, '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name FROM (SELECT p_partkey, ['flam_tap','Five Stroke','single_paradiddle','lesson_25','drag_tap'][p_partkey % 5 + 1] AS s FROM part)")
def p14_p16_slugs(spark, d):
    s = F.element_at(F.array(*map(F.lit, ("flam_tap", "Five Stroke", "single_paradiddle", "lesson_25", "drag_tap"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    p = fx.table(spark, d, "part").select("p_partkey", s.alias("s"))
    return p.select("p_partkey", scalars.category_of(F.col("s")).alias("category"), scalars.valid_slug(F.col("s")).alias("valid"), scalars.display_name(F.col("s")).alias("name"))


@query("SELECT s_suppkey, substr(sha256('{\"s_name\":\"' || s_name || '\",\"s_nationkey\":' || s_nationkey || '}'), 1, 16) AS config_hash, md5(s_name || '_' || s_nationkey) AS cache_key, (('0x' || substr(md5('42:' || s_suppkey), 1, 8))::BIGINT % 7)::INTEGER AS pick FROM supplier")
def p17_p19_hashes(spark, d):
    s = fx.table(spark, d, "supplier")
    return s.select("s_suppkey", scalars.fingerprint("s_nationkey", "s_name").alias("config_hash"), scalars.cache_key(F.col("s_name"), F.col("s_nationkey")).alias("cache_key"), sampling.pick("s_suppkey", 7).alias("pick"))


@query(SO + " SELECT sample_id, CASE augmentation_preset WHEN 'gym' THEN 'hall' END AS aug_room_type, CASE augmentation_preset WHEN 'gym' THEN 0.6::DOUBLE END AS aug_room_wet_dry, CASE augmentation_preset WHEN 'lo_fi' THEN 8 END AS aug_degrade_bit_depth FROM so")
def p20_preset_parameters(spark, d):
    presets = spark.sql("select * from values ('none', false, 'studio', 0.1D, false, 16), ('gym', true, 'hall', 0.6D, false, 16), ('lo_fi', false, 'club', 0.2D, true, 8) as t(preset, room_enabled, room_type, room_wet_dry, degrade_enabled, degrade_bit_depth)")
    o = scalars.with_preset(orders(spark, d), presets)
    return o.select("sample_id", "aug_room_type", "aug_room_wet_dry", "aug_degrade_bit_depth")


# Windows

_IOI = EV + ", i AS (SELECT sample_id, actual_time_ms AS t, lag(actual_time_ms) OVER (PARTITION BY sample_id ORDER BY actual_time_ms) AS b FROM ev)"


def _points(spark, d):
    return fx.events(spark, d).select("sample_id", "position", F.col("actual_time_ms").alias("time_ms"))


@query(_IOI + ", f AS (SELECT sample_id, avg(t - b) AS m, stddev_pop(t - b) AS s FROM i GROUP BY 1) SELECT u.sample_id, round(coalesce(m, 0), 5) AS ioi_mean, round(coalesce(s, 0), 5) AS ioi_sd, round(coalesce(s / m, 0), 5) AS ioi_cv, round(coalesce(60000 / m, 0), 5) AS tempo_bpm FROM (SELECT DISTINCT user_id AS sample_id FROM events) u LEFT JOIN f USING (sample_id)")
def w01_interval_features(spark, d):
    return rounded(windows.interval_features(_points(spark, d), fx.samples(spark, d)), 5)


@query(_IOI + " SELECT sample_id, round(t, 6) AS time_ms, round(t - b, 6) AS ioi_ms, round((t + b) / 2, 6) AS mid_ms FROM i WHERE b IS NOT NULL")
def w02_intervals(spark, d):
    return rounded(windows.intervals(_points(spark, d)))


@query(BOTH + ", nn AS (SELECT sample_id, position, timing_error_ms AS y, row_number() OVER (PARTITION BY sample_id ORDER BY position) - 1 AS x FROM st) SELECT sample_id, position, round(y - avg(y) OVER p - covar_pop(x, y) OVER p / var_pop(x) OVER p * (x - avg(x) OVER p), 5) AS residual_ms FROM nn WINDOW p AS (PARTITION BY sample_id)")
def w03_detrended(spark, d):
    return rounded(stats.detrended(strokes(spark, d)).select("sample_id", "position", "residual_ms"), 5)


@query(
    EV.replace("WITH ", "WITH RECURSIVE ", 1)
    + DETECTED_SQL
    + """, o AS (SELECT sample_id, time_ms, strength, row_number() OVER (PARTITION BY sample_id ORDER BY time_ms, strength) AS rn FROM de),
k AS (SELECT sample_id, rn, time_ms AS t, strength AS s, 1 AS g FROM o WHERE rn = 1 UNION ALL
  SELECT o.sample_id, o.rn, CASE WHEN o.time_ms - k.t < 20 AND o.strength <= k.s THEN k.t ELSE o.time_ms END, CASE WHEN o.time_ms - k.t < 20 AND o.strength <= k.s THEN k.s ELSE o.strength END,
    k.g + CASE WHEN o.time_ms - k.t < 20 THEN 0 ELSE 1 END FROM k JOIN o ON o.sample_id = k.sample_id AND o.rn = k.rn + 1)
SELECT sample_id, round(arg_max(t, rn), 6) AS time_ms, round(arg_max(s, rn), 6) AS strength FROM k GROUP BY sample_id, g"""
)
def w04_merge_close(spark, d):
    return rounded(windows.merge_close(detections(spark, d)))


@query(
    EV
    + """, p AS (SELECT sample_id, actual_time_ms AS t, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY sample_id) AS n, actual_time_ms - lag(actual_time_ms) OVER w AS gap FROM ev WINDOW w AS (PARTITION BY sample_id ORDER BY actual_time_ms)),
c AS (SELECT DISTINCT sample_id, n, CASE WHEN n < 4 THEN 1 ELSE least(n, 8) END AS k FROM p), u AS (SELECT sample_id, n, k, unnest(range(k)) AS cycle FROM c),
f AS (SELECT u.sample_id, u.n, u.cycle, CASE WHEN u.cycle > 0 AND p.gap < 40 THEN least(p.i + 1, u.n - 1) ELSE p.i END AS a FROM u JOIN p ON p.sample_id = u.sample_id AND p.i = round_even(u.cycle * u.n / u.k::DOUBLE, 0)),
e AS (SELECT *, coalesce(lead(a) OVER (PARTITION BY sample_id ORDER BY cycle), n) - 1 AS b FROM f)
SELECT e.sample_id, e.cycle::INTEGER AS cycle, a::INTEGER AS first, b::INTEGER AS last, round(greatest(0, p.t - 50), 6)::DOUBLE AS start_ms, round(q.t + 50, 6) AS end_ms FROM e JOIN p ON p.sample_id = e.sample_id AND p.i = a JOIN p q ON q.sample_id = e.sample_id AND q.i = b"""
)
def w05_cycle_cuts(spark, d):
    p = _points(spark, d)
    return rounded(windows.cycle_cuts(p, F.lit(8)))


@query(EV + " SELECT sample_id, position, greatest(1, least(127, trunc(actual_velocity * greatest(0.5, 1 - position * 0.01::DOUBLE))))::INTEGER AS decayed_velocity FROM ev")
def w06_velocity_decay(spark, d):
    return windows.velocity_decay(fx.events(spark, d), 0.01).select("sample_id", "position", "decayed_velocity")


@query(EV + " SELECT sample_id, position, round(greatest(0, least(72000, actual_time_ms)), 6)::DOUBLE AS from_ms, round(greatest(0, least(72000, coalesce(lead(actual_time_ms) OVER (PARTITION BY sample_id ORDER BY position), 72000))), 6)::DOUBLE AS to_ms, round(0.3 + 0.7 * actual_velocity / 127, 6)::DOUBLE AS gain FROM ev")
def w07_gains(spark, d):
    return rounded(windows.gains(fx.events(spark, d), F.lit(72000.0)))


@query(EV + ", x AS (SELECT sample_id, position, is_grace_note AS g, lead(is_grace_note, 1) OVER w AS g1, lead(is_grace_note, 2) OVER w AS g2 FROM ev WINDOW w AS (PARTITION BY sample_id ORDER BY position)) SELECT sample_id, position FROM x WHERE g AND g1 AND NOT g2")
def w08_drags(spark, d):
    return windows.drags(fx.events(spark, d))


@query(EV + ", x AS (SELECT sample_id, position, is_grace_note, first_value(CASE WHEN NOT is_grace_note THEN position END IGNORE NULLS) OVER (PARTITION BY sample_id, position // 8 ORDER BY position ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS p FROM ev) SELECT sample_id, position, CASE WHEN is_grace_note THEN p END AS parent FROM x")
def w09_grace_parents(spark, d):
    e = fx.events(spark, d).withColumn("cycle", F.floor(F.col("position") / 8))
    return windows.grace_parents(e).select("sample_id", "position", "parent")


@query("SELECT c_mktsegment, row_number() OVER (ORDER BY min(c_custkey), c_mktsegment) - 1 AS number FROM customer GROUP BY 1")
def w10_first_seen(spark, d):
    return windows.first_seen_numbers(fx.table(spark, d, "customer"), "c_mktsegment", "c_custkey")


# Sequences


@query(ST + ", t AS (SELECT sample_id, list([timing_error_ms, actual_velocity::DOUBLE] ORDER BY position) FILTER (position < 12) AS x, count(*) AS n FROM st GROUP BY 1) SELECT sample_id, list_transform(x || list_transform(range(12 - len(x)), lambda i: [0.0::DOUBLE, 0.0::DOUBLE]), lambda r: list_transform(r, lambda v: round(v, 6))) AS matrix, list_transform(range(12), lambda i: (i < len(x))::INTEGER) AS mask, least(12, n)::INTEGER AS length FROM t")
def q01_feature_matrix(spark, d):
    m = sequences.feature_matrix(strokes(spark, d), ["timing_error_ms", "actual_velocity"], 12)
    return m.withColumn("matrix", F.transform("matrix", lambda r: F.transform(r, lambda v: sql_round(v))))


@query(EV + ", h AS (SELECT sample_id, list(DISTINCT trunc(actual_time_ms / 1000)::INTEGER) AS f FROM ev GROUP BY 1) SELECT sample_id, list_transform(range(72), lambda i: list_contains(f, i::INTEGER)::INTEGER) AS targets FROM h")
def q02_onset_targets(spark, d):
    return sequences.onset_targets(fx.events(spark, d), 72, 1000.0)


@query(EV + ", h AS (SELECT sample_id, trunc(actual_time_ms / 1000)::INTEGER AS f, arg_max(CASE WHEN hand = 'L' THEN 1 ELSE 2 END, position) AS h FROM ev GROUP BY ALL), m AS (SELECT sample_id, list(f) AS fs, list(h) AS hs FROM (SELECT * FROM h ORDER BY sample_id, f) GROUP BY 1) SELECT sample_id, list_transform(range(72), lambda i: coalesce(hs[list_position(fs, i::INTEGER)], 0)) AS targets FROM m")
def q03_hand_targets(spark, d):
    return sequences.hand_targets(fx.events(spark, d), 72, 1000.0)


_LISTS = "x AS (SELECT l_orderkey AS id, list(l_quantity::DOUBLE ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS x FROM lineitem GROUP BY 1)"


def _lists(spark, d):
    """Lists of several lengths: the quantities of each order's lines."""
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    g = fx.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return g.select("id", F.transform("rows", lambda r: r["l_quantity"].cast("double")).alias("x"))


@query(f"WITH {_LISTS} SELECT id, x[1:4] || list_transform(range(greatest(0, 4 - len(x))), lambda i: 0.0::DOUBLE) AS padded, list_transform(range(4), lambda i: (i < len(x))::INTEGER) AS mask, least(4, len(x))::INTEGER AS length FROM x")
def q04_fixed_length(spark, d):
    return sequences.fixed_length(_lists(spark, d), "x", 4).drop("x")


@query(f"WITH {_LISTS}, m AS (SELECT id // 16 AS batch, max(len(x)) AS n FROM x GROUP BY 1) SELECT id, x || list_transform(range(n - len(x)), lambda i: 0.0::DOUBLE) AS padded FROM x JOIN m ON batch = id // 16")
def q05_batch_length(spark, d):
    return sequences.batch_length(_lists(spark, d).withColumn("batch", F.floor(F.col("id") / 16)), "x", "batch").select("id", "padded")


_EMB = "SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings"


def _arrays(spark, d):
    return fx.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))


@query(f"WITH a AS ({_EMB}), y AS (SELECT vec_id, list_transform(x, lambda v: v / list_max(list_transform(x, lambda w: abs(w)))) AS y FROM a) SELECT vec_id, unnest(range(len(y)))::INTEGER AS position, unnest(y) AS y FROM y")
def q06_peak_normal(spark, d):
    return _arrays(spark, d).select("vec_id", F.posexplode(sequences.peak_normal(F.col("x"))).alias("position", "y"))


@query(f"WITH a AS ({_EMB}), e AS (SELECT vec_id, list_transform(range(0, len(x) - 16 + 1, 8), lambda i: sqrt(list_sum(list_transform(x[i + 1:i + 16], lambda v: v * v)) / 16)) AS r FROM a) SELECT vec_id, unnest(range(len(r)))::INTEGER AS position, round(unnest(r), 5) AS envelope, round(list_avg(r), 5) AS mean, round(list_stddev_pop(r), 5) AS sd, round(list_max(r), 5) AS top, round(list_max(r) - list_min(r), 5) AS reach, round(len(r) * 8 / 16.0 - 0.5, 5)::DOUBLE AS last_time FROM e")
def q07_q08_envelope(spark, d):
    e = _arrays(spark, d).withColumn("r", sequences.rms_envelope(F.col("x"), 16, 8)).withColumn("s", sequences.dynamics(F.col("r")))
    e = e.withColumn("t", sequences.frame_times(F.col("r"), 8, 16.0))
    return rounded(e.select("vec_id", F.posexplode("r").alias("position", "envelope"), F.col("s.mean").alias("mean"), F.col("s.sd").alias("sd"), F.col("s.max").alias("top"), F.col("s.range").alias("reach"), F.element_at("t", -1).alias("last_time")), 5)


@query(f"WITH a AS ({_EMB}), c AS (SELECT vec_id, list_transform(range(4), lambda i: sqrt(list_sum(list_transform(x[i * (len(x) // 4) + 1:(i + 1) * (len(x) // 4)], lambda v: v * v)) / (len(x) // 4))) AS y FROM a) SELECT vec_id, unnest(range(len(y)))::INTEGER AS chunk, round(unnest(y), 5) AS rms FROM c")
def q09_chunk_rms(spark, d):
    return rounded(_arrays(spark, d).select("vec_id", F.posexplode(sequences.chunk_rms(F.col("x"), 4)).alias("chunk", "rms")), 5)


@query("SELECT vec_id, i::INTEGER AS position, (embedding[2 * i + 1]::DOUBLE + embedding[2 * i + 2]::DOUBLE) / 2 AS mono FROM embeddings, range(32) r(i)")
def q10_mono(spark, d):
    pairs = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.array(F.get("embedding", 2 * i), F.get("embedding", 2 * i + 1)))
    return fx.table(spark, d, "embeddings").select("vec_id", F.posexplode(sequences.mono(pairs)).alias("position", "mono"))


@query("WITH m AS (SELECT vec_id, i AS n, list_transform(embedding[i * 16 + 1:i * 16 + 16], lambda v: v::DOUBLE) AS x FROM embeddings, range(4) r(i)) SELECT vec_id, n::INTEGER AS n, k::INTEGER AS position, round((x[k + 1] - list_avg(x)) / list_stddev_pop(x), 4) AS z FROM m, range(16) q(k)")
def q11_z_rows(spark, d):
    rows = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("embedding", i * 16 + 1, F.lit(16)))
    e = fx.table(spark, d, "embeddings").select("vec_id", F.posexplode(sequences.z_rows(rows)).alias("n", "row"))
    return rounded(e.select("vec_id", "n", F.posexplode("row").alias("position", "z")), 4)


_TEXTS = """l AS (SELECT l_orderkey AS id, CASE l_returnflag WHEN 'A' THEN 'R' WHEN 'N' THEN 'L' ELSE 'B' END AS c, CASE WHEN l_linestatus = 'F' THEN '>' ELSE '.' END AS a,
row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS position FROM lineitem)"""


def _texts(spark, d):
    li = fx.table(spark, d, "lineitem")
    c = F.when(F.col("l_returnflag") == "A", "R").when(F.col("l_returnflag") == "N", "L").otherwise("B")
    a = F.when(F.col("l_linestatus") == "F", ">").otherwise(".")
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", c.alias("c"), a.alias("a"))
    g = li.groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return g.select("id", F.array_join(F.transform("rows", lambda r: r["c"]), " ").alias("sticking"), F.array_join(F.transform("rows", lambda r: r["a"]), "").alias("accents"), F.transform("rows", lambda r: r["c"]).alias("hands"), F.transform("rows", lambda r: r["a"]).alias("marks"))


@query(f"WITH {_TEXTS} SELECT id, position::INTEGER AS position, CASE WHEN c <> 'B' THEN c WHEN count(*) FILTER (c = 'B') OVER (PARTITION BY id ORDER BY position) % 2 = 1 THEN 'R' ELSE 'L' END AS hand, CASE WHEN a = '>' THEN 'accent' ELSE 'tap' END AS stroke_type FROM l")
def q12_parse_sticking(spark, d):
    return sequences.parse_sticking(_texts(spark, d), "sticking", "accents")


@query(f"WITH {_TEXTS} SELECT id, position::INTEGER AS position, CASE WHEN c <> 'B' THEN c WHEN count(*) FILTER (c = 'B') OVER (PARTITION BY id ORDER BY position) % 2 = 1 THEN 'R' ELSE 'L' END AS hand, CASE WHEN a = '>' THEN 'accent' ELSE 'tap' END AS stroke_type FROM l")
def x04_table_function(spark, d):
    table_functions.register(spark)
    texts = _texts(spark, d)
    return spark.sql("SELECT id, e.* FROM {texts}, LATERAL expand_sticking(sticking, accents) e", texts=texts)


@query("WITH t AS (SELECT p_partkey, ['(R)','R>','>L','l','(l)','R'][p_partkey % 6 + 1] AS k FROM part) SELECT p_partkey, upper(regexp_extract(k, '[RLrl]')) AS hand, CASE WHEN k LIKE '(%)' THEN 'grace' WHEN contains(k, '>') THEN 'accent' ELSE 'tap' END AS stroke_type FROM t")
def q13_parse_token(spark, d):
    k = F.element_at(F.array(*map(F.lit, ("(R)", "R>", ">L", "l", "(l)", "R"))), (F.col("p_partkey") % 6 + 1).cast("int"))
    return fx.table(spark, d, "part").select("p_partkey", sequences.parse_token(k).alias("t")).select("p_partkey", "t.*")


@query(f"WITH {_TEXTS} SELECT id, coalesce(list(position::INTEGER ORDER BY position) FILTER (a = '>'), []) AS accents, count(*)::INTEGER AS n, list(translate(c, 'RL', 'LR') ORDER BY position) AS mirrored FROM l GROUP BY 1")
def q14_q15_positions(spark, d):
    t = _texts(spark, d)
    return t.select("id", sequences.positions_of(F.col("marks"), ">").alias("accents"), F.size("hands").alias("n"), sequences.mirrored(F.col("hands")).alias("mirrored"))


_CATALOGUE = "('flam', 1.0D, array(named_struct('hand','L','stroke_type','grace','grace_offset',30.0D), named_struct('hand','R','stroke_type','accent','grace_offset',cast(null as double)), named_struct('hand','L','stroke_type','tap','grace_offset',cast(null as double)))), ('para', 1.0D, array(named_struct('hand','R','stroke_type','accent','grace_offset',cast(null as double)), named_struct('hand','L','stroke_type','tap','grace_offset',cast(null as double)), named_struct('hand','R','stroke_type','diddle','grace_offset',cast(null as double)), named_struct('hand','R','stroke_type','diddle','grace_offset',cast(null as double))))"


@query(
    SO
    + """, c(slug, i, hand, stroke_type, off, slot, slots, k) AS (VALUES ('flam',0,'L','grace',30.0::DOUBLE,0,2,3), ('flam',1,'R','accent',NULL,0,2,3), ('flam',2,'L','tap',NULL,1,2,3), ('para',0,'R','accent',NULL,0,4,4), ('para',1,'L','tap',NULL,1,4,4), ('para',2,'R','diddle',NULL,2,4,4), ('para',3,'R','diddle',NULL,3,4,4)),
t AS (SELECT DISTINCT tempo_bpm FROM so) SELECT slug, tempo_bpm, y.cycle::INTEGER AS cycle, (y.cycle * k + i)::INTEGER AS position, hand, stroke_type, round((y.cycle + slot / slots::DOUBLE) * 60000.0::DOUBLE / tempo_bpm - coalesce(off, 0), 6) AS intended_time_ms,
CASE stroke_type WHEN 'accent' THEN 120 WHEN 'grace' THEN 40 WHEN 'diddle' THEN 75 ELSE 65 END AS intended_velocity, stroke_type = 'grace' AS is_grace_note, CASE WHEN stroke_type = 'grace' THEN (y.cycle * k + i + 1)::INTEGER END AS parent FROM c, t, range(3) y(cycle)"""
)
def q16_expected_grid(spark, d):
    catalogue = spark.sql(f"select * from values {_CATALOGUE} as t(slug, beats_per_cycle, pattern)")
    g = sequences.expected_grid(catalogue, orders(spark, d).select("tempo_bpm").distinct(), 3)
    return rounded(g.withColumn("position", F.col("position").cast("int")).withColumn("parent", F.col("parent").cast("int")))


@query(
    EV
    + """, x AS (SELECT ev.*, j FROM ev, LATERAL (SELECT unnest(range(CASE WHEN stroke_type = 'buzz' THEN 2 + position % 3 ELSE 1 END)) AS j))
SELECT sample_id, row_number() OVER o - 1 AS position, (CASE WHEN j > 0 THEN max(position) OVER (PARTITION BY sample_id) + sum((j > 0)::INTEGER) OVER o ELSE position END)::INTEGER AS "index", stroke_type, round(actual_time_ms + j * 25, 6) AS actual_time_ms,
greatest(1, trunc(actual_velocity * 0.85::DOUBLE ** j))::INTEGER AS actual_velocity, is_grace_note OR j > 0 AS is_grace_note, CASE WHEN j > 0 THEN position END::INTEGER AS parent_stroke_index FROM x WINDOW o AS (PARTITION BY sample_id ORDER BY position, j)"""
)
def q17_bounces(spark, d):
    return rounded(sequences.bounces(fx.events(spark, d), (2 + F.col("position") % 3).cast("int"), F.lit(25.0)))


@query(SM + " SELECT sample_id, 'strokes' AS \"table\" FROM sm WHERE sample_id % 17 = 0")
def q18_missing_ids(spark, d):
    s = fx.samples(spark, d)
    return sequences.missing_ids(s, {"strokes": fx.events(spark, d).where("sample_id % 17 <> 0"), "samples": s})


@query("SELECT event_id, (props->>'$.k')::INTEGER AS k FROM events")
def q19_json_field(spark, d):
    return fx.table(spark, d, "events").select("event_id", sequences.json_field("props", "$.k", "int").alias("k"))


# Sampling and splits


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10")
def l01_top_k(spark, d):
    return sampling.top_k(fx.table(spark, d, "part"), "p_brand", 10)


@query(SO + " SELECT rudiment_slug, sample_id FROM so QUALIFY row_number() OVER (PARTITION BY rudiment_slug ORDER BY sample_id) <= 5")
def l02_first_n(spark, d):
    return sampling.first_per_group(orders(spark, d), ["rudiment_slug"], ["sample_id"], 5).select("rudiment_slug", "sample_id")


@query(SO + " SELECT rudiment_slug, skill_tier, min(sample_id) AS sample_id FROM so GROUP BY ALL")
def l04_representatives(spark, d):
    return sampling.first_per_group(orders(spark, d), ["rudiment_slug", "skill_tier"], ["sample_id"]).select("rudiment_slug", "skill_tier", "sample_id")


@query(SO + " SELECT sample_id FROM so ORDER BY md5('42:' || sample_id), sample_id LIMIT 50")
def l05_v24_shuffled(spark, d):
    return sampling.shuffled(orders(spark, d), "sample_id", 50).select("sample_id")


@query(SO + " SELECT skill_tier, sample_id FROM so QUALIFY row_number() OVER (PARTITION BY skill_tier ORDER BY md5('42:' || sample_id), sample_id) <= 20")
def l06_balanced(spark, d):
    return sampling.balanced(orders(spark, d), "skill_tier", 20, "sample_id").select("skill_tier", "sample_id")


@query(SO + ", p AS (SELECT profile_id, row_number() OVER (ORDER BY md5('42:' || profile_id), profile_id) - 1 AS r, count(*) OVER () AS n FROM (SELECT DISTINCT profile_id FROM so)) SELECT profile_id, CASE WHEN r < floor(n * 0.7) THEN 'train' WHEN r < floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split FROM p")
def l07_random_split(spark, d):
    return sampling.random_split(orders(spark, d))


_STRAT = SO + """, p AS (SELECT profile_id, skill_tier, row_number() OVER (PARTITION BY skill_tier ORDER BY md5('42:' || profile_id), profile_id) - 1 AS r, count(*) OVER (PARTITION BY skill_tier) AS n FROM (SELECT DISTINCT profile_id, skill_tier FROM so)),
c AS (SELECT *, greatest(1, floor(n * 0.7)) AS tr, floor(n * 0.15) AS va FROM p), ss AS (SELECT profile_id, skill_tier, CASE WHEN r < tr THEN 'train' WHEN r < tr + va - CASE WHEN n >= 3 AND n - tr - va = 0 AND va > 1 THEN 1 ELSE 0 END THEN 'val' ELSE 'test' END AS split FROM c)"""


@query(_STRAT + " SELECT * FROM ss")
def l08_stratified_split(spark, d):
    return sampling.stratified_split(orders(spark, d))


@query(SO + """, r AS (SELECT sample_id, skill_tier, row_number() OVER (PARTITION BY skill_tier ORDER BY md5('42:' || sample_id), sample_id) - 1 AS r, count(*) OVER (PARTITION BY skill_tier) AS n FROM so), b AS (SELECT max(ceil(n / 8.0))::BIGINT AS nb FROM r)
SELECT skill_tier, sample_id, ((r + t * n) // 8)::INTEGER AS batch FROM r, b, LATERAL (SELECT unnest(range((nb * 8 - 1 - r) // n + 1)) AS t) WHERE r <= nb * 8 - 1""")
def l09_balanced_batches(spark, d):
    return sampling.balanced_batches(orders(spark, d), 32, "skill_tier", "sample_id", 4).select("skill_tier", "sample_id", "batch")


@query(SO + " SELECT sample_id, CASE WHEN ('0x' || substr(md5('42:' || sample_id), 1, 8))::BIGINT / 4294967296.0 < 0.8 THEN 'train' ELSE 'test' END AS part FROM so")
def l10_train_test(spark, d):
    return sampling.train_test(orders(spark, d), "sample_id").select("sample_id", "part")


@query(SO + ", x AS (SELECT profile_id, tempo, md5('42:' || profile_id || ':' || tempo) AS h FROM (SELECT DISTINCT profile_id FROM so), (VALUES (60),(90),(120),(150)) t(tempo)) SELECT profile_id, tempo FROM x QUALIFY row_number() OVER (PARTITION BY profile_id ORDER BY h, tempo) <= 2")
def l11_choose_per_key(spark, d):
    tempos = spark.sql("select * from values 60, 90, 120, 150 as t(tempo)")
    return sampling.choose_per_key(orders(spark, d), tempos, "profile_id", "tempo", 2).select("profile_id", "tempo")


# Checks


def _check(check, passed, message, details) -> str:
    return f"SELECT '{check}' AS \"check\", {passed} AS passed, {message} AS message, {details} AS detail"


def first_detail(df):
    """One detail as a plain column, for comparison."""
    return df.select("check", "passed", "message", F.element_at(F.map_values("details"), 1).alias("detail"))


@query(f"WITH f AS (SELECT count(*) AS n, count(DISTINCT l_orderkey) AS d FROM lineitem) {_check('ids_unique', 'n = d', chr(39).join(['d || ', ' distinct of ', ' || n']), '(n - d)::VARCHAR')} FROM f")
def v02_ids_unique(spark, d):
    return first_detail(checks.ids_unique(fx.table(spark, d, "lineitem"), "l_orderkey"))


@query(f"WITH f AS (SELECT count(DISTINCT user_id) AS k FROM events WHERE user_id % 17 = 0) {_check('strokes_refs', 'k = 0', chr(39).join(['k || ', ' orphan ids', '']), 'k::VARCHAR')} FROM f")
def v03_v05_refs(spark, d):
    return first_detail(checks.refs(fx.events(spark, d), fx.samples(spark, d).where("sample_id % 17 <> 0"), "strokes"))


@query(EV + ", f AS (SELECT avg((actual_velocity BETWEEN 1 AND 127)::INTEGER) AS r, min(actual_velocity) AS lo, max(actual_velocity) AS hi FROM ev) SELECT 'velocity_range' AS \"check\", r >= 0.999 AS passed, 'min ' || lo || ', max ' || hi AS message FROM f")
def v06_velocity_range(spark, d):
    return checks.velocity_range(fx.events(spark, d)).drop("details")


@query(ST + ", f AS (SELECT max(abs(timing_error_ms)) AS t, avg(abs(timing_error_ms)) AS m, avg((abs(timing_error_ms) <= 200)::INTEGER) AS r FROM st WHERE stroke_type <> 'grace') SELECT 'timing_range' AS \"check\", t < 500 AND (m < 100 OR r >= 0.8) AS passed, 'non-grace timing errors' AS message FROM f")
def v07_timing_range(spark, d):
    return checks.timing_range(strokes(spark, d)).drop("details")


@query(SCORES_SQL + ", bad AS (SELECT (min(timing_accuracy) < 0 OR max(timing_accuracy) > 100)::INTEGER + (min(hand_balance) < 0 OR max(hand_balance) > 100)::INTEGER + (min(overall_score) < 0 OR max(overall_score) > 100)::INTEGER AS k FROM ex) SELECT 'score_ranges' AS \"check\", k = 0 AS passed, k || ' columns out of range' AS message FROM bad")
def v08_score_ranges(spark, d):
    return checks.score_ranges(scores(spark, d), ["timing_accuracy", "hand_balance", "overall_score"]).drop("details")


@query(SM + ", c AS (SELECT user_id AS sample_id, count(*) AS n FROM events GROUP BY 1), f AS (SELECT count(*) FILTER (num_strokes <> coalesce(n, 0)) AS k, count(*) AS n FROM sm LEFT JOIN c USING (sample_id)) SELECT 'stroke_counts_match' AS \"check\", k = 0 AS passed, k || ' of ' || n || ' differ' AS message FROM f")
def v09_v10_counts_match(spark, d):
    return checks.counts_match(fx.samples(spark, d), fx.events(spark, d), "num_strokes", "stroke").drop("details")


@query(SCORES_SQL + f", t AS (SELECT skill_tier AS tier, avg(timing_accuracy) AS m FROM ex GROUP BY 1), u AS (SELECT *, lead(m) OVER (ORDER BY CASE tier WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1 WHEN 'advanced' THEN 2 ELSE 3 END) AS nx FROM t) SELECT 'tier_timing' AS \"check\", bool_and(nx IS NULL OR nx >= m - 2) AS passed, count(*) || ' tiers compared' AS message FROM u")
def v11_v12_tier_order(spark, d):
    return checks.tier_order(scores(spark, d), "timing_accuracy", "tier_timing").drop("details")


@query("WITH c AS (SELECT conv_id, list(role ORDER BY turn) FILTER (turn < 2) AS r FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) GROUP BY 1), f AS (SELECT count(*) FILTER (r IS NULL OR r <> ['user','assistant']) AS k, count(*) AS n FROM c) SELECT 'pattern_correct' AS \"check\", k = 0 AS passed, k || ' of ' || n || ' wrong' AS message FROM f")
def v13_pattern_correct(spark, d):
    c = fx.table(spark, d, "conversations").select("conv_id", "turn", "role").distinct()
    patterns = c.select("conv_id").distinct().withColumn("pattern", F.array(F.lit("user"), F.lit("assistant")))
    return checks.pattern_correct(c, patterns, "conv_id", "role", "turn").drop("details")


@query(EV + ", a AS (SELECT sample_id, actual_time_ms AS t, actual_velocity AS v, row_number() OVER (PARTITION BY sample_id ORDER BY actual_time_ms) AS rn FROM ev), f AS (SELECT count(*) AS n, avg((abs(x.t - (y.t + 2)) <= 5)::INTEGER) AS near, avg((x.v = y.v)::INTEGER) AS same FROM a x JOIN a y USING (sample_id, rn)) SELECT 'lists_aligned' AS \"check\", near >= 0.99 AND same >= 0.99 AS passed, n || ' events compared' AS message FROM f")
def v14_aligned(spark, d):
    e = fx.events(spark, d).select("sample_id", F.col("actual_time_ms").alias("time_ms"), F.col("actual_velocity").alias("velocity"))
    return checks.aligned(e, e.withColumn("time_ms", F.col("time_ms") + 2.0)).drop("details")


#: Parents are missing for some samples where orphans are to be found.
LOST = "sample_id % 17 <> 0"


def _all_checks(spark, d, parents: str = "true"):
    s = written(strokes(spark, d))
    x = written(labels.exercise_scores(s, fx.samples(spark, d)))
    return audit.verify(
        {"samples": fx.samples(spark, d).where(parents), "strokes": s, "exercises": x},
        [
            audit.unique("samples"),
            audit.refs("strokes", "samples"),
            audit.refs("exercises", "samples"),
            audit.no_nulls("strokes", ["timing_error_ms", "diddle_position"]),
            audit.velocity("strokes"),
            audit.timing("strokes"),
            audit.ranges("exercises", ["timing_accuracy", "hand_balance", "overall_score"]),
            audit.counts("samples", "strokes", "num_strokes", "stroke"),
            audit.tier_order("exercises", "timing_accuracy", "tier_timing"),
            audit.tier_order("exercises", "hand_balance", "tier_hand_balance"),
        ],
    )


def _refs_sql(child: str, name: str) -> str:
    lost = f"{child} WHERE sample_id NOT IN (SELECT sample_id FROM pa)"
    return f"SELECT '{name}_refs', count(*) = 0, count(DISTINCT sample_id) || ' orphan ids', MAP {{'orphan_ids': count(DISTINCT sample_id)::DOUBLE, 'orphan_rows': count(*)::DOUBLE}} FROM {lost}"


def _tier_sql(metric: str, name: str) -> str:
    means = ", ".join(f"'{t}': round(avg({metric}) FILTER (skill_tier = '{t}'), 4)::DOUBLE" for t in TIERS)
    rank = "CASE skill_tier WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1 WHEN 'advanced' THEN 2 ELSE 3 END"
    rises = f"SELECT bool_and(nx IS NULL OR nx >= m - 2) FROM (SELECT m, lead(m) OVER (ORDER BY r) AS nx FROM (SELECT {rank} AS r, avg({metric}) AS m FROM ex GROUP BY 1))"
    return f"SELECT '{name}', ({rises}), count(DISTINCT skill_tier) || ' tiers compared', MAP {{{means}}} FROM ex"


def _range_sql(columns: list[str]) -> str:
    bad = " + ".join(f"(min({c}) < 0 OR max({c}) > 100)::INTEGER" for c in columns)
    ends = ", ".join(f"'{c}_min': round(min({c}), 4)::DOUBLE, '{c}_max': round(max({c}), 4)::DOUBLE" for c in columns)
    return f"SELECT 'score_ranges', ({bad}) = 0, ({bad}) || ' columns out of range', MAP {{{ends}}} FROM ex"


def _checks_sql(parents: str = "true") -> str:
    e = "abs(timing_error_ms)"
    parts = [
        "SELECT 'ids_unique' AS \"check\", count(*) = count(DISTINCT sample_id) AS passed, count(DISTINCT sample_id) || ' distinct of ' || count(*) AS message, MAP {'duplicates': (count(*) - count(DISTINCT sample_id))::DOUBLE} AS details FROM pa",
        _refs_sql("st", "strokes"),
        _refs_sql("ex", "exercises"),
        "SELECT 'strokes_nulls', t + p = 0, (t + p) || ' nulls in required columns', MAP {'timing_error_ms': t::DOUBLE, 'diddle_position': p::DOUBLE} FROM (SELECT count(*) - count(timing_error_ms) AS t, count(*) - count(diddle_position) AS p FROM st)",
        "SELECT 'velocity_range', avg((actual_velocity BETWEEN 1 AND 127)::INTEGER) >= 0.999, 'min ' || min(actual_velocity) || ', max ' || max(actual_velocity), MAP {'in_range': round(avg((actual_velocity BETWEEN 1 AND 127)::INTEGER), 6)::DOUBLE} FROM st",
        f"SELECT 'timing_range', max({e}) < 500 AND (avg({e}) < 100 OR avg(({e} <= 200)::INTEGER) >= 0.8), 'non-grace timing errors', MAP {{'max': round(max({e}), 4)::DOUBLE, 'mean': round(avg({e}), 4)::DOUBLE, 'within_200': round(avg(({e} <= 200)::INTEGER), 6)::DOUBLE}} FROM st WHERE stroke_type <> 'grace'",
        _range_sql(["timing_accuracy", "hand_balance", "overall_score"]),
        "SELECT 'stroke_counts_match', k = 0, k || ' of ' || n || ' differ', MAP {'mismatches': k::DOUBLE} FROM (SELECT count(*) FILTER (num_strokes <> coalesce(c, 0)) AS k, count(*) AS n FROM pa LEFT JOIN (SELECT sample_id, count(*) AS c FROM st GROUP BY 1) USING (sample_id))",
        _tier_sql("timing_accuracy", "tier_timing"),
        _tier_sql("hand_balance", "tier_hand_balance"),
    ]
    return SCORES_SQL + f", pa AS (SELECT * FROM sm WHERE {parents}), ck AS (" + " UNION ALL ".join(parts) + ")"


@query(_checks_sql() + " SELECT count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, bool_and(passed) AS all_passed FROM ck")
def v15_verify_all(spark, d):
    return checks.summary(_all_checks(spark, d))


@query(_checks_sql(LOST) + ' SELECT "check", passed, message, unnest(map_keys(details)) AS detail, unnest(map_values(details)) AS value FROM ck')
def v15_check_details(spark, d):
    return audit.detail_rows(_all_checks(spark, d, LOST))


@query(
    _checks_sql(LOST)
    + """, tally AS (SELECT count(*) FILTER (NOT passed AND "check" IN ('ids_unique','strokes_refs','exercises_refs')) AS issues, count(*) FILTER (NOT passed AND "check" NOT IN ('ids_unique','strokes_refs','exercises_refs')) AS warnings FROM ck)
SELECT issues, warnings, CASE WHEN issues > 0 THEN 'stop' ELSE 'go' END AS decision FROM tally"""
)
def v16_triage(spark, d):
    return checks.triage(_all_checks(spark, d, LOST), ["ids_unique", "strokes_refs", "exercises_refs"])


@query(
    _checks_sql(LOST)
    + """ SELECT to_json({'passed': count(*) FILTER (passed), 'failed': count(*) FILTER (NOT passed), 'checks': list({'check': "check", 'passed': passed, 'message': message} ORDER BY "check")})::VARCHAR AS report FROM ck"""
)
def v17_report_json(spark, d):
    return checks.report_json(_all_checks(spark, d, LOST))


@query(
    """WITH o AS (SELECT count(*) FILTER (user_id IS NULL) AS nulls, count(DISTINCT user_id) FILTER (user_id NOT IN (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL)) AS orphans FROM events),
d AS (SELECT count(*) - count(DISTINCT event_id) AS repeats FROM events), t(name, missing) AS (VALUES ('samples', ''), ('strokes', 'no_such_column'), ('exercises', ''))
SELECT name || '_columns' AS "check", missing = '' AS passed, 'missing: ' || missing AS message FROM t
UNION ALL SELECT name || '_nulls', nulls = 0, nulls || ' nulls in required columns' FROM t, o
UNION ALL SELECT name || '_duplicates', repeats = 0, repeats || ' repeated keys' FROM t, d
UNION ALL SELECT name || '_refs', orphans = 0, orphans || ' orphan ids' FROM t, o WHERE name <> 'samples'"""
)
def v01_integrity(spark, d):
    t = {"samples": fx.samples(spark, d), "strokes": fx.events(spark, d), "exercises": scores(spark, d)}
    required = {"samples": ["sample_id", "skill_tier"], "strokes": ["sample_id", "index", "no_such_column"], "exercises": ["sample_id", "overall_score"]}
    return checks.integrity(t, required, {"samples": ["sample_id"], "strokes": ["sample_id", "index"], "exercises": ["sample_id"]}).drop("details")


@query(SO + SPLIT_SQL + ", k AS (SELECT o.profile_id, count(DISTINCT split) AS n FROM (SELECT DISTINCT profile_id FROM so) o LEFT JOIN sp USING (profile_id) GROUP BY 1), f AS (SELECT count(*) FILTER (n > 1) AS several, count(*) FILTER (n = 0) AS none FROM k) SELECT 'split_sound' AS \"check\", several = 0 AND none = 0 AS passed, several || ' in several, ' || none || ' in none' AS message FROM f")
def v18_split_sound(spark, d):
    o = orders(spark, d)
    return checks.split_sound(some_splits(o), o).drop("details")


_SIG = "WITH a AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS x, CASE WHEN vec_id % 2 = 0 THEN 4 ELSE 5 END AS e FROM embeddings), f AS (SELECT vec_id, len(list_filter(x, lambda v: abs(v) < 0.001)) / len(x)::DOUBLE AS si, len(list_filter(x, lambda v: abs(v) >= 0.99)) / len(x)::DOUBLE AS cl, 20 * log10(sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x))) AS db, abs(len(x) / 16.0 - e) > 0.5 AS wd FROM a)"


def _flags(spark, d):
    e = fx.table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("samples"), F.lit(16).alias("sample_rate"), F.when(F.col("vec_id") % 2 == 0, 4).otherwise(5).alias("expected_sec"))
    return checks.signal_flags(e)


@query(_SIG + " SELECT vec_id, round(si, 6) AS silence_ratio, round(cl, 6) AS clip_ratio, round(db, 4) AS rms_db, wd AS wrong_duration, si > 0.8 OR cl > 0.001 OR wd AS failed FROM f")
def v19_v22_signal_flags(spark, d):
    return _flags(spark, d).select("vec_id", sql_round(F.col("silence_ratio"), 6).alias("silence_ratio"), sql_round(F.col("clip_ratio"), 6).alias("clip_ratio"), sql_round(F.col("rms_db"), 4).alias("rms_db"), "wrong_duration", "failed")


@query(_SIG + " SELECT count(*) AS n, count(*) FILTER (si > 0.8) AS silent, count(*) FILTER (cl > 0.001) AS clipped, count(*) FILTER (db NOT BETWEEN -40 AND -6) AS rms_outlier, count(*) FILTER (wd) AS wrong_duration, count(*) FILTER (si > 0.8 OR cl > 0.001 OR wd) AS failed, round(avg(db), 4) AS rms_mean, round(stddev_pop(db), 4) AS rms_sd, avg((db NOT BETWEEN -40 AND -6)::INTEGER) < 0.05 AS rms_passed FROM f")
def v23_signal_summary(spark, d):
    return rounded(checks.signal_summary(_flags(spark, d)), 4)


def queries() -> dict:
    return Q


def oracle_sql() -> dict[str, str]:
    return SQL
