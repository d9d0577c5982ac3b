"""Queries of sources and sinks (O-S*), streaming (O-T*), user functions (O-X*) and learning jobs (O-M*), with SQL twins.

Sinks write below a fresh folder of the session's shared folder and return what a reader finds there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strokelab.functions import user
from strokelab.operators import labels, ml
from strokelab.plans import fixtures as fx
from strokelab.plans.q_labels import SCORES_SQL, rounded, scores, sql_round, strokes
from strokelab.plans.q_tables import SM, SO, SPLIT_SQL, ST, orders, some_splits
from strokelab.sources import catalogue, tables, versioned
from strokelab.sources.shared import scratch, written
from strokelab.streaming import ingest, progress, statelog

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


def _lineitem(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "lineitem")


_KEEP = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 2) AS l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_shipdate DESC, l_extendedprice DESC) = 1"
_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def s01_s15_read(spark, d):
    returned = _lineitem(spark, d).where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return tables.read_table(spark, d, "orders", returned, ["o_orderkey", "o_totalprice"], "o_orderkey")


@query(SM + " SELECT count(*) AS num_samples, list(sample_id::VARCHAR ORDER BY sample_id::VARCHAR) AS sample_ids FROM sm")
def s02_manifest(spark, d):
    path = scratch(spark)
    tables.write_manifest(fx.samples(spark, d), path)
    return tables.read_manifest(spark, path).drop("config")


@query(SCORES_SQL + " SELECT sm.sample_id, count(st.position) AS n_strokes, ceil(count(st.position) / 8.0)::BIGINT AS n_measures, round(any_value(overall_score), 6) AS overall_score FROM sm JOIN st USING (sample_id) JOIN ex USING (sample_id) GROUP BY 1")
def s03_documents(spark, d):
    s = strokes(spark, d)
    docs = tables.documents(fx.samples(spark, d).drop("num_strokes"), s.select("sample_id", "position", "hand"), labels.measure_labels(s, F.lit(8)), scores(spark, d).drop("skill_tier"))
    return rounded(docs.select("sample_id", F.size("strokes").cast("long").alias("n_strokes"), F.size("measures").cast("long").alias("n_measures"), F.col("scores.overall_score").alias("overall_score")))


@query(_KEEP)
def s04_upsert(spark, d):
    path = scratch(spark)
    li = _lineitem(spark, d)
    seq = li.select(*_COLUMNS, F.struct("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("_seq"))
    for part in (seq.where("l_suppkey % 2 = 0"), seq.where("l_suppkey % 2 = 1")):
        versioned.merge(part, path, ["l_orderkey", "l_linenumber"], buckets=16)
    return versioned.read(spark, path).select(*_COLUMNS)


@query(ST + " SELECT sample_id, position, hand, stroke_type FROM st")
def s05_flatten(spark, d):
    s = strokes(spark, d).select("sample_id", "position", "hand", "stroke_type")
    m = s.select("sample_id", F.col("position").alias("index")).where("index % 8 = 0")
    docs = tables.documents(fx.samples(spark, d), s, m, fx.samples(spark, d).select("sample_id", F.lit(1.0).alias("overall_score")))
    return tables.flatten(docs)["strokes"]


@query("SELECT * FROM (VALUES ('customer', (SELECT count(*) FROM customer)), ('supplier', (SELECT count(*) FROM supplier))) t(name, n)")
def s06_x05_write_tables(spark, d):
    path = scratch(spark)
    written = tables.write_tables({n: fx.table(spark, d, n) for n in ("customer", "supplier")}, path)
    assert written == {n: spark.read.parquet(f"{path}/{n}.parquet").count() for n in written}
    parts = [spark.read.parquet(f"{path}/{n}.parquet").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in written]
    return parts[0].unionByName(parts[1])


@query("SELECT o_orderkey FROM orders")
def s07_merge_outputs(spark, d):
    path = scratch(spark)
    o = fx.table(spark, d, "orders").select("o_orderkey")
    for i in range(3):
        o.where(F.col("o_orderkey") % 3 == i).write.parquet(f"{path}/worker_{i}/orders.parquet")
    return tables.merge_outputs(spark, [f"{path}/worker_{i}" for i in range(4)], "orders")


@query(SO + SPLIT_SQL + " SELECT profile_id::VARCHAR AS profile_id, split FROM sp")
def s08_splits_json(spark, d):
    path = scratch(spark)
    tables.save_splits(some_splits(orders(spark, d)), path)
    return tables.load_splits(spark, path)


@query(SO + SPLIT_SQL + " SELECT sample_id, score, CASE coalesce(split, 'train') WHEN 'val' THEN 'validation' ELSE coalesce(split, 'train') END AS split FROM so LEFT JOIN sp USING (profile_id)")
def s09_s11_export(spark, d):
    path = scratch(spark)
    o = orders(spark, d)
    s = o.select("sample_id", "profile_id", F.lit("x").alias("audio_path"), F.lit("").alias("midi_path"))
    tables.write_export(tables.export_config(s, o.select("sample_id", "score"), some_splits(o)), path, max_shard_rows=1000)
    return spark.read.parquet(path).select("sample_id", "score", "split")


@query("SELECT o_orderkey AS sample_id, CASE WHEN o_orderkey % 4 = 0 THEN 'test' ELSE 'train' END AS split, o_comment_length AS length FROM (SELECT o_orderkey, (o_orderkey * 7919 % 1000)::INTEGER AS o_comment_length FROM orders)")
def s11_byte_shards(spark, d):
    """Rows of many lengths in shards of at most 100 kB; the files are counted on the way."""
    path = scratch(spark)
    length = (F.col("o_orderkey") * 7919 % 1000).cast("int")
    o = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("sample_id"), F.when(F.col("o_orderkey") % 4 == 0, "test").otherwise("train").alias("split"), F.repeat(F.lit("x"), length).alias("text"))
    tables.write_export(o, path, max_shard_bytes=100_000)
    size = F.octet_length(F.to_json(F.struct("sample_id", "split", "text")))
    back = spark.read.parquet(path).select("sample_id", "split", F.length("text").alias("length"), F.input_file_name().alias("f"), size.alias("bytes"))
    # Opening small files takes the time: each is read once, many by a task.
    back = written(back.coalesce(4 * spark.sparkContext.defaultParallelism))
    held = back.groupBy("f").agg(F.sum("bytes").alias("bytes"))
    fits = held.agg((F.max("bytes") <= 100_000).alias("fits"))  # one row
    return back.join(F.broadcast(fits.where("fits")), how="cross").select("sample_id", "split", "length")


@query("SELECT n_nationkey AS sample_id, CASE WHEN n_nationkey % 5 <> 0 THEN sum(length(c_name) + 1)::BIGINT END AS n_bytes FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def s10_media(spark, d):
    path = scratch(spark)
    names = fx.table(spark, d, "customer").select("c_nationkey", "c_name")
    names.repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    found = tables.list_files(spark, path).select("path", F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("long").alias("n_nationkey"))
    s = fx.table(spark, d, "nation").join(found, "n_nationkey", "left")
    s = s.select(F.col("n_nationkey").alias("sample_id"), F.when(F.col("n_nationkey") % 5 == 0, "").otherwise(F.col("path")).alias("audio_path"))
    return tables.embed_media(s, tables.read_files(spark, path), "audio_path", "audio").select("sample_id", F.length("audio").cast("long").alias("n_bytes"))


_PATTERNS = """t AS (SELECT p_brand AS slug, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_size) - 1 AS position FROM (SELECT DISTINCT p_brand, p_size FROM part)),
s AS (SELECT *, substr(slug, 7)::INTEGER % 2 = 0 AS simple, p_size % 3 = 2 AS buzz, count(*) FILTER (p_size % 3 = 2) OVER (PARTITION BY slug ORDER BY position) AS nth, count(*) OVER (PARTITION BY slug) AS n FROM t)"""


@query(
    f"""WITH {_PATTERNS} SELECT slug, position::INTEGER AS position, n / 4.0::DOUBLE AS beats_per_cycle,
CASE WHEN simple AND buzz THEN CASE WHEN nth % 2 = 1 THEN 'R' ELSE 'L' END WHEN p_size % 3 = 0 THEN 'R' ELSE 'L' END AS hand,
CASE WHEN simple THEN CASE WHEN buzz THEN 'buzz' WHEN p_size % 4 = 0 THEN 'accent' ELSE 'tap' END WHEN buzz THEN 'diddle' WHEN p_size % 4 = 0 THEN 'accent' WHEN p_size % 4 = 1 THEN 'grace' ELSE 'tap' END AS stroke_type,
CASE WHEN NOT simple AND NOT buzz AND p_size % 4 = 1 THEN -0.05::DOUBLE END AS grace_offset, CASE WHEN NOT simple AND buzz THEN p_size END::INTEGER AS diddle_position FROM s"""
)
def s17_catalogue(spark, d):
    path = scratch(spark)
    size = F.sort_array(F.collect_set("p_size"))
    p = fx.table(spark, d, "part").groupBy(F.col("p_brand").alias("slug")).agg(size.alias("x"))
    char = lambda v: F.when(v % 3 == 0, "R").when(v % 3 == 1, "L").otherwise("B")
    hand = lambda v: F.when(v % 3 == 0, "R").otherwise("L")
    token = lambda v: F.when(v % 4 == 0, F.concat(hand(v), F.lit(">"))).when(v % 4 == 1, F.concat(F.lit("("), hand(v), F.lit(")"))).otherwise(hand(v))
    full = lambda v: F.to_json(F.struct(hand(v).alias("hand"), F.lit("diddle").alias("type"), v.cast("int").alias("diddle_position")))
    strokes = F.array_join(F.transform("x", lambda v: F.when(v % 3 == 2, full(v)).otherwise(F.concat(F.lit('"'), token(v), F.lit('"')))), ", ")
    simple = F.array_join(F.transform("x", char), " ")
    accents = F.array_join(F.transform("x", lambda v: F.when(v % 4 == 0, ">").otherwise(".")), "")
    even = F.substring("slug", 7, 9).cast("int") % 2 == 0
    text = F.when(even, F.format_string('{"slug": "%s", "pattern": {"simple": "%s", "accents": "%s"}}', "slug", simple, accents)).otherwise(F.format_string('{"slug": "%s", "pattern": {"strokes": [%s]}}', "slug", strokes))
    p.select("slug", text.alias("value")).repartition("slug").write.partitionBy("slug").text(path)
    return catalogue.load(spark, path).select("slug", "beats_per_cycle", F.posexplode("pattern").alias("position", "s")).select("slug", "position", "beats_per_cycle", "s.*")


@query(ST + " SELECT sample_id, position FROM st")
def s12_auxiliary(spark, d):
    path = scratch(spark)
    tables.write_auxiliary({"strokes": strokes(spark, d).select("sample_id", "position")}, path)
    return spark.read.parquet(f"{path}/auxiliary/strokes")


@query("SELECT o_orderkey AS sample_id, CASE WHEN o_orderkey % 3 = 0 THEN 'audio/x/' || o_orderkey || '.flac' ELSE 'audio/' || o_orderkey || '.flac' END AS media_path FROM orders WHERE o_orderkey % 2 = 0")
def s13_media_path(spark, d):
    o = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("sample_id"))
    s = o.withColumn("audio_path", F.when(F.col("sample_id") % 3 == 0, F.format_string("audio/x/%d.flac", "sample_id")).when(F.col("sample_id") % 3 == 1, ""))
    listing = s.where("sample_id % 2 = 0").select(tables.media_path(F.col("sample_id"), F.col("audio_path"), "audio", ".flac").alias("path"))
    return tables.with_media(s, listing).select("sample_id", "media_path")


@query("SELECT c_custkey::VARCHAR AS value FROM customer WHERE c_mktsegment = 'BUILDING'")
def s14_export_subset(spark, d):
    path = scratch(spark)
    tables.export_subset(fx.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'"), path, "ids", "c_custkey")
    return spark.read.text(path)


@query("SELECT l_orderkey, round(l_extendedprice * 2, 2) AS twice FROM lineitem")
def s16_x01_map_batches(spark, d):
    li = _lineitem(spark, d).select("l_orderkey", "l_extendedprice")
    return rounded(user.map_batches(li, lambda p: pd.DataFrame({"l_orderkey": p["l_orderkey"], "twice": p["l_extendedprice"] * 2}), "l_orderkey long, twice double"), 2)


@query("WITH " + fx.EVENTS_SQL.strip() + ", k AS (SELECT sample_id, position, floor(greatest(actual_time_ms, 0) * 0.96::DOUBLE) AS tick, actual_velocity FROM ev) SELECT sample_id, position AS seq, round(max(tick) OVER (PARTITION BY sample_id ORDER BY position) * 500000.0 / 480000.0, 4)::DOUBLE AS time_ms, actual_velocity AS velocity FROM k QUALIFY true")
def s18_onset_times(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("sample_id").orderBy("position")
    tick = F.floor(F.greatest("actual_time_ms", F.lit(0.0)) * 0.96)
    e = fx.events(spark, d).withColumn("_k", F.max(tick).over(w))
    m = e.select("sample_id", F.col("position").alias("seq"), (F.col("_k") - F.coalesce(F.lag("_k").over(w), F.lit(0))).alias("delta_ticks"), F.lit("note_on").alias("type"), F.col("actual_velocity").alias("velocity"), F.lit(None).cast("int").alias("tempo_us"), F.lit(480).alias("ticks_per_beat"))
    return rounded(tables.onset_times(m), 4)


@query("SELECT user_id, event_id, round(value, 2) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 6 DESC, event_id DESC) = 1")
def t01_ingest(spark, d):
    """The last event of each user, where six files with events of every user arrive one after the other."""
    path = scratch(spark)
    e = fx.table(spark, d, "events").select("event_id", "user_id", "value")
    for i in range(6):
        e.where(F.col("event_id") % 6 == i).coalesce(1).write.mode("append").parquet(f"{path}/in")
    ingest.ingest(spark, f"{path}/in", f"{path}/out", f"{path}/state", "event_id long, user_id long, value double", ["user_id"], "event_id", 1, buckets=16).awaitTermination()
    return rounded(versioned.read(spark, f"{path}/out").drop("_seq"), 2)


@query(
    """WITH b AS (SELECT event_id % 6 AS i, count(*) FILTER (value >= 10) AS good, count(*) FILTER (value < 10) AS bad FROM events GROUP BY 1), c AS (SELECT sum(good) OVER w AS completed, sum(bad) OVER w AS failed, (SELECT count(*) FROM events) AS total FROM b WINDOW w AS (ORDER BY i))
SELECT completed::BIGINT AS completed, failed::BIGINT AS failed, (total - completed - failed)::BIGINT AS remaining, round(100.0 * completed / total, 4)::DOUBLE AS percent FROM c"""
)
def x05_stream_progress(spark, d):
    """What a listener is told after each of six batches; rows under a value of 10 can't be used."""
    path = scratch(spark)
    e = fx.table(spark, d, "events").select("event_id", "user_id", "value")
    for i in range(6):
        e.where(F.col("event_id") % 6 == i).coalesce(1).write.mode("append").parquet(f"{path}/in")
    seen = []
    listener = progress.StreamProgress(seen.append, e.count())
    spark.streams.addListener(listener)
    try:
        schema = "event_id long, user_id long, value double"
        ingest.ingest(spark, f"{path}/in", f"{path}/out", f"{path}/state", schema, ["user_id"], "event_id", 1, buckets=16, failed=F.col("value") < 10).awaitTermination()
        listener.wait(60)
    finally:
        spark.streams.removeListener(listener)
    told = [(p.completed, p.failed, p.remaining, p.percent) for p in seen if not p.done]  # one row a batch
    return rounded(spark.createDataFrame(told, "completed long, failed long, remaining long, percent double"), 4)


@query(SO + ", p AS (SELECT DISTINCT profile_id AS id FROM so) SELECT id, CASE WHEN id % 7 IN (1, 4) THEN 'pending' WHEN id % 7 = 5 THEN 'failed' ELSE 'completed' END AS status, id % 3 = 0 AS in_test FROM p")
def t02_resume(spark, d):
    """Seven epochs, each the outcomes of the profiles of one residue, with a snapshot every third; the fifth epoch is cut short."""
    root = scratch(spark)
    ids = written(orders(spark, d).select(F.col("profile_id").cast("string").alias("id")).distinct())
    part = lambda i: ids.where(F.pmod(F.col("id").cast("long"), F.lit(7)) == i)
    log = statelog.StateLog(spark, root, "config-a", every=3)
    log.save(ids.select(F.col("id").alias("profile_id"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split")), "splits", ["profile_id"])
    for i in range(7):
        status = {1: "running", 5: "failed"}.get(i, "completed")
        number = log.append(part(i).select("id", F.lit(status).alias("status"), F.lit(i).alias("updated_at")))
        if i == 4:
            broken = spark.read.parquet(f"{root}/config-a/epochs/n={number}").inputFiles()[0]
            fs, p = tables._hadoop(spark, broken)
            fs.create(p, True).close()
    # Another run of the same configuration reads the log anew.
    again = statelog.StateLog(spark, root, "config-a", every=3)
    left = again.pending(ids).withColumn("pending", F.lit(True))
    all_ids = ids.join(again.status().select("id", "status"), "id", "left").join(left, "id", "left").join(again.load("splits").select(F.col("profile_id").alias("id"), "split"), "id")
    return all_ids.select(F.col("id").cast("long").alias("id"), F.when(F.col("pending"), "pending").otherwise(F.col("status")).alias("status"), (F.col("split") == "test").alias("in_test"))


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 AND o_orderkey % 7 = 3")
def x02_user_predicate(spark, d):
    def chosen(price: pd.Series, key: pd.Series) -> pd.Series:
        return (price > 300000) & (key % 7 == 3)

    return user.where(fx.table(spark, d, "orders"), chosen, "o_totalprice", "o_orderkey").select("o_orderkey")


@query("SELECT user_id, count(*) AS n, round(max(value) - min(value), 4) AS reach FROM events GROUP BY 1")
def x03_per_group(spark, d):
    def fn(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [p["user_id"].iloc[0]], "n": [len(p)], "reach": [p["value"].max() - p["value"].min()]})

    return rounded(user.per_group(fx.table(spark, d, "events").select("user_id", "value"), "user_id", fn, "user_id long, n long, reach double"), 4)


# Learning jobs


@query(SCORES_SQL + " SELECT sm.sample_id, sm.skill_tier, tempo_bpm::DOUBLE AS tempo_bpm, round(overall_score, 6) AS overall_score, round(hand_balance, 6) AS hand_balance FROM sm JOIN ex USING (sample_id)")
def m01_classification_data(spark, d):
    x = scores(spark, d)
    data = ml.classification_data(fx.samples(spark, d), x).join(x.select("sample_id", "overall_score"), "sample_id")
    return rounded(data.select("sample_id", "skill_tier", "tempo_bpm", "overall_score", "hand_balance"))


@query(SO + " SELECT sample_id, round((score - avg(score) OVER ()) / stddev_pop(score) OVER (), 5) AS score FROM so")
def m02_standardised(spark, d):
    return rounded(ml.standardised(orders(spark, d).select("sample_id", "score"), ["score"]), 5)


@query(SCORES_SQL + """ SELECT sm.sample_id, any_value(tempo_bpm)::DOUBLE AS tempo_bpm, round(avg(timing_error_ms), 6) AS timing_error_mean, round(stddev_samp(timing_error_ms), 6) AS timing_error_std, round(max(timing_error_ms), 6) AS timing_error_max,
  round(avg(actual_velocity), 6) AS velocity_mean, round(stddev_samp(actual_velocity), 6) AS velocity_std, round(any_value(overall_score), 6) AS overall_score FROM sm JOIN st USING (sample_id) JOIN ex USING (sample_id) GROUP BY 1""")
def m01_regression_data(spark, d):
    return rounded(ml.regression_data(fx.samples(spark, d), strokes(spark, d), scores(spark, d)))


def _tier_data(spark, d):
    return written(ml.classification_data(fx.samples(spark, d), scores(spark, d)))


def _score_data(spark, d):
    return written(ml.regression_data(fx.samples(spark, d), strokes(spark, d), scores(spark, d)))


@query()
def m03_classifiers(spark, d, trees=100):
    p = ml.classify(_tier_data(spark, d), list(ml.TIER_FEATURES), "skill_tier", "sample_id", trees=trees)
    return ml.class_metrics(p["logistic"]).withColumn("model", F.lit("logistic")).unionByName(ml.class_metrics(p["forest"]).withColumn("model", F.lit("forest")))


@query()
def m04_regressors(spark, d, trees=100):
    p = ml.regress(_score_data(spark, d), list(ml.SCORE_FEATURES), "overall_score", "sample_id", trees=trees)
    return ml.regression_metrics(p["ridge"]).withColumn("model", F.lit("ridge")).unionByName(ml.regression_metrics(p["forest"]).withColumn("model", F.lit("forest")))


_PRED = "p AS (SELECT o_orderpriority AS truth, CASE WHEN o_orderkey % 4 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS predicted FROM orders)"


def _predictions(spark, d):
    o = fx.table(spark, d, "orders")
    return o.select(F.col("o_orderpriority").alias("truth"), F.when(F.col("o_orderkey") % 4 == 0, "1-URGENT").otherwise(F.col("o_orderpriority")).alias("predicted"))


@query(f"WITH {_PRED} SELECT truth, predicted, count(*) AS n FROM p GROUP BY ALL")
def m05_confusion(spark, d):
    return ml.confusion(_predictions(spark, d))


_REPORT = f"""WITH {_PRED}, t AS (SELECT truth AS class, count(*) AS support, count(*) FILTER (truth = predicted) AS hits FROM p GROUP BY 1), s AS (SELECT predicted AS class, count(*) AS said FROM p GROUP BY 1),
r AS (SELECT class, support, hits / said AS prec, hits / support AS rec FROM t LEFT JOIN s USING (class))"""


@query(_REPORT + " SELECT class, support, round(prec, 6) AS precision, round(rec, 6) AS recall, round(2 * prec * rec / (prec + rec), 6) AS f1 FROM r")
def m06_class_report(spark, d):
    return rounded(ml.class_report(_predictions(spark, d)))


@query(_REPORT + " SELECT round(sum(rec * support) / sum(support), 6) AS accuracy, round(avg(rec), 6) AS balanced_accuracy, round(avg(2 * prec * rec / (prec + rec)), 6) AS macro_f1, round(sum(2 * prec * rec / (prec + rec) * support) / sum(support), 6) AS weighted_f1 FROM r")
def m05_m06_class_metrics(spark, d):
    return rounded(ml.class_metrics(_predictions(spark, d)))


@query("WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS x FROM lineitem) SELECT round(avg(abs(y - x)), 3) AS mae, round(avg((y - x) ** 2), 0) AS mse, round(sqrt(avg((y - x) ** 2)), 3) AS rmse, round(1 - avg((y - x) ** 2) / var_pop(y), 6) AS r2 FROM p")
def m07_regression_metrics(spark, d):
    m = ml.regression_metrics(_lineitem(spark, d).select(F.col("l_extendedprice").alias("truth"), (F.col("l_quantity") * 1500).alias("predicted")))
    return m.select(sql_round(F.col("mae"), 3).alias("mae"), sql_round(F.col("mse"), 0).alias("mse"), sql_round(F.col("rmse"), 3).alias("rmse"), sql_round(F.col("r2"), 6).alias("r2"))


@query()
def m08_m10_utility(spark, d, **sizes):
    return spark.createDataFrame(ml.utility(_tier_data(spark, d), _score_data(spark, d), **sizes), "part string, name string, value double")


def queries() -> dict:
    return Q


def oracle_sql() -> dict[str, str]:
    return SQL
