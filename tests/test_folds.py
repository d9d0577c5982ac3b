"""Order-dependent operators against plain loops, and sources, streaming and statistics on small frames."""

import random
import time

import pytest
from pyspark.sql import functions as F

from strokelab.functions import scalars
from strokelab.operators import filters, joins, sampling, sequences, stats, windows
from strokelab.plans import fixtures as fx
from strokelab.plans.q_tables import detections, truth
from strokelab.sources import catalogue, tables


def grouped(rows, key=0):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r[1:])
    return out


def test_match_nearest(spark, small):
    t, d = truth(spark, small), detections(spark, small)
    got = {tuple(r) for r in joins.match_nearest(t, d).select("sample_id", "position", "detected").collect()}
    have, want = grouped(d.select("sample_id", "detected", "time_ms").collect()), set()
    for s, rows in grouped(t.select("sample_id", "position", "time_ms", "velocity").collect()).items():
        taken = set()
        for p, time, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
            near = sorted((abs(time - x), k) for k, x in have.get(s, []) if abs(time - x) < 50 and k not in taken)
            if near:
                taken.add(near[0][1])
                want.add((s, p, near[0][1]))
    assert got == want and got


def greedy(truth, points, window=50):
    """truth: (position, time, velocity), points: (number, time)."""
    taken, out = set(), set()
    for p, t, _ in sorted(truth, key=lambda r: (-r[2], r[0])):
        near = sorted((abs(t - x), k) for k, x in points if abs(t - x) < window and k not in taken)
        if near:
            taken.add(near[0][1])
            out.add((p, near[0][1]))
    return out


@pytest.mark.parametrize("crowd", ["random", "ties", "ramp", "edge"])
def test_match_nearest_in_crowds(spark, crowd):
    rng, truths, points = random.Random(crowd), {}, {}
    for s in range(6):
        if crowd == "ramp":  # every stroke is stronger than the one before, and points are short by a few
            truths[s] = [(i, 20.0 * i, i) for i in range(60)]
            points[s] = [(i, 20.0 * i + 9) for i in range(0, 58 - s)]
        elif crowd == "edge":
            truths[s] = [(0, 100.0, 5), (1, 200.0, 5)]
            points[s] = [(0, 50.0), (1, 149.9), (2, 250.0)]
        else:
            step = 1 if crowd == "random" else 10
            truths[s] = [(i, float(rng.randrange(0, 900, step)), rng.randrange(1, 128 if crowd == "random" else 3)) for i in range(40)]
            points[s] = list(enumerate(sorted(float(rng.randrange(0, 900, step)) for _ in range(30))))
    t = spark.createDataFrame([(s, *r) for s, rows in truths.items() for r in rows], "sample_id int, position long, time_ms double, velocity int")
    d = spark.createDataFrame([(s, *r) for s, rows in points.items() for r in rows], "sample_id int, detected long, time_ms double")
    got = {tuple(r) for r in joins.match_nearest(t, d).select("sample_id", "position", "detected").collect()}
    assert got == {(s, *m) for s in truths for m in greedy(truths[s], points[s])}
    assert joins.match_nearest(t, d.limit(0)).count() == 0


def test_no_python_per_sample(spark, small):
    for df in (joins.match_nearest(truth(spark, small), detections(spark, small)), windows.merge_close(detections(spark, small))):
        assert "InPandas" not in df._jdf.queryExecution().toString()


def test_supplement_like_a_loop(spark):
    rng, rows = random.Random(9), {}
    for s in range(8):
        rows[s] = (sorted(round(rng.random() * 900, 1) for _ in range(60)), sorted(round(rng.random() * 900, 1) for _ in range(12)), [rng.choice((0.0, 0.005, 0.3)) for _ in range(rng.choice((40, 100)))])
    frame = lambda i, kind: spark.createDataFrame([(s, x) for s, r in rows.items() for x in r[i]], f"sample_id int, {kind} double")
    curves = spark.createDataFrame([(s, r[2]) for s, r in rows.items()], "sample_id int, activation array<double>")
    got = sorted(map(tuple, joins.supplement(frame(0, "time_ms"), frame(1, "time_ms"), curves).collect()))
    want = []
    for s, (times, have, curve) in rows.items():
        known = list(have)
        for t in times:
            a = curve[max(0, min(round(t / 1000 * 100), len(curve) - 1))]
            if all(abs(t - x) >= 20 for x in known) and a >= 0.01:
                known.append(t)
                want.append((s, t, a))
    assert got == sorted(want) and want


def test_supplement_sends_no_curves(spark):
    """Curves that are made on the way are of unknown size to Spark; they must stay where they are."""
    t = spark.range(500).select((F.col("id") % 50).alias("sample_id"), (F.col("id") * 30.0).alias("time_ms"))
    c = t.groupBy("sample_id").agg(F.array_repeat(F.lit(0.5), 7400).alias("activation"))
    df = joins.supplement(t, t.where("time_ms > 9000"), c)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [_key" in plan and "Inner, BuildLeft" in plan and not any("BroadcastHashJoin" in line and "Inner" in line for line in plan.splitlines())
    assert sorted(r["time_ms"] for r in df.collect()) == [i * 30.0 for i in range(301)]


def test_merge_close_of_one_long_sample(spark):
    df = spark.range(100_000).select(F.lit("s").alias("sample_id"), (F.col("id") * 15.0 + F.when(F.col("id") % 4 == 0, 30).otherwise(0)).alias("time_ms"), (F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0).alias("strength"))
    rows, kept = sorted((r["time_ms"], r["strength"]) for r in df.collect()), []
    for p in rows:
        if kept and p[0] - kept[-1][0] < 20:
            kept[-1] = p if p[1] > kept[-1][1] else kept[-1]
        else:
            kept.append(p)
    began = time.perf_counter()
    got = sorted((r["time_ms"], r["strength"]) for r in windows.merge_close(df).collect())
    assert got == kept and time.perf_counter() - began < 30


def test_measures_that_overlap(spark):
    rng = random.Random(2)
    events = {s: [(i, rng.randrange(60)) for i in range(50)] for s in range(5)}
    spans = {s: [(k, a, a + rng.randrange(0, 25)) for k, a in enumerate(rng.randrange(60) for _ in range(9))] for s in range(6)}
    e = spark.createDataFrame([(s, *r) for s, rows in events.items() for r in rows], "sample_id int, id int, index int")
    m = spark.createDataFrame([(s, *r) for s, rows in spans.items() for r in rows], "sample_id int, index int, stroke_start int, stroke_end int")
    got = sorted(map(tuple, joins.in_measures(e, m).select("sample_id", "id", "index", "measure").collect()))
    assert got == sorted((s, i, at, k) for s, rows in events.items() for i, at in rows for k, a, b in spans[s] if a <= at < b) and got


def test_sweep_rows_grow_with_the_events(spark):
    """One sample of 2,000 measures: no step makes more rows than events, borders and results."""
    n = 2000
    e = spark.range(8 * n).select(F.lit(1).alias("sample_id"), F.col("id").cast("int").alias("index"))
    m = spark.range(n).select(F.lit(1).alias("sample_id"), F.col("id").cast("int").alias("index"), (F.col("id") * 8).cast("int").alias("stroke_start"), (F.col("id") * 8 + 8).cast("int").alias("stroke_end"))
    df = joins.in_measures(e, m)
    assert df.count() == 8 * n
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "_at" in plan and not any("stroke_start" in line and ("<=" in line or ">=" in line) and "Join" in line for line in plan.splitlines())


def test_frames_by_runs(spark):
    rng, frames = random.Random(6), 360_000
    rows = [("long", i, rng.random() * 370_000_0, rng.choice("LR")) for i in range(6000)] + [("early", 0, -5.0, "L"), ("early", 1, 3.0, "R"), ("late", 0, 1e8, "L"), ("same", 0, 25.0, "R"), ("same", 1, 21.0, "L")]
    e = spark.createDataFrame(rows, "sample_id string, position int, actual_time_ms double, hand string")
    want = {s: ([0] * frames, [0] * frames) for s in ("long", "early", "late", "same")}
    for s, _, t, hand in rows:
        if int(t / 10) < frames:
            want[s][0][int(t / 10)], want[s][1][int(t / 10)] = 1, 1 if hand == "L" else 2
    began = time.perf_counter()
    for i, f in enumerate((sequences.onset_targets, sequences.hand_targets)):
        assert {r["sample_id"]: r["targets"] for r in f(e, frames, 10.0).collect()} == {s: w[i] for s, w in want.items()}
    assert time.perf_counter() - began < 60


def test_supplement(spark):
    t = spark.createDataFrame([("s", 100.0), ("s", 110.0), ("s", 300.0), ("s", 500.0)], "sample_id string, time_ms double")
    d = spark.createDataFrame([("s", 310.0)], "sample_id string, time_ms double")
    c = spark.createDataFrame([("s", [0.5] * 45)], "sample_id string, activation array<double>")
    got = sorted(r["time_ms"] for r in joins.supplement(t, d, c).collect())
    assert got == [100.0, 500.0]  # 110 is near the added 100, 300 near a detection, 500 falls on the clamped last frame


def test_merge_close(spark, small):
    d = detections(spark, small)
    got = sorted(map(tuple, windows.merge_close(d).collect()))
    want = []
    for s, rows in grouped(d.select("sample_id", "time_ms", "strength").collect()).items():
        kept = []
        for p in sorted(rows):
            if kept and p[0] - kept[-1][0] < 20:
                if p[1] > kept[-1][1]:
                    kept[-1] = p
            else:
                kept.append(p)
        want += [(s, *p) for p in kept]
    assert got == sorted(want)


def test_cycle_cuts(spark):
    p = spark.createDataFrame([("s", float(x)) for x in (0, 100, 200, 300, 370, 400, 500, 600)], "sample_id string, time_ms double")
    rows = windows.cycle_cuts(p, F.lit(2)).orderBy("cycle").collect()
    assert [(r["first"], r["last"], r["start_ms"], r["end_ms"]) for r in rows] == [(0, 3, 0.0, 350.0), (4, 7, 320.0, 650.0)]
    tight = spark.createDataFrame([("s", float(x)) for x in (0, 100, 200, 300, 320, 400, 500, 600)], "sample_id string, time_ms double")
    assert [(r["first"], r["last"]) for r in windows.cycle_cuts(tight, F.lit(2)).orderBy("cycle").collect()] == [(0, 4), (5, 7)]


def cuts(times, target):
    n = len(times)
    if n < 4:
        return [(0, n - 1)]
    starts = [0]
    for k in range(1, target):
        i = round(k * n / target)
        starts.append(min(i + 1, n - 1) if times[i] - times[i - 1] < 40 else i)
    return list(zip(starts, [s - 1 for s in starts[1:]] + [n - 1], strict=True))


def test_cycle_cuts_like_a_loop(spark):
    rng = random.Random(4)
    samples = {s: sorted(round(rng.random() * n * rng.choice((20, 90, 400)), 1) for _ in range(n)) for s, n in enumerate((1, 2, 3, 4, 5, 13, 20, 41, 70, 300))}
    p = spark.createDataFrame([(s, t) for s, times in samples.items() for t in times], "sample_id int, time_ms double")
    for target in (None, 4):
        got = {}
        for r in windows.cycle_cuts(p, None if target is None else F.lit(target)).orderBy("cycle").collect():
            got.setdefault(r["sample_id"], []).append(r)
        for s, times in samples.items():
            want = cuts(times, max(2, min(6, len(times) // 7)) if target is None else target)
            assert [(r["first"], r["last"]) for r in got[s]] == want
            assert [(r["start_ms"], r["end_ms"]) for r in got[s]] == [(max(0, times[a] - 50), times[b] + 50) for a, b in want]


def test_pending_golden(spark):
    ids = spark.createDataFrame([(f"s{i}",) for i in range(1, 6)], "id string")
    status = spark.createDataFrame([("s1", "completed"), ("s3", "failed")], "id string, status string")
    assert sorted(r[0] for r in joins.pending(ids, status).collect()) == ["s2", "s4", "s5"]


def test_export_golden(spark):
    s = spark.createDataFrame([("s1", "p1"), ("s2", "p1"), ("s3", "p2"), ("s4", "p3")], "sample_id string, profile_id string").withColumn("audio_path", F.lit("a/x.flac")).withColumn("midi_path", F.lit(""))
    x = spark.createDataFrame([("s1", 1.0)], "sample_id string, overall_score double")
    splits = spark.createDataFrame([("p1", "train"), ("p2", "val"), ("p3", "test")], "profile_id string, split string")
    out = tables.export_config(s, x, splits)
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 2, "validation": 1, "test": 1}
    assert not {"audio_path", "midi_path"} & set(out.columns)
    media = spark.createDataFrame([("file:/d/a/x.flac", bytearray(b"abc"))], "path string, content binary")
    assert tables.export_config(s, x, splits, "audio", media).where("audio is not null").count() == 4
    assert tables.export_config(s, x, splits, "midi_only", media).where("midi is null").count() == 4


def test_upsert_and_broken_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, _seq int"), path, ["k"])
    tables.upsert(spark.createDataFrame([(1, "c", 3, True), (2, "d", 1, False)], "k int, v string, _seq int, more boolean"), path, ["k"])
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v", "more").collect())) == [(1, "c", True), (2, "d", False)]
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not parquet")
    tables.upsert(spark.createDataFrame([(1, "a", 1)], "k int, v string, _seq int"), str(broken), ["k"])
    assert spark.read.parquet(str(broken)).count() == 1


def test_catalogue(spark, tmp_path):
    (tmp_path / "a.yaml").write_text('name: "Flam Tap"\nslug: flam_tap\ncategory: flam\nsticking: lRL\naccents: ".> "\n')
    r = catalogue.load(spark, str(tmp_path)).first()
    assert r["slug"] == "flam_tap" and [(s["hand"], s["stroke_type"]) for s in r["pattern"]] == [("L", "grace"), ("R", "accent"), ("L", "tap")]


@pytest.mark.parametrize("pattern", ["{simple: R L, accents: '>'}", "{strokes: [R, X]}", "{beats_per_cycle: 1}"])
def test_bad_patterns_fail(spark, tmp_path, pattern):
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text(f"slug: a\npattern: {pattern}\n")
    with pytest.raises(Exception, match="length|no hand|no pattern"):
        catalogue.load(spark, str(tmp_path)).collect()


def test_byte_cap_of_exports(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("sample_id"), F.repeat(F.lit("ab"), (F.col("id") % 50).cast("int")).alias("text"), F.lit("train").alias("split"))
    tables.write_export(df, str(tmp_path / "x"), max_shard_bytes=5000)
    files = list((tmp_path / "x" / "split=train").glob("*.parquet"))
    # 48 kB of rows: full shards of five sixths or more, none over the cap.
    assert 10 <= len(files) <= 12 and max(f.stat().st_size for f in files) <= 5000 and spark.read.parquet(str(tmp_path / "x")).count() == 500


def test_many_shards_are_few_tasks(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").alias("sample_id"), F.repeat(F.lit("ab"), (F.col("id") % 50).cast("int")).alias("text"), F.when(F.col("id") % 3 == 0, "val").otherwise("train").alias("split"))
    group = f"shards-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, group)
    for _ in range(2):  # the second takes the first one's place
        tables.write_export(df, str(tmp_path / "x"), max_shard_bytes=1000)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup(group) for i in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    files = list((tmp_path / "x").glob("split=*/*.parquet"))
    assert len(files) > 200 and max(s.numTasks for s in stages if s) <= 32 and not list(tmp_path.glob("x/split=*/_shard*")) and [p.name for p in tmp_path.iterdir()] == ["x"]
    back = spark.read.parquet(str(tmp_path / "x"))
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    assert back.groupBy(F.input_file_name()).agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0] <= 1000


@pytest.mark.parametrize("kind", ["plain", "moved"])
def test_files_of_shards_are_made_by_tasks(spark, tmp_path, monkeypatch, kind):
    renamed, hadoop = [], tables._hadoop

    class Watched:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return (lambda *a: (renamed.append(a), self.fs.rename(*a))[1]) if name == "rename" else getattr(self.fs, name)

    monkeypatch.setattr(tables, "_hadoop", lambda *a: (Watched(hadoop(*a)[0]), hadoop(*a)[1]))
    names = F.array(F.lit("a/b=c%"), F.lit("ü x:y{z}"), F.lit(""), F.lit(None).cast("string"), F.lit("train"))
    df = spark.range(1500).select(
        F.col("id").alias("sample_id"),
        names[(F.col("id") % 5).cast("int")].alias("split"),
        F.repeat(F.lit("ab"), (F.col("id") % 40).cast("int")).alias("the text"),
        F.array(F.struct(F.col("id").cast("decimal(12,2)").alias("d"), F.lit(None).cast("int").alias("n"))).alias("nested"),
        F.timestamp_seconds(F.col("id") * 1e6).alias("at"),
        F.expr("date'1400-01-01' + cast(id as int)").alias("day"),
        F.expr("cast(id as string)").cast("binary").alias("raw"),
        (F.expr("make_dt_interval(0, 0, 0, id)") if kind == "moved" else F.map_from_arrays(F.array(F.lit("k")), F.array("id"))).alias("kind"),
    )
    tables.write_export(df, str(tmp_path / "x"), max_shard_bytes=2000)
    files = list((tmp_path / "x").glob("split=*/*.parquet"))
    assert len(files) > 90 and (len(renamed) == 1 or kind == "moved") and (tmp_path / "x" / "_SUCCESS").exists()
    df.write.partitionBy("split").parquet(str(tmp_path / "y"))
    assert {f.parent.name for f in files} == {f.parent.name for f in (tmp_path / "y").glob("split=*/*.parquet")}
    back, plain = spark.read.parquet(str(tmp_path / "x")), spark.read.parquet(str(tmp_path / "y"))
    assert back.schema == plain.schema and sorted(map(repr, back.collect())) == sorted(map(repr, plain.collect()))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["x", "y"]


def test_ranges_of_shards_are_bounded(spark, tmp_path, monkeypatch):
    df = spark.range(1000, numPartitions=1).select(F.col("id").alias("sample_id"), F.repeat(F.lit("ab"), (F.col("id") % 50).cast("int")).alias("text"), F.lit("train").alias("split"))
    want = sorted(map(tuple, tables.sharded(df, 1000)[0].collect()))
    monkeypatch.setattr(tables, "RANGE_BITS", 5)
    got, n = tables.sharded(df, 1000)
    assert sorted(map(tuple, got.collect())) == want and n == len({r[-1] for r in want})


def test_numbers_of_ranges(spark):
    from strokelab.operators.numbering import numbered

    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    assert [tuple(r) for r in numbered(df, ["k"], "n").orderBy("k").collect()] == [(i, i) for i in range(1000)]


def test_learnability():
    from strokelab.operators import ml

    got = ml.learnability([{"scores": [s], "mean": s} for s in (0.2, 0.3, 0.5)] + [{"scores": [0.4, 0.6], "mean": 0.5}])
    assert got["improves"] and got["fold_sd"] == pytest.approx(0.1) and (got["fold_min"], got["fold_max"]) == (0.4, 0.6)
    assert got["convergence"] == pytest.approx(1 - 0.0942809 / 0.4333333, abs=1e-5)
    assert [ml.verdict(*x) for x in ((0.8, 0.6), (0.8, 0.1), (0.1, 0.4), (0.5, 0.3))] == ["PASSED", "PARTIAL", "PARTIAL", "NEEDS REVIEW"]


def test_onset_times_follow_the_tempo(spark):
    rows = [("s", 0, 0, "note_on", 90, None), ("s", 1, 480, "note_on", 90, None), ("s", 2, 0, "set_tempo", 0, 1_000_000), ("s", 3, 480, "note_on", 90, None), ("s", 4, 10, "note_on", 0, None)]
    m = spark.createDataFrame(rows, "sample_id string, seq int, delta_ticks int, type string, velocity int, tempo_us int").withColumn("ticks_per_beat", F.lit(480))
    assert [r["time_ms"] for r in tables.onset_times(m).orderBy("seq").collect()] == [0.0, 500.0, 1500.0]


def test_constant_columns_do_not_fail(spark):
    df = spark.createDataFrame([("beginner", 1.0, 1.0), ("advanced", 1.0, 2.0)], "skill_tier string, a double, b double")
    assert stats.correlation_matrix(df, ["a", "b"]).first()["r"] is None
    assert stats.distribution(df, "a").first()["skewness"] == 0.0
    assert stats.anova(df, ["a"]).first()["f"] is None


def test_f_tail():
    assert stats.f_tail(4.0, 2, 10) == pytest.approx(0.0531, abs=5e-4)
    assert stats.f_tail(0.0, 2, 10) == 1.0


def test_splits_are_sound(spark, small):
    o = fx.scored_orders(spark, small)
    for s in (sampling.random_split(o), sampling.stratified_split(o)):
        assert s.count() == s.select("profile_id").distinct().count() == o.select("profile_id").distinct().count()
    with pytest.raises(ValueError, match="sum"):
        sampling.random_split(o, (0.5, 0.1, 0.1))
    two = spark.createDataFrame([(1, "beginner"), (2, "beginner")], "profile_id int, skill_tier string")
    assert "train" in {r["split"] for r in sampling.stratified_split(two).collect()}


def test_unknown_condition_is_skipped(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, p string")
    with pytest.warns(UserWarning, match="nothing"):
        assert filters.where_all(df, {"p": None, "nothing": 1}).count() == 1
    assert filters.clean(df.drop("p"), "p").count() == 2


def test_sample_ids_round_trip(spark):
    df = spark.createDataFrame([("professional", 3, "single_paradiddle", 120, "Marching_GM_GS", None)], "t string, n int, s string, b int, f string, p string")
    sid = scalars.sample_id(*map(F.col, ("t", "n", "s", "b", "f", "p")))
    r = df.select(sid.alias("i"), scalars.parse_sample_id(sid).alias("p")).first()
    assert r["i"] == "pro003_single_paradiddle_120bpm_marching_clean" and r["p"]["slug"] == "single_paradiddle" and r["p"]["tempo_bpm"] == 120


def test_halves_round_to_even(spark):
    r = spark.range(1).select(scalars.cycles_for(F.lit(5.0), F.lit(2.0)).alias("a"), scalars.cycles_for(F.lit(0.1), F.lit(2.0)).alias("b"), scalars.sample_index(F.lit(-3.7), 1000).alias("c")).first()
    assert tuple(r) == (2, 1, -3)


def test_upsert_keeps_a_broken_table(spark, tmp_path):
    import os

    from strokelab.sources import tables

    path = str(tmp_path / "t.parquet")
    os.mkdir(path)
    (tmp_path / "t.parquet" / "part-0.parquet").write_bytes(b"no parquet at all")
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "id long, v string, _seq long")
    tables.upsert(new, path, ["id"])
    kept = [d for d in os.listdir(tmp_path) if d.startswith("t.parquet.broken")]
    assert [r["v"] for r in spark.read.parquet(path).collect()] == ["b"] and len(kept) == 1
    assert os.path.exists(tmp_path / kept[0] / "part-0.parquet")
