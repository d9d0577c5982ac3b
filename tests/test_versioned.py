"""Keyed tables by touched buckets, streams into them, and the log of a resumable run."""

import os

import pytest
from pyspark.sql import functions as F

from strokelab.sources import tables, versioned
from strokelab.streaming import ingest, statelog

ROW = "k long, v string, _seq long"


def content(spark, path, *columns):
    return sorted(map(tuple, versioned.read(spark, path).select(*columns).collect()), key=repr)


def folders(spark, path):
    return versioned.latest(spark, path)[1]["folders"]


def test_last_row_of_a_key_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.merge(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "n", 1)], ROW), path, ["k"])
    versioned.merge(spark.createDataFrame([(1, "late", 0), (2, "c", 3), (None, "m", 2)], ROW), path, ["k"])
    assert content(spark, path, "k", "v") == [(1, "b"), (2, "c"), (None, "m")]
    assert content(spark, path, "v") == sorted([("b",), ("c",), ("m",)])
    assert sorted(map(tuple, versioned.read(spark, path, 1).select("k", "v").collect()), key=repr) == [(1, "b"), (None, "n")]


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.merge(spark.range(2000).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).cast("long").alias("_seq")), path, ["k"], buckets=32)
    before = folders(spark, path)
    assert len(before) == 32
    versioned.merge(spark.createDataFrame([(7, "new", 2)], ROW), path, ["k"])
    after = folders(spark, path)
    changed = [b for b in after if after[b] != before[b]]
    assert len(changed) == 1 and os.listdir(f"{path}/data/{after[changed[0]]}").count(f"_bucket={changed[0]}") == 1
    moved = sum(len(os.listdir(f"{path}/data/{f}")) for f in set(after.values()) - set(before.values()))
    assert moved <= 3  # one bucket, _SUCCESS and its checksum
    assert versioned.read(spark, path).count() == 2000 and (7, "new") in content(spark, path, "k", "v")


def test_stopped_between_write_and_switch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versioned.merge(spark.createDataFrame([(1, "a", 1)], ROW), path, ["k"])

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versioned, "_switch", stopped)
        with pytest.raises(KeyboardInterrupt):
            versioned.merge(spark.createDataFrame([(1, "b", 2), (2, "c", 2)], ROW), path, ["k"])
    assert content(spark, path, "k", "v") == [(1, "a")]
    versioned.merge(spark.createDataFrame([(2, "d", 3)], ROW), path, ["k"])
    assert content(spark, path, "k", "v") == [(1, "a"), (2, "d")]
    assert versioned.vacuum(spark, path, keep=1) >= 1 and content(spark, path, "k", "v") == [(1, "a"), (2, "d")]
    assert len(versioned.numbers(spark, f"{path}/versions")) == 1


def test_two_writers_and_cut_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versioned.merge(spark.createDataFrame([(1, "a", 1)], ROW), path, ["k"])
    switch = versioned._switch

    def late(*arguments):
        with monkeypatch.context() as m:
            m.setattr(versioned, "_switch", switch)
            versioned.merge(spark.createDataFrame([(2, "other", 1)], ROW), path, ["k"])
        switch(*arguments)

    with monkeypatch.context() as m:
        m.setattr(versioned, "_switch", late)
        with pytest.raises(versioned.Conflict):
            versioned.merge(spark.createDataFrame([(1, "mine", 2)], ROW), path, ["k"])
    assert content(spark, path, "k", "v") == [(1, "a"), (2, "other")]
    # A version file that was cut short is passed over.
    with open(versioned.numbered_file(f"{path}/versions", 3), "w") as f:
        f.write("0" * 64 + "\n{")
    assert content(spark, path, "k", "v") == [(1, "a"), (2, "other")]
    # One that its checksum knows to be damaged is passed over too.
    with open(versioned.numbered_file(f"{path}/versions", 2), "w") as f:
        f.write("damaged")
    assert content(spark, path, "k", "v") == [(1, "a")]
    assert versioned.merge(spark.createDataFrame([(5, "on", 1)], ROW), path, ["k"]) == 4 and content(spark, path, "k", "v") == [(1, "a"), (5, "on")]


def test_columns_and_kinds(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.merge(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], ROW), path, ["k"])
    versioned.merge(spark.createDataFrame([(2, "c", 2, True)], f"{ROW}, more boolean"), path, ["k"])
    assert content(spark, path, "k", "v", "more") == [(1, "a", None), (2, "c", True)]
    with pytest.raises(TypeError, match="column v"):
        versioned.merge(spark.createDataFrame([(1, 5, 3)], "k long, v int, _seq long"), path, ["k"])
    with pytest.raises(ValueError, match="keys"):
        versioned.merge(spark.createDataFrame([(1, "a", 3)], ROW), path, ["v"])
    versioned.merge(spark.createDataFrame([], ROW), path, ["k"])
    assert versioned.read(spark, path).count() == 2
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, str(tmp_path / "none"))


def test_upsert_says_where_a_rename_failed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert(spark.createDataFrame([(1, "a", 1)], ROW), path, ["k"])
    real = tables._hadoop

    class Refuses:
        def __init__(self, fs, part):
            self.fs, self.part = fs, part

        def __getattr__(self, name):
            return (lambda a, b: False if self.part in a.getName() else self.fs.rename(a, b)) if name == "rename" else getattr(self.fs, name)

    for part in ("staging", "t"):
        with monkeypatch.context() as m:
            m.setattr(tables, "_hadoop", lambda s, p, part=part: (Refuses(real(s, p)[0], part), real(s, p)[1]))
            with pytest.raises(OSError, match="can't be"):
                tables.upsert(spark.createDataFrame([(1, "b", 2)], ROW), path, ["k"])
        assert [r["v"] for r in spark.read.parquet(path).collect()] == ["a"]


def test_stream_equals_batch_and_replays(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema, seen = "k long, v string", []
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.mode("append").parquet(src)
    ingest.ingest(spark, src, out, state, schema, ["k"], "k").awaitTermination()
    spark.createDataFrame([(2, "c"), (3, "d")], schema).coalesce(1).write.mode("append").parquet(src)
    ingest.ingest(spark, src, out, state, schema, ["k"], "k", callback=lambda n, _: seen.append(n)).awaitTermination()
    assert content(spark, out, "k", "v") == [(1, "a"), (2, "c"), (3, "d")] and seen == [1]
    # The batch came through, but the stream didn't write that it did.
    for name in os.listdir(f"{state}/commits"):
        if name.strip(".").startswith("1"):
            os.remove(f"{state}/commits/{name}")
    at = versioned.latest(spark, out)[0]
    ingest.ingest(spark, src, out, state, schema, ["k"], "k").awaitTermination()
    assert versioned.latest(spark, out)[0] == at and content(spark, out, "k", "v") == [(1, "a"), (2, "c"), (3, "d")]


def outcomes(spark, ids, status, at):
    return spark.createDataFrame([(i, status, at) for i in ids], statelog.ROWS)


def cut_short(spark, folder):
    for f in spark.read.parquet(folder).inputFiles():
        with open(f.removeprefix("file://"), "wb") as x:
            x.write(b"PAR1")


def test_log_by_configuration(spark, tmp_path):
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    log = statelog.StateLog(spark, str(tmp_path), "one")
    log.append(spark.createDataFrame([("a", "failed", 1), ("a", "completed", 2)], statelog.ROWS))
    assert [r[0] for r in log.pending(ids).collect()] == ["b"] and log.progress(2) == {"completed": 1, "failed": 0, "remaining": 1}
    assert statelog.StateLog(spark, str(tmp_path), "two").pending(ids).count() == 2
    # The later epoch counts where times are equal.
    log.append(outcomes(spark, ["a"], "running", 2))
    assert log.pending(ids).count() == 2


def test_a_broken_epoch_loses_its_own_rows(spark, tmp_path):
    log = statelog.StateLog(spark, str(tmp_path), "x", every=4)
    ids = spark.createDataFrame([(f"s{i}",) for i in range(12)], "id string")
    for i in range(6):
        log.append(outcomes(spark, [f"s{2 * i}", f"s{2 * i + 1}"], "completed", i))
    home = tmp_path / "x"
    assert sorted(os.listdir(home / "snapshots"))[:1] == [".00000004.json.crc"] or "n=4" in os.listdir(home / "snapshots")
    assert log.pending(ids).count() == 0
    cut_short(spark, str(home / "epochs" / "n=6"))
    assert sorted(r[0] for r in log.pending(ids).collect()) == ["s10", "s11"] and log.lost() == [6]
    # The first snapshot's epochs are still there, so losing it loses nothing.
    cut_short(spark, str(home / "snapshots" / "n=4"))
    assert sorted(r[0] for r in log.pending(ids).collect()) == ["s10", "s11"]
    for i in range(7, 10):
        log.append(outcomes(spark, ["s10", "s11"], "completed", i))
    assert log.pending(ids).count() == 0


def test_two_generations_stay(spark, tmp_path):
    log = statelog.StateLog(spark, str(tmp_path), "x", every=2)
    for i in range(7):
        log.append(outcomes(spark, [f"s{i}"], "completed", i))
    assert log._numbers("snapshots") == [6, 4] and log._numbers("epochs") == [7, 6, 5]
    cut_short(spark, str(tmp_path / "x" / "snapshots" / "n=6"))
    assert log.status().count() == 7
    # A run that ended before the digest file: the epoch isn't there, and its number is used again.
    for name in ("00000007.json", ".00000007.json.crc"):
        os.remove(tmp_path / "x" / "epochs" / name)
    assert log.status().count() == 6 and log.append(outcomes(spark, ["z"], "failed", 9)) == 7
    assert {r["id"] for r in log.status().collect()} == {f"s{i}" for i in range(6)} | {"z"}


def test_profiles_and_splits_come_back(spark, tmp_path):
    log = statelog.StateLog(spark, str(tmp_path), "x")
    assert log.load("splits") is None
    log.save(spark.createDataFrame([("p1", "train"), ("p2", "val")], "profile_id string, split string"), "splits", ["profile_id"])
    log.save(spark.createDataFrame([("p2", "test")], "profile_id string, split string"), "splits", ["profile_id"])
    log.save(spark.createDataFrame([("p1", (3.5, [60, 90]))], "profile_id string, timing struct<sd: double, tempo: array<int>>"), "profiles", ["profile_id"])
    assert sorted(map(tuple, log.load("splits").collect())) == [("p1", "train"), ("p2", "test")]
    assert log.load("profiles").first()["timing"].asDict() == {"sd": 3.5, "tempo": [60, 90]}


def test_a_stopped_run_goes_on(spark, tmp_path):
    expected = spark.range(40).select(F.col("id").cast("string").alias("id"))
    done, told = [], []

    def work(todo):
        ids = [r[0] for r in todo.collect()]
        if len(done) == 2:
            raise RuntimeError("stopped")
        done.append(ids)
        return outcomes(spark, ids, "completed", 0).select("id", F.when(F.col("id") == "3", "failed").otherwise("completed").alias("status"))

    log = statelog.StateLog(spark, str(tmp_path), "x")
    with pytest.raises(RuntimeError, match="stopped"):
        log.run(expected, work, 10, lambda: 1, told.append)
    assert len(told) == 2 and told[0]["remaining"] > told[1]["remaining"] > 0
    first, done = [i for ids in done for i in ids], []
    end = log.run(expected, work, 100, lambda: 2)
    assert end["remaining"] == 0 and end["failed"] == 1 and sorted(first + done[0], key=int) == [str(i) for i in range(40)]
