"""Progress of running jobs and streams."""

import time

import pytest
from pyspark.sql import functions as F

from strokelab.sources import versioned
from strokelab.streaming import ingest, progress


def test_numbers():
    p = progress.Progress(30, 10, 100, 15.0)
    assert (p.remaining, p.percent, p.rate, p.eta_sec) == (60, 30.0, 2.0, 30.0)
    unknown = progress.Progress(0, 0, None, 0.0)
    assert (unknown.remaining, unknown.percent, unknown.rate, unknown.eta_sec) == (None, None, None, None)


def slowly():
    def slow(batches):
        for b in batches:
            time.sleep(0.4)
            yield b

    return slow


def test_watch_reports_while_a_job_runs(spark):
    seen = []
    with progress.watch(spark, seen.append, every_sec=0.1):
        assert spark.range(0, 120, 1, 12).mapInPandas(slowly(), "id long").agg(F.count("id")).first()[0] == 120
    running = [p for p in seen if not p.done]
    assert len({p.completed for p in running}) > 1 and any(p.remaining for p in running)
    assert seen[-1].done and seen[-1].remaining == 0 and seen[-1].completed >= 13 and seen[-1].failed == 0
    n = len(seen)
    spark.range(10).count()
    assert len(seen) == n and spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_watch_reports_failed_tasks(spark):
    seen = []
    with pytest.raises(Exception, match="boom"), progress.watch(spark, seen.append):
        spark.range(8).select(F.raise_error(F.lit("boom"))).collect()
    assert seen[-1].done and seen[-1].failed >= 1


def test_errors_of_the_callback_are_raised(spark):
    def broken(_):
        raise KeyError("mine")

    with pytest.raises(KeyError), progress.watch(spark, broken, every_sec=0.05):
        spark.range(0, 4, 1, 4).mapInPandas(slowly(), "id long").count()


def test_stream_batches(spark, tmp_path):
    source = spark.range(40).select(F.col("id").alias("key"), F.when(F.col("id") % 10 == 3, None).otherwise(F.col("id")).alias("at"))
    source.repartitionByRange(4, "key").write.parquet(f"{tmp_path}/in")
    seen = []
    listener = progress.StreamProgress(seen.append, total=40)
    spark.streams.addListener(listener)
    try:
        q = ingest.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/log", "key long, at long", ["key"], "at", files_per_trigger=1, buckets=4, failed=F.col("at").isNull())
        q.awaitTermination(120)
        assert listener.wait(20)
    finally:
        spark.streams.removeListener(listener)
    running = [p for p in seen if not p.done]
    assert [p.completed + p.failed for p in running] == [10, 20, 30, 40] and [p.remaining for p in running] == [30, 20, 10, 0]
    assert seen[-1].done and (seen[-1].completed, seen[-1].failed) == (36, 4) and not listener.errors
    assert versioned.read(spark, f"{tmp_path}/out").count() == 36


def test_streams_of_another_name_are_left_out(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in")
    seen = []
    listener = progress.StreamProgress(seen.append, name="another")
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
        q = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/log").queryName("mine").trigger(availableNow=True).start()
        q.awaitTermination(60)
        time.sleep(1)
    finally:
        spark.streams.removeListener(listener)
    assert not seen


def test_tables_report_while_they_are_written(spark, tmp_path):
    from strokelab.sources import tables

    seen = []
    slow = spark.range(0, 40, 1, 8).mapInPandas(slowly(), "id long")
    assert tables.write_tables({"a": slow, "b": spark.range(3)}, str(tmp_path), callback=lambda name, p: seen.append((name, p))) == {"a": 40, "b": 3}
    assert [n for n, p in seen if p.done] == ["a", "b"] and any(n == "a" and p.remaining for n, p in seen)
