"""Correlations of many columns against pairs, and byte shards of exports."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strokelab.operators import gram, stats
from strokelab.sources import tables


def test_like_pairs(spark):
    u = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 7.0
    df = spark.range(400).select(*[F.when(u(50 + i) > 20, u(i) + u(0) * i + 1e6 * i).alias(f"x{i}") for i in range(6)], F.lit(3).alias("constant"), F.lit("text").alias("t"), (F.col("id") % 2 == 0).alias("flag"), F.lit(None).cast("double").alias("none")).repartition(3)
    assert gram.numeric_columns(df) == [*[f"x{i}" for i in range(6)], "constant", "flag", "none"]
    many = {(r["a"], r["b"]): (r["n"], r["r"]) for r in gram.correlations(df).collect()}
    pairs = {(r["a"], r["b"]): (r["n"], r["r"]) for r in stats.correlation_matrix(df.withColumn("flag", F.col("flag").cast("int")), gram.numeric_columns(df)).collect()}
    assert many.keys() == pairs.keys()
    for k, (n, r) in pairs.items():
        assert many[k][0] == n and (many[k][1] is None if r is None else many[k][1] == pytest.approx(r, abs=1e-9)), k


def test_three_hundred_columns_in_one_pass(spark):
    k = 300
    df = spark.range(300).select(*[F.when(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(5)) > 0, F.pmod(F.xxhash64("id", F.lit(-1 - i % 40)), F.lit(100)) * 1.0).alias(f"c{i}") for i in range(k)])
    out = gram.correlations(df)
    rows = out.collect()
    assert len(rows) == k * (k - 1) // 2 and out._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1
    x = df.toPandas().to_numpy(float)
    for r in rows[:: 997]:
        a, b = (x[:, int(c[1:])] for c in (r["a"], r["b"]))
        both = ~np.isnan(a) & ~np.isnan(b)
        assert r["n"] == both.sum() and r["r"] == pytest.approx(np.corrcoef(a[both], b[both])[0, 1], abs=1e-9)
    assert gram.correlations(df.limit(0), ["c0", "c1"]).collect()[0]["r"] is None
    assert gram.correlations(df, ["c0"]).count() == 0


def shards(spark, sizes, cap, parts=4):
    """Bytes of each shard by split, for rows of about these sizes."""
    rows = [(i, "train" if i % 3 else "val", "x" * max(0, n - 40)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "sample_id int, split string, text string").repartition(parts)
    out, n = tables.sharded(df, cap)
    size = F.octet_length(F.to_json(F.struct("sample_id", "split", "text")))
    found = out.groupBy("split", "_shard").agg(F.sum(size).alias("bytes"), F.max(size).alias("row")).collect()
    assert out.count() == len(rows) and {r["_shard"] for r in found} == set(range(n))
    return found


@pytest.mark.parametrize("kind", ["small", "mixed", "large", "few"])
def test_shards_by_bytes(spark, kind):
    rng = random.Random(kind)
    sizes = {"small": [rng.randrange(45, 120) for _ in range(900)], "mixed": [rng.choice((50, 90, 130, 260, 400, 480, 600, 990)) for _ in range(500)], "large": [rng.randrange(500, 1000) for _ in range(60)], "few": [60, 300, 140, 200]}[kind]
    found = shards(spark, sizes, 1000)
    for split in ("train", "val"):
        mine = [r["bytes"] for r in found if r["split"] == split]
        assert max(mine) <= 1000 and sum(b < 500 for b in mine) <= 1


def test_one_huge_row_changes_no_other_shard(spark):
    sizes = [60 + i % 50 for i in range(400)]
    plain, huge = (sorted(r["bytes"] for r in shards(spark, s, 1000, 1)) for s in (sizes, [*sizes, 50_000]))
    assert huge[:-1] == plain and huge[-1] > 49_000
