"""Exact quantiles by ranges and sketches that merge, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strokelab.operators import quantiles, stats

PROBS = {"low": 0.0, "p25": 0.25, "p50": 0.5, "odd": 0.373, "p99": 0.99, "high": 1.0}


def frame(spark, groups):
    return spark.createDataFrame([(g, None if x is None else float(x)) for g, xs in groups.items() for x in xs], "g string, x double").repartition(5)


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(5)
    return {
        "normal": rng.normal(size=3000),
        "steep": 2.0 ** rng.integers(-900, 900, 2000),
        "constant": np.full(500, 7.5),
        "two": np.repeat([1.0, 9.0], [1500, 2]),
        "one": [3.0],
        "pair": [1.0, 2.0],
        None: rng.integers(0, 50, 900),
        "mass": np.concatenate([np.zeros(2500), rng.random(800)]),
    }


@pytest.mark.parametrize("sort_rows", [40, 50_000])
def test_exact(spark, groups, sort_rows):
    got = {r["g"]: r for r in quantiles.exact(frame(spark, groups | {"none": [None, None]}), "x", PROBS, ["g"], sort_rows=sort_rows, k=200).collect()}
    assert set(got) == {*groups, "none"} and got["none"]["p50"] is None
    for g, xs in groups.items():
        for n, p in PROBS.items():
            assert got[g][n] == pytest.approx(float(np.quantile(np.asarray(xs, float), p)), rel=1e-9, abs=1e-300), (g, n)


def test_whole_table(spark, groups):
    every = np.concatenate([np.asarray(x, float) for x in groups.values()])
    row = quantiles.exact(frame(spark, groups), "x", PROBS, sort_rows=500, k=400).collect()
    assert len(row) == 1 and all(row[0][n] == pytest.approx(float(np.quantile(every, p))) for n, p in PROBS.items())
    assert quantiles.exact(frame(spark, {"a": [None]}), "x", PROBS).collect()[0]["p50"] is None
    assert quantiles.exact(frame(spark, groups).limit(0), "x", PROBS, ["g"]).count() == 0


def test_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 7).alias("part"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("tier"), (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 1.0).alias("x"))
    kept = quantiles.sketches(df, "x", ["part", "tier"])
    assert kept.count() == 14
    for r in quantiles.estimated(quantiles.merged(kept, ["tier"]), {"p10": 0.1, "p50": 0.5}).collect():
        assert r["n"] == 20_000 and abs(r["p10"] - 1000) < 300 and abs(r["p50"] - 5000) < 300


def test_statistics_by_ranges_are_the_same(spark, groups):
    df = frame(spark, {g: x for g, x in groups.items() if g != "steep"})  # whose sums depend on their order
    key = lambda rows: sorted(([None if v is None else v if isinstance(v, str) else float(f"{v:.7g}") + 0.0 for v in r] for r in rows), key=repr)
    for f, a in ((stats.described, ("x", "g")), (stats.box_plot, ("x", "g")), (stats.distribution, ("x",))):
        one, many = f(df, *a), f(df, *a, ranges=True)
        assert one.columns == many.columns and key(one.collect()) == key(many.collect())
        assert "percentile(" not in many._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["b01_distribution", "b02_distribution_by_tier", "b03_dataset_stats", "b17_described", "b21_box_plot", "f11_trim_outliers"])
def test_queries_keep_no_buffer_of_all_values(spark, small, name):
    from strokelab.plans import registry

    assert "percentile(" not in registry.queries()[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
