"""Checks of several tables in one pass, against plain counts, on awkward tables, and the shape of the plan."""

import pytest

from strokelab.operators import audit, checks


def tables(spark, samples, strokes):
    return {
        "samples": spark.createDataFrame(samples, "sample_id long, num_strokes int, skill_tier string, score double"),
        "strokes": spark.createDataFrame(strokes, "sample_id long, actual_velocity int, stroke_type string, timing_error_ms double"),
    }


def every():
    return [
        audit.unique("samples"),
        audit.refs("strokes", "samples"),
        audit.counts("samples", "strokes", "num_strokes", "stroke"),
        audit.no_nulls("strokes", ["actual_velocity"]),
        audit.velocity("strokes"),
        audit.timing("strokes"),
        audit.ranges("samples", ["score"]),
        audit.tier_order("samples", "score", "tiers"),
    ]


def result(t):
    return {r["check"]: (r["passed"], r["message"], r["details"]) for r in audit.verify(t, every()).collect()}


def test_faults_are_found(spark):
    samples = [(1, 2, "beginner", 50.0), (2, 0, "advanced", 47.0), (2, 0, "advanced", 47.0), (3, None, "professional", 120.0), (None, None, None, None)]
    strokes = [(1, 64, "tap", 10.0), (1, None, "tap", -600.0), (9, 200, "grace", 900.0), (9, 1, "tap", None), (None, 5, "tap", 1.0)]
    r = result(tables(spark, samples, strokes))
    assert r["ids_unique"] == (False, "3 distinct of 5", {"duplicates": 2.0})
    assert r["strokes_refs"] == (False, "2 orphan ids", {"orphan_ids": 2.0, "orphan_rows": 3.0})  # 9 and null
    assert r["stroke_counts_match"] == (True, "0 of 4 differ", {"mismatches": 0.0})
    assert r["strokes_nulls"] == (False, "1 nulls in required columns", {"actual_velocity": 1.0})
    assert r["velocity_range"] == (False, "min 1, max 200", {"in_range": 0.75})
    assert r["timing_range"][0] is False and r["timing_range"][2] == {"max": 600.0, "mean": 203.6667, "within_200": 0.666667}
    assert r["score_ranges"] == (False, "1 columns out of range", {"score_min": 47.0, "score_max": 120.0})
    assert r["tiers"][:2] == (False, "3 tiers compared")  # 50 falls to 47


def test_sound_tables_pass(spark):
    r = result(tables(spark, [(1, 1, "beginner", 50.0), (2, 0, "advanced", 49.0)], [(1, 64, "tap", 10.0)]))
    assert all(passed for passed, _, _ in r.values())


def test_repeated_parents_with_other_counts(spark):
    r = result(tables(spark, [(1, 1, "beginner", 1.0), (1, 5, "beginner", 1.0)], [(1, 64, "tap", 1.0)]))
    assert r["stroke_counts_match"][1] == "1 of 1 differ"


def test_empty_tables(spark):
    r = result(tables(spark, [], []))
    assert r["ids_unique"][:2] == (True, "0 distinct of 0") and r["strokes_refs"][0] and r["tiers"][0] and r["stroke_counts_match"][0]
    assert r["velocity_range"][0] is False and r["velocity_range"][1] == "no rows"  # nothing says that it holds


def test_like_the_single_checks(spark, small):
    from strokelab.plans import fixtures as fx

    m, s = fx.samples(spark, small).where("sample_id % 17 <> 0"), fx.events(spark, small)
    got = audit.verify({"samples": m, "strokes": s}, [audit.unique("samples"), audit.refs("strokes", "samples"), audit.counts("samples", "strokes", "num_strokes", "stroke"), audit.velocity("strokes")])
    want = checks.verify_all([checks.ids_unique(m), checks.refs(s, m, "strokes"), checks.counts_match(m, s, "num_strokes", "stroke"), checks.velocity_range(s)])
    rows = lambda df: sorted((r["check"], r["passed"], r["message"], tuple(sorted((k, float(v)) for k, v in r["details"].items()))) for r in df.collect())
    assert rows(got) == rows(want)


def test_one_pass(spark, tmp_path):
    t = tables(spark, [(1, 1, "beginner", 50.0)], [(1, 64, "tap", 10.0)])
    for name, df in t.items():
        df.write.parquet(f"{tmp_path}/{name}")
    df = audit.verify({n: spark.read.parquet(f"{tmp_path}/{n}") for n in t}, every())
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "Join" not in plan
    executed = df._jdf.queryExecution().executedPlan().toString()
    assert executed.count("hashpartitioning") == 1


def test_names_must_differ(spark):  # columns need a session
    with pytest.raises(ValueError):
        audit.verify({}, [audit.unique("samples"), audit.unique("samples")])
