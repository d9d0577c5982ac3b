"""Table functions of SQL against the built-in expansions."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strokelab.functions import table_functions
from strokelab.operators import sequences
from strokelab.plans import fixtures as fx


@pytest.fixture(scope="module")
def sql(spark):
    table_functions.register(spark)
    return spark.sql


def test_sticking(spark, sql):
    rows = [(1, "R L b B", "> .. >"), (2, "rlrl", ">..>"), (3, "RL", ">"), (4, None, ">"), (5, "", ""), (6, "RBBBL", ".....")]
    texts = spark.createDataFrame(rows, "id int, sticking string, accents string")
    got = sorted(map(tuple, sql("SELECT id, e.* FROM {t}, LATERAL expand_sticking(sticking, accents) e", t=texts).collect()))
    assert got == sorted(map(tuple, sequences.parse_sticking(texts, "sticking", "accents", "id").collect()))
    assert {r[0] for r in got} >= {2, 6}


def test_schema_follows_the_arguments(sql):
    assert sql("SELECT * FROM expand_sticking('RL')").columns == ["position", "hand"]
    assert sql("SELECT * FROM expand_sticking('RL', '>.')").columns == ["position", "hand", "stroke_type"]
    assert dict(sql("SELECT * FROM expand_bounces(1.5D, 90, 2, 25, 0.85D)").dtypes) == {"j": "int", "time_ms": "double", "velocity": "int"}
    assert dict(sql("SELECT * FROM expand_bounces(1.5D, 90L, 2, 25, 0.85D)").dtypes)["velocity"] == "bigint"
    with pytest.raises(AnalysisException, match="not string"):
        sql("SELECT * FROM expand_sticking(5)")


def test_bounces(spark, small, sql):
    e = fx.events(spark, small)
    n = F.when(F.col("stroke_type") == "buzz", 2 + F.col("position") % 3).otherwise(1).cast("int")
    got = sql("SELECT sample_id, position, x.* FROM {e}, LATERAL expand_bounces(actual_time_ms, actual_velocity, n, 25, 0.85D) x", e=e.withColumn("n", n))
    want = sequences.bounces(e, (2 + F.col("position") % 3).cast("int"), F.lit(25.0))
    rows = lambda df, *c: sorted((r[0], round(r[1], 6), r[2]) for r in df.select(*c).collect())
    assert rows(got, "sample_id", "time_ms", "velocity") == rows(want, "sample_id", "actual_time_ms", "actual_velocity")
