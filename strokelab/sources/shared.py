"""Tables written once into the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A fresh path below ``spark.checkpoint.dir``; in local mode a temporary folder stands in where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-flows-")
    return f"{root.rstrip('/')}/flow-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once and read back: used several times without being computed again, and safe if executors are lost."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
