"""User code on tables (O-X*, O-S16): whole batches through Arrow, never row by row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a function to batches of rows (O-X01, O-S16); ``spark.sql.execution.arrow.maxRecordsPerBatch`` sets their size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    return df.mapInPandas(run, schema)


def where(df: DataFrame, predicate: Column | Callable[..., pd.Series], *columns: str) -> DataFrame:
    """A Column where there is one; else a vectorised function of some columns (O-X02)."""
    if isinstance(predicate, Column):
        return df.where(predicate)
    chosen = F.pandas_udf(predicate, "boolean")
    return df.where(chosen(*map(F.col, columns)))


def per_group(df: DataFrame, key: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """User code over each sample's events (O-X03)."""
    return df.groupBy(key).applyInPandas(fn, schema)


def counted(df: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """The frame with a row count that can be read after an action (O-X05)."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
