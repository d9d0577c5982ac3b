"""Correlations of many columns by a masked Gram matrix (O-B06)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType | BooleanType)]


def _products(k: int, middle: np.ndarray):
    upper = np.triu_indices(k, 1)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A task's sums over the rows in which both columns of a pair have values."""
        total = np.zeros((6, k, k))
        for b in batches:
            x = b.to_numpy(dtype=float, na_value=np.nan)
            mask = ~np.isnan(x)
            m = mask.astype(float)
            x = np.where(mask, x - middle, 0.0)
            square = x * x
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, square.T @ m, m.T @ square, x.T @ x])
        # One row a pair, however many rows the task had.
        yield pd.DataFrame({"i": upper[0], "j": upper[1], **{name: t[upper] for name, t in zip(("n", "sx", "sy", "sxx", "syy", "sxy"), total, strict=True)}})

    return run


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All pairs a < b of the columns (all numeric ones by default, in their order) as rows (a, b, n, r).

    Pairs are complete by pair: rows where either value is null or NaN don't count for them.  Columns are shifted by their
    means, from one row of averages, so that large offsets cost no digits; then one pass multiplies each batch with itself
    and only sums leave a task.  r is null where a column is constant over its pair's rows.
    """
    columns = columns or numeric_columns(df)
    k = len(columns)
    x = df.select(*[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(columns)])
    if k < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, n long, r double")
    means = x.agg(*[F.avg(f"c{i}") for i in range(k)]).first()
    middle = np.array([0.0 if m is None else m for m in means])
    sums = x.mapInPandas(_products(k, middle), "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double").groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    # Every pair of columns, also where no task had rows.
    place = lambda c: df.sparkSession.range(k).select(F.col("id").cast("int").alias(c))
    sums = place("i").join(place("j"), F.col("i") < F.col("j")).join(sums, ["i", "j"], "left").fillna(0.0)
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    vx, vy, c = F.col("sxx") - F.try_divide(sx * sx, n), F.col("syy") - F.try_divide(sy * sy, n), F.col("sxy") - F.try_divide(sx * sy, n)
    # What is left of equal values after rounding is no spread.
    spread = lambda v, s: F.when(v > 1e-12 * s, v)
    r = F.try_divide(c, F.sqrt(spread(vx, F.col("sxx"))) * F.sqrt(spread(vy, F.col("syy"))))
    names = F.array(*map(F.lit, columns))
    return sums.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), n.cast("long").alias("n"), F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))
