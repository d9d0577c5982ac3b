"""Filters and predicates (O-F*): conditions are Columns, so they reach the scan."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.operators import quantiles
from strokelab.schemas import optional_col


def is_clean(df: DataFrame, preset: str = "augmentation_preset") -> Column:
    """No preset, or the preset ``none`` (O-F01); True where the table has no such column."""
    c = optional_col(df, preset)
    return c.isNull() | (c == "none")


def clean(df: DataFrame, preset: str = "augmentation_preset") -> DataFrame:
    return df.where(is_clean(df, preset))


def augmented(df: DataFrame, preset: str = "augmentation_preset") -> DataFrame:
    """The complement of ``clean`` (O-F02)."""
    return df.where(~is_clean(df, preset))


def equals(df: DataFrame, column: str, value) -> DataFrame:
    """O-F03."""
    return df.where(F.col(column) == value)


def member(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """O-F04."""
    return df.where(F.col(column).isin(list(values)))


def within(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Closed range; a missing end is open (O-F05, O-F07, O-F14)."""
    c = F.col(column)
    if low is not None:
        df = df.where(c >= low)
    return df if high is None else df.where(c <= high)


def containing(df: DataFrame, column: str, part: str) -> DataFrame:
    """O-F06."""
    return df.where(F.col(column).contains(part))


def applicable(df: DataFrame, column: str) -> DataFrame:
    """Rows to which an optional score applies (O-F08)."""
    return df.where(F.col(column).isNotNull())


def where_all(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """None: is null; a list, set or tuple: member; else equal.  Unknown columns are warned about and skipped (O-F09, O-F10)."""
    for column, value in conditions.items():
        if column not in df.columns:
            warnings.warn(f"no column {column!r}: condition skipped", stacklevel=2)
        elif value is None:
            df = df.where(F.col(column).isNull())
        elif isinstance(value, (list, set, tuple, frozenset)):
            df = member(df, column, sorted(value))
        else:
            df = equals(df, column, value)
    return df


def trim_outliers(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99, approx: bool = False, ranges: bool = False) -> DataFrame:
    """Rows between two quantiles of a column (O-F11); ``ranges`` finds the exact ones without a buffer of all values."""
    if ranges:
        ends = quantiles.exact(df, column, {"_low": low, "_high": high})  # one row
        return df.crossJoin(F.broadcast(ends)).where(F.col(column).between(F.col("_low"), F.col("_high"))).drop("_low", "_high")
    q = (lambda p: F.percentile_approx(column, F.lit(p), F.lit(10_000))) if approx else (lambda p: F.percentile(F.col(column), F.lit(p)))
    ends = df.agg(q(low).alias("_low"), q(high).alias("_high"))  # one row
    return df.crossJoin(F.broadcast(ends)).where(F.col(column).between(F.col("_low"), F.col("_high"))).drop("_low", "_high")


def in_split(df: DataFrame, splits: DataFrame, split: str, profile: str = "profile_id") -> DataFrame:
    """Rows whose profile is in a split; ``validation`` is ``val`` (O-F12)."""
    wanted = {"validation": "val"}.get(split, split)
    return df.join(splits.where(F.col("split") == wanted).select(profile), profile, "left_semi")


def held_out_domain(df: DataFrame, column: str, train: Iterable, test: Iterable) -> DataFrame:
    """Label rows by domain and drop those of neither side (O-F13)."""
    c = F.col(column)
    return df.withColumn("domain_split", F.when(c.isin(list(train)), "train").when(c.isin(list(test)), "test")).where("domain_split is not null")


def timing_rows(strokes: DataFrame) -> DataFrame:
    """Strokes for timing analyses: by type, so expanded bounces stay in (O-F15)."""
    return strokes.where("stroke_type <> 'grace'")


def velocity_rows(strokes: DataFrame) -> DataFrame:
    return strokes.where("stroke_type not in ('grace', 'accent')")


def grace_rows(strokes: DataFrame) -> DataFrame:
    return strokes.where("is_grace_note and flam_spacing_ms is not null")
