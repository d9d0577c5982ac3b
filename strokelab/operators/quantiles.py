"""Quantiles of columns of any size: mergeable sketches, and exact values by narrowing ranges.

``sketches`` keeps one small sketch for each partition and group, to be stored, merged and asked later.  ``exact`` needs no
buffer that grows with the number of distinct values: a sketch proposes a range for every rank that is wanted, one pass
counts what lies below and within, and only rows of ranges that hold their rank are looked at again, until a range is a
single value or short enough to be sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strokelab.sources import shared

#: Groups times ranks up to which the wanted ranges are sent to every task; more are joined.
SENT = 100_000
#: Equal parts of the ranks at which a sketch is asked.
GRID = 512


def sketches(df: DataFrame, column: str, by: list[str], k: int = 200) -> DataFrame:
    """(by..., n, sketch): a mergeable quantile sketch of each group's values; add a partition's column to ``by`` to keep them apart."""
    x = F.col(column).cast("double")
    return df.where(x.isNotNull()).groupBy(*by).agg(F.count(x).alias("n"), F.call_function("kll_sketch_agg_double", x, F.lit(k)).alias("sketch"))


def merged(kept: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of smaller groups merged into those of larger ones."""
    return kept.groupBy(*by).agg(F.sum("n").alias("n"), F.call_function("kll_merge_agg_double", "sketch").alias("sketch"))


def estimated(kept: DataFrame, probs: dict[str, float]) -> DataFrame:
    """The sketches' quantiles as columns, named by ``probs``."""
    return kept.select(*[c for c in kept.columns if c != "sketch"], *[F.call_function("kll_sketch_get_quantile_double", "sketch", F.lit(p)).alias(n) for n, p in probs.items()])


def _shift(k: int) -> float:
    """How far to each side of its rank a range of a sketch reaches: about three times the sketch's usual error."""
    return min(0.25, 8.0 / k)


def exact(df: DataFrame, column: str, probs: dict[str, float], by: list[str] | None = None, sort_rows: int = 50_000, k: int = 1000) -> DataFrame:
    """Exact quantiles, linear between neighbours, as columns named by ``probs``, one row a group (O-B01).

    Nulls and NaN don't count; a group without values has null quantiles; null groups are groups.  A range
    of more than ``sort_rows`` values is narrowed by another pass, so no task sorts more for one rank.
    """
    by = by or []
    groups = [f"_g{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(g) for c, g in zip(by, groups, strict=True)], F.nullif(F.col(column).cast("double"), F.lit(float("nan"))).alias("_x"))
    base = shared.written(rows.groupBy(*groups).agg(F.count("_x").alias("_n")) if groups else rows.agg(F.count("_x").alias("_n")))
    place = lambda p: (F.col("_n") - 1) * F.lit(float(p))
    ranks = F.array(*[F.floor(place(p)) + i for p in probs.values() for i in (0, 1)])
    # One row for each group and rank; the rank counts from 0 within the rows that are left.
    wanted = base.where("_n > 0").select(*groups, "_n", F.explode(F.array_distinct(ranks)).alias("_rank")).where("_rank < _n")
    wanted = shared.written(wanted.select(*groups, "_rank", F.col("_rank").alias("_at"), F.col("_n").alias("_size")))
    keys = [*groups, "_rank"]
    found, left = None, rows.where("_x is not null")
    per_rank = False
    shift = _shift(k)
    while True:
        # A pass over what is left: sketches where the ranges lie, at first one a group.
        own = keys if per_rank else groups
        grouped = left.groupBy(*own) if own else left.groupBy()
        told = grouped.agg(F.call_function("kll_sketch_agg_double", "_x", F.lit(k)).alias("_sketch"), F.count("_x").alias("_count")).where("_count > 0").drop("_count")
        # The ends of the grid are the smallest and the largest value.
        told = told.withColumn("_edges", F.call_function("kll_sketch_get_quantile_double", "_sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))).drop("_sketch")
        ask = _join(wanted, told, own)
        middle = (F.col("_at") + 0.5) / F.col("_size")
        edge = lambda i: F.get("_edges", F.greatest(F.lit(0), F.least(F.lit(GRID), i)).cast("int"))
        low, high = edge(F.floor((middle - shift) * GRID)), edge(F.ceil((middle + shift) * GRID))
        ranges = shared.written(ask.select(*keys, "_at", "_size", low.alias("_low"), high.alias("_high")))
        within = _join(left, _small(ranges), own).where("_x <= _high")
        x, lo, hi = F.col("_x"), F.col("_low"), F.col("_high")
        counted = within.groupBy(*keys).agg(
            F.count_if(x < lo).alias("_below"), F.count_if(x == lo).alias("_lowest"), F.count_if(x == hi).alias("_highest"), F.count_if(x >= lo).alias("_inside")
        )
        # A range that missed its rank is drawn anew, wider, from all values that are left for it.
        place_in = F.col("_at") - F.col("_below")
        value_at = F.when(place_in < F.col("_lowest"), lo).when(place_in >= F.col("_inside") - F.col("_highest"), hi)
        held = place_in.between(0, F.col("_inside") - 1)
        state = shared.written(_join(ranges, counted, keys).select(*keys, "_at", "_size", "_low", "_high", "_below", "_lowest", "_highest", "_inside", held.alias("_held"), F.when(held, value_at).alias("_value")))
        # Between the ends, which may hold any number of equal values, there is always less than before.
        open_in = (F.col("_at") - F.col("_below") - F.col("_lowest")).alias("_at")
        between = F.col("_inside") - F.col("_lowest") - F.col("_highest")
        done = state.where("_value is not null").select(*keys, "_value")
        short = state.where(F.col("_held") & F.col("_value").isNull() & (between <= sort_rows)).select(*keys, "_low", "_high", open_in)
        inside = _join(left, _small(short), own).where("_x > _low and _x < _high")
        sorted_rows = inside.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy("_x")) - 1).where("_i = _at").select(*keys, x.alias("_value"))
        step = shared.written(done.unionByName(sorted_rows))
        found = step if found is None else found.unionByName(step)
        again = state.where(~F.col("_held") | (F.col("_value").isNull() & (between > sort_rows)))
        if again.isEmpty():
            break
        narrow = again.select(*keys, F.when(F.col("_held"), lo).alias("_low"), F.when(F.col("_held"), hi).alias("_high"))
        keep = lo.isNull() | ((x > lo) & (x < hi))
        left = shared.written(_join(left, _small(narrow), own).where(keep).select(*keys, "_x"))
        wanted = shared.written(again.select(*keys, F.when(F.col("_held"), open_in).otherwise(F.col("_at")).alias("_at"), F.when(F.col("_held"), between).otherwise(F.col("_size")).alias("_size")))
        shift = shift if again.where("not _held").isEmpty() else min(0.5, 4 * shift)
        per_rank = True
    # A few rows a group, however many values it has.
    value = lambda p, i: F.max(F.when(F.col("_rank") == F.floor(place(p)) + i, F.col("_value")))
    values = _join(base, found, groups) if groups else base.crossJoin(found)
    parts = [F.struct(value(p, 0).alias("a"), F.coalesce(value(p, 1), value(p, 0)).alias("b"), F.max(place(p) - F.floor(place(p))).alias("f")).alias(n) for n, p in probs.items()]
    answers = values.groupBy(*groups).agg(*parts) if groups else values.agg(*parts)
    answers = answers.select(*groups, *[F.when(F.col(f"{n}.f") == 0, F.col(f"{n}.a")).otherwise(F.col(f"{n}.a") + (F.col(f"{n}.b") - F.col(f"{n}.a")) * F.col(f"{n}.f")).alias(n) for n in probs])
    out = _join(base.select(*groups), answers, groups, "left") if groups else answers
    return out.select(*[F.col(g).alias(c) for g, c in zip(groups, by, strict=True)], *probs)


def _small(ranges: DataFrame) -> DataFrame:
    """The hint to send a table of ranges to every task, where it is counted to be small enough."""
    return F.broadcast(ranges) if ranges.count() <= SENT else ranges


def _join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null; without keys every row of ``a`` meets the few rows of ``b``."""
    if not keys:
        return a.crossJoin(b)
    other = b.select(*[F.col(c).alias(f"_r{c}") if c in keys else F.col(c) for c in b.columns if c in keys or c not in a.columns])
    same: Column = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    return a.join(other, same, how).drop(*[f"_r{c}" for c in keys])
