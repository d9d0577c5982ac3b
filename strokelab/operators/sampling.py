"""Sorts, limits, samples and splits (O-L*): seeded by md5 of the key, so any engine repeats them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strokelab.schemas import SPLITS, TIERS


def seeded(key: str, seed: int | str = 42) -> Column:
    """A hex string that orders keys at random but the same way everywhere (O-P19, T15)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def pick(key: str, n: int, seed: int | str = 42) -> Column:
    """A number below n from the key (O-P19)."""
    return (F.conv(F.substring(seeded(key, seed), 1, 8), 16, 10).cast("long") % n).cast("int")


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """Most frequent values, ties by value (O-L01)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(k)


def first_per_group(df: DataFrame, group: list[str], order: list, n: int = 1) -> DataFrame:
    """O-L02, O-L04."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def listed(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Rows in a fixed order of a column's values, others last (O-L03)."""
    place = F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(column)), F.lit(0))
    return df.orderBy(F.asc_nulls_last(place), column)


def shuffled(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in seeded random order (O-L05, O-V24)."""
    return df.orderBy(seeded(key, seed), key).limit(n)


def balanced(df: DataFrame, group: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """At most n rows of each group, all where there are fewer (O-L06)."""
    return first_per_group(df, [group], [seeded(key, seed), key], n)


def _check(ratios: tuple[float, float, float]) -> None:
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")


def seeded_ranks(df: DataFrame, key: str, group: list[str], seed: int = 42, shards: int = 64) -> DataFrame:
    """``df`` with the seeded rank ``_r`` of each row in its group, from 0, and the group's size ``_n``.

    Ranks are counted in shards of the hash and moved up by the sizes of the shards before, so that a group with a third
    of all rows is ranked by many tasks. Rows of one key are ranked in no fixed order among themselves.
    """
    shard = (F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * shards / (1 << 32)).cast("int")
    p = df.withColumn("_h", seeded(key, seed)).withColumn("_shard", shard)
    sizes = p.groupBy(*group, "_shard").agg(F.count(F.lit(1)).alias("_k"))  # one row per group and shard
    w = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_k").over(w.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    facts = sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_shard").alias("_s"), before.alias("_before"), F.sum("_k").over(w).alias("_n"))
    same = F.col("_shard") == F.col("_s")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    rank = F.row_number().over(Window.partitionBy(*group, "_shard").orderBy("_h", key)) - 1
    ranked = p.withColumn("_r", rank).join(facts, same)
    return ranked.withColumn("_r", F.col("_r") + F.col("_before")).drop("_h", "_shard", "_s", "_before", *[f"_g{i}" for i in range(len(group))])


def random_split(profiles: DataFrame, ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), profile: str = "profile_id", seed: int = 42, shards: int = 64) -> DataFrame:
    """Profiles to train, val and test by seeded rank (O-L07)."""
    _check(ratios)
    ranked = seeded_ranks(profiles.select(profile).distinct(), profile, [], seed, shards)
    train, val = F.floor(F.col("_n") * ratios[0]), F.floor(F.col("_n") * ratios[1])
    return ranked.select(profile, F.when(F.col("_r") < train, "train").when(F.col("_r") < train + val, "val").otherwise("test").alias("split"))


def stratified_split(profiles: DataFrame, ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), profile: str = "profile_id", tier: str = "skill_tier", seed: int = 42) -> DataFrame:
    """Per tier: floors of the ratios, at least one in train, the rest in test; where three or more leave no test, one val moves there (O-L08)."""
    _check(ratios)
    p = seeded_ranks(profiles.select(profile, tier).distinct(), profile, [tier], seed)
    train = F.greatest(F.lit(1), F.floor(F.col("_n") * ratios[0]))
    val = F.floor(F.col("_n") * ratios[1])
    moved = F.when((F.col("_n") >= 3) & (F.col("_n") - train - val == 0) & (val > 1), 1).otherwise(0)
    return p.select(profile, tier, F.when(F.col("_r") < train, "train").when(F.col("_r") < train + val - moved, "val").otherwise("test").alias("split"))


def split_stats(splits: DataFrame, tier: str = "skill_tier") -> DataFrame:
    """Profiles per split and tier, zeros included (O-B25)."""
    spark = splits.sparkSession
    grid = spark.createDataFrame([(s, t) for s in SPLITS for t in TIERS], f"split string, {tier} string")
    n = splits.groupBy("split", tier).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, ["split", tier], "left").select("split", tier, F.coalesce("n", F.lit(0)).alias("n"))


def balanced_batches(df: DataFrame, batch_size: int, group: str, key: str, groups: int, seed: int = 42, wrap: bool = True) -> DataFrame:
    """Batch number for rows so that each batch takes ``batch_size // groups`` of every group (O-L09).

    The largest group sets the number of batches; with ``wrap`` smaller groups are used again from their start.
    """
    k = batch_size // groups
    ranked = seeded_ranks(df, key, [group], seed)
    if not wrap:
        return ranked.withColumn("batch", F.floor(F.col("_r") / k).cast("int")).drop("_r", "_n")
    most = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).agg(F.max(F.ceil(F.col("_n") / k)).alias("_batches"))  # one row
    again = ranked.crossJoin(F.broadcast(most))
    # A row of rank r in a group of n stands at r, r + n, r + 2n, ... up to the end of the last batch.
    last = F.col("_batches") * k - 1
    turns = F.sequence(F.lit(0), F.floor((last - F.col("_r")) / F.col("_n")).cast("int"))
    out = again.where(F.col("_r") <= last).withColumn("_turn", F.explode(turns))
    return out.withColumn("batch", F.floor((F.col("_r") + F.col("_turn") * F.col("_n")) / k).cast("int")).drop("_r", "_n", "_batches", "_turn")


def train_test(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> DataFrame:
    """Rows split by seeded hash order: exact shares by an approximate cut would drift, so the hash value itself is cut (O-L10)."""
    u = F.conv(F.substring(seeded(key, seed), 1, 8), 16, 10).cast("double") / (1 << 32)
    return df.withColumn("part", F.when(u < train, "train").otherwise("test"))


def choose_per_key(keys: DataFrame, values: DataFrame, key: str, value: str, n: int, seed: int = 42) -> DataFrame:
    """n distinct values for every key (O-L11).

    ``values`` is a list of options (tempos, presets): they travel as one sorted array, and each key sorts it by its own hash.
    """
    options = values.agg(F.sort_array(F.collect_set(value)).alias("_v"))  # one row
    mark = lambda v: F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), v.cast("string")))
    drawn = F.slice(F.sort_array(F.transform("_v", lambda v: F.struct(mark(v).alias("h"), v.alias("v")))), 1, n)
    both = keys.select(key).distinct().crossJoin(F.broadcast(options))
    return both.select(key, F.explode(drawn).alias("_d")).select(key, F.col("_d.v").alias(value))
