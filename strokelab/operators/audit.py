"""Checks of several tables in one pass (O-V01 to O-V12, O-V15).

A check names the facts that it needs: folds (sum, least, greatest) of a table's rows, and folds over ids that may look at how
many rows each table has for an id.  All checks of all tables become one aggregation by id over the union of the tables and one
more over the ids, so every table is read once, is combined before the one shuffle by id, and no table is joined.

Defined results: empty tables hold no fault and their details are null or zero; a null id belongs to no other table's rows, so
in a child it is an orphan; an id that stands several times in the parent is wrong in its count if any of its rows is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.operators.checks import text
from strokelab.schemas import TIERS


class Fold(NamedTuple):
    """A value that can be folded in any order and in steps."""

    how: Callable[[Column], Column]
    value: Column

    def of(self, value: Column | None = None) -> Column:
        return self.how(self.value if value is None else value)


def total(value: Column) -> Fold:
    return Fold(F.sum, value)


def number(condition: Column) -> Fold:
    """How often a condition holds."""
    return Fold(F.sum, F.when(condition, 1).otherwise(0).cast("long"))


def least(value: Column) -> Fold:
    return Fold(F.min, value)


def greatest(value: Column) -> Fold:
    return Fold(F.max, value)


#: Facts of a check by their names.
Facts = dict[str, Column]


@dataclass(frozen=True)
class Check:
    name: str
    passed: Callable[[Facts], Column]
    message: Callable[[Facts], Column]
    details: Callable[[Facts], Facts]
    rows: dict[str, dict[str, Fold]] = field(default_factory=dict)
    ids: Callable[[Facts, Facts, Column], dict[str, Fold]] | None = None  # of row counts by table, facts of an id, the id


def unique(table: str, name: str = "ids_unique") -> Check:
    """No id twice (O-V02)."""
    return Check(
        name,
        lambda f: f["n"] == f["d"],
        lambda f: text(f["d"], " distinct of ", f["n"]),
        lambda f: {"duplicates": f["n"] - f["d"]},
        ids=lambda n, f, i: {"n": total(n[table]), "d": number((n[table] > 0) & i.isNotNull())},
    )


def refs(child: str, parent: str) -> Check:
    """No child without a parent (O-V03 to O-V05)."""

    def ids(n: Facts, f: Facts, i: Column) -> dict[str, Fold]:
        lost = (n[child] > 0) & ((n[parent] == 0) | i.isNull())
        return {"k": number(lost), "rows": total(F.when(lost, n[child]).otherwise(0))}

    return Check(f"{child}_refs", lambda f: f["k"] == 0, lambda f: text(f["k"], " orphan ids"), lambda f: {"orphan_ids": f["k"], "orphan_rows": f["rows"]}, ids=ids)


def counts(parent: str, child: str, recorded: str, name: str) -> Check:
    """Recorded child counts equal the actual ones, missing being zero (O-V09, O-V10)."""
    said = F.coalesce(F.col(recorded), F.lit(0))

    def ids(n: Facts, f: Facts, i: Column) -> dict[str, Fold]:
        real = F.when(i.isNotNull(), n[child]).otherwise(0)
        return {"k": number((n[parent] > 0) & ((f["lo"] != real) | (f["hi"] != real))), "n": number(n[parent] > 0)}

    return Check(
        f"{name}_counts_match", lambda f: f["k"] == 0, lambda f: text(f["k"], " of ", f["n"], " differ"), lambda f: {"mismatches": f["k"]}, {parent: {"lo": least(said), "hi": greatest(said)}}, ids
    )


def no_nulls(table: str, columns: list[str]) -> Check:
    """Required columns hold no null (O-V01)."""
    return Check(
        f"{table}_nulls",
        lambda f: reduce(lambda a, b: a + b, f.values()) == 0,
        lambda f: text(reduce(lambda a, b: a + b, f.values()), " nulls in required columns"),
        lambda f: {c: f[c] for c in columns},
        {table: {c: number(F.col(c).isNull()) for c in columns}},
    )


def velocity(table: str, column: str = "actual_velocity", low: int = 1, high: int = 127, share: float = 0.999) -> Check:
    """Nearly all known velocities in their range (O-V06)."""
    c = F.col(column)
    rate = lambda f: F.try_divide(f["good"], f["n"])
    return Check(
        "velocity_range",
        lambda f: rate(f) >= share,
        lambda f: text("min ", f["lo"], ", max ", f["hi"]),
        lambda f: {"in_range": F.round(rate(f), 6)},
        {table: {"good": number(c.between(low, high)), "n": number(c.isNotNull()), "lo": least(c), "hi": greatest(c)}},
    )


def timing(table: str, column: str = "timing_error_ms") -> Check:
    """Non-grace errors: none of 500 ms or more, and mean under 100 ms or at least 80 % within 200 ms (O-V07)."""
    e = F.when(F.col("stroke_type") != "grace", F.abs(column))
    mean, near = lambda f: F.try_divide(f["all"], f["n"]), lambda f: F.try_divide(f["near"], f["n"])
    return Check(
        "timing_range",
        lambda f: (f["top"] < 500) & ((mean(f) < 100) | (near(f) >= 0.8)),
        lambda f: F.lit("non-grace timing errors"),
        lambda f: {"max": F.round(f["top"], 4), "mean": F.round(mean(f), 4), "within_200": F.round(near(f), 6)},
        {table: {"top": greatest(e), "all": total(e), "n": number(e.isNotNull()), "near": number(e <= 200)}},
    )


def ranges(table: str, columns: list[str], low: float = 0.0, high: float = 100.0, name: str = "score_ranges") -> Check:
    """All values of each column in a range (O-V08)."""

    def bad(f: Facts) -> Column:
        return reduce(lambda a, b: a + b, [F.coalesce((f[f"{c}_min"] < low) | (f[f"{c}_max"] > high), F.lit(False)).cast("int") for c in columns])

    return Check(
        name,
        lambda f: bad(f) == 0,
        lambda f: text(bad(f), " columns out of range"),
        lambda f: {k: F.round(v, 4) for k, v in f.items()},
        {table: {k: x for c in columns for k, x in ((f"{c}_min", least(F.col(c))), (f"{c}_max", greatest(F.col(c))))}},
    )


def tier_order(table: str, metric: str, name: str, tolerance: float = 2.0, tier: str = "skill_tier") -> Check:
    """Tier means rise with the tier, up to a tolerance; fewer than two tiers pass (O-V11, O-V12)."""
    at = lambda t: F.when(F.col(tier) == t, F.col(metric))
    mean = lambda f, t: F.try_divide(f[f"{t}_sum"], f[f"{t}_n"])

    def means(f: Facts) -> Column:
        return F.filter(F.array(*[mean(f, t) for t in TIERS]), lambda m: m.isNotNull())

    def passed(f: Facts) -> Column:
        m = means(f)
        pairs = F.greatest(F.size(m) - 1, F.lit(0))
        return F.forall(F.zip_with(F.slice(m, F.lit(1), pairs), F.slice(m, F.lit(2), pairs), lambda a, b: b >= a - tolerance), lambda ok: ok)

    return Check(
        name,
        passed,
        lambda f: text(F.size(means(f)), " tiers compared"),
        lambda f: {t: F.round(mean(f, t), 4) for t in TIERS},
        {table: {k: x for t in TIERS for k, x in ((f"{t}_sum", total(at(t))), (f"{t}_n", number(at(t).isNotNull())))}},
    )


def verify(tables: dict[str, DataFrame], checks: list[Check], key: str = "sample_id") -> DataFrame:
    """One row a check: check, passed, message, details (a map of numbers).  Check names must differ."""
    if len({c.name for c in checks}) < len(checks):
        raise ValueError("two checks of one name")
    place = {(c.name, k): f"_{a}_{b}" for a, c in enumerate(checks) for b, k in enumerate(k for t in c.rows.values() for k in t)}
    folds = {place[c.name, k]: x for c in checks for t in c.rows.values() for k, x in t.items()}
    parts = []
    for name, df in tables.items():
        mine = [x.value.alias(place[c.name, k]) for c in checks for k, x in c.rows.get(name, {}).items()]
        parts.append(df.select(F.col(key).alias("_id"), F.lit(1).cast("long").alias(f"_n_{name}"), *mine))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    per = union.groupBy("_id").agg(*[F.coalesce(F.sum(f"_n_{t}"), F.lit(0)).alias(f"_n_{t}") for t in tables], *[x.of(F.col(p)).alias(p) for p, x in folds.items()])
    have = {t: F.col(f"_n_{t}") for t in tables}
    wide, facts = [], {}
    for a, c in enumerate(checks):
        of = {k: F.col(place[c.name, k]) for t in c.rows.values() for k in t}
        more = {(k, f"_id_{a}_{b}"): x for b, (k, x) in enumerate(c.ids(have, of, F.col("_id")).items())} if c.ids else {}
        wide += [x.of().alias(p) for (_, p), x in more.items()]
        kinds = {place[c.name, k]: x for t in c.rows.values() for k, x in t.items()} | {p: x for (_, p), x in more.items()}
        names = {k: place[c.name, k] for k in of} | {k: p for k, p in more}
        facts[c.name] = {k: F.coalesce(F.col(p), F.lit(0)) if kinds[p].how is F.sum else F.col(p) for k, p in names.items()}
    one = per.agg(*[x.of(F.col(p)).alias(p) for p, x in folds.items()], *wide)
    made = []
    for c in checks:
        f = facts[c.name]
        entries = [x for k, v in c.details(f).items() for x in (F.lit(k), v.cast("double"))]
        made.append(F.struct(F.lit(c.name).alias("check"), F.coalesce(c.passed(f), F.lit(False)).alias("passed"), F.coalesce(c.message(f), F.lit("no rows")).alias("message"), F.create_map(*entries).alias("details")))
    return one.select(F.explode(F.array(*made)).alias("c")).select("c.*")


def detail_rows(checks: DataFrame) -> DataFrame:
    """One row a check and detail: check, passed, message, detail, value."""
    return checks.select("check", "passed", "message", F.explode("details").alias("detail", "value"))
