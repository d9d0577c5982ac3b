"""Pattern catalogue of one small YAML or JSON file per pattern (O-S17)."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strokelab.operators.sequences import parse_token

#: Fields of a file. A stroke is a token, or an object that Spark hands over as its JSON text.
FILE = """name string, slug string, category string, subdivision string, tempo_range array<int>, pas_number int, description string, starts_on_left boolean,
pattern struct<simple:string,accents:string,strokes:array<string>,beats_per_cycle:double>,
params struct<flam_spacing_range:array<double>,diddle_ratio_range:array<double>,roll_type:string,roll_strokes_per_beat:int,buzz_strokes_range:array<int>,buzz_detail:string,drag_spacing_range:array<double>>"""
STROKE = "hand string, type string, grace_offset double, diddle_position int"
#: Fixed value: the offset of a grace note given as a token.
GRACE_OFFSET = -0.05


def fields(text: str) -> dict:
    """A file's fields; without a YAML reader, JSON and flat ``key: value`` lines are read."""
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml
    except ImportError:
        lines = [line.partition(":") for line in text.splitlines() if ":" in line and not line.lstrip().startswith("#")]
        return {k.strip(): v.strip().strip("\"'") for k, _, v in lines}
    return yaml.safe_load(text)


def as_json(text: str) -> str:
    """A file as JSON. A flat ``sticking`` text (lower case: grace notes) with ``accents`` becomes a list of tokens."""
    data = fields(text)
    if "pattern" not in data and "sticking" in data:
        hands = data["sticking"].replace(" ", "")
        marks = (data.get("accents") or "").replace(" ", "").ljust(len(hands), ".")
        tokens = [f"({h})" if h.islower() else h + ">" * (m == ">") for h, m in zip(hands, marks, strict=False)]
        data["pattern"] = {"strokes": tokens, "beats_per_cycle": data.get("beats_per_cycle")}
    return json.dumps(data)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"value": [as_json(t) for t in pdf["value"]]})


def _simple(simple: Column, accents: Column) -> Column:
    """Strokes of a text of R, L and B (buzz, hands in turn from R); accents where the second text has ``>``."""
    c = F.split(F.upper(F.replace(simple, F.lit(" "))), "")
    c = F.filter(c, lambda x: x != "")
    a = F.replace(accents, F.lit(" "))

    def stroke(x: Column, i: Column) -> Column:
        buzzes = F.size(F.filter(F.slice(c, F.lit(1), i + 1), lambda y: y == "B"))
        hand = F.when(x == "B", F.when(buzzes % 2 == 1, "R").otherwise("L")).when(x == "R", "R").otherwise("L")
        kind = F.when(x == "B", "buzz").when(F.substr(a, i + 1, F.lit(1)) == ">", "accent").otherwise("tap")
        return F.struct(hand.alias("hand"), kind.alias("stroke_type"), F.lit(None).cast("double").alias("grace_offset"), F.lit(None).cast("int").alias("diddle_position"))

    wrong = (F.coalesce(F.length(a), F.lit(0)) > 0) & (F.length(a) != F.size(c))
    return F.when(wrong, F.raise_error(F.lit("accents and sticking differ in length"))).otherwise(F.transform(c, stroke))


def _detailed(strokes: Column) -> Column:
    """Strokes of a list of tokens and objects."""

    def stroke(x: Column) -> Column:
        token, whole = parse_token(F.trim(x)), F.from_json(x, STROKE)
        bad = F.when(token["hand"].isNull() | (token["hand"] == ""), F.raise_error(F.concat(F.lit("no hand in "), x))).otherwise(token["hand"])
        named = x.startswith("{")
        return F.struct(
            F.when(named, whole["hand"]).otherwise(bad).alias("hand"),
            F.when(named, F.coalesce(whole["type"], F.lit("tap"))).otherwise(token["stroke_type"]).alias("stroke_type"),
            F.when(named, whole["grace_offset"]).when(token["stroke_type"] == "grace", GRACE_OFFSET).alias("grace_offset"),
            F.when(named, whole["diddle_position"]).alias("diddle_position"),
        )

    return F.transform(strokes, stroke)


def load(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: its fields, the pattern as strokes, defaults filled in.

    A pattern is ``simple`` text with optional ``accents``, or a list of ``strokes``; a file with neither fails, as do
    accents of another length and tokens without a hand. Beats are a quarter of the strokes unless given.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True).mapInPandas(_rows, "value string")
    d = text.select(F.from_json("value", FILE).alias("d")).select("d.*")
    p = F.col("pattern")
    strokes = F.when(p["simple"].isNotNull(), _simple(p["simple"], p["accents"])).when(p["strokes"].isNotNull(), _detailed(p["strokes"]))
    strokes = strokes.otherwise(F.raise_error(F.concat(F.lit("no pattern in "), F.coalesce("slug", F.lit("a file")))))
    out = d.withColumn("beats_per_cycle", p["beats_per_cycle"]).withColumn("pattern", strokes)
    return out.select(
        "name", "slug", "category", F.coalesce("beats_per_cycle", F.size("pattern") / 4.0).alias("beats_per_cycle"), "pattern",
        F.coalesce("subdivision", F.lit("sixteenth")).alias("subdivision"), F.coalesce("tempo_range", F.array(F.lit(60), F.lit(180))).alias("tempo_range"),
        "params", "pas_number", "description", F.coalesce("starts_on_left", F.lit(False)).alias("starts_on_left"),
    )
