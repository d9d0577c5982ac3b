"""Table functions for SQL users (O-X04): one row becomes many in a LATERAL join.

DataFrame users have the same expansions in built-in functions (``sequences.parse_sticking``, ``sequences.bounces``); these
run in Python workers, row by row, and keep nothing between rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import DataType, IntegerType, NumericType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


def _want(name: str, argument: AnalyzeArgument, kind: type[DataType]) -> None:
    if not isinstance(argument.dataType, kind):
        raise ValueError(f"{name} is {argument.dataType.simpleString()}, not {kind.__name__.removesuffix('Type').lower()}")


@udtf
class ExpandSticking:
    """``expand_sticking(sticking[, accents])``: position, hand and, where accents are given, stroke_type.

    R, L, and B as alternating hands from R; spaces are stripped.  Texts that are null, empty or of different lengths give no
    rows.
    """

    @staticmethod
    def analyze(sticking: AnalyzeArgument, accents: AnalyzeArgument | None = None) -> AnalyzeResult:
        _want("sticking", sticking, StringType)
        schema = StructType().add("position", IntegerType()).add("hand", StringType())
        if accents is not None:
            _want("accents", accents, StringType)
            schema = schema.add("stroke_type", StringType())
        return AnalyzeResult(schema)

    def eval(self, sticking: str | None, *accents: str | None) -> Iterator[tuple]:
        if sticking is None or None in accents:
            return
        hands = "".join(sticking.split()).upper()
        marks = [a.replace(" ", "") for a in accents]
        if any(len(m) != len(hands) for m in marks):
            return
        both = 0
        for i, c in enumerate(hands):
            both += c == "B"
            hand = c if c in "RL" else "R" if both % 2 else "L"
            yield (i, hand, *("accent" if m[i] == ">" else "tap" for m in marks))


@udtf
class ExpandBounces:
    """``expand_bounces(time_ms, velocity, n, spacing_ms, decay)``: sub-event number j, its time and its fading velocity.

    An event is its own sub-event 0; n under 1 counts as 1.  Times and velocities have the types of the arguments.
    """

    @staticmethod
    def analyze(time_ms: AnalyzeArgument, velocity: AnalyzeArgument, n: AnalyzeArgument, spacing_ms: AnalyzeArgument, decay: AnalyzeArgument) -> AnalyzeResult:
        for name, a in (("time_ms", time_ms), ("velocity", velocity), ("n", n), ("spacing_ms", spacing_ms), ("decay", decay)):
            _want(name, a, NumericType)
        return AnalyzeResult(StructType().add("j", IntegerType()).add("time_ms", time_ms.dataType).add("velocity", velocity.dataType))

    def eval(self, time_ms, velocity, n, spacing_ms, decay) -> Iterator[tuple]:
        for j in range(max(1, n or 1)):
            yield j, None if time_ms is None else time_ms + type(time_ms)(j * spacing_ms), None if velocity is None else type(velocity)(max(1, int(velocity * float(decay) ** j)))


def register(spark: SparkSession) -> None:
    """Make both known to the session's SQL."""
    spark.udtf.register("expand_sticking", ExpandSticking)
    spark.udtf.register("expand_bounces", ExpandBounces)
