"""Numbers in sorted order for as many rows as there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strokelab.sources import shared


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with each row's place in the order, from 0; the order has to tell all rows apart.

    Rows are cut into ranges, written once (ranges are drawn anew each time they are computed), numbered within their
    range and moved up by the sizes of the ranges before; only one row per range meets in one task.
    """
    ranges = shared.written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = ranges.groupBy("_part").agg(F.count(F.lit(1)).alias("_k"))
    before = sizes.select("_part", F.coalesce(F.sum("_k").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranges.withColumn(out, place).join(F.broadcast(before), "_part").withColumn(out, F.col(out) + F.col("_before")).drop("_part", "_before")
