"""Incremental ingest on Structured Streaming (O-T01); resumable runs are in ``statelog``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strokelab.sources import versioned
from strokelab.streaming import progress


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: str,
    keys: list[str],
    order: str,
    files_per_trigger: int = 8,
    callback: Callable[[int, DataFrame], None] | None = None,
    buckets: int = 64,
    failed: Column | None = None,
) -> StreamingQuery:
    """Bounded batches of new parquet files, each merged into the target with the last row of a key winning (O-T01).

    A batch rewrites the buckets that it has keys of and no others; read the target by ``versioned.read``.  The sequence is
    (batch, ``order``).  The target knows the last batch it took from this checkpoint, so a replayed one is left out.
    Rows of ``failed`` (those that can't be used) are counted for ``progress.StreamProgress`` and not merged.
    """

    def sink(batch: DataFrame, number: int) -> None:
        batch.persist()  # a merge reads its batch twice; so the source is read and counted once
        try:
            good = batch if failed is None else batch.where(~F.coalesce(failed, F.lit(False)))
            # 40 bits for the order within a batch keep (batch, order) in one long.
            rows = good.withColumn("_seq", F.lit(number).cast("long") * (1 << 40) + F.col(order).cast("long"))
            versioned.merge(rows, target, keys, buckets=buckets, source=checkpoint, number=number)
            if callback:
                callback(number, good)
        finally:
            batch.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    stream = progress.measured(stream, failed)
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
