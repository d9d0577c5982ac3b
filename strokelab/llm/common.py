"""Helpers shared by the corpus operators: tables, shared folder, small column tools."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts, as a regular-expression class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; ``sf_dir`` may be any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is missing in local mode (tests) a temporary folder is made and kept for the session; on a cluster
    its executors wouldn't see it, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            folder = known.get()
        elif not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            folder = tempfile.mkdtemp(prefix="spark-shared-")
            spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    # What the writing query shuffled is of no use once the table is there.
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_column(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_by_keys(df: DataFrame, keys: DataFrame, columns: list[str], most_bits: int = 1 << 30) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` that may have their key in ``keys``, and rows that surely haven't; neither side is shuffled.

    The keys' hashes are set in a bitmap of about 16 bits for each key, at most ``most_bits`` (128 MB), which every task
    gets.  A larger set of keys only lets more rows through by chance, so a join must follow on the first side.
    """
    bits = 1 << min(most_bits.bit_length() - 1, max(15, math.ceil(math.log2(16 * max(1, keys.count())))))
    slot = lambda frame: F.pmod(F.xxhash64(*[frame[c] for c in columns]), F.lit(bits))
    bitmap = keys.select(slot(keys).alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    at = F.bitmap_bit_position(F.col("_slot")).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = (
        df.withColumn("_slot", slot(df))
        .withColumn("_bucket", F.bitmap_bucket_number("_slot"))
        .join(F.broadcast(bitmap), "_bucket", "left")
        .withColumn("_in", F.coalesce(F.getbit(byte.cast("long"), at % 8) == 1, F.lit(False)))
    )
    return marked.where("_in").select(*df.columns), marked.where("not _in").select(*df.columns)
