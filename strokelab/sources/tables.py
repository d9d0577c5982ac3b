"""Scans, sources and sinks of the label tables (O-S*)."""

from __future__ import annotations

import functools
import math
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import nullcontext
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strokelab.operators import numbering
from strokelab.schemas import DDL, KEYS, nan_to_null
from strokelab.sources import shared
from strokelab.streaming.progress import Progress, watch


def read_table(spark: SparkSession, folder: str, name: str, ids: DataFrame | list | None = None, columns: list[str] | None = None, key: str = "sample_id") -> DataFrame:
    """One label table, optionally of some samples and columns only (O-S01, O-S15).

    A short list becomes a pushed-down predicate, a frame of ids a semi join.
    """
    df = nan_to_null(spark.read.parquet(f"{folder}/{name}.parquet"))
    if isinstance(ids, list):
        df = df.where(F.col(key).isin(ids))
    elif ids is not None:
        df = df.join(ids.select(key), key, "left_semi")
    return df.select(*columns) if columns else df


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns and types of a label table's schema; other columns (``aug_*``) are kept behind them."""
    fields = [f.strip().split(" ") for f in DDL[name].split(",")]
    known = [(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in fields]
    return df.select(*known, *[c for c in df.columns if c not in {f[0] for f in fields}])


def manifest(samples: DataFrame, config: str = "{}", key: str = "sample_id") -> DataFrame:
    """Count, distinct ids and config of a data set as one row of JSON (O-S02).

    The id list is a manifest's own content; for tables beyond some millions of samples read the samples table instead.
    """
    ids = F.sort_array(F.collect_set(F.col(key).cast("string")))
    return samples.agg(F.to_json(F.struct(F.count(F.lit(1)).alias("num_samples"), ids.alias("sample_ids"), F.lit(config).alias("config"))).alias("value"))


def write_manifest(samples: DataFrame, path: str, config: str = "{}") -> None:
    manifest(samples, config).coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("num_samples long, sample_ids array<string>, config string").json(path)


def documents(samples: DataFrame, strokes: DataFrame, measures: DataFrame, exercises: DataFrame, key: str = "sample_id") -> DataFrame:
    """Every sample as one nested row: metadata, strokes and measures in order, scores (O-S03)."""

    def nested(df: DataFrame, order: str, name: str) -> DataFrame:
        fields = [order, *[c for c in df.columns if c not in (key, order)]]
        return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))

    scores = exercises.select(key, F.struct(*[c for c in exercises.columns if c != key]).alias("scores"))
    return samples.join(nested(strokes, "position", "strokes"), key, "left").join(nested(measures, "index", "measures"), key, "left").join(scores, key, "left")


def flatten(docs: DataFrame, key: str = "sample_id") -> dict[str, DataFrame]:
    """Nested samples to the four tables, with counts and ``aug_*`` columns of an ``aug`` struct (O-S05)."""
    counts = [F.coalesce(F.size("strokes"), F.lit(0)).alias("num_strokes"), F.coalesce(F.size("measures"), F.lit(0)).alias("num_measures")]
    aug = [F.col(f"aug.{f.name}").alias(f"aug_{f.name}") for f in docs.schema["aug"].dataType.fields] if "aug" in docs.columns else []
    meta = [c for c in docs.columns if c not in ("strokes", "measures", "scores", "aug", "num_strokes", "num_measures")]
    return {
        "samples": docs.select(*meta, *counts, *aug),
        "strokes": docs.select(key, F.explode("strokes").alias("s")).select(key, "s.*"),
        "measures": docs.select(key, F.explode("measures").alias("m")).select(key, "m.*"),
        "exercises": docs.where("scores is not null").select(key, "scores.*"),
    }


def keep_last(rows: DataFrame, keys: list[str], sequence: list[Column]) -> DataFrame:
    """The last row of each key by an explicit sequence (O-S04, T11)."""
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in sequence])
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


#: How the reader names files that are no parquet.
BROKEN = ("CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "UNABLE_TO_INFER_SCHEMA", "CANNOT_MERGE_SCHEMAS")


def upsert(new: DataFrame, path: str, keys: list[str], sequence: str = "_seq") -> None:
    """Merge rows into a parquet table, the later ``sequence`` winning (O-S04).

    The merged table is written beside the old one and swapped in by two renames, so a failed write leaves the old table;
    between the two renames there is none.  ``versioned.merge`` rewrites only what a batch touches and switches at once.
    A table whose files the reader says are no parquet is set aside beside the new one and never deleted; any other fault,
    of the network for instance, is raised.
    """
    spark = new.sparkSession
    fs, target = _hadoop(spark, path)
    rows, broken = new, False
    if fs.exists(target):
        try:
            rows = spark.read.option("mergeSchema", "true").parquet(path).unionByName(new, allowMissingColumns=True)
            rows.schema  # noqa: B018
        except Exception as fault:  # of several kinds; only what the files themselves hold counts
            if not any(said in str(fault) for said in BROKEN):
                raise
            rows, broken = new, True
    staging, old = f"{path}.staging-{uuid.uuid4().hex}", f"{path}.{'broken' if broken else 'old'}-{uuid.uuid4().hex}"
    keep_last(rows, keys, [F.col(sequence)]).write.parquet(staging)
    _, s = _hadoop(spark, staging)
    _, o = _hadoop(spark, old)
    moved = fs.exists(target)
    # Hadoop may say no instead of raising.
    if moved and not fs.rename(target, o):
        fs.delete(s, True)
        raise OSError(f"{path} can't be moved aside; it is as it was")
    if fs.exists(target) or not fs.rename(s, target):
        if moved and not fs.exists(target):
            fs.rename(o, target)
        raise OSError(f"{path} can't be replaced; the merged table is in {staging}")
    if moved and not broken:
        fs.delete(o, True)


def write_tables(
    tables: dict[str, DataFrame], folder: str, mode: str = "overwrite", compression: str = "snappy", callback: Callable[[str, Progress], None] | None = None
) -> dict[str, int]:
    """Write all tables and return the rows written of each, counted on the way (O-S06, O-X05).

    ``callback`` gets a table's name and the progress of its tasks, again and again while it is written.
    """
    from pyspark.sql import Observation

    out = {}
    for name, df in tables.items():
        seen = Observation(f"rows_{name}")
        with watch(df.sparkSession, partial(callback, name)) if callback else nullcontext():
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("compression", compression).parquet(f"{folder}/{name}.parquet")
        out[name] = seen.get["n"]
    return out


def merge_outputs(spark: SparkSession, folders: list[str], name: str) -> DataFrame:
    """Union of a table's parts, missing folders and corrupt files skipped (O-S07)."""
    paths = [p for f in folders if _hadoop(spark, p := f"{f}/{name}.parquet")[0].exists(_hadoop(spark, p)[1])]
    if not paths:
        return spark.createDataFrame([], DDL[name])
    return spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(*paths)


def save_splits(splits: DataFrame, path: str, profile: str = "profile_id") -> None:
    """Split map as JSON, one line ``{"profile_id": ..., "split": ...}`` a profile, so that no task holds all of them (O-S08)."""
    known = splits.where(F.col("split").isin("train", "val", "test"))
    known.select(F.col(profile).cast("string"), "split").write.mode("overwrite").json(path)


def load_splits(spark: SparkSession, path: str, profile: str = "profile_id") -> DataFrame:
    return spark.read.schema(f"`{profile}` string, split string").json(path)


PATH_COLUMNS = ("midi_path", "audio_path")


def export_config(samples: DataFrame, exercises: DataFrame, splits: DataFrame, config: str = "labels_only", media: DataFrame | None = None, scores: list[str] | None = None) -> DataFrame:
    """Rows of an export configuration ``labels_only``, ``midi_only`` or ``audio`` (O-S09, O-S10).

    Scores are joined, the split attached (``validation`` for val, train where unknown), path columns dropped; the
    latter two embed the media bytes of ``media`` (path, content) by relative path, null where the path is empty.
    """
    from strokelab.operators import joins

    allowed = scores or [c for c in exercises.columns if c != "sample_id"]
    df = joins.with_split(joins.with_scores(samples, exercises, allowed), splits)
    df = df.withColumn("split", F.when(F.col("split") == "val", "validation").otherwise(F.col("split")))
    for name, column in (("midi_only", "midi_path"), ("audio", "audio_path")):
        if config == name:
            df = embed_media(df, media, column, column.removesuffix("_path"))
    return df.drop(*PATH_COLUMNS)


def embed_media(df: DataFrame, media: DataFrame, path: str, out: str) -> DataFrame:
    """Join file contents by the last two parts of their path (O-S10)."""
    tail = lambda c: F.array_join(F.slice(F.split(c, "/"), -F.least(F.lit(2), F.size(F.split(c, "/"))), F.lit(2)), "/")
    files = media.select(tail(F.col("path")).alias("_tail"), F.col("content").alias(out))
    wanted = F.when(F.col(path) != "", tail(F.col(path)))
    return df.withColumn("_tail", wanted).join(files, "_tail", "left").drop("_tail")


#: Rows of a range of ``sharded``, as a power of two: no task sorts more of one split and size together.
RANGE_BITS = 16


def sharded(df: DataFrame, max_bytes: int, split: str = "split") -> tuple[DataFrame, int]:
    """Rows with the number of their shard (``_shard``, from 0 over all splits), and how many shards there are (O-S11).

    Bytes are counted as JSON text.  Small rows (an eighth of the cap at most) fill seven eighths of it by running sums of
    bytes: within ranges of rows, moved up by the ranges before.  Larger ones go four, two or one to a shard by their size,
    and one above the cap is a shard alone, so no row changes what others have for room.  What is left over of a split's
    classes is put together, so at most one shard of a split is under half full.
    """
    cap, half = F.lit(max_bytes), max_bytes / 2
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    kind = F.when(F.col("_size") * 8 <= cap, 0).when(F.col("_size") * 4 <= cap, 4).when(F.col("_size") * 2 <= cap, 2).otherwise(1)
    rows = df.withColumn("_size", size.cast("long")).withColumn("_kind", kind).withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", RANGE_BITS))
    # Written once: the ranges must stay as they are.
    rows = shared.written(rows)
    each = rows.groupBy(split, "_kind", "_part").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(split, "_kind").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = each.select(split, "_kind", "_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_bytes", "_rows")])
    here = Window.partitionBy(split, "_kind", "_part").orderBy("_id")
    placed = rows.withColumn("_start", F.sum("_size").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")).withColumn("_nth", F.row_number().over(here) - 1)
    placed = placed.join(before.withColumnRenamed(split, "_s"), F.col(split).eqNullSafe(F.col("_s")) & placed["_kind"].eqNullSafe(before["_kind"]) & placed["_part"].eqNullSafe(before["_part"])).drop("_s", before["_kind"], before["_part"])
    piece = F.when(F.col("_kind") == 0, F.floor((F.col("_start") + F.col("_bytes_before")) * 8 / (cap * 7))).otherwise(F.floor((F.col("_nth") + F.col("_rows_before")) / F.col("_kind")))
    placed = placed.withColumn("_piece", piece)
    # One row a shard.
    totals = placed.groupBy(split, "_kind", "_piece").agg(F.sum("_size").alias("_bytes"))
    last = Window.partitionBy(split, "_kind")
    totals = totals.withColumn("_light", (F.col("_bytes") < half) & (F.col("_piece") == F.max("_piece").over(last)))
    # At most three light ones a split; two of them fit one shard, and what they make is light only if it is the last.
    order = Window.partitionBy(split, "_light").orderBy("_bytes", "_kind")
    pair = totals.withColumn("_n", F.row_number().over(order)).withColumn("_two", F.sum("_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = F.when(F.col("_light") & ((F.col("_n") <= 2) | (F.col("_two") <= max_bytes)), F.lit(-1).cast("long")).otherwise(F.col("_kind") * F.lit(1 << 40) + F.col("_piece"))
    named = shared.written(pair.select(split, "_kind", "_piece", joined.alias("_name")))
    numbers = numbering.numbered(named.select(split, "_name").distinct(), [split, "_name"], "_shard")
    same = lambda x, y, names: functools.reduce(lambda a, b: a & b, [x[c].eqNullSafe(y[c]) for c in names])
    map_ = named.join(numbers, same(named, numbers, [split, "_name"])).select(named[split].alias("_s"), F.col("_kind").alias("_k"), F.col("_piece").alias("_p"), "_shard")
    out = placed.join(map_, F.col(split).eqNullSafe(F.col("_s")) & (F.col("_kind") == F.col("_k")) & (F.col("_piece") == F.col("_p")))
    return out.select(*df.columns, F.col("_shard").cast("int").alias("_shard")), numbers.count()


def write_export(df: DataFrame, path: str, max_shard_rows: int | None = None, max_shard_bytes: int | None = None) -> None:
    """Export partitioned by split, with a cap on the rows or the bytes of a file (O-S11).

    Bytes are counted as JSON text, which parquet seldom exceeds.  A task writes many shards of ``sharded``, each as a file of its
    own, beside the export, and the whole then takes the export's place.
    """
    if max_shard_bytes:
        return _write_shards(df, path, max_shard_bytes)
    w = df.write.mode("overwrite").partitionBy("split")
    (w.option("maxRecordsPerFile", max_shard_rows) if max_shard_rows else w).parquet(path)


#: Bytes of shards that one task writes: what a task reports to the driver is then small beside what it writes.
TASK_BYTES = 64 << 20
#: Bytes of a shard that its task holds before it writes them.
GROUP_BYTES = 16 << 20
#: Types that Arrow writes to parquet as Spark reads them.
PLAIN = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _plain(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return bool(kind.fields) and all(_plain(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _plain(kind.elementType)
    if isinstance(kind, T.MapType):
        return _plain(kind.keyType) and _plain(kind.valueType)
    return type(kind) in PLAIN


def _write_shards(df: DataFrame, path: str, max_bytes: int) -> None:
    spark = df.sparkSession
    rows, n = sharded(df, max_bytes)
    tasks = max(1, math.ceil(n * max_bytes / TASK_BYTES), min(n, spark.sparkContext.defaultParallelism))
    dealt = rows.repartitionById(tasks, F.col("_shard") % tasks)
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    fs, s = _hadoop(spark, staging)
    _, target = _hadoop(spark, path)
    _, made = _hadoop(spark, f"{staging}/export")
    fs.mkdirs(made)
    if fs.getUri().getScheme() == "file" and _plain(df.drop("split").schema):
        _write_mounted(dealt, fs.makeQualified(s).toUri().getPath(), n)
        fs.create(_hadoop(spark, f"{staging}/export/_SUCCESS")[1]).close()
    else:
        _write_moved(dealt, staging)
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(made, target):
        raise OSError(f"{path} can't be replaced; the export is in {staging}/export")
    fs.delete(s, True)


def _write_mounted(dealt: DataFrame, staging: str, n: int) -> None:
    """Shards as files of a folder that all machines have mounted: tasks write them with Arrow under their own names."""
    spark = dealt.sparkSession
    codec = spark.conf.get("spark.sql.parquet.compression.codec").lower()
    codec = {"uncompressed": "none", "lz4_raw": "lz4"}.get(codec, codec)
    # What Spark's own files say of themselves.
    said = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": dealt.drop("split", "_shard").schema.json()}
    rows = dealt.withColumn("_split", F.col("split").cast("string")).drop("split")  # ends with the shard and its split
    done = rows.sortWithinPartitions("_shard").mapInArrow(functools.partial(_shard_files, staging, codec, said), "n long").agg(F.sum("n")).first()[0]
    if (done or 0) != n:
        raise OSError(f"{done} of {n} shards were written to {staging}")


def _shard_files(staging: str, codec: str, said: dict[str, str], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Writes a file for each shard of rows that come in its order; a row with their number.

    A file gets its name when it is whole, so a task that runs again or twice changes nothing.
    """
    own = f"{staging}/tasks/{uuid.uuid4().hex}"
    os.makedirs(own)
    now, writer, held, folder, n = None, None, [], "", 0

    def flush() -> None:
        nonlocal held
        if held:
            writer.write_table(pa.Table.from_batches(held))
        held = []

    def close() -> None:
        if writer is not None:
            flush()
            writer.close()
            os.replace(f"{own}/part", f"{folder}/part-{now:09d}.parquet")

    for b in batches:
        shards, data = b.column(b.num_columns - 2).to_numpy(), pa.RecordBatch.from_arrays(b.columns[:-2], schema=pa.schema(list(b.schema)[:-2], said))
        at = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for lo, hi in zip(at, at[1:]):
            if lo == hi:
                continue
            if shards[lo] != now:
                close()
                now, n = int(shards[lo]), n + 1
                folder = f"{staging}/export/{_folder('split', b.column(b.num_columns - 1)[lo].as_py())}"
                os.makedirs(folder, exist_ok=True)
                writer = pq.ParquetWriter(f"{own}/part", data.schema, compression=codec, store_schema=False)
            held.append(data.slice(lo, hi - lo))
            if sum(x.nbytes for x in held) >= GROUP_BYTES:
                flush()
    close()
    os.rmdir(own)
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])


def _folder(column: str, value: str | None) -> str:
    """Name of a partition's folder as Spark writes it."""
    return f"{column}={re.sub(UNSAFE, lambda m: f'%{ord(m[0]):02X}', value) if value else '__HIVE_DEFAULT_PARTITION__'}"


UNSAFE = r"""[\x01-\x1F"#%'*/:=?\\\x7F{\[\]^]"""


def _write_moved(dealt: DataFrame, staging: str) -> None:
    """Shards as files of any folder: Spark writes each into a folder of its own, and the driver moves them from there."""
    spark = dealt.sparkSession
    dealt.write.partitionBy("split", "_shard").parquet(f"{staging}/shards")
    fs, s = _hadoop(spark, f"{staging}/shards")
    files, known, new_path = fs.listFiles(s, True), {}, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while files.hasNext():
        file = files.next().getPath()
        folder = file.getParent()
        if not folder.getName().startswith("_shard="):
            to = new_path(f"{staging}/export/{file.getName()}")
        else:
            split = folder.getParent().getName()
            if split not in known:
                known[split] = new_path(f"{staging}/export", split)
                fs.mkdirs(known[split])
            to = new_path(known[split], f"part-{int(folder.getName().removeprefix('_shard=')):09d}-{file.getName().split('-', 2)[-1]}")
        if not fs.rename(file, to):
            raise OSError(f"{file.toString()} can't be moved; the export is as it was")


def write_auxiliary(tables: dict[str, DataFrame], path: str) -> None:
    """Stroke and measure tables beside the export (O-S12)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/auxiliary/{name}")


def media_path(sample: Column, path: Column, folder: str, suffix: str) -> Column:
    """The recorded path, else the flat layout ``folder/id.suffix`` (O-S13)."""
    return F.coalesce(F.nullif(path, F.lit("")), F.concat(F.lit(f"{folder}/"), sample.cast("string"), F.lit(suffix)))


def with_media(df: DataFrame, listing: DataFrame, path: str = "audio_path", folder: str = "audio", suffix: str = ".flac", key: str = "sample_id") -> DataFrame:
    """Rows whose media file is in a listing (``path`` column relative to the root) (O-S13)."""
    resolved = df.withColumn("_path", media_path(F.col(key), F.col(path), folder, suffix))
    return resolved.join(listing.select(F.col("path").alias("_path")), "_path", "left_semi").withColumnRenamed("_path", "media_path")


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Paths of files below a folder, without their contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).select("path", "length")


def read_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).select("path", "content")


def export_subset(df: DataFrame, path: str, kind: str = "csv", key: str = "sample_id") -> None:
    """A subset as csv with header, parquet, or a list of ids (O-S14)."""
    if kind == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif kind == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif kind == "ids":
        df.select(F.col(key).cast("string")).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown kind {kind!r}")


def onset_times(messages: DataFrame, key: str = "sample_id") -> DataFrame:
    """Absolute onset times of decoded messages: delta ticks summed at the tempo that holds, velocity above zero (O-S18).

    ``messages``: key, seq, delta_ticks, type, velocity, tempo_us (null: as before; 500,000 at first), ticks_per_beat.
    """
    w = Window.partitionBy(key).orderBy("seq")
    held = F.coalesce(F.last("tempo_us", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(500_000))
    ms = F.col("delta_ticks") * held / (F.col("ticks_per_beat") * 1000.0)
    timed = messages.withColumn("_ms", ms).withColumn("time_ms", F.sum("_ms").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return timed.where("type = 'note_on' and velocity > 0").select(key, "seq", "time_ms", "velocity")


def keys_of(name: str) -> list[str]:
    return KEYS[name]
