"""Keyed tables that are merged by the partitions a batch touches and switched by one atomic rename (O-S04, O-T01).

A table's rows lie in a fixed number of buckets by the hash of their key.  A merge reads and writes anew only the buckets that
the batch has keys of.  A small version file lists the folder of every bucket; it is written beside the others and renamed
to its number, so readers see the table before the merge or after it and nothing else.  Files of earlier versions stay until
``vacuum``, so a reader that began earlier can go on.

    path/data/<folder>/_bucket=7/part-….parquet
    path/versions/00000012.json
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strokelab.sources import tables

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another merge has switched the table meanwhile; merge again."""


def _text(spark: SparkSession, path: str) -> str:
    fs, p = tables._hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, body: dict, path: str) -> None:
    """A small JSON file with a digest of itself, complete or absent; ``Conflict`` if it is there already."""
    fs, parent = tables._hadoop(spark, path.rsplit("/", 1)[0])
    fs.mkdirs(parent)
    text = json.dumps(body, sort_keys=True)
    draft = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    jvm, (_, d), (_, p) = spark._jvm, tables._hadoop(spark, draft), tables._hadoop(spark, path)
    stream = fs.create(d, False)
    stream.write(bytearray(f"{hashlib.sha256(text.encode()).hexdigest()}\n{text}".encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        # Unlike FileSystem.rename this never replaces a file and raises where it fails.
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(d), fs.makeQualified(p), options)
    except Exception as fault:
        fs.delete(d, False)
        if "FileAlreadyExists" in str(fault):
            raise Conflict(path) from fault
        raise


def published(spark: SparkSession, path: str) -> dict | None:
    """The content of such a file, None where it isn't whole."""
    try:
        digest, _, text = _text(spark, path).partition("\n")
    except Exception as fault:
        if "ChecksumException" in str(fault):
            return None
        raise
    return json.loads(text) if hashlib.sha256(text.encode()).hexdigest() == digest else None


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the files ``<number>.json`` of a folder, newest first."""
    fs, p = tables._hadoop(spark, folder)
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def numbered_file(folder: str, number: int) -> str:
    return f"{folder}/{number:08d}.json"


def latest(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and content of the newest version that is whole; (0, None) for a table that isn't there."""
    for n in numbers(spark, f"{path}/versions"):
        if body := published(spark, numbered_file(f"{path}/versions", n)):
            return n, body
    return 0, None


def _frame(spark: SparkSession, path: str, body: dict, buckets: list[str]) -> DataFrame:
    schema = StructType.fromJson(body["schema"])
    folders = sorted({f"{path}/data/{body['folders'][b]}/{BUCKET}={b}" for b in buckets if b in body["folders"]})
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of the newest whole version, or of a given one; columns that older buckets lack are null."""
    body = latest(spark, path)[1] if version is None else published(spark, numbered_file(f"{path}/versions", version))
    if body is None:
        raise FileNotFoundError(f"no whole version in {path}")
    return _frame(spark, path, body, sorted(body["folders"], key=int))


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _schema(old: StructType, new: StructType, path: str) -> StructType:
    """Columns of both, those of ``old`` first."""
    known = {f.name: f.dataType for f in old}
    for f in new:
        if f.name in known and known[f.name] != f.dataType:
            raise TypeError(f"{path}: column {f.name} is {known[f.name].simpleString()}, not {f.dataType.simpleString()}")
    nullable = [*old, *[f for f in new if f.name not in known]]
    out = StructType()
    for f in nullable:
        out.add(f.name, f.dataType, True, f.metadata)
    return out


def merge(new: DataFrame, path: str, keys: list[str], sequence: str = "_seq", buckets: int = 64, source: str | None = None, number: int | None = None) -> int:
    """Merge rows into the table, the row of the largest ``sequence`` winning for each key; the version that holds them.

    The number of buckets is fixed by the first merge.  ``source`` and ``number`` name a batch of a stream: a batch whose
    number the table has already taken is left out, so a replay changes nothing.  Columns new to the table are added; a
    column of another type is refused.  Null keys are keys like any other.
    """
    spark = new.sparkSession
    at, body = latest(spark, path)
    # Numbers of files that aren't whole are not used again.
    after = max(numbers(spark, f"{path}/versions"), default=0) + 1
    if body is None:
        body = {"buckets": buckets, "keys": keys, "folders": {}, "schema": StructType().jsonValue(), "taken": {}}
    if body["keys"] != keys:
        raise ValueError(f"{path} has the keys {body['keys']}")
    if source is not None and number <= body["taken"].get(source, -1):
        return at
    schema = _schema(StructType.fromJson(body["schema"]), new.schema, path)
    rows = new.withColumn(BUCKET, bucket_of(keys, body["buckets"]))
    # At most one row a bucket.
    touched = sorted(str(r[0]) for r in rows.select(BUCKET).distinct().collect())
    folder = f"{after:08d}-{uuid.uuid4().hex}"
    if touched:
        # One row a key already in the tasks that read the batch, so that a key of very many rows is no task of its own.
        rows = tables.keep_last(rows, [BUCKET, *keys], [F.col(sequence)])
        old = _frame(spark, path, body | {"schema": schema.jsonValue()}, touched).withColumn(BUCKET, bucket_of(keys, body["buckets"]))
        kept = tables.keep_last(old.unionByName(rows, allowMissingColumns=True).repartition(len(touched), BUCKET), [BUCKET, *keys], [F.col(sequence)])
        kept.write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    taken = body["taken"] | ({source: number} if source is not None else {})
    _switch(spark, path, after, body | {"folders": body["folders"] | dict.fromkeys(touched, folder), "schema": schema.jsonValue(), "taken": taken})
    return after


def _switch(spark: SparkSession, path: str, number: int, body: dict) -> None:
    publish(spark, body, numbered_file(f"{path}/versions", number))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what only versions older than the newest ``keep`` whole ones use, and what no version uses; files of merges
    that are still running are among the latter, so vacuum between merges.  The number of folders deleted."""
    kept, used = [], set()
    found = numbers(spark, f"{path}/versions")
    for n in found:
        body = published(spark, numbered_file(f"{path}/versions", n)) if len(kept) < keep else None
        if body:
            kept.append(n)
            used |= {f"{folder}/{BUCKET}={b}" for b, folder in body["folders"].items()}
    if not kept:
        return 0
    fs, data = tables._hadoop(spark, f"{path}/data")
    gone = 0
    for n in found:
        if n < kept[-1]:
            fs.delete(tables._hadoop(spark, numbered_file(f"{path}/versions", n))[1], False)
    for folder in fs.listStatus(data) if fs.exists(data) else []:
        name = folder.getPath().getName()
        parts = [p.getPath() for p in fs.listStatus(folder.getPath()) if p.getPath().getName().startswith(f"{BUCKET}=")]
        idle = [p for p in parts if f"{name}/{p.getName()}" not in used]
        for p in [folder.getPath()] if len(idle) == len(parts) else idle:
            fs.delete(p, True)
            gone += 1
    return gone
