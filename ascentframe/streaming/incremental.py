"""Incremental import planning on a file stream.

The batch functions do the work; the stream only brings the newly arrived
files.  A file may be superseded by one that arrives later, so each micro-batch
also re-plans the earlier files of the launches it touches, and only those.

What was seen is kept under ``root`` as deltas and snapshots, both by bucket, a
hash of the launch::

    root/<files|events>/batch=<number>/bucket=<b>/part-...     what one batch added
    root/<files|events>/upto=<number>/bucket=<b>/part-...      all that counts up to that batch

A batch opens the newest snapshot before it and the deltas behind that, and of
these only the buckets of its own launches, so the files it opens do not grow
with the batches before it.  Every ``SNAPSHOT_EVERY``-th batch folds the deltas
into the next snapshot; of a file's events it keeps those its state is made of.
A batch writes under its own number, so a replay replaces its own output, and it
reads only what earlier batches wrote.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ascentframe.functions.naming import base_name, parse_archive_names
from ascentframe.operators import tracking
from ascentframe.plans.importing import plan_events, plan_import

EVENT_SCHEMA = "sonde string, filename string, kind string, seq long, at timestamp, text string"
FILE_SCHEMA = "path string, station string, datetime string, seq long"
EVENTS, FILES = "events", "files"
SCHEMAS = {EVENTS: EVENT_SCHEMA, FILES: FILE_SCHEMA}
BUCKET, BUCKETS, SNAPSHOT_EVERY = "bucket", 16, 4


def bucket_of(station: Column, datetime: Column, filename: Column) -> Column:
    """The bucket of a launch; a file whose name tells no launch has one by its name."""
    launch = F.when(datetime.isNotNull(), F.concat_ws("/", station, datetime)).otherwise(filename)
    return F.pmod(F.xxhash64(launch), F.lit(BUCKETS)).cast("int")


def folders(spark: SparkSession, root: str, table: str, before: int | None = None) -> list[str]:
    """The newest finished snapshot (of batches before ``before``) and the deltas behind it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/*=*")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [re.search(r"/(batch|upto)=(\d+)$", f.getPath().toString()) for f in files.globStatus(place) or []]
    found = {(m[1], int(m[2])) for m in names if m and (before is None or int(m[2]) < before)}
    done = [n for kind, n in found if kind == "upto" and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/upto={n}/_SUCCESS"))]
    last = max(done, default=-1)
    deltas = sorted(n for kind, n in found if kind == "batch" and n > last)
    return [f"{root}/{table}/upto={last}"] * bool(done) + [f"{root}/{table}/batch={n}" for n in deltas]


def _read(spark: SparkSession, root: str, table: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    paths = folders(spark, root, table, before)
    schema = f"{SCHEMAS[table]}, {BUCKET} int"
    if not paths:
        return spark.createDataFrame([], schema)
    parts = [spark.read.schema(schema).parquet(p) for p in paths]  # a bounded number: one snapshot and its deltas
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """Events that the state of every file is made of."""
    return _read(spark, root, EVENTS).drop(BUCKET)


def read_files(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, FILES).drop(BUCKET)


def _write(rows: DataFrame, path: str) -> None:
    rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path)


def file_stream(spark: SparkSession, root: str, pattern: str = "*.jar") -> DataFrame:
    """Arriving files as (path, length, modificationTime)."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return (
        spark.readStream.format("binaryFile").schema(schema)
        .option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .load(root).select("path", "length", "modificationTime")
    )


def plan_batch(batch: DataFrame, number: int, root: str, sonde: str) -> None:
    """Plans the files of one batch against what earlier batches left below ``root``, and adds to it."""
    spark = batch.sparkSession
    parsed = parse_archive_names(batch.select("path"))
    launch = bucket_of(F.col("station"), F.col("datetime"), F.col("filename"))
    fresh = parsed.select("path", "station", "datetime", launch.alias(BUCKET)).persist()
    paths = None
    try:
        buckets = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most BUCKETS
        seen = _read(spark, root, FILES, number, buckets)
        touched = seen.join(fresh.select("station", "datetime").distinct(), ["station", "datetime"], "left_semi")
        paths = fresh.select("path").unionByName(touched.select("path")).persist()  # survivors look at them twice
        # the log is reduced to the files of this batch before anything is aggregated
        names = paths.select(base_name(F.col("path")).alias("filename")).distinct()
        events = _read(spark, root, EVENTS, number, buckets).where(F.col("sonde") == sonde)
        state = tracking.current_state(events.join(names, "filename", "left_semi"))
        plan = plan_import(paths, state, sonde).withColumn(BUCKET, launch)
        _write(plan_events(plan, number, [BUCKET]), f"{root}/{EVENTS}/batch={number}")
        _write(fresh.withColumn("seq", F.lit(number).cast("long")), f"{root}/{FILES}/batch={number}")
    finally:
        if paths is not None:
            paths.unpersist()
        fresh.unpersist()
    if number % SNAPSHOT_EVERY == SNAPSHOT_EVERY - 1:
        fold(spark, root, number)


def fold(spark: SparkSession, root: str, number: int) -> None:
    """Writes the snapshots up to a batch from the ones before and the deltas since."""
    events = _up_to(spark, root, EVENTS, number)
    _write(tracking.standing_events(events, [BUCKET]), f"{root}/{EVENTS}/upto={number}")
    _write(_up_to(spark, root, FILES, number), f"{root}/{FILES}/upto={number}")


def _up_to(spark: SparkSession, root: str, table: str, number: int) -> DataFrame:
    """All rows up to a batch, its own included, without the snapshot of that number (a replay writes it again)."""
    delta = spark.read.schema(f"{SCHEMAS[table]}, {BUCKET} int").parquet(f"{root}/{table}/batch={number}")
    return _read(spark, root, table, number).unionByName(delta)


def start_planning(files: DataFrame, root: str, checkpoint: str, sonde: str):
    """Starts the query; every batch plans its files against the current state.
    ``root`` holds the tracking events and the files seen so far."""
    return (
        files.writeStream.foreachBatch(lambda batch, number: plan_batch(batch, number, root, sonde))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
