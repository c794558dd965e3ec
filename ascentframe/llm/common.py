"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ascentframe.session import ensure_checkpoint_dir, shuffles_dropped, small_batches  # noqa: F401

#: White space of the word rules, besides the blank.
GAPS = "\t\n\v\f\r"
#: A side of a join is broadcast up to so many rows of one or two numbers (some 32 bytes each in a task).
BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text in order, NULL and empty texts give none.

    One kind of white space and a one-character separator: a plain search splits, no pattern is run.
    """
    plain = F.coalesce(text, F.lit(""))
    for gap in GAPS:
        plain = F.replace(plain, F.lit(gap), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once, also where lambdas inside `body` use it."""
    return F.transform(F.array(value), body)[0]


def cut(frame: DataFrame) -> DataFrame:
    """`frame` stored in the shared folder of the session, without its lineage."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def deleted(spark: SparkSession, path: str) -> None:
    """Removes a folder of this job that no later step reads; an absent one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def sized(frame: DataFrame, rows: int) -> DataFrame:
    """A join side with a broadcast hint if its counted rows allow it; Spark chooses otherwise."""
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled as good, each once."""
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def with_trust(docs: DataFrame, labels: DataFrame, flag: str, *columns: str) -> DataFrame:
    """The given columns of `docs` with a boolean column that says whether labels call the row good.

    All labels count. The id list is broadcast while its counted size is small; beyond that Spark joins by key.
    """
    ids = cut(trusted_ids(labels))
    marked = sized(ids.withColumn(flag, F.lit(True)), ids.count())
    joined = docs.select("doc_id", *columns).join(marked, "doc_id", "left")
    return joined.select(*columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the slices [start, start + length), slice after slice."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def groups_by_size(sizes, limit: int):
    """Ranges [a, b) of consecutive items whose summed size stays near `limit`; a larger item is a range of its own."""
    first = held = count = 0
    for size in sizes:
        if held and held + size > limit:
            yield first, count
            first, held = count, 0
        held += size
        count += 1
    if count > first:
        yield first, count
