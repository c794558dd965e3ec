"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Rows are handed to Python in batches of so many bytes and rows, where `small_batches` was asked for.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1000


def build_session(master: str | None = None, app: str = "ascentframe", **conf) -> SparkSession:
    """A session with the settings every job here expects (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # call-site capture costs more than the planning of wide expressions
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in `spark.checkpoint.dir`.

    Without that setting only a local session gets a folder (a fresh temporary one, remembered in the session); on a
    cluster a machine-local folder would lose rows, so the job fails at once.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
    named = spark.conf.get("ascentframe.local.dir", None)
    if not named:
        named = tempfile.mkdtemp(prefix="ascentframe-")
        spark.conf.set("ascentframe.local.dir", named)
    return named


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python in batches of a few megabytes: whole texts come by thousands otherwise,
    and a worker that has held such a batch stays that large beside the next one's heap."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: Setting by which Spark deletes what an execution has shuffled at the end of it (from 4.1 on; unknown before, without effect).
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write inside has shuffled is deleted as soon as the write has ended, not when the driver collects garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
