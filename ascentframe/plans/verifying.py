"""Full check of stored soundings against re-processed sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ascentframe.operators import reconcile as R
from ascentframe.session import ensure_checkpoint_dir

IDENTITY = ("station", "report_timestamp")


def pairs_of(source_headers: DataFrame, stored_headers: DataFrame, key: str, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """(key, _stored): the stored soundings of each source sounding, looked up by station and time.  A sounding stored
    twice comes out twice, which the comparison shows."""
    theirs = stored_headers.select(F.col(key).alias("_stored"), *identity)
    return source_headers.select(key, *identity).join(theirs, list(identity)).select(key, "_stored")


def verify(source_levels: DataFrame, stored_levels: DataFrame, source_headers: DataFrame,
           stored_headers: DataFrame, level_columns: Sequence[str], header_columns: Sequence[str],
           key: str = "g_product_id", order: str = "observation_id", identity: Sequence[str] = IDENTITY,
           numeric: Sequence[str] | None = None) -> DataFrame:
    """One verdict row per source sounding.  Unknown stations, soundings without a
    stored header, and lost or extra levels or values do not pass.

    Levels are compared by digests first; the pairs (a narrow row per sounding) are
    stored once, and only soundings that differ have their levels looked up."""
    ensure_checkpoint_dir(source_levels.sparkSession)
    pairs = pairs_of(source_headers, stored_headers, key, identity).checkpoint(eager=True)
    headers = stored_headers.withColumnRenamed(key, "_stored").join(pairs, "_stored").drop("_stored")
    profiles = R.compare_levels(source_levels, stored_levels, key, order, level_columns, pairs=pairs)
    return R.verdicts(source_headers, pairs, key, profiles,
                      R.compare_headers(source_headers, headers, key, header_columns, numeric))
