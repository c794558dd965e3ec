"""Stored tables, seeds and array-valued soundings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe import contracts as C


def read_levels(spark: SparkSession, path: str, columns: list[str] | None = None,
                year: int | None = None, month: int | None = None) -> DataFrame:
    """Projected, partition-pruned read of a table partitioned by year and month."""
    df = spark.read.parquet(path)
    if year is not None:
        df = df.where(F.col("year") == year)
    if month is not None:
        df = df.where(F.col("month") == month)
    return df.select(*columns) if columns else df


def read_headers(spark: SparkSession, path: str, columns: list[str] | None = None,
                 start=None, end=None) -> DataFrame:
    """Header read over the half-open range [start, end) of report_timestamp."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col("report_timestamp") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("report_timestamp") < F.lit(end))
    return df.select(*columns) if columns else df


def read_box(spark: SparkSession, path: str, south: float, north: float, west: float, east: float,
             degrees: float = C.TILE_DEGREES) -> DataFrame:
    """Rows of a tiled table (``writers.write_tiles``) whose station lies in the box, borders included; only its tiles are
    opened.  A box whose west is greater than its east reaches over the antimeridian."""
    df = spark.read.parquet(path)
    lat, lon = (F.col(f"`{axis}|station_configuration`") for axis in ("latitude", "longitude"))
    low = {edge: int(math.floor(value / degrees) * degrees) for edge, value in (("s", south), ("n", north), ("w", west), ("e", east))}
    rows = F.col("lat_tile").between(low["s"], low["n"]) & lat.between(south, north)
    if west <= east:
        columns = F.col("lon_tile").between(low["w"], low["e"]) & lon.between(west, east)
    else:
        columns = ((F.col("lon_tile") >= low["w"]) | (F.col("lon_tile") <= low["e"])) & ((lon >= west) | (lon <= east))
    return df.where(rows & columns)


def read_tab_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated text with ``\\N`` for missing values, no header."""
    return spark.read.csv(path, sep="\t", nullValue="\\N", schema=schema, quote="", header=False)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_tab_text(spark, path, C.STATION_SCHEMA)


def levels_from_arrays(soundings: DataFrame, key: str, variables: list[str]) -> DataFrame:
    """One row per sounding with an array per variable -> one row per level,
    ``level_idx`` from 0.  Shorter arrays give NULL at the end."""
    zipped = F.arrays_zip(*[F.col(name) for name in variables])
    rows = soundings.select(key, F.posexplode(zipped).alias("level_idx", "_v"))
    return rows.select(key, "level_idx", *[F.col(f"_v.{name}").alias(name) for name in variables])
