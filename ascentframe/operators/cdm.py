"""The long common-data-model table: one row per level and observed variable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ascentframe import contracts as C
from ascentframe.functions import numeric, times

# storage kind of each long-table column
STORAGE = {
    "observed_variable": "int16",
    "observation_value": "float32",
    "units": "uint16",
    "z_coordinate": "float32",
    "z_coordinate_type": "uint8",
    **{f"uncertainty_value{k}": "float32" for k in (1, 2, 5)},
    **{f"uncertainty_type{k}": "uint8" for k in (1, 2, 5)},
    **{f"uncertainty_units{k}": "uint16" for k in (1, 2, 5)},
    "report_timestamp": "int64",
    "report_meaning_of_timestamp": "uint8",
    "report_id": "text",
    "report_duration": "uint8",
    "observation_id": "int64",
    "primary_station_id": "text",
    "station_name|station_configuration": "text",
    "latitude|station_configuration": "float32",
    "longitude|station_configuration": "float32",
    "height_of_station_above_sea_level": "float32",
    "latitude|observations_table": "float32",
    "longitude|observations_table": "float32",
    "record_number": "int32",
    "sensor_id": "text",
}


def variable_dim(spark: SparkSession) -> DataFrame:
    """The code -> label dictionary (one row per observed variable)."""
    rows = [(v.code, v.label, v.unit) for v in C.VARIABLES]
    return spark.createDataFrame(rows, "code int, label string, units int")


def scan_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the table has, nothing else (keeps the scan narrow)."""
    return df.select(*[F.col(f"`{name}`") for name in wanted if name in df.columns])


def join_headers(levels: DataFrame, headers: DataFrame) -> DataFrame:
    """Levels with their header; a header column that clashes gets ``_header``.

    No hint: a small header table is broadcast by its measured size, a large
    one is merged, with hot soundings split by the adaptive skew join.
    """
    clash = {name: f"{name}_header" for name in headers.columns
             if name in levels.columns and name != "g_product_id"}
    return levels.join(headers.withColumnsRenamed(clash), "g_product_id", "inner")


def with_record_number(df: DataFrame, stations: DataFrame) -> DataFrame:
    lookup = stations.select(F.col("idstation").alias("primary_station_id"), F.col("id").alias("record_number"))
    return df.join(lookup, "primary_station_id", "left")


#: What is told of a variable, with the columns of a variable that may feed it.
_MEASURES = {"value": ("old", "new"), "u1": ("random", None), "u2": ("systematic_old", "systematic_new"), "u5": ("total_old", "total_new")}


def _variables(codes: Sequence[int] | None) -> list[C.Variable]:
    return [v for v in C.VARIABLES if codes is None or v.code in codes]


def _fed(what: str, codes: Sequence[int] | None) -> list[C.Variable]:
    """Variables that some column feeds, in the order of their array."""
    return [v for v in _variables(codes) if any(getattr(v, field) for field in _MEASURES[what] if field)]


def level_measures(levels: DataFrame, transform_units: bool = True, codes: Sequence[int] | None = None, kind: str = "double") -> DataFrame:
    """Levels with one array for each measure (dialects merged, units changed), as they are shuffled and exploded.

    An array has a place only for variables with that measure, so a level is a third smaller than its columns; with
    ``kind`` float (the storage type of the export) it is a third of them.
    """
    have, scale = levels.columns, C.UNIT_TRANSFORMS if transform_units else {}

    def number(name):
        return numeric.either_number(have, name, None, scale).cast(kind)

    def measure(what):
        old, new = ([number(getattr(v, field) if field else None) for v in _fed(what, codes)] for field in _MEASURES[what])
        return F.zip_with(F.array(*old).cast(f"array<{kind}>"), F.array(*new).cast(f"array<{kind}>"), lambda a, b: F.coalesce(a, b))

    return levels.select(
        "g_product_id",
        F.col("observation_id").cast("long").alias("observation_id"),
        times.epoch_seconds(F.col("report_timestamp")).alias("report_timestamp"),
        number("lat").alias("latitude|observations_table"),
        number("lon").alias("longitude|observations_table"),
        number("alt").alias("z_coordinate"),
        *[measure(what).alias(f"_{what}") for what in _MEASURES],
    )


def header_columns(headers: DataFrame, stations: DataFrame, kind: str = "double") -> DataFrame:
    """The header's columns of the long table, one row per header, with the record number of its station."""
    have = headers.columns
    rows = headers.select(
        "g_product_id",
        *[numeric.either_text(have, *pair).alias(name) for name, pair in C.HEADER_TEXT.items()],
        *[numeric.either_number(have, *pair).cast(kind).alias(name) for name, pair in C.HEADER_NUMBERS.items()],
    )
    return with_record_number(rows, stations)


def long_table(base: DataFrame, codes: Sequence[int] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Every level (``level_measures`` joined with ``header_columns``) once per observed variable, missing values kept.

    A fixed list of (code, unit, places in the arrays) is exploded beside the level, so that no struct is built for each
    variable and the generated code stays small enough to be compiled.  With ``codes``
    (the same as the levels were made with) only those variables are made; columns ``keep`` are passed on.
    """
    places = {what: {v.code: k for k, v in enumerate(_fed(what, codes))} for what in _MEASURES}
    pieces = F.array(*[
        F.struct(F.lit(v.code).alias("code"), F.lit(v.unit).alias("unit"),
                 *[F.lit(places[what].get(v.code)).cast("int").alias(what) for what in _MEASURES])
        for v in _variables(codes)
    ])
    measure = {what: F.get(f"_{what}", F.col(f"_piece.{what}")) for what in _MEASURES}
    fixed = {
        "observed_variable": F.col("_piece.code"),
        "observation_value": measure["value"],
        "units": F.col("_piece.unit"),
        "report_id": F.col("g_product_id"),
        "z_coordinate_type": F.lit(0),
        "report_meaning_of_timestamp": F.lit(1),
        "report_duration": F.lit(9),
    }
    for kind in (1, 2, 5):
        fixed[f"uncertainty_value{kind}"] = measure[f"u{kind}"]
        fixed[f"uncertainty_type{kind}"] = F.lit(kind)
        fixed[f"uncertainty_units{kind}"] = F.col("_piece.unit")
    return base.withColumn("_piece", F.explode(pieces)).select(*[
        fixed.get(f.name, F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in C.CDM_SCHEMA.fields
    ], *keep)


def encoded_long_table(long: DataFrame) -> DataFrame:
    """Storage types, with each kind's sentinel for missing values."""
    return long.select(*[
        numeric.encoded(F.col(f"`{name}`"), kind).alias(name) for name, kind in STORAGE.items()
    ])


def with_month(df: DataFrame, epoch: str = "report_timestamp") -> DataFrame:
    ts = F.timestamp_seconds(F.col(epoch))
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def with_tiles(df: DataFrame, degrees: float = C.TILE_DEGREES) -> DataFrame:
    """Lower corners of the latitude/longitude tile of the station."""
    return df.withColumns(
        {
            f"{name}_tile": (F.floor(F.col(f"`{axis}|station_configuration`") / degrees) * degrees).cast("int")
            for name, axis in (("lat", "latitude"), ("lon", "longitude"))
        }
    )


def available_months(headers: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """Distinct (year, month) of the headers, in order."""
    rows = headers.where(times.in_month_range(F.col("report_timestamp"), start_year, end_year))
    months = rows.select(F.year("report_timestamp").alias("year"), F.month("report_timestamp").alias("month"))
    return months.distinct().orderBy("year", "month")


def levels_by_day(levels: DataFrame) -> DataFrame:
    """Levels of each month and day (days since 1970 of ``report_timestamp``); a calendar's worth of rows."""
    return levels.groupBy(*_month_of(levels), day(times.epoch_seconds(F.col("report_timestamp"))).alias("day")).agg(F.count(F.lit(1)).alias("levels"))


def levels_by_month(levels: DataFrame) -> DataFrame:
    """Levels, or rows, of each month."""
    return levels.groupBy(*_month_of(levels)).agg(F.count(F.lit(1)).alias("levels"))


def _month_of(levels: DataFrame) -> list[Column]:
    """(year, month): the partition columns where the table has them, else taken from the time."""
    return [F.col(name) if {"year", "month"} <= set(levels.columns) else part("report_timestamp").alias(name)
            for name, part in (("year", F.year), ("month", F.month))]


#: Months are worked off in about so many rounds, each of at least as many levels; what a round shuffles is deleted before the next.
ROUNDS, ROUND_LEVELS = 8, 2_000_000


def month_rounds(sizes: Mapping[tuple[int | None, int | None], int], rows_per_level: int = 1) -> list[list[tuple[int | None, int | None]]]:
    """The months in order, in rounds of whole months that hold about equally many of the given rows; a month that has more
    is a round of its own.  Rows without a month come last."""
    most = max(ROUND_LEVELS * rows_per_level, -(-sum(sizes.values()) // ROUNDS))
    rounds: list[list[tuple[int | None, int | None]]] = []
    held = 0
    for month in sorted(sizes, key=lambda m: (None in m, m[0] or 0, m[1] or 0)):
        if not rounds or held + sizes[month] > most:
            rounds.append([])
            held = 0
        rounds[-1].append(month)
        held += sizes[month]
    return rounds


def of_months(stored: DataFrame, months: Sequence[tuple[int | None, int | None]]) -> DataFrame:
    """Rows of a table by month that lie in the given months; other folders are not opened."""
    test = F.lit(False)
    for year, month in months:
        test = test | (F.col("year").eqNullSafe(year) & F.col("month").eqNullSafe(month))
    return stored.where(test)


def day(epoch: Column) -> Column:
    return F.floor(epoch / 86400).cast("int")


def missing_months(requested: DataFrame, existing: DataFrame) -> DataFrame:
    return requested.join(existing.select("year", "month"), ["year", "month"], "left_anti")
