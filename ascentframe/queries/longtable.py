"""The long table over the star schema: orders are headers, lineitem levels.

Every column the export reads is a closed formula of the line; one formula text
serves Spark and the SQL twin.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ascentframe import contracts as C
from ascentframe.functions import numeric
from ascentframe.operators import cdm
from ascentframe.plans import exporting
from ascentframe.queries import views as V
from ascentframe.queries.registry import query

# old-dialect columns are filled for even orders, new-dialect ones for odd
_EVEN = ("wvmr", "asc", "geopot", "res_rh", "u", "v", "swrad")
_ODD = ("wvmr_vol", "vspeed", "alt_gph", "rh_res", "wzon", "wmeri")
_BASE = {"press": "1000 - l_quantity * 10", "temp": "300 - l_quantity", "rh": "l_discount * 1000",
         "time": "l_extendedprice / 100", "alt": "l_extendedprice / 10", "lat": "l_tax * 1000 - 40",
         "lon": "l_discount * 1800 - 90", "wdir": "l_quantity * 7", "wspeed": "l_tax * 250", "fp": "250 + l_quantity / 4"}


def _formula(name: str, place: int) -> str:
    if name in _BASE:
        return _BASE[name]
    text = f"l_quantity * {place} + l_tax"
    if name in _EVEN:
        return f"CASE WHEN l_orderkey % 2 = 0 THEN {text} END"
    if name in _ODD:
        return f"CASE WHEN l_orderkey % 2 = 1 THEN {text} END"
    return f"CASE WHEN l_linenumber <> {place % 7 + 1} THEN {text} END"


_NAMES = [n for n in C.export_level_columns() if n not in C.LEVEL_KEYS]
LEVEL_FORMULAS = {name: _formula(name, place) for place, name in enumerate(_NAMES, start=1)}
OBSERVATION = "(CAST(l_linenumber AS BIGINT) * 100000000 + l_partkey) * 1000000 + l_suppkey"

HEADER_FORMULAS = {
    "g_general_sitecode": "CASE WHEN o_orderkey % 2 = 0 THEN concat('NATION_', CAST(c_nationkey AS STRING)) END",
    "g_site_key": "CASE WHEN o_orderkey % 2 = 1 THEN concat('NATION_', CAST(c_nationkey + 2 AS STRING)) END",
    "g_general_sitename": "CASE WHEN o_orderkey % 2 = 0 THEN c_mktsegment END",
    "g_site_name": "CASE WHEN o_orderkey % 5 <> 0 THEN c_name END",
    "g_product_code": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END",
    "g_product_key": "o_orderstatus",
    "g_measuringsystem_latitude": "CASE WHEN o_orderkey % 2 = 0 THEN c_acctbal / 100 - 10 END",
    "g_measurementsystem_latitude": "c_acctbal / 200",
    "g_measuringsystem_longitude": "CASE WHEN o_orderkey % 2 = 0 THEN c_acctbal / 50 END",
    "g_measurementsystem_longitude": "c_acctbal / 80",
    "g_measuringsystem_altitude": "CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice / 1000 END",
    "g_measurementsystem_altitude": "CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 500 END",
}


def levels(spark, sf_dir):
    rows = V.table(spark, sf_dir, "lineitem")
    return rows.select(
        F.col("l_orderkey").alias("g_product_id"),
        F.expr(OBSERVATION).alias("observation_id"),
        F.col("l_shipdate").alias("report_timestamp"),
        *[F.expr(text).alias(name) for name, text in LEVEL_FORMULAS.items()],
    )


def headers(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    customers = V.table(spark, sf_dir, "customer")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.col("o_orderkey").alias("g_product_id"),
        F.col("o_orderdate").alias("launch_timestamp"),
        *[F.expr(text).alias(name) for name, text in HEADER_FORMULAS.items()],
    )


def stations(spark, sf_dir):
    return V.table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") * 40 + 1).alias("id"), F.col("n_name").alias("idstation"))


def long_table_of(spark, sf_dir, **options):
    return exporting.build_long_table(levels(spark, sf_dir), headers(spark, sf_dir), stations(spark, sf_dir), **options)


def _sql(text: str) -> str:
    return text.replace("STRING", "VARCHAR")


def _either(old, new, scaled):
    parts = []
    for name in dict.fromkeys((old, new)):
        if name in LEVEL_FORMULAS:
            factor, offset = C.UNIT_TRANSFORMS.get(name, (1.0, 0.0)) if scaled else (1.0, 0.0)
            parts.append(f'"{name}" * {factor!r}::DOUBLE + {offset!r}::DOUBLE' if factor != 1.0 else f'CAST("{name}" AS DOUBLE)')
    return "coalesce(" + ", ".join(parts) + ")" if parts else "CAST(NULL AS DOUBLE)"


def _pieces(scaled: bool) -> str:
    return "\nUNION ALL ".join(
        f"SELECT g_product_id, observation_id, report_timestamp, {v.code} AS observed_variable, {v.unit} AS units, "
        f"{_either(v.old, v.new, scaled)} AS observation_value, {_either(v.random, None, scaled)} AS u1, "
        f"{_either(v.systematic_old, v.systematic_new, scaled)} AS u2, {_either(v.total_old, v.total_new, scaled)} AS u5, "
        "CAST(alt AS DOUBLE) AS z_coordinate, lat, lon FROM wide"
        for v in C.VARIABLES
    )


def _long(scaled: bool = True) -> str:
    return f"""
wide AS (
  SELECT l_orderkey AS g_product_id, {OBSERVATION} AS observation_id, l_shipdate AS report_timestamp,
    {', '.join(f'{_sql(t)} AS "{n}"' for n, t in LEVEL_FORMULAS.items())}
  FROM lineitem),
hd AS (
  SELECT o_orderkey AS g_product_id, {', '.join(f'{_sql(t)} AS {n}' for n, t in HEADER_FORMULAS.items())}
  FROM orders JOIN customer ON o_custkey=c_custkey),
pieces AS ({_pieces(scaled)}),
hx AS (
  SELECT g_product_id, coalesce(g_general_sitecode, g_site_key, '') AS primary_station_id,
    coalesce(g_general_sitename, g_site_name, '') AS station_name, coalesce(g_product_code, g_product_key, '') AS sensor_id,
    coalesce(g_measuringsystem_latitude, g_measurementsystem_latitude) AS slat,
    coalesce(g_measuringsystem_longitude, g_measurementsystem_longitude) AS slon,
    coalesce(g_measuringsystem_altitude, g_measurementsystem_altitude) AS salt,
    n_nationkey*40+1 AS record_number
  FROM hd LEFT JOIN nation ON n_name=coalesce(g_general_sitecode, g_site_key, '')),
lt AS (
  SELECT p.*, hx.* EXCLUDE (g_product_id), CAST(epoch(report_timestamp) AS BIGINT) AS epoch,
    year(report_timestamp) AS year, month(report_timestamp) AS month
  FROM pieces p JOIN hx ON hx.g_product_id=p.g_product_id)"""


LONG = _long()

# every column of the long table, as the SQL twin spells it
_TWIN = {
    "observed_variable": "observed_variable", "observation_value": "observation_value", "units": "units",
    "z_coordinate": "z_coordinate", "z_coordinate_type": "0", "report_timestamp": "epoch", "report_meaning_of_timestamp": "1",
    "report_id": "g_product_id", "report_duration": "9", "observation_id": "observation_id",
    "primary_station_id": "primary_station_id", "station_name|station_configuration": "station_name",
    "latitude|station_configuration": "slat", "longitude|station_configuration": "slon",
    "height_of_station_above_sea_level": "salt", "latitude|observations_table": "lat", "longitude|observations_table": "lon",
    "record_number": "record_number", "sensor_id": "sensor_id",
    **{f"uncertainty_{what}{k}": text for k in (1, 2, 5)
       for what, text in (("value", f"u{k}"), ("type", str(k)), ("units", "units"))},
}
_ENCODED = {"int64": "coalesce(CAST({0} AS BIGINT), -9223372036854775808)", "int32": "coalesce(CAST({0} AS INTEGER), -2147483648)",
            "float32": "coalesce(CAST({0} AS FLOAT), CAST('NaN' AS FLOAT))", "uint8": "coalesce({0}, 255)",
            "uint16": "coalesce({0}, 65535)", "int16": "{0}", "text": "coalesce(CAST({0} AS VARCHAR), '')"}
_PLAIN_SQL = ", ".join(f'{_TWIN[f.name]} AS "{f.name}"' for f in C.CDM_SCHEMA.fields)
_ENCODED_SQL = ", ".join(f'{_ENCODED[kind].format(_TWIN[name])} AS "{name}"' for name, kind in cdm.STORAGE.items())

_MEASURES = {"observation_value": "observation_value", "u1": "uncertainty_value1", "u2": "uncertainty_value2",
             "u5": "uncertainty_value5", "z_coordinate": "z_coordinate"}


@query("long_table", f"WITH {LONG} SELECT {_PLAIN_SQL} FROM lt")
def long_table(spark, sf_dir):
    """The whole table, all columns; the formulas are plain arithmetic, so values agree to the last digit."""
    return long_table_of(spark, sf_dir)


@query("long_table_by_month", f"""WITH {LONG}
SELECT year, month, observed_variable, record_number, count(*) AS rows_out, count(observation_value) AS valued,
  {', '.join(f'round(sum({src}),8) AS sum_{out}, count({src}) AS n_{out}' for src, out in _MEASURES.items())},
  round(sum(slat),8) AS sum_slat, round(sum(slon),8) AS sum_slon, round(sum(salt),8) AS sum_salt,
  round(sum(lat),8) AS sum_lat, round(sum(lon),8) AS sum_lon, count(*) FILTER (station_name<>'') AS named,
  CAST(sum(length(sensor_id)) AS BIGINT) AS sensor_chars, min(epoch) AS first_epoch, count(DISTINCT g_product_id) AS reports
FROM lt GROUP BY ALL""")
def long_table_by_month(spark, sf_dir):
    """A report's first level of each group is marked while levels are still single rows, so that no aggregate is kept for
    each report and variable."""
    group = ["year", "month", "record_number"]
    first = F.row_number().over(Window.partitionBy("g_product_id", *group).orderBy("observation_id")) == 1
    rows = long_table_of(spark, sf_dir, arrange=lambda base: cdm.with_month(base).withColumn("_first", first),
                         keep=["year", "month", "_first"])
    sums = {
        **{out: out for out in _MEASURES.values()},
        "slat": "latitude|station_configuration", "slon": "longitude|station_configuration",
        "salt": "height_of_station_above_sea_level", "lat": "latitude|observations_table",
        "lon": "longitude|observations_table",
    }
    aggs = [F.count(F.lit(1)).alias("rows_out"), F.count("observation_value").alias("valued")]
    for out, src in sums.items():
        aggs.append(F.round(F.sum(f"`{src}`"), 8).alias(f"sum_{out}"))
        if out in _MEASURES.values():
            aggs.append(F.count(f"`{src}`").alias(f"n_{out}"))
    aggs += [
        F.count_if(F.col("`station_name|station_configuration`") != "").alias("named"),
        F.sum(F.length("sensor_id")).alias("sensor_chars"),
        F.min("report_timestamp").alias("first_epoch"),
        F.count_if("_first").alias("reports"),
    ]
    return rows.groupBy("year", "month", "observed_variable", "record_number").agg(*aggs)


@query("long_table_year_range", f"""WITH {LONG}
SELECT year, month, observed_variable, count(*) AS rows_out, round(sum(observation_value),4) AS total
FROM lt WHERE year BETWEEN 1996 AND 1998 GROUP BY ALL""")
def long_table_year_range(spark, sf_dir):
    rows = cdm.with_month(long_table_of(spark, sf_dir, start_year=1996, end_year=1998))
    return rows.groupBy("year", "month", "observed_variable").agg(
        F.count(F.lit(1)).alias("rows_out"), F.round(F.sum("observation_value"), 4).alias("total"))


@query("raw_unit_long_table", f"""WITH {_long(False)}
SELECT observed_variable, round(sum(observation_value),4) AS total, round(sum(u5),4) AS spread, count(*) AS rows_out
FROM lt GROUP BY observed_variable""")
def raw_unit_long_table(spark, sf_dir):
    rows = long_table_of(spark, sf_dir, transform_units=False)
    return rows.groupBy("observed_variable").agg(
        F.round(F.sum("observation_value"), 4).alias("total"), F.round(F.sum("uncertainty_value5"), 4).alias("spread"),
        F.count(F.lit(1)).alias("rows_out"))


@query("encoded_long_table", f"WITH {LONG} SELECT {_ENCODED_SQL} FROM lt")
def encoded_long_table(spark, sf_dir):
    """Storage form of every row, sentinels included; numbers travel in the type that they are stored in, as in the export."""
    return cdm.encoded_long_table(long_table_of(spark, sf_dir, kind="float"))


@query("mandatory_columns", f"""WITH {LONG}
SELECT 'latitude|observations_table' AS column_name, count(*) AS total_rows, count(*) FILTER (lat IS NULL) AS missing FROM lt
UNION ALL SELECT 'longitude|observations_table', count(*), count(*) FILTER (lon IS NULL) FROM lt
UNION ALL SELECT 'report_duration', count(*), 0 FROM lt
UNION ALL SELECT 'report_meaning_of_timestamp', count(*), 0 FROM lt
UNION ALL SELECT 'station_name|station_configuration', count(*), count(*) FILTER (station_name='') FROM lt""")
def mandatory_columns(spark, sf_dir):
    from ascentframe.operators.schema import mandatory_violations

    rows = long_table_of(spark, sf_dir)
    name = "station_name|station_configuration"
    return mandatory_violations(rows.withColumn(name, F.nullif(F.col(f"`{name}`"), F.lit(""))))


@query("station_tiles", f"""WITH {LONG}
SELECT CAST(floor(slat/10)*10 AS INTEGER) AS lat_tile, CAST(floor(slon/10)*10 AS INTEGER) AS lon_tile, count(*) AS rows_out
FROM lt GROUP BY ALL""")
def station_tiles(spark, sf_dir):
    rows = cdm.with_tiles(long_table_of(spark, sf_dir))
    return rows.groupBy("lat_tile", "lon_tile").agg(F.count(F.lit(1)).alias("rows_out"))


@query("available_months", """
SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders WHERE year(o_orderdate)>=1996""")
def available_months(spark, sf_dir):
    rows = V.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("report_timestamp"))
    return cdm.available_months(rows, start_year=1996)


@query("months_to_export", """
SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders
WHERE (year(o_orderdate), month(o_orderdate)) NOT IN (SELECT (year(ts), month(ts)) FROM (
  SELECT o_orderdate AS ts FROM orders WHERE o_totalprice > 490000))""")
def months_to_export(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "report_timestamp")
    existing = cdm.available_months(orders.where("o_totalprice > 490000"))
    return cdm.missing_months(cdm.available_months(orders), existing)


@query("levels_with_headers", """
SELECT l_orderkey AS g_product_id, l_shipdate AS report_timestamp, l_quantity AS value, o_orderdate AS report_timestamp_header,
  o_totalprice AS value_header FROM lineitem JOIN orders ON l_orderkey=o_orderkey""")
def levels_with_headers(spark, sf_dir):
    level = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("g_product_id"), F.col("l_shipdate").alias("report_timestamp"),
        F.col("l_quantity").alias("value"))
    header = V.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("g_product_id"), F.col("o_orderdate").alias("report_timestamp"),
        F.col("o_totalprice").alias("value"))
    return cdm.join_headers(level, header)


@query("either_dialect", """
SELECT event_id, coalesce(CASE WHEN event_type<>'error' THEN value END, value*2) AS number,
  coalesce(CASE WHEN event_type='view' THEN event_type END, props, '') AS words FROM events""")
def either_dialect(spark, sf_dir):
    rows = V.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("old_n"),
        (F.col("value") * 2).alias("new_n"), F.when(F.col("event_type") == "view", F.col("event_type")).alias("old_t"),
        F.col("props").alias("new_t"))
    have = rows.columns
    return rows.select("event_id", numeric.either_number(have, "old_n", "new_n").alias("number"),
                       numeric.either_text(have, "old_t", "new_t").alias("words"))
