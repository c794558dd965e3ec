"""Writes to the shared folder and reads back: sinks, sources and the stream."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe import contracts as C
from ascentframe.operators import cdm, tracking
from ascentframe.plans import exporting, importing
from ascentframe.queries import files as Q
from ascentframe.queries import longtable as L
from ascentframe.queries import profiles as P
from ascentframe.queries import views as V
from ascentframe.queries.registry import query
from ascentframe.session import shared_dir, shuffles_dropped
from ascentframe.sinks import snapshots, writers
from ascentframe.sources import tables
from ascentframe.streaming import incremental


def new_folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query("monthly_export_round_trip", f"""WITH {L.LONG}
SELECT year, month, observed_variable, count(*) AS rows_out, count(observation_value) AS valued FROM lt GROUP BY ALL""")
def monthly_export_round_trip(spark, sf_dir):
    """Exports two years first, then all: the second run adds only what is missing."""
    path = new_folder(spark, "long")
    levels = L.levels(spark, sf_dir)
    headers = L.headers(spark, sf_dir).withColumnRenamed("launch_timestamp", "launched")
    months = levels.select("report_timestamp")
    for years in ((1996, 1997), (None, None)):
        exporting.export_months(levels, headers, L.stations(spark, sf_dir), path, *years, months_of=months, levels_timed=True)
    back = spark.read.parquet(path)
    return back.groupBy("year", "month", F.col("observed_variable").cast("int").alias("observed_variable")).agg(
        F.count(F.lit(1)).alias("rows_out"), F.count(F.nanvl("observation_value", F.lit(None))).alias("valued"))


@query("appended_levels", """
SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS n, round(sum(l_quantity),2) AS total
FROM lineitem WHERE year(l_shipdate)=1997 GROUP BY ALL""")
def appended_levels(spark, sf_dir):
    """Levels appended by month, one year read back by partition."""
    path = new_folder(spark, "levels")
    rows = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("g_product_id"), F.col("l_shipdate").alias("report_timestamp"), "l_quantity")
    writers.append_levels(rows, path)
    back = tables.read_levels(spark, path, ["year", "month", "l_quantity"], year=1997)
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("total"))


@query("headers_in_range", """
SELECT o_orderkey AS g_product_id, o_orderdate AS report_timestamp FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1997-03-01'""")
def headers_in_range(spark, sf_dir):
    path = new_folder(spark, "headers")
    rows = V.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("g_product_id"), F.col("o_orderdate").alias("report_timestamp"), "o_totalprice")
    rows.write.parquet(path)
    start, end = (F.to_timestamp_ntz(F.lit(day)) for day in ("1997-02-01", "1997-03-01"))
    return tables.read_headers(spark, path, ["g_product_id", "report_timestamp"], start, end)


@query("tab_text_round_trip", """
SELECT c_custkey AS id, CASE WHEN c_custkey%3<>0 THEN c_name END AS name, CASE WHEN c_custkey%4<>0 THEN c_acctbal END AS elevation
FROM customer""")
def tab_text_round_trip(spark, sf_dir):
    path = new_folder(spark, "text")
    rows = V.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("elevation"))
    writers.write_tab_text(rows, path)
    return tables.read_tab_text(spark, path, rows.schema)


@query("csv_dump_round_trip", """
SELECT year(l_shipdate) AS year, count(*) AS n, round(sum(l_extendedprice),2) AS total FROM lineitem
WHERE year(l_shipdate) BETWEEN 1996 AND 1999 GROUP BY ALL""")
def csv_dump_round_trip(spark, sf_dir):
    path = new_folder(spark, "dump")
    levels = V.table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "report_timestamp")
    writers.dump_csv(levels, V.table(spark, sf_dir, "orders"), path, 1996, 1999)
    back = spark.read.csv(f"{path}/data", header=True)
    return back.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice").cast("double")), 2).alias("total"))


@query("dump_summary", """
WITH y AS (SELECT unnest(range(1990, 2006)) AS year)
SELECT CASE WHEN year NOT IN (SELECT year(l_shipdate) FROM lineitem) THEN 'skipped' WHEN year BETWEEN 1996 AND 1999 THEN 'exported'
  ELSE 'error' END AS outcome, count(*) AS tables FROM y GROUP BY ALL""")
def dump_summary(spark, sf_dir):
    """A dump that broke off after four years, counted against the whole table."""
    path = new_folder(spark, "summary")
    levels = V.table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "report_timestamp")
    writers.dump_csv(levels, V.table(spark, sf_dir, "orders"), path, 1996, 1999, compress=False)
    return writers.dump_summary(levels, path, 1990, 2005)


@query("truncated_table", "SELECT count(*) AS before, 0 AS after, 5 AS columns FROM customer")
def truncated_table(spark, sf_dir):
    """A copied table, emptied: no row, the same columns."""
    path = new_folder(spark, "emptied")
    rows = V.table(spark, sf_dir, "customer")
    rows.write.parquet(path)
    before = spark.read.parquet(path).count()
    writers.truncate(spark, path, rows.schema)
    left = spark.read.parquet(path)
    return left.agg(F.lit(before).alias("before"), F.count(F.lit(1)).cast("int").alias("after")).withColumn(
        "columns", F.lit(len(left.columns)))


@query("export_order", f"""WITH {L.LONG}
SELECT year, month, count(*) AS rows_out, 0 AS misplaced FROM lt GROUP BY ALL""")
def export_order(spark, sf_dir):
    """Rows of an export that stand behind a greater one: in their file by (variable, time, observation), and over the files
    of a month by (time, observation) of their variable."""
    path = new_folder(spark, "ordered")
    levels = L.levels(spark, sf_dir)
    headers = L.headers(spark, sf_dir).withColumnRenamed("launch_timestamp", "launched")
    exporting.export_months(levels, headers, L.stations(spark, sf_dir), path, months_of=levels.select("report_timestamp"), levels_timed=True)
    stored, placed = spark.read.parquet(path), new_folder(spark, "placed")
    sizes = {(r["year"], r["month"]): r["levels"] for r in cdm.levels_by_month(stored).collect()}  # at most 12 per year
    for some in cdm.month_rounds(sizes, len(C.VARIABLES)):
        with shuffles_dropped(spark):  # a month's rows follow each other in one round; what is kept is a row for each month
            _misplaced(cdm.of_months(stored, some)).write.mode("append").parquet(placed)
    return spark.read.parquet(placed)


def _misplaced(stored):
    back = stored.select(
        "year", "month", F.struct("observed_variable", "report_timestamp", "observation_id").alias("place"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    month = ["year", "month"]
    before = F.lag("place").over(Window.partitionBy(*month, "file").orderBy("row"))
    inside = back.withColumn("bad", F.coalesce(before > F.col("place"), F.lit(False)))
    # a variable's rows in a file as one row; the files' names follow the ranges of time
    spans = inside.groupBy(*month, "file", "place.observed_variable").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("bad").alias("bad"), F.min("place").alias("low"), F.max("place").alias("high"))
    last = F.lag("high").over(Window.partitionBy(*month, "observed_variable").orderBy("file"))
    spans = spans.withColumn("late", F.coalesce(last > F.col("low"), F.lit(False)).cast("int"))
    return spans.groupBy(*month).agg(F.sum("rows").alias("rows_out"), (F.sum("bad") + F.sum("late")).cast("int").alias("misplaced"))


#: A box over two tiles and parts of others, and one over the antimeridian.
BOXES = {"near": (0.0, 24.5, 35.0, 61.25), "around": (-10.0, 40.0, 100.0, 12.0)}


@query("tiled_boxes", f"""WITH {L.LONG},
box AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {', '.join(f'{x}::DOUBLE' for x in b)})" for n, b in BOXES.items())}) AS t(box, s, n, w, e))
SELECT box, CAST(floor(slat/10)*10 AS INTEGER) AS lat_tile, CAST(floor(slon/10)*10 AS INTEGER) AS lon_tile, count(*) AS rows_out,
  count(DISTINCT g_product_id) AS reports, round(sum(observation_value),3) AS total
FROM lt JOIN box ON slat BETWEEN s AND n AND CASE WHEN w<=e THEN slon BETWEEN w AND e ELSE slon>=w OR slon<=e END
WHERE observed_variable=126 GROUP BY ALL""")
def tiled_boxes(spark, sf_dir):
    """Air temperatures of all stations laid out by tile, two boxes read back."""
    path = new_folder(spark, "tiles")
    writers.write_tiles(L.long_table_of(spark, sf_dir, codes=[126]), path)
    result = None
    for name, box in BOXES.items():
        part = tables.read_box(spark, path, *box).groupBy("lat_tile", "lon_tile").agg(
            F.count(F.lit(1)).alias("rows_out"), F.count_distinct("report_id").alias("reports"),
            F.round(F.sum("observation_value"), 3).alias("total")).withColumn("box", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


@query("published_dictionary", " UNION ALL ".join(
    f"SELECT {v.code} AS code, '{v.label}' AS label, {v.unit} AS units, count(*) AS levels FROM lineitem JOIN orders ON l_orderkey=o_orderkey"
    f" JOIN customer ON o_custkey=c_custkey" for v in C.VARIABLES))
def published_dictionary(spark, sf_dir):
    """The dictionary that an export publishes beside its months, with the rows of each variable."""
    path = new_folder(spark, "published")
    levels = L.levels(spark, sf_dir)
    headers = L.headers(spark, sf_dir).withColumnRenamed("launch_timestamp", "launched")
    exporting.export_months(levels, headers, L.stations(spark, sf_dir), path, months_of=levels.select("report_timestamp"), levels_timed=True)
    rows = spark.read.parquet(path).groupBy(F.col("observed_variable").cast("int").alias("code")).agg(F.count(F.lit(1)).alias("levels"))
    return spark.read.parquet(f"{path}/{writers.DICTIONARY}").join(rows, "code", "left")


@query("sounding_export_check", """
SELECT CASE event_type WHEN 'view' THEN 'RS-11G' WHEN 'click' THEN 'IMS-100' ELSE event_type END AS sonde_type,
  count(*) AS n, true AS complete FROM events GROUP BY ALL""")
def sounding_export_check(spark, sf_dir):
    path = new_folder(spark, "soundings")
    events = V.table(spark, sf_dir, "events")
    sonde = F.when(F.col("event_type") == "view", "RS11G").when(F.col("event_type") == "click", "IMS100").otherwise(
        F.col("event_type"))
    levels = events.select(F.col("user_id").alias("g_product_id"), "value", sonde.alias("sonde"))
    attrs = levels.select("g_product_id", "sonde").distinct().withColumn(
        "attrs", F.create_map(F.lit("id"), F.col("g_product_id").cast("string")))
    written = writers.export_soundings(levels, attrs, path)
    back = spark.read.parquet(f"{path}/levels")
    return back.groupBy("sonde_type").agg(F.count(F.lit(1)).alias("n")).withColumn("complete", F.lit(written.complete))


@query("levels_from_arrays", """
SELECT vec_id, CAST(pos-1 AS INTEGER) AS level_idx, CAST(embedding[pos] AS DOUBLE) AS temp, CAST(embedding[pos]*2 AS DOUBLE) AS rh
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding)+1)) AS pos FROM embeddings)""")
def levels_from_arrays(spark, sf_dir):
    rows = V.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("temp"),
        F.transform("embedding", lambda x: (x * F.lit(2).cast("float")).cast("double")).alias("rh"))
    return tables.levels_from_arrays(rows, "vec_id", ["temp", "rh"])


_SITE = "CASE WHEN user_id%9=0 THEN 'NATION_30' ELSE 'NATION_' || (user_id%25) END"
_TIME = "make_timestamp(2024, CAST(1+user_id%12 AS BIGINT), CAST(1+user_id%27 AS BIGINT), 0, 0, 0)"
#: Accepted soundings come in two batches, even numbers first; their levels are numbered through.
STORE = P.VALID + f""",
ob AS (
  SELECT s.*, g_product_id AS user_id, row_number() OVER (ORDER BY g_product_id%2, g_product_id, level_idx) AS observation_id
  FROM sc s WHERE g_product_id%9<>0),
hs AS (SELECT *, {_SITE} AS site, {_TIME} AS ts FROM ob)"""


def _load(spark, sf_dir, again: bool):
    """Loads all soundings in two batches.  With ``again`` the first batch was loaded before from bad sources (stations
    unknown, every launch a month late, soundings of the other batch among them), is loaded rightly, and once more the
    same; each run replaces the one before."""
    levels = V.sounding_levels(spark, sf_dir)
    sid = F.col("g_product_id")
    station = F.when(sid % 9 == 0, F.lit("NATION_30")).otherwise(F.concat(F.lit("NATION_"), (sid % 25).cast("string")))
    stamp = F.format_string("2024-%02d-%02d 00:00:00", sid % 12 + 1, sid % 27 + 1)
    old = F.col("c") == "CF-1.4"
    entries = {"Conventions": F.col("c"), "g.Product.ID": sid.cast("string"), "g.Site.Key": F.when(~old, station),
               "g.Measurement.StandardTime": F.when(~old, stamp), "g.General.SiteCode": F.when(old, station),
               "g.Ascent.StandardTime": F.when(old, stamp), "g.Site.Name": F.concat(F.lit("Site "), station),
               "g.Product.Code": F.lit("CODE"), "g.MeasurementSystem.Latitude": F.concat((sid % 80).cast("string"), F.lit(".5 deg"))}
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries.items()])
    attrs = levels.groupBy("g_product_id").agg(F.max("conventions").alias("c")).select(
        "g_product_id", F.map_from_entries(F.filter(pairs, lambda x: x["value"].isNotNull())).alias("attrs"))
    late = F.transform_values("attrs", lambda k, v: F.when(k.endswith("StandardTime"), F.date_format(
        F.add_months(v.try_cast("timestamp"), 1), "yyyy-MM-dd HH:mm:ss")).when(k.isin("g.Site.Key", "g.General.SiteCode") & (sid % 4 == 0), "").otherwise(v))
    bad = attrs.withColumn("attrs", late)
    root = new_folder(spark, "store")
    runs = [("0", sid % 4 < 3, bad)] * again + [("0", sid % 2 == 0, attrs), ("1", sid % 2 == 1, attrs)] + [("0", sid % 2 == 0, attrs)] * again
    for batch, chosen, given in runs:
        importing.load_soundings(levels.where(chosen).drop("conventions"), given.where(chosen), Q.nation_stations(spark, sf_dir),
                                 "NET", root, sonde="RS41", batch=batch)
    return root


@query("loaded_soundings", f"""
WITH {STORE},
u AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT u.user_id AS g_product_id, CASE WHEN u.user_id%9=0 THEN 'Station ''NATION_30'' not found in NET station database' END AS reason,
  CASE WHEN u.user_id%9<>0 THEN n END AS stored_levels, u.user_id%9<>0 AS diagnosed, f.first_id AS first_id,
  CASE WHEN u.user_id%9<>0 THEN CAST(u.user_id%25+1 AS INTEGER) END AS idstation_pk,
  CASE WHEN u.user_id%9<>0 THEN {_TIME.replace('user_id', 'u.user_id')} END AS report_timestamp,
  CASE WHEN u.user_id%9<>0 THEN u.user_id%80+0.5e0 END AS latitude,
  CASE WHEN u.user_id%9<>0 AND u.user_id%2=0 THEN 'NATION_' || (u.user_id%25) END AS wmo
FROM u LEFT JOIN (SELECT g_product_id, min(observation_id) AS first_id FROM hs GROUP BY ALL) f ON f.g_product_id=u.user_id""")
def loaded_soundings(spark, sf_dir):
    """Validates, numbers, diagnoses and stores all soundings (one batch three times, first from bad sources), then reads
    the three tables."""
    root = _load(spark, sf_dir, again=True)
    header, stored, bad = (snapshots.read(spark, root, name) for name in (importing.HEADERS, importing.LEVELS, importing.REJECTS))
    counts = stored.groupBy("g_product_id").agg(F.count(F.lit(1)).alias("stored_levels"), F.min("observation_id").alias("first_id"))
    good = header.join(counts, "g_product_id").select(
        "g_product_id", F.lit(None).cast("string").alias("reason"), "stored_levels",
        F.col("diag_pwat").isNotNull().alias("diagnosed"), "first_id", F.col("idstation_pk").cast("int").alias("idstation_pk"),
        F.col("report_timestamp").cast("timestamp_ntz").alias("report_timestamp"),
        F.col("g_measurementsystem_latitude").alias("latitude"), F.col("g_general_sitewmoid").alias("wmo"))
    return good.unionByName(bad.select("g_product_id", "reason", F.lit(False).alias("diagnosed")), allowMissingColumns=True)


_OF_LEVEL = {126: "temp", 138: "rhp", 104: "u", 105: "v", 125: "alt", 142: "press*100e0"}


@query("exported_store", f"""
WITH {STORE}
SELECT year(ts) AS year, month(ts) AS month, g_product_id AS report_id, observation_id, code AS observed_variable,
  round(CAST(CAST(x AS FLOAT) AS DOUBLE), 2) AS observation_value, site AS primary_station_id, 'Site ' || site AS station_name,
  CAST(epoch(ts) AS BIGINT) AS report_timestamp, CAST(user_id%25+1 AS INTEGER) AS record_number
FROM hs, (""" + " UNION ALL ".join(f"SELECT {v.code} AS code" for v in C.VARIABLES) + f""") codes,
LATERAL (SELECT CASE {' '.join(f'WHEN code={k} THEN {x}' for k, x in _OF_LEVEL.items())} END AS x) v""")
def exported_store(spark, sf_dir):
    """Loads a store, exports it, and reads the long table back."""
    root = _load(spark, sf_dir, again=False)
    out = new_folder(spark, "exported")
    for _ in range(2):  # the second run finds nothing to do
        exporting.export_store(spark, root, Q.nation_stations(spark, sf_dir), out)
    back = spark.read.parquet(out)
    value = F.round(F.nanvl(F.col("observation_value").cast("double"), F.lit(None)), 2)
    return back.select(
        "year", "month", F.col("report_id").cast("long").alias("report_id"), "observation_id",
        F.col("observed_variable").cast("int").alias("observed_variable"), value.alias("observation_value"), "primary_station_id",
        F.col("`station_name|station_configuration`").alias("station_name"), "report_timestamp", "record_number")


FILE_LIST = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                          T.StructField("modificationTime", T.TimestampNTZType())])


@query("streamed_import_state", f"""WITH {Q.SURVIVORS}
SELECT filename, left(reason,255) AS note FROM sv""")
def streamed_import_state(spark, sf_dir):
    """All archives arrive in six lots, with a snapshot after the fourth; the state after the last one."""
    base = new_folder(spark, "stream")
    V.archive_files(spark, sf_dir).repartition(6, "path").write.parquet(f"{base}/arrivals")
    arriving = spark.readStream.schema(FILE_LIST).option("maxFilesPerTrigger", 1).parquet(f"{base}/arrivals")
    incremental.start_planning(arriving, f"{base}/plan", f"{base}/checkpoint", "RS41").awaitTermination()
    return tracking.current_state(incremental.read_events(spark, f"{base}/plan")).select("filename", "note")


