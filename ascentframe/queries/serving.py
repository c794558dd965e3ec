"""Launch catalogue and profile serving over events and the long table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ascentframe.operators import catalog, cdm
from ascentframe.plans import exporting
from ascentframe.queries import longtable
from ascentframe.queries import views as V
from ascentframe.queries.registry import query
from ascentframe.queries.storage import new_folder

FILE = ["user_id"]


def blocks(spark, sf_dir):
    """Events as an ordered file per user; a run of one event type is a launch."""
    rows = V.table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("code"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"),
    )
    return catalog.marked_blocks(rows, FILE, [F.asc("ts"), F.asc("event_id")], ["event_type"])


def launch_rows(spark, sf_dir):
    return catalog.launches(blocks(spark, sf_dir), FILE, "event_type", "epoch", "code")


BLOCKS = """
b0 AS (
  SELECT user_id, ts, event_id, event_type, CAST(regexp_extract(props,'[0-9]+') AS INTEGER) AS code,
    row_number() OVER w - 1 AS idx, CASE WHEN row_number() OVER w=1 THEN 0
      WHEN lag(event_type) OVER w <> event_type THEN 1 ELSE 0 END AS chg
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b1 AS (SELECT *, CAST(sum(chg) OVER (PARTITION BY user_id ORDER BY idx) AS BIGINT) AS block_id FROM b0),
ln AS (
  SELECT user_id, block_id, min(idx) AS start_idx, max(idx)+1 AS end_idx, min_by(event_type, idx) AS station_name,
    strftime(min_by(ts, idx), '%Y-%m-%d %H:%M:%S') AS launch_date, list_sort(list(DISTINCT code)) AS codes
  FROM b1 GROUP BY ALL),
lb AS (
  SELECT user_id, block_id, start_idx, end_idx, station_name, launch_date, code,
    CASE code WHEN 73 THEN 'shortwave_radiation' ELSE 'Code ' || code END AS label
  FROM (SELECT * EXCLUDE (codes), unnest(codes) AS code FROM ln))"""


@query("launch_segments", f"WITH {BLOCKS} SELECT event_id, user_id, idx, block_id FROM b1")
def launch_segments(spark, sf_dir):
    return blocks(spark, sf_dir).select("event_id", "user_id", "idx", "block_id")


@query("launches", f"""WITH {BLOCKS}
SELECT user_id, block_id, start_idx, end_idx, station_name, launch_date, array_to_string(codes, ',') AS codes FROM ln""")
def launches(spark, sf_dir):
    return launch_rows(spark, sf_dir).withColumn("codes", F.array_join("codes", ","))


@query("first_launches", f"""WITH {BLOCKS}
SELECT user_id, block_id, start_idx, end_idx, station_name FROM ln WHERE block_id < 5""")
def first_launches(spark, sf_dir):
    rows = catalog.launches(blocks(spark, sf_dir), FILE, "event_type", "epoch", "code", max_launches=5)
    return rows.select("user_id", "block_id", "start_idx", "end_idx", "station_name")


@query("launch_variables", f"WITH {BLOCKS} SELECT * FROM lb")
def launch_variables(spark, sf_dir):
    return catalog.launch_labels(launch_rows(spark, sf_dir), cdm.variable_dim(spark), FILE)


@query("launch_catalogue", f"""WITH {BLOCKS}
SELECT user_id, block_id, station_name, launch_date, start_idx, end_idx,
  string_agg(code || '=' || label, ';' ORDER BY code) AS variable_labels FROM lb GROUP BY ALL""")
def launch_catalogue(spark, sf_dir):
    rows = catalog.catalogue(launch_rows(spark, sf_dir), cdm.variable_dim(spark), FILE)
    entries = F.array_sort(F.map_entries("variable_labels"))
    shown = F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"]))
    return rows.withColumn("variable_labels", F.array_join(shown, ";"))


@query("dataset_variables", f"WITH {BLOCKS} SELECT DISTINCT code, label FROM lb")
def dataset_variables(spark, sf_dir):
    return catalog.dataset_variables(catalog.launch_labels(launch_rows(spark, sf_dir), cdm.variable_dim(spark), FILE))


@query("station_dates", f"WITH {BLOCKS} SELECT DISTINCT station_name, launch_date FROM ln")
def station_dates(spark, sf_dir):
    return catalog.station_dates(launch_rows(spark, sf_dir))


@query("launch_choices", f"""WITH {BLOCKS}
SELECT station_name, launch_date, label || ' (code ' || code || ')' AS display, count(*) AS blocks,
  max((user_id, block_id))[1] AS user_id, max((user_id, block_id))[2] AS block_id, max(code) AS code,
  max_by(start_idx, (user_id, block_id)) AS start_idx, max_by(end_idx, (user_id, block_id)) AS end_idx
FROM lb GROUP BY station_name, launch_date, label, code""")
def launch_choices(spark, sf_dir):
    labels = catalog.launch_labels(launch_rows(spark, sf_dir), cdm.variable_dim(spark), FILE)
    return catalog.launch_choices(labels, ["user_id", "block_id"])


_STORED = "round(CAST(CAST({} AS FLOAT) AS DOUBLE),3)"


@query("profile_by_altitude", f"""WITH {longtable.LONG},
one AS (SELECT station_name, epoch FROM lt WHERE station_name<>'' GROUP BY ALL
  ORDER BY count(*) DESC, station_name, epoch LIMIT 1)
SELECT {_STORED.format("z_coordinate")} AS z_coordinate, {_STORED.format("observation_value")} AS observation_value,
  {_STORED.format("u1")} AS uncertainty_value1, {_STORED.format("u2")} AS uncertainty_value2, {_STORED.format("u5")} AS uncertainty_value5
FROM lt JOIN one USING (station_name, epoch) WHERE observed_variable=126""")
def profile_by_altitude(spark, sf_dir):
    """The air-temperature profile of the launch with the most rows (a top-1 report), from a stored export: the launch
    index names it and its file, and the file's slice is read by start and end."""
    path = new_folder(spark, "served")
    levels, headers = longtable.levels(spark, sf_dir), longtable.headers(spark, sf_dir).withColumnRenamed("launch_timestamp", "launched")
    exporting.export_months(levels, headers, longtable.stations(spark, sf_dir), path, months_of=levels.select("report_timestamp"), levels_timed=True)
    catalog.write_launch_index(spark, path)
    named = catalog.launch_index(spark, path).where("station_name <> ''")
    one = named.groupBy("station_name", "epoch").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), "station_name", "epoch").first()
    if one is None:
        return catalog.launch_slice(spark, path, "", 0, 126)
    served = catalog.launch_slice(spark, path, one["station_name"], one["epoch"], 126)
    return served.select(*[F.round(F.nanvl(F.col(name).cast("double"), F.lit(None)), 3).alias(name) for name in served.columns])


@query("launch_slices", f"""WITH {longtable.LONG}
SELECT station_name, epoch, observed_variable AS code, year, month, count(*) AS rows, true AS inside FROM lt GROUP BY ALL""")
def launch_slices(spark, sf_dir):
    """The launch index of a stored export: rows of every launch and variable by month, all inside their slices."""
    path = new_folder(spark, "sliced")
    levels, headers = longtable.levels(spark, sf_dir), longtable.headers(spark, sf_dir).withColumnRenamed("launch_timestamp", "launched")
    exporting.export_months(levels, headers, longtable.stations(spark, sf_dir), path, months_of=levels.select("report_timestamp"), levels_timed=True)
    catalog.write_launch_index(spark, path)
    return catalog.launch_index(spark, path).groupBy("station_name", "epoch", "code", "year", "month").agg(
        F.sum("rows").alias("rows"), F.bool_and(F.col("rows") <= F.col("end_idx") - F.col("start_idx")).alias("inside"))


@query("station_index", f"""WITH {BLOCKS}
SELECT station_name, launch_date, user_id, block_id, start_idx, end_idx,
  row_number() OVER (PARTITION BY station_name, launch_date ORDER BY user_id, block_id) AS nth,
  count(*) OVER (PARTITION BY station_name, launch_date) AS blocks FROM ln""")
def station_index(spark, sf_dir):
    return catalog.station_index(launch_rows(spark, sf_dir), ["user_id", "block_id"])
