"""Views of the given tables in the shape of the library's inputs.

Each view maps whole tables row by row with closed formulas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ascentframe.operators.ordered import Group, per_group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# One formula text per column: Spark and the SQL twins read the same words.
ARCHIVE_COLUMNS = {
    "station": "concat('ST', chr(CAST(65 + o_custkey % 5 AS INT)))",
    "folder": "CASE WHEN o_orderkey % 2 = 0 THEN '-RS-01' ELSE '-RS-02' END",
    "product": "CASE o_orderstatus WHEN 'F' THEN 'RS41-GDP' WHEN 'O' THEN 'RS92-GDP' ELSE 'IMS-100-GDP' END",
    "extra": "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '2_' END",
    "grp": "concat('1-00', CAST(o_orderkey % 2 AS STRING), '-00', CAST(o_custkey % 4 AS STRING))",
    "tail": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN '.jar' WHEN '4' THEN '.zip' "
            "ELSE concat('_rev00', substring(o_orderpriority, 1, 1), '.jar') END",
}


def seconds(ts):
    """Epoch seconds with the fraction, from a timestamp without zone."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ``k``: 0-based position in the user's events by (ts, event_id)."""
    events = table(spark, sf_dir, "events")

    def work(group: Group) -> DataFrame:
        return group.number("rn").df.withColumn("k", F.col("rn") - 1).drop("rn")

    return per_group(events, ["user_id"], [F.asc("ts"), F.asc("event_id")], work)


def sounding_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sounding per user, one level per event."""
    rows = numbered_events(spark, sf_dir)
    sid, k, value = F.col("user_id"), F.col("k"), F.col("value")
    alt = F.lit(100.0) + 320.0 * k
    base = F.greatest(288.15 + sid % 20 - 0.0065 * (alt - 100.0), 210.0 + sid % 5)
    rh = F.lit(20.0) + (value * 7) % 80
    return rows.select(
        sid.alias("g_product_id"),
        k.cast("int").alias("level_idx"),
        (F.lit(1000.0) * F.exp(-k / 25.0)).alias("press"),
        alt.alias("alt"),
        F.when(F.col("event_type") != "error", base + ((value % 1.0) - 0.5) * 0.2).alias("temp"),
        F.when(sid % 2 == 0, rh / 100.0).otherwise(rh).alias("rh"),
        F.when(sid % 7 != 0, 5.0 + 0.4 * k + value % 3).alias("u"),
        F.when(sid % 7 != 0, -2.0 + 0.1 * k).alias("v"),
        F.when(sid % 2 == 0, F.lit("CF-1.4")).otherwise(F.lit("CF-1.7")).alias("conventions"),
    )


def archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive path per order; several may belong to one launch."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    parts = orders.select("*", *[F.expr(text).alias(f"f_{name}") for name, text in ARCHIVE_COLUMNS.items()])
    stamp = F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss")
    code = F.concat("f_station", "f_folder")
    name = F.concat(code, F.lit("_"), "f_extra", "f_product", F.lit("_00"), (F.col("o_custkey") % 3).cast("string"),
                    F.lit("_"), stamp, F.lit("_"), "f_grp", F.lit("_AI"), F.col("o_orderkey").cast("string"), "f_tail")
    return parts.select(
        F.concat(F.lit("archive/"), code, F.lit("/"), name).alias("path"),
        F.col("o_orderkey").alias("length"),
        F.col("o_orderdate").alias("modificationTime"),
    )


ARCHIVE_SQL = (
    "fa AS (SELECT *, "
    + ", ".join(f"{text.replace('STRING', 'VARCHAR')} AS f_{name}" for name, text in ARCHIVE_COLUMNS.items())
    + """ FROM orders),
files AS (
  SELECT 'archive/' || f_station || f_folder || '/' || f_station || f_folder || '_' || f_extra || f_product || '_00'
    || CAST(o_custkey % 3 AS VARCHAR) || '_' || strftime(o_orderdate, '%Y%m%dT%H%M%S') || '_' || f_grp || '_AI'
    || CAST(o_orderkey AS VARCHAR) || f_tail AS path, * FROM fa)"""
)


def tracking_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tracked file per order: imported, excluded with a note, or waiting."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 3, 20).alias("sonde"),
        F.concat(F.lit("file-"), F.col("o_orderkey").cast("string")).alias("filename"),
        F.when(status == "F", F.col("o_orderdate").cast("timestamp")).alias("date_of_import"),
        F.when(status == "P", F.concat(F.lit("excluded "), F.col("o_custkey").cast("string"))).alias("note"),
    )


STATE_SQL = """st AS (
  SELECT substring(o_orderpriority, 3, 20) AS sonde, 'file-' || CAST(o_orderkey AS VARCHAR) AS filename,
    CASE WHEN o_orderstatus='F' THEN o_orderdate END AS date_of_import,
    CASE WHEN o_orderstatus='P' THEN 'excluded ' || CAST(o_custkey AS VARCHAR) END AS note, * FROM orders)"""
