"""Station harvest, upsert and look-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from ascentframe.operators import stations
from ascentframe.queries import views as V
from ascentframe.queries.registry import query
from ascentframe.sources import html


def station_pages(spark, sf_dir):
    """One page per customer holding a site table: a header row, the customer's
    row, a row with too few cells and one with a blank id."""
    key = F.col("c_custkey")
    wmo = F.when(key % 3 == 0, F.concat(F.lit("0-2-"), key.cast("string"))).otherwise(key.cast("string"))
    cells = [
        F.concat(F.lit("<b>"), "c_name", F.lit("</b>")),
        F.concat("c_mktsegment", F.lit(", NZ &amp; more")),
        F.concat((F.col("c_acctbal") / 100).cast("decimal(12,2)").cast("string"), F.lit("°")),
        F.when(key % 4 == 0, F.lit("unknown")).otherwise(F.concat((key % 180).cast("string"), F.lit(".5&deg;"))),
        F.concat((key % 90).cast("string"), F.lit(" m / "), (key % 70).cast("string"), F.lit(".5 m")),
        wmo,
    ]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td class='c'> "), c, F.lit(" </td>")) for c in cells], F.lit("</tr>"))
    page = F.concat(
        F.lit("<html><body><p>x</p><table id='s'>\n<tr><th>Code</th></tr>\n"), row,
        F.lit("\n<tr><td>short</td></tr><tr><td> </td><td>a</td><td>1</td><td>2</td><td>3</td><td>4</td></tr></table>"
              "<table><tr><td>other</td></tr></table></body></html>"))
    return V.table(spark, sf_dir, "customer").select("c_custkey", page.alias("html"))


@query("station_harvest", """
SELECT c_custkey, c_name AS idstation, c_mktsegment AS name,
  TRY_CAST(CAST(CAST(c_acctbal/100 AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE) AS latitude,
  CASE WHEN c_custkey%4<>0 THEN c_custkey%180+0.5e0 END AS longitude,
  CAST(greatest(c_custkey%90, c_custkey%70+0.5e0) AS DOUBLE) AS elevation,
  CASE WHEN c_custkey%3<>0 THEN CAST(c_custkey AS INTEGER) END AS wmoid FROM customer""")
def station_harvest(spark, sf_dir):
    rows = html.table_rows(station_pages(spark, sf_dir), "html", ["c_custkey"])
    return stations.stations_from_cells(rows, "cells", "c_custkey")


@query("page_list_items", r"""
WITH i AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1)) AS body,
  generate_subscripts(regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1), 1) - 1 AS pos FROM pages)
SELECT page_id, CAST(pos AS INTEGER) AS pos, regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(body, '<[^>]*>', '', 'g'), '&nbsp;',' '),'&lt;','<'),'&gt;','>'),'&quot;','"'),'&#39;',chr(39)),'&deg;','°'),'&amp;','&'),
  '^\s+',''),'\s+$','') AS text FROM i""")
def page_list_items(spark, sf_dir):
    return html.elements(V.table(spark, sf_dir, "pages"), "html", "li", ["page_id"])


def current_stations(spark, sf_dir):
    rows = V.table(spark, sf_dir, "supplier")
    return rows.select(
        (F.col("s_suppkey") + 1).alias("id"), F.concat(F.lit("N"), F.col("s_suppkey").cast("string")).alias("idstation"),
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        F.col("s_nationkey").cast("double").alias("elevation"), F.lit(None).cast("int").alias("wmoid"),
        F.lit("OLD").alias("network"))


def incoming_stations(spark, sf_dir):
    rows = V.table(spark, sf_dir, "customer")
    return rows.select(
        F.concat(F.lit("N"), (F.floor(F.col("c_custkey") / 2) * 3).cast("string")).alias("idstation"),
        F.col("c_custkey").alias("page"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("latitude"), (F.col("c_custkey") % 180).cast("double").alias("longitude"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey").cast("double")).alias("elevation"),
        F.col("c_nationkey").alias("wmoid"))


UPSERT = """
cur AS (SELECT s_suppkey+1 AS id, 'N' || s_suppkey AS idstation, s_name AS name, s_acctbal AS latitude,
  CAST(NULL AS DOUBLE) AS longitude, CAST(s_nationkey AS DOUBLE) AS elevation, CAST(NULL AS INTEGER) AS wmoid, 'OLD' AS network FROM supplier),
inc AS (SELECT 'N' || (c_custkey//2*3) AS idstation, c_name AS name, c_acctbal AS latitude, CAST(c_custkey%180 AS DOUBLE) AS longitude,
  CASE WHEN c_custkey%2=0 THEN CAST(c_nationkey AS DOUBLE) END AS elevation, c_nationkey AS wmoid FROM customer
  QUALIFY row_number() OVER (PARTITION BY c_custkey//2 ORDER BY c_custkey DESC)=1),
ups AS (
  SELECT c.id, c.idstation, CASE WHEN n.idstation IS NOT NULL THEN n.name ELSE c.name END AS name,
    CASE WHEN n.idstation IS NOT NULL THEN n.latitude ELSE c.latitude END AS latitude,
    CASE WHEN n.idstation IS NOT NULL THEN n.longitude ELSE c.longitude END AS longitude,
    CASE WHEN n.idstation IS NOT NULL THEN n.elevation ELSE c.elevation END AS elevation,
    CASE WHEN n.idstation IS NOT NULL THEN n.wmoid ELSE c.wmoid END AS wmoid,
    CASE WHEN n.idstation IS NOT NULL THEN 'NET' ELSE c.network END AS network
  FROM cur c LEFT JOIN inc n ON n.idstation=c.idstation
  UNION ALL
  SELECT (SELECT max(id) FROM cur) + row_number() OVER (ORDER BY idstation), idstation, name, latitude, longitude, elevation, wmoid, 'NET'
  FROM inc WHERE idstation NOT IN (SELECT idstation FROM cur))"""


@query("station_upsert", f"WITH {UPSERT} SELECT * FROM ups")
def station_upsert(spark, sf_dir):
    return stations.upsert_stations(current_stations(spark, sf_dir), incoming_stations(spark, sf_dir), "NET", "page")


@query("station_refresh", """
WITH cur AS (SELECT s_suppkey+1 AS id, 'N' || s_suppkey AS idstation, s_name AS name, s_acctbal AS latitude,
  CAST(NULL AS DOUBLE) AS longitude, CAST(s_nationkey AS DOUBLE) AS elevation, CAST(NULL AS INTEGER) AS wmoid, 'OLD' AS network FROM supplier)
SELECT * FROM cur
UNION ALL SELECT (SELECT max(id) FROM cur) + row_number() OVER (ORDER BY c_name), c_name, c_mktsegment,
  TRY_CAST(CAST(CAST(c_acctbal/100 AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE), CASE WHEN c_custkey%4<>0 THEN c_custkey%180+0.5e0 END,
  CAST(greatest(c_custkey%90, c_custkey%70+0.5e0) AS DOUBLE), CASE WHEN c_custkey%3<>0 THEN CAST(c_custkey AS INTEGER) END, 'NET'
FROM customer""")
def station_refresh(spark, sf_dir):
    """Harvested pages normalised and merged into the station dimension."""
    rows = html.table_rows(station_pages(spark, sf_dir), "html", ["c_custkey"])
    return stations.refresh_stations(current_stations(spark, sf_dir), rows, "NET", order="c_custkey")


@query("station_lookup", """
SELECT o_orderkey, 'NATION_' || (o_custkey%30) AS code, CASE WHEN o_custkey%30<25 AND o_custkey%30%2=0 THEN o_custkey%30+1 END AS station_id
FROM orders""")
def station_lookup(spark, sf_dir):
    dim = V.table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).alias("id"), F.col("n_name").alias("idstation"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lit("NET")).otherwise(F.lit("OTHER")).alias("network"))
    rows = V.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("NATION_"), (F.col("o_custkey") % 30).cast("string")).alias("code"))
    return stations.with_station_id(rows, dim, "code", "NET")
