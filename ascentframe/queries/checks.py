"""Reconciliation of stored tables with re-processed ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ascentframe.operators import reconcile as R
from ascentframe.plans import verifying
from ascentframe.queries import views as V
from ascentframe.queries.registry import query

#: Numbers the levels of an order; line, price and quantity together occur once.
OBSERVATION = ("(CAST(l_linenumber AS BIGINT) * 10000000000 + CAST(round(l_extendedprice * 100) AS BIGINT)) * 100 "
               "+ CAST(l_quantity AS BIGINT)")
COLUMNS = ("quantity", "price", "discount", "tax")


#: What the store holds: no soundings of some numbers, no levels of others, some without their tail or a middle level.
LEFT = ("l_orderkey % 11 <> 0 AND l_orderkey % 19 <> 0 AND NOT (l_orderkey % 13 = 0 AND l_linenumber >= 3) "
        "AND NOT (l_orderkey % 17 = 0 AND l_linenumber = 2)")


def source_levels(spark, sf_dir):
    return V.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("g_product_id"), F.expr(OBSERVATION).alias("observation_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


def stored_levels(spark, sf_dir):
    """The same levels as a store holds them: every third sounding unchanged, the others off by little; soundings,
    profiles, tails and middles missing, some values off, some lost, some columns lost whole."""
    rows = source_levels(spark, sf_dir).where(LEFT.replace("l_orderkey", "g_product_id").replace(
        "l_linenumber", "(observation_id DIV 1000000000000)"))
    key = F.col("g_product_id")
    odd, same, line = key % 10 == 0, key % 3 == 1, F.expr("observation_id DIV 1000000000000")
    return rows.withColumns(
        {
            "quantity": F.when(same, F.col("quantity")).when(odd, F.col("quantity") + 0.02).otherwise(F.col("quantity") + 0.005),
            "price": F.when(same, F.col("price")).when(key % 6 != 0, F.col("price") * 1.000001),
            "discount": F.when(key % 4 == 0, F.lit(float("nan"))).otherwise(F.col("discount")),
            "tax": F.when((key % 7 != 0) | (line != 4), F.col("tax")),
        }
    )


_POS = "row_number() OVER (PARTITION BY l_orderkey ORDER BY " + OBSERVATION + ") AS pos"
CMP = f"""
e AS (SELECT l_orderkey AS k, {_POS}, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem),
a AS (
  SELECT l_orderkey AS k, {_POS}, CASE WHEN l_orderkey%3=1 THEN l_quantity WHEN l_orderkey%10=0 THEN l_quantity+0.02e0
      ELSE l_quantity+0.005e0 END AS quantity,
    CASE WHEN l_orderkey%3=1 THEN l_extendedprice WHEN l_orderkey%6<>0 THEN l_extendedprice*1.000001e0 END AS price,
    CASE WHEN l_orderkey%4<>0 THEN l_discount END AS discount,
    CASE WHEN l_orderkey%7<>0 OR l_linenumber<>4 THEN l_tax END AS tax FROM lineitem WHERE {LEFT}),
j AS (""" + " UNION ALL ".join(
    f"SELECT coalesce(e.k,a.k) AS k, '{c}' AS column_name, e.{c} AS x, a.{c} AS y, e.k IS NULL AS is_extra, a.k IS NULL AS is_missing "
    "FROM e FULL JOIN a ON e.k=a.k AND e.pos=a.pos" for c in COLUMNS
) + """),
cp AS (
  SELECT k, column_name, count(x-y) AS compared, count(*) FILTER (abs(x-y)>1e-2+1e-5*abs(y)) AS off,
    count(*) FILTER ((x IS NULL) <> (y IS NULL)) AS one_sided, max(abs(x-y)) AS max_diff,
    count(*) FILTER (is_missing) AS missing, count(*) FILTER (is_extra) AS extra
  FROM j GROUP BY k, column_name HAVING compared>0 OR one_sided+missing+extra>0),
ps AS (SELECT *, CASE WHEN off=0 AND one_sided+missing+extra=0 THEN 'OK' ELSE 'ERR' END AS status FROM cp)"""


def profile_rows(spark, sf_dir):
    return R.compare_levels(source_levels(spark, sf_dir), stored_levels(spark, sf_dir), "g_product_id", "observation_id", COLUMNS)


@query("profile_reconciliation", f"""WITH {CMP}
SELECT k AS g_product_id, column_name, compared, off, one_sided, missing, extra, round(max_diff,6) AS max_diff, status FROM ps""")
def profile_reconciliation(spark, sf_dir):
    return profile_rows(spark, sf_dir).withColumn("max_diff", F.round("max_diff", 6))


HEADERS = ("totalprice", "status", "priority", "launch_time", "serial", "sonde", "version")


def source_headers(spark, sf_dir):
    return V.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("g_product_id"),
        F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(" m")).alias("totalprice"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("launch_time"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("N"), (F.col("o_custkey") % 7).cast("string"), F.lit(" x")))
        .otherwise(F.format_string("%03d", F.col("o_custkey") % 7)).alias("serial"),
        F.lit("RS41").alias("sonde"), F.lit("1.10").alias("version"), *_identity())


def _identity():
    """Station and time of an order's sounding; the same on both sides, unlike the stored numbers."""
    return [F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("station"),
            F.col("o_orderdate").alias("report_timestamp")]


def stored_headers(spark, sf_dir):
    k = F.col("o_orderkey")
    shifted = F.col("o_orderdate") + F.expr("CASE WHEN o_orderkey % 5 = 0 THEN INTERVAL 2 SECOND ELSE INTERVAL 0 SECOND END")
    price = F.when(k % 3 == 0, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice")).cast("decimal(18,3)").cast("string")
    unit = F.when(k % 8 == 0, F.lit(" km")).when(k % 8 == 1, F.lit("")).otherwise(F.lit(" m"))
    return V.table(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0").select(
        k.alias("g_product_id"),
        F.concat(price, unit).alias("totalprice"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("  "), "o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.date_format(shifted, "yyyy-MM-dd HH:mm:ss").alias("launch_time"),
        F.concat(F.when(k % 2 == 0, F.lit("S")).otherwise(F.lit("")), (F.col("o_custkey") % 7).cast("string")).alias("serial"),
        F.when(k % 2 == 0, F.lit("IMS41")).otherwise(F.lit(" RS41 ")).alias("sonde"),
        F.when(k % 4 == 2, F.lit("1.1")).otherwise(F.lit("1.10 ")).alias("version"), *_identity())


HDR = """
h AS (
  SELECT o_orderkey AS k, 'totalprice' AS column_name,
    CASE WHEN o_orderkey%8<2 OR o_orderkey%3=0 AND 100 > 1e-4+1e-5*abs(o_totalprice+100) THEN 'ERR' ELSE 'OK' END AS status FROM orders
  UNION ALL SELECT o_orderkey, 'status', CASE WHEN o_orderkey%4=0 THEN 'ERR' ELSE 'OK' END FROM orders
  UNION ALL SELECT o_orderkey, 'priority', 'OK' FROM orders
  UNION ALL SELECT o_orderkey, 'launch_time', CASE WHEN o_orderkey%5=0 THEN 'ERR' ELSE 'OK' END FROM orders
  UNION ALL SELECT o_orderkey, 'serial', 'ERR' FROM orders
  UNION ALL SELECT o_orderkey, 'version', CASE WHEN o_orderkey%4=2 THEN 'ERR' ELSE 'OK' END FROM orders
  UNION ALL SELECT o_orderkey, 'sonde', CASE WHEN o_orderkey%2=0 THEN 'ERR' ELSE 'OK' END FROM orders),
hs AS (SELECT * FROM h WHERE k%11<>0)"""


def header_rows(spark, sf_dir):
    return R.compare_headers(source_headers(spark, sf_dir), stored_headers(spark, sf_dir), "g_product_id", HEADERS, ("totalprice",))


@query("header_reconciliation", f"WITH {HDR} SELECT k AS g_product_id, column_name, status FROM hs")
def header_reconciliation(spark, sf_dir):
    return header_rows(spark, sf_dir).select("g_product_id", "column_name", "status")


@query("missing_soundings", "SELECT o_orderkey AS g_product_id FROM orders WHERE o_orderkey%11=0")
def missing_soundings(spark, sf_dir):
    return R.missing_soundings(source_headers(spark, sf_dir), stored_headers(spark, sf_dir), "g_product_id")


VERDICT = CMP + "," + HDR + """,
vd AS (
  SELECT o_orderkey AS g_product_id, o_orderkey%11<>0 AS found,
    coalesce(p.ok,0) AS profile_ok, coalesce(p.err,0) AS profile_err, coalesce(q.ok,0) AS header_ok, coalesce(q.err,0) AS header_err
  FROM orders
  LEFT JOIN (SELECT k, count(*) FILTER (status='OK') AS ok, count(*) FILTER (status='ERR') AS err FROM ps GROUP BY k) p ON p.k=o_orderkey
  LEFT JOIN (SELECT k, count(*) FILTER (status='OK') AS ok, count(*) FILTER (status='ERR') AS err FROM hs
    WHERE column_name NOT IN ('serial', 'sonde', 'version') GROUP BY k) q ON q.k=o_orderkey),
vx AS (SELECT *, found AND profile_ok+profile_err>0 AND profile_err=0 AND header_err=0 AS passed FROM vd)"""


def verdict_rows(spark, sf_dir):
    """Stored soundings have numbers of their own and are found by station and time."""
    other = F.col("g_product_id") + 10_000_000
    return verifying.verify(
        source_levels(spark, sf_dir), stored_levels(spark, sf_dir).withColumn("g_product_id", other),
        source_headers(spark, sf_dir), stored_headers(spark, sf_dir).withColumn("g_product_id", other),
        COLUMNS, HEADERS[:4], numeric=("totalprice",))


@query("sounding_check_verdicts", f"WITH {VERDICT} SELECT * FROM vx")
def sounding_check_verdicts(spark, sf_dir):
    return verdict_rows(spark, sf_dir)


@query("global_check_verdict", f"""WITH {VERDICT}
SELECT count(*) AS soundings, count(*) FILTER (passed) AS passed, bool_and(passed) AS all_passed FROM vx""")
def global_check_verdict(spark, sf_dir):
    return R.global_verdict(verdict_rows(spark, sf_dir))
