"""Accept-or-reject rules of one sounding, each with its reason.

Rules form a chain; the first reason that applies is the one reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ascentframe import contracts as C
from ascentframe.functions.times import lenient_timestamp

CONVENTIONS, PRODUCT = "Conventions", "g.Product.ID"


def _by_dialect(values: dict[str, Column]) -> Column:
    dialect = F.col("attrs")[CONVENTIONS]
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(dialect == name, value).otherwise(out)
    return out


def judge_soundings(attrs: DataFrame, level_counts: DataFrame, stations: DataFrame, network: str,
                    sonde: str = "") -> DataFrame:
    """Every sounding with ``station_key``, ``idstation_pk``, ``report_timestamp``
    and ``reason`` (NULL when accepted).

    ``attrs``: g_product_id, attrs (map).  ``level_counts``: g_product_id,
    n_levels, n_times.  ``stations`` is the station dimension; it is joined
    without a hint, so it is broadcast only if its size allows.
    """
    df = attrs.join(level_counts, "g_product_id", "left")
    key_name = _by_dialect({d: F.lit(keys[0]) for d, keys in C.DIALECT_KEYS.items()})
    time_name = _by_dialect({d: F.lit(keys[1]) for d, keys in C.DIALECT_KEYS.items()})
    df = df.withColumns(
        {
            "conventions": F.col("attrs")[CONVENTIONS],
            "station_key": F.nullif(_by_dialect({d: F.col("attrs")[k[0]] for d, k in C.DIALECT_KEYS.items()}),
                                    F.lit("")),
            "time_text": F.coalesce(_by_dialect({d: F.col("attrs")[k[1]] for d, k in C.DIALECT_KEYS.items()}),
                                    F.lit("")),
            "_key_name": key_name,
            "_time_name": time_name,
        }
    )
    wanted = stations.where(F.col("network") == network).select(
        F.col("idstation").alias("station_key"), F.col("id").alias("idstation_pk")
    )
    df = df.join(wanted, "station_key", "left")
    df = df.withColumn("report_timestamp", lenient_timestamp(F.col("time_text")))

    def reason(condition: Column, *parts) -> Column:
        return F.when(condition, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]))

    names = F.transform(F.map_keys("attrs"), F.lower)
    # fixed values: the reason texts
    rules = [
        reason(F.coalesce(F.col("n_levels"), F.lit(0)) == 0, "No measurement data provided"),
        reason(F.coalesce(F.col("n_times"), F.lit(0)) == 0, "No time data found in measurements"),
        reason(F.col("conventions").isNull(), f"Error converting: missing attribute {CONVENTIONS}"),
        reason(F.col("_key_name").isNull(), "Unsupported file conventions: ", F.col("conventions")),
        reason(F.col("station_key").isNull(), "Missing station identifier (", F.col("_key_name"), ") in metadata"),
        reason(F.col("idstation_pk").isNull(), "Station '", F.col("station_key"),
               f"' not found in {network} station database"),
        reason(F.col("report_timestamp").isNull(), f"Invalid timestamp format for {sonde}: '",
               F.col("time_text"), "'"),
        reason(~F.array_contains(names, PRODUCT.lower()), f"Error converting: missing attribute {PRODUCT}"),
    ]
    return df.withColumn("reason", F.coalesce(*rules)).drop("_key_name", "_time_name")


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where("reason IS NULL")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where("reason IS NOT NULL")


def soundings_without_levels(headers: DataFrame, levels: DataFrame) -> DataFrame:
    """Headers no level belongs to."""
    return headers.join(levels.select("g_product_id"), "g_product_id", "left_anti")


def outcome_counts(judged: DataFrame) -> DataFrame:
    outcome = F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    return judged.groupBy(outcome.alias("outcome")).count()
