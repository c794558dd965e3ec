"""The station dimension: normalising harvested rows, upsert, look-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ascentframe.functions import text
from ascentframe.operators.ordered import per_group
from ascentframe.session import ensure_checkpoint_dir

DESCRIPTIVE = ("name", "latitude", "longitude", "elevation", "wmoid")


def normalised_cells(cells: Column) -> dict[str, Column]:
    """Station columns from six table cells in page order."""
    return {
        "idstation": F.trim(F.get(cells, 0)),
        "name": text.station_name(F.get(cells, 1)),
        "latitude": text.degrees(F.get(cells, 2)),
        "longitude": text.degrees(F.get(cells, 3)),
        "elevation": text.elevation(F.get(cells, 4)),
        "wmoid": text.strict_integer(F.get(cells, 5)),
    }


def stations_from_cells(rows: DataFrame, cells: str = "cells", *keep: str) -> DataFrame:
    """Rows with at least six cells and a non-blank id, as station rows; the columns
    ``keep`` stay."""
    usable = rows.where((F.size(cells) >= 6) & (F.trim(F.get(cells, 0)) != ""))
    return usable.select(*keep, *[col.alias(name) for name, col in normalised_cells(F.col(cells)).items()])


def latest_rows(incoming: DataFrame, order: str | None = None) -> DataFrame:
    """One row for each code: the one that is last by ``order``, among equals (or
    without an order) the one with the greatest description."""
    described = F.struct(*DESCRIPTIVE)
    rank = F.struct(*([order] if order else []), *DESCRIPTIVE)
    last = incoming.where(F.col("idstation").isNotNull()).groupBy("idstation").agg(F.max_by(described, rank).alias("_last"))
    return last.select("idstation", "_last.*")


def refresh_stations(current: DataFrame, harvested: DataFrame, network: str, cells: str = "cells",
                     order: str | None = None) -> DataFrame:
    """Harvested table rows, normalised and merged into the station dimension."""
    rows = harvested.withColumn("_order", F.col(order) if order else F.lit(0))
    usable = stations_from_cells(rows, cells, "_order")
    return upsert_stations(current, usable, network, "_order")


def upsert_stations(current: DataFrame, incoming: DataFrame, network: str, order: str | None = None) -> DataFrame:
    """Current stations with incoming ones merged in.  A matched station takes
    the incoming description and the network; an unmatched incoming one gets the
    next ids in order of its code; the others stay.  Of incoming rows with one
    code the last by ``order`` counts."""
    # read for both halves, and to count and number the new ones: written down, so that pages are taken apart once
    ensure_checkpoint_dir(incoming.sparkSession)
    incoming = latest_rows(incoming, order).checkpoint(eager=True)
    merged = (
        current.alias("c")
        .join(incoming.alias("n"), F.col("c.idstation") == F.col("n.idstation"), "left")
        .select(
            "c.id",
            "c.idstation",
            *[F.when(F.col("n.idstation").isNotNull(), F.col(f"n.{name}")).otherwise(F.col(f"c.{name}")).alias(name)
              for name in DESCRIPTIVE],
            F.when(F.col("n.idstation").isNotNull(), F.lit(network)).otherwise(F.col("c.network")).alias("network"),
        )
    )
    fresh = incoming.join(current.select("idstation"), "idstation", "left_anti").withColumn("_all", F.lit(1))
    fresh = per_group(fresh, ["_all"], [F.asc("idstation")], lambda group: group.number("_nth").df)
    top = current.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    fresh = fresh.select(
        (top + F.col("_nth")).cast(current.schema["id"].dataType).alias("id"),
        "idstation", *DESCRIPTIVE, F.lit(network).alias("network"),
    )
    return merged.unionByName(fresh)


def with_station_id(df: DataFrame, stations: DataFrame, code: str, network: str) -> DataFrame:
    """Adds ``station_id`` by (code, network); NULL when unknown."""
    lookup = stations.where(F.col("network") == network).select(
        F.col("idstation").alias(code), F.col("id").alias("station_id")
    )
    return df.join(lookup, code, "left")
