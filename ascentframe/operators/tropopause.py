"""Thermal tropopause: lapse rate at most 2 K/km at a level at or above 500 hPa,
and on average over the 2 km above it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ascentframe.operators.ordered import Group

# --- fixed values: constants of the thermal tropopause ---
R_OVER_G = 29.27  # m/K
LAPSE_LIMIT = 2.0  # K/km
TOP_PRESSURE = 500.0  # hPa
DEPTH_KM = 2.0


def with_height(group: Group) -> Group:
    """``zkm``: height above the lowest level from the hypsometric equation, and
    ``dz``/``lapse`` against the level below.  Needs ``prev1`` of (p, tk)."""
    mean_t = (F.col("prev1.tk") + F.col("tk")) * 0.5
    dz = F.lit(R_OVER_G) * mean_t * F.ln(F.col("prev1.p") / F.col("p")) / 1000.0
    group = group.with_columns({"dz": F.coalesce(dz, F.lit(0.0))})
    group = group.running({"zkm": F.col("dz")})
    lapse = F.when(F.col("dz") > 0, (F.col("prev1.tk") - F.col("tk")) / F.col("dz"))
    return group.with_columns({"lapse": lapse})


def thermal_tropopause(group: Group) -> DataFrame:
    """One row per sounding that has a tropopause: p (hPa) and T (Celsius)."""
    key = group.keys[0]
    group = group.number("rn").neighbours(["p", "tk"], back=1)
    group = with_height(group)
    last = F.max_by(F.struct("zkm", "tk", "rn"), F.col("rn"))
    group = group.attach({"last": last})
    narrow = group.on(
        group.df.select(*_kept(group), "p", "tk", "zkm", "lapse", "rn", "last")
    )
    candidate = (
        (F.col("p") <= TOP_PRESSURE) & (F.col("lapse") <= LAPSE_LIMIT)
        & (F.col("rn") < F.col("last.rn")) & (F.col("rn") > 1)
    )
    looked = narrow.reach_ahead("zkm", DEPTH_KM, ["zkm", "tk"], "above", candidate, "rn")
    above_z = F.coalesce(F.col("above.zkm"), F.col("last.zkm"))
    above_t = F.coalesce(F.col("above.tk"), F.col("last.tk"))
    depth = above_z - F.col("zkm")
    mean_lapse = (F.col("tk") - above_t) / depth
    hit = F.when(depth > 0, mean_lapse <= LAPSE_LIMIT)
    return looked.where(hit).groupBy(key).agg(
        F.min_by("p", "rn").alias("diag_tropopause_p"),
        (F.min_by("tk", "rn") - 273.15).alias("diag_tropopause_t"),
    )


def _kept(group: Group) -> list[str]:
    return [name for name in (*group.keys, "_part", "_parts") if name in group.df.columns]
