"""Bulk shear and storm-relative helicity of the lowest layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ascentframe.operators.profile import interpolated

SHEAR_TOPS_KM = (1, 3, 6)
HELICITY_TOP_M = 3000.0


def _wind_at(depth: float, axis: str) -> Column:
    """Wind component at the surface height plus ``depth``, linear in height;
    NULL where the profile does not reach it."""
    top = F.col("sfc.z") + depth
    pack = F.struct("z", "u_wind", "v_wind")
    near = F.struct("z", "rn")
    below = F.max_by(F.when(F.col("z") <= top, pack), F.when(F.col("z") <= top, near))
    above = F.min_by(F.when(F.col("z") >= top, pack), F.when(F.col("z") >= top, near))
    base = F.max(F.col("sfc.z")) + depth
    share = F.when(above["z"] == below["z"], F.lit(0.0)).otherwise((base - below["z"]) / (above["z"] - below["z"]))
    return below[axis] + share * (above[axis] - below[axis])


def shear_aggregates() -> dict[str, Column]:
    out = {}
    for top in SHEAR_TOPS_KM:
        for short, axis in (("u", "u_wind"), ("v", "v_wind")):
            out[f"diag_shear_0_{top}km_{short}"] = _wind_at(top * 1000.0, axis) - F.max(F.col(f"sfc.{axis}"))
    return out


def turning() -> Column:
    """u' v - u v' between this level and the next; the next is cut at the top of
    the layer.  NULL for levels outside the layer.  Needs ``next1``."""
    top = F.col("sfc.z") + HELICITY_TOP_M
    z0, z1 = F.col("z"), F.col("next1.z")
    share = F.when(z1 > top, (top - z0) / (z1 - z0)).otherwise(F.lit(1.0))
    u0, v0 = F.col("u_wind"), F.col("v_wind")
    u1 = u0 + share * (F.col("next1.u_wind") - u0)
    v1 = v0 + share * (F.col("next1.v_wind") - v0)
    return F.when(z0 < top, u1 * v0 - u0 * v1)


def helicity_aggregates() -> dict[str, Column]:
    part = F.col("turn")
    reached = (F.max("z") >= F.max(F.col("sfc.z")) + HELICITY_TOP_M) & (F.count(part) > 0)
    sums = {
        "pos": F.coalesce(F.sum(F.when(part > 0, part)), F.lit(0.0)),
        "neg": F.coalesce(F.sum(F.when(part < 0, part)), F.lit(0.0)),
        "tot": F.sum(part),
    }
    return {f"diag_srh_0_3km_{name}": F.when(reached, value) for name, value in sums.items()}
