"""Surface-parcel ascent: lifting, free convection, equilibrium, energies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ascentframe.functions import thermo as th
from ascentframe.operators.ordered import Group


def with_thermo(group: Group) -> Group:
    """Dew point (K), potential and equivalent potential temperature (K)."""
    tk, p = F.col("tk"), F.col("p")
    group = group.with_columns({"dk": th.dewpoint(tk, F.col("rhp"))})
    return group.with_columns(
        {
            "theta": th.potential_temperature(p, tk),
            "theta_e": th.equivalent_potential_temperature(p, tk, F.col("dk")),
        }
    )


def with_surface(group: Group) -> Group:
    """The lowest valid level, and its lifting condensation level, on every row."""
    lowest = F.max_by(F.struct("p", "tk", "dk", "z", "u_wind", "v_wind", "theta_e"), F.struct("press", "level_idx"))
    group = group.attach({"sfc": lowest})
    group = group.with_columns({"lcl_t": th.lcl_temperature(F.col("sfc.tk"), F.col("sfc.dk"))})
    return group.with_columns({"lcl_p": th.lcl_pressure(F.col("sfc.p"), F.col("sfc.tk"), F.col("lcl_t"))})


def with_ascent(group: Group) -> Group:
    """Parcel temperature ``tp`` (K): dry adiabat up to the LCL, then saturated."""
    moist = th.saturated_temperature(F.col("p"), F.col("sfc.theta_e"), F.col("lcl_t"))
    # below the LCL the steps are not worked out
    group = group.with_columns({"_moist": F.when(F.col("p") < F.col("lcl_p"), moist)})
    dry = F.col("sfc.tk") * F.pow(F.col("p") / F.col("sfc.p"), F.lit(th.KAPPA))
    tp = F.when(F.col("lcl_p").isNotNull(), F.when(F.col("p") >= F.col("lcl_p"), dry).otherwise(F.col("_moist")))
    group = group.on(group.df.withColumn("tp", tp).drop("_moist"))
    return group.with_columns({"lnp": F.ln("p"), "lift": F.col("tp") - F.col("tk")})


def with_crossings(group: Group) -> Group:
    """LFC and EL of the sounding on every row.  Needs ``prev1``.

    LFC: the first level above the LCL where the parcel is warmer; the crossing
    below that level, or the LCL itself if the parcel was already warmer there.
    EL: the uppermost change from warmer to not warmer, if above the LFC.
    """
    before, now = F.col("prev1.lift"), F.col("lift")
    weight = before / (before - now)
    cross_x = F.col("prev1.lnp") + weight * (F.col("lnp") - F.col("prev1.lnp"))
    cross_t = F.col("prev1.tp") + weight * (F.col("tp") - F.col("prev1.tp"))
    upward = (before <= 0) & (now > 0)
    downward = (before > 0) & (now <= 0)
    point = F.struct(F.exp(cross_x).alias("p"), cross_t.alias("t"))
    lcl = F.struct(F.col("lcl_p").alias("p"), F.col("lcl_t").alias("t"))
    start = F.when(upward, F.when(F.exp(cross_x) <= F.col("lcl_p"), point).otherwise(lcl)).otherwise(lcl)
    buoyant = (F.col("p") < F.col("lcl_p")) & (now > 0)
    group = group.with_columns(
        {"_start": F.when(buoyant, start), "_end": F.when(downward, point)}
    )
    group = group.attach(
        {
            "lfc": F.min_by("_start", F.when(buoyant, F.col("rn"))),
            "_el": F.max_by("_end", F.when(downward, F.col("rn"))),
        }
    )
    return group.with_columns({"el": F.when(F.col("_el.p") < F.col("lfc.p"), F.col("_el"))})


def layer_area(lower_x: Column, upper_x: Column) -> Column:
    """Integral of the parcel excess over ln p, from the previous level to this
    one, inside [upper_x, lower_x]; the excess is linear in between."""
    x0, x1 = F.col("prev1.lnp"), F.col("lnp")
    b0, b1 = F.col("prev1.lift"), F.col("lift")
    start, stop = F.least(x0, lower_x), F.greatest(x1, upper_x)

    def excess(x: Column) -> Column:
        return b0 + (b1 - b0) * (x0 - x) / (x0 - x1)

    inside = F.col("lfc").isNotNull() & (x0 > x1) & (start > stop)
    return F.when(inside, (excess(start) + excess(stop)) / 2.0 * (start - stop))


def energy_aggregates() -> dict[str, Column]:
    """CAPE over LFC..EL (the profile top where there is no EL) and CIN over
    surface..LFC (never positive); both 0 without an LFC.  J/kg."""
    lfc_x = F.ln(F.col("lfc.p"))
    top_x = F.coalesce(F.ln(F.col("el.p")), F.lit(float("-1e9")))
    cape = F.sum(layer_area(lfc_x, top_x)) * th.R_DRY
    cin = F.sum(layer_area(F.lit(1e9), lfc_x)) * th.R_DRY
    known = F.max(F.col("tp")).isNotNull()
    return {
        "diag_cape": F.when(known, F.coalesce(cape, F.lit(0.0))),
        "diag_cin": F.when(known, F.least(F.coalesce(cin, F.lit(0.0)), F.lit(0.0))),
    }


def point_aggregates() -> dict[str, Column]:
    out = {}
    for name, where in (("lcl", None), ("lfc", "lfc"), ("el", "el")):
        press = F.col("lcl_p") if where is None else F.col(f"{where}.p")
        temp = F.col("lcl_t") if where is None else F.col(f"{where}.t")
        out[f"diag_{name}_p"] = F.max(press)
        out[f"diag_{name}_t"] = F.max(th.celsius(temp))
    return out
