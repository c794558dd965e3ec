"""All diagnostics of a sounding: profile columns for the level table and one
row of scalars for the header table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ascentframe import contracts as C
from ascentframe.functions import thermo as th
from ascentframe.operators import clouds, parcel, tropopause, wind
from ascentframe.operators.ordered import Group
from ascentframe.operators.profile import (
    KEY,
    VALID_KEYS,
    interpolated,
    over_soundings,
    top_down_order,
    valid_levels,
)

STANDARD_LEVELS = (850.0, 700.0, 500.0)


def _by_validity(group: Group) -> Group:
    return Group(group.df, VALID_KEYS, top_down_order(), group.parts)


def diagnosed_levels(levels: DataFrame, min_levels: int = C.MIN_VALID_LEVELS, sizes: DataFrame | None = None) -> DataFrame:
    """Every input level with td (Celsius), theta, theta_e (K) and
    parcel_profile (Celsius).  The four are NULL on invalid levels and in
    soundings with fewer than ``min_levels`` valid ones; no level is lost.
    ``sizes``: as in ``per_group``."""
    keep = levels.columns

    def work(group: Group) -> DataFrame:
        split = _by_validity(group)
        split = parcel.with_ascent(parcel.with_surface(parcel.with_thermo(split)))
        use = F.col("valid") & (F.col("n_valid") >= min_levels)
        values = {
            "td": th.celsius(F.col("dk")),
            "theta": F.col("theta"),
            "theta_e": F.col("theta_e"),
            "parcel_profile": th.celsius(F.col("tp")),
        }
        return split.df.select(*keep, "valid", "n_valid",
                               *[F.when(use, col).alias(name) for name, col in values.items()])

    return over_soundings(levels, work, sizes)


def _indices() -> dict:
    out = {}
    for level in STANDARD_LEVELS:
        names = ["tc", "dc", "tpc"] if level == 500.0 else ["tc", "dc"]
        for name, col in interpolated(names, level).items():
            out[f"_{name}{int(level)}"] = col
    return out


def _with_indices(df: DataFrame) -> DataFrame:
    """K, Total Totals, Lifted and Showalter index; each NULL on its own."""
    t850, t700, t500 = (F.col(f"_tc{int(level)}") for level in STANDARD_LEVELS)
    d850, d700 = F.col("_dc850"), F.col("_dc700")
    df = df.withColumns(
        {
            "diag_k_index": (t850 - t500) + d850 - (t700 - d700),
            "diag_total_totals": t850 + d850 - 2.0 * t500,
            "diag_lifted_index": t500 - F.col("_tpc500"),
            "_t0": t850 + th.ZERO_C,
            "_d0": d850 + th.ZERO_C,
        }
    )
    start, dew = F.col("_t0"), F.col("_d0")
    df = df.withColumn("_lt", th.lcl_temperature(start, dew))
    df = df.withColumns(
        {
            "_lp": th.lcl_pressure(F.lit(850.0), start, F.col("_lt")),
            "_th": th.equivalent_potential_temperature(F.lit(850.0), start, dew),
        }
    )
    df = df.withColumn("_up", th.saturated_temperature(F.lit(500.0), F.col("_th"), F.col("_lt")))
    dry = start * F.pow(F.lit(500.0 / 850.0), F.lit(th.KAPPA))
    lifted = F.when(F.col("_lp") <= 500.0, dry).otherwise(F.col("_up"))
    return df.withColumn("diag_showalter", t500 - th.celsius(lifted))


def _scalars(group: Group) -> DataFrame:
    """Scalars of every sounding except the tropopause."""
    group = parcel.with_ascent(parcel.with_surface(parcel.with_thermo(group)))
    group = group.with_columns(
        {
            "w": th.mixing_ratio(F.col("p"), th.saturation_pressure(F.col("dk"))),
            "tc": th.celsius(F.col("tk")),
            "dc": th.celsius(F.col("dk")),
            "tpc": th.celsius(F.col("tp")),
        }
    )
    around = ["p", "lnp", "tk", "tp", "lift", "rhp", "z", "u_wind", "v_wind", "w"]
    group = group.number("rn").neighbours(around, back=3, ahead=3)
    group = group.with_columns({"turn": wind.turning(), "high_hit": clouds.high_hit()})
    group = parcel.with_crossings(group)

    # trapezoid of the mixing ratio over falling pressure; hPa -> Pa; per g
    water = F.sum((F.col("w") + F.col("prev1.w")) / 2.0 * (F.col("prev1.p") - F.col("p"))) * (100.0 / th.GRAVITY)
    freezing = F.min(F.when(F.col("tk") <= th.ZERO_C, F.col("rn"))) - 1
    aggs = {
        **parcel.point_aggregates(),
        **parcel.energy_aggregates(),
        **_indices(),
        "diag_pwat": water,
        "diag_freezing_level_index": freezing.cast("int"),
        **clouds.cloud_aggregates(),
        **wind.shear_aggregates(),
        **wind.helicity_aggregates(),
    }
    rows = group.df.groupBy(KEY).agg(*[col.alias(name) for name, col in aggs.items()])
    return _with_indices(rows)


def sounding_scalars(levels: DataFrame, min_levels: int = C.MIN_VALID_LEVELS) -> DataFrame:
    """One row per sounding with at least ``min_levels`` valid levels and all
    scalar diagnostics, under their storage names."""
    names = [name for name in C.SCALAR_DIAGNOSTICS if not name.startswith("diag_tropopause")]

    def work(group: Group) -> DataFrame:
        good = valid_levels(group, min_levels)
        main = _scalars(good).select(KEY, *names)
        return main.join(tropopause.thermal_tropopause(good), KEY, "left").select(KEY, *C.SCALAR_DIAGNOSTICS)

    # the join of the two halves implies this test on one side only; stated for
    # both, their scan and exchange are the same and are run once
    return over_soundings(levels.where(F.col(KEY).isNotNull()), work)


def tropopauses(levels: DataFrame, min_levels: int = C.MIN_VALID_LEVELS) -> DataFrame:
    """Only the tropopause, for callers that need nothing else."""
    return over_soundings(levels, lambda group: tropopause.thermal_tropopause(valid_levels(group, min_levels)))


def enrich(levels: DataFrame, headers: DataFrame, min_levels: int = C.MIN_VALID_LEVELS):
    """(levels with the profile columns, headers with the scalar columns).

    ``headers`` holds one row per sounding and may carry ``conventions``, which
    drives the humidity rule.  Soundings that cannot be diagnosed keep their
    rows, with NULL diagnostics.
    """
    source = levels
    if "conventions" in headers.columns and "conventions" not in levels.columns:
        source = levels.join(headers.select(KEY, "conventions"), KEY, "left")
    out_levels = diagnosed_levels(source, min_levels).drop("valid", "n_valid")
    out_headers = headers.join(sounding_scalars(source, min_levels), KEY, "left")
    return out_levels, out_headers


def full_sounding_diagnostics(levels: DataFrame, min_levels: int = 1) -> DataFrame:
    """The nested form: one row per sounding with structs ``Parcel``, ``Indices``,
    ``Tropopause``, ``Wind``, ``Misc`` and ``CloudBase``."""
    flat = sounding_scalars(levels, min_levels)

    def pick(**fields):
        return F.struct(*[F.col(f"diag_{src}").alias(name) for name, src in fields.items()])

    return flat.select(
        KEY,
        pick(LCL_p="lcl_p", LCL_t="lcl_t", LFC_p="lfc_p", LFC_t="lfc_t", EL_p="el_p", EL_t="el_t",
             CAPE="cape", CIN="cin").alias("Parcel"),
        pick(LiftedIndex="lifted_index", KIndex="k_index", TotalTotals="total_totals",
             Showalter="showalter").alias("Indices"),
        pick(p="tropopause_p", t="tropopause_t").alias("Tropopause"),
        pick(Shear_0_1km_u="shear_0_1km_u", Shear_0_1km_v="shear_0_1km_v",
             Shear_0_3km_u="shear_0_3km_u", Shear_0_3km_v="shear_0_3km_v",
             Shear_0_6km_u="shear_0_6km_u", Shear_0_6km_v="shear_0_6km_v",
             SRH_positive="srh_0_3km_pos", SRH_negative="srh_0_3km_neg",
             SRH_total="srh_0_3km_tot").alias("Wind"),
        pick(PWAT="pwat", FreezingLevelIndex="freezing_level_index").alias("Misc"),
        pick(Height="cloud_base_height", Type="cloud_base_type").alias("CloudBase"),
    )
