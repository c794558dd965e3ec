"""Validity, preference and ordering rules of one sounding's levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe import contracts as C
from ascentframe.operators.ordered import Group, per_group

KEY = "g_product_id"
VALID_KEYS = [KEY, "valid"]

# optional level columns of the diagnostics
OPTIONAL = ("alt", "alt_amsl", "u", "v", "wzon", "wmeri")


def finite(col: Column) -> Column:
    """The value where it is a finite number, else NULL."""
    col = col.cast("double")
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def smoothed(value: str, shift: int = 0, prev: str = "prev", nxt: str = "next", half: int = 2) -> Column:
    """Centred boxcar mean of ``value`` at ``shift`` rows from this one, with
    the edge value repeated beyond the ends of the group.

    Needs neighbour structs out to ``half + |shift|`` rows on both sides.
    """

    def at(offset: int) -> Column:
        if offset == 0:
            return F.col(value)
        side, steps = (prev, -offset) if offset < 0 else (nxt, offset)
        nearer = [F.col(f"{side}{k}.{value}") for k in range(steps, 0, -1)]
        return F.coalesce(*nearer, F.col(value))

    total = at(shift - half)
    for offset in range(shift - half + 1, shift + half + 1):
        total = total + at(offset)
    return total / float(2 * half + 1)


def with_optional(levels: DataFrame) -> DataFrame:
    missing = [name for name in OPTIONAL if name not in levels.columns]
    return levels.withColumns({name: F.lit(None).cast("double") for name in missing}) if missing else levels


def humidity_percent(rh: Column, conventions: Column, max_rh: Column) -> Column:
    """Relative humidity in percent: fractions of the old dialect are scaled."""
    old = conventions.isin(*C.OLD_DIALECTS) & (max_rh <= 1.1)
    return F.when(old, rh * 100.0).otherwise(rh)


def scale_humidity(group: Group) -> Group:
    if "conventions" not in group.df.columns:
        return group
    group = group.attach({"_max_rh": F.max(finite(F.col("rh")))})
    scaled = humidity_percent(F.col("rh"), F.col("conventions"), F.col("_max_rh"))
    return group.with_columns({"rh": scaled})


def mark_valid(group: Group) -> Group:
    """Adds p, tk, rhp, z, u_wind, v_wind (NULL where not finite), ``has_wind``,
    ``valid`` and ``n_valid``; preferences are settled per sounding."""
    group = group.attach({f"_n_{name}": F.count(F.col(name)) for name in OPTIONAL if name != "alt"})
    has = {name: F.col(f"_n_{name}") > 0 for name in OPTIONAL if name != "alt"}
    group = group.with_columns({"has_wind": (has["u"] | has["wzon"]) & (has["v"] | has["wmeri"])})

    def chosen(first: str, second: str) -> Column:
        return finite(F.when(has[first], F.col(first)).otherwise(F.col(second)))

    group = group.with_columns(
        {
            "p": finite(F.col("press")),
            "tk": finite(F.col("temp")),
            "rhp": finite(F.col("rh")),
            "z": chosen("alt_amsl", "alt"),
            "u_wind": F.when(F.col("has_wind"), chosen("u", "wzon")),
            "v_wind": F.when(F.col("has_wind"), chosen("v", "wmeri")),
        }
    )
    core = (F.col("p") > 0) & F.col("tk").isNotNull() & F.col("rhp").isNotNull() & F.col("z").isNotNull()
    wind = ~F.col("has_wind") | (F.col("u_wind").isNotNull() & F.col("v_wind").isNotNull())
    group = group.with_columns({"valid": F.coalesce(core & wind, F.lit(False))})
    group = group.attach({"n_valid": F.count(F.when(F.col("valid"), 1))})
    return group.on(group.df.drop("_max_rh", *[f"_n_{name}" for name in OPTIONAL]))


def top_down_order() -> list[Column]:
    """Pressure falling; among equal pressures the later level first."""
    return [F.desc("press"), F.desc("level_idx")]


def over_soundings(levels: DataFrame, work, sizes: DataFrame | None = None) -> DataFrame:
    """Runs ``work`` on groups of one sounding's levels in profile order, with
    humidity scaled and validity marked."""

    def prepared(group: Group) -> DataFrame:
        return work(mark_valid(scale_humidity(group)))

    return per_group(with_optional(levels), [KEY], top_down_order(), prepared, sizes)


def valid_levels(group: Group, at_least: int = C.MIN_VALID_LEVELS) -> Group:
    good = group.df.where(F.col("valid") & (F.col("n_valid") >= at_least))
    return Group(good, group.keys, group.order, group.parts)


def interpolated(names: list[str], at: float, axis: str = "p") -> dict[str, Column]:
    """Aggregates that give each column at ``axis = at``, linear between the two
    nearest levels and clamped at the ends of the profile."""
    pack = F.struct(axis, *names)
    near = F.struct(axis, "rn")
    high = F.min_by(F.when(F.col(axis) >= at, pack), F.when(F.col(axis) >= at, near))
    low = F.max_by(F.when(F.col(axis) <= at, pack), F.when(F.col(axis) <= at, near))
    share = F.when(high[axis] == low[axis], F.lit(0.0)).otherwise(
        (F.lit(at) - low[axis]) / (high[axis] - low[axis])
    )
    out = {}
    for name in names:
        inner = low[name] + share * (high[name] - low[name])
        out[name] = F.when(high.isNull(), low[name]).when(low.isNull(), high[name]).otherwise(inner)
    return out


def schema_of_levels() -> T.StructType:
    cols = [("g_product_id", T.LongType()), ("level_idx", T.IntegerType())]
    cols += [(name, T.DoubleType()) for name in ("press", "temp", "rh", *OPTIONAL)]
    return T.StructType([T.StructField(name, dtype) for name, dtype in cols])
