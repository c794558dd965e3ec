"""Moist thermodynamics as column expressions.

Formulas: Bolton (1980), "The Computation of Equivalent Potential Temperature",
Mon. Wea. Rev. 108.  Pressure in hPa, temperature in K unless a name says
otherwise.  A result outside the domain of its formula is NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KAPPA = 2.0 / 7.0
EPSILON = 0.62195691
R_DRY = 287.0474709
GRAVITY = 9.80665
ZERO_C = 273.15
LIFT_STEPS = 8
#: A step that moves the temperature (K) by less is the last: the next would move it by its square, below the last digit.
SETTLED = 1e-7


def _positive(col: Column) -> Column:
    return F.when(col > 0, col)


def saturation_pressure(temp_k: Column) -> Column:
    """Bolton eq. 10."""
    return F.lit(6.112) * F.exp(F.lit(17.67) * (temp_k - ZERO_C) / (temp_k - 29.65))


def dewpoint(temp_k: Column, rh_percent: Column) -> Column:
    """Dew point in K from temperature and relative humidity in percent."""
    ratio = F.ln(_positive(rh_percent / 100.0 * saturation_pressure(temp_k)) / 6.112)
    return F.lit(243.5) * ratio / (F.lit(17.67) - ratio) + ZERO_C


def mixing_ratio(press: Column, vapour: Column) -> Column:
    """kg/kg from total and vapour pressure."""
    return F.lit(EPSILON) * vapour / _positive(press - vapour)


def potential_temperature(press: Column, temp_k: Column) -> Column:
    return temp_k * F.pow(F.lit(1000.0) / _positive(press), F.lit(KAPPA))


def lcl_temperature(temp_k: Column, dew_k: Column) -> Column:
    """Bolton eq. 15."""
    return 1.0 / (1.0 / (dew_k - 56.0) + F.ln(temp_k / dew_k) / 800.0) + 56.0


def lcl_pressure(press: Column, temp_k: Column, lcl_k: Column) -> Column:
    return press * F.pow(lcl_k / temp_k, F.lit(1.0 / KAPPA))


def equivalent_potential_temperature(press: Column, temp_k: Column, dew_k: Column) -> Column:
    """Bolton eq. 39 with the dry potential temperature of eq. 24."""
    vapour = saturation_pressure(dew_k)
    mix = mixing_ratio(press, vapour)
    at_lcl = lcl_temperature(temp_k, dew_k)
    dry = potential_temperature(press - vapour, temp_k) * F.pow(temp_k / at_lcl, 0.28 * mix)
    return dry * F.exp(mix * (1.0 + 0.448 * mix) * (3036.0 / at_lcl - 1.78))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def saturated_temperature(press: Column | str, theta_e: Column | str, lcl_k: Column | str) -> Column:
    """Temperature (K) at ``press`` of a saturated parcel with equivalent potential
    temperature ``theta_e`` that became saturated at ``lcl_k``.

    Newton steps on ln(theta_e).  The start is an upper bound of the solution and
    the function is convex there, so the steps fall monotonically; eight reach
    1e-9 K over the range of soundings, and most levels settle after three or four,
    which ends their steps.  The steps are a fold over a short array:
    the expression has the size of one step, however often it is used, no Python
    runs, and rows stay in their partitions.
    """
    press, theta_e, lcl_k = (F.col(c) if isinstance(c, str) else c for c in (press, theta_e, lcl_k))
    goal = F.ln(theta_e)
    start = F.when(lcl_k.isNotNull(), F.least(lcl_k, theta_e * F.pow(press / 1000.0, F.lit(KAPPA))))

    def moved(temp: Column, dry: Column, mix: Column, goal: Column) -> Column:
        """Excess over slope.  What is interpreted costs by its operations, so common factors are drawn out."""
        heat, wet = 3036.0 / temp - 1.78, mix * (1.0 + 0.448 * mix)
        value = F.ln(temp) - KAPPA * F.ln(dry) + wet * heat - goal
        # vapour / dry is mix / EPSILON
        rise = mix * (17.67 * 243.5 / EPSILON) / ((temp - 29.65) * (temp - 29.65))
        slope = 1.0 / temp + rise * (KAPPA + EPSILON * press / dry * (1.0 + 0.896 * mix) * heat) - wet * 3036.0 / (temp * temp)
        return value / slope

    def step(at: Column, _) -> Column:
        temp, goal = at["temp"], at["goal"]
        dry = _let(saturation_pressure(temp), lambda v: F.when(press > v, F.struct((press - v).alias("d"), (EPSILON * v / (press - v)).alias("m"))))
        by = _let(dry, lambda s: moved(temp, s["d"], s["m"], goal))
        after = _let(by, lambda d: F.struct((temp - d).alias("temp"), goal.alias("goal"), (F.abs(d) >= SETTLED).alias("on")))
        # a step without a solution leaves no flag and no temperature, and ends the steps too
        return F.when(at["on"], after).otherwise(at)

    first = F.struct(start.alias("temp"), (goal - KAPPA * math.log(1000.0)).alias("goal"), F.lit(True).alias("on"))
    known = goal.isNotNull() & start.isNotNull()
    return F.when(known, F.aggregate(F.array_repeat(F.lit(0), LIFT_STEPS), first, step, lambda at: at["temp"]))


def celsius(temp_k: Column) -> Column:
    return temp_k - ZERO_C
