"""Cloud base from humidity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ascentframe.operators.profile import smoothed

LOW_TOP_M = 3000.0
LOW_RH = 95.0
HIGH_BOTTOM_M = 4000.0
HIGH_RH = 75.0
LOW_LABEL = "low cloud (RH)"
HIGH_LABEL = "high cloud (Zhang)"
CLEAR_LABEL = "clear"


def local_maximum(value: Column, before: Column, after: Column) -> Column:
    """Strictly above both neighbours; NULL at the ends."""
    return (value > before) & (value > after)


def high_hit(high_rh: float = HIGH_RH) -> Column:
    """Needs neighbour structs of ``rhp`` out to three rows."""
    here = smoothed("rhp")
    peak = local_maximum(here, smoothed("rhp", -1), smoothed("rhp", 1))
    inner = F.col("prev1").isNotNull() & F.col("next1").isNotNull()
    return inner & (F.col("z") > HIGH_BOTTOM_M) & peak & (here >= high_rh)


def cloud_aggregates() -> dict[str, Column]:
    low_hit = (F.col("z") <= LOW_TOP_M) & (F.col("rhp") >= LOW_RH)
    low = F.min_by(F.when(low_hit, F.col("z")), F.when(low_hit, F.col("rn")))
    high = F.min_by(F.when(F.col("high_hit"), F.col("z")), F.when(F.col("high_hit"), F.col("rn")))
    label = F.when(low.isNotNull(), F.lit(LOW_LABEL)).when(high.isNotNull(), F.lit(HIGH_LABEL))
    return {
        "diag_cloud_base_height": F.coalesce(low, high),
        "diag_cloud_base_type": label.otherwise(F.lit(CLEAR_LABEL)),
    }
