"""Profile and launch queries give the same rows when every group takes the split path."""

import pytest
from test_queries import QUERIES, SF_DIR

from ascentframe.operators.ordered import HOT_ROWS_CONF

NAMES = ["boxcar_smoothing", "cloud_base", "launch_segments", "level_validity", "local_maxima", "odd_sounding_preferences",
         "profile_integral", "profile_reconciliation", "thermal_tropopause", "value_two_days_on", "wind_shear_helicity",
         "sounding_diagnostics", "enriched_levels", "parcel_levels_energy", "standard_level_interpolation",
         "odd_sounding_diagnostics", "station_upsert", "launch_catalogue"]


def rows(df):
    plain = [tuple(round(v, 3) + 0.0 if isinstance(v, float) else v for v in r) for r in df.collect()]
    return sorted(map(repr, plain))


@pytest.mark.parametrize("name", NAMES)
def test_split_path_gives_the_same_rows(spark, name):
    whole = rows(QUERIES[name](spark, SF_DIR))
    spark.conf.set(HOT_ROWS_CONF, "25")
    try:
        split = rows(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert whole == split
