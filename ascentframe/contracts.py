"""Column contracts and fixed dictionaries.

The storage contract of the two wide tables is discovered from the stored
table itself (``operators.schema.contract_of``); the lists below hold only the
columns the jobs here read or write by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: sonde types and their output folder names ---------------
SONDE_TYPES = ("RS92", "RS41", "RS11G", "IMS100")
SONDE_FOLDERS = {"RS92": "RS92", "RS41": "RS41", "RS11G": "RS-11G", "IMS100": "IMS-100"}

# --- fixed values: metadata dialects ----------------------------------------
NEW_DIALECT = "CF-1.7"
OLD_DIALECTS = ("CF-1.4", "RS-11G")
DIALECT_KEYS = {
    # dialect -> (station attribute, timestamp attribute)
    "CF-1.7": ("g.Site.Key", "g.Measurement.StandardTime"),
    "CF-1.4": ("g.General.SiteCode", "g.Ascent.StandardTime"),
    "RS-11G": ("g.General.SiteCode", "g.Ascent.StandardTime"),
}

# --- fixed values: reserved words and their storage-safe spelling -----------
RESERVED_NAMES = {
    "comment": "cmt",
    "references": "refs",
    "group": "grp",
    "user": "usr",
    "default": "def",
}

# --- fixed values: limits -----------------------------------------------------
NOTE_LIMIT = 255
ERROR_LIMIT = 200
FLOAT4_MIN_NORMAL = 1.175494351e-38
MIN_VALID_LEVELS = 10


@dataclass(frozen=True)
class Variable:
    """One observed variable: its code, label and the columns that feed it."""

    code: int
    label: str
    old: str | None
    new: str | None
    unit: int
    random: str | None = None
    systematic_old: str | None = None
    systematic_new: str | None = None
    total_old: str | None = None
    total_new: str | None = None


# --- fixed values: the observed-variable dictionary ---------------------------
VARIABLES = (
    Variable(126, "air_temperature", "temp", "temp", 5,
             "u_std_temp", "u_cor_temp", "temp_uc_tcor", "u_temp", "temp_uc"),
    Variable(138, "relative_humidity", "rh", "rh", 1016,
             "u_std_rh", "u_cor_rh", "rh_uc_tcor", "u_rh", "rh_uc"),
    Variable(106, "wind_from_direction", "wdir", "wdir", 110,
             total_old="u_wdir", total_new="wdir_uc"),
    Variable(107, "wind_speed", "wspeed", "wspeed", 731,
             total_old="u_wspeed", total_new="wspeed_uc"),
    Variable(104, "eastward_wind_speed", "u", "wzon", 731, total_new="wzon_uc"),
    Variable(105, "northward_wind_speed", "v", "wmeri", 731, total_new="wmeri_uc"),
    Variable(123, "water_vapour_mixing_ratio", "wvmr", "wvmr_vol", 788,
             systematic_new="wvmr_vol_uc_tcor", total_new="wvmr_vol_uc"),
    Variable(122, "vertical_speed_of_radiosonde", "asc", "vspeed", 731, total_new="vspeed_uc"),
    Variable(117, "geopotential_height", "geopot", "alt_gph", 1,
             systematic_new="alt_gph_uc_tcor", total_new="alt_gph_uc"),
    Variable(116, "frost_point_temperature", "fp", "fp", 5, total_new="fp_uc"),
    Variable(124, "air_relative_humidity_effective_vertical_resolution", "res_rh", "rh_res", 3),
    Variable(73, "shortwave_radiation", "swrad", None, 811, total_old="u_swrad"),
    Variable(125, "altitude", "alt", "alt", 1, total_old="u_alt", total_new="alt_uc"),
    Variable(142, "pressure", "press", "press", 32, total_old="u_press", total_new="press_uc"),
    Variable(143, "time_since_launch", "time", "time", 3),
)

# --- fixed values: linear unit transforms, column -> (scale, offset) ----------
UNIT_TRANSFORMS = {
    "wvmr_vol": (1e-6, 0.0),
    "wvmr_vol_uc": (1e-6, 0.0),
    "wvmr_vol_uc_tcor": (1e-6, 0.0),
    "press": (100.0, 0.0),
    "u_press": (100.0, 0.0),
    "press_uc": (100.0, 0.0),
}

# --- fixed values: header columns of the export, (old dialect name, new dialect name) ---
HEADER_TEXT = {
    "primary_station_id": ("g_general_sitecode", "g_site_key"),
    "station_name|station_configuration": ("g_general_sitename", "g_site_name"),
    "sensor_id": ("g_product_code", "g_product_key"),
}
HEADER_NUMBERS = {
    "latitude|station_configuration": ("g_measuringsystem_latitude", "g_measurementsystem_latitude"),
    "longitude|station_configuration": ("g_measuringsystem_longitude", "g_measurementsystem_longitude"),
    "height_of_station_above_sea_level": ("g_measuringsystem_altitude", "g_measurementsystem_altitude"),
}

LEVEL_KEYS = ("g_product_id", "observation_id", "report_timestamp", "idstation_pk")


def variable_columns() -> list[str]:
    """Every level column named by the dictionary, once, in dictionary order."""
    seen: dict[str, None] = {}
    for var in VARIABLES:
        for name in (var.old, var.new, var.random, var.systematic_old, var.systematic_new,
                     var.total_old, var.total_new):
            if name:
                seen.setdefault(name)
    return list(seen)


def export_level_columns() -> list[str]:
    """The level columns the monthly export scans (keys, position, variables)."""
    return list(LEVEL_KEYS) + ["lat", "lon"] + variable_columns()


def export_header_columns() -> list[str]:
    pairs = list(HEADER_TEXT.values()) + list(HEADER_NUMBERS.values())
    return ["g_product_id"] + [name for pair in pairs for name in pair]


# --- fixed values: columns of the long table in output order -----------------------
CDM_SCHEMA = T.StructType(
    [
        T.StructField("observed_variable", T.IntegerType()),
        T.StructField("observation_value", T.DoubleType()),
        T.StructField("units", T.IntegerType()),
        T.StructField("z_coordinate", T.DoubleType()),
        T.StructField("z_coordinate_type", T.IntegerType()),
    ]
    + [
        T.StructField(f"uncertainty_{what}{kind}", dtype)
        for kind in (1, 2, 5)
        for what, dtype in (("value", T.DoubleType()), ("type", T.IntegerType()),
                            ("units", T.IntegerType()))
    ]
    + [
        T.StructField("report_timestamp", T.LongType()),
        T.StructField("report_meaning_of_timestamp", T.IntegerType()),
        T.StructField("report_id", T.LongType()),
        T.StructField("report_duration", T.IntegerType()),
        T.StructField("observation_id", T.LongType()),
        T.StructField("primary_station_id", T.StringType()),
        T.StructField("station_name|station_configuration", T.StringType()),
        T.StructField("latitude|station_configuration", T.DoubleType()),
        T.StructField("longitude|station_configuration", T.DoubleType()),
        T.StructField("height_of_station_above_sea_level", T.DoubleType()),
        T.StructField("latitude|observations_table", T.DoubleType()),
        T.StructField("longitude|observations_table", T.DoubleType()),
        T.StructField("record_number", T.IntegerType()),
        T.StructField("sensor_id", T.StringType()),
    ]
)
# --- fixed values: columns that must be filled ---------------------------------
MANDATORY_COLUMNS = (
    "latitude|observations_table",
    "longitude|observations_table",
    "report_duration",
    "report_meaning_of_timestamp",
    "station_name|station_configuration",
)
TILE_DEGREES = 10.0

# --- fixed values: storage sentinels of the encoded long table -----------------
INT64_MISSING = -(2**63)
UINT8_MISSING = 255
UINT16_MISSING = 65535
INT32_MISSING = -(2**31)

# --- fixed values: columns of the stored station and tracking tables -----------
STATION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("elevation", T.FloatType()),
        T.StructField("idstation", T.StringType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("name", T.StringType()),
        T.StructField("network", T.StringType()),
        T.StructField("wmoid", T.IntegerType()),
    ]
)

TRACKING_SCHEMA = T.StructType(
    [
        T.StructField("sonde", T.StringType(), False),
        T.StructField("filename", T.StringType(), False),
        T.StructField("date_of_import", T.TimestampType()),
        T.StructField("note", T.StringType()),
        T.StructField("detail", T.StringType()),
    ]
)

# --- fixed values: storage names of level and header diagnostics ----------------
PROFILE_DIAGNOSTICS = ("td", "theta", "theta_e", "parcel_profile")
SCALAR_DIAGNOSTICS = (
    ["diag_lcl_p", "diag_lcl_t", "diag_lfc_p", "diag_lfc_t", "diag_el_p", "diag_el_t",
     "diag_cape", "diag_cin", "diag_lifted_index", "diag_k_index", "diag_total_totals",
     "diag_showalter", "diag_tropopause_p", "diag_tropopause_t", "diag_pwat",
     "diag_freezing_level_index", "diag_cloud_base_height", "diag_cloud_base_type"]
    + [f"diag_shear_0_{top}km_{axis}" for top in (1, 3, 6) for axis in ("u", "v")]
    + [f"diag_srh_0_3km_{part}" for part in ("pos", "neg", "tot")]
)

SCALAR_TYPES = {"diag_freezing_level_index": "int", "diag_cloud_base_type": "string"}


def scalar_type(name: str) -> str:
    return SCALAR_TYPES.get(name, "double")
