"""Table schemas and the model's feature list."""

from pyspark.sql import types as T

KEYS = ["building_id", "meter"]
ORDER = "timestamp"
TARGET = "meter_reading"

# Wall-clock hours of the building's site. Without a zone, no session setting
# and no daylight-saving change can shift or merge two hours.
_HOUR = T.TimestampNTZType()


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


READINGS = _table(
    ("building_id", T.LongType()),
    ("meter", T.IntegerType()),
    ("timestamp", _HOUR),
    ("meter_reading", T.FloatType()),
)

BUILDINGS = _table(
    ("site_id", T.IntegerType()),
    ("building_id", T.LongType()),
    ("primary_use", T.StringType()),
    ("square_feet", T.FloatType()),
    ("year_built", T.FloatType()),
    ("floor_count", T.FloatType()),
)

WEATHER = _table(
    ("site_id", T.IntegerType()),
    ("timestamp", _HOUR),
    ("air_temperature", T.FloatType()),
    ("cloud_coverage", T.FloatType()),
    ("dew_temperature", T.FloatType()),
    ("precip_depth_1_hr", T.FloatType()),
    ("sea_level_pressure", T.FloatType()),
    ("wind_direction", T.FloatType()),
    ("wind_speed", T.FloatType()),
)

# Meter codes and their names.
METER_NAMES = {0: "electricity", 1: "chilledwater", 2: "steam", 3: "hotwater"}

WEATHER_COLUMNS = [
    "air_temperature", "dew_temperature", "cloud_coverage", "precip_depth_1_hr",
    "sea_level_pressure", "wind_direction", "wind_speed",
]

# The model inputs, by family, in model order.
FEATURE_FAMILIES = {
    "time": ["hour", "dayofweek", "month", "is_weekend", "is_holiday", "day_of_year",
             "hour_sin", "hour_cos", "month_sin", "month_cos"],
    "lag": ["lag_24h", "lag_168h", "lag_diff_24h"],
    "rolling": [f"rolling_{stat}_{hours}h" for hours in (24, 168) for stat in ("mean", "std", "min", "max")],
    "building": ["log_square_feet", "building_age", "primary_use_code"],
    "weather": ["air_temperature", "dew_temperature", "temp_diff", "relative_humidity",
                "temp_squared", "wind_chill", "cloud_coverage", "wind_speed"],
    "interaction": ["hour_weekend", "temp_x_hour", "sqft_x_temp", "reading_vs_rolling"],
    "id": ["site_id", "meter"],
}
FEATURES = [name for family in FEATURE_FAMILIES.values() for name in family]
