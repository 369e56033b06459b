"""Model features. Nothing here looks at the current or a later reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.config import CleaningSettings, FeatureSettings
from wattline.functions import scalar as S
from wattline.functions.groups import LongGroups, as_series, find_long_groups
from wattline.functions.rolling import STATISTICS
from wattline.functions.sequence import lag_step, null_zero_runs_step, rolling_step
from wattline.operators.cleaning import cap_outliers, cap_step
from wattline.operators.joins import mark_holidays
from wattline.schemas import FEATURES, KEYS


def add_time_features(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    df = mark_holidays(df).withColumns({
        "hour": F.hour(ts),
        "dayofweek": S.day_of_week(ts),
        "month": F.month(ts),
        "is_weekend": S.is_weekend(ts),
        "day_of_year": F.dayofyear(ts),
    })
    hour_sin, hour_cos = S.cycle(F.col("hour"), 24)
    month_sin, month_cos = S.cycle(F.col("month"), 12)
    return df.withColumns({
        "hour_sin": hour_sin, "hour_cos": hour_cos, "month_sin": month_sin, "month_cos": month_cos})


def with_use_codes(buildings: DataFrame) -> DataFrame:
    """Number the uses alphabetically from 0; a missing use is -1.

    The ranking runs over the distinct uses only.
    """
    codes = (
        buildings.select("primary_use").where(F.col("primary_use").isNotNull()).distinct()
        .withColumn("primary_use_code", F.row_number().over(Window.orderBy("primary_use")) - 1)
    )
    return buildings.join(codes, "primary_use", "left").withColumn(
        "primary_use_code", F.coalesce("primary_use_code", F.lit(-1)))


def add_building_features(df: DataFrame) -> DataFrame:
    """Use codes, unless the joined building table already carried them."""
    if "primary_use" not in df.columns or "primary_use_code" in df.columns:
        return df
    return with_use_codes(df)


def add_weather_features(df: DataFrame) -> DataFrame:
    if "air_temperature" not in df.columns:
        return df
    air, dew = F.col("air_temperature"), F.col("dew_temperature")
    df = df.withColumns({
        "temp_diff": air - dew,
        "relative_humidity": S.relative_humidity(air, dew),
        "temp_squared": air * air,
    })
    if "wind_speed" in df.columns:
        df = df.withColumn("wind_chill", S.wind_chill(air, F.col("wind_speed")))
    return df


def add_interaction_features(df: DataFrame) -> DataFrame:
    def c(name: str):
        return F.col(name)

    products = {
        "hour_weekend": ("hour", "is_weekend"),
        "temp_x_hour": ("air_temperature", "hour"),
        "sqft_x_temp": ("log_square_feet", "air_temperature"),
    }
    df = df.withColumns({
        out: c(a) * c(b) for out, (a, b) in products.items() if a in df.columns and b in df.columns})
    if "rolling_mean_24h" in df.columns and "lag_24h" in df.columns:
        df = df.withColumn("reading_vs_rolling", S.clip(S.ratio(c("lag_24h"), c("rolling_mean_24h")), -10, 10))
    return df


def narrow_floats(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("float") for name, kind in df.dtypes if kind == "double"})


def add_sequence_features(
    df: DataFrame, cfg: FeatureSettings = FeatureSettings(),
    cleaning: CleaningSettings | None = None, long: LongGroups | None = None,
    statistics: Sequence[str] = STATISTICS,
) -> DataFrame:
    """Lags and rolling statistics, and with ``cleaning`` the caps and outages before them.

    Everything here wants the rows of a meter together and in order, so it
    shares one shuffle. Call it on narrow rows and join the dimensions later.
    """
    if long is None:
        long = find_long_groups(df)
    reach = max(*cfg.lags, *cfg.windows)
    if cleaning and long:
        df = cap_outliers(df, cleaning.cap_quantile, long=long)
    if cleaning:
        reach += cleaning.min_zero_streak
    s = as_series(df, long, KEYS, before=reach, after=cleaning.min_zero_streak if cleaning else 0)
    rows = s.rows
    if cleaning:
        if not long:
            rows = cap_step(rows, s, cleaning.cap_quantile)
        rows = null_zero_runs_step(rows, s, cleaning.min_zero_streak)
    rows = lag_step(rows, s, cfg.lags)
    return s.owned(rolling_step(rows, s, cfg.windows, statistics=statistics))


def add_row_features(df: DataFrame, cfg: FeatureSettings = FeatureSettings()) -> DataFrame:
    """Everything that needs only the row and its dimensions."""
    for step in (add_time_features, add_building_features, add_weather_features, add_interaction_features):
        df = step(df)
    return narrow_floats(df) if cfg.narrow_floats else df


def build_features(
    df: DataFrame, cfg: FeatureSettings = FeatureSettings(), long: LongGroups | None = None
) -> DataFrame:
    return add_row_features(add_sequence_features(df, cfg, long=long), cfg)


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in FEATURES if c in df.columns]


def select_features(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*extra, *[c for c in feature_columns(df) if c not in extra])
