"""Cleaning and data quality."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.config import CleaningSettings
from wattline.functions.groups import LongGroups, Series, find_long_groups, join_groups
from wattline.functions.quantiles import group_quantiles
from wattline.functions.sequence import fill_from_neighbours
from wattline.schemas import FEATURES, KEYS, TARGET

_NEIGHBOUR_FILLED = ["air_temperature", "dew_temperature", "wind_speed", "sea_level_pressure"]
_ZERO_FILLED = ["precip_depth_1_hr", "wind_direction"]


def drop_negatives(df: DataFrame, value: str = TARGET) -> DataFrame:
    """Missing readings stay: only a known negative one is an error."""
    return df.where(F.col(value).isNull() | (F.col(value) >= 0))


def convert_units(df: DataFrame, cfg: CleaningSettings = CleaningSettings(), value: str = TARGET) -> DataFrame:
    """One site's electricity meters report kBTU; everything else is in kWh."""
    if "site_id" not in df.columns:
        return df
    affected = (F.col("site_id") == cfg.converted_site) & (F.col("meter") == cfg.converted_meter)
    return df.withColumn(
        value, F.when(affected, F.col(value) * cfg.conversion_factor).otherwise(F.col(value)))


def clean_readings(df: DataFrame, cfg: CleaningSettings = CleaningSettings()) -> DataFrame:
    return convert_units(drop_negatives(df), cfg)


def fill_weather(df: DataFrame) -> DataFrame:
    """Neighbouring hours of the site, the overall median, or zero, by column."""
    neighbours = [c for c in _NEIGHBOUR_FILLED if c in df.columns]
    if neighbours:
        df = fill_from_neighbours(df, neighbours, ["site_id"])
    if "cloud_coverage" in df.columns:
        median = group_quantiles(df.select("cloud_coverage"), "cloud_coverage", {"median": 0.5}, keys=[])
        df = df.withColumn("cloud_coverage", F.coalesce("cloud_coverage", median.scalar()))
    return df.fillna(0.0, subset=[c for c in _ZERO_FILLED if c in df.columns])


def cap_step(df: DataFrame, series: Series, quantile: float, value: str = TARGET) -> DataFrame:
    """Cap inside an existing partitioning; for series that fit one task."""
    cap = F.percentile(F.col(value).cast("double"), F.lit(quantile)).over(series.group())
    return df.withColumn("_cap", cap).withColumn(
        value, F.when(F.col(value) > F.col("_cap"), F.col("_cap")).otherwise(F.col(value))).drop("_cap")


def cap_outliers(
    df: DataFrame, quantile: float = 0.999, value: str = TARGET,
    keys: Sequence[str] = KEYS, long: LongGroups | None = None,
) -> DataFrame:
    """Readings above the group's quantile become that quantile; missing ones stay."""
    if long is None:
        long = find_long_groups(df, keys)
    if not long:
        return cap_step(df, Series(df, list(keys), ""), quantile, value)
    caps = group_quantiles(df, value, {"_cap": quantile}, keys, long)
    return join_groups(df, caps, list(keys), "left").withColumn(
        value, F.when(F.col(value) > F.col("_cap"), F.col("_cap")).otherwise(F.col(value))).drop("_cap")


def drop_incomplete(df: DataFrame, target: str = TARGET, features: Sequence[str] = FEATURES) -> DataFrame:
    """Separate ``IS NOT NULL`` conditions, so that each can be pushed to its table."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in [*features, target] if c in df.columns]))


def quality_report(df: DataFrame, value: str = TARGET) -> DataFrame:
    """Counts, shares and levels per site.

    Two steps keep distinct counts small: first per meter, then per site.
    """
    v = F.col(value)
    meters = df.groupBy("site_id", "building_id", "meter").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(v.isNull()).alias("n_missing"),
        F.count_if(v == 0).alias("n_zero"),
        F.sum(v.cast("double")).alias("total"),
        F.max(v.cast("double")).alias("peak"),
    )
    known = F.sum("n_rows") - F.sum("n_missing")
    return meters.groupBy("site_id").agg(
        F.countDistinct("building_id").alias("n_buildings"),
        F.count(F.lit(1)).alias("n_meters"),
        F.sum("n_rows").alias("n_rows"),
        F.round(100 * F.sum("n_missing") / F.sum("n_rows"), 2).alias("pct_missing"),
        F.round(100 * F.sum("n_zero") / F.sum("n_rows"), 2).alias("pct_zero"),
        F.coalesce(F.round(F.sum("total") / F.nullif(known, F.lit(0)), 2), F.lit(0.0)).alias("mean_reading"),
        F.coalesce(F.round(F.max("peak"), 2), F.lit(0.0)).alias("max_reading"),
    ).orderBy("site_id")
