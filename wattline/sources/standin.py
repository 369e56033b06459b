"""Meter-model tables derived from the generic star-schema test tables.

Readings come from ``events`` on a full hourly grid, buildings from
``customer`` and weather from ``events``. Everything is computed by Spark, so
the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.functions.groups import spread_series


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _meter_code() -> Column:
    return F.when(F.col("event_type").isin("click", "view"), 0).otherwise(1)


def _hour() -> Column:
    return F.date_trunc("hour", "ts").cast("timestamp_ntz")


def event_readings(events: DataFrame) -> DataFrame:
    """One raw reading per event, in whole hundredths."""
    return events.select(
        F.col("user_id").alias("building_id"),
        _meter_code().alias("meter"),
        _hour().alias("timestamp"),
        F.round(F.col("value") * 100).cast("long").cast("double").alias("meter_reading"),
    )


def readings(spark: SparkSession, sf_dir: str, buildings: int | None = None) -> DataFrame:
    """Hourly readings per (building, meter); hours without events read 0.

    ``buildings`` folds the users onto that many buildings, which gives dense
    series instead of zero-heavy ones.

    Only hours with events are shuffled: each one is then followed by the empty hours up to the meter's next, made
    where it lies. A building that is missing has a series, but no events of its own.
    """
    raw = event_readings(table(spark, sf_dir, "events"))
    if buildings is not None:
        raw = raw.withColumn("building_id", F.col("building_id") % buildings)
    ends = raw.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
    low, high = (ends.select(c).scalar() for c in ends.columns)
    known = F.col("timestamp").isNotNull() & F.col("building_id").isNotNull()
    hourly = raw.groupBy("building_id", "meter", F.coalesce("timestamp", low).alias("_hour")).agg(
        F.sum(F.when(known, F.col("meter_reading"))).alias("_sum"))
    meters = raw.select("building_id", "meter").distinct().count()
    hours = ends.select(F.timestamp_diff("HOUR", "low", "high")).first()[0] or 0
    series = Window.partitionBy("building_id", "meter").orderBy("_hour")
    hour = F.expr("INTERVAL 1 HOUR")
    spans = spread_series(hourly, meters * (hours + 1)).withColumns({
        "_from": F.when(F.row_number().over(series) == 1, low).otherwise(F.col("_hour")),
        "_to": F.coalesce(F.lead("_hour").over(series) - hour, high),
    })
    return spans.withColumn("timestamp", F.explode(F.sequence("_from", "_to", hour))).select(
        "building_id", "meter", "timestamp",
        F.when(F.col("timestamp") == F.col("_hour"), F.coalesce("_sum", F.lit(0.0))).otherwise(0.0).alias("meter_reading"))


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("building_id"),
        (F.col("c_nationkey") % 16).alias("site_id"),
        F.col("c_mktsegment").alias("primary_use"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 10).alias("square_feet"),
        F.when(F.col("c_custkey") % 7 != 0, 1950 + F.col("c_custkey") % 60).alias("year_built"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    low = F.min(F.col("value").cast("decimal(18,2)")).cast("double")
    high = F.max("value").cast("double")
    first_id = F.min("event_id").cast("long")
    return e.groupBy(
        (F.col("user_id") % 16).cast("int").alias("site_id"), _hour().alias("timestamp")
    ).agg(
        (low / 10 - 5).alias("air_temperature"),
        F.when(first_id % 5 != 0, low / 20 - 6).alias("dew_temperature"),
        F.when(first_id % 3 != 0, high / 50).alias("wind_speed"),
        F.when(first_id % 4 != 0, (first_id % 9).cast("double")).alias("cloud_coverage"),
        F.when(first_id % 2 != 0, (first_id % 7).cast("double")).alias("precip_depth_1_hr"),
        F.when(first_id % 6 != 0, 1000 + (first_id % 31).cast("double")).alias("sea_level_pressure"),
        F.when(first_id % 10 != 0, (first_id % 36).cast("double") * 10).alias("wind_direction"),
    )
