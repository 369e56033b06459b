"""Enrichment joins.

All are left equi-joins without hints: Spark broadcasts a dimension when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles, where adaptive execution splits a building or site that holds too
many rows. Holidays need no join, they are computed from the date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.session import materialize
from wattline.sources.calendar import DEFAULT_COUNTRY, is_holiday, site_country


def join_buildings(df: DataFrame, buildings: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    if columns is not None:
        buildings = buildings.select("building_id", *columns)
    return df.join(buildings, "building_id", "left")


def join_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Exact hour of the site; hours without a record stay missing."""
    return df.join(weather, ["site_id", "timestamp"], "left")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would multiply rows of a left join; empty for a valid dimension."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def lookup_with_default(
    df: DataFrame, table: DataFrame, keys: Sequence[str], column: str, default: Column, out: str
) -> DataFrame:
    found = table.select(*keys, F.col(column).alias("_found"))
    return df.join(found, list(keys), "left").withColumn(out, F.coalesce("_found", default)).drop("_found")


# Rows of a group result that every task may hold.
FEW_GROUPS = 10_000


def join_groups_results(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows to one result per group, for keys of few values.

    The result is counted first: up to ``FEW_GROUPS`` rows go to every task, so
    that the rows stay where they are instead of meeting in one task per key.
    Larger results are joined by shuffling.
    """
    table = materialize(table)
    return df.join(F.broadcast(table) if table.count() <= FEW_GROUPS else table, list(keys), how)


def mark_holidays(df: DataFrame, out: str = "is_holiday", order: str = "timestamp") -> DataFrame:
    """1 on public holidays of the site's country, on US ones without a site."""
    country = site_country(F.col("site_id")) if "site_id" in df.columns else F.lit(DEFAULT_COUNTRY)
    return df.withColumn(out, is_holiday(country, F.to_date(order)).cast("int"))
