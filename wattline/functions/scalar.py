"""Row-wise expressions. Missing stays missing, in clips and divisions too."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """``greatest`` and ``least`` skip nulls, so a missing value is guarded."""
    clipped = value
    if low is not None:
        clipped = F.greatest(clipped, F.lit(float(low)))
    if high is not None:
        clipped = F.least(clipped, F.lit(float(high)))
    return F.when(value.isNotNull(), clipped)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is missing for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def day_of_week(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """Position on a circle, so that the last hour lies next to the first."""
    angle = value * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def relative_humidity(air: Column, dew: Column) -> Column:
    """Magnus approximation, in percent."""
    def pressure(t: Column) -> Column:
        return F.exp(17.625 * t / (243.04 + t))

    return clip(100 * pressure(dew) / pressure(air), 0, 100)


def wind_chill(air: Column, wind: Column) -> Column:
    """Felt temperature below 10 degrees, the air temperature above."""
    speed = F.pow(clip(wind, low=0.1), F.lit(0.16))
    felt = 13.12 + 0.6215 * air - 11.37 * speed + 0.3965 * air * speed
    return F.when(air < 10, felt).otherwise(air)
