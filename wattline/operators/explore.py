"""Exploratory summary tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import scalar as S
from wattline.functions.quantiles import group_quantiles
from wattline.operators.joins import join_groups_results
from wattline.schemas import METER_NAMES, TARGET, WEATHER_COLUMNS
from wattline.session import materialize


def _read_often(df: DataFrame, *columns: Column | str) -> DataFrame:
    """The named columns, stored unless ``df`` is a stored table: exact quantiles read them several times."""
    rows = df.select(*columns)
    return rows if hasattr(df, "stored_at") else materialize(rows)


def dataset_summary(df: DataFrame) -> DataFrame:
    """Two steps: one row per meter first, so that the distinct counts stay small."""
    meters = df.groupBy("site_id", "building_id", "meter").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    return meters.agg(
        F.sum("n").alias("total_rows"),
        F.countDistinct("building_id").alias("n_buildings"),
        F.countDistinct("site_id").alias("n_sites"),
        F.countDistinct("building_id", "meter").alias("n_meters"),
        F.min("first").alias("date_range_start"),
        F.max("last").alias("date_range_end"),
    )


def meter_name(code: Column) -> Column:
    pairs = [F.lit(x) for pair in METER_NAMES.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), code.cast("string"))


def buildings_per_meter_type(df: DataFrame) -> DataFrame:
    return df.groupBy("meter").agg(F.countDistinct("building_id").alias("n_buildings")).withColumn(
        "meter_name", meter_name(F.col("meter")))


def buildings_per_use(buildings: DataFrame) -> DataFrame:
    return buildings.where(F.col("primary_use").isNotNull()).groupBy("primary_use").agg(
        F.count(F.lit(1)).alias("n_buildings")).orderBy(F.desc("n_buildings"), "primary_use")


def meter_quantiles(df: DataFrame, value: str = TARGET, quantile: float = 0.99) -> DataFrame:
    """The median and the cap of every meter code at once, for ``meter_distribution`` and ``clipped_histogram``."""
    rows = _read_often(df, "meter", F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    return materialize(group_quantiles(rows, "_v", {"median": 0.5, "_cap": quantile}, ["meter"]))


def meter_distribution(df: DataFrame, value: str = TARGET, quantiles: DataFrame | None = None) -> DataFrame:
    """One row for each known meter code, also for codes without readings; ``quantiles`` may bring the medians."""
    v = F.col(value)
    codes = df.sparkSession.range(len(METER_NAMES)).select(F.col("id").cast("int").alias("meter"))
    known = _read_often(df, "meter", v.cast("double").alias(value)).where(F.col("meter").isin(*METER_NAMES))
    known = known.withColumn("meter", F.col("meter").cast("int"))
    levels = known.groupBy("meter").agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg(v), 2).alias("mean"),
        F.round(F.stddev_samp(v), 2).alias("std"),
        F.round(F.max(v), 2).alias("max"),
        F.round(100 * F.count_if(v == 0) / F.count(F.lit(1)), 2).alias("pct_zero"),
    )
    if quantiles is None:
        medians = group_quantiles(known, value, {"median": 0.5}, ["meter"])
    else:
        medians = quantiles.where(F.col("meter").isin(*METER_NAMES)).select(F.col("meter").cast("int").alias("meter"), "median")
    return (
        codes.join(levels, "meter", "left").join(medians, "meter", "left")
        .select("meter", meter_name(F.col("meter")).alias("meter_name"),
                F.coalesce("count", F.lit(0)).alias("count"), "mean",
                F.round("median", 2).alias("median"), "std", "max", "pct_zero")
    )


def _bins(df: DataFrame, keys: Sequence[str], bins: int, low: Column, high: Column, value: str) -> DataFrame:
    """Counts per equal-width bin; the last bin is closed, rows outside are left out."""
    width = (high - low) / bins
    place = F.floor((F.col(value) - low) / F.nullif(width, F.lit(0.0)))
    bin_no = F.when(F.col(value) == high, F.lit(bins - 1)).otherwise(F.least(place, F.lit(bins - 1)))
    inside = (F.col(value) >= low) & (F.col(value) <= high)
    return df.where(inside).groupBy(*keys, bin_no.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def histogram(
    df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None, clamp: bool = False
) -> DataFrame:
    """Equal-width histogram over fixed borders, or over the data's own range.

    ``clamp`` moves outside values onto the borders instead of leaving them out.
    """
    rows = df.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if clamp:
        rows = rows.withColumn("_v", S.clip(F.col("_v"), low, high))
        low = high = None
    if low is not None and high is not None:
        return _bins(rows, [], bins, F.lit(float(low)), F.lit(float(high)), "_v")
    ends = rows.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high"))).scalar()
    return _bins(rows.withColumn("_ends", ends), [], bins, F.col("_ends")["low"], F.col("_ends")["high"], "_v")


def clipped_histogram(
    df: DataFrame, value: str = TARGET, bins: int = 80, quantile: float = 0.99, keys: Sequence[str] = ("meter",),
    caps: DataFrame | None = None,
) -> DataFrame:
    """Histogram per group, values above the group's quantile counted as the quantile; ``caps`` may bring the quantiles."""
    keys = list(keys)
    rows = _read_often(df, *keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if caps is None:
        caps = group_quantiles(rows, "_v", {"_cap": quantile}, keys)
    rows = join_groups_results(rows, caps, keys).withColumn("_v", F.least("_v", "_cap"))
    ends = rows.groupBy(*keys).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    return _bins(join_groups_results(rows, ends, keys), keys, bins, F.col("_low"), F.col("_high"), "_v")


def time_profiles(df: DataFrame, value: str = TARGET) -> DataFrame:
    """Mean reading by hour, by weekday, by month and by hour and meter, in one pass.

    The readings are first reduced to sums per meter, hour, weekday and month
    (a few thousand rows at most); every profile is built from those.
    """
    ts = F.col("timestamp")
    v = F.col(value).cast("double")
    cells = df.groupBy(
        "meter", F.hour(ts).alias("hour"), F.weekday(ts).alias("weekday"), F.month(ts).alias("month")
    ).agg(F.sum(v).alias("s"), F.count(v).alias("n"))
    profiles = F.array(*[
        F.struct(F.lit(name).alias("profile"), bucket.cast("int").alias("bucket"), meter.cast("int").alias("meter"))
        for name, bucket, meter in (
            ("hour", F.col("hour"), F.lit(None)), ("weekday", F.col("weekday"), F.lit(None)),
            ("month", F.col("month"), F.lit(None)), ("hour_by_meter", F.col("hour"), F.col("meter")))
    ])
    return cells.select("s", "n", F.inline(profiles)).groupBy("profile", "bucket", "meter").agg(
        (F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("mean_reading"))


def profile_extremes(df: DataFrame, value: str = TARGET) -> DataFrame:
    """Hour of the highest and lowest mean (the earlier on ties), weekday to weekend ratio."""
    p = time_profiles(df, value)
    m = F.col("mean_reading")
    hours = F.when(F.col("profile") == "hour", m)
    days = F.col("profile") == "weekday"
    weekend = F.avg(F.when(days & (F.col("bucket") >= 5), m))
    return p.agg(
        F.max_by("bucket", F.when(hours.isNotNull(), F.struct(hours, -F.col("bucket")))).alias("peak_hour"),
        F.min_by("bucket", F.when(hours.isNotNull(), F.struct(hours, F.col("bucket")))).alias("trough_hour"),
        F.round(F.avg(F.when(days & (F.col("bucket") < 5), m))
                / F.greatest(weekend, F.lit(1e-6)), 2).alias("weekday_vs_weekend_ratio"),
    )


def missingness(df: DataFrame, value: str = TARGET) -> DataFrame:
    def share(condition: Column) -> Column:
        return F.round(100 * F.count_if(condition) / F.nullif(F.count(F.lit(1)), F.lit(0)), 2)

    return df.agg(
        *[share(F.col(c).isNull()).alias(f"{c}_missing_pct") for c in WEATHER_COLUMNS if c in df.columns],
        share(F.col(value) == 0).alias("reading_zero_pct"),
        share(F.col(value).isNull()).alias("reading_missing_pct"),
    )


def response_curve(
    df: DataFrame, by: str = "air_temperature", value: str = TARGET, bins: int = 20, min_rows: int = 100
) -> DataFrame:
    """Mean reading per equal-width bin of ``by``, for meters with enough rows.

    Bins are closed on the right; the lowest one also takes the minimum.
    """
    rows = _read_often(df, "meter", F.col(by).alias("_x"), F.col(value).cast("double").alias("_y"))
    rows = rows.where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    ends = rows.groupBy("meter").agg(
        F.min("_x").alias("_low"), F.max("_x").alias("_high"), F.count(F.lit(1)).alias("_rows")
    ).where(F.col("_rows") >= min_rows)
    width = (F.col("_high") - F.col("_low")) / bins
    place = F.ceil((F.col("_x") - F.col("_low")) / F.nullif(width, F.lit(0.0)))
    bin_no = F.greatest(F.least(F.coalesce(place, F.lit(1)), F.lit(bins)), F.lit(1)).cast("int")
    return join_groups_results(rows, ends, ["meter"]).groupBy("meter", bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("_y").alias("mean_reading"),
    )


def correlations(
    df: DataFrame,
    columns: Sequence[str] = (TARGET, "air_temperature", "dew_temperature", "wind_speed"),
    required: Sequence[str] = ("air_temperature", TARGET),
) -> DataFrame:
    """Pearson correlation of every pair, over the rows where both are known.

    All rows count; there is no sampling.
    """
    present = [c for c in columns if c in df.columns]
    known = reduce(and_, [F.col(c).isNotNull() for c in required])
    rows = df.where(known).select(*[F.col(c).cast("double").alias(c) for c in present])
    pairs = list(combinations_with_replacement(present, 2))
    wide = rows.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = [(a, b, i) for i, (a, b) in enumerate(pairs)]
    entries += [(b, a, i) for a, b, i in entries if a != b]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("correlation"))
        for a, b, i in entries
    ])))


def site_comparison(df: DataFrame, value: str = TARGET) -> DataFrame:
    v = F.col(value)
    df = _read_often(df, "site_id", "building_id", v.cast("double").alias(value))
    per_building = df.groupBy("site_id", "building_id").agg(F.sum(v).alias("s"), F.count(v).alias("n"))
    levels = per_building.groupBy("site_id").agg(
        F.count("building_id").alias("n_buildings"),
        F.sum("n").alias("n_rows"),
        (F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("mean_reading"),
    )
    medians = group_quantiles(df, value, {"median_reading": 0.5}, ["site_id"])
    return levels.join(medians, "site_id", "left").orderBy("site_id")


def site_leaders(sites: DataFrame) -> DataFrame:
    """Sites with the highest mean and with most buildings; the lower id on ties."""
    return sites.agg(
        F.max_by("site_id", F.struct("mean_reading", -F.col("site_id"))).alias("highest_consumption_site"),
        F.max_by("site_id", F.struct("n_buildings", -F.col("site_id"))).alias("most_buildings_site"),
    )


def prediction_sample(df: DataFrame, n: int = 5000, target: str = TARGET, predicted: str = "predicted") -> DataFrame:
    """A repeatable sample for the actual-versus-predicted chart: the n rows hashed lowest."""
    rows = df.select("building_id", "meter", "timestamp", target, predicted)
    key = F.md5(F.concat_ws("|", "building_id", "meter", F.col("timestamp").cast("string")))
    return rows.orderBy(key, "building_id", "meter", "timestamp").limit(n)


def residual_summary(df: DataFrame, residual: str = "residual") -> DataFrame:
    """What the residual histogram's caption says."""
    return df.agg(F.count(residual).alias("n"), F.avg(residual).alias("mean_residual"))


def rate_by_meter_type(df: DataFrame) -> DataFrame:
    return df.groupBy("meter").agg((100 * F.avg("is_anomaly")).alias("anomaly_rate_pct"))


def score_tail(df: DataFrame, score: str = "anomaly_score", threshold: float = 3.5, limit: float = 12.0) -> DataFrame:
    a = F.abs(score)
    return df.agg(
        F.count(score).alias("n_scored"),
        F.count_if(a > threshold).alias("n_flagged"),
        F.count_if(a > limit).alias("n_beyond"),
    )

