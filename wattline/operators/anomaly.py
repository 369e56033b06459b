"""Per-meter modified z-scores, flags, streaks and their summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.config import AnomalySettings
from wattline.functions.groups import LongGroups, find_long_groups, join_groups
from wattline.functions.quantiles import group_quantiles
from wattline.functions.sequence import add_run_length
from wattline.schemas import KEYS
from wattline.session import materialize

# 0.6745 makes the MAD comparable to a standard deviation,
# 1.4826 is the factor put on the standard deviation when the MAD is zero.
MAD_FACTOR = 0.6745
STD_FACTOR = 1.4826
FALLBACKS = ("median", "mean", "zero")


def _score(value: Column, median: Column, mad: Column, spread: Column) -> Column:
    scale = F.when(mad > 0, mad).otherwise(spread * STD_FACTOR)
    return (
        F.when(value.isNull(), F.lit(None).cast("double"))
        .when(scale > 0, MAD_FACTOR * (value - median) / F.nullif(scale, F.lit(0.0)))
        .otherwise(0.0)
    )


def _spread(value: Column, median: Column, fallback: str, agg: Callable[[Column], Column]) -> Column:
    """Population standard deviation about the median or the mean."""
    if fallback == "median":
        return F.sqrt(agg(F.avg((value - median) * (value - median))))
    if fallback == "mean":
        return agg(F.stddev_pop(value))
    if fallback == "zero":
        return F.lit(0.0)
    raise ValueError(f"fallback must be one of {FALLBACKS}")


def modified_zscore(
    df: DataFrame, value: str = "residual", out: str = "anomaly_score", fallback: str = "median",
    keys: Sequence[str] = KEYS, min_rows: int = 0, long: LongGroups | None = None,
) -> DataFrame:
    """Distance from the group's median in units of its median absolute deviation.

    Groups that fit a task are scored by windows over one shuffle, and the rows
    are computed once. With longer groups the statistics come from counting
    (see ``group_quantiles``) and are joined back.
    """
    keys = list(keys)
    if long is None:
        long = find_long_groups(df, keys)
    v = F.col(value).cast("double")
    if not long and keys:
        group = Window.partitionBy(*keys)

        def over(agg: Column) -> Column:
            return agg.over(group)

        rows = df.withColumns({"_median": over(F.percentile(v, F.lit(0.5))), "_n": over(F.count(v))})
        rows = rows.withColumns({
            "_mad": over(F.percentile(F.abs(v - F.col("_median")), F.lit(0.5))),
            "_spread": _spread(v, F.col("_median"), fallback, over),
        })
    else:
        rows = _joined_statistics(materialize(df), value, fallback, keys, long)
    score = _score(v, F.col("_median"), F.col("_mad"), F.col("_spread"))
    if min_rows:
        score = F.when(v.isNotNull() & (F.col("_n") < min_rows), 0.0).otherwise(score)
    return rows.withColumn(out, score).drop("_median", "_n", "_mad", "_spread")


def _joined_statistics(
    df: DataFrame, value: str, fallback: str, keys: list[str], long: LongGroups
) -> DataFrame:
    v = F.col(value).cast("double")

    def attach(rows: DataFrame, table: DataFrame) -> DataFrame:
        if keys:
            return join_groups(rows, table, keys, "left")
        return rows.withColumns({c: table.select(c).scalar() for c in table.columns})

    rows = attach(df, materialize(group_quantiles(df, value, {"_median": 0.5}, keys, long)))
    deviations = rows.select(*keys, F.abs(v - F.col("_median")).alias("_dev"))
    mads = group_quantiles(deviations, "_dev", {"_mad": 0.5}, keys, long)
    others = rows.groupBy(*keys).agg(
        F.count(v).alias("_n"), _spread(v, F.col("_median"), fallback, lambda agg: agg).alias("_spread"))
    return attach(attach(rows, materialize(mads)), materialize(others))


def flag(df: DataFrame, threshold: float, score: str = "anomaly_score", out: str = "is_anomaly") -> DataFrame:
    return df.withColumn(out, F.coalesce((F.abs(score) > threshold).cast("int"), F.lit(0)))


def detect_anomalies(
    df: DataFrame, residual: str = "residual", cfg: AnomalySettings = AnomalySettings(),
    scorer: Callable[..., DataFrame] = modified_zscore, long: LongGroups | None = None,
) -> DataFrame:
    """Score, flag and measure streaks. ``scorer`` may be replaced by another one."""
    if long is None:
        long = find_long_groups(df)
    scored = scorer(df, value=residual, out="anomaly_score", fallback=cfg.fallback, min_rows=cfg.min_rows, long=long)
    return add_run_length(flag(scored, cfg.threshold), "is_anomaly", "anomaly_streak", long=long)


def summarize_meters(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEYS).agg(
        F.count("is_anomaly").alias("total_hours"),
        F.sum("is_anomaly").alias("anomaly_hours"),
        F.avg("anomaly_score").alias("mean_anomaly_score"),
        F.max(F.abs("anomaly_score")).alias("max_anomaly_score"),
        F.avg("residual").alias("mean_residual"),
        F.sum(F.greatest(F.col("residual"), F.lit(0.0))).alias("total_excess"),
        F.max("anomaly_streak").alias("max_streak"),
    ).withColumn("anomaly_rate", F.col("anomaly_hours") / F.nullif(F.col("total_hours"), F.lit(0)))


def anomaly_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("is_anomaly").alias("anomalies_flagged"),
        F.round(100 * F.avg("is_anomaly"), 2).alias("anomaly_rate_pct"),
    )


def severity_by_site(df: DataFrame) -> DataFrame:
    severity = F.abs("anomaly_score")
    return df.where(F.col("is_anomaly") == 1).groupBy("site_id").agg(
        F.count(F.lit(1)).alias("n_anomalies"),
        F.avg(severity).alias("mean_severity"),
        F.sum(severity).alias("cumulative_severity"),
    ).orderBy("site_id")
