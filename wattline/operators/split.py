"""Time split, baselines and regression metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.joins import lookup_with_default
from wattline.schemas import KEYS, ORDER, TARGET


def cutoff(df: DataFrame, holdout: str, order: str = ORDER) -> Column:
    """Latest time minus the hold-out, as a scalar subquery: nothing is collected."""
    return df.agg((F.max(order) - F.expr(holdout)).alias("cutoff")).scalar()


def time_split(
    df: DataFrame, holdout: str = "INTERVAL 3 MONTHS", order: str = ORDER, check: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff and rows from it on."""
    border = cutoff(df, holdout, order)
    train, held_out = df.where(F.col(order) < border), df.where(F.col(order) >= border)
    if check and train.isEmpty():
        first, last = df.agg(F.min(order), F.max(order)).first()
        raise ValueError(
            f"no training rows: the data run from {first} to {last} and a hold-out of {holdout} takes all of them")
    return train, held_out


def predict_group_mean(train: DataFrame, held_out: DataFrame, target: str = TARGET, out: str = "predicted") -> DataFrame:
    """The meter's mean reading, for unseen meters the overall one.

    The overall mean comes from the per-meter sums, not from a second scan.
    """
    sums = train.groupBy(*KEYS).agg(F.sum(F.col(target).cast("double")).alias("s"), F.count(target).alias("n"))
    overall = sums.agg(F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).scalar()
    means = sums.withColumn("mean", F.col("s") / F.nullif(F.col("n"), F.lit(0)))
    return lookup_with_default(held_out, means, KEYS, "mean", overall, out)


def predict_persistence(
    train: DataFrame, held_out: DataFrame, target: str = TARGET, out: str = "predicted", fill: str = "train_mean"
) -> DataFrame:
    """The reading a day earlier.

    ``fill='val_mean'`` fills gaps with the mean of the rows being predicted,
    as published; the default does not look at them.
    """
    source = held_out if fill == "val_mean" and "lag_24h" in held_out.columns else train
    mean = source.agg(F.avg(F.col(target).cast("double"))).scalar()
    known = F.col("lag_24h") if "lag_24h" in held_out.columns else F.lit(None).cast("double")
    return held_out.withColumn(out, F.coalesce(known, mean))


def with_residual(df: DataFrame, predicted: str = "predicted", target: str = TARGET, out: str = "residual") -> DataFrame:
    return df.withColumn(out, F.col(target) - F.col(predicted))


def regression_metrics(df: DataFrame, predicted: str = "predicted", target: str = TARGET) -> DataFrame:
    """One pass over the predictions: rmse, mae, cv_rmse, mean_actual."""
    error = F.col(target) - F.col(predicted)
    return df.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(target).alias("mean_actual"),
    ).select(
        "rmse", "mae",
        F.when(F.col("mean_actual") > 0, F.col("rmse") / F.nullif(F.col("mean_actual"), F.lit(0.0)))
        .otherwise(F.lit(float("inf"))).alias("cv_rmse"),
        "mean_actual",
    )


def improvement_pct(model: Column, baseline: Column) -> Column:
    return (1 - model / F.nullif(baseline, F.lit(0.0))) * 100
