"""The prioritised audit list."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.config import AuditSettings
from wattline.functions.scalar import ratio
from wattline.functions.ranking import ordinal_rank
from wattline.operators.joins import join_buildings
from wattline.session import materialize

# The columns of the list, in order.
AUDIT_COLUMNS = [
    "rank", "building_id", "meter", "site_id", "primary_use", "square_feet", "anomaly_rate",
    "anomaly_hours", "total_hours", "max_streak", "mean_anomaly_score", "max_anomaly_score",
    "total_excess", "excess_per_sqft", "priority_score",
]


def build_audit_list(
    summary: DataFrame, buildings: DataFrame, cfg: AuditSettings = AuditSettings(), top_n: int | None = None
) -> DataFrame:
    """Meters by weighted share of the worst value in each measure; ties by building and meter.

    The candidates (one row per meter) are stored once, because the column
    maxima and the ranking both read them.
    """
    rows = join_buildings(
        summary.where(F.col("total_hours") >= cfg.min_hours), buildings, ["site_id", "primary_use", "square_feet"])
    has_streak = "max_streak" in summary.columns
    rows = rows.withColumns({
        "excess_per_sqft": F.when(F.col("square_feet") > 0, ratio(F.col("total_excess"), F.col("square_feet")))
        .otherwise(0.0),
        "streak_severity": ratio(F.col("max_streak"), F.col("total_hours")) if has_streak else F.lit(0.0),
    })
    rows = materialize(rows)
    worst = rows.agg(F.struct(*[F.max(c).alias(c) for c in cfg.weights])).scalar()
    rows = rows.withColumn("_worst", worst)
    shares = [
        F.when(F.col("_worst")[c] > 0, F.col(c) / F.nullif(F.col("_worst")[c], F.lit(0.0))).otherwise(0.0) * weight
        for c, weight in cfg.weights.items()
    ]
    rows = rows.withColumn("priority_score", reduce(add, shares))
    order = [F.col("priority_score").desc_nulls_last(), "building_id", "meter"]
    if top_n:
        rows = rows.orderBy(*order).limit(top_n)
    ranked = ordinal_rank(rows, order, "rank")
    return ranked.select(*[c for c in AUDIT_COLUMNS if c in ranked.columns]).orderBy("rank")
