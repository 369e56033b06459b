"""Writers. Results are written by the tasks that hold them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.schemas import KEYS, ORDER, TARGET

PREDICTION_COLUMNS = [*KEYS, ORDER, TARGET, "predicted", "residual"]


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    writer.save(path)
    return path


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Held-out rows with prediction and residual (target minus prediction)."""
    if "residual" not in df.columns:
        df = df.withColumn("residual", F.col(TARGET) - F.col("predicted"))
    return write_table(df.select(*PREDICTION_COLUMNS), path, fmt)


def write_audit_list(audit: DataFrame, path: str, fmt: str = "csv") -> str:
    if fmt not in ("csv", "json"):
        raise ValueError("the audit list is written as csv or json")
    return write_table(audit, path, fmt)


def summary_row(spark: SparkSession, **entries: DataFrame | Column | int | float | str) -> DataFrame:
    """One row of named results; one-row tables become structs."""
    def cell(value):
        if isinstance(value, DataFrame):
            return value.agg(F.first(F.struct(*value.columns))).scalar()
        return value if isinstance(value, Column) else F.lit(value)

    return spark.range(1).select(*[cell(v).alias(name) for name, v in entries.items()])


def write_summary(row: DataFrame, path: str) -> str:
    return write_table(row, path, "json")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
