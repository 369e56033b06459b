"""Readers with fixed schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from wattline.functions.groups import find_long_groups
from wattline.functions.scalar import nan_to_null
from wattline.functions.sequence import null_zero_runs
from wattline.operators.cleaning import cap_outliers, clean_readings, fill_weather
from wattline.operators.features import with_use_codes
from wattline.operators.joins import join_buildings, join_weather
from wattline.schemas import BUILDINGS, READINGS, WEATHER
from wattline.session import materialize

# Fixed value: reference year when no building has a construction year.
DEFAULT_REFERENCE_YEAR = 2017


def csv_options(fmt: str) -> dict[str, str]:
    """A value that doesn't fit its column stops the read; headers are checked against the schema."""
    if fmt != "csv":
        return {}
    return {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "enforceSchema": "false", "mode": "FAILFAST"}


def missing_as_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))}
    return df.select(*[nan_to_null(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def read_table(spark: SparkSession, paths: str | Sequence[str], schema: StructType, fmt: str = "csv") -> DataFrame:
    """One table from one or many files; Spark reads them in parallel splits."""
    reader = spark.read.schema(schema).options(**csv_options(fmt)).format(fmt)
    return missing_as_null(reader.load(paths if isinstance(paths, str) else list(paths)))


def read_readings(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv", rows: int | None = None) -> DataFrame:
    df = read_table(spark, paths, READINGS, fmt)
    return first_rows(df, rows) if rows else df


def read_buildings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return describe_buildings(read_table(spark, path, BUILDINGS, fmt))


def read_weather(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return fill_weather(read_table(spark, path, WEATHER, fmt))


def first_rows(df: DataFrame, rows: int, in_one_task: int = 100_000) -> DataFrame:
    """The earliest rows, in a defined order (time, building, meter); a missing time is the earliest.

    Few rows come from one sort. For more, the time that holds the last of them
    is found from the counts per time, and only that time's rows are sorted.
    """
    if rows <= in_one_task:
        return df.orderBy("timestamp", "building_id", "meter").limit(rows)
    border = _time_of_row(df.groupBy("timestamp").agg(F.count(F.lit(1)).alias("n")), rows)
    if border is None:
        return df
    time, left = F.lit(border[0]), rows - border[1]
    at = F.col("timestamp")
    last = df.where(at.eqNullSafe(time)).orderBy("building_id", "meter").limit(left)
    if border[0] is None:
        return last
    return df.where(at.isNull() | (at < time)).unionByName(last)


def _time_of_row(counts: DataFrame, row: int) -> tuple | None:
    """The time at which the ``row``-th row stands, and how many rows come before that time.

    Times may be as many as rows, so they are range-sorted and stored. The sizes of the ranges tell which one holds
    the row, and that one's running counts tell the time; no task sees more than a range.
    """
    ranged = materialize(counts.orderBy("timestamp").withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range of the sort, a number fixed by the shuffle setting
    sizes = ranged.groupBy("part").agg(F.sum("n").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    part = sizes.where((F.col("ahead") < row) & (F.col("ahead") + F.col("n") >= row)).collect()
    if not part:
        return None
    so_far = Window.partitionBy("part").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.where(F.col("part") == part[0]["part"]).withColumn("ahead", F.coalesce(F.sum("n").over(so_far), F.lit(0)) + part[0]["ahead"])
    found = inside.where((F.col("ahead") < row) & (F.col("ahead") + F.col("n") >= row)).first()
    return found["timestamp"], found["ahead"]


def describe_buildings(buildings: DataFrame) -> DataFrame:
    """Age up to the year after the newest building, log area and use code."""
    newest = buildings.agg(F.floor(F.max("year_built")) + 1).scalar()
    df = buildings.withColumns({
        "building_age": F.coalesce(newest, F.lit(DEFAULT_REFERENCE_YEAR)) - F.col("year_built"),
        "log_square_feet": F.log1p("square_feet"),
    })
    return with_use_codes(df) if "primary_use" in df.columns else df


def enrich(readings: DataFrame, buildings: DataFrame, weather: DataFrame) -> DataFrame:
    """Readings with their dimensions, negatives dropped and units converted."""
    return clean_readings(join_weather(join_buildings(readings, buildings), weather))


def load_dataset(
    readings: DataFrame | Sequence[DataFrame], buildings: DataFrame, weather: DataFrame, clean: bool = True
) -> DataFrame:
    """The joined data set from one or several reading tables, optionally capped and outage-free.

    Caps and outages move and sort the readings with their site only; the other columns are joined afterwards.
    """
    tables = [readings] if isinstance(readings, DataFrame) else list(readings)
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    if not clean:
        return enrich(rows, buildings, weather)
    long = find_long_groups(rows)
    narrow = clean_readings(join_buildings(rows, buildings, ["site_id"]))
    narrow = null_zero_runs(cap_outliers(narrow, long=long), long=long)
    rest = [c for c in buildings.columns if c not in ("building_id", "site_id")]
    df = join_weather(join_buildings(narrow, buildings, rest), weather)
    return df.select(enrich(rows, buildings, weather).columns)
