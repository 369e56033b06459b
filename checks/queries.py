"""Every operator as a query over the test tables, with its comparison SQL.

numbers, so sums are exact in any order; other derived values are rounded on
both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sql as Q
from wattline.config import AuditSettings, BoosterSettings, Settings
from wattline.functions.ranking import ordinal_rank
from wattline.functions.sequence import add_lags, add_rolling, add_run_length, fill_from_neighbours, null_zero_runs
from wattline.operators import anomaly, audit, cleaning, explore, features, joins, models, split
from wattline.plans import jobs
from wattline.schemas import FEATURES, KEYS, ORDER, TARGET
from wattline.session import materialize, shared_dir
from wattline.sources import readings as R
from wattline.sources import sinks, standin
from wattline.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Query
    oracle: str | None


CHECKS: dict[str, Check] = {}
SETTINGS = Settings(holdout="INTERVAL 7 DAYS")
# The library's learners with fewer rounds: at 100 rounds a fit takes minutes here.
QUICK = BoosterSettings(rounds=12, patience=4, forest_trees=10)


def check(name: str, oracle: str | None = None):
    def register(run: Query) -> Query:
        CHECKS[name] = Check(run, Q.query(oracle) if oracle else None)
        return run
    return register


def _rd(spark, sf):
    return standin.readings(spark, sf)


def _dense(spark, sf):
    return standin.readings(spark, sf, buildings=8)


def _meta(spark, sf):
    return R.describe_buildings(standin.buildings(spark, sf))


def _wx(spark, sf):
    return cleaning.fill_weather(standin.weather(spark, sf))


def _joined(spark, sf):
    return joins.join_weather(joins.join_buildings(_rd(spark, sf), _meta(spark, sf)), _wx(spark, sf))


def _dataset(spark, sf):
    return R.load_dataset(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf))


def _split(spark, sf):
    return split.time_split(_dense(spark, sf), SETTINGS.holdout, check=False)


def _forecast(spark, sf):
    return split.with_residual(split.predict_group_mean(*_split(spark, sf)))


def _detected(spark, sf):
    return anomaly.detect_anomalies(_forecast(spark, sf))


def _rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    return df.select(*[
        F.round(c, special.get(c, digits)).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/check-{uuid.uuid4().hex}"


_RAW = T.StructType([
    T.StructField("building_id", T.LongType()), T.StructField("meter", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("meter_reading", T.DoubleType()),
])

# --- A: sources and sinks ----------------------------------------------------


@check("a1_read_readings", "SELECT building_id, meter, timestamp, meter_reading FROM ev")
def _(spark, sf):
    path = sinks.write_table(standin.event_readings(standin.table(spark, sf, "events")), _folder(spark))
    return R.read_table(spark, path, _RAW)


@check("a1_read_wide_ids", "SELECT building_id + 40000 AS building_id, meter + 200 AS meter, timestamp, "
       "CAST(CAST(meter_reading AS FLOAT) AS DOUBLE) AS meter_reading FROM ev")
def _(spark, sf):
    rows = standin.event_readings(standin.table(spark, sf, "events")).select(
        (F.col("building_id") + 40000).alias("building_id"), (F.col("meter") + 200).alias("meter"), ORDER, TARGET)
    read = R.read_readings(spark, sinks.write_table(rows, _folder(spark)))
    return read.withColumn(TARGET, F.col(TARGET).cast("double"))


@check("a2_read_buildings_csv", """
SELECT CAST(building_id AS BIGINT) AS building_id, site_id, primary_use, CAST(year_built AS DOUBLE) AS year_built,
       CAST(building_age AS DOUBLE) AS building_age, round(log_square_feet, 3) AS log_square_feet, primary_use_code FROM described""")
def _(spark, sf):
    rows = standin.buildings(spark, sf).withColumn("floor_count", F.lit(None).cast("float"))
    columns = ["site_id", "building_id", "primary_use", "square_feet", "year_built", "floor_count"]
    read = R.read_buildings(spark, sinks.write_table(rows.select(columns), _folder(spark)))
    return read.select(
        "building_id", "site_id", "primary_use", *[F.col(c).cast("double").alias(c) for c in ("year_built", "building_age")],
        F.round("log_square_feet", 3).alias("log_square_feet"), "primary_use_code")


@check("a3_read_weather_csv", """
SELECT site_id, timestamp, round(air_temperature, 3) AS air_temperature, round(sea_level_pressure, 3) AS sea_level_pressure,
       cloud_coverage, precip_depth_1_hr, wind_direction FROM wx_filled""")
def _(spark, sf):
    columns = ["site_id", ORDER, "air_temperature", "cloud_coverage", "dew_temperature", "precip_depth_1_hr",
               "sea_level_pressure", "wind_direction", "wind_speed"]
    read = R.read_weather(spark, sinks.write_table(standin.weather(spark, sf).select(columns), _folder(spark)))
    exact = ("cloud_coverage", "precip_depth_1_hr", "wind_direction")
    return read.select("site_id", ORDER, *[F.round(F.col(c).cast("double"), 3).alias(c) for c in ("air_temperature", "sea_level_pressure")],
                       *[F.col(c).cast("double").alias(c) for c in exact])


@check("a2_read_buildings", """
SELECT building_id, site_id, primary_use, round(square_feet, 6) AS square_feet, year_built, building_age,
       round(log_square_feet, 6) AS log_square_feet, primary_use_code FROM described""")
def _(spark, sf):
    return _rounded(_meta(spark, sf))


_WX = ("site_id, timestamp, round(air_temperature, 6) AS air_temperature, round(dew_temperature, 6) AS dew_temperature, "
       "round(wind_speed, 6) AS wind_speed, cloud_coverage, precip_depth_1_hr, sea_level_pressure, wind_direction")


@check("a3_read_weather", f"SELECT {_WX} FROM wx")
def _(spark, sf):
    path = sinks.write_table(standin.weather(spark, sf), _folder(spark))
    schema = T.StructType([T.StructField("site_id", T.IntegerType()), T.StructField("timestamp", T.TimestampNTZType())]
                          + [T.StructField(c, T.DoubleType()) for c in standin.weather(spark, sf).columns[2:]])
    return _rounded(R.read_table(spark, path, schema))


@check("a4_row_limited_read", """
SELECT building_id, meter, timestamp, meter_reading FROM rd ORDER BY timestamp, building_id, meter LIMIT 5000""")
def _(spark, sf):
    return R.first_rows(_rd(spark, sf), 5000)


@check("a6_multi_file_read", "SELECT building_id, meter, timestamp, meter_reading FROM ev")
def _(spark, sf):
    rows, folder = standin.event_readings(standin.table(spark, sf, "events")), _folder(spark)
    paths = [sinks.write_table(rows.where(F.col("meter") == m), f"{folder}/{m}") for m in (0, 1)]
    return R.read_table(spark, paths, _RAW)


_CLEANED = """
SELECT building_id, meter, timestamp, round(meter_reading, 6) AS meter_reading, site_id, primary_use,
       round(air_temperature, 6) AS air_temperature, cloud_coverage FROM cleaned"""


@check("a7_union_of_chunks", _CLEANED)
def _(spark, sf):
    rows = _rd(spark, sf)
    df = R.load_dataset([rows.where(F.col("meter") == m) for m in (0, 1)], _meta(spark, sf), _wx(spark, sf), clean=False)
    return _rounded(df.select(*KEYS, ORDER, TARGET, "site_id", "primary_use", "air_temperature", "cloud_coverage"))


@check("a8_write_predictions", """
SELECT building_id, meter, timestamp, meter_reading, round(predicted, 6) AS predicted, round(residual, 6) AS residual
FROM residuals""")
def _(spark, sf):
    path = sinks.write_predictions(_forecast(spark, sf), _folder(spark))
    schema = T.StructType([*_RAW.fields, T.StructField("predicted", T.DoubleType()), T.StructField("residual", T.DoubleType())])
    return _rounded(R.read_table(spark, path, schema))


def _audit_columns(df):
    return _rounded(df, total_excess=3)


@check("a9_write_audit_list", Q.audit("audit_rows"))
def _(spark, sf):
    rows = audit.build_audit_list(anomaly.summarize_meters(_detected(spark, sf)), _meta(spark, sf))
    path = sinks.write_audit_list(rows, _folder(spark), "json")
    return _audit_columns(R.read_table(spark, path, rows.schema, "json"))


@check("a10_write_quality_report", """
SELECT site_id, count(DISTINCT building_id) AS n_buildings, count(DISTINCT (building_id, meter)) AS n_meters,
       count(*) AS n_rows, round(100.0 * count(*) FILTER (meter_reading IS NULL) / count(*), 2) AS pct_missing,
       round(100.0 * count(*) FILTER (meter_reading = 0) / count(*), 2) AS pct_zero,
       COALESCE(round(avg(meter_reading), 2), 0) AS mean_reading, COALESCE(round(max(meter_reading), 2), 0) AS max_reading
FROM (SELECT r.*, m.site_id FROM rd_null r LEFT JOIN meta m USING (building_id)) GROUP BY 1""")
def _(spark, sf):
    df = joins.join_buildings(null_zero_runs(_rd(spark, sf)), _meta(spark, sf), ["site_id"])
    report = cleaning.quality_report(df)
    return R.read_table(spark, sinks.write_table(report, _folder(spark)), report.schema)


@check("a11_write_summary", """
SELECT (SELECT count(*) FROM rd_dense) AS rows, round(sqrt(avg(residual * residual)), 6) AS rmse,
       round(avg(abs(residual)), 6) AS mae FROM residuals""")
def _(spark, sf):
    row = sinks.summary_row(
        spark, rows=_dense(spark, sf).agg(F.count(F.lit(1)).alias("n")),
        model=split.regression_metrics(_forecast(spark, sf)))
    path = sinks.write_summary(row, _folder(spark))
    back = R.read_table(spark, path, row.schema, "json")
    return back.select(F.col("rows.n").alias("rows"), F.round("model.rmse", 6).alias("rmse"), F.round("model.mae", 6).alias("mae"))


# --- B: cleaning -------------------------------------------------------------


@check("b1_drop_negatives", """
SELECT building_id, meter, timestamp, meter_reading - 5000 AS meter_reading FROM rd_null
WHERE meter_reading IS NULL OR meter_reading >= 5000""")
def _(spark, sf):
    rows = null_zero_runs(_rd(spark, sf)).withColumn(TARGET, F.col(TARGET) - 5000)
    return cleaning.drop_negatives(rows).select(*KEYS, ORDER, TARGET)


@check("b2_convert_units", """
SELECT building_id, meter, timestamp, site_id,
       round(CASE WHEN site_id = 0 AND meter = 0 THEN meter_reading * 0.293071 ELSE meter_reading END, 6) AS meter_reading
FROM rd LEFT JOIN meta USING (building_id)""")
def _(spark, sf):
    rows = joins.join_buildings(_rd(spark, sf), _meta(spark, sf), ["site_id"])
    return _rounded(cleaning.convert_units(rows))


@check("b3_fill_neighbours", """
SELECT site_id, timestamp, round(air_temperature, 6) AS air_temperature, round(dew_temperature, 6) AS dew_temperature,
       round(wind_speed, 6) AS wind_speed, sea_level_pressure FROM wx_filled""")
def _(spark, sf):
    columns = ["air_temperature", "dew_temperature", "wind_speed", "sea_level_pressure"]
    filled = fill_from_neighbours(standin.weather(spark, sf), columns, ["site_id"])
    return _rounded(filled.select("site_id", ORDER, *columns))


@check("b4_fill_constants", "SELECT site_id, timestamp, cloud_coverage, precip_depth_1_hr, wind_direction FROM wx_filled")
def _(spark, sf):
    return _wx(spark, sf).select("site_id", ORDER, "cloud_coverage", "precip_depth_1_hr", "wind_direction")


@check("b5_cap_outliers", f"""
SELECT building_id, meter, timestamp, round(meter_reading, 6) AS meter_reading FROM ({Q.capped("rd")})""")
def _(spark, sf):
    return _rounded(cleaning.cap_outliers(_rd(spark, sf)))


@check("b6_null_zero_runs", "SELECT building_id, meter, timestamp, meter_reading FROM rd_null")
def _(spark, sf):
    return null_zero_runs(_rd(spark, sf)).select(*KEYS, ORDER, TARGET)


_FEATURE_ROWS = f"""
SELECT r.*, lag_24h - lag_168h AS lag_diff_24h FROM (
  SELECT x.*, lag(meter_reading, 24) OVER w AS lag_24h, lag(meter_reading, 168) OVER w AS lag_168h
  FROM ({Q.rolled("dataset")}) x WINDOW w AS ({Q.W})) r"""


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in (
    "meter_reading", "lag_24h", "lag_168h", "rolling_mean_24h", "rolling_std_24h", "rolling_mean_168h", "rolling_std_168h",
    "log_square_feet", "building_age", "site_id", "air_temperature", "dew_temperature", "wind_speed", "cloud_coverage"))


Q.run_tables(f"SELECT building_id, meter, timestamp, meter_reading, lag_24h, site_id FROM ({_FEATURE_ROWS}) f "
             f"WHERE {_COMPLETE} AND rolling_mean_24h <> 0")


@check("b7_drop_incomplete", "SELECT building_id, meter, timestamp, round(meter_reading, 6) AS meter_reading FROM run_rows")
def _(spark, sf):
    rows = jobs.feature_table(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf), SETTINGS)
    return _rounded(cleaning.drop_incomplete(rows).select(*KEYS, ORDER, TARGET))


_QUALITY = """
SELECT site_id, count(DISTINCT building_id) AS n_buildings, count(DISTINCT (building_id, meter)) AS n_meters,
       count(*) AS n_rows, round(100.0 * count(*) FILTER (meter_reading IS NULL) / count(*), 2) AS pct_missing,
       round(100.0 * count(*) FILTER (meter_reading = 0) / count(*), 2) AS pct_zero,
       COALESCE(round(avg(meter_reading), 2), 0) AS mean_reading, COALESCE(round(max(meter_reading), 2), 0) AS max_reading
FROM dataset GROUP BY 1"""


@check("b8_quality_report", _QUALITY)
def _(spark, sf):
    return cleaning.quality_report(_dataset(spark, sf))


# --- C: joins ----------------------------------------------------------------


@check("c1_join_buildings", """
SELECT r.*, m.site_id, m.primary_use, m.year_built FROM rd r LEFT JOIN meta m USING (building_id)""")
def _(spark, sf):
    return joins.join_buildings(_rd(spark, sf), _meta(spark, sf), ["site_id", "primary_use", "year_built"])


@check("c2_join_weather", f"""
SELECT r.building_id, r.meter, r.timestamp, r.meter_reading, r.site_id, round(w.air_temperature, 6) AS air_temperature,
       round(w.dew_temperature, 6) AS dew_temperature, round(w.wind_speed, 6) AS wind_speed, w.cloud_coverage
FROM (SELECT r.*, m.site_id FROM rd r LEFT JOIN meta m USING (building_id)) r
LEFT JOIN wx w ON w.site_id = r.site_id AND w.timestamp = r.timestamp""")
def _(spark, sf):
    rows = joins.join_buildings(_rd(spark, sf), _meta(spark, sf), ["site_id"])
    weather = standin.weather(spark, sf).drop("precip_depth_1_hr", "sea_level_pressure", "wind_direction")
    return _rounded(joins.join_weather(rows, weather))


@check("c3_join_summary", """
SELECT s.building_id, s.meter, s.total_hours, m.site_id, m.primary_use, round(m.square_feet, 6) AS square_feet
FROM (SELECT building_id, meter, count(*) AS total_hours FROM rd GROUP BY 1, 2) s LEFT JOIN meta m USING (building_id)""")
def _(spark, sf):
    summary = _rd(spark, sf).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("total_hours"))
    return _rounded(joins.join_buildings(summary, _meta(spark, sf), ["site_id", "primary_use", "square_feet"]))


@check("c4_lookup_with_default", """
SELECT r.*, COALESCE(m.mean, (SELECT avg(meter_reading) FROM rd)) AS level
FROM rd r LEFT JOIN (SELECT building_id, meter, avg(meter_reading) AS mean FROM rd
                     WHERE building_id % 2 = 0 GROUP BY 1, 2) m USING (building_id, meter)""")
def _(spark, sf):
    rows = _rd(spark, sf)
    means = rows.where(F.col("building_id") % 2 == 0).groupBy(*KEYS).agg(F.avg(TARGET).alias("mean"))
    return joins.lookup_with_default(rows, means, KEYS, "mean", rows.agg(F.avg(TARGET)).scalar(), "level")


@check("c5_holidays_of_readings", f"""
SELECT r.building_id, r.meter, r.timestamp, r.site_id, CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday
FROM (SELECT r.*, m.site_id FROM rd r LEFT JOIN meta m USING (building_id)) r
LEFT JOIN holidays h ON h.country = {Q.COUNTRY.format(site="r.site_id")} AND h.date = CAST(r.timestamp AS DATE)""")
def _(spark, sf):
    rows = joins.join_buildings(_rd(spark, sf), _meta(spark, sf), ["site_id"]).drop(TARGET)
    return joins.mark_holidays(rows).select(*KEYS, ORDER, "site_id", "is_holiday")


@check("c5_holidays_over_years", f"""
SELECT l.site_id, CAST(l.ship_date AS VARCHAR) AS ship_date, CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday, count(*) AS n
FROM (SELECT l_suppkey % 16 AS site_id, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem) l
LEFT JOIN holidays h ON h.country = {Q.COUNTRY.format(site="l.site_id")} AND h.date = l.ship_date GROUP BY 1, 2, 3""")
def _(spark, sf):
    rows = standin.table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 16).alias("site_id"), F.to_date("l_shipdate").alias("ship_date"))
    marked = joins.mark_holidays(rows, order="ship_date")
    return marked.groupBy("site_id", F.col("ship_date").cast("string").alias("ship_date"), "is_holiday").agg(
        F.count(F.lit(1)).alias("n"))


@check("c6_group_statistic_to_rows", """
SELECT *, meter_reading - avg(meter_reading) OVER (PARTITION BY building_id, meter) AS above_mean FROM rd""")
def _(spark, sf):
    rows = _rd(spark, sf)
    means = rows.groupBy(*KEYS).agg(F.avg(TARGET).alias("mean"))
    return rows.join(means, KEYS, "left").withColumn("above_mean", F.col(TARGET) - F.col("mean")).drop("mean")


# --- D: row features ---------------------------------------------------------


@check("d1_d2_date_parts", """
SELECT building_id, meter, timestamp, CAST(hour(timestamp) AS INTEGER) AS hour,
       CAST(isodow(timestamp) - 1 AS INTEGER) AS dayofweek, CAST(month(timestamp) AS INTEGER) AS month,
       CAST(dayofyear(timestamp) AS INTEGER) AS day_of_year, CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM rd""")
def _(spark, sf):
    return features.add_time_features(_rd(spark, sf)).select(
        *KEYS, ORDER, "hour", "dayofweek", "month", "day_of_year", "is_weekend")


@check("d3_holiday_without_site", """
SELECT r.building_id, r.meter, r.timestamp, CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday
FROM rd r LEFT JOIN holidays h ON h.country = 'US' AND h.date = CAST(r.timestamp AS DATE)""")
def _(spark, sf):
    return joins.mark_holidays(_rd(spark, sf)).drop(TARGET)


@check("d4_cycles", """
SELECT building_id, meter, timestamp, round(sin(2 * pi() * hour(timestamp) / 24), 6) + 0.0 AS hour_sin,
       round(cos(2 * pi() * hour(timestamp) / 24), 6) + 0.0 AS hour_cos,
       round(sin(2 * pi() * month(timestamp) / 12), 6) + 0.0 AS month_sin,
       round(cos(2 * pi() * month(timestamp) / 12), 6) + 0.0 AS month_cos FROM rd""")
def _(spark, sf):
    return _rounded(features.add_time_features(_rd(spark, sf)).select(
        *KEYS, ORDER, "hour_sin", "hour_cos", "month_sin", "month_cos"))


@check("d5_d8_weather_features", f"""
SELECT site_id, timestamp, round(air_temperature - dew_temperature, 6) AS temp_diff, round({Q.HUMIDITY}, 6) AS relative_humidity,
       round(air_temperature * air_temperature, 6) AS temp_squared, round({Q.CHILL}, 6) AS wind_chill
FROM (SELECT * REPLACE (air_temperature AS air_temperature) FROM wx WHERE dew_temperature IS NOT NULL)
UNION ALL
SELECT site_id, timestamp, NULL, NULL, round(air_temperature * air_temperature, 6), round({Q.CHILL}, 6)
FROM wx WHERE dew_temperature IS NULL""")
def _(spark, sf):
    return _rounded(features.add_weather_features(standin.weather(spark, sf)).select(
        "site_id", ORDER, "temp_diff", "relative_humidity", "temp_squared", "wind_chill"))


@check("d9_use_codes", "SELECT building_id, primary_use, primary_use_code FROM described")
def _(spark, sf):
    return features.with_use_codes(standin.buildings(spark, sf)).select("building_id", "primary_use", "primary_use_code")


@check("d10_d12_interactions", f"""
SELECT building_id, meter, timestamp,
       CAST(hour(timestamp) * CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS hour_weekend,
       round(air_temperature * hour(timestamp), 6) AS temp_x_hour, round(log_square_feet * air_temperature, 6) AS sqft_x_temp,
       round(CASE WHEN lag_24h / nullif(rolling_mean_24h, 0) IS NOT NULL
                  THEN least(greatest(lag_24h / nullif(rolling_mean_24h, 0), -10), 10) END, 6) AS reading_vs_rolling
FROM (SELECT *, lag(meter_reading, 24) OVER ({Q.W}) AS lag_24h FROM ({Q.rolled("joined", (24,), ("mean",))}))""")
def _(spark, sf):
    rows = add_rolling(add_lags(_joined(spark, sf), (24,)), (24,), statistics=("mean",))
    rows = features.add_interaction_features(features.add_time_features(rows))
    return _rounded(rows.select(*KEYS, ORDER, "hour_weekend", "temp_x_hour", "sqft_x_temp", "reading_vs_rolling"))


@check("d13_residual", "SELECT building_id, meter, timestamp, round(residual, 6) AS residual FROM residuals")
def _(spark, sf):
    return _rounded(_forecast(spark, sf).select(*KEYS, ORDER, "residual"))


@check("d15_select_features", """
SELECT building_id, meter, timestamp, CAST(hour(timestamp) AS INTEGER) AS hour,
       CAST(isodow(timestamp) - 1 AS INTEGER) AS dayofweek FROM rd""")
def _(spark, sf):
    rows = features.add_time_features(_rd(spark, sf)).drop(
        "month", "is_weekend", "is_holiday", "day_of_year", "hour_sin", "hour_cos", "month_sin", "month_cos")
    return features.select_features(rows, *KEYS, ORDER)


@check("d16_narrow_floats", """
SELECT building_id, meter, timestamp, CAST(meter_reading AS FLOAT) AS meter_reading FROM rd""")
def _(spark, sf):
    return features.narrow_floats(_rd(spark, sf))


_WHOLE = {"hour", "dayofweek", "month", "is_weekend", "is_holiday", "day_of_year", "building_age", "primary_use_code",
          "hour_weekend", "site_id"}
_DEFINITIONS = {
    "hour": "CAST(hour(timestamp) AS INTEGER)", "dayofweek": "CAST(isodow(timestamp) - 1 AS INTEGER)",
    "month": "CAST(month(timestamp) AS INTEGER)", "is_weekend": "CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END",
    "is_holiday": "CASE WHEN h.date IS NULL THEN 0 ELSE 1 END", "day_of_year": "CAST(dayofyear(timestamp) AS INTEGER)",
    "hour_sin": "sin(2 * pi() * hour(timestamp) / 24)", "hour_cos": "cos(2 * pi() * hour(timestamp) / 24)",
    "month_sin": "sin(2 * pi() * month(timestamp) / 12)", "month_cos": "cos(2 * pi() * month(timestamp) / 12)",
    "lag_diff_24h": "lag_24h - lag_168h", "temp_diff": "air_temperature - dew_temperature",
    "relative_humidity": f"CASE WHEN dew_temperature IS NOT NULL THEN {Q.HUMIDITY} END",
    "temp_squared": "air_temperature * air_temperature", "wind_chill": Q.CHILL,
    "hour_weekend": "CAST(hour(timestamp) * CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS INTEGER)",
    "temp_x_hour": "air_temperature * hour(timestamp)", "sqft_x_temp": "log_square_feet * air_temperature",
    "reading_vs_rolling": "CASE WHEN lag_24h / nullif(rolling_mean_24h, 0) IS NOT NULL "
                          "THEN least(greatest(lag_24h / nullif(rolling_mean_24h, 0), -10), 10) END",
}


@check("d17_build_features", "SELECT building_id, meter, timestamp, {columns} FROM ({rows}) r "
       "LEFT JOIN holidays h ON h.country = {country} AND h.date = CAST(r.timestamp AS DATE)".format(
           columns=", ".join(
               f"{d} AS {c}" if c in _WHOLE else f"round({d}, 6) + 0.0 AS {c}"
               for c, d in ((c, _DEFINITIONS.get(c, c)) for c in FEATURES if c != "meter")),
           rows=f"SELECT x.*, lag(meter_reading, 24) OVER w AS lag_24h, lag(meter_reading, 168) OVER w AS lag_168h "
                f"FROM ({Q.rolled('joined')}) x WINDOW w AS ({Q.W})",
           country=Q.COUNTRY.format(site="r.site_id")))
def _(spark, sf):
    rows = features.build_features(_joined(spark, sf))
    return _rounded(features.select_features(rows, *KEYS, ORDER))


# --- E: sequences ------------------------------------------------------------


@check("e1_e2_lags", f"""
SELECT building_id, meter, timestamp, meter_reading, lag_24h, lag_168h, lag_24h - lag_168h AS lag_diff_24h
FROM (SELECT *, lag(meter_reading, 24) OVER w AS lag_24h, lag(meter_reading, 168) OVER w AS lag_168h
      FROM rd_null WINDOW w AS ({Q.W}))""")
def _(spark, sf):
    return add_lags(null_zero_runs(_rd(spark, sf))).select(
        *KEYS, ORDER, TARGET, "lag_24h", "lag_168h", "lag_diff_24h")


_ROLLS = ", ".join(f"rolling_{s}_{w}h" for w in (24, 168) for s in ("mean", "std", "min", "max"))


@check("e3_rolling", f"SELECT building_id, meter, timestamp, {_ROLLS} FROM ({Q.rolled('rd_null')})")
def _(spark, sf):
    rows = add_rolling(null_zero_runs(_rd(spark, sf))).drop(TARGET)
    return rows.withColumns({c: F.round(c, 6) for c in rows.columns if "_std_" in c})


@check("e4_rolling_without_minimum", "SELECT building_id, meter, timestamp, rolling_mean_24h, rolling_std_24h, "
       f"rolling_mean_168h, rolling_std_168h FROM ({Q.rolled('rd_null', stats=('mean', 'std'), minimum=1)})")
def _(spark, sf):
    rows = add_rolling(null_zero_runs(_rd(spark, sf)), statistics=("mean", "std"), min_count=lambda w: 1).drop(TARGET)
    return rows.withColumns({c: F.round(c, 6) for c in rows.columns if "_std_" in c})


@check("e5_kernel_rolling_mean", "SELECT building_id, meter, timestamp, rolling_mean_5h "
       f"FROM ({Q.rolled('rd_null', (5,), ('mean',), 1)})")
def _(spark, sf):
    return add_rolling(null_zero_runs(_rd(spark, sf)), (5,), statistics=("mean",), min_count=lambda w: 1).drop(TARGET)


@check("e6_kernel_rolling_std", "SELECT building_id, meter, timestamp, rolling_std_24h "
       f"FROM ({Q.rolled('rd_null', (24,), ('std',), 2)})")
def _(spark, sf):
    return _rounded(add_rolling(
        null_zero_runs(_rd(spark, sf)), (24,), statistics=("std",), min_count=lambda w: 2).drop(TARGET))


@check("e7_trailing_mean", "SELECT building_id, meter, timestamp, rolling_mean_24h "
       f"FROM ({Q.rolled('rd_null', (24,), ('mean',), 1, last=0)})")
def _(spark, sf):
    return add_rolling(null_zero_runs(_rd(spark, sf)), (24,), statistics=("mean",), min_count=lambda w: 1,
                       include_current=True).drop(TARGET)


@check("e8_run_length", "SELECT building_id, meter, timestamp, CAST(run_flag * run_rows AS BIGINT) AS idle_hours "
       f"FROM ({Q.runs('rd', 'CASE WHEN meter_reading = 0 THEN 1 ELSE 0 END')})")
def _(spark, sf):
    rows = _rd(spark, sf).withColumn("idle", (F.col(TARGET) == 0).cast("int"))
    return add_run_length(rows, "idle", "idle_hours").select(*KEYS, ORDER, "idle_hours")


@check("e9_ordinal_rank", """
SELECT building_id, meter, total, row_number() OVER (ORDER BY total DESC, building_id, meter) AS rank
FROM (SELECT building_id, meter, sum(meter_reading) AS total FROM rd GROUP BY 1, 2)""")
def _(spark, sf):
    totals = _rd(spark, sf).groupBy(*KEYS).agg(F.sum(TARGET).alias("total"))
    return ordinal_rank(totals, [F.desc("total"), *KEYS], "rank")


# --- F: aggregations ---------------------------------------------------------


@check("f1_meter_means", """
SELECT building_id, meter, avg(meter_reading) AS mean, (SELECT avg(meter_reading) FROM rd) AS overall FROM rd GROUP BY 1, 2""")
def _(spark, sf):
    rows = _rd(spark, sf)
    return rows.groupBy(*KEYS).agg(F.avg(TARGET).alias("mean")).withColumn("overall", rows.agg(F.avg(TARGET)).scalar())


@check("f2_regression_metrics", """
SELECT round(sqrt(avg(residual * residual)), 6) AS rmse, round(avg(abs(residual)), 6) AS mae,
       round(sqrt(avg(residual * residual)) / avg(meter_reading), 6) AS cv_rmse,
       round(avg(meter_reading), 6) AS mean_actual FROM residuals""")
def _(spark, sf):
    return _rounded(split.regression_metrics(_forecast(spark, sf)))


@check("f3_meter_summary", """
SELECT building_id, meter, total_hours, CAST(anomaly_hours AS BIGINT) AS anomaly_hours,
       round(mean_anomaly_score, 6) AS mean_anomaly_score, round(max_anomaly_score, 6) AS max_anomaly_score,
       round(mean_residual, 6) + 0.0 AS mean_residual, round(total_excess, 3) AS total_excess,
       CAST(max_streak AS BIGINT) AS max_streak, round(anomaly_rate, 6) AS anomaly_rate FROM summary""")
def _(spark, sf):
    return _rounded(anomaly.summarize_meters(_detected(spark, sf)), total_excess=3)


@check("f4_anomaly_totals", """
SELECT CAST(sum(is_anomaly) AS BIGINT) AS anomalies_flagged, round(100.0 * avg(is_anomaly), 2) AS anomaly_rate_pct FROM detected""")
def _(spark, sf):
    return anomaly.anomaly_totals(_detected(spark, sf))


@check("f5_severity_by_site", """
SELECT m.site_id, count(*) AS n_anomalies, round(avg(abs(anomaly_score)), 6) AS mean_severity,
       round(sum(abs(anomaly_score)), 3) AS cumulative_severity
FROM detected d LEFT JOIN meta m USING (building_id) WHERE is_anomaly = 1 GROUP BY 1""")
def _(spark, sf):
    rows = joins.join_buildings(_detected(spark, sf), _meta(spark, sf), ["site_id"])
    return _rounded(anomaly.severity_by_site(rows), cumulative_severity=3)


@check("f6_column_maxima", """
SELECT round(max(anomaly_rate), 6) AS anomaly_rate, round(max(max_anomaly_score), 6) AS max_anomaly_score,
       round(max(total_excess), 3) AS total_excess FROM summary WHERE total_hours >= 100""")
def _(spark, sf):
    summary = anomaly.summarize_meters(_detected(spark, sf)).where(F.col("total_hours") >= 100)
    return _rounded(summary.agg(*[
        F.max(c).alias(c) for c in ("anomaly_rate", "max_anomaly_score", "total_excess")]), total_excess=3)


@check("f7_buildings_per_meter_type", """
SELECT meter, count(DISTINCT building_id) AS n_buildings,
       CASE meter WHEN 0 THEN 'electricity' WHEN 1 THEN 'chilledwater' END AS meter_name FROM rd GROUP BY 1""")
def _(spark, sf):
    return explore.buildings_per_meter_type(_rd(spark, sf))


@check("f8_buildings_per_use", "SELECT primary_use, count(*) AS n_buildings FROM meta WHERE primary_use IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return explore.buildings_per_use(_meta(spark, sf))


# --- G: anomaly scores -------------------------------------------------------

_SCORE = "SELECT building_id, meter, timestamp, round(anomaly_score, 6) AS anomaly_score FROM ({rows})"


def _scores(spark, sf, **options):
    rows = anomaly.modified_zscore(_dense(spark, sf), value=TARGET, **options)
    return _rounded(rows.drop(TARGET))


@check("g1_modified_zscore", _SCORE.format(rows=Q.scored("rd_dense", "meter_reading", minimum=0)))
def _(spark, sf):
    return _scores(spark, sf)


@check("g2_fallback_about_mean", _SCORE.format(rows=Q.scored("rd_dense", "meter_reading", "mean", 0)))
def _(spark, sf):
    return _scores(spark, sf, fallback="mean")


@check("g2_fallback_zero", _SCORE.format(rows=Q.scored("rd_dense", "meter_reading", "zero", 0)))
def _(spark, sf):
    return _scores(spark, sf, fallback="zero")


@check("g3_minimum_rows", "SELECT building_id, meter, event_id, round(anomaly_score, 6) AS anomaly_score FROM ({})".format(
    Q.scored("(SELECT user_id AS building_id, event_type AS meter, event_id, CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) AS value "
    "FROM events)", "value")))
def _(spark, sf):
    rows = standin.table(spark, sf, "events").select(
        F.col("user_id").alias("building_id"), F.col("event_type").alias("meter"), "event_id",
        F.round(F.col("value") * 100).cast("long").cast("double").alias("value"))
    return _rounded(anomaly.modified_zscore(rows, value="value", min_rows=10).drop("value"))


@check("g4_flags", "SELECT building_id, meter, timestamp, is_anomaly FROM flagged")
def _(spark, sf):
    scored = anomaly.modified_zscore(_forecast(spark, sf), min_rows=10)
    return anomaly.flag(scored, 3.5).select(*KEYS, ORDER, "is_anomaly")


@check("g5_g6_detect_anomalies", """
SELECT building_id, meter, timestamp, round(residual, 6) AS residual, round(anomaly_score, 6) AS anomaly_score, is_anomaly,
       CAST(anomaly_streak AS BIGINT) AS anomaly_streak FROM detected""")
def _(spark, sf):
    return _rounded(_detected(spark, sf).select(*KEYS, ORDER, "residual", "anomaly_score", "is_anomaly", "anomaly_streak"))


@check("g7_overall_zscore", _SCORE.format(rows=Q.scored("rd_dense", "meter_reading", "mean", 0, keys="")))
def _(spark, sf):
    return _scores(spark, sf, fallback="mean", keys=[])


# --- H: split, models, audit -------------------------------------------------


@check("h1_time_split", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate AS timestamp,
       CASE WHEN l_shipdate < (SELECT max(l_shipdate) - INTERVAL 3 MONTHS FROM lineitem) THEN 'train' ELSE 'val' END AS part
FROM lineitem""")
def _(spark, sf):
    rows = standin.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").alias(ORDER))
    train, held_out = split.time_split(rows)
    return train.withColumn("part", F.lit("train")).unionByName(held_out.withColumn("part", F.lit("val")))


@check("h2_meter_mean_forecast", """
SELECT building_id, meter, timestamp, meter_reading, round(predicted, 6) AS predicted FROM mean_forecast""")
def _(spark, sf):
    return _rounded(split.predict_group_mean(*_split(spark, sf)))


_PERSIST = """
SELECT building_id, meter, timestamp, round(COALESCE(lag_200h, (SELECT avg(meter_reading) FROM {part})), 6) AS predicted
FROM (SELECT * FROM (SELECT *, lag(meter_reading, 700) OVER ({w}) AS lag_200h FROM rd_dense)
      WHERE timestamp >= (SELECT max(timestamp) - INTERVAL 7 DAY FROM rd_dense))"""


def _persisted(spark, sf, fill):
    # A lag longer than most of the history leaves gaps to fill.
    rows = add_lags(_dense(spark, sf), (700,)).withColumnRenamed("lag_700h", "lag_24h")
    train, held_out = split.time_split(rows, SETTINGS.holdout, check=False)
    return _rounded(split.predict_persistence(train, held_out, fill=fill).select(*KEYS, ORDER, "predicted"))


@check("h3_persistence_forecast", _PERSIST.format(part="train", w=Q.W))
def _(spark, sf):
    return _persisted(spark, sf, "train_mean")


@check("h3_persistence_published_fill", _PERSIST.format(part="val", w=Q.W))
def _(spark, sf):
    return _persisted(spark, sf, "val_mean")


def _modelling(spark, sf, buildings=8):
    rows = standin.readings(spark, sf, buildings)
    return jobs.modelling_rows(rows, _meta(spark, sf), _wx(spark, sf), SETTINGS)


_HELD = "SELECT building_id, meter, timestamp, round(meter_reading, 6) AS meter_reading, true AS usable FROM run_val"


def _usable(forecast):
    """Held-out rows, and whether each has a prediction that isn't negative; a missing one isn't usable."""
    usable = F.coalesce(F.col("predicted") >= 0, F.lit(False))
    return _rounded(forecast.predictions.select(*KEYS, ORDER, TARGET, usable.alias("usable")))


@check("h4_d14_boosted_trees", _HELD)
def _(spark, sf):
    _, train, held_out = _modelling(spark, sf, None)
    return _usable(models.fit_boosted_trees(train, held_out, QUICK))


# Readings with a daily and weekly shape of each building, and the given readings as noise.
_SHAPE = """200 + round(80 * cos(2 * pi() * ({hour} - 14) / 24) * (1 + building_id % 4)) + CASE WHEN {weekday} >= 5 THEN -120 ELSE 0 END
       + CAST(meter_reading AS BIGINT) % 29"""
_SHAPED = f"""SELECT *, lag(meter_reading, 24) OVER ({Q.W}) AS lag_24h, lag(meter_reading, 168) OVER ({Q.W}) AS lag_168h
    FROM (SELECT building_id, meter, timestamp, CAST({_SHAPE.format(hour="hour(timestamp)", weekday="(isodow(timestamp) - 1)")} AS DOUBLE) AS meter_reading FROM rd)"""


@check("h4_beats_baselines", f"""
SELECT * FROM (WITH s AS (SELECT * FROM ({_SHAPED}) WHERE lag_168h IS NOT NULL), b AS (SELECT max(timestamp) - INTERVAL 7 DAY AS cut FROM s),
     v AS (SELECT s.* FROM s, b WHERE timestamp >= cut), m AS (SELECT building_id, meter, avg(meter_reading) AS p FROM s, b WHERE timestamp < cut GROUP BY 1, 2)
SELECT 'meter_mean' AS model, round(sqrt(avg(pow(meter_reading - p, 2))), 4) AS rmse, true AS beaten FROM v JOIN m USING (building_id, meter)
UNION ALL SELECT 'persistence', round(sqrt(avg(pow(meter_reading - lag_24h, 2))), 4), true FROM v)""")
def _(spark, sf):
    shape = F.expr(_SHAPE.format(hour="hour(timestamp)", weekday="weekday(timestamp)")).cast("double")
    rows = add_lags(_rd(spark, sf).withColumn(TARGET, shape)).drop("lag_diff_24h").where("lag_168h IS NOT NULL")
    rows = rows.withColumns({"hour": F.hour(ORDER), "dayofweek": F.weekday(ORDER)})
    train, held_out = split.time_split(materialize(rows), SETTINGS.holdout, check=False)
    trees = models.fit_boosted_trees(train, held_out, QUICK)
    error = split.regression_metrics(trees.predictions).select("rmse").scalar()
    base = models.compare_models([("meter_mean", split.predict_group_mean(train, held_out), 0.0), ("persistence", split.predict_persistence(train, held_out), 0.0)])
    return base.select("model", F.round("rmse", 4).alias("rmse"), (F.col("rmse") > error).alias("beaten"))


@check("h5_second_learner", _HELD)
def _(spark, sf):
    _, train, held_out = _modelling(spark, sf, None)
    return _usable(models.fit_forest(train, held_out, QUICK))


_METRICS = """SELECT '{name}' AS model, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, count(*) AS n_val,
                     (SELECT count(*) FROM run_train) AS n_train, true AS scored FROM (SELECT {error} AS e FROM {rows})"""


@check("h6_model_comparison", " UNION ALL ".join([
    _METRICS.format(name="meter_mean", error="residual", rows="run_res"),
    _METRICS.format(name="persistence", error="meter_reading - lag_24h", rows="run_val"),
    *[f"SELECT '{m}', NULL, NULL, (SELECT count(*) FROM run_val), (SELECT count(*) FROM run_train), true"
      for m in ("forest", "boosted_trees")]]))
def _(spark, sf):
    # The learners' errors have no counterpart in SQL: only that they are there is compared.
    cfg, base = replace(SETTINGS, booster=QUICK), F.col("model").isin("meter_mean", "persistence")
    table = jobs.compare_job(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf), cfg)
    return table.select(
        "model", *[F.when(base, F.round(c, 4)).alias(c) for c in ("rmse", "mae")], "n_val", "n_train",
        (F.col("rmse") > 0).alias("scored"))


@check("h7_feature_importance", f"SELECT {len(FEATURES)} AS n_features, 1.0::DOUBLE AS total, true AS in_order, (SELECT count(*) > 0 FROM run_train) AS fitted")
def _(spark, sf):
    _, train, held_out = _modelling(spark, sf, None)
    table = models.feature_importance(models.fit_boosted_trees(train, held_out, QUICK), top_n=None)
    return table.agg(
        F.count("feature").cast("int").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"),
        (F.min("importance") >= 0).alias("in_order"), (F.max("importance") > 0).alias("fitted"))


@check("h8_site_models", """
SELECT site_id, CASE WHEN n_train >= 100 AND COALESCE(n_val, 0) >= 10 THEN 'ok' ELSE 'skipped' END AS status, n_train, COALESCE(n_val, 0) AS n_val
FROM (SELECT site_id, count(*) AS n_train FROM run_train GROUP BY 1)
LEFT JOIN (SELECT site_id, count(*) AS n_val FROM run_val GROUP BY 1) USING (site_id)""")
def _(spark, sf):
    _, train, held_out = _modelling(spark, sf, None)
    table = models.fit_site_models(train, held_out, replace(QUICK, rounds=5))
    return table.select("site_id", "status", "n_train", "n_val")


@check("h8_site_lines", f"""
SELECT v.building_id, v.meter, v.timestamp,
       round(CASE WHEN a IS NOT NULL THEN greatest(a + b * v.lag_24h, 0.0) END, 4) AS predicted
FROM (SELECT * FROM lagged WHERE timestamp >= (SELECT max(timestamp) - INTERVAL 7 DAY FROM rd)) v
LEFT JOIN (SELECT site_id, regr_intercept(meter_reading, lag_24h) AS a, regr_slope(meter_reading, lag_24h) AS b FROM lagged
           WHERE timestamp < (SELECT max(timestamp) - INTERVAL 7 DAY FROM rd)
           GROUP BY 1 HAVING count(*) >= 100) l USING (site_id)""".replace(
    "FROM lagged", f"FROM (SELECT r.*, m.site_id, lag(meter_reading, 24) OVER ({Q.W}) AS lag_24h "
                   "FROM rd r LEFT JOIN meta m USING (building_id))"))
def _(spark, sf):
    rows = joins.join_buildings(add_lags(_rd(spark, sf)), _meta(spark, sf), ["site_id"])
    train, held_out = split.time_split(rows, SETTINGS.holdout, check=False)
    return _rounded(models.fit_site_lines(train, held_out).select(*KEYS, ORDER, "predicted"), 4)


@check("h8_site_ridges", f"""
SELECT * FROM (WITH r AS (SELECT r.*, m.site_id, lag(meter_reading, 24) OVER ({Q.W}) AS x1, lag(meter_reading, 168) OVER ({Q.W}) AS x2 FROM rd r LEFT JOIN meta m USING (building_id)),
     b AS (SELECT max(timestamp) - INTERVAL 7 DAY AS cut FROM r),
     s AS (SELECT site_id, avg(meter_reading) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12,
                  covar_pop(x1, meter_reading) AS s1y, covar_pop(x2, meter_reading) AS s2y
           FROM r, b WHERE timestamp < cut AND x1 IS NOT NULL AND x2 IS NOT NULL GROUP BY 1 HAVING count(*) >= 100),
     c AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM s)
SELECT r.building_id, r.meter, r.timestamp, round(CASE WHEN b1 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL THEN greatest(my + b1 * (x1 - m1) + b2 * (x2 - m2), 0.0) END, 3) AS predicted
FROM (SELECT r.* FROM r, b WHERE timestamp >= cut) r LEFT JOIN c USING (site_id))""")
def _(spark, sf):
    rows = joins.join_buildings(add_lags(_rd(spark, sf)), _meta(spark, sf), ["site_id"])
    train, held_out = split.time_split(materialize(rows), SETTINGS.holdout, check=False)
    return _rounded(models.fit_site_ridges(train, held_out, ["lag_24h", "lag_168h"], penalty=0.0).select(*KEYS, ORDER, "predicted"), 3)


@check("h11_step_size_search", "SELECT 3::BIGINT AS n_tried, true AS in_bounds, true AS best_first, (SELECT count(*) > 0 FROM run_val) AS scored")
def _(spark, sf):
    _, train, held_out = _modelling(spark, sf, None)
    best, table = models.search_step_size(train, held_out, replace(QUICK, rounds=6), evaluations=3)
    step = F.col("step_size")
    return table.agg(
        F.count("step_size").alias("n_tried"), F.min((step >= 0.005) & (step <= 0.3)).alias("in_bounds"),
        (F.min_by("step_size", F.struct("rmse", "step_size")) == best).alias("best_first"), F.min(F.col("rmse") > 0).alias("scored"))


@check("h12_a12_saved_model", "SELECT building_id, meter, timestamp, true AS same FROM run_val")
def _(spark, sf):
    _, train, held_out = _modelling(spark, sf, None)
    forecast = models.fit_boosted_trees(train, held_out, QUICK)
    loaded = sinks.load_model(sinks.save_model(forecast.model, _folder(spark)))
    again = loaded.transform(forecast.predictions).withColumn("again", F.greatest("prediction", F.lit(0.0)))
    return again.select(*KEYS, ORDER, F.col("again").eqNullSafe(F.col("predicted")).alias("same"))


@check("h13_audit_list", Q.audit("audit_rows"))
def _(spark, sf):
    return _audit_columns(audit.build_audit_list(anomaly.summarize_meters(_detected(spark, sf)), _meta(spark, sf)))


@check("h14_improvement", """
SELECT round((1 - (SELECT sqrt(avg(residual * residual)) FROM residuals)
        / (SELECT sqrt(avg(pow(meter_reading - (SELECT avg(meter_reading) FROM train), 2))) FROM val)) * 100, 6) AS improvement_pct""")
def _(spark, sf):
    train, held_out = _split(spark, sf)
    overall = held_out.withColumn("predicted", train.agg(F.avg(TARGET)).scalar())
    model = split.regression_metrics(_forecast(spark, sf)).select("rmse").scalar()
    base = split.regression_metrics(overall).select("rmse").scalar()
    return spark.range(1).select(F.round(split.improvement_pct(model, base), 6).alias("improvement_pct"))


# --- I: exploratory tables ---------------------------------------------------


@check("i1_dataset_summary", """
SELECT CAST(count(*) AS BIGINT) AS total_rows, count(DISTINCT building_id) AS n_buildings, count(DISTINCT site_id) AS n_sites,
       count(DISTINCT (building_id, meter)) AS n_meters, min(timestamp) AS date_range_start, max(timestamp) AS date_range_end
FROM rd LEFT JOIN meta USING (building_id)""")
def _(spark, sf):
    return explore.dataset_summary(joins.join_buildings(_rd(spark, sf), _meta(spark, sf), ["site_id"]))


@check("i2_meter_distribution", """
SELECT c.meter, c.meter_name, count(r.meter) AS count, round(avg(meter_reading), 2) AS mean,
       round(median(meter_reading), 2) AS median, round(stddev_samp(meter_reading), 2) AS std,
       round(max(meter_reading), 2) AS max,
       round(100.0 * count(*) FILTER (meter_reading = 0) / nullif(count(r.meter), 0), 2) AS pct_zero
FROM (VALUES (0, 'electricity'), (1, 'chilledwater'), (2, 'steam'), (3, 'hotwater')) c(meter, meter_name)
LEFT JOIN rd_null r ON r.meter = c.meter GROUP BY 1, 2""")
def _(spark, sf):
    return explore.meter_distribution(null_zero_runs(_rd(spark, sf)))


def _bin(value: str, low: str, high: str, n: int) -> str:
    return (f"CAST(CASE WHEN {value} = {high} THEN {n - 1} "
            f"ELSE least(floor(({value} - {low}) / nullif(({high} - {low}) / {n}, 0)), {n - 1}) END AS INTEGER)")


@check("i3_clipped_histogram", f"""
SELECT meter, {_bin("v", "lo", "hi", 80)} AS bin, count(*) AS count
FROM (SELECT *, min(v) OVER (PARTITION BY meter) AS lo, max(v) OVER (PARTITION BY meter) AS hi
      FROM (SELECT r.meter, least(meter_reading, cap) AS v FROM rd_null r
            JOIN (SELECT meter, quantile_cont(meter_reading, 0.99) AS cap FROM rd_null GROUP BY 1) c USING (meter)
            WHERE meter_reading IS NOT NULL)) GROUP BY 1, 2""")
def _(spark, sf):
    return explore.clipped_histogram(null_zero_runs(_rd(spark, sf)))


@check("i4_time_profiles", """
SELECT 'hour' AS profile, CAST(hour(timestamp) AS INTEGER) AS bucket, CAST(NULL AS INTEGER) AS meter, avg(meter_reading) AS mean_reading
FROM rd_null GROUP BY 2
UNION ALL SELECT 'weekday', CAST(isodow(timestamp) - 1 AS INTEGER), NULL, avg(meter_reading) FROM rd_null GROUP BY 2
UNION ALL SELECT 'month', CAST(month(timestamp) AS INTEGER), NULL, avg(meter_reading) FROM rd_null GROUP BY 2
UNION ALL SELECT 'hour_by_meter', CAST(hour(timestamp) AS INTEGER), meter, avg(meter_reading) FROM rd_null GROUP BY 2, 3""")
def _(spark, sf):
    return explore.time_profiles(null_zero_runs(_rd(spark, sf)))


@check("i5_profile_extremes", """
SELECT (SELECT CAST(hour(timestamp) AS INTEGER) FROM rd_null GROUP BY hour(timestamp)
        ORDER BY avg(meter_reading) DESC, hour(timestamp) LIMIT 1) AS peak_hour,
       (SELECT CAST(hour(timestamp) AS INTEGER) FROM rd_null GROUP BY hour(timestamp)
        ORDER BY avg(meter_reading), hour(timestamp) LIMIT 1) AS trough_hour,
       (SELECT round(avg(m) FILTER (d <= 5) / greatest(avg(m) FILTER (d > 5), 1e-6), 2)
        FROM (SELECT isodow(timestamp) AS d, avg(meter_reading) AS m FROM rd_null GROUP BY 1)) AS weekday_vs_weekend_ratio""")
def _(spark, sf):
    return explore.profile_extremes(null_zero_runs(_rd(spark, sf)))


@check("i6_missingness", "SELECT {}, round(100.0 * count(*) FILTER (meter_reading = 0) / count(*), 2) AS reading_zero_pct, "
       "round(100.0 * count(*) FILTER (meter_reading IS NULL) / count(*), 2) AS reading_missing_pct FROM dataset".format(
           ", ".join(f"round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS {c}_missing_pct"
                     for c in ("air_temperature", "dew_temperature", "cloud_coverage", "precip_depth_1_hr",
                               "sea_level_pressure", "wind_direction", "wind_speed"))))
def _(spark, sf):
    return explore.missingness(_dataset(spark, sf))


_WEATHERED = """SELECT r.*, w.air_temperature, w.dew_temperature, w.wind_speed
FROM rd_null r LEFT JOIN meta m USING (building_id) LEFT JOIN wx w ON w.site_id = m.site_id AND w.timestamp = r.timestamp"""


def _weathered(spark, sf):
    rows = joins.join_buildings(null_zero_runs(_rd(spark, sf)), _meta(spark, sf), ["site_id"])
    return joins.join_weather(rows, standin.weather(spark, sf))


@check("i7_response_curve", f"""
SELECT meter, CAST(greatest(least(ceil((air_temperature - lo) / ((hi - lo) / 20)), 20), 1) AS INTEGER) AS bin, count(*) AS count,
       round(avg(meter_reading), 6) AS mean_reading
FROM (SELECT *, min(air_temperature) OVER (PARTITION BY meter) AS lo, max(air_temperature) OVER (PARTITION BY meter) AS hi,
             count(*) OVER (PARTITION BY meter) AS n
      FROM ({_WEATHERED}) WHERE air_temperature IS NOT NULL AND meter_reading IS NOT NULL)
WHERE n >= 100 GROUP BY 1, 2""")
def _(spark, sf):
    return _rounded(explore.response_curve(_weathered(spark, sf)))


_CORR = ("meter_reading", "air_temperature", "dew_temperature", "wind_speed")


@check("i8_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) AS correlation FROM ({_WEATHERED}) "
    "WHERE air_temperature IS NOT NULL AND meter_reading IS NOT NULL" for a in _CORR for b in _CORR))
def _(spark, sf):
    return _rounded(explore.correlations(_weathered(spark, sf)))


_SITES = """
SELECT site_id, count(DISTINCT building_id) AS n_buildings, CAST(count(meter_reading) AS BIGINT) AS n_rows,
       avg(meter_reading) AS mean_reading, median(meter_reading) AS median_reading
FROM rd_null LEFT JOIN meta USING (building_id) GROUP BY 1"""


@check("i9_site_comparison", _SITES)
def _(spark, sf):
    return explore.site_comparison(
        joins.join_buildings(null_zero_runs(_rd(spark, sf)), _meta(spark, sf), ["site_id"]))


@check("i9_site_leaders", f"""
SELECT (SELECT site_id FROM ({_SITES}) ORDER BY mean_reading DESC, site_id LIMIT 1) AS highest_consumption_site,
       (SELECT site_id FROM ({_SITES}) ORDER BY n_buildings DESC, site_id LIMIT 1) AS most_buildings_site""")
def _(spark, sf):
    return explore.site_leaders(explore.site_comparison(
        joins.join_buildings(null_zero_runs(_rd(spark, sf)), _meta(spark, sf), ["site_id"])))


@check("i10_prediction_sample", """
SELECT building_id, meter, timestamp, meter_reading, round(predicted, 6) AS predicted FROM mean_forecast
ORDER BY md5(concat_ws('|', building_id, meter, timestamp)), building_id, meter, timestamp LIMIT 1000""")
def _(spark, sf):
    return _rounded(explore.prediction_sample(_forecast(spark, sf), 1000))


@check("i10_residual_summary", "SELECT count(residual) AS n, round(avg(residual), 6) AS mean_residual FROM residuals")
def _(spark, sf):
    return _rounded(explore.residual_summary(_forecast(spark, sf)))


@check("i10_residual_histogram", f"""
SELECT {_bin("residual", "lo", "hi", 100)} AS bin, count(*) AS count
FROM (SELECT residual, min(residual) OVER () AS lo, max(residual) OVER () AS hi FROM residuals) GROUP BY 1""")
def _(spark, sf):
    return explore.histogram(_forecast(spark, sf), "residual", 100)


@check("i11_score_histogram", f"""
SELECT {_bin("s", "lo", "hi", 100)} AS bin, count(*) AS count
FROM (SELECT s, min(s) OVER () AS lo, max(s) OVER () AS hi
      FROM (SELECT least(greatest(anomaly_score, -10.0), 10.0) AS s FROM detected)) GROUP BY 1""")
def _(spark, sf):
    return explore.histogram(_detected(spark, sf), "anomaly_score", 100, -10, 10, clamp=True)


@check("i11_rate_by_meter_type", "SELECT meter, round(100.0 * avg(is_anomaly), 6) AS anomaly_rate_pct FROM detected GROUP BY 1")
def _(spark, sf):
    return _rounded(explore.rate_by_meter_type(_detected(spark, sf)))


@check("i12_severity_histogram", f"""
SELECT {_bin("abs(anomaly_score)", "0.0::DOUBLE", "12.0::DOUBLE", 79)} AS bin, count(*) AS count
FROM ({Q.scored("residuals", "residual", "zero", 0)}) WHERE abs(anomaly_score) <= 12 GROUP BY 1""")
def _(spark, sf):
    scores = anomaly.modified_zscore(_forecast(spark, sf), fallback="zero")
    return explore.histogram(scores.withColumn("severity", F.abs("anomaly_score")), "severity", 79, 0, 12)


@check("i12_score_tail", f"""
SELECT count(anomaly_score) AS n_scored, count(*) FILTER (abs(anomaly_score) > 3.5) AS n_flagged,
       count(*) FILTER (abs(anomaly_score) > 12) AS n_beyond FROM ({Q.scored("residuals", "residual", "zero", 0)})""")
def _(spark, sf):
    return explore.score_tail(anomaly.modified_zscore(_forecast(spark, sf), fallback="zero"))


# --- J, K, P: streaming and jobs ---------------------------------------------


@check("a5_j1_incremental_ingest", """
SELECT e.building_id, e.meter, e.timestamp, round(CASE WHEN site_id = 0 AND meter = 0 THEN meter_reading * 0.293071
       ELSE meter_reading END, 6) AS meter_reading, m.site_id, round(w.air_temperature, 6) AS air_temperature
FROM ev e LEFT JOIN meta m USING (building_id) LEFT JOIN wx_filled w USING (site_id, timestamp)""")
def _(spark, sf):
    folder = _folder(spark)
    events = standin.table(spark, sf, "events")
    source = sinks.write_table(events.repartition(4), f"{folder}/arrivals", "parquet")
    stream = ingest.read_stream(spark, source, events.schema, max_files=1)
    ingest.ingest(stream, _meta(spark, sf), _wx(spark, sf), f"{folder}/sink", f"{folder}/progress",
                  prepare=standin.event_readings).awaitTermination()
    return _rounded(spark.read.parquet(f"{folder}/sink").select(*KEYS, ORDER, TARGET, "site_id", "air_temperature"))


@check("j2_limited_replay", """
SELECT e.building_id, e.meter, e.timestamp, round(CASE WHEN site_id = 0 AND meter = 0 THEN meter_reading * 0.293071
       ELSE meter_reading END, 6) AS meter_reading, m.site_id
FROM ev e LEFT JOIN meta m USING (building_id) WHERE e.meter = 1""")
def _(spark, sf):
    # One folder of files per chunk; the replay takes the second one only.
    folder = _folder(spark)
    events = standin.table(spark, sf, "events")
    chunk = F.when(F.col("event_type").isin("click", "view"), 0).otherwise(1)
    for i in (0, 1):
        sinks.write_table(events.where(chunk == i), f"{folder}/arrivals/chunk-{i}", "parquet")
    stream = ingest.read_stream(spark, f"{folder}/arrivals/chunk-1", events.schema, max_files=1, pattern="*.parquet")
    ingest.ingest(stream, _meta(spark, sf), _wx(spark, sf), f"{folder}/sink", f"{folder}/progress",
                  prepare=standin.event_readings).awaitTermination()
    return _rounded(spark.read.parquet(f"{folder}/sink").select(*KEYS, ORDER, TARGET, "site_id"))


@check("k3_top_meters", "SELECT * FROM ({}) WHERE rank <= 5".format(Q.audit("audit_rows")))
def _(spark, sf):
    summary = anomaly.summarize_meters(_detected(spark, sf))
    return _audit_columns(audit.build_audit_list(summary, _meta(spark, sf), top_n=5))


@check("p1_audit_run", Q.audit("flag_audit_rows"))
def _(spark, sf):
    return flagship(spark, sf)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Clean, forecast by meter mean, score the held-out week and rank the meters."""
    return _audit_columns(jobs.baseline_audit(_dense(spark, sf), _meta(spark, sf), SETTINGS))


def _mean_model(train, held_out, cfg):
    return models.Forecast("meter_mean", split.predict_group_mean(train, held_out), PipelineModel([]), list(FEATURES), 0.0)


def _full_run(spark, sf):
    """The whole job with a forecast that SQL can follow, and the folder of its files."""
    out = _folder(spark)
    return out, jobs.audit_job(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf), out, replace(SETTINGS, audit=AuditSettings(min_hours=24)), fit=_mean_model)


@check("p1_full_run_audit", Q.audit("run_audit_rows"))
def _(spark, sf):
    return _audit_columns(_full_run(spark, sf)[1].audit)


@check("p1_full_run_sites", """
SELECT site_id, count(*) AS n_anomalies, round(avg(abs(anomaly_score)), 6) AS mean_severity,
       round(sum(abs(anomaly_score)), 3) AS cumulative_severity FROM run_detected WHERE is_anomaly = 1 GROUP BY 1""")
def _(spark, sf):
    return _rounded(_full_run(spark, sf)[1].sites, cumulative_severity=3)


@check("p1_full_run_predictions", """
SELECT building_id, meter, timestamp, round(meter_reading, 3) AS meter_reading, round(meter_reading - residual, 3) AS predicted FROM run_res""")
def _(spark, sf):
    out, _ = _full_run(spark, sf)
    schema = T.StructType([*_RAW.fields, T.StructField("predicted", T.DoubleType()), T.StructField("residual", T.DoubleType())])
    return _rounded(R.read_table(spark, f"{out}/predictions", schema).drop("residual"), 3)


@check("p1_full_run_summary", f"""
SELECT (SELECT count(*) FROM run_rows) AS modelled, (SELECT count(*) FROM run_train) AS train_rows,
       (SELECT count(*) FROM run_val) AS val_rows, {len(FEATURES)}::BIGINT AS n_features,
       (SELECT round(sqrt(avg(residual * residual)), 4) FROM run_res) AS rmse,
       (SELECT round(sqrt(avg(pow(meter_reading - lag_24h, 2))), 4) FROM run_val) AS persistence_rmse,
       (SELECT CAST(sum(is_anomaly) AS BIGINT) FROM run_detected) AS flagged, (SELECT count(*) FROM run_audit_rows) AS entries""")
def _(spark, sf):
    out, _ = _full_run(spark, sf)
    s = spark.read.json(f"{out}/summary")
    return s.select(
        F.col("rows.modelled").alias("modelled"), "train_rows", "val_rows", "n_features", F.round("model.rmse", 4).alias("rmse"),
        F.round("persistence.rmse", 4).alias("persistence_rmse"), F.col("anomalies.anomalies_flagged").alias("flagged"),
        F.col("audit_entries.meters").alias("entries"))


@check("p1_audit_run_boosted", f"""
SELECT building_id, meter, timestamp, round(meter_reading, 3) AS meter_reading, true AS usable, {len(FEATURES)}::BIGINT AS n_features,
       (SELECT count(*) FROM run_train) AS train_rows FROM run_val""")
def _(spark, sf):
    # the whole job with its own learner; what it wrote is read back
    out, cfg = _folder(spark), replace(SETTINGS, booster=QUICK, audit=AuditSettings(min_hours=24))
    jobs.audit_job(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf), out, cfg)
    schema = T.StructType([*_RAW.fields, T.StructField("predicted", T.DoubleType()), T.StructField("residual", T.DoubleType())])
    summary = spark.read.json(f"{out}/summary")
    rows = R.read_table(spark, f"{out}/predictions", schema)
    return rows.select(
        *KEYS, ORDER, F.round(TARGET, 3).alias(TARGET), F.coalesce(F.col("predicted") >= 0, F.lit(False)).alias("usable"),
        summary.select("n_features").scalar().alias("n_features"), summary.select("train_rows").scalar().alias("train_rows"))


@check("p1_full_run_meters", """
SELECT building_id, meter, CAST(count(is_anomaly) AS BIGINT) AS total_hours, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_hours FROM run_detected GROUP BY 1, 2""")
def _(spark, sf):
    # the written summary of the meters
    out, _ = _full_run(spark, sf)
    rows = spark.read.option("header", "true").csv(f"{out}/anomaly_summary")
    return rows.select(
        F.col("building_id").cast("bigint").alias("building_id"), F.col("meter").cast("int").alias("meter"),
        *[F.col(c).cast("bigint").alias(c) for c in ("total_hours", "anomaly_hours")])


@check("k6_other_scorer", """
SELECT building_id, meter, timestamp, round(z, 6) AS anomaly_score, CASE WHEN abs(z) > 3.5 THEN 1 ELSE 0 END AS is_anomaly
FROM (SELECT *, COALESCE((residual - avg(residual) OVER g) / nullif(stddev_pop(residual) OVER g, 0), 0.0) AS z
      FROM residuals WINDOW g AS (PARTITION BY building_id, meter))""")
def _(spark, sf):
    def plain(df, value, out, **_):
        group = Window.partitionBy(*KEYS)
        centred = F.col(value) - F.avg(value).over(group)
        return df.withColumn(out, F.coalesce(centred / F.nullif(F.stddev_pop(value).over(group), F.lit(0.0)), F.lit(0.0)))

    found = anomaly.detect_anomalies(_forecast(spark, sf), scorer=plain)
    return _rounded(found.select(*KEYS, ORDER, "anomaly_score", "is_anomaly"))


@check("p2_quality", _QUALITY)
def _(spark, sf):
    return jobs.quality_job(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf))


@check("p3_explore", """
SELECT site_id, count(DISTINCT building_id) AS n_buildings, CAST(count(meter_reading) AS BIGINT) AS n_rows,
       round(avg(meter_reading), 6) AS mean_reading, round(median(meter_reading), 6) AS median_reading
FROM dataset GROUP BY 1""")
def _(spark, sf):
    return _rounded(jobs.explore_job(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf))["sites"])


_BY_TABLE = {  # the total of one column of every written table
    "dataset": ("total_rows", "SELECT 1, count(*) FROM dataset"),
    "meter_types": ("n_buildings", "SELECT count(*), sum(n) FROM (SELECT count(DISTINCT building_id) AS n FROM dataset GROUP BY meter)"),
    "uses": ("n_buildings", "SELECT count(*), sum(n) FROM (SELECT count(*) AS n FROM meta WHERE primary_use IS NOT NULL GROUP BY primary_use)"),
    "meter_distribution": ("count", "SELECT 4, count(*) FROM dataset WHERE meter BETWEEN 0 AND 3"),
    "reading_histogram": ("count", "SELECT NULL, count(meter_reading) FROM dataset"),
    "profiles": ("bucket", """SELECT count(*), sum(b) FROM (SELECT DISTINCT 0 AS p, -1 AS m, hour(timestamp) AS b FROM dataset UNION SELECT 1, -1, isodow(timestamp) - 1 FROM dataset
        UNION SELECT 2, -1, month(timestamp) FROM dataset UNION SELECT 3, meter, hour(timestamp) FROM dataset)"""),
    "extremes": ("peak_hour", "SELECT 1, (SELECT hour(timestamp) FROM dataset GROUP BY hour(timestamp) ORDER BY avg(meter_reading) DESC, hour(timestamp) LIMIT 1)"),
    "missingness": ("reading_zero_pct", "SELECT 1, 100.0 * count(*) FILTER (meter_reading = 0) / count(*) FROM dataset"),
    "temperature_response": ("count", """SELECT NULL, sum(n) FROM (SELECT count(*) AS n FROM dataset WHERE air_temperature IS NOT NULL AND meter_reading IS NOT NULL
        GROUP BY meter HAVING count(*) >= 100)"""),
    "correlations": ("correlation", "SELECT 16, 4 + 2 * ({}) FROM dataset WHERE air_temperature IS NOT NULL AND meter_reading IS NOT NULL".format(
        " + ".join(f"corr({a}, {b})" for i, a in enumerate(_CORR) for b in _CORR[:i]))),
    "sites": ("n_rows", "SELECT (SELECT count(DISTINCT COALESCE(site_id, -1)) FROM dataset), count(meter_reading) FROM dataset"),
    "site_leaders": ("highest_consumption_site", "SELECT 1, (SELECT site_id FROM dataset GROUP BY 1 ORDER BY avg(meter_reading) DESC, site_id LIMIT 1)"),
}


@check("p3_explore_written", " UNION ALL ".join(
    f"SELECT '{name}' AS name, CAST(n AS BIGINT) AS n_rows, round(CAST(t AS DOUBLE), 2) AS total FROM ({sql}) x(n, t)" for name, (_, sql) in _BY_TABLE.items()))
def _(spark, sf):
    # all twelve tables as the job wrote them
    out = _folder(spark)
    jobs.explore_job(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf), out)
    found = None
    for name, (column, sql) in _BY_TABLE.items():
        count = F.lit(None) if sql.startswith("SELECT NULL") else F.count(F.lit(1))
        row = spark.read.json(f"{out}/eda/{name}").agg(
            F.lit(name).alias("name"), count.cast("bigint").alias("n_rows"), F.round(F.sum(column).cast("double"), 2).alias("total"))
        found = row if found is None else found.unionByName(row)
    return found


@check("p5_raw_features", f"""
SELECT r.building_id, r.meter, r.timestamp, r.meter_reading, CAST(hour(r.timestamp) AS INTEGER) AS hour,
       CAST(dayofweek(r.timestamp) + 1 AS INTEGER) AS dayofweek, CAST(month(r.timestamp) AS INTEGER) AS month,
       CASE WHEN isodow(r.timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend, CAST(dayofyear(r.timestamp) AS INTEGER) AS day_of_year,
       lag(meter_reading, 24) OVER w AS lag_24h, lag(meter_reading, 168) OVER w AS lag_168h, rolling_mean_24h,
       rolling_std_24h, rolling_mean_168h, rolling_std_168h, site_id, round(air_temperature, 6) AS air_temperature
FROM ({Q.rolled("joined", stats=("mean", "std"), minimum=1)}) r WINDOW w AS ({Q.W})""")
def _(spark, sf):
    rows = jobs.raw_feature_job(_rd(spark, sf), _meta(spark, sf), _wx(spark, sf)).select(
        *KEYS, ORDER, TARGET, "hour", "dayofweek", "month", "is_weekend", "day_of_year", "lag_24h", "lag_168h",
        "rolling_mean_24h", "rolling_std_24h", "rolling_mean_168h", "rolling_std_168h", "site_id", "air_temperature")
    return rows.withColumns({c: F.round(c, 6) for c in ("rolling_std_24h", "rolling_std_168h", "air_temperature")})


@check("p6_load_dataset", """
SELECT building_id, meter, timestamp, round(meter_reading, 6) AS meter_reading, site_id, primary_use,
       round(air_temperature, 6) AS air_temperature, cloud_coverage FROM dataset""")
def _(spark, sf):
    return _rounded(_dataset(spark, sf).select(
        *KEYS, ORDER, TARGET, "site_id", "primary_use", "air_temperature", "cloud_coverage"))
