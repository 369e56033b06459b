"""What keeps work and memory in step with the rows."""

import datetime as dt

import pytest
from helpers import START, assert_same, hours, readings
from pyspark.sql import functions as F

from wattline.functions import groups
from wattline.functions.sequence import add_lags, null_zero_runs
from wattline.operators import explore
from wattline.plans import jobs
from wattline.sources import standin


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def events(spark, tmp_path, rows):
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def at(hour, minute=0):
    return START + dt.timedelta(hours=hour, minutes=minute)


def test_readings_fill_every_hour_of_every_meter(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = [(at(2, 5), 1, "click", 1.5), (at(2, 5), 1, "click", 1.5), (at(2, 50), 1, "view", 2.0), (at(5), 1, "buy", 4.0),
            (at(0), 2, "click", 3.0), (None, 2, "buy", 7.0), (at(6, 59), None, "click", 9.0), (at(4), 3, "view", None)]
    found = {(r.building_id, r.meter, r.timestamp): r.meter_reading for r in standin.readings(spark, events(spark, tmp_path, rows)).collect()}
    meters = [(1, 0), (1, 1), (2, 0), (2, 1), (None, 0), (3, 0)]
    wanted = {(*m, at(h)): 0.0 for m in meters for h in range(7)}
    wanted |= {(1, 0, at(2)): 500.0, (1, 1, at(5)): 400.0, (2, 0, at(0)): 300.0}
    assert found == wanted


def test_empty_hours_are_not_shuffled(spark, tmp_path):
    rows = standin.readings(spark, events(spark, tmp_path, [(at(0), 1, "click", 1.0), (at(500), 2, "view", 1.0)]))
    physical = add_lags(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in physical[: physical.index("Generate")]


def test_tasks_stay_small_however_many_series_there_are(spark, monkeypatch):
    rows = readings(spark, [r for b in range(40) for r in hours(range(10), b)])
    before = add_lags(rows, (2,))
    monkeypatch.setattr(groups, "TASK_ROWS", 20)
    after = add_lags(rows, (2,))
    assert after.rdd.getNumPartitions() >= 20
    assert_same(before, after)
    assert groups.find_long_groups(rows).rows == 400


@pytest.mark.parametrize("table", [
    explore.meter_distribution, explore.clipped_histogram, explore.site_comparison,
    lambda df: explore.response_curve(df, "air_temperature", min_rows=1)])
def test_tables_with_quantiles_compute_their_rows_once(spark, table):
    rows = null_zero_runs(readings(spark, hours([3, 0, 5, None, 8])), 2).withColumns(
        {"site_id": F.lit(1), "air_temperature": F.col("meter_reading") + 1})
    assert "Window" in plan(rows) and "Window" not in plan(table(rows))


def test_dimensions_join_a_stored_series(spark):
    rows = readings(spark, hours(range(60)))
    buildings = spark.createDataFrame([(1, 0, 5.0)], "building_id int, site_id int, log_square_feet double")
    weather = spark.createDataFrame([(0, START, 1.0, 2.0)], "site_id int, timestamp timestamp_ntz, air_temperature double, dew_temperature double")
    assert "Window" not in plan(jobs.feature_table(rows, buildings, weather))


def test_exploration_stores_what_its_tables_read(spark, monkeypatch, tmp_path):
    """One selection serves the medians and the caps per meter, and no column is stored that no table reads."""
    asked, stored = [], []
    monkeypatch.setattr(explore, "group_quantiles", lambda *a, f=explore.group_quantiles: asked.append((a[2], a[3])) or f(*a))
    monkeypatch.setattr(jobs, "materialize", lambda df, f=jobs.materialize: stored.append(df.columns) or f(df))
    rows = readings(spark, hours(range(1, 61)) + hours([5, None, 7] * 20, building=2, meter=1) + hours([4] * 9, building=3, meter=9))
    buildings = spark.createDataFrame([(b, b % 2, "Office", 100.0) for b in (1, 2, 3)], "building_id int, site_id int, primary_use string, square_feet double")
    weather = spark.createDataFrame([(0, START, 1.0, 2.0, 3.0)], "site_id int, timestamp timestamp_ntz, air_temperature double, dew_temperature double, wind_speed double")
    tables = jobs.explore_job(rows, buildings, weather)
    assert asked == [({"median": 0.5, "_cap": 0.99}, ["meter"]), ({"median_reading": 0.5}, ["site_id"])]
    assert not {"primary_use", "square_feet"} & set(stored[0])
    df = jobs.load_dataset(rows, buildings, weather)
    for name, plain in (("meter_distribution", explore.meter_distribution(df)), ("reading_histogram", explore.clipped_histogram(df))):
        assert sorted(map(repr, tables[name].collect())) == sorted(map(repr, plain.collect()))
