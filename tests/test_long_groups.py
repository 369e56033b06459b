"""Splitting a series must never change a result."""

import pytest
from helpers import assert_same, column, frame, hours, readings, uneven
from pyspark.sql import functions as F

from wattline.config import CleaningSettings, FeatureSettings
from wattline.functions.groups import SEGMENT, LongGroups, as_series, find_long_groups
from wattline.functions.quantiles import group_quantiles
from wattline.functions.ranking import ordinal_rank
from wattline.functions.sequence import add_lags, add_rolling, add_run_length, fill_from_neighbours, null_zero_runs
from wattline.operators.anomaly import detect_anomalies, modified_zscore
from wattline.operators.cleaning import cap_outliers
from wattline.operators.features import add_sequence_features

WHOLE = LongGroups(("building_id", "meter"), 10**9, None)


@pytest.fixture(scope="module")
def rows(spark):
    """Meters of uneven length; one long one has no building id, flags are missing where readings are."""
    df = readings(spark, uneven()).withColumn("building_id", F.when(F.col("building_id") != 2, F.col("building_id")))
    return df.withColumn("flag", (F.col("meter_reading") == 0).cast("int")).cache()


@pytest.mark.parametrize("operator", [
    lambda df, long: add_lags(df, (3, 50), long=long),
    lambda df, long: add_rolling(df, (7, 24, 60), long=long),
    lambda df, long: add_rolling(df, (24,), include_current=True, long=long),
    lambda df, long: null_zero_runs(df, 30, long=long),
    lambda df, long: add_run_length(df, "flag", "run", long=long),
    lambda df, long: fill_from_neighbours(df, ["meter_reading"], ["building_id", "meter"], long=long),
    lambda df, long: cap_outliers(df, 0.9, long=long),
    lambda df, long: modified_zscore(df, value="meter_reading", long=long),
    lambda df, long: detect_anomalies(df.withColumn("residual", F.col("meter_reading")), long=long),
    lambda df, long: add_sequence_features(
        df, FeatureSettings((24, 48), (24, 48)), CleaningSettings(min_zero_streak=30), long=long),
], ids=["lags", "rolling", "trailing", "outages", "runs", "fill", "cap", "zscore", "detect", "features"])
def test_split_equals_whole(rows, small_groups, operator):
    long = find_long_groups(rows)
    assert long
    assert_same(operator(rows, long), operator(rows, WHOLE))


@pytest.mark.parametrize("step", ["7 MINUTES", "1 SECOND", "20 MICROSECONDS"])
def test_a_day_above_the_limit_is_cut(spark, small_groups, step):
    """Several hundred readings within a day, an hour or a second of one meter."""
    df = spark.sql(f"""SELECT 1 AS building_id, 0 AS meter, timestamp_ntz'2024-01-03 23:59:58' + id * INTERVAL {step} AS timestamp,
        CASE WHEN id % 90 < 50 THEN 0.0 WHEN id % 7 > 0 THEN CAST(id * 37 % 101 AS DOUBLE) END AS meter_reading FROM range(400)""")
    long = find_long_groups(df)
    segments = as_series(df, long, before=24).rows.groupBy(SEGMENT).count().collect()
    assert len(segments) >= 8 and max(r["count"] for r in segments) <= 2 * 40 + 24
    for operator in (lambda d, g: add_rolling(d, (7, 24), long=g), lambda d, g: null_zero_runs(d, 30, long=g), lambda d, g: fill_from_neighbours(d, ["meter_reading"], ["building_id", "meter"], long=g)):
        assert_same(operator(df, long), operator(df, WHOLE))


def test_only_long_groups_are_reported(rows, small_groups):
    assert {r.building_id for r in find_long_groups(rows).keys_table.collect()} == {1, None}
    assert not find_long_groups(rows, limit=10_000)


@pytest.mark.parametrize("keys", [["building_id"], []])
def test_counted_quantiles_match_percentile(rows, small_groups, keys):
    wanted = {"q0": 0.0, "q10": 0.1, "median": 0.5, "q999": 0.999, "q1": 1.0}
    signed = rows.withColumn("x", F.col("meter_reading") * F.when(F.hour("timestamp") % 2 == 0, -1.37).otherwise(1e-4))
    expected = signed.groupBy(*keys).agg(*[F.percentile("x", F.lit(p)).alias(n) for n, p in wanted.items()])
    found = group_quantiles(signed, "x", wanted, keys)
    order = keys or ["q0"]
    assert_same(found, expected, *order)


def test_distributed_rank(rows, small_groups):
    ranked = frame(ordinal_rank(rows, [F.desc_nulls_last("meter_reading"), "building_id", "timestamp"], "rank"), "rank")
    assert list(ranked["rank"]) == list(range(1, len(ranked) + 1))
    known = ranked["meter_reading"].dropna()
    assert (known.diff().dropna() <= 0).all()


def test_a_missing_key_is_a_group_both_ways(spark, small_groups):
    rows = readings(spark, [(None, 0, t, float(i)) for i, (_, _, t, _) in enumerate(hours(range(100)))])
    for df in (cap_outliers(rows, 0.5), cap_outliers(rows, 0.5, long=WHOLE)):
        assert frame(df)["meter_reading"].max() == 49.5


def test_one_value_in_a_long_group(spark, small_groups):
    """All ranks in one bin of equal values."""
    rows = readings(spark, hours([7.0] * 300))
    assert_same(modified_zscore(rows, value="meter_reading"), modified_zscore(rows, value="meter_reading", long=WHOLE))


@pytest.mark.parametrize("limit", ["40", "2"])
def test_a_missing_flag_ends_a_run(spark, limit):
    spark.conf.set("spark.wattline.maxGroupRows", limit)
    rows = readings(spark, hours([1, 1, None, 1, 1, 1, 0, None, None, 1]))
    found = column(add_run_length(rows.withColumnRenamed("meter_reading", "flag"), "flag", "run"), "run")
    spark.conf.unset("spark.wattline.maxGroupRows")
    assert found == [2, 2, 0, 3, 3, 3, 0, 0, 0, 1]
