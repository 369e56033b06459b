"""Edge cases on hand-built rows; expected values by hand."""

import datetime as dt

import pytest
from helpers import START, column, frame, hours, readings
from pyspark.sql import functions as F

from wattline.config import AuditSettings
from wattline.functions.rolling import frame_plan
from wattline.functions.scalar import clip, relative_humidity, wind_chill
from wattline.functions.sequence import add_lags, add_rolling, add_run_length, fill_from_neighbours, null_zero_runs
from wattline.operators.anomaly import detect_anomalies, modified_zscore, summarize_meters
from wattline.operators.audit import AUDIT_COLUMNS, build_audit_list
from wattline.operators.cleaning import cap_outliers, convert_units, drop_negatives, quality_report
from wattline.operators.features import with_use_codes
from wattline.operators.joins import duplicate_keys, mark_holidays
from wattline.operators.split import predict_group_mean, regression_metrics, time_split
from wattline.sources.readings import describe_buildings


def test_negatives_go_and_missing_stays(spark):
    assert column(drop_negatives(readings(spark, hours([1, -1, None, 0]))), "meter_reading") == [1, None, 0]


def test_units_only_change_for_one_site_and_meter(spark):
    rows = readings(spark, hours([10]) + hours([10], meter=1)).withColumn("site_id", F.lit(0))
    assert column(convert_units(rows), "meter_reading") == [pytest.approx(2.93071), 10]
    assert convert_units(rows.drop("site_id")).columns == rows.drop("site_id").columns


def test_cap_keeps_missing(spark):
    values = column(cap_outliers(readings(spark, hours([1, 2, 3, None, 103])), 0.5), "meter_reading")
    assert values == [1, 2, 2.5, None, 2.5]


def test_a_missing_reading_ends_a_zero_run(spark):
    rows = readings(spark, hours([0, 0, None, 0, 0, 0, 5, 0, 0]))
    assert column(null_zero_runs(rows, 3), "meter_reading") == [0, 0, None, None, None, None, 5, 0, 0]


def test_runs_do_not_cross_meters(spark):
    rows = readings(spark, hours([5, 0, 0], building=1) + hours([0, 0, 5], building=2))
    assert column(null_zero_runs(rows, 3), "meter_reading") == [5, 0, 0, 0, 0, 5]


def test_lags_count_rows_not_hours(spark):
    rows = hours([1, 2]) + [(1, 0, START + dt.timedelta(days=9), 3.0)]
    df = add_lags(readings(spark, rows), (1,))
    assert column(df, "lag_1h") == [None, 1, 2]
    assert column(df, "lag_diff_24h") == [None, None, None]


def test_rolling_leaves_the_current_row_out_and_needs_a_quarter(spark):
    df = add_rolling(readings(spark, hours(range(1, 13))), (8,), statistics=("mean", "std", "min", "max"))
    mean = column(df, "rolling_mean_8h")
    assert mean[:2] == [None, None] and mean[2] == 1.5 and mean[11] == 7.5
    assert column(df, "rolling_min_8h")[11] == 4 and column(df, "rolling_max_8h")[11] == 11
    assert column(df, "rolling_std_8h")[2] == pytest.approx(0.5 ** 0.5)


def test_rolling_skips_missing(spark):
    df = add_rolling(readings(spark, hours([1, None, 3, 4, 5])), (3,), min_count=lambda w: 1)
    assert column(df, "rolling_mean_3h") == [None, 1, 1, 2, 3.5]


def test_rolling_of_last_rows(spark):
    df = add_rolling(readings(spark, hours(range(100))), (5,), min_count=lambda w: 1)
    assert column(df, "rolling_mean_5h")[-1] == 96


@pytest.mark.parametrize("width", [1, 5, 8, 9, 24, 97, 168, 1000, 4999])
def test_frame_parts_cover_the_frame_once(width):
    for size, parts in frame_plan([width]):
        covered = sorted(i for part, skip in parts for i in range(skip, skip + part))
        assert not parts or covered == list(range(size))
        assert len(parts) <= 16


def test_fill_takes_the_past_then_the_first_value(spark):
    df = fill_from_neighbours(readings(spark, hours([None, 2, None, 4, None])), ["meter_reading"], ["building_id"])
    assert column(df, "meter_reading") == [2, 2, 2, 4, 4]


def test_run_lengths(spark):
    df = readings(spark, hours([0, 1, 1, 0, 1])).withColumn("flag", F.col("meter_reading").cast("int"))
    assert column(add_run_length(df, "flag", "n"), "n") == [0, 2, 2, 0, 1]


def _scores(spark, values, **options):
    return column(modified_zscore(readings(spark, hours(values)), value="meter_reading", **options), "anomaly_score")


def test_score_and_flags(spark):
    scores = _scores(spark, [0.0, 0.1, -0.1, 10.0, -10.0, 0.05])
    assert [abs(s) > 3.5 for s in scores] == [False, False, False, True, True, False]


def test_score_fallbacks_without_spread_of_the_median(spark):
    values = [0, 0, 0, 0, 10]
    about_median = 0.6745 * 10 / (1.4826 * 20 ** 0.5)
    about_mean = 0.6745 * 10 / (1.4826 * 4)
    assert _scores(spark, values)[-1] == pytest.approx(about_median)
    assert _scores(spark, values, fallback="mean")[-1] == pytest.approx(about_mean)
    assert _scores(spark, values, fallback="zero") == [0] * 5
    with pytest.raises(ValueError):
        _scores(spark, values, fallback="other")


def test_constant_single_and_missing_scores(spark):
    assert _scores(spark, [5.0] * 20) == [0] * 20
    assert _scores(spark, [3.14]) == [0]
    assert _scores(spark, [1, None, 2, 3])[1] is None
    assert _scores(spark, [1, 2, 900], min_rows=10) == [0, 0, 0]


def test_empty_training_part_is_an_error(spark):
    with pytest.raises(ValueError, match="no training rows"):
        time_split(readings(spark, hours([1, 2, 3])), "INTERVAL 1 MONTH")


def test_month_cutoff_keeps_the_hour(spark):
    rows = readings(spark, [(1, 0, dt.datetime(2016, 5, 31, 7), 1.0), (1, 0, dt.datetime(2016, 4, 30, 6), 2.0),
                            (1, 0, dt.datetime(2016, 4, 30, 7), 3.0)])
    train, held_out = time_split(rows, "INTERVAL 1 MONTH")
    assert column(train, "meter_reading") == [2] and sorted(column(held_out, "meter_reading")) == [1, 3]


def test_unseen_meters_get_the_overall_mean(spark):
    train, held_out = readings(spark, hours([1, 3])), readings(spark, hours([9]) + hours([9], building=2))
    assert column(predict_group_mean(train, held_out), "predicted") == [2, 2]


def test_metrics_of_a_nonpositive_mean(spark):
    df = readings(spark, hours([-1, -3])).withColumn("predicted", F.lit(0.0))
    m = regression_metrics(df).first()
    assert m.cv_rmse == float("inf") and m.mae == 2 and m.rmse == pytest.approx(5 ** 0.5)


def test_audit_shares_and_ties(spark):
    summary = spark.createDataFrame(
        [(b, 0, 200, 0, 0.0, 0.0, 0.0, -5.0, 0, 0.0) for b in (3, 1, 2)] + [(9, 0, 50, 50, 9.0, 9.0, 9.0, 9.0, 9, 1.0)],
        "building_id int, meter int, total_hours long, anomaly_hours long, mean_anomaly_score double, "
        "max_anomaly_score double, mean_residual double, total_excess double, max_streak long, anomaly_rate double")
    meta = spark.createDataFrame([(1, 0, "Office", 10.0), (2, 0, "Office", None)],
                                 "building_id int, site_id int, primary_use string, square_feet double")
    audit = frame(build_audit_list(summary, meta), "rank")
    assert list(audit.columns) == AUDIT_COLUMNS
    assert list(audit["building_id"]) == [1, 2, 3] and list(audit["priority_score"]) == [0, 0, 0]
    assert build_audit_list(summary, meta, AuditSettings(min_hours=10), top_n=2).count() == 2
    assert "max_streak" not in build_audit_list(summary.drop("max_streak"), meta).columns


def test_quality_of_an_empty_level(spark):
    report = quality_report(readings(spark, hours([None, None])).withColumn("site_id", F.lit(4))).first()
    assert (report.pct_missing, report.mean_reading, report.max_reading) == (100, 0, 0)


def test_building_age_without_any_year(spark):
    df = spark.createDataFrame([(1, None, 9.0), (2, None, None)], "building_id int, year_built double, square_feet double")
    assert [r.building_age for r in describe_buildings(df).collect()] == [None, None]
    dated = spark.createDataFrame([(1, 1990.0, 9.0), (2, 2015.0, 1.0)], "building_id int, year_built double, square_feet double")
    assert {r.building_id: r.building_age for r in describe_buildings(dated).collect()} == {1: 26, 2: 1}


def test_use_codes_are_alphabetical(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "building_id int, primary_use string")
    assert {r.building_id: r.primary_use_code for r in with_use_codes(df).collect()} == {1: 1, 2: 0, 3: -1}


@pytest.mark.parametrize("day, site, expected", [
    ("2016-07-04", 0, 1), ("2016-07-04", 1, 0), ("2016-12-26", 0, 1), ("2016-12-27", 1, 1), ("2016-03-25", 1, 1),
    ("2016-03-28", 12, 1), ("2016-07-01", 7, 1), ("2016-11-24", 99, 1), ("2021-12-31", 3, 1), ("2016-05-30", 5, 1),
    ("2016-10-31", 12, 1), ("2016-11-23", 0, 0),
])
def test_holidays(spark, day, site, expected):
    row = spark.createDataFrame([(site, dt.datetime.fromisoformat(day))], "site_id int, timestamp timestamp_ntz")
    assert mark_holidays(row).first().is_holiday == expected


def test_missing_is_kept_by_clips_and_weather(spark):
    df = spark.createDataFrame([(None, 5.0, None), (20.0, 20.0, None)], "air double, dew double, wind double").select(
        clip(F.col("air"), 0, 1).alias("clipped"), relative_humidity(F.col("air"), F.col("dew")).alias("humidity"),
        wind_chill(F.col("air"), F.col("wind")).alias("chill"))
    first, second = df.collect()
    assert tuple(first) == (None, None, None)
    assert second.clipped == 1 and second.humidity == pytest.approx(100) and second.chill == 20


def test_duplicate_dimension_keys_are_found(spark):
    df = readings(spark, hours([1]) + hours([2]))
    assert duplicate_keys(df, ["building_id", "timestamp"]).count() == 1


def test_streaks_and_summary(spark):
    values = [0, 1] * 10 + [500, 500, 500] + [0, 1] * 5
    df = readings(spark, hours(values)).withColumn("residual", F.col("meter_reading"))
    detected = detect_anomalies(df)
    assert max(column(detected, "anomaly_streak")) == 3
    summary = summarize_meters(detected).first()
    assert (summary.total_hours, summary.anomaly_hours, summary.max_streak) == (33, 3, 3)


def test_feature_path_has_one_shuffle_and_one_sort(spark):
    """Caps, outages, lags and rolling statistics keep the one order of the series."""
    from wattline.config import CleaningSettings
    from wattline.functions.groups import LongGroups
    from wattline.operators.features import add_sequence_features

    whole = LongGroups(("building_id", "meter"), 10**9, None)
    df = add_sequence_features(readings(spark, hours([1.0] * 30)), cleaning=CleaningSettings(), long=whole)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("least", [1, 2, 7, 8, 9, 16, 48])
def test_outages_by_their_definition(spark, least):
    import numpy as np

    rng = np.random.default_rng(least)
    values = []
    while len(values) < 400:
        values += [0.0] * int(rng.choice([1, least - 1, least, least + 1, 2 * least + 3])) + [[1.0], [None], [2.0, 3.0]][rng.integers(3)]
    wanted, i = list(values), 0
    while i < len(values):
        j = i
        while j < len(values) and values[j] == 0:
            j += 1
        if j - i >= least:
            wanted[i:j] = [None] * (j - i)
        i = max(j, i + 1)
    assert column(null_zero_runs(readings(spark, hours(values)), least), "meter_reading") == wanted
