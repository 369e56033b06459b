"""The jobs: quality report, exploration, feature table, model comparison, audit run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.config import Settings
from wattline.functions.groups import LongGroups, find_long_groups
from wattline.functions.sequence import add_lags, add_rolling, null_zero_runs
from wattline.operators import explore
from wattline.operators.anomaly import anomaly_totals, detect_anomalies, severity_by_site, summarize_meters
from wattline.operators.audit import build_audit_list
from wattline.operators.cleaning import (
    cap_outliers, clean_readings, drop_incomplete, quality_report,
)
from wattline.operators.features import add_row_features, add_sequence_features
from wattline.operators.joins import join_buildings, join_weather
from wattline.operators.models import Forecast, compare_models, feature_importance, fit_boosted_trees, fit_forest
from wattline.operators.split import (
    improvement_pct, predict_group_mean, predict_persistence, regression_metrics, time_split, with_residual,
)
from wattline.schemas import KEYS, ORDER, TARGET, WEATHER_COLUMNS
from wattline.session import materialize
from wattline.sources.readings import load_dataset
from wattline.sources.sinks import (
    save_model, summary_row, write_audit_list, write_predictions, write_summary, write_table,
)


def feature_table(
    readings: DataFrame, buildings: DataFrame, weather: DataFrame,
    cfg: Settings = Settings(), long: LongGroups | None = None,
) -> DataFrame:
    """Cleaned readings with every feature, before incomplete rows are dropped.

    Only the columns the sequence work needs travel through its shuffle. Its result is stored, and the wide dimension
    columns are joined to the stored rows: in one plan, every condition on a feature would be computed inside the stage of
    the rolling statistics, which then is too large to be compiled.
    """
    return with_dimensions(materialize(cleaned_series(readings, buildings, cfg, long)), buildings, weather, cfg)


def cleaned_series(
    readings: DataFrame, buildings: DataFrame, cfg: Settings = Settings(), long: LongGroups | None = None
) -> DataFrame:
    """Cleaned readings with their site, lags and rolling statistics: all that wants a meter's rows in order."""
    if long is None:
        long = find_long_groups(readings)
    rows = clean_readings(join_buildings(readings, buildings, ["site_id"]), cfg.cleaning)
    return add_sequence_features(rows, cfg.features, cfg.cleaning, long)


def with_dimensions(series: DataFrame, buildings: DataFrame, weather: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """A cleaned series with the other columns of its building, the weather and the features of single rows."""
    rest = [c for c in buildings.columns if c not in ("building_id", "site_id")]
    return add_row_features(join_weather(join_buildings(series, buildings, rest), weather), cfg.features)


def cleaned_readings(
    readings: DataFrame, buildings: DataFrame, cfg: Settings = Settings(), long: LongGroups | None = None
) -> DataFrame:
    """Converted, capped and outage-free readings with their site; no other dimension takes part."""
    if long is None:
        long = find_long_groups(readings)
    rows = clean_readings(join_buildings(readings, buildings, ["site_id"]), cfg.cleaning)
    rows = cap_outliers(rows, cfg.cleaning.cap_quantile, long=long)
    return null_zero_runs(rows, cfg.cleaning.min_zero_streak, long=long)


def quality_job(readings: DataFrame, buildings: DataFrame, weather: DataFrame, long: LongGroups | None = None) -> DataFrame:
    """The report reads sites and readings only, so weather is not joined."""
    return quality_report(cleaned_readings(readings, buildings, long=long))


def explore_job(readings: DataFrame, buildings: DataFrame, weather: DataFrame, out: str | None = None) -> dict[str, DataFrame]:
    """All exploratory tables over the cleaned data set; written below ``out`` if given.

    What the tables read of the data set is stored once, and both tables of quantiles per meter share one selection.
    """
    df = load_dataset(readings, buildings, weather)
    df = materialize(df.select(*[c for c in ["site_id", *KEYS, ORDER, TARGET, *WEATHER_COLUMNS] if c in df.columns]))
    quantiles = explore.meter_quantiles(df)
    sites = explore.site_comparison(df)
    tables = {
        "dataset": explore.dataset_summary(df),
        "meter_types": explore.buildings_per_meter_type(df),
        "uses": explore.buildings_per_use(buildings),
        "meter_distribution": explore.meter_distribution(df, quantiles=quantiles),
        "reading_histogram": explore.clipped_histogram(df, caps=quantiles.select("meter", "_cap")),
        "profiles": explore.time_profiles(df),
        "extremes": explore.profile_extremes(df),
        "missingness": explore.missingness(df),
        "temperature_response": explore.response_curve(df),
        "correlations": explore.correlations(df),
        "sites": sites,
        "site_leaders": explore.site_leaders(sites),
    }
    for name, table in tables.items() if out else ():
        write_table(table, f"{out}/eda/{name}", "json")
    return tables


def raw_feature_job(readings: DataFrame, buildings: DataFrame, weather: DataFrame) -> DataFrame:
    """Joined, uncleaned readings with date parts, lags and rolling mean and
    deviation without a minimum fill. Weekdays count from Sunday = 1 here."""
    long = find_long_groups(readings)
    rows = add_rolling(
        add_lags(readings, long=long), statistics=("mean", "std"), min_count=lambda width: 1, long=long)
    ts = F.col(ORDER)
    return join_weather(join_buildings(rows, buildings), weather).withColumns({
        "hour": F.hour(ts),
        "dayofweek": F.dayofweek(ts),
        "month": F.month(ts),
        "is_weekend": F.dayofweek(ts).isin(1, 7).cast("int"),
        "day_of_year": F.dayofyear(ts),
    }).drop("lag_diff_24h")


def modelling_rows(
    readings: DataFrame, buildings: DataFrame, weather: DataFrame, cfg: Settings, long: LongGroups | None = None,
    series: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Complete feature rows, stored once, and their train and held-out parts; of ``cleaned_series`` if that is given."""
    table = feature_table(readings, buildings, weather, cfg, long) if series is None else with_dimensions(series, buildings, weather, cfg)
    rows = materialize(drop_incomplete(table))
    return (rows, *time_split(rows, cfg.holdout))


def compare_job(
    readings: DataFrame, buildings: DataFrame, weather: DataFrame, cfg: Settings = Settings(), out: str | None = None
) -> DataFrame:
    """Metrics of both baselines and both learners on the same split, with its row counts; written to ``out`` if given."""
    _, train, held_out = modelling_rows(readings, buildings, weather, cfg)
    trees, forest = fit_boosted_trees(train, held_out, cfg.booster), fit_forest(train, held_out, cfg.booster)
    sizes = [part.agg(F.count(F.lit(1))).scalar() for part in (train, held_out)]
    table = compare_models([
        ("meter_mean", predict_group_mean(train, held_out), 0.0),
        ("persistence", predict_persistence(train, held_out), 0.0),
        (forest.name, forest.predictions, forest.train_seconds),
        (trees.name, trees.predictions, trees.train_seconds),
    ]).withColumns({"n_train": sizes[0], "n_val": sizes[1]})
    if out:
        write_table(table, f"{out}/model_comparison", "json")
    return table


@dataclass(frozen=True)
class AuditRun:
    predictions: DataFrame
    scored: DataFrame
    summary: DataFrame
    sites: DataFrame
    audit: DataFrame


def baseline_audit(
    readings: DataFrame, buildings: DataFrame, cfg: Settings = Settings()
) -> DataFrame:
    """Audit list from the meter-mean forecast; lags must exist, other features need not.

    No dimension except the site of a building is needed before the ranking.
    """
    long = find_long_groups(readings)
    rows = clean_readings(join_buildings(readings, buildings, ["site_id"]), cfg.cleaning)
    rows = add_sequence_features(rows, cfg.features, cfg.cleaning, long, statistics=("mean",))
    needed = [f"lag_{n}h" for n in cfg.features.lags] + [f"rolling_mean_{w}h" for w in cfg.features.windows]
    rows = materialize(drop_incomplete(rows, features=needed).select(*KEYS, ORDER, TARGET))
    train, held_out = time_split(rows, cfg.holdout)
    predictions = predict_group_mean(train, held_out)
    scored = detect_anomalies(with_residual(predictions), cfg=cfg.anomaly, long=long)
    return build_audit_list(summarize_meters(scored), buildings, cfg.audit)


def _importance(forecast: Forecast) -> Column:
    """The leading inputs by name; empty for a forecast without a tree ensemble."""
    stages = forecast.model.stages
    top = feature_importance(forecast).collect() if stages and hasattr(stages[-1], "featureImportances") else []
    pairs = [F.struct(F.lit(r["feature"]).alias("feature"), F.lit(r["importance"]).alias("importance")) for r in top]
    return F.array(*pairs) if pairs else F.array().cast("array<struct<feature:string,importance:double>>")


def audit_job(
    readings: DataFrame, buildings: DataFrame, weather: DataFrame, out: str, cfg: Settings = Settings(),
    fit: Callable[..., Forecast] = fit_boosted_trees,
) -> AuditRun:
    """The full run; every result table is written below ``out``.

    The readings are cleaned once: the series with its lags and rolling statistics is stored, and the quality report and
    the model's rows are read from it.
    """
    spark = readings.sparkSession
    long = find_long_groups(readings)
    series = materialize(cleaned_series(readings, buildings, cfg, long))
    write_table(quality_report(series), f"{out}/data_quality")
    rows, train, held_out = modelling_rows(readings, buildings, weather, cfg, long, series)
    forecast = fit(train, held_out, cfg.booster)
    save_model(forecast.model, f"{out}/model")
    predictions = materialize(forecast.predictions.select(*KEYS, ORDER, TARGET, "site_id", "predicted"))
    write_predictions(predictions, f"{out}/predictions")
    scored = materialize(detect_anomalies(with_residual(predictions), cfg=cfg.anomaly, long=long))
    summary = materialize(summarize_meters(scored).orderBy(F.desc("anomaly_rate"), *KEYS))
    run = AuditRun(
        predictions, scored, summary, severity_by_site(scored), build_audit_list(summary, buildings, cfg.audit))
    write_table(summary, f"{out}/anomaly_summary")
    write_table(run.sites, f"{out}/site_severity")
    write_audit_list(run.audit, f"{out}/audit_list")
    model = regression_metrics(predictions)
    mean = regression_metrics(predict_group_mean(train, held_out))
    write_summary(summary_row(
        spark,
        rows=rows.agg(F.count(F.lit(1)).alias("modelled")),
        train_rows=train.agg(F.count(F.lit(1))).scalar(), val_rows=held_out.agg(F.count(F.lit(1))).scalar(),
        n_features=len(forecast.features), importance=_importance(forecast),
        model=model, meter_mean=mean, persistence=regression_metrics(predict_persistence(train, held_out)),
        improvement_pct=F.round(improvement_pct(model.select("rmse").scalar(), mean.select("rmse").scalar()), 2),
        anomalies=anomaly_totals(scored),
        audit_entries=run.audit.agg(F.count(F.lit(1)).alias("meters")),
    ), f"{out}/summary")
    return run
