"""Time the headline queries with every output column computed (``noop`` sink).

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
The readings are derived once and stored, as a user would have them, so the
figures are for the operators and not for the stand-in tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import SETTINGS  # noqa: E402
from wattline.functions.sequence import add_lags, add_rolling, null_zero_runs  # noqa: E402
from wattline.operators import anomaly, cleaning, explore, split  # noqa: E402
from wattline.plans import jobs  # noqa: E402
from wattline.session import build_session, materialize  # noqa: E402
from wattline.sources import standin  # noqa: E402
from wattline.sources.readings import describe_buildings, load_dataset  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")

    buildings = materialize(describe_buildings(standin.buildings(spark, sf_dir)))
    weather = materialize(cleaning.fill_weather(standin.weather(spark, sf_dir)))
    rd = materialize(standin.readings(spark, sf_dir))
    dense = materialize(standin.readings(spark, sf_dir, buildings=8))

    def forecast(rows):
        return split.with_residual(split.predict_group_mean(*split.time_split(rows, SETTINGS.holdout, check=False)))

    queries = {
        "scan": lambda: rd,
        "cap_outliers": lambda: cleaning.cap_outliers(rd),
        "zero_streaks": lambda: null_zero_runs(rd),
        "lags": lambda: add_lags(rd),
        "rolling": lambda: add_rolling(rd),
        "load_dataset": lambda: load_dataset(rd, buildings, weather),
        "raw_features": lambda: jobs.raw_feature_job(rd, buildings, weather),
        "feature_table": lambda: jobs.feature_table(rd, buildings, weather, SETTINGS),
        "modified_zscore": lambda: anomaly.modified_zscore(rd, value="meter_reading"),
        "detect_anomalies": lambda: anomaly.detect_anomalies(forecast(rd)),
        "meter_summary": lambda: anomaly.summarize_meters(anomaly.detect_anomalies(forecast(rd))),
        "quality": lambda: jobs.quality_job(rd, buildings, weather),
        "meter_distribution": lambda: explore.meter_distribution(rd),
        "site_comparison": lambda: explore.site_comparison(
            rd.join(buildings.select("building_id", "site_id"), "building_id", "left")),
        "audit_list": lambda: jobs.baseline_audit(rd, buildings, SETTINGS),
        "audit_list_dense": lambda: jobs.baseline_audit(dense, buildings, SETTINGS),
    }
    queries["feature_table"]().write.format("noop").mode("overwrite").save()  # compile once before timing
    seconds = {}
    for name, build in queries.items():
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    rows = rd.count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "readings": rows,
        "feature_rows_per_sec": round(rows / seconds["feature_table"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
