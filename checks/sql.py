"""Named SQL tables (DuckDB) the comparison queries are built from."""

from __future__ import annotations

import re


def _readings(building: str) -> str:
    return f"""
WITH h AS (SELECT {building} AS building_id,
                  CASE WHEN event_type IN ('click','view') THEN 0 ELSE 1 END AS meter,
                  date_trunc('hour', ts) AS ts_hour,
                  CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS r
           FROM events GROUP BY 1, 2, 3),
     b AS (SELECT min(ts_hour) AS lo, max(ts_hour) AS hi FROM h),
     t AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp FROM b),
     k AS (SELECT DISTINCT building_id, meter FROM h)
SELECT k.building_id, k.meter, t.timestamp, COALESCE(h.r, 0.0) AS meter_reading
FROM k CROSS JOIN t
LEFT JOIN h ON h.building_id = k.building_id AND h.meter = k.meter AND h.ts_hour = t.timestamp"""


W = "PARTITION BY building_id, meter ORDER BY timestamp"


def runs(source: str, flag: str) -> str:
    """Rows of ``source`` with ``run_rows``, the length of their run of equal flags."""
    return f"""
SELECT * EXCLUDE (f, c, run_no), count(*) OVER (PARTITION BY building_id, meter, run_no) AS run_rows, f AS run_flag
FROM (SELECT *, sum(c) OVER ({W}) AS run_no
      FROM (SELECT *, {flag} AS f,
                   CASE WHEN ({flag}) = lag({flag}) OVER ({W}) THEN 0 ELSE 1 END AS c FROM {source}))"""


def outages(source: str) -> str:
    return f"""
SELECT * REPLACE (CASE WHEN run_flag = 1 AND run_rows >= 48 THEN NULL ELSE meter_reading END AS meter_reading)
FROM ({runs(source, "CASE WHEN meter_reading = 0 THEN 1 ELSE 0 END")})"""


def capped(source: str, q: float = 0.999) -> str:
    return f"""
SELECT s.* REPLACE (CASE WHEN s.meter_reading > c.cap THEN c.cap ELSE s.meter_reading END AS meter_reading)
FROM {source} s JOIN (SELECT building_id, meter, quantile_cont(meter_reading, {q}) AS cap
                      FROM {source} GROUP BY 1, 2) c USING (building_id, meter)"""


def rolled(source: str, widths=(24, 168), stats=("mean", "std", "min", "max"), minimum=None, last: int = 1) -> str:
    functions = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    columns, frames = [], []
    for w in widths:
        least = max(1, w // 4) if minimum is None else minimum
        end = f"{last} PRECEDING" if last else "CURRENT ROW"
        frames.append(f"w{w} AS ({W} ROWS BETWEEN {w - 1 + last} PRECEDING AND {end})")
        for s in stats:
            value = f"{functions[s]}(meter_reading) OVER w{w}"
            if s == "std":
                value = f"round({value}, 6)"
            columns.append(f"CASE WHEN count(meter_reading) OVER w{w} >= {least} THEN {value} END AS rolling_{s}_{w}h")
    return f"SELECT *, {', '.join(columns)} FROM {source} WINDOW {', '.join(frames)}"


def scored(source: str, value: str, fallback: str = "median", minimum: int = 10,
           keys: str = "building_id, meter") -> str:
    spread = {
        "median": f"sqrt(avg(({value} - med) * ({value} - med)) OVER g)",
        "mean": f"stddev_pop({value}) OVER g",
        "zero": "0.0",
    }[fallback]
    group = f"(PARTITION BY {keys})" if keys else "()"
    return f"""
SELECT * EXCLUDE (med, n, mad, spread),
       CASE WHEN n < {minimum} THEN 0.0
            WHEN mad > 0 THEN 0.6745 * ({value} - med) / mad
            WHEN spread > 0 THEN 0.6745 * ({value} - med) / (1.4826 * spread)
            ELSE 0.0 END AS anomaly_score
FROM (SELECT *, median(abs({value} - med)) OVER g AS mad, {spread} AS spread
      FROM (SELECT *, median({value}) OVER g AS med, count({value}) OVER g AS n FROM {source} WINDOW g AS {group})
      WINDOW g AS {group})"""


def holdout(source: str, part: str) -> str:
    sign = {"train": "<", "val": ">="}[part]
    return f"SELECT * FROM {source} WHERE timestamp {sign} (SELECT max(timestamp) - INTERVAL 7 DAY FROM {source})"


AUDIT = """
SELECT a.*, CASE WHEN square_feet > 0 THEN total_excess / square_feet ELSE 0.0 END AS excess_per_sqft,
       max_streak / total_hours AS streak_severity
FROM (SELECT s.*, m.site_id, m.primary_use, m.square_feet
      FROM {summary} s LEFT JOIN meta m USING (building_id) WHERE total_hours >= {hours}) a"""

_EASTER = """
SELECT y, make_date(CAST(y AS BIGINT), CAST((e + w - 7 * s + 114) // 31 AS BIGINT),
                    CAST((e + w - 7 * s + 114) % 31 + 1 AS BIGINT)) AS easter
FROM (SELECT *, (a + 11 * e + 22 * w) // 451 AS s
      FROM (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - e - c % 4) % 7 AS w
            FROM (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS e
                  FROM (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM range(1990, 2031) r(y)))))"""

# Every date of 1990-2030 with the countries that keep it as a holiday.
_HOLIDAYS = f"""
WITH d AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS date),
     p AS (SELECT date, year(date) AS y, month(date) AS m, day(date) AS dd, isodow(date) AS wd,
                  (day(date) + 6) // 7 AS nth, day(last_day(date)) - day(date) < 7 AS final FROM d),
     e AS ({_EASTER}),
     q AS (SELECT p.*, e.easter FROM p JOIN e USING (y)),
     us_fixed AS (SELECT date FROM q WHERE (m = 1 AND dd = 1) OR (m = 7 AND dd = 4) OR (m = 11 AND dd = 11)
                  OR (m = 12 AND dd = 25) OR (m = 6 AND dd = 19 AND y >= 2021)),
     moved AS (SELECT date, m, dd, y FROM q WHERE isodow(date) >= 6)
SELECT 'US' AS country, date FROM us_fixed
UNION SELECT 'US', CASE isodow(date) WHEN 6 THEN date - 1 WHEN 7 THEN date + 1 END FROM us_fixed WHERE isodow(date) >= 6
UNION SELECT 'US', date FROM q WHERE (wd = 1 AND ((m IN (1, 2) AND nth = 3) OR (m = 5 AND final) OR (m = 9 AND nth = 1)
      OR (m = 10 AND nth = 2))) OR (m = 11 AND wd = 4 AND nth = 4)
UNION SELECT 'UK', date FROM q WHERE (m = 1 AND dd = 1) OR date = easter - 2 OR (m = 12 AND dd IN (25, 26))
      OR (wd = 1 AND m = 5 AND nth = 1 AND y NOT IN (1995, 2020)) OR (m = 5 AND dd = 8 AND y IN (1995, 2020))
      OR (wd = 1 AND m = 5 AND final AND y NOT IN (2002, 2012, 2022))
      OR date IN ('1999-12-31', '2002-06-03', '2002-06-04', '2011-04-29', '2012-06-04', '2012-06-05',
                  '2022-06-02', '2022-06-03', '2022-09-19', '2023-05-08')
UNION SELECT c, date + CAST(8 - isodow(date) AS INTEGER) FROM moved, (VALUES ('UK'), ('IE'), ('CA')) v(c) WHERE m = 1 AND dd = 1
UNION SELECT c, date + 2 FROM moved, (VALUES ('UK'), ('IE')) v(c) WHERE m = 12 AND dd IN (25, 26)
UNION SELECT 'IE', date + CAST(8 - isodow(date) AS INTEGER) FROM moved WHERE m = 3 AND dd = 17
UNION SELECT 'CA', date + CAST(8 - isodow(date) AS INTEGER) FROM moved WHERE (m = 7 AND dd = 1) OR (m = 12 AND dd = 25)
UNION SELECT 'CA', date FROM q WHERE (dd = 1 AND m IN (1, 7)) OR (m = 12 AND dd = 25) OR date = easter - 2
      OR (wd = 1 AND m = 9 AND nth = 1)
UNION SELECT 'IE', date FROM q WHERE (m = 1 AND dd = 1) OR (m = 3 AND dd = 17) OR (m = 12 AND dd IN (25, 26))
      OR date = easter + 1 OR (wd = 1 AND ((m IN (5, 6, 8) AND nth = 1 AND (m <> 5 OR y >= 1994)) OR (m = 10 AND final)))
      OR (y >= 2023 AND m = 2 AND ((dd = 1 AND wd = 5) OR (wd = 1 AND nth = 1 AND isodow(make_date(y, 2, 1)) <> 5)))"""

COUNTRY = ("CASE WHEN {site} IN (1, 5) THEN 'UK' WHEN {site} IN (7, 11) THEN 'CA' "
           "WHEN {site} = 12 THEN 'IE' ELSE 'US' END")

HUMIDITY = ("least(greatest(100 * exp(17.625 * dew_temperature / (243.04 + dew_temperature)) "
            "/ exp(17.625 * air_temperature / (243.04 + air_temperature)), 0), 100)")
CHILL = ("CASE WHEN air_temperature < 10 THEN 13.12 + 0.6215 * air_temperature "
         "- 11.37 * pow(CASE WHEN wind_speed IS NOT NULL THEN greatest(wind_speed, 0.1) END, 0.16) "
         "+ 0.3965 * air_temperature * pow(CASE WHEN wind_speed IS NOT NULL THEN greatest(wind_speed, 0.1) END, 0.16) "
         "ELSE air_temperature END")

TABLES = {
    "rd": _readings("user_id"),
    "rd_dense": _readings("user_id % 8"),
    "ev": """SELECT user_id AS building_id, CASE WHEN event_type IN ('click','view') THEN 0 ELSE 1 END AS meter,
                    date_trunc('hour', ts) AS timestamp, CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) AS meter_reading
             FROM events""",
    "meta": """SELECT c_custkey AS building_id, c_nationkey % 16 AS site_id, c_mktsegment AS primary_use,
                      CASE WHEN c_acctbal > 0 THEN c_acctbal * 10 END AS square_feet,
                      CASE WHEN c_custkey % 7 <> 0 THEN 1950 + c_custkey % 60 END AS year_built FROM customer""",
    "described": """SELECT m.*, (SELECT max(year_built) + 1 FROM meta) - year_built AS building_age,
                           ln(1 + square_feet) AS log_square_feet,
                           COALESCE(CAST(u.code AS INTEGER), -1) AS primary_use_code
                    FROM meta m LEFT JOIN (SELECT primary_use, row_number() OVER (ORDER BY primary_use) - 1 AS code
                                           FROM (SELECT DISTINCT primary_use FROM meta)) u USING (primary_use)""",
    "wx": """SELECT *, CASE WHEN i % 5 <> 0 THEN low / 20 - 6 END AS dew_temperature,
                    CASE WHEN i % 3 <> 0 THEN high / 50 END AS wind_speed,
                    CASE WHEN i % 4 <> 0 THEN CAST(i % 9 AS DOUBLE) END AS cloud_coverage,
                    CASE WHEN i % 2 <> 0 THEN CAST(i % 7 AS DOUBLE) END AS precip_depth_1_hr,
                    CASE WHEN i % 6 <> 0 THEN 1000 + CAST(i % 31 AS DOUBLE) END AS sea_level_pressure,
                    CASE WHEN i % 10 <> 0 THEN CAST(i % 36 AS DOUBLE) * 10 END AS wind_direction
             FROM (SELECT CAST(user_id % 16 AS INT) AS site_id, date_trunc('hour', ts) AS timestamp,
                          CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / 10 - 5 AS air_temperature,
                          CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS low, CAST(max(value) AS DOUBLE) AS high,
                          min(event_id) AS i FROM events GROUP BY 1, 2)""",
    "wx_filled": """
SELECT site_id, timestamp, {neighbours},
       COALESCE(cloud_coverage, (SELECT median(cloud_coverage) FROM wx)) AS cloud_coverage,
       COALESCE(precip_depth_1_hr, 0.0) AS precip_depth_1_hr, COALESCE(wind_direction, 0.0) AS wind_direction
FROM wx WINDOW p AS (PARTITION BY site_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING),
               n AS (PARTITION BY site_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
""".format(neighbours=", ".join(
        f"COALESCE(last_value({c} IGNORE NULLS) OVER p, first_value({c} IGNORE NULLS) OVER n) AS {c}"
        for c in ("air_temperature", "dew_temperature", "wind_speed", "sea_level_pressure"))),
    "holidays": _HOLIDAYS,
    "rd_null": outages("rd"),
    "joined": """SELECT r.*, m.* EXCLUDE (building_id), w.* EXCLUDE (site_id, timestamp)
                 FROM rd r LEFT JOIN described m USING (building_id)
                 LEFT JOIN wx_filled w ON w.site_id = m.site_id AND w.timestamp = r.timestamp""",
    "cleaned": """SELECT * REPLACE (CASE WHEN site_id = 0 AND meter = 0 THEN meter_reading * 0.293071
                                        ELSE meter_reading END AS meter_reading)
                  FROM joined WHERE meter_reading IS NULL OR meter_reading >= 0""",
    "cleaned_capped": capped("cleaned"),
    "dataset": outages("cleaned_capped"),
    "val": holdout("rd_dense", "val"),
    "train": holdout("rd_dense", "train"),
    "mean_forecast": """SELECT v.*, COALESCE(m.mean, (SELECT avg(meter_reading) FROM train)) AS predicted
                        FROM val v LEFT JOIN (SELECT building_id, meter, avg(meter_reading) AS mean
                                              FROM train GROUP BY 1, 2) m USING (building_id, meter)""",
    "residuals": "SELECT *, meter_reading - predicted AS residual FROM mean_forecast",
    "flagged": f"""SELECT *, CASE WHEN abs(anomaly_score) > 3.5 THEN 1 ELSE 0 END AS is_anomaly
                   FROM ({scored("residuals", "residual")})""",
    "detected": f"""SELECT *, run_flag * run_rows AS anomaly_streak FROM ({runs("flagged", "is_anomaly")})""",
    "summary": """SELECT building_id, meter, count(is_anomaly) AS total_hours, sum(is_anomaly) AS anomaly_hours,
                         avg(anomaly_score) AS mean_anomaly_score, max(abs(anomaly_score)) AS max_anomaly_score,
                         avg(residual) AS mean_residual, sum(greatest(residual, 0.0)) AS total_excess,
                         max(anomaly_streak) AS max_streak, sum(is_anomaly) / count(is_anomaly) AS anomaly_rate
                  FROM detected GROUP BY 1, 2""",
}

# The flagship starts from converted, capped and outage-free dense readings.
TABLES |= {
    "flag_clean": """SELECT r.* REPLACE (CASE WHEN m.site_id = 0 AND r.meter = 0 THEN meter_reading * 0.293071
                                              ELSE meter_reading END AS meter_reading)
                     FROM rd_dense r LEFT JOIN meta m USING (building_id)""",
    "flag_capped": capped("flag_clean"),
    "flag_null": outages("flag_capped"),
    "flag_rows": f"""SELECT building_id, meter, timestamp, meter_reading FROM (
                       SELECT *, lag(meter_reading, 24) OVER w AS l1, lag(meter_reading, 168) OVER w AS l2,
                              count(meter_reading) OVER ({W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS c1,
                              count(meter_reading) OVER ({W} ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING) AS c2
                       FROM flag_null WINDOW w AS ({W}))
                     WHERE meter_reading IS NOT NULL AND l1 IS NOT NULL AND l2 IS NOT NULL AND c1 >= 6 AND c2 >= 42""",
    "flag_val": holdout("flag_rows", "val"),
    "flag_train": holdout("flag_rows", "train"),
    "flag_res": """SELECT v.*, meter_reading - COALESCE(m.mean, (SELECT avg(meter_reading) FROM flag_train)) AS residual
                   FROM flag_val v LEFT JOIN (SELECT building_id, meter, avg(meter_reading) AS mean
                                              FROM flag_train GROUP BY 1, 2) m USING (building_id, meter)""",
    "flag_flags": f"""SELECT *, CASE WHEN abs(anomaly_score) > 3.5 THEN 1 ELSE 0 END AS is_anomaly
                      FROM ({scored("flag_res", "residual")})""",
    "flag_detected": f"SELECT *, run_flag * run_rows AS anomaly_streak FROM ({runs('flag_flags', 'is_anomaly')})",
}
TABLES["flag_summary"] = TABLES["summary"].replace("FROM detected", "FROM flag_detected")
TABLES["audit_rows"] = AUDIT.format(summary="summary", hours=100)
TABLES["flag_audit_rows"] = AUDIT.format(summary="flag_summary", hours=100)

_ORDER = list(TABLES)


def run_tables(rows: str) -> None:
    """Register the tables of a whole run, from its complete feature rows to the audit list."""
    TABLES["run_rows"] = rows
    for name in ("val", "train", "res", "flags", "detected", "summary"):
        TABLES[f"run_{name}"] = TABLES[f"flag_{name}"].replace("flag_", "run_")
    TABLES["run_audit_rows"] = AUDIT.format(summary="run_summary", hours=24)
    _ORDER[:] = list(TABLES)


def audit(rows: str) -> str:
    shares = " + ".join(
        f"CASE WHEN max({c}) OVER () > 0 THEN {c} / max({c}) OVER () ELSE 0.0 END * {w}"
        for c, w in (("anomaly_rate", 0.3), ("max_anomaly_score", 0.25), ("excess_per_sqft", 0.25), ("streak_severity", 0.2)))
    return f"""
SELECT row_number() OVER (ORDER BY priority_score DESC, building_id, meter) AS rank, building_id, meter, site_id,
       primary_use, round(square_feet, 6) AS square_feet, round(anomaly_rate, 6) AS anomaly_rate, CAST(anomaly_hours AS BIGINT) AS anomaly_hours,
       total_hours, CAST(max_streak AS BIGINT) AS max_streak, round(mean_anomaly_score, 6) AS mean_anomaly_score,
       round(max_anomaly_score, 6) AS max_anomaly_score, round(total_excess, 3) AS total_excess,
       round(excess_per_sqft, 6) AS excess_per_sqft, round(priority_score, 6) AS priority_score
FROM (SELECT *, {shares} AS priority_score FROM {rows})"""


def query(body: str) -> str:
    """``body`` preceded by the named tables it uses, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(TABLES[name])

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({TABLES[n]})" for n in sorted(needed, key=_ORDER.index))
    return f"WITH {ctes}\n{body}"
