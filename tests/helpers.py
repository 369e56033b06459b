import datetime as dt

import numpy as np
import pandas as pd

START = dt.datetime(2024, 1, 1)
SCHEMA = "building_id int, meter int, timestamp timestamp_ntz, meter_reading double"


def hours(values, building=1, meter=0, start=START):
    return [(building, meter, start + dt.timedelta(hours=i), None if v is None else float(v))
            for i, v in enumerate(values)]


def readings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def uneven(seed=7):
    """Three meters: a dense one, one with gaps of days, a short one; zeros and nulls mixed in."""
    rng = np.random.default_rng(seed)
    rows = []
    for building, n, step in ((1, 300, 1), (2, 260, 5), (3, 30, 1)):
        t = START
        for _ in range(n):
            t += dt.timedelta(hours=int(rng.integers(1, step + 1)) if rng.random() > 0.02 else 24 * step)
            kind = rng.random()
            value = None if kind < 0.05 else 0.0 if kind < 0.3 else float(rng.integers(1, 1000))
            rows.append((building, 0, t, value))
    # A long outage across many rows of the dense meter.
    dense = [i for i, r in enumerate(rows) if r[0] == 1]
    for i in dense[90:200]:
        rows[i] = (*rows[i][:3], 0.0)
    return rows


def frame(df, *keys):
    keys = list(keys) or ["building_id", "meter", "timestamp"]
    return df.toPandas().sort_values(keys).reset_index(drop=True)


def column(df, name):
    return [None if pd.isna(v) else v for v in frame(df)[name]]


def assert_same(left, right, *keys):
    a, b = frame(left, *keys), frame(right, *keys)
    pd.testing.assert_frame_equal(a[sorted(a)], b[sorted(b)], check_dtype=False, rtol=1e-9, atol=1e-7)
