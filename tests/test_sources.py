"""Readers: wide ids, missing values, bad values, streams like batches, bounded reads."""

import datetime as dt

import pytest
from helpers import frame, hours, readings

from wattline.schemas import READINGS
from wattline.sources.readings import first_rows, read_readings
from wattline.streaming.ingest import read_stream

HEADER = "building_id,meter,timestamp,meter_reading\n"
GOOD = HEADER + "40000,200,2016-01-01 00:00:00,1.5\n1,0,2016-01-01 01:00:00,NaN\n1,0,2016-01-01 02:00:00,\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text(GOOD)
    return tmp_path


def test_wide_ids_and_missing_values(spark, folder):
    rows = {(r.building_id, r.meter, r.timestamp.hour): r.meter_reading for r in read_readings(spark, str(folder)).collect()}
    assert rows == {(40000, 200, 0): 1.5, (1, 0, 1): None, (1, 0, 2): None}


@pytest.mark.parametrize("line", ["1,0,2016-01-01T00:00:00,1.0", "1,0,01/02/2016 00:00,1.0", "x,0,2016-01-01 00:00:00,1.0"])
def test_a_bad_value_stops_the_read(spark, tmp_path, line):
    (tmp_path / "bad.csv").write_text(HEADER + line + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|parse"):
        read_readings(spark, str(tmp_path)).collect()


def test_a_stream_reads_like_a_batch(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("stream")
    stream = read_stream(spark, str(folder), READINGS, "csv")
    stream.writeStream.format("parquet").option("path", f"{out}/sink").option("checkpointLocation", f"{out}/progress").trigger(
        availableNow=True).start().awaitTermination()
    key = lambda r: (r.building_id, r.timestamp, r.meter_reading)
    assert sorted(map(str, map(key, spark.read.parquet(f"{out}/sink").collect()))) == sorted(map(str, map(key, read_readings(spark, str(folder)).collect())))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 100])
def test_many_first_rows_equal_few(spark, n):
    rows = [r for b in (3, 1, 2) for r in hours(range(3), building=b)] + [(9, 0, None, 1.0), (8, 0, None, 2.0)]
    df = readings(spark, [(b, m, t if t is None else t + dt.timedelta(0), v) for b, m, t, v in rows])
    assert frame(first_rows(df, n, in_one_task=0)).equals(frame(first_rows(df, n)))
