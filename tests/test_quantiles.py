"""Selection by digits against the collecting percentile, and its plan."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.functions.quantiles import code_value, group_quantiles, order_code

EDGES = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), 0.1, 3.0]


def bits(value):
    b = struct.unpack("q", struct.pack("d", abs(value)))[0]
    return -b if value < 0 else b


def test_codes_are_the_bits(spark):
    values = EDGES + [f(math.ldexp(1, e)) for e in range(-1074, 1024, 3) for f in (lambda x: x, lambda x: math.nextafter(x, 0), lambda x: math.nextafter(x, math.inf))]
    values += [-v for v in values]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    rows = rows.withColumn("c", order_code(F.col("v"))).withColumn("back", code_value(F.col("c"))).collect()
    assert all(r.c == bits(r.v) and r.back == r.v for r in rows)
    odd = spark.sql("SELECT double('NaN') AS v").select(order_code(F.col("v")).alias("c")).withColumn("back", code_value(F.col("c"))).first()
    assert odd.c > bits(math.inf) and math.isnan(odd.back)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate((rng.normal(0, 1e6, 400), rng.integers(-3, 4, 400).astype(float), np.exp(rng.normal(0, 80, 300)), np.zeros(200)))
    keys = [None, 0, 1, 2]
    data = [(keys[i % 4], float(v)) for i, v in enumerate(rng.permutation(values))] + [(7, 4.5), (8, None), (1, None)]
    return spark.createDataFrame(data, "k int, v double")


def test_equals_the_collecting_percentile(spark, rows, small_groups):
    wanted = {"low": 0.0, "quarter": 0.25, "half": 0.5, "cap": 0.999, "high": 1.0}
    for keys in (["k"], []):
        mine = {tuple(r[k] for k in keys): r for r in group_quantiles(rows, "v", wanted, keys).collect()}
        plain = rows.groupBy(*keys).agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in wanted.items()]).collect()
        for r in plain:
            if r["half"] is not None:
                assert [mine[tuple(r[k] for k in keys)][n] for n in wanted] == pytest.approx([r[n] for n in wanted], rel=1e-14)


def test_no_value_is_shuffled(spark, rows, small_groups):
    plan = group_quantiles(rows, "v", {"half": 0.5}, [])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("_value" in line or "_code" in line for line in exchanges)
    assert group_quantiles(rows.limit(0), "v", {"half": 0.5}, ["k"]).count() == 0


def test_codes_are_stored_once_and_short_groups_are_not_looked_for(spark, rows, small_groups, monkeypatch):
    """Every pass reads stored codes; a table of long groups only is selected as a whole; few rows left end the passes."""
    from wattline.functions import quantiles

    stored, discarded = [], []
    monkeypatch.setattr(quantiles, "materialize", lambda df, f=quantiles.materialize: stored.append(df.columns) or f(df))
    monkeypatch.setattr(quantiles, "discard", lambda df, f=quantiles.discard: discarded.append(df.columns) or f(df))
    long = rows.where("k IS NULL OR k < 3")
    for limit, passes in ((1_000_000, 2), (0, 4)):
        stored.clear(), discarded.clear()
        monkeypatch.setattr(quantiles, "LAST_ROWS", limit)
        found = group_quantiles(long, "v", {"half": 0.5}, ["k"])
        assert stored == [["k", "_code"]] + [["k", "_prefix", "_count", "_asks"]] * passes and discarded == [["k", "_code"]]
        assert "ObjectHashAggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile" not in found._jdf.queryExecution().optimizedPlan().toString()
        plain = {r.k: r.half for r in long.groupBy("k").agg(F.percentile("v", F.lit(0.5)).alias("half")).collect()}
        assert {r.k: r.half for r in found.collect()} == pytest.approx(plain, rel=1e-14)
