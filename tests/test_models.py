"""Stopping, step search and models of many sites."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import models
from wattline.operators.models import fit_site_ridges, minimize_bounded, rounds_with_patience


def test_patience():
    assert rounds_with_patience([5, 4, 3, 3, 3.5, 2.9, 4], 3) == 6
    assert rounds_with_patience([5, 4, 3, 3, 3.5, 2.9, 4], 2) == 3
    assert rounds_with_patience([1.0], 1) == 1 and rounds_with_patience([3, 2, 1], 1) == 3


@pytest.mark.parametrize("best", [0.006, 0.05, 0.11, 0.29])
def test_bounded_search_finds_the_minimum(best):
    for f in (lambda x: (x - best) ** 2, lambda x: abs(math.log(x / best)), lambda x: -math.exp(-((x - best) / 0.05) ** 2)):
        tried = minimize_bounded(f, 0.005, 0.3, 40)
        first = next(iter(tried))
        found = min(tried, key=lambda x: (tried[x], x))
        assert len(tried) <= 40 and all(0.005 <= x <= 0.3 for x in tried)
        assert abs(found - best) < 2e-3 and found != first
    assert len(minimize_bounded(lambda x: 1.0, 0.005, 0.3, 5)) == 5


def test_step_search_measures_every_step(spark):
    rng = np.random.default_rng(0)
    rows = [(i % 3, 0, float(i % 24), float(rng.normal()) + 10 * (i % 24 > 11)) for i in range(400)]
    df = spark.createDataFrame(rows, "site_id int, meter int, hour double, meter_reading double")
    cfg = models.BoosterSettings(rounds=4, max_depth=2, stopping_fraction=0.0)
    best, table = models.search_step_size(df.where("rand(1) < 2").limit(300), df, cfg, evaluations=4)
    tried = [(r.step_size, r.rmse) for r in table.collect()]
    assert len(tried) == 4 and best == tried[0][0] == min(tried, key=lambda x: (x[1], x[0]))[0]
    assert len({e for _, e in tried}) > 1


def test_ridge_of_many_sites(spark):
    """Three thousand sites in one job, against least squares of each."""
    rng = np.random.default_rng(1)
    n, sites = 120, 3000
    x = rng.normal(size=(sites, n, 3)) * [1, 50, 0.01] + [0, 1000, 5]
    x[7, :, 2] = 4.0  # an input that doesn't vary
    y = 500 + x @ [3, -0.1, 40] + rng.normal(size=(sites, n))
    frame = np.concatenate((np.repeat(np.arange(sites), n)[:, None], x.reshape(-1, 3), y.reshape(-1, 1)), axis=1)
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame(frame, columns=["site_id", "a", "b", "c", "meter_reading"])).withColumn("site_id", F.col("site_id").cast("int"))
    few = spark.createDataFrame([(9000, 1.0, 2.0, 3.0, 4.0)], df.schema)
    held = df.where("site_id IN (0, 7, 2999)").unionByName(few)
    held = held.unionByName(held.limit(1).withColumn("a", F.lit(None).cast("double")))
    found = fit_site_ridges(df.unionByName(few), held, ["a", "b", "c"], penalty=0.0).collect()
    assert len(found) == 3 * n + 2
    for site in (0, 7, 2999):
        inputs = np.column_stack((np.ones(n), x[site]))
        line = np.linalg.lstsq(inputs, y[site], rcond=None)[0]
        own = {(r.a, r.b): r.predicted for r in found if r.site_id == site and r.a is not None}
        for row in inputs:
            assert own[row[1], row[2]] == pytest.approx(max(0.0, row @ line), rel=1e-6)
    assert [r.predicted for r in found if r.site_id == 9000 or r.a is None] == [None, None]


def test_boosted_trees_store_no_node_of_a_row(spark):
    """The same trees as with a stored node per row and level, and bins for all values of a categorical input."""
    rng = np.random.default_rng(3)
    rows = [(i % 150 if i % 11 else None, i % 2, float(i % 24), float(rng.normal()) + 10 * (i % 24 > 11) + i % 150) for i in range(3000)]
    df = spark.createDataFrame(rows, "site_id int, meter int, hour double, meter_reading double")
    cfg = models.BoosterSettings(rounds=3, max_depth=4, stopping_fraction=0.0)
    found = models.fit_boosted_trees(df, df, cfg).model.stages[-1]
    assert not found.getCacheNodeIds() and found.getMaxBins() == 152
    stored = models.training_vectors(df, models.CATEGORICAL).rows
    again = models.GBTRegressor(
        labelCol="meter_reading", maxDepth=4, maxIter=3, stepSize=cfg.step_size, subsamplingRate=cfg.row_fraction, featureSubsetStrategy="0.8",
        minInstancesPerNode=cfg.min_rows_per_leaf, maxBins=152, seed=cfg.seed, cacheNodeIds=True).fit(stored)
    assert found.toDebugString.split("\n", 1)[1] == again.toDebugString.split("\n", 1)[1]
