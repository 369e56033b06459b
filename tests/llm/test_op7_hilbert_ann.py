"""Neighbours along Hilbert curves: order of the curve, exact results with whole windows, recall, odd tables."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm.op7_hilbert_ann import hilbert, search


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute(ids, x, k, every):
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        score = x @ x[at]
        order = [j for j in np.lexsort((ids, -score)) if j != at][:k]
        out[int(ids[at])] = [(int(ids[j]), score[j]) for j in order]
    return out


def table(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], "vec_id bigint, embedding array<float>")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[1:400:2] = x[1]  # one common vector
    x[800:850] = x[800] + rng.normal(size=(50, 16)).astype(np.float32) * 1e-3
    return np.arange(1500), x.astype(float)


def test_ties_go_to_the_smaller_id(spark):
    """Vectors of zeros and ones: very many equal products, all told apart by id."""
    rng = np.random.default_rng(6)
    ids, x = rng.permutation(1200), rng.integers(0, 2, (1200, 11)).astype(float)
    x[x.sum(axis=1) == 0, 0] = 1
    found = lists(search(table(spark, ids, x), "vec_id", "embedding", F.col("id") % 20 == 0, k=20, curves=1, blocks=1, reach=0, unit=300))
    assert found == brute(ids, x, 20, 20)


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_whole_windows_are_exact(spark, vectors):
    ids, x = vectors
    found = lists(search(table(spark, ids, x), "vec_id", "embedding", F.col("id") % 5 == 0, k=7, curves=2, blocks=3, reach=2, unit=200))
    wanted = brute(ids, x, 7, 5)
    assert found.keys() == wanted.keys()
    for q, near in wanted.items():
        assert [i for i, _ in found[q]] == [i for i, _ in near]
        assert np.allclose([s for _, s in found[q]], [s for _, s in near], rtol=1e-12)


def test_recall(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32).astype(float)
    found = lists(search(table(spark, ids, x), "vec_id", "embedding", F.col("id") % 20 == 0))
    wanted = brute(ids, x, 20, 20)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in near}) for q, near in wanted.items())
    assert all(len(v) == 20 for v in found.values()) and hits >= 0.9 * 20 * len(wanted)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (21, [1.0, 1.0]), (21, [1.0, 1.0]), (None, [1.0, 0.0]), (40, None), (60, []), (80, [0.0, 0.0]),
            (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]), (160, [1.0, 2.0, 3.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("mine"))
    found = lists(search(df, "vec_id", "embedding", F.col("id") % 20 == 0))
    assert {q: [i for i, _ in v] for q, v in found.items()} == {0: [1, 2, 21, 20], 20: [21, 0, 1, 2]}
    assert search(df.limit(0), "vec_id", "embedding", F.col("id") % 20 == 0).count() == 0
    assert search(df, "vec_id", "embedding", F.col("id") < 0).count() == 0
