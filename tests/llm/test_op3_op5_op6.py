"""The learned operators: their inference against brute force, and held-out accuracy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import op3_toxicity as op3
from wattline.llm import op5_language_id as op5
from wattline.llm import op6_quality as op6
from wattline.llm.common import in_fold

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


# --- toxicity


def all_maximal(values):
    """Maximal segments by their recursive definition: the best one, then the same left and right of it."""
    best = None
    for i in range(len(values)):
        for j in range(i + 1, len(values) + 1):
            s = round(sum(values[i:j]), 9)
            if s > 0 and (best is None or s > best[0]):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    return all_maximal(values[:i]) + [(i, j, s)] + [(a + j, b + j, t) for a, b, t in all_maximal(values[j:])]


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(0)
    for _ in range(200):
        values = [float(v) for v in rng.choice([-3.1, -1.7, -0.9, 0.53, 1.21, 2.37, 4.03], rng.integers(0, 14))]
        found = [(a, b, round(s, 6)) for a, b, s in op3.maximal_segments((i, 1, v) for i, v in enumerate(values))]
        wanted = [(a, b, round(s, 6)) for a, b, s in all_maximal(values)]
        assert [round(s, 6) for *_, s in found] == [s for *_, s in wanted] or math.isclose(sum(s for *_, s in found), sum(s for *_, s in wanted))
        assert len(found) == len(wanted)


def test_runs_keep_the_segments():
    values = [-0.1, -0.1, 2.0, -0.1, 1.5, -0.1, -0.1]
    assert op3.maximal_segments(op3.runs(values, 0.1)) == [(2, 5, pytest.approx(3.4))]


def test_toxic_passages_on_held_out_texts(spark, tables):
    docs, labels = tables
    held = in_fold(F.col("doc_id"), 4, 2)
    model = op3.train(docs, labels, ~held)
    found = op3.score(docs, model).join(labels.where(held & F.col("toxic").isNotNull()), "doc_id").collect()
    right = np.mean([r.predicted == r.toxic for r in found])
    assert right >= 0.9 and all(0 <= r.score <= 1 for r in found)
    assert all(0 <= p.start < p.end and p.expected < 1 for r in found for p in r.passages)


def test_toxicity_of_odd_tables(docs, nothing, tables):
    model = op3.Model(words={"idiot": 5.0}, lam=1.0, k=0.01, offset=-3.0, slope=1.0)
    found = op3.score(docs, model).collect()
    assert len(found) == docs.count() and {r.predicted for r in found} == {0} and isinstance(found[0].score, float)
    assert op3.score(nothing, model).count() == 0
    empty = op3.train(tables[0], tables[1].limit(0), F.lit(True))
    assert all(r.score < 1e-9 for r in op3.score(docs, empty).collect())


# --- language


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    lengths = np.array([70, 1, 29, 64, 32])
    scores, trans = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    gamma, pairs = op5.forward_backward(scores, lengths, trans)
    at, step, total = 0, np.exp(trans), np.zeros((3, 3))
    for n in lengths:
        s = np.exp(scores[at : at + n])
        alpha, beta = [np.ones(3) / 3 @ step * s[0]], [np.ones(3)]
        for x in s[1:]:
            alpha.append(alpha[-1] @ step * x)
        for x in s[:0:-1]:
            beta.append(step @ (x * beta[-1]))
        beta = beta[::-1]
        wanted = np.array(alpha) * np.array(beta)
        assert np.allclose(gamma[at : at + n], wanted / wanted.sum(1, keepdims=True), atol=1e-9)
        for t in range(1, n):
            p = alpha[t - 1][:, None] * step * (s[t] * beta[t])[None, :]
            total += p / p.sum()
        at += n
    assert np.allclose(pairs, total)


def test_code_switched_words():
    sample = [("the house and the garden with the tree of this", "en"), ("das haus und der garten mit dem baum von dieser", "de")] * 20
    tagger = op5.fit(sample, run=5)
    ((words, gamma),) = op5.tag_words(tagger, ["The garden and the house with das haus und der baum mit dem garten"])
    said = [tagger.langs[i] for i in gamma.argmax(axis=1)]
    assert said[:5] == ["en"] * 5 and said[7:] == ["de"] * (len(words) - 7)


def test_language_of_held_out_texts(tables, docs, nothing):
    rows, _ = tables
    held = in_fold(F.col("doc_id"), 4, 2)
    tagger = op5.train(rows, ~held)
    found = op5.identify(rows, tagger).where(held).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.99
    odd = op5.identify(docs, tagger).collect()
    assert [r.lang_pred for r in odd if r.doc_id in (2, 3, 6)] == ["und"] * 3 and all(r.score == 0 for r in odd if r.lang_pred == "und")
    assert op5.identify(nothing, tagger).count() == 0
    none = op5.train(docs.where("false"), F.lit(True))
    assert {r.lang_pred for r in op5.identify(docs, none).collect()} == {"und"}


# --- quality


def test_pairs_rank_and_the_quantile_cuts():
    rng = np.random.default_rng(4)
    good, bad = rng.normal(1, 1, (300, len(op6.FEATURES))), rng.normal(-1, 1, (300, len(op6.FEATURES)))
    model = op6.fit(good, bad, bad_share=0.2)
    up, down = model.strength(good), model.strength(bad)
    assert np.mean(up[:, None] > down[None, :]) > 0.99
    below = 0.8 * np.mean(up < model.threshold) + 0.2 * np.mean(down < model.threshold)
    assert abs(below - 0.2) < 0.01
    x = np.array([model.threshold, model.threshold + 1])
    assert op6.sigmoid(model.steepness * (x - model.threshold))[0] == 0.5


def test_quality_of_held_out_texts(tables, docs, nothing):
    rows, labels = tables
    held = in_fold(F.col("doc_id"), 3, 1)
    model = op6.train(rows, labels, ~held)
    found = op6.score(rows, model).join(labels.where(held), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in found]) >= 0.95
    odd = op6.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert op6.score(nothing, model).count() == 0
    none = op6.train(rows, labels.limit(0), F.lit(True))
    assert {r.score for r in op6.score(docs, none).collect()} == {0.5}


def test_quality_learns_from_every_labelled_text(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 4 > 0), rng.normal(0.6 if i % 4 else -0.6, 1, len(op6.FEATURES)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, label int, features array<double>")
    pairs = op6.dealt(df, {0: 100, 1: 300}).collect()
    own = {label: {tuple(x) for _, y, x in rows if y == label} for label in (0, 1)}
    assert len(pairs) == 300 * op6.ROUNDS
    assert {tuple(r.good) for r in pairs} == own[1] and {tuple(r.bad) for r in pairs} == own[0]
    model = op6.fit_rows(df, 0.25)
    x, y = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0) + 1e-3)
    strength = model.strength(x)
    ordered = np.sort(strength)
    assert model.threshold == pytest.approx((ordered[99] + ordered[100]) / 2)
    assert model.steepness == pytest.approx(4 / (np.median(strength[y == 1]) - np.median(strength[y == 0])))
    # texts beyond any bound on a class change the model
    assert not np.allclose(op6.fit_rows(df.where("doc_id < 396"), 0.25).weights, model.weights)


def test_quality_moves_features_not_texts(spark, tables, monkeypatch):
    """The join with the labels lies above the description of the texts, whose shuffle it would else be."""
    plans, store = [], op6.materialize
    monkeypatch.setattr(op6, "materialize", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or store(df))
    op6.train(*tables, ~in_fold(F.col("doc_id"), 3, 1))
    assert plans[0].index("Join") < plans[0].index("MapInArrow")


def test_quality_takes_repeated_rows_and_drops_missing_ids(spark, monkeypatch):
    stored, store = [], op6.materialize
    monkeypatch.setattr(op6, "materialize", lambda df: stored.append(store(df)) or stored[-1])
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, None), (2, "c"), (3, "d"), (None, "e"), (4, "f")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (4, 1), (9, 0)], "doc_id long, quality int")
    op6.train(docs, labels, F.col("doc_id") != 4)
    wanted = [(1, 1, op6.describe("a b"))] * 2 + [(1, 1, op6.describe(None)), (2, 0, op6.describe("c"))]
    assert sorted(tuple(r) for r in stored[0].collect()) == sorted(wanted)
