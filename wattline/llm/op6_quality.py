"""Document quality by Bradley-Terry ranking of preference pairs.

Every text is described by a few ratios (case, symbols, separators, repetition, word shapes). From labelled texts,
pairs of a good and a bad one are preferences; logistic loss on the pairs' feature differences gives the weights, so
a text's score is its Bradley-Terry strength. The decision threshold is the score's quantile at the share of bad
texts; the published score is the logistic distance to it, 0.5 exactly at the threshold.

All labelled texts take part, in everything learned: each one stands in ``ROUNDS`` pairs at least, dealt by hash. The
tasks add up the loss's gradient and curvature of their pairs, and only these sums reach the driver.

Defined results: null and empty texts have all-zero features and are scored like any other; repeated rows are scored
each; whole texts are used at any length. Without labelled rows of both classes every score is 0.5.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.quantiles import group_quantiles
from wattline.functions.ranking import ordinal_rank
from wattline.llm.common import map_texts, prepare, sigmoid
from wattline.session import materialize

UPPER, DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
SYMBOLS = bytes(c for c in range(33, 127) if c not in LETTERS + DIGIT + b".,;:'\"()-!?|")
FEATURES = (
    "size", "upper", "digit", "symbol", "bar", "shout", "stop", "adjacent", "fresh", "same_line", "top_word", "word_length",
    "long_word", "symbol_word", "symbol_any", "adjacent_any", "upper_any", "bar_any", "fresh_squared",
)


def describe(text: str | None) -> list[float]:
    """The features of one text, each between about 0 and 1."""
    data = (text or "").encode()
    words = (text or "").split()
    n, w = max(len(data), 1), max(len(words), 1)
    count = lambda chars: (len(data) - len(data.translate(None, chars))) / n
    lines = [x for x in (text or "").split("\n") if x]
    tally = Counter(words)
    fresh = len(tally) / w
    # distinct words grow more slowly than words: compare with a power of the length
    fresh = min(1.0, fresh * w**0.15 / 1.5)
    symbol, adjacent, upper, bar = count(SYMBOLS), sum(map(eq, words, words[1:])) / w, count(UPPER), data.count(b"|") / w
    return [
        min(1.0, math.log1p(len(words)) / 10), upper, count(DIGIT), symbol, bar, data.count(b"!") / w, data.count(b".") / w,
        adjacent, fresh, 1 - len(set(lines)) / len(lines) if lines else 0.0, tally.most_common(1)[0][1] / w if words else 0.0,
        min(1.0, n / w / 20), sum(len(x) > 25 for x in tally) / w, min(1.0, symbol * n / w), min(1.0, 20 * symbol),
        min(1.0, 5 * adjacent), min(1.0, 4 * upper), min(1.0, 4 * bar), fresh * fresh,
    ]


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    steepness: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.steepness * (self.strength(x) - self.threshold))


#: Deals of the pairs: in each, every text of the larger class meets one of the other.
ROUNDS = 4
#: Newton steps end when none of the weights moves by more.
STILL, STEPS = 1e-6, 25


def dealt(rows: DataFrame, sizes: dict[int, int], rounds: int = ROUNDS) -> DataFrame:
    """Pairs ``good``, ``bad`` of feature arrays. Both classes are put in hashed order anew in each round; place ``i`` of
    the larger class meets place ``i`` modulo the smaller one's size, so that every text's number of pairs is as even
    as can be."""
    found = None
    for i in range(rounds):
        placed = ordinal_rank(rows, ["label", F.xxhash64("doc_id", "features", F.lit(i)), "doc_id"], "place")
        sides = []
        for label, name in ((1, "good"), (0, "bad")):
            start = 0 if label == 0 else sizes[0]
            sides.append(placed.where(F.col("label") == label).select((F.col("place") - 1 - start).alias("_at"), F.col("features").alias(name)))
        sides.sort(key=lambda side: -sizes[1 if "good" in side.columns else 0])
        large, small = sides
        less = min(sizes.values())
        pairs = large.withColumn("_at", F.col("_at") % less).join(small, "_at").select("good", "bad")
        found = pairs if found is None else found.unionByName(pairs)
    return found


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=float).reshape(-1, len(FEATURES))


def _added(df: DataFrame, term) -> np.ndarray:
    """The sum over all batches of ``term(batch)``, a vector of fixed length; each task adds up its own."""
    prepare(df.sparkSession)

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = term(batch)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["place", "total"])

    sums = df.mapInArrow(run, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    return np.array([r["total"] for r in sums.orderBy("place").collect()])


def newton(sums) -> np.ndarray:
    """Weights at the least loss; ``sums(w)`` gives the mean gradient and curvature of the pairs' loss as one vector."""
    width = len(FEATURES)
    w = np.zeros(width)
    for _ in range(STEPS):
        found = sums(w)
        step = np.linalg.solve(found[width:].reshape(width, width) + 1e-3 * np.eye(width), found[:width] - 1e-3 * w)
        step = step * min(1.0, 3 / max(np.abs(step).max(), 1e-9))
        w = w + step
        if np.abs(step).max() < STILL:
            break
    return w


def slopes(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Summed gradient and curvature of the logistic loss of feature differences."""
    p = sigmoid(d @ w)
    return np.concatenate((d.T @ (1 - p), ((d * (p * (1 - p))[:, None]).T @ d).ravel()))


def fit(good: np.ndarray, bad: np.ndarray, bad_share: float, seed: int = 0) -> Ranker:
    """The fit of ``fit_rows`` for few texts, held as arrays."""
    width = len(FEATURES)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    both = np.concatenate((good, bad))
    mean, scale = both.mean(0), both.std(0) + 1e-3
    z = lambda x: np.clip((x - mean) / scale, -8, 8)
    rng, most = np.random.default_rng(seed), max(len(good), len(bad))
    deal = lambda x: np.concatenate([np.resize(rng.permutation(len(x)), most) for _ in range(ROUNDS)])
    d = z(good[deal(good)]) - z(bad[deal(bad)])
    model = Ranker(mean, scale, newton(lambda w: slopes(d, w) / len(d)), 0.0, 1.0)
    up, down = model.strength(good), model.strength(bad)
    score = np.concatenate((up, down))
    weight = np.concatenate((np.full(len(up), (1 - bad_share) / len(up)), np.full(len(down), bad_share / len(down))))
    order = np.argsort(score, kind="stable")
    at = int(np.searchsorted(np.cumsum(weight[order]), bad_share * (1 - 1e-9)))
    model.threshold = float((score[order][at] + score[order][min(at + 1, len(order) - 1)]) / 2)
    model.steepness = float(4 / max(np.median(up) - np.median(down), 1e-6))
    return model


def fit_rows(rows: DataFrame, bad_share: float) -> Ranker:
    """Newton steps on the pairs' logistic loss with a small ridge; ``rows`` are ``doc_id``, ``label`` and ``features``."""
    width = len(FEATURES)
    sizes = {0: 0, 1: 0} | {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not sizes[0] or not sizes[1]:
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    n = sum(sizes.values())
    mean = _added(rows.select("features"), lambda b: _matrix(b.column(0)).sum(0)) / n
    scale = np.sqrt(_added(rows.select("features"), lambda b: ((_matrix(b.column(0)) - mean) ** 2).sum(0)) / n) + 1e-3
    z = lambda x: np.clip((x - mean) / scale, -8, 8)
    pairs = materialize(dealt(rows, sizes))
    differences = lambda b: z(_matrix(b.column("good"))) - z(_matrix(b.column("bad")))
    w = newton(lambda w: _added(pairs, lambda b: slopes(differences(b), w)) / (ROUNDS * max(sizes.values())))
    model = Ranker(mean, scale, w, 0.0, 1.0)
    strengths = materialize(_strengths(rows, model))
    model.threshold = _cut(strengths, sizes, bad_share)
    middle = {r["label"]: r["median"] for r in group_quantiles(strengths, "strength", {"median": 0.5}, ["label"]).collect()}
    model.steepness = float(4 / max(middle[1] - middle[0], 1e-6))
    return model


def _strengths(rows: DataFrame, model: Ranker) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = model.strength(_matrix(batch.column("features")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found)], names=["label", "strength"])

    return rows.select("label", "features").mapInArrow(run, "label int, strength double")


def _cut(strengths: DataFrame, sizes: dict[int, int], bad_share: float) -> float:
    """Midway between the strength at which the rows' weight reaches the share of bad texts, and the next one. Classes
    weigh what their shares say, also if ids repeat among the labels or labels lack texts."""
    weight = {0: bad_share / sizes[0], 1: (1 - bad_share) / sizes[1]}
    heavy = F.when(F.col("label") == 1, weight[1]).otherwise(weight[0])
    wanted = bad_share * (1 - 1e-9)
    # strengths in order, in ranges: the one that holds the wanted weight is found from the ranges' sums
    placed = materialize(strengths.orderBy("strength", "label").select("strength", heavy.alias("weight"), F.spark_partition_id().alias("part")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.sum("weight").alias("weight")).withColumn("ahead", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    here = parts.where(F.col("ahead") < wanted).orderBy(F.desc("part")).first()
    if here is None:
        return float(placed.agg(F.min("strength")).first()[0])
    so_far = Window.orderBy("strength").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.where(F.col("part") == here["part"]).withColumn("mass", F.sum("weight").over(so_far) + here["ahead"])
    at = inside.where(F.col("mass") >= wanted).agg(F.min("strength")).first()[0]
    if at is None:
        at = placed.where(F.col("part") == here["part"]).agg(F.max("strength")).first()[0]
    above = placed.where(F.col("strength") > at).agg(F.min("strength")).first()[0]
    return float(at if above is None else (at + above) / 2)


def features(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``features``, an array in the order of ``FEATURES``."""
    keep = [c for c in df.columns if c not in (text, "features")] if keep is None else keep
    return map_texts(df, text, "features array<double>", lambda texts: {"features": [describe(t) for t in texts]}, keep)


def train(docs: DataFrame, labels: DataFrame, keep: Column) -> Ranker:
    """Fit on all labelled texts; ``keep`` says which labelled ids may be used."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & keep)
    one = known.groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("label")).where(F.col("label").isin(0, 1))
    # described where they lie: what the join moves is a text's features, not the text
    found = features(docs.where(F.col("doc_id").isNotNull() & keep).select("doc_id", "text"), keep=["doc_id"])
    rows = materialize(found.join(one, "doc_id").select("doc_id", "label", "features"))
    bad = labels.where(F.col("quality").isNotNull() & keep).agg(F.avg((F.col("quality") == 0).cast("double")).alias("s")).first()["s"]
    return fit_rows(rows, float(bad or 0.0))


def score(df: DataFrame, model: Ranker, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all other columns by default), ``score``, ``predicted`` (score of at least 0.5) and ``strength``."""

    def make(texts):
        x = np.array([describe(t) for t in texts]).reshape(-1, len(FEATURES))
        p = model.probability(x)
        return {"score": p, "predicted": (p >= 0.5).astype(int), "strength": model.strength(x)}

    made = ("score", "predicted", "strength")
    keep = [c for c in df.columns if c != text and c not in made] if keep is None else keep
    return map_texts(df, text, "score double, predicted int, strength double", make, keep)
