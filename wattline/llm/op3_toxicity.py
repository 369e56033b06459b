"""Toxic passages by maximum-scoring segment search over token log-odds.

Training compares labelled texts. Words are counted once per text, and families of words that begin with the same four
or five letters by the sums of their words; texts that agree in two min-hashes of their word triples count as one, so that copies don't vote twice. The log-odds of
a word between toxic and clean texts has an informative Dirichlet prior proportional to its overall frequency; a
word's token score is the lower bound ``delta - z * sigma``. A word without a positive bound takes its family's,
unless clean texts hold the word. All other tokens score ``-drift``.

A text's token scores are scanned once; all maximal segments come out in linear time. Their significance follows
extreme-value theory: with ``lam`` solving the balance equation over the background tokens and ``k`` fitted to the
maxima of clean training texts, a segment of score s in a text of n tokens has ``lam * s - log(k * n)``. The positive
values of a text's segments add up to its evidence, which a logistic curve turns into a probability.

Defined results: null and empty texts have no segment and get the curve's value at evidence 0; repeated rows are
scored each; ties between segments are kept in text order; whole texts are used at any length. Without labelled
rows of both classes every score is 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import labelled_ids, map_texts, sigmoid
from wattline.session import materialize

WORD = re.compile(r"[^\W_]+")


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    drift: float = 0.1
    lam: float = 1.0
    k: float = 1.0
    offset: float = -60.0
    slope: float = 0.0

    def token(self, word: str) -> float:
        known = self.words.get(word)
        if known is not None:
            return known
        return max(self.prefixes.get(word[:4], -self.drift), self.prefixes.get(word[:5], -self.drift))


class Scores(dict):
    """Word -> token score, remembered for a bounded number of words."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = self.model.token(word)
        return value


def maximal_segments(scores) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [start, end) of a sequence, left to right (Ruzzo and Tompa's linear scan).

    ``scores`` are (position, length, score) runs in order.
    """
    found: list[list] = []  # start, end, sum before, sum after
    link: list[int] = []  # the nearest earlier candidate with a smaller sum before it
    total = 0.0
    for at, size, score in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        new = [at, at + size, before, total]
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= new[2]:
                j = link[j]
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                link.append(j)
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:], link[j:]
            j = len(found) - 1
    return [(a, b, after - before) for a, b, before, after in found]


def runs(values: list[float], drift: float):
    """Tokens as runs: each positive token alone, the tokens between them as one."""
    array = np.array(values)
    last = 0
    for i in np.flatnonzero(array > 0).tolist():
        if i > last:
            yield last, i - last, -drift * (i - last)
        yield i, 1, values[i]
        last = i + 1


def passages(model: Model, words: list[str], known: Scores) -> list[tuple[int, int, float, float]]:
    """Significant segments: first word, end, score, normalised score."""
    values = list(map(known.__getitem__, words))
    base = math.log(max(model.k * len(words), 1e-300)) if words else 0.0
    scored = [(a, b, s, model.lam * s - base) for a, b, s in maximal_segments(runs(values, model.drift))]
    return [x for x in scored if x[3] > 0]


def _groups(words: list[str]) -> tuple[int, int]:
    triples = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return tuple(min(xxhash.xxh64_intdigest(t, seed) for t in triples) - (1 << 63) for seed in (1, 2))


def _distinct(rows: DataFrame) -> DataFrame:
    """One text of each group and label."""

    def make(texts):
        found = [_groups(WORD.findall((t or "").lower())) for t in texts]
        return {"text": texts, "a": [f[0] for f in found], "b": [f[1] for f in found]}

    return materialize(map_texts(rows, "text", "text string, a bigint, b bigint", make, ["label"]).dropDuplicates(["a", "b", "label"]))


def _count(rows: DataFrame) -> DataFrame:
    """For every word: toxic and clean texts that hold it."""

    def run(batches):
        tally: dict[str, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                for term in set(WORD.findall((text or "").lower())):
                    tally.setdefault(term, [0, 0])[label] += 1
        columns = [list(tally), [v[1] for v in tally.values()], [v[0] for v in tally.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["term", "y1", "y0"])

    return rows.select("text", "label").mapInArrow(run, "term string, y1 bigint, y0 bigint").groupBy("term").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))


def _families(words: DataFrame) -> DataFrame:
    """Counts of words by their first letters (marked by a space). The most frequent toxic word is left out: it is
    scored itself, and one word alone says nothing about others that begin like it."""
    parts = [
        words.where(F.length("term") > n).groupBy(F.concat(F.lit(" "), F.substring("term", 1, n)).alias("term"))
        .agg((F.sum("y1") - F.max("y1")).alias("y1"), F.sum("y0").alias("y0"))
        for n in (4, 5)
    ]
    return parts[0].unionByName(parts[1])


def train(
    docs: DataFrame, labels: DataFrame, keep: Column, per_class: int = 3000,
    z: float = 3.5, least: float = 1.5, drift: float = 0.1, prior: float = 10.0,
) -> Model:
    """Fit on at most ``per_class`` labelled texts of each class; ``keep`` says which labelled ids may be used.

    ``z``: standard deviations between log-odds and bound; ``least``: smallest log-odds of a toxic token; ``drift``:
    what any other token costs; ``prior``: tokens that the Dirichlet prior weighs.
    """
    chosen = labelled_ids(labels, "toxic", keep, per_class)  # bounded, so its join may be broadcast
    rows = _distinct(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label"))
    words = materialize(_count(rows))
    n1, n0 = words.agg(F.coalesce(F.sum("y1"), F.lit(0)), F.coalesce(F.sum("y0"), F.lit(0))).first()
    if not n1 or not n0:
        return Model(drift=drift)
    counted = words.unionByName(_families(words))
    share = (F.col("y1") + F.col("y0")) / (n1 + n0)
    y1, y0 = F.col("y1") + F.greatest(share * prior, F.lit(0.5)), F.col("y0") + F.greatest(share * prior, F.lit(0.5))
    delta = F.log(y1 / F.greatest(n1 + prior - y1, F.lit(1.0))) - F.log(y0 / F.greatest(n0 + prior - y0, F.lit(1.0)))
    bound = delta - z * F.sqrt(1 / y1 + 1 / y0)
    good = {r["term"]: r["s"] for r in counted.where(F.col("y1") >= 2).where((delta >= least) & (bound > 0)).select("term", bound.alias("s")).collect()}
    model = Model({t: s for t, s in good.items() if t[0] != " "}, {t[1:]: s for t, s in good.items() if t[0] == " "}, drift)
    if model.prefixes:
        stems = list(model.prefixes)
        stem = F.col("term").substr(1, 4).isin(stems) | F.col("term").substr(1, 5).isin(stems)
        seen = words.where(stem & (F.col("y0") > 0)).select("term").collect()
        model.words = {r["term"]: -drift for r in seen} | model.words
    share = labels.where(F.col("toxic").isNotNull() & keep).agg(F.avg((F.col("toxic") == 1).cast("double")).alias("s")).first()["s"]
    return calibrate(model, rows, min(max(share, 1e-3), 1 - 1e-3))


def _summaries(model: Model, rows: DataFrame) -> list:
    def make(texts):
        known = Scores(model)
        out = {"n": [], "segments": [], "positive": []}
        for text in texts:
            words = WORD.findall((text or "").lower())
            values = list(map(known.__getitem__, words))
            out["n"].append(len(words))
            out["segments"].append([s for _, _, s in maximal_segments(runs(values, model.drift))])
            out["positive"].append([v for v in values if v > 0])
        return out

    return map_texts(rows, "text", "n bigint, segments array<double>, positive array<double>", make, ["label"]).collect()


def calibrate(model: Model, rows: DataFrame, toxic_share: float) -> Model:
    """Fit ``lam``, ``k`` and the logistic curve on the bounded training texts."""
    found = _summaries(model, rows)
    clean = [r for r in found if r["label"] == 0]
    tokens = sum(r["n"] for r in clean) or 1
    lifts = [v for r in clean for v in r["positive"]]
    highest = max([*model.words.values(), *model.prefixes.values(), 0.0])
    lifts = np.array([*lifts, max(highest, model.drift)])  # one more: a score never seen isn't impossible
    low, high = 1e-3, 50.0 / max(lifts.max(), 1e-3)

    def balance(lam):
        return (np.exp(np.minimum(lam * lifts, 700)).sum() + max(tokens - len(lifts), 1) * math.exp(-lam * model.drift)) / (tokens + 1) - 1

    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if balance(mid) > 0 else (mid, high)
    model.lam = (low + high) / 2
    model.k = len(clean) / max(sum(max(r["n"], 1) * math.exp(-min(model.lam * max(r["segments"], default=0.0), 700)) for r in clean), 1e-9)
    x = np.array([sum(max(0.0, model.lam * s - math.log(model.k * r["n"])) for s in r["segments"]) for r in found])
    y = np.array([r["label"] for r in found], float)
    # the sample's classes are bounded apart: weigh them back to their share of all labels
    w = np.where(y == 1, toxic_share / y.sum(), (1 - toxic_share) / (1 - y).sum()) * len(y)
    scale = max(np.quantile(x[y == 1], 0.5), 1e-9)
    a, b = -1.0, 1.0
    for _ in range(60):
        p = sigmoid(a + b * x / scale)
        v = w * p * (1 - p) + 1e-9
        u = x / scale
        g = np.array([(w * (y - p)).sum() - 0.01 * a, (w * (y - p) * u).sum() - 0.01 * b])
        h = np.array([[v.sum() + 0.01, (v * u).sum()], [(v * u).sum(), (v * u * u).sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
    model.offset, model.slope = float(a), float(max(b, 0.0) / scale)
    return model


def score(df: DataFrame, model: Model, threshold: float = 0.3, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all other columns by default), ``score``, ``predicted`` and ``passages``: every significant segment
    as first word, end word (exclusive), score and expected number of such segments by chance."""
    spread = df.sparkSession.sparkContext.broadcast(model)

    def make(texts):
        own = spread.value
        known = Scores(own)
        out = {"score": [], "predicted": [], "passages": []}
        for t in texts:
            found = passages(own, WORD.findall((t or "").lower()), known)
            p = float(sigmoid(own.offset + own.slope * sum(x[3] for x in found)))
            out["score"].append(p)
            out["predicted"].append(int(p >= threshold))
            out["passages"].append([{"start": a, "end": b, "score": s, "expected": math.exp(-e)} for a, b, s, e in found])
        return out

    made = ("score", "predicted", "passages")
    keep = [c for c in df.columns if c != text and c not in made] if keep is None else keep
    schema = "score double, predicted int, passages array<struct<start:bigint,end:bigint,score:double,expected:double>>"
    return map_texts(df, text, schema, make, keep)
