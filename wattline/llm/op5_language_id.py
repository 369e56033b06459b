"""Language of every word by a linear-chain conditional random field, for texts that switch between languages.

A word's potentials are sums of learned weights of its character n-grams (those that touch a word border are its
affixes) and of the word itself (the lexicon); learned transitions join neighbouring words. Forward-backward gives
every word's posterior. A document's language is the one with the largest posterior mass over its words' letters.

Weights are fitted by gradient ascent on sequences from a bounded sample of labelled texts (``docs_per_lang`` distinct
texts of each language, by hash). Training sequences are runs of words from several documents one after the other, so
that there are switches to learn from.

Defined results: ``und`` with score 0 if the text is null, empty or has no letter, or if nothing could be learned;
equal masses go to the language that sorts first; repeated rows are scored each; texts of any length are used whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_texts

WORDS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 17
BLOCK = 32
#: Words whose features are held at once.
LOT = 4096
UNKNOWN = "und"


@dataclass
class Tagger:
    langs: list[str]
    weights: np.ndarray  # [BUCKETS, languages]
    transitions: np.ndarray  # [languages, languages], log potentials


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word, one after another, and where each word's begin."""
    text = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    last = np.repeat(first + size, size)
    at = np.arange(codes.size)
    owner = np.repeat(np.arange(len(words)), size)
    rolled = np.zeros(codes.size, np.uint64)
    found, owners = [], []
    mix = np.uint64(0x9E3779B97F4A7C15)
    for n in range(1, 5):
        reach = np.minimum(at + n - 1, codes.size - 1)
        rolled = (rolled + codes[reach] + np.uint64(n)) * mix
        rolled ^= rolled >> np.uint64(29)
        inside = at + n <= last
        found.append(rolled[inside])
        owners.append(owner[inside])
    whole = np.add.reduceat((codes + np.uint64(7)) * mix * (np.uint64(2) * (at - first[owner]).astype(np.uint64) + np.uint64(1)), first)
    found.append(whole ^ (whole >> np.uint64(31)))
    owners.append(np.arange(len(words)))
    owners, found = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owners, kind="stable")
    slots = ((found * mix) >> np.uint64(64 - 17)).astype(np.int64)[order]
    return slots, np.searchsorted(owners[order], np.arange(len(words)))


def emissions(words: list[str], weights: np.ndarray) -> np.ndarray:
    found = []
    for at in range(0, len(words), LOT):
        slots, begins = features(words[at : at + LOT])
        counts = np.diff(np.append(begins, slots.size))
        found.append(np.add.reduceat(weights[slots], begins, axis=0) / counts[:, None])
    return np.concatenate(found)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of all words of several sequences, and the summed posteriors of neighbouring labels.

    Every sequence is cut into blocks of ``BLOCK`` words. All blocks are advanced together, first as products of
    matrices to learn what enters each block, then with that entry; the result is that of one pass over each sequence.
    """
    n, k = scores.shape
    step = np.exp(transitions)
    blocks = -(-lengths // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    total = int(blocks.sum())
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    word = np.arange(n) - np.repeat(begin, lengths)
    place = (np.repeat(first, lengths) + word // BLOCK) * BLOCK + word % BLOCK
    e = np.ones((total * BLOCK, k))
    e[place] = np.exp(scores - scores.max(axis=1, keepdims=True))
    real = np.zeros(total * BLOCK, bool)
    real[place] = True
    e, real = e.reshape(total, BLOCK, k), real.reshape(total, BLOCK)

    across = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(BLOCK):
        moved = (across.reshape(-1, k) @ step).reshape(total, k, k) * e[:, t, None, :]
        moved /= moved.sum(axis=(1, 2), keepdims=True)
        across = np.where(real[:, t, None, None], moved, across)
    enter, leave = np.full((total, k), 1.0 / k), np.ones((total, k))
    for j in range(1, int(blocks.max(initial=0))):
        at = first[blocks > j] + j
        v = np.einsum("bi,bij->bj", enter[at - 1], across[at - 1])
        enter[at] = v / v.sum(axis=1, keepdims=True)
    for j in range(int(blocks.max(initial=0)) - 2, -1, -1):
        at = first[blocks > j + 1] + j
        v = np.einsum("bij,bj->bi", across[at + 1], leave[at + 1])
        leave[at] = v / v.sum(axis=1, keepdims=True)

    alpha, before = np.empty_like(e), np.empty_like(e)
    v = enter
    for t in range(BLOCK):
        before[:, t] = v
        v = (v @ step) * e[:, t]
        v /= v.sum(axis=1, keepdims=True)
        alpha[:, t] = v
    beta = np.empty_like(e)
    v = leave
    for t in range(BLOCK - 1, -1, -1):
        beta[:, t] = v
        back = (e[:, t] * v) @ step.T
        back /= back.sum(axis=1, keepdims=True)
        v = np.where(real[:, t, None], back, v)
    gamma = (alpha * beta).reshape(-1, k)[place]
    gamma /= gamma.sum(axis=1, keepdims=True)
    inner = word > 0
    into = (e * beta).reshape(-1, k)[place][inner]
    outof = before.reshape(-1, k)[place][inner]
    z = np.einsum("ni,ij,nj->n", outof, step, into)
    pairs = step * ((outof / z[:, None]).T @ into)
    return gamma, pairs


def fit(sample: list[tuple[str, str]], rounds: int = 40, run: int = 12, seed: int = 0) -> Tagger:
    """``sample``: (text, language). Sequences take ``run`` words of a document at a time and mix documents."""
    langs = sorted({lang for _, lang in sample})
    rng = np.random.default_rng(seed)
    runs: list[tuple[int, list[str]]] = []
    for text, lang in sample:
        words = WORDS.findall(text.lower())
        cut = [words[i : i + run] for i in range(0, len(words), run)]
        for i in rng.permutation(len(cut))[:6]:
            runs.append((langs.index(lang), cut[i]))
    if not runs:
        return Tagger([], np.zeros((BUCKETS, 1), np.float32), np.zeros((1, 1)))
    runs = [runs[i] for i in rng.permutation(len(runs))]
    words = [w for _, ws in runs for w in ws]
    label = np.concatenate([np.full(len(ws), y) for y, ws in runs])
    # a run is followed by one of the same document's language three times out of four
    order = np.argsort([y + 10 * rng.random() * (rng.random() < 0.5) for y, _ in runs], kind="stable")
    starts = np.concatenate(([0], np.cumsum([len(ws) for _, ws in runs])[:-1]))
    index = np.concatenate([np.arange(starts[i], starts[i] + len(runs[i][1])) for i in order])
    words, label = [words[i] for i in index], label[index]
    lengths = np.full(-(-len(words) // 48), 48)
    lengths[-1] = len(words) - 48 * (len(lengths) - 1)
    codes, unique = pd.factorize(np.array(words, object))
    slots, begins = features(list(unique))
    counts = np.diff(np.append(begins, slots.size))
    owner = np.repeat(np.arange(len(unique)), counts)
    used, slots_at = np.unique(slots, return_inverse=True)

    k = len(langs)
    w, trans = np.zeros((used.size, k)), np.zeros((k, k))
    gold_pairs = np.zeros((k, k))
    inner = np.ones(len(label), bool)
    inner[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = False
    at = np.flatnonzero(inner)
    np.add.at(gold_pairs, (label[at - 1], label[at]), 1)
    gold = np.eye(k)[label]
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)]
    for i in range(1, rounds + 1):
        score = np.add.reduceat(w[slots_at], begins, axis=0) / counts[:, None]
        gamma, pairs = forward_backward(score[codes], lengths, trans)
        miss = np.empty((len(unique), k))
        for c in range(k):
            miss[:, c] = np.bincount(codes, gold[:, c] - gamma[:, c], len(unique))
        miss /= counts[:, None]
        gw = np.empty_like(w)
        for c in range(k):
            gw[:, c] = np.bincount(slots_at, miss[owner, c], used.size)
        for j, (value, grad) in enumerate(((w, gw - 0.02 * w), (trans, gold_pairs - pairs - 0.1 * trans))):
            m, v = moments[2 * j], moments[2 * j + 1]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += 0.5 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-6)
    weights = np.zeros((BUCKETS, k), np.float32)
    weights[used] = w
    return Tagger(langs, weights, trans)


def training_sample(df: DataFrame, lang: str, text: str, docs_per_lang: int) -> list[tuple[str, str]]:
    """At most ``docs_per_lang`` distinct texts of each language: those whose hash falls below a share of all hashes."""
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h")
    )
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not known:
        return []
    share = F.create_map(*[F.lit(x) for k, n in known.items() for x in (k, min(1.0, 1.2 * docs_per_lang / max(n, 1)))])
    picked = rows.where((F.col("h") / F.lit(2.0**64) + 0.5) <= share[F.col("lang")])
    one = picked.groupBy("lang", "h").agg(F.first("text").alias("text"))
    from pyspark.sql import Window

    ranked = one.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= docs_per_lang)
    return [(r["text"], r["lang"]) for r in ranked.orderBy("lang", "h").collect()]


def train(df: DataFrame, keep: Column, lang: str = "lang", text: str = "text", docs_per_lang: int = 300) -> Tagger:
    """Fit on rows where ``keep`` holds and a language is given."""
    return fit(training_sample(df.where(keep), lang, text, docs_per_lang))


def tag_words(tagger: Tagger, texts: list[str | None]) -> list[tuple[list[str], np.ndarray]]:
    """Words of every text and their posteriors [words, languages]."""
    split = [WORDS.findall((t or "").lower()) for t in texts]
    lengths = np.array([len(s) for s in split])
    if not tagger.langs or not lengths.sum():
        return [(s, np.zeros((len(s), len(tagger.langs)))) for s in split]
    codes, unique = pd.factorize(np.array([w for s in split for w in s], object))
    score = emissions(list(unique), tagger.weights).astype(np.float64)
    gamma, _ = forward_backward(score[codes], lengths[lengths > 0], tagger.transitions)
    ends = np.cumsum(lengths)
    return [(s, gamma[e - n : e]) for s, e, n in zip(split, ends, lengths, strict=True)]


def identify(df: DataFrame, tagger: Tagger, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all other columns by default) with ``lang_pred``, ``score`` (the language's share of the letters),
    ``switches`` between languages, and ``sureness``: the mean over letters of their word's likeliest language. A text in
    several languages has a small score, but a sure label for each word."""
    spread = df.sparkSession.sparkContext.broadcast(tagger)  # the table of weights has a fixed size
    langs = tagger.langs

    def make(texts):
        out = {"lang_pred": [], "score": [], "switches": [], "sureness": []}
        for words, gamma in tag_words(spread.value, texts):
            if not words or not langs:
                best, score, switches, sure = UNKNOWN, 0.0, 0, 0.0
            else:
                size = np.fromiter(map(len, words), np.float64, len(words))
                mass = size @ gamma / size.sum()
                sure = float(min(1.0, size @ gamma.max(axis=1) / size.sum()))
                at = int(mass.argmax())
                best, score = langs[at], float(min(1.0, mass[at]))
                path = gamma.argmax(axis=1)
                switches = int((path[1:] != path[:-1]).sum())
            out["lang_pred"].append(best)
            out["score"].append(score)
            out["switches"].append(switches)
            out["sureness"].append(sure)
        return out

    made = ("lang_pred", "score", "switches", "sureness")
    keep = [c for c in df.columns if c != text and c not in made] if keep is None else keep
    return map_texts(df, text, "lang_pred string, score double, switches bigint, sureness double", make, keep, limit=512 << 10)
