"""Hashed features, gains and draws against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.llm.op13_importance_resampling import MATRIX_BYTES, TABLE, buckets_of, crc_matrix, resample, segments
from wattline.llm.queries import op13_importance_resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, width=2):
    w = WORD.findall((text or "").encode().lower())
    return [zlib.crc32(b" ".join(w[i : i + r])) % 10_000 for r in range(1, width + 1) for i in range(len(w) - r + 1)], len(w)


def plainly(docs, targets, min_words=20):
    s, t = Counter(), Counter()
    own = [(key, *features(text)) for key, text in docs]
    for _, f, _ in own:
        s.update(f)
    for text in targets:
        t.update(features(text)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    rows = []
    for key, f, words in own:
        weight = math.floor(sum(map(gain, f)) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), words])
    drawn = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    ranks = {id(r): i + 1 for i, r in enumerate(drawn[: 25 * len(drawn) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=repr)


def test_crc_of_rows():
    rows = np.random.default_rng(3).integers(0, 256, (40, 17), dtype=np.uint8)
    assert crc_matrix(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]
    assert TABLE[1] == 0x77073096 and len(set(TABLE.tolist())) == 256


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é1.\n", max_size=60)), max_size=6), st.integers(1, 3), st.integers(1, 40))
def test_pieces_change_nothing(texts, width, limit):
    texts = [*texts, "w" * (MATRIX_BYTES + 9) + " a " + "v" * (MATRIX_BYTES - 3)]
    got = {i: [] for i in range(len(texts))}
    for batch in segments(texts, width, limit):
        for i, b in zip(*(x.tolist() for x in buckets_of(batch, width, 10_000)), strict=True):
            got[i].append(b)
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(features(t, width)[0]) for i, t in enumerate(texts)}


def test_every_document(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = [tuple(r) for r in op13_importance_resampling(spark, small).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(rows, key=repr) == plainly(docs, target)


def test_odd_rows(spark, docs, nothing):
    target = spark.createDataFrame([(1, "the cat and the dog"), (2, None)], "item_id int, text string")
    for rows, goal in ((docs, target), (docs, target.limit(0)), (nothing, target)):
        given_rows = rows.withColumns({"rank": F.lit("x"), "weight": F.lit(1.5), "key": F.lit(7), "n_words": F.lit(None).cast("int")})
        found = resample(given_rows, goal, min_words=1)
        assert set(found.columns) == {*given_rows.columns, "n_features"} - {"text", "n_words"}
        mine = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=repr)
        assert mine == plainly([(r.doc_id, r.text) for r in rows.collect()], [r.text for r in goal.collect()], 1)


def test_ties_go_to_the_smaller_id(spark):
    rows = spark.createDataFrame([(i % 3, "same words again") for i in range(12)], "doc_id bigint, text string")
    found = resample(rows, rows, min_words=1, percent=100).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 13))
    assert [(-r.score, r.doc_id) for r in found] == sorted((-r.score, r.doc_id) for r in found)
