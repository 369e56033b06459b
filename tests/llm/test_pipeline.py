"""The pipeline's decisions against the operators' own results, and odd tables through all stages."""

import corpus_pipeline as C
import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import op5_language_id as L
from wattline.llm.common import map_texts


@pytest.fixture(scope="module")
def stages(spark, small):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in C.STAGES:
        kept = stage(spark, docs, small).cache()
        out.append((name, docs, kept))
        docs = kept
    return out


def test_each_stage_keeps_a_part_of_its_input(stages):
    for name, before, after in stages:
        ids, kept = ([r.doc_id for r in d.select("doc_id").collect()] for d in (before, after))
        assert set(kept) <= set(ids) and len(kept) == len(set(kept)) and len(kept) > 0.8 * len(ids), name
        if name != "sentencepiece":
            assert after.columns == before.columns
            assert after.exceptAll(before).count() == 0


def test_near_duplicates_are_gone_and_others_kept(stages):
    _, before, after = stages[2]

    def sets(df):
        out = {}
        for r in df.collect():
            w = (r.text or "").encode().lower().split()
            out[r.doc_id] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)])
        return out

    alike = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    given, kept = sets(before), sets(after)
    keys = sorted(kept)
    assert not any(alike(kept[a], kept[b]) for i, a in enumerate(keys) for b in keys[i + 1 :])
    for gone in given.keys() - kept.keys():
        assert any(alike(given[gone], given[k]) for k in given if k != gone)


def test_no_benchmark_item_is_left(spark, stages, small):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    name, before, after = stages[3]
    holds = lambda r: any(i in " ".join(r.text.lower().split()) for i in items)
    kept = {r.doc_id for r in after.collect()}
    assert {r.doc_id for r in before.collect() if holds(r)} == {r.doc_id for r in before.collect()} - kept


def test_tokens_decode_to_the_texts(stages):
    _, before, after = stages[4]
    assert after.count() == before.count() and after.where("NOT decoded_equal").count() == 0


def test_odd_rows(spark, docs, nothing, small):
    names = ("predicted", "key", "more", "c", "t", "id", "label", "ids", "starts", "component", "n")
    rows = docs.withColumns({c: F.lit(c) for c in names})
    for table in (rows, nothing.withColumns({c: F.lit(c) for c in names})):
        given = table
        for _, stage in C.STAGES:
            given = stage(spark, given, small).cache()
            given.count()
        assert given.count() <= table.count()
    kept = C.ngram_jaccard(spark, rows, small).select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "5", "6", "None"]
    assert {r.doc_id for r in C.language_id(spark, rows, small).select("doc_id").collect()} == {1, 4, 5, None}
    assert C.decontamination(spark, rows.withColumn("n_chars", F.lit(None).cast("bigint")), small).count() == rows.count()


def test_repeated_and_missing_ids(spark, small):
    story = [f"{a} went down to the {b} and saw that the {c} was gone for good this time" for a, b, c in (("anna", "river", "boat"), ("we", "market", "fish"), ("nobody", "cellar", "wine"), ("he", "station", "train"))]
    rows = [(1, story[0], "x"), (2, story[0], "x"), (2, story[1], "x"), (2, story[1], "x"), (3, story[2], "x"), (None, story[2], "x"), (None, story[3], "x"), (None, story[3], "y"), (4, None, "x"), (5, "", "x")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = C.ngram_jaccard(spark, table, small)
    assert kept.columns == table.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(1, story[0]), (2, story[1]), (3, story[2]), (None, story[3]), (4, None), (5, "")], key=str)


def test_texts_in_several_languages_stay(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one = {r.lang: r.text for r in docs.where("lang IS NOT NULL AND length(text) > 400").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    parts = [" ".join(one[lang].split()[:25]) for lang in sorted(one)[:4]]
    mixed = spark.createDataFrame([(10**9, "\n".join(parts)), (10**9 + 1, "12 34 !"), (10**9 + 2, None)], "doc_id bigint, text string")
    rows = docs.unionByName(mixed, allowMissingColumns=True)
    kept = {r.doc_id for r in C.language_id(spark, rows, small).where("doc_id >= 1000000000").collect()}
    assert len(parts) > 2 and kept == {10**9}


def test_workers_get_the_texts_in_small_batches(spark, small):
    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    C.table(spark, small, "documents")
    texts = spark.range(0, 600, 1, 1).select("id", F.repeat(F.lit("word "), 10_000).alias("text"))
    found = texts.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
    assert sum(r.rows for r in found) == 600
    assert max(r.bytes for r in found) < 2 << 20


def test_a_limit_of_the_session_is_kept(spark, small):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    C.table(spark, small, "documents")
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "3000000")
        C.table(spark, small, "documents")
        assert spark.conf.get(key).startswith("3000000")
    finally:
        spark.conf.set(key, before)


def test_features_are_held_in_lots(monkeypatch):
    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 12, 2 * L.LOT + 5)]
    weights = rng.random((L.BUCKETS, 3)).astype(np.float32)
    slots, begins = L.features(words)
    counts = np.diff(np.append(begins, slots.size))
    at_once = np.add.reduceat(weights[slots], begins, axis=0) / counts[:, None]
    sizes = []
    monkeypatch.setattr(L, "features", lambda own, real=L.features: sizes.append(len(own)) or real(own))
    assert (L.emissions(words, weights) == at_once).all()
    assert sizes == [L.LOT, L.LOT, 5]
