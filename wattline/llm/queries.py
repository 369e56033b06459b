"""The registered queries of this package, and their comparison SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import in_fold, table
from wattline.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]
MODEL = "piece_bpe_32k.model"


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op1_decontamination import find_leaks

    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    leak = F.col("leak")
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", leak["item_id"].alias("item_id"), leak["start"].alias("start"), leak["end"].alias("end"), leak["edits"].alias("edits")
    )


def op2_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op2_quotation_links import link_quotes

    found = link_quotes(table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "turn", "role", "text", "reply_to", "place", "n_quoted", "n_linked", "format")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op3_toxicity import score, train

    docs, held = table(spark, sf_dir, "documents"), in_fold(F.col("doc_id"), 4, 2)
    model = train(docs, table(spark, sf_dir, "labels"), ~held)
    found = score(docs.select("doc_id", "text"), model, threshold=0.3)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op4_html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op5_language_id import identify, train

    docs, held = table(spark, sf_dir, "documents"), in_fold(F.col("doc_id"), 4, 2)
    found = identify(docs.select("doc_id", "text"), train(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "switches")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op6_quality import score, train

    docs, held = table(spark, sf_dir, "documents"), in_fold(F.col("doc_id"), 3, 1)
    model = train(docs, table(spark, sf_dir, "labels"), ~held)
    return score(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "score", "predicted", "strength")


def op7_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op7_hilbert_ann import search

    found = search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op8_ngram_jaccard import components

    found = components(table(spark, sf_dir, "documents"), "doc_id", "text", percent=90, width=3)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op9_token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), model_path(), limit=4096, keep=["doc_id"])


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op10_sentencepiece import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), model_path(), ["doc_id"])


def op11_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op11_license_templates import joined_labels, scan_licenses

    found = scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("matches", lambda m: m["phrase"])
    starts = F.transform(base, lambda m: m["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined_labels(base).alias("base_labels"), joined_labels(F.col("matches")).alias("labels"), F.col("coverage").alias("score"),
        F.exists("matches", lambda m: m["whole"]).alias("whole"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op12_fill_in_middle import fill_in_middle, restored

    made = fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattline.llm.op13_importance_resampling import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_quotation_links, op3_toxicity, op4_html_text, op5_language_id, op6_quality, op7_hilbert_ann, op8_ngram_jaccard, op9_token_counts, op10_sentencepiece, op11_license_templates, op12_fill_in_middle, op13_importance_resampling)}
