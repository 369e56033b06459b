"""From raw documents to token ids in five stages.

Each stage gets what the one before kept, and drops or makes what its operator decides:

1. ``language_id``: texts without a letter, and texts whose words are labelled with a mean certainty below a half, go; a
   text that mixes several languages stays.
2. ``toxicity``: texts with a score of at least 0.3 go.
3. ``ngram_jaccard``: of each group of near duplicates (five-word shingles, similarity of at least 0.8), the document
   with the smallest id stays, one without an id only if none has one. Every row is compared by its own text, also where
   ids repeat or are missing; only rows that repeat both id and text are one document.
4. ``decontamination``: documents that hold a benchmark item within its edit budget go.
5. ``sentencepiece``: the rest is encoded with begin and end ids, with each piece's byte span in the text, and decoded
   again. Of the columns, doc_id, lang and source go on.

Other columns are carried along whatever their names.

Null and empty texts go at the first stage; an empty table passes through as an empty table. Models are learned from the
stage's input and the labels, never from rows held out by the crc32 of their id. Stages are written as Parquet and read
again, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import in_fold, table
from wattline.llm.op1_decontamination import find_leaks
from wattline.llm.op3_toxicity import score
from wattline.llm.op3_toxicity import train as train_toxicity
from wattline.llm.op5_language_id import UNKNOWN, identify
from wattline.llm.op5_language_id import train as train_language
from wattline.llm.op8_ngram_jaccard import components
from wattline.llm.op10_sentencepiece import encode
from wattline.session import drop_shuffles, materialize


def _learn() -> Column:
    """Rows that models may learn from."""
    return ~in_fold(F.col("doc_id"), 4, 2)


def _packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one, so that none can clash with what an operator makes."""
    return docs.select("text", "doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row"))


def _unpacked(kept: DataFrame, columns: list[str]) -> DataFrame:
    return kept.select(*[F.col("text") if c == "text" else F.col("__row")[c].alias(c) for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify(_packed(docs), train_language(docs, _learn()), keep=["text", "__row"])
    return _unpacked(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("sureness") >= 0.5)), docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), _learn())
    found = score(_packed(docs), model, threshold=0.3, keep=["text", "__row"])
    return _unpacked(found.where("predicted = 0"), docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a row's key is a hash of its id and text, the same whenever the row is read
    own = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    found = components(docs.select(own.alias("__key"), "text"), "__key", "text", percent=80, width=5).select(F.col("id").alias("__key"), "component")
    ids = docs.select(own.alias("__key"), "doc_id").distinct()
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__key"))
    first = materialize(found.distinct().join(ids, "__key").groupBy("component").agg(smallest.alias("x")).select("x.__key"))
    drop_shuffles(spark)
    return docs.withColumn("__key", own).join(first, "__key", "left_semi").dropDuplicates(["__key"]).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from wattline.llm.queries import model_path

    return encode(docs.select("doc_id", "lang", "source", "text"), model_path(), spans=True, check=True)


STAGES = [
    ("language_id", language_id), ("toxicity", toxicity), ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination), ("sentencepiece", sentencepiece),
]

#: Learned models and tokenizers can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
