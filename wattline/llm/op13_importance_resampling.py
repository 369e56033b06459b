"""Importance resampling towards a target, on features hashed by length-bucketed CRC matrices.

Features are all runs of one to ``width`` consecutive words. The distinct feature bytes of a batch are grouped by equal
length into two-dimensional byte arrays, one row a feature; the CRC-32 of all rows advances column by column through the
table of the polynomial, and the results are scattered back to the places where the features stand.

1. Buckets are counted over all documents and all target texts: one pass, one row per bucket from every task.
2. A bucket's gain is the logarithm of its smoothed frequency in the target over that in the documents. The gains, as
   many as buckets, go to every task; a second pass takes each document's floored mean gain.
3. A Gumbel value from a hash of the key is added, and the highest scores are drawn: a sample without replacement that
   follows the weights. The draw is a distributed sort of narrow rows.

Texts are taken whole, in pieces of bounded size that overlap by the words a run can reach back. Features longer than
``MATRIX_BYTES`` are too few and too uneven for matrices; the same CRC is taken of them one by one.

Defined results: null and empty texts, and texts without words, have no feature and weight 0, and aren't drawn if
``min_words`` is above 0; a null key hashes like an empty string and comes after other keys of the same score; rows that
repeat a key count, score and rank each; an empty target or empty documents give every bucket the smoothed frequency.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.ranking import ordinal_rank
from wattline.llm.common import map_texts, prepare, release, text_slices
from wattline.llm.words import PIECE_BYTES, word_pieces
from wattline.session import materialize

POLYNOMIAL = 0xEDB88320
MATRIX_BYTES = 256
SLICE_BYTES = 4 << 20


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(POLYNOMIAL), x >> 1).astype(np.uint32)
    return x


TABLE = _crc_table()


def crc_matrix(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a two-dimensional byte array, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = TABLE[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return ~crc


def crc_of_runs(blob: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """CRC-32 of runs of words (one row of word numbers each), the words joined by one space."""
    if not len(runs):
        return np.zeros(0, np.uint32)
    of_word = lengths[runs]
    begins = np.zeros(runs.shape, np.int64)
    np.cumsum(of_word[:, :-1] + 1, axis=1, out=begins[:, 1:])
    total = begins[:, -1] + of_word[:, -1]
    out = np.zeros(len(runs), np.uint32)
    order = np.argsort(total, kind="stable")
    sizes, first = np.unique(total[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, first[1:]), strict=True):
        if size > MATRIX_BYTES:
            for r in rows.tolist():
                words = [blob[offsets[w] : offsets[w] + lengths[w]].tobytes() for w in runs[r].tolist()]
                out[r] = zlib.crc32(b" ".join(words))
            continue
        matrix = np.full((len(rows), size), 32, np.uint8)
        for slot in range(runs.shape[1]):
            n = of_word[rows, slot]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row = np.repeat(np.arange(len(rows)), n)
            matrix[row, np.repeat(begins[rows, slot], n) + within] = blob[np.repeat(offsets[runs[rows, slot]], n) + within]
        out[rows] = crc_matrix(matrix)
    return out


def segments(texts: list[str | None], width: int, limit: int = PIECE_BYTES) -> Iterator[list[tuple[int, list[bytes], int]]]:
    """Batches of about ``limit`` bytes of (number of the text, words, how many of them were there in the piece before)."""
    batch, held = [], 0
    for i, text in enumerate(texts):
        before: list[bytes] = []
        for words in word_pieces(text, limit):
            batch.append((i, before + words, len(before)))
            before = (before + words)[-(width - 1) :] if width > 1 else []
            held += sum(map(len, words))
            if held >= limit:
                yield batch
                batch, held = [], 0
    if batch:
        yield batch


def buckets_of(batch: list[tuple[int, list[bytes], int]], width: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For every feature that stands in a batch, repeats included: the number of its text, and its bucket."""
    sizes = np.array([len(words) for _, words, _ in batch])
    codes, unique = pd.factorize(np.array([w for _, words, _ in batch for w in words], object))
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.fromiter(map(len, unique), np.int64, len(unique))
    offsets = np.cumsum(lengths) - lengths
    blob = np.frombuffer(b"".join(unique), np.uint8)
    text = np.repeat(np.array([i for i, _, _ in batch]), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    new = place >= np.repeat(np.array([c for _, _, c in batch]), sizes)
    of_text, found = [], []
    run = np.zeros(len(codes), np.int64)
    distinct = np.zeros((1, 0), np.int64)
    for size in range(1, width + 1):
        # a run of this size that ends at p is the shorter run that ends at p - 1, and the word at p
        ends = np.flatnonzero(place >= size - 1)
        number, pairs = pd.factorize((run[ends - 1] if size > 1 else 0) * np.int64(len(unique)) + codes[ends])
        distinct = np.column_stack([distinct[pairs // len(unique)], pairs % len(unique)])
        counted = new[ends]
        crc = crc_of_runs(blob, offsets, lengths, distinct)
        found.append((crc.astype(np.int64) % buckets)[number[counted]])
        of_text.append(text[ends[counted]])
        run = np.zeros(len(codes), np.int64)
        run[ends] = number
    return np.concatenate(of_text), np.concatenate(found)


def count_buckets(df: DataFrame, text: str, width: int, buckets: int) -> DataFrame:
    """``bucket`` and ``n``: how many features of all texts fall into each bucket that has any."""
    prepare(df.sparkSession)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, "__text", SLICE_BYTES):
                for found in segments(part.column("__text").to_pylist(), width, SLICE_BYTES):
                    total += np.bincount(buckets_of(found, width, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        release()
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], names=["bucket", "n"])

    rows = df.select(F.col(f"`{text}`").cast("string").alias("__text"))
    return rows.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", width: int = 2, buckets: int = 10_000) -> np.ndarray:
    """The gain of every bucket in thousandths: log of target over documents, both with one count more a bucket.

    What reaches the driver is one number a bucket and side.
    """
    both = count_buckets(docs, text, width, buckets).withColumn("side", F.lit(0)).unionByName(
        count_buckets(target, target_text, width, buckets).withColumn("side", F.lit(1)))
    counts = np.zeros((2, buckets))
    for r in both.collect():
        counts[r["side"], r["bucket"]] = r["n"]
    (s, t), (all_s, all_t) = counts, counts.sum(axis=1)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, text: str = "text", keep: list[str] | None = None, width: int = 2) -> DataFrame:
    """``keep`` (all other columns by default), ``n_words``, ``n_features`` and ``weight``: the floored mean gain."""
    buckets = len(gains)

    def make(texts):
        sums, n, words = np.zeros(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for batch in segments(texts, width, SLICE_BYTES):
            of_text, found = buckets_of(batch, width, buckets)
            sums += np.bincount(of_text, gains[found], len(texts))
            n += np.bincount(of_text, minlength=len(texts))
            for i, own, before in batch:
                words[i] += len(own) - before
        return {"n_words": words, "n_features": n, "weight": sums.astype(np.int64) // np.maximum(n, 1)}

    made = ("n_words", "n_features", "weight")
    keep = [c for c in docs.columns if c != text and c not in made] if keep is None else keep
    return map_texts(docs, text, "n_words bigint, n_features bigint, weight bigint", make, keep, SLICE_BYTES)


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", keep: list[str] | None = None,
    width: int = 2, buckets: int = 10_000, percent: int = 25, min_words: int = 20, salt: str = "7:",
) -> DataFrame:
    """``keep`` (all other columns by default) with ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the rows with at least ``min_words`` words, ``percent`` hundredths are drawn; ``rank`` counts them from the highest
    score, and is null for all others.
    """
    made = ("n_words", "n_features", "weight", "score", "rank")
    keep = [c for c in docs.columns if c != text and c not in made] if keep is None else keep
    gains = bucket_gains(docs, target, text, target_text, width, buckets)
    named = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").cast("string").alias("__text"))
    weighed = weigh(named, gains, "__text", [*keep, "__key"], width)
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("__key").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    scored = materialize(weighed.withColumn("score", F.col("weight") + gumbel))
    long_enough = F.col("n_words") >= min_words
    n = percent * scored.where(long_enough).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("__key"), "n_features", "weight"]
    ranked = ordinal_rank(scored.where(long_enough), order, "rank").withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    rest = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select(*[F.col(f"`{c}`") for c in keep], "n_features", "weight", "score", "rank")
