"""Helpers shared by the operators: tables, text batches, splits and bounded samples."""

from __future__ import annotations

import ctypes
import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver itself found it, and get rows in batches of a slice's size.

    An executor holds a batch several times outside its heap, and so do its workers: Spark's own limit is 64 MB. A limit
    that the session sets is kept.
    """
    import wattline

    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(CHUNK_BYTES))

    root = os.path.dirname(os.path.dirname(os.path.abspath(wattline.__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(key: Column, folds: int, fold: int) -> Column:
    """True for rows whose crc32 of the key, written as text, has this remainder; a null key counts as 0."""
    return F.coalesce(F.crc32(key.cast("string")), F.lit(0)) % folds == fold


def text_slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most ``limit`` bytes of text each, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start, total = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            ends.append(i)
            start, total = i, 0
        total += size
    start = 0
    for end in [*ends, batch.num_rows]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end


def release() -> None:
    """Give memory that a finished task no longer needs back to the system: workers live on and share an executor."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(df: DataFrame, column: str, schema: str, make, carry: list[str] | None = None, limit: int = CHUNK_BYTES) -> DataFrame:
    """Run ``make(texts) -> dict of columns`` over slices of whole texts; nulls are passed as None.

    ``carry`` names the input columns that are returned next to the made ones; all others are not read. ``limit`` is
    the text of one slice, in bytes.
    """
    from pyspark.sql.types import StructType

    prepare(df.sparkSession)
    carry = [c for c in df.columns if c != column] if carry is None else carry
    own = column if column in carry and dict(df.dtypes)[column] == "string" else "__text"
    source = df.select(*[F.col(f"`{c}`") for c in carry])
    if own == "__text":
        source = df.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{column}`").cast("string").alias(own))
    made = StructType.fromDDL(schema)
    out = StructType(list(df.select(*[F.col(f"`{c}`") for c in carry]).schema.fields) + list(made.fields))
    target = _arrow_schema(out)
    names = [f.name for f in made.fields]

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, own, limit):
                columns = make(part.column(own).to_pylist())
                arrays = [part.column(c).cast(target.field(c).type) for c in carry]
                arrays += [pa.array(columns[n], target.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
        release()

    return source.mapInArrow(run, out)


def _arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def labelled_ids(labels: DataFrame, label: str, keep: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled ids of each class, those with the smallest hash; one row per id."""
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & keep)
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    parts = [
        one.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))
