"""Approximate nearest neighbours by inner product along shifted space-filling curves.

Equal vectors are indexed once, with their ``k + 1`` smallest ids (no query can need more of them). Every vector's
direction is rotated at random, cut to a few coordinates, shifted and placed on a Hilbert curve, once for each of
``curves`` curves. Each curve is cut into ``blocks`` ranges of about equal size; a query meets the vectors of its own
range and of ``reach`` ranges on either side. The windows of all curves merge, and candidates are ranked again by the
inner product of the original vectors in double precision.

The windows are a fixed share of the data, ``(2 * reach + 1) / blocks`` of each curve, so recall doesn't fall as tables
grow (tables of few vectors get fewer ranges, so that a window holds ``k`` of them); the price is work that grows with queries times that share. Ranges of any size are cut into units of at most
``unit`` vectors by ``unit`` queries, so no task holds more.

Defined results: rows without an id, without a vector, with a vector of another length than most, with null, NaN or
infinite components or with only zeros take no part; rows that repeat an id with an equal vector count once; equal
scores go to the smaller id; fewer than ``k`` candidates give all of them; no queries give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import prepare
from wattline.session import materialize


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with integer coordinates below ``2 ** bits`` [points, dimensions]."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(dims):
            flip = (x[i] >> level) & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(turn)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> level) & 1
    return key


def projections(width: int, curves: int, dims: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations cut to ``dims`` columns [curves, width, dims] and shifts [curves, dims]."""
    rng = np.random.default_rng(seed)
    turns = np.stack([np.linalg.qr(rng.normal(size=(width, width)))[0][:, :dims] for _ in range(curves)])
    return turns, rng.uniform(0, 1, (curves, turns.shape[2]))


def curve_keys(vectors: np.ndarray, turns: np.ndarray, shifts: np.ndarray, bits: int) -> np.ndarray:
    """Keys [vectors, curves] of the vectors' directions."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    span = 9.6 / np.sqrt(vectors.shape[1])  # a random direction's coordinates deviate by 1 / sqrt(width)
    top = (1 << bits) - 1
    out = []
    for turn, shift in zip(turns, shifts, strict=True):
        place = (unit @ turn / span + 0.5 + shift) / 2 * (top + 1)
        out.append(hilbert(np.clip(place, 0, top).astype(np.int64), bits))
    return np.stack(out, axis=1)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Columns ``id`` and ``vec`` of the rows that take part."""
    v = F.col("vec")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull()).where(finite & F.exists(v, lambda x: x != 0))
    width = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (width[0]["n"] if width else 0))


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(rows, -1)


def search(
    df: DataFrame, key: str, vector: str, is_query: Column, k: int = 20, curves: int = 12, dims: int = 8, bits: int = 5,
    blocks: int = 16, reach: int = 1, unit: int = 4096, seed: int = 7,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``id``, ``score``. ``is_query`` is a condition on ``id``."""
    prepare(df.sparkSession)
    rows = usable(df, key, vector)
    small = Window.partitionBy("vec").orderBy("id")
    kept = rows.distinct().withColumn("r", F.row_number().over(small)).where(F.col("r") <= k + 1)
    base = kept.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("first", F.col("ids")[0])
    asked = rows.where(is_query).distinct()
    one = rows.limit(1).collect()
    width = len(one[0]["vec"]) if one else 1
    turns, shifts = projections(width, curves, min(dims, width), seed)

    def keyed(batches):
        for batch in batches:
            if batch.num_rows:
                keys = curve_keys(_matrix(batch.column("vec"), batch.num_rows), turns, shifts, bits)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))], names=[*batch.schema.names, "keys"])

    schema = f"vec {rows.schema['vec'].dataType.simpleString()}, ids array<bigint>, first bigint, keys array<bigint>"
    index = materialize(base.select("vec", "ids", "first").mapInArrow(keyed, schema))
    queries = materialize(asked.withColumnRenamed("id", "query_id").join(index.select("vec", "first"), "vec").select("query_id", "first"))

    # equal shares of each curve; ranges of a few vectors would leave queries with less than k candidates
    n_vectors = index.count()
    blocks = max(1, min(blocks, n_vectors // (4 * (k + 1))))
    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    found = index.agg(*[F.percentile_approx(F.col("keys")[c], shares, 10_000).alias(f"c{c}") for c in range(curves)]).first()
    cuts = [found[f"c{c}"] or [0] for c in range(curves)] if blocks > 1 else [[1 << 62]] * curves
    borders = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in cut]) for cut in cuts])
    asking = index.join(queries.select("first").distinct(), "first", "left_semi")
    n_asking = max(queries.select("first").distinct().count(), 1)

    def placed(frame: DataFrame, wide: bool, own: int, other: int) -> DataFrame:
        """One row for each unit that the vector takes part in; ``own`` and ``other``: cuts of its side and the other's."""
        at = frame.select("first", "vec", F.posexplode("keys").alias("curve", "key"))
        block = F.size(F.filter(F.element_at(borders, F.col("curve") + 1), lambda b: b <= F.col("key")))
        at = at.withColumn("block", F.explode(F.sequence(block - reach, block + reach)) if wide else block)
        mine = F.pmod(F.xxhash64("first"), F.lit(own))
        return at.withColumn("mine", mine).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.lit(other - 1))))

    cuts_c = max(1, -(-int(n_vectors * 1.2) // (blocks * unit)))
    cuts_q = max(1, -(-int(n_asking * 1.2 * (2 * reach + 1)) // (blocks * unit)))
    left = placed(asking, True, cuts_q, cuts_c).where(F.col("block").between(0, blocks - 1))
    left = left.select("curve", "block", F.col("mine").alias("q"), F.col("theirs").cast("bigint").alias("c"), F.lit(True).alias("asks"), "first", "vec")
    right = placed(index, False, cuts_c, cuts_q)
    right = right.select("curve", "block", F.col("theirs").cast("bigint").alias("q"), F.col("mine").alias("c"), F.lit(False).alias("asks"), "first", "vec")

    def rank(part: pa.Table) -> pa.Table:
        asks = np.asarray(part.column("asks"))
        first = np.asarray(part.column("first"))
        m = _matrix(part.column("vec"), part.num_rows)
        order = np.argsort(first[~asks], kind="stable")
        q, c, cid = m[asks], m[~asks][order], first[~asks][order]
        if not len(q) or not len(c):
            return pa.table({"q": pa.array([], pa.int64()), "first": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        take, out = min(k + 1, len(c)), []
        # products of blocks may be rounded otherwise than a pair's own: whatever could be among the nearest is measured
        margin = 8 * c.shape[1] * np.finfo(float).eps * np.sqrt((q * q).sum(axis=1)) * np.sqrt((c * c).sum(axis=1).max())
        for at in range(0, len(q), 64):
            product = q[at : at + 64] @ c.T
            least = np.partition(product, len(c) - take, axis=1)[:, len(c) - take] - 2 * margin[at : at + 64]
            row, near = np.nonzero(product >= least[:, None])
            exact = np.concatenate([(q[at + row[b : b + 65536]] * c[near[b : b + 65536]]).sum(axis=1) for b in range(0, len(row), 65536)])
            order = np.lexsort((near, -exact, row))
            place = np.arange(len(row)) - np.searchsorted(row, row)  # candidates are sorted by query, so are the ordered ones
            best = order[place < take]
            out.append((at + row[best], near[best], exact[best]))
        row, near, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"q": first[asks][row], "first": cid[near], "score": score})

    pairs = left.unionByName(right).groupBy("curve", "block", "q", "c").applyInArrow(rank, "q bigint, first bigint, score double")
    merged = pairs.groupBy("q", "first").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    top = merged.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    ids = top.join(index.select("first", "ids"), "first").select("q", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    lists = ids.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("near")
    )
    joined = queries.join(lists, queries["first"] == lists["q"])
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    flat = joined.select("query_id", F.posexplode(others).alias("at", "x"))
    return flat.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("id"), F.col("x.score").alias("score"))
