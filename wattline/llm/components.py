"""Connected components of a table of links, by Spark joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wattline.session import discard, materialize


#: Links that one task may hold (16 bytes each, and their nodes).
LINKS_OF_A_TASK = 1_000_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, and the smallest node each is joined to."""
    nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = list(range(len(nodes)))
    for x, y in zip(places[: len(a)].tolist(), places[len(a) :].tolist(), strict=True):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
    found = np.array(root, dtype=np.int64)
    while (found[found] != found).any():
        found = found[found]
    return nodes, nodes[found] if len(nodes) else nodes


def _joined(batches):
    parts = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches if b.num_rows]
    if parts:
        nodes, least = roots(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], names=["node", "component"])


def connected_components(edges: DataFrame, max_rounds: int = 60, in_one_task: int = LINKS_OF_A_TASK) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of ``edges`` (columns ``a``, ``b``).

    Links that are counted and few enough are joined by one task. More are joined by rounds, which
    alternate two steps until nothing changes: every node's larger neighbours are linked to its smallest one, then
    every node and its smaller neighbours to the smallest of them. Each round writes its links to the shared folder.
    Nodes with many links stay spread: minima are combined before they are shuffled, and stored
    so that the joins with them read plain tables, which adaptive execution can split.
    """
    links = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    if links.count() <= in_one_task:
        found = materialize(links.coalesce(1).mapInArrow(_joined, "node bigint, component bigint"))
        discard(links)
        return found
    before = None
    for _ in range(max_rounds):
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        old, least = links, materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = materialize(large)
        discard(old, least)
        least = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = large.join(least, "hi").select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo"))
        seen = Observation()
        small = small.where("hi <> lo").distinct()
        links = materialize(small.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")))
        now = seen.get
        discard(large, least)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    own = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(own)
