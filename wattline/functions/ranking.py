"""Ordinal ranks over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.session import materialize, max_group_rows


def ordinal_rank(df: DataFrame, order: Sequence, out: str) -> DataFrame:
    """1..n in the given (total) order.

    A window without partitions sorts everything in one task, so it is used
    only for tables of counted, moderate size. Larger ones are range-sorted and
    stored; a row's rank is then its place in its partition plus the sizes of
    the partitions before it.
    """
    rows = materialize(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    if rows.count() <= max_group_rows(df.sparkSession):
        return rows.withColumn(out, F.row_number().over(Window.orderBy("_place")).cast("long")).drop("_place")
    rows = rows.withColumn("_part", F.shiftright("_place", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    in_part = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # One offset per sort partition, a number fixed by the shuffle setting.
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_before") + in_part + 1).cast("long"))
        .drop("_place", "_part", "_before")
    )
