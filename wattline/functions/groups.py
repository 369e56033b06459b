"""Splitting series that are too long for one task.

Sequence operators sort one series per task. That is the cheapest plan while
every series fits, so it is used whenever a count of the groups says so. Series
above ``spark.wattline.maxGroupRows`` rows are cut into segments of about that
size, at days, and inside days, hours, minutes or seconds that alone hold more. Each segment also receives the neighbouring rows its frames reach, so
windows over ``(keys, segment)`` give the same results as windows over the
whole series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattline.schemas import KEYS, ORDER
from wattline.session import materialize, max_group_rows

SEGMENT = "_segment"
_OWNER = "_owner"


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys as windows and aggregates group them: a missing key equals a missing key."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


@dataclass(frozen=True)
class LongGroups:
    """The groups above the row limit; ``keys_table`` is None when there are none. ``rows`` are those of all groups, and
    ``all`` tells that no group is short."""

    keys: tuple[str, ...]
    limit: int
    keys_table: DataFrame | None
    rows: int = 0
    all: bool = False

    def __bool__(self) -> bool:
        return self.keys_table is not None


def find_long_groups(df: DataFrame, keys: Sequence[str] = KEYS, limit: int | None = None) -> LongGroups:
    """Count rows per group (map-side combined, key columns only) and keep the long ones.

    A result measured on a superset of rows, such as the raw readings, stays
    valid for every later stage that only drops rows.
    """
    limit = limit or max_group_rows(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(F.min("n").alias("shortest"), F.max("n").alias("longest"), F.sum("n").alias("rows")).first()
    rows = found["rows"] or 0
    if rows == 0 or found["longest"] <= limit:
        return LongGroups(tuple(keys), limit, None, rows)
    long = counts.where(F.col("n") > limit)
    return LongGroups(tuple(keys), limit, materialize(long.select(*keys)) if keys else long, rows, found["shortest"] > limit)


# Rows a task of sequence work holds and sorts, about.
TASK_ROWS = 500_000


def spread_series(df: DataFrame, rows: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Series spread over tasks of about ``TASK_ROWS`` rows, where the shuffle setting alone would make larger ones.

    Meters of one building stay together: its table can be joined where they are. What is spread already is not moved.
    """
    parts = max(-(-rows // TASK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [c for c in keys if c == "building_id"] or list(keys)
    return df.repartition(parts, *by) if by else df


@dataclass(frozen=True)
class Series:
    """Rows ready for windows over ``keys``; ``owned`` drops the borrowed rows."""

    rows: DataFrame
    keys: list[str]
    order: str

    @property
    def split(self) -> bool:
        return SEGMENT in self.keys

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.order)

    def group(self) -> WindowSpec:
        """The whole series; in the order of ``window``, if there is one, so that both share a sort."""
        if not self.order:
            return Window.partitionBy(*self.keys)
        return self.window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def owned(self, df: DataFrame) -> DataFrame:
        if not self.split:
            return df
        return df.where(F.col(SEGMENT) == F.col(_OWNER)).drop(SEGMENT, _OWNER)


# Grains at which long series are cut, in microseconds: day, hour, minute, second and one.
GRAINS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1)


def _at_grain(order: str, grain: int) -> Column:
    """Begin of the grain a row lies in; grains are nested, so begins of several grains keep the order of time."""
    micros = F.unix_micros(F.col(order).cast("timestamp"))
    return micros - F.pmod(micros, F.lit(grain))


def _with_slots(df: DataFrame, long: LongGroups, order: str, finer: list[DataFrame]) -> DataFrame:
    """Rows with ``_slot``: their day; for each table of ``finer``, the next grain where the slot is listed there."""
    keys = list(long.keys)
    rows = df.withColumn("_slot", _at_grain(order, GRAINS[0]))
    for grain, crowded in zip(GRAINS[1:], finer, strict=False):
        listed = crowded.select(*keys, "_slot", F.lit(True).alias("_crowded"))
        rows = join_groups(rows, listed, [*keys, "_slot"], "left").withColumn(
            "_slot", F.when(F.col("_crowded"), _at_grain(order, grain)).otherwise(F.col("_slot"))).drop("_crowded")
    return rows


def _crowded_slots(df: DataFrame, long: LongGroups, order: str) -> list[DataFrame]:
    """Days of a series that hold more rows than the limit, hours of these days that do, and so on; stored.

    There are at most as many as the rows divided by the limit, so slots stay few however dense a day is.
    """
    keys, finer = list(long.keys), []
    rows = join_groups(df, long.keys_table, keys, "left_semi").select(*keys, order)
    while len(finer) < len(GRAINS) - 1:
        counts = _with_slots(rows, long, order, finer).groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_rows"))
        crowded = materialize(counts.where(F.col("_rows") > long.limit))
        if crowded.isEmpty():
            break
        finer.append(crowded)
    return finer


def _cut(df: DataFrame, long: LongGroups, order: str, before: int, after: int, finer: list[DataFrame]) -> DataFrame:
    """Per long group and slot: its segment, and the first and last segment reading it.

    One row per day of a series, and more only where a day is crowded, so a
    group's rows here are few however many readings it holds.
    """
    keys = list(long.keys)
    days = (
        _with_slots(join_groups(df, long.keys_table, keys, "left_semi").select(*keys, order), long, order, finer)
        .groupBy(*keys, "_slot")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    in_order = Window.partitionBy(*keys).orderBy("_slot")
    days = days.withColumn(
        "_start", F.coalesce(F.sum("_rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("_end", F.col("_start") + F.col("_rows"))
    by_band = Window.partitionBy(*keys).orderBy("_band")
    days = days.withColumn("_band", F.floor(F.col("_start") / long.limit))
    days = days.withColumn(_OWNER, F.dense_rank().over(by_band) - 1)
    first, last = F.col(_OWNER), F.col(_OWNER)
    if before:
        ahead = Window.partitionBy(*keys).orderBy("_start").rangeBetween(0, before - 1)
        days = days.withColumn("_reach", F.max(_OWNER).over(ahead))
        last = F.coalesce(F.lead("_reach").over(in_order), last)
    if after:
        behind = Window.partitionBy(*keys).orderBy("_end").rangeBetween(-(after - 1), 0)
        days = days.withColumn("_back", F.min(_OWNER).over(behind))
        first = F.coalesce(F.lag("_back").over(in_order), first)
    return days.select(*keys, "_slot", _OWNER, first.alias("_first"), last.alias("_last"))


def as_series(
    df: DataFrame,
    long: LongGroups | None = None,
    keys: Sequence[str] = KEYS,
    order: str = ORDER,
    before: int = 0,
    after: int = 0,
) -> Series:
    """Prepare ``df`` for windows reaching ``before`` rows back and ``after`` rows ahead."""
    if long is None:
        long = find_long_groups(df, keys)
    if not long:
        crowded = long.rows > TASK_ROWS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return Series(spread_series(df, long.rows, keys) if crowded else df, list(keys), order)
    finer = _crowded_slots(df, long, order)
    cut = materialize(_cut(df, long, order, before, after, finer))
    rows = (
        join_groups(_with_slots(df, long, order, finer), cut, [*keys, "_slot"], "left")
        .withColumn(_OWNER, F.coalesce(_OWNER, F.lit(0)))
        .withColumn(
            SEGMENT,
            F.explode(F.sequence(F.coalesce("_first", F.lit(0)), F.coalesce("_last", F.lit(0)))),
        )
        .drop("_slot", "_first", "_last")
    )
    return Series(rows, [*keys, SEGMENT], order)
