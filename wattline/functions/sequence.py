"""Operators over one ordered series per meter: lags, rolls, runs, fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.groups import SEGMENT, LongGroups, Series, as_series, join_groups
from wattline.functions.rolling import STATISTICS, add_frame_summaries, frame_statistic
from wattline.schemas import KEYS, ORDER, TARGET


# Rows of the short frame that looks ahead for the end of an outage.
AHEAD = 8


def quarter_full(width: int) -> int:
    """A rolling value needs a quarter of its frame."""
    return max(1, width // 4)


# --- steps on prepared rows -------------------------------------------------

def lag_step(df: DataFrame, series: Series, lags: Sequence[int], value: str = TARGET) -> DataFrame:
    w = series.window()
    df = df.withColumns({f"lag_{n}h": F.lag(value, n).over(w) for n in lags})
    both = {24, 168} <= set(lags)
    return df.withColumn(
        "lag_diff_24h", F.col("lag_24h") - F.col("lag_168h") if both else F.lit(None).cast("double")
    )


def rolling_step(
    df: DataFrame,
    series: Series,
    widths: Sequence[int],
    value: str = TARGET,
    statistics: Sequence[str] = STATISTICS,
    min_count=quarter_full,
    include_current: bool = False,
) -> DataFrame:
    df = add_frame_summaries(df, value, widths, series.window(), 0 if include_current else 1, statistics)
    df = df.withColumns({
        f"rolling_{stat}_{width}h": frame_statistic(width, stat, min_count(width))
        for width in widths for stat in statistics
    })
    return df.drop(*[f"_frame_{w}" for w in widths])


def null_zero_runs_step(df: DataFrame, series: Series, min_length: int, value: str = TARGET) -> DataFrame:
    """Null zeros in runs of at least ``min_length`` rows; a null reading ends a run.

    The length of a run so far is the distance to the last row that isn't zero.
    A zero is in a long run if that length has reached the limit, or does so
    within the next ``min_length - 1`` rows, which are looked at in a few
    shifted copies of a short frame. Everything keeps the series' one order.
    """
    w = series.window()
    zero = F.coalesce(F.col(value) == 0, F.lit(False))
    df = df.withColumn("_row", F.row_number().over(w))
    last = F.last(F.when(~zero, F.col("_row")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_length", F.col("_row") - F.coalesce(last, F.lit(0)))
    reaches = (F.col("_length") == min_length).cast("int")
    step = min(AHEAD, min_length)
    df = df.withColumn("_ahead", F.max(reaches).over(w.rowsBetween(0, step - 1)))
    offsets = [*range(0, min_length - step, step), min_length - step]
    near = F.greatest(F.lit(0), *[F.lead("_ahead", n).over(w) if n else F.col("_ahead") for n in offsets])
    df = df.withColumn("_near", near)
    too_long = zero & ((F.col("_length") >= min_length) | (F.col("_near") == 1))
    return df.withColumn(value, F.when(~too_long, F.col(value))).drop("_row", "_length", "_ahead", "_near")


# --- stand-alone operators --------------------------------------------------

def add_lags(
    df: DataFrame, lags: Sequence[int] = (24, 168), value: str = TARGET,
    long: LongGroups | None = None, keys: Sequence[str] = KEYS,
) -> DataFrame:
    """``lag_<n>h``: the value n rows back in the same series."""
    s = as_series(df, long, keys, before=max(lags))
    return s.owned(lag_step(s.rows, s, lags, value))


def add_rolling(
    df: DataFrame, widths: Sequence[int] = (24, 168), value: str = TARGET,
    statistics: Sequence[str] = STATISTICS, min_count=quarter_full,
    include_current: bool = False, long: LongGroups | None = None, keys: Sequence[str] = KEYS,
) -> DataFrame:
    """``rolling_<stat>_<w>h`` over the last w rows, by default without the current one."""
    s = as_series(df, long, keys, before=max(widths))
    return s.owned(rolling_step(s.rows, s, widths, value, statistics, min_count, include_current))


def null_zero_runs(
    df: DataFrame, min_length: int = 48, value: str = TARGET,
    long: LongGroups | None = None, keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Outages: zero readings in runs of ``min_length`` rows or more become missing."""
    s = as_series(df, long, keys, before=min_length, after=min_length)
    return s.owned(null_zero_runs_step(s.rows, s, min_length, value))


def add_run_length(
    df: DataFrame, flag: str, out: str,
    long: LongGroups | None = None, keys: Sequence[str] = KEYS, order: str = ORDER,
) -> DataFrame:
    """Length of the run of equal flags a row belongs to; 0 where the flag is 0 or missing.

    A missing flag ends a run.
    """
    s = as_series(df, long, keys, order)
    w = s.window()
    before = F.lag(F.struct(F.col(flag).alias("flag"))).over(w)
    changed = before.isNotNull() & ~F.col(flag).eqNullSafe(before["flag"])
    rows = s.rows.withColumn("_changed", changed.cast("int"))
    rows = rows.withColumn("_run", F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*s.keys, "_run").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_length", F.count(F.lit(1)).over(run)).drop("_changed")
    if s.split:
        rows = _join_runs(rows, flag, list(keys))
    rows = rows.withColumn(out, F.when(F.col(flag) != 0, F.col("_length")).otherwise(F.lit(0)).cast("long"))
    return s.owned(rows.drop("_run", "_length"))


def _join_runs(rows: DataFrame, flag: str, keys: list[str]) -> DataFrame:
    """Extend runs over segment borders.

    Every segment reports its first and last run, and neighbouring pieces with
    the same flag are added up: a few rows per segment instead of the series.
    """
    by_chain = Window.partitionBy(*keys, "_chain")
    pieces = (
        rows.groupBy(*keys, SEGMENT)
        .agg(
            F.min_by(F.struct(F.col(flag).alias("flag"), F.col("_length").alias("length")), "_run").alias("head"),
            F.max_by(F.struct(F.col(flag).alias("flag"), F.col("_length").alias("length")), "_run").alias("tail"),
            F.max("_run").alias("_last"),
        )
        .withColumn("whole", F.col("_last") == 0)
        .select(*keys, SEGMENT, "_last", F.posexplode(
            F.when(F.col("whole"), F.array("head")).otherwise(F.array("head", "tail"))).alias("_pos", "_piece"))
    )
    in_order = Window.partitionBy(*keys).orderBy(SEGMENT, "_pos")
    breaks = (F.col("_pos") > 0) | ~F.col("_piece.flag").eqNullSafe(F.lag("_piece.flag").over(in_order))
    totals = (
        pieces.withColumn("_break", breaks.cast("int"))
        .withColumn("_chain", F.sum("_break").over(in_order))
        .withColumn("_total", F.sum("_piece.length").over(by_chain))
        .groupBy(*keys, SEGMENT)
        .agg(F.max(F.when(F.col("_pos") == 0, F.col("_total"))).alias("_head"),
             F.max(F.when(F.col("_pos") == 1, F.col("_total"))).alias("_tail"),
             F.max("_last").alias("_last"))
    )
    length = (
        F.when(F.col("_run") == 0, F.col("_head"))
        .when(F.col("_run") == F.col("_last"), F.col("_tail"))
        .otherwise(F.col("_length"))
    )
    return join_groups(rows, totals, [*keys, SEGMENT], "left").withColumn("_length", length).drop("_head", "_tail", "_last")


def fill_from_neighbours(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str],
    order: str = ORDER, long: LongGroups | None = None,
) -> DataFrame:
    """Last known value of the group, else its first known one.

    A row without an earlier value lies before the group's first value, so the
    backward fill is always that first value.
    """
    s = as_series(df, long, keys, order)
    past = s.window().rowsBetween(Window.unboundedPreceding, 0)
    whole = s.window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if not s.split:
        return s.rows.withColumns({
            c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(whole))
            for c in columns
        })
    ends = s.rows.groupBy(*keys, SEGMENT).agg(*[
        agg for c in columns for agg in (
            F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_head_{c}"),
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_tail_{c}"),
        )
    ])
    segments = Window.partitionBy(*keys).orderBy(SEGMENT)
    before = segments.rowsBetween(Window.unboundedPreceding, -1)
    all_segments = segments.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = ends.select(*keys, SEGMENT, *[
        F.coalesce(F.last(f"_tail_{c}", ignorenulls=True).over(before),
                   F.first(f"_head_{c}", ignorenulls=True).over(all_segments)).alias(f"_carry_{c}")
        for c in columns
    ])
    rows = s.rows.withColumns({c: F.last(c, ignorenulls=True).over(past) for c in columns})
    rows = join_groups(rows, carried, [*keys, SEGMENT], "left").withColumns({c: F.coalesce(c, f"_carry_{c}") for c in columns})
    return s.owned(rows.drop(*[f"_carry_{c}" for c in columns]))
