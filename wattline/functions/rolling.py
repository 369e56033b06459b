"""Rolling statistics over the last rows of a series.

A sliding ``ROWS`` frame re-reads the whole frame for every row, which costs
``rows x width``. So only frames of a few rows are read directly. A wide frame
is put together from a few shifted copies of a narrower one, in the same
partitioning and ordering: three 8-row summaries make a 24-row one, seven of
those a 168-row one. Summaries merge exactly (count, sum, centred squares, min,
max), so nothing cancels out as it would with differences of running totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

DIRECT_ROWS = 8
MAX_PARTS = 8
STATISTICS = ("mean", "std", "min", "max")


def frame_plan(widths: Sequence[int]) -> list[tuple[int, list[tuple[int, int]]]]:
    """Steps ``(width, [(part width, rows to skip), ...])``, narrow to wide.

    A step without parts is a directly read frame.
    """
    steps: dict[int, list[tuple[int, int]]] = {}

    def build(width: int) -> None:
        if width in steps:
            return
        if width <= DIRECT_ROWS:
            steps[width] = []
            return
        parts, left = [], width
        for size in sorted(steps, reverse=True):
            while left >= size:
                parts.append((size, width - left))
                left -= size
        if left:
            build(left)
            parts.append((left, width - left))
        steps[width] = parts

    for width in sorted(set(widths)):
        if width < 1:
            raise ValueError("a frame needs at least one row")
        if width > DIRECT_ROWS and not steps:
            build(next((d for d in range(DIRECT_ROWS, 3, -1) if width % d == 0), DIRECT_ROWS))
        while width // max(steps, default=width) > MAX_PARTS:
            quotient = width // max(steps)
            build(max(steps) * next((f for f in range(MAX_PARTS, 3, -1) if quotient % f == 0), MAX_PARTS))
        build(width)
    return list(steps.items())


# What a summary must carry for each statistic, besides the count.
_CARRIED = {"mean": {"total"}, "std": {"total", "squares"}, "min": {"low"}, "max": {"high"}}


def _read_frame(value: str, carried: set[str], window: WindowSpec) -> Column:
    v = F.col(value)
    count = F.count(v).over(window)
    read = {
        "total": F.sum(v).over(window),
        "squares": F.var_pop(v).over(window) * count,
        "low": F.min(v).over(window),
        "high": F.max(v).over(window),
    }
    return F.struct(count.alias("count"), *[c.alias(k) for k, c in read.items() if k in carried])


def _merge(df: DataFrame, name: str, carried: set[str], parts: list[str]) -> DataFrame:
    """Merge summaries; a missing or empty part adds nothing.

    The parts are folded as an array: written out part by part, the code of a wide frame is too long to be compiled.
    """
    merged, held = f"{name}_merged", F.col(f"{name}_parts")

    def added(term) -> Column:
        return F.aggregate(held, F.lit(0.0), lambda total, p: total + F.coalesce(term(p), F.lit(0.0)))

    df = df.withColumn(f"{name}_parts", F.array(*parts))
    sums = [F.aggregate(held, F.lit(0).cast("long"), lambda n, p: n + F.coalesce(p["count"], F.lit(0))).alias("count")]
    if "total" in carried:
        sums.append(added(lambda p: p["total"]).alias("total"))
    df = df.withColumn(merged, F.struct(*sums))
    fields = {"count": F.col(merged)["count"]}
    if "total" in carried:
        fields["total"] = F.col(merged)["total"]
    if "squares" in carried:
        df = df.withColumn(f"{name}_mean", F.try_divide(fields["total"], fields["count"]))
        fields["squares"] = added(lambda p: _squares_about(p, F.col(f"{name}_mean")))
    if "low" in carried:
        fields["low"] = F.array_min(F.transform(held, lambda p: p["low"]))
    if "high" in carried:
        fields["high"] = F.array_max(F.transform(held, lambda p: p["high"]))
    return df.withColumn(name, F.struct(*[c.alias(k) for k, c in fields.items()])).drop(merged, f"{name}_parts", f"{name}_mean")


def _squares_about(p: Column, mean: Column) -> Column:
    offset = p["total"] / F.nullif(p["count"], F.lit(0)) - mean
    return p["squares"] + p["count"] * offset * offset


def add_frame_summaries(
    df: DataFrame, value: str, widths: Sequence[int], window: WindowSpec,
    first: int = 1, statistics: Sequence[str] = STATISTICS,
) -> DataFrame:
    """Add ``_frame_<width>`` summaries of rows ``-(first+width-1) .. -first``.

    ``first=1`` leaves the current row out, ``first=0`` includes it. Only what
    the ``statistics`` need is carried along.
    """
    carried = set().union(*[_CARRIED[s] for s in statistics])
    steps = frame_plan(widths)
    for width, parts in steps:
        name = f"_frame_{width}"
        if not parts:
            frame = window.rowsBetween(-(first + width - 1), -first)
            df = df.withColumn(name, _read_frame(value, carried, frame))
            continue
        shifted = {
            f"_part_{i}": F.lag(f"_frame_{size}", skip).over(window)
            for i, (size, skip) in enumerate(parts) if skip
        }
        names = [f"_part_{i}" if skip else f"_frame_{size}" for i, (size, skip) in enumerate(parts)]
        df = _merge(df.withColumns(shifted), name, carried, names).drop(*shifted)
    return df.drop(*[f"_frame_{w}" for w, _ in steps if w not in set(widths)])


def frame_statistic(width: int, statistic: str, min_count: int) -> Column:
    """One statistic of a summary; missing below ``min_count`` valid values."""
    s = F.col(f"_frame_{width}")
    if statistic == "mean":
        result = F.try_divide(s["total"], s["count"])
    elif statistic == "std":
        result = F.sqrt(F.try_divide(s["squares"], F.nullif(s["count"] - 1, F.lit(0))))
    elif statistic == "min":
        result = s["low"]
    elif statistic == "max":
        result = s["high"]
    else:
        raise ValueError(f"unknown statistic {statistic!r}")
    return F.when(s["count"] >= min_count, result)
