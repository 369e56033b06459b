"""Exact quantiles per group, for groups of any size.

Spark's ``percentile`` keeps a group's distinct values in one task. That is
fine for a meter-year; for a group of unbounded size the wanted ranks are
selected digit by digit: a double is mapped to a 64-bit integer of the same
order, and four passes count its 16-bit digits, each only among the values that
agree with a wanted rank so far. What is shuffled is at most 65,536 counts per
group, wanted prefix and task, combined map-side; what passes from one pass to
the next is one row per group and wanted prefix. Once few rows agree with a
wanted rank, their remaining digits are counted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.groups import LongGroups, find_long_groups, join_groups
from wattline.schemas import KEYS
from wattline.session import discard, materialize

DIGIT_BITS, CODE_BITS = 16, 64
#: So many rows that may still hold a wanted rank are counted by all their remaining bits at once.
LAST_ROWS = 1_000_000
_FRACTION_BITS, _BIAS, _LOWEST = 52, 1023, -1022


def group_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float],
    keys: Sequence[str] = KEYS, long: LongGroups | None = None,
) -> DataFrame:
    """One row per group with the named, linearly interpolated quantiles of ``value``."""
    keys = list(keys)
    df = df.select(*keys, F.col(value).cast("double").alias("_value"))
    if long is None:
        long = find_long_groups(df.where(F.col("_value").isNotNull()), keys)
    if not long:
        return _direct(df, keys, probabilities)
    if not keys or long.all:
        return _by_counting(df, keys, probabilities)
    short = _direct(join_groups(df, long.keys_table, keys, "left_anti"), keys, probabilities)
    return short.unionByName(_by_counting(join_groups(df, long.keys_table, keys, "left_semi"), keys, probabilities))


def _direct(df: DataFrame, keys: list[str], probabilities: dict[str, float]) -> DataFrame:
    return df.groupBy(*keys).agg(*[
        F.percentile("_value", F.lit(p)).alias(name) for name, p in probabilities.items()
    ])


def order_code(value: Column) -> Column:
    """A 64-bit integer with the order of a double, both zeros alike, NaN above all: its bits, negated below zero."""
    x = F.abs(value)
    exponent = _exponent(x, F.floor(F.log2(x)).cast("int"))
    return _bits(value, x, exponent, _scaled(x, exponent))


def _exponent(x: Column, guess: Column) -> Column:
    # the logarithm may be off by one next to a power of two
    exact = guess + F.when(x >= F.pow(F.lit(2.0), guess + 1), 1).when(x < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    return F.greatest(exact, F.lit(_LOWEST))


def _scaled(x: Column, exponent: Column) -> Column:
    return x / F.pow(F.lit(2.0), exponent)


def _bits(value: Column, x: Column, exponent: Column, scaled: Column) -> Column:
    biased = F.when(scaled >= 1, exponent + _BIAS).otherwise(0).cast("long")
    fraction = (F.when(scaled >= 1, scaled - 1).otherwise(scaled) * float(1 << _FRACTION_BITS)).cast("long")
    largest = F.lit((2 * _BIAS + 1) << _FRACTION_BITS)
    bits = (
        F.when(x == 0, F.lit(0).cast("long")).when(F.isnan(x), largest + 1).when(x == float("inf"), largest)
        .otherwise(F.shiftleft(biased, _FRACTION_BITS) + fraction)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def _with_codes(df: DataFrame) -> DataFrame:
    """``order_code`` of ``_value``, step by step: each step is computed once, and the code is short enough to be compiled."""
    x, exponent = F.col("_x"), F.col("_exponent")
    df = df.withColumn("_x", F.abs("_value")).withColumn("_guess", F.floor(F.log2(x)).cast("int"))
    df = df.withColumn("_exponent", _exponent(x, F.col("_guess"))).withColumn("_scaled", _scaled(x, exponent))
    return df.withColumn("_code", _bits(F.col("_value"), x, exponent, F.col("_scaled")))


def code_value(code: Column) -> Column:
    """The double of an order code."""
    bits = F.abs(code)
    biased = F.shiftright(bits, _FRACTION_BITS)
    fraction = bits.bitwiseAND(F.lit((1 << _FRACTION_BITS) - 1)).cast("double")
    size = (
        F.when(biased == 0, fraction * F.pow(F.lit(2.0), F.lit(_LOWEST - _FRACTION_BITS)))
        .when(biased > 2 * _BIAS, F.when(fraction > 0, F.lit(float("nan"))).otherwise(F.lit(float("inf"))))
        .otherwise((fraction / float(1 << _FRACTION_BITS) + 1) * F.pow(F.lit(2.0), biased - _BIAS))
    )
    return F.when(code < 0, -size).otherwise(size)


def _asked(total: Column, probabilities: dict[str, float]) -> Column:
    """The two ranks (from 0) each quantile lies between, and how far it is from the lower one."""
    last = total - 1
    return F.array(*[
        F.struct(
            F.lit(name).alias("name"), F.lit(side).alias("side"), (last * p - F.floor(last * p)).alias("share"),
            (F.floor(last * p) if side == 0 else F.ceil(last * p)).cast("long").alias("rank"))
        for name, p in probabilities.items() for side in (0, 1)
    ])


def _by_counting(df: DataFrame, keys: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Codes are stored once, next to their keys, and read once per digit; ``df`` is read once.

    A pass counts whole numbers only, so that it is a hash aggregation in compiled code; which ranks are asked for is
    joined to the few counts.
    """
    # A constant stands in for the keys of an ungrouped quantile.
    by = keys or ["_all"]
    rows = df.where(F.col("_value").isNotNull())
    codes = materialize(_with_codes(rows if keys else rows.withColumn("_all", F.lit(0))).select(*by, "_code"))
    found, done, left = None, 0, 0
    while done < CODE_BITS:
        bits = CODE_BITS - done if found is not None and left <= LAST_ROWS else DIGIT_BITS
        digit = F.shiftright("_code", CODE_BITS - done - bits)
        if found is None:
            # the first digit keeps the sign, so that its order is that of the codes
            counts = codes.groupBy(*by, digit.alias("_digit")).agg(F.count(F.lit(1)).alias("_count"))
            group = Window.partitionBy(*by)
            counts = counts.withColumn("_asks", _asked(F.sum("_count").over(group), probabilities))
        else:
            rows = codes.withColumn("_prefix", F.shiftright("_code", CODE_BITS - done))
            rows = join_groups(rows, found.select(*by, "_prefix"), [*by, "_prefix"], "left_semi").withColumn("_digit", digit)
            counts = rows.groupBy(*by, "_prefix", "_digit").agg(F.count(F.lit(1)).alias("_count"))
            counts = join_groups(counts, found.drop("_count"), [*by, "_prefix"])
            group = Window.partitionBy(*by, "_prefix")
        before = group.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_below", F.coalesce(F.sum("_count").over(before), F.lit(0)))
        # a few rows per group, stored: plans of later passes would hold all passes before them
        found = materialize(counts.select(*by, F.col("_digit").alias("_prefix"), "_count", _inside().alias("_asks")).where(F.size("_asks") > 0))
        done += bits
        left = found.agg(F.sum("_count")).first()[0] or 0
    discard(codes)
    value = code_value(F.col("_prefix"))
    ends = found.select(*by, "_prefix", F.inline("_asks")).groupBy(*by).agg(*[
        F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.struct(value.alias("v"), "share"))).alias(f"_{name}_{side}")
        for name in probabilities for side in (0, 1)
    ])
    result = ends.select(*by, *[_between(F.col(f"_{name}_0"), F.col(f"_{name}_1")).alias(name) for name in probabilities])
    return result if keys else result.drop("_all")


def _inside() -> Column:
    """The asked ranks that lie among a digit's values, counted from the first of these."""
    here = F.filter("_asks", lambda a: (a["rank"] >= F.col("_below")) & (a["rank"] < F.col("_below") + F.col("_count")))
    return F.transform(here, lambda a: a.withField("rank", a["rank"] - F.col("_below")))


def _between(low: Column, high: Column) -> Column:
    return F.when(low["v"] == high["v"], low["v"]).otherwise((1 - low["share"]) * low["v"] + low["share"] * high["v"])
