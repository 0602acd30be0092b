"""Sums and means of doubles that do not depend on the order of addition.

Every double is a whole multiple of a power of two. It is cut in limbs of ``LIMB_BITS`` bits on a fixed grid of exponents,
whole numbers that add up like counts: in any order, in partial aggregates, across micro-batches. The limb sums of a group
make up its exact sum, which is rounded once, at the end. No value is rounded before, whatever its size.

NaN makes a sum NaN; infinities of one sign make it that infinity, of both signs NaN; no values make it null.
"""

from __future__ import annotations

import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sum of 2**38 limbs of this size fits a long.
LIMB_BITS = 24
#: Limbs that hold the 53 bits of a double wherever they start, with one to spare for a logarithm that is off by one.
LIMBS = 5
#: Grid numbers that stand for values off the grid.
NOT_A_NUMBER, PLUS_INFINITY, MINUS_INFINITY = 1000, 1001, 1002


def limbs(value: Column) -> Column:
    """The non-zero limbs of a double as an array of (grid, limb): the value is the sum of limb * 2**(24 * grid)."""
    top = F.floor(F.log2(F.abs(value)) / LIMB_BITS).cast("int") + 1
    lowest = top - (LIMBS - 1)
    # In two steps, as the whole factor may leave the range of doubles. Powers of two scale without rounding.
    half = F.pow(F.lit(2.0), lowest.cast("double") * (-LIMB_BITS // 2))
    rest = F.abs(value) * half * half
    sign = F.when(value < 0, -1).otherwise(1)
    found = []
    for i in reversed(range(LIMBS)):
        unit = 2.0 ** (LIMB_BITS * i)
        limb = F.floor(rest / unit)
        found.append(F.struct((lowest + i).alias("grid"), (limb * sign).cast("bigint").alias("limb")))
        rest = rest - limb.cast("double") * unit
    special = (
        F.when(F.isnan(value), NOT_A_NUMBER).when(value == math.inf, PLUS_INFINITY).when(value == -math.inf, MINUS_INFINITY)
    )
    empty = F.array().cast("array<struct<grid: int, limb: bigint>>")
    one = F.array(F.struct(special.cast("int").alias("grid"), F.lit(1).cast("bigint").alias("limb")))
    split = F.filter(F.array(*found), lambda x: x["limb"] != 0)
    return F.when(value.isNull() | (value == 0), empty).when(special.isNotNull(), one).otherwise(split)


def limb_sums(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per group, value column and grid number the sum of limbs and, with grid null, the count of values.

    The rows of two tables of sums add up by ``merge_limbs``; a group has at most some hundred rows.
    """
    column = F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value")) for v in values]))
    long = df.select(*keys, column.alias("_v")).select(*keys, F.col("_v.name").alias("name"), F.col("_v.value").alias("value"))
    count = F.array(F.struct(F.lit(None).cast("int").alias("grid"), F.lit(1).cast("bigint").alias("limb")))
    parts = F.explode(F.concat(count, limbs(F.col("value"))))
    rows = long.filter(F.col("value").isNotNull()).select(*keys, "name", parts.alias("_p"))
    return rows.groupBy(*keys, "name", F.col("_p.grid").alias("grid")).agg(F.sum("_p.limb").alias("limb"))


def merge_limbs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Limb sums of both tables together."""
    both = first.unionByName(second)
    return both.groupBy(*[c for c in both.columns if c != "limb"]).agg(F.sum("limb").alias("limb"))


def rounding():
    """A function from the (grid, limb) pairs of a group to its sum, mean and count; sum and mean are each rounded once.

    All it needs is inside it, so that it travels to the workers whole.
    """
    bits, nan_at, plus_at, minus_at = LIMB_BITS, NOT_A_NUMBER, PLUS_INFINITY, MINUS_INFINITY

    def double(exact: Fraction) -> float:
        try:
            return exact.numerator / exact.denominator
        except OverflowError:
            return math.inf if exact > 0 else -math.inf

    def rounded(parts: list) -> tuple[float | None, float | None, int]:
        count = sum(limb for grid, limb in parts if grid is None)
        grids = {grid: limb for grid, limb in parts if grid is not None and limb}
        if not count:
            return None, None, 0
        plus, minus = plus_at in grids, minus_at in grids
        if nan_at in grids or (plus and minus):
            return math.nan, math.nan, count
        if plus or minus:
            return (math.inf, math.inf, count) if plus else (-math.inf, -math.inf, count)
        total = sum((Fraction(limb) * Fraction(2) ** (bits * grid) for grid, limb in grids.items()), Fraction(0))
        return double(total), double(total / count), count

    return rounded


def _rounded(parts: Column) -> Column:
    rounded = rounding()

    def of_groups(parts: pd.Series) -> pd.DataFrame:
        # A null number comes as None or NaN.
        rows = [rounded([(None if p["grid"] is None or p["grid"] != p["grid"] else int(p["grid"]), int(p["limb"])) for p in group]) for group in parts]
        out = pd.DataFrame(rows, columns=["sum", "mean", "count"]).astype({"sum": "float64", "mean": "float64", "count": "int64"})
        # NaN does not survive the way back by itself: it would come out as null.
        return out.assign(nan=out["sum"].isna() & (out["count"] > 0))

    return F.pandas_udf(of_groups, "sum DOUBLE, mean DOUBLE, count BIGINT, nan BOOLEAN")(parts)


def exact_sums(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and value column (``name``): count, sum and mean, from limb sums; one small row per group comes here."""
    gathered = sums.groupBy(*keys, "name").agg(F.collect_list(F.struct("grid", "limb")).alias("_p"))
    found = gathered.select(*keys, "name", _rounded(F.col("_p")).alias("_r"))
    numbers = [F.when(F.col("_r.nan"), math.nan).otherwise(F.col(f"_r.{c}")).alias(c) for c in ("sum", "mean")]
    return found.select(*keys, "name", F.col("_r.count").alias("count"), *numbers)


def exact_stats(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per group and value column: count, exact sum, exact mean, minimum and maximum."""
    bounds = df.groupBy(*keys).agg(
        *[F.struct(F.min(F.col(v).cast("double")).alias("min"), F.max(F.col(v).cast("double")).alias("max")).alias(v) for v in values]
    )
    long = F.inline(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v)["min"].alias("min"), F.col(v)["max"].alias("max")) for v in values]))
    listed = bounds.select(*keys, long)
    sums = exact_sums(limb_sums(df, keys, values), keys)
    own = sums.select(*[F.col(k).alias(f"_{k}") for k in [*keys, "name"]], "count", "sum", "mean")
    same = [listed[k].eqNullSafe(own[f"_{k}"]) for k in [*keys, "name"]]
    return listed.join(own, same, "left").select(*keys, "name", F.coalesce("count", F.lit(0)).alias("count"), "sum", "mean", "min", "max")
