"""Exact interpolated quantiles that never sort or buffer a whole group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer, which
fails when a group holds billions of rows. Here a mergeable sketch first gives, per group
and probability, values at a geometric grid of distances from it; the narrowest pair that
surely encloses the wanted order statistics bounds a band. Rows outside the bands are only
counted, which happens map-side, and the bands are ranked in two levels: cells of a band
first, then the values of a cell. The answer is exact: the sketch merely decides what need
not be sorted. The grid ends at the smallest and largest value, so one rule serves groups
of any size.

A sketch depends on the order in which its parts are merged, which on a cluster is the order of
arrival, so a bound that is computed twice may differ. The bounds of the groups, one row each, are
therefore written once, and whatever counts and ranks by them reads these.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.session import materialize

#: The sketch is off by 1 / ACCURACY of the rows at most; bands allow for four times that.
ACCURACY = 10_000
#: Cells of a band, of equal width in value.
CELLS = 64


def ranked_bands(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], spread: float = 0.0, min_n: int = 1,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Distinct values near the quantiles of each group, with their ranks.

    ``[_start, _stop)`` are the 0-based ranks a value takes in the sorted group, ``_n`` is the
    group's row count and ``_x_...`` its ``extra`` aggregates. A row with a null value
    stands for the rows of a gap between bands. ``probs`` must ascend. A band holds the ranks
    within ``spread`` * sqrt(n) of its quantile, besides what the sketch's error and rounding
    need; a rank outside fails the query.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    steps = int(math.log2(ACCURACY / 4))
    ends = [min(1.0, max(0.0, p + side * 2.0**-j)) for p in probs for j in range(steps + 1) for side in (-1, 1)]
    limits = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, ACCURACY).alias("_grid"), *extra)
    more = [F.col(c).alias(f"_x_{c}") for c in limits.columns[len(keys) + 2 :]]
    limits = limits.where(F.col("_n") >= min_n)
    need = F.lit(4.0 / ACCURACY) + F.lit(2.0) / F.col("_n") + F.lit(spread) / F.sqrt("_n")
    step = F.least(F.lit(steps), F.greatest(F.lit(0), F.floor(-F.log2(need)))).cast("int")
    pick = lambda i, side: F.get("_grid", 2 * (i * (steps + 1) + step) + side)
    bands = [F.array(*[pick(i, side) for i in range(len(probs))]).alias(name) for side, name in ((0, "_low"), (1, "_high"))]
    limits = materialize(limits.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n", *more, *bands), name="limits")
    extras = [c for c in limits.columns if c.startswith("_x_")]

    def limited(df: DataFrame, names: Sequence[str]) -> DataFrame:
        if keys:
            side = limits.select(*[f"_k_{k}" for k in keys], *names)
            return df.join(side, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]).drop(*[f"_k_{k}" for k in keys])
        return df.withColumn("_p", limits.select(F.struct(*names)).scalar()).select("*", "_p.*").drop("_p")

    joined = limited(rows.select(*keys, "_v"), ["_low", "_high"])
    v = F.col("_v")
    lows, highs = ([F.get(name, F.lit(i)) for i in range(len(probs))] for name in ("_low", "_high"))
    passed = functools.reduce(operator.add, [(v > hi).cast("int") for hi in highs])
    inside = functools.reduce(operator.or_, [v.between(lo, hi) for lo, hi in zip(lows, highs)])
    low, high = F.get("_low", F.col("_gap")), F.get("_high", F.col("_gap"))
    cell = F.when(high > low, F.floor((F.col("_v") - low) / (high - low) * CELLS)).otherwise(F.lit(0)).cast("int")
    counted = (
        joined.where(v <= highs[-1]).withColumn("_gap", passed)
        .select(*keys, "_gap", F.when(inside, cell).otherwise(F.lit(-1)).alias("_cell"), F.when(inside, v).alias("_v"))
        .groupBy(*keys, "_gap", "_cell", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    # first level: at most (CELLS + 2) rows for each probability of a group
    cells = counted.groupBy(*keys, "_gap", "_cell").agg(F.sum("_c").alias("_in_cell"))
    before = Window.partitionBy(*keys).orderBy("_gap", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_gap").alias("_k__gap"), F.col("_cell").alias("_k__cell"), F.coalesce(F.sum("_in_cell").over(before), F.lit(0)).alias("_before"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in (*keys, "_gap", "_cell")]
    run = Window.partitionBy(*keys, "_gap", "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_stop", F.sum("_c").over(run)).join(cells, same).withColumn("_stop", F.col("_stop") + F.col("_before"))
    ranked = ranked.select(*keys, "_v", (F.col("_stop") - F.col("_c")).alias("_start"), "_stop")
    return limited(ranked, ["_n", *extras]).select(*keys, "_n", *extras, "_v", "_start", "_stop")


def at_rank(rank: Column) -> Column:
    inside = F.col("_v").isNotNull() & (F.col("_start") <= rank) & (rank < F.col("_stop"))
    return F.max(F.when(inside, F.col("_v")))


def read_quantiles(
    bands: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str], n: str = "n"
) -> DataFrame:
    """Interpolated quantiles (inclusive definition) and the row count, read off the bands."""
    extras = [c for c in bands.columns if c.startswith("_x_")]
    aggs = [F.max("_n").alias("_n"), *[F.first(c).alias(c) for c in extras]]
    for p, name in zip(probs, names):
        spot = F.lit(p) * (F.col("_n") - 1)
        aggs += [at_rank(F.floor(spot)).alias(f"{name}_lo"), at_rank(F.ceil(spot)).alias(f"{name}_hi")]
    outside = F.raise_error("quantile rank outside its sketch band").cast("double")
    out = []
    for p, name in zip(probs, names):
        lo, hi, spot = F.col(f"{name}_lo"), F.col(f"{name}_hi"), F.lit(p) * (F.col("_n") - 1)
        exact = lo + (hi - lo) * (spot - F.floor(spot))
        found = F.when(lo.isNull() | hi.isNull(), outside).otherwise(exact)
        out.append(F.when(F.col("_n").isNotNull(), found).alias(name))
    return bands.groupBy(*keys).agg(*aggs).select(*keys, F.coalesce("_n", F.lit(0)).alias(n), *out, *[F.col(c).alias(c[3:]) for c in extras])


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float] = (0.5,),
    names: Sequence[str] = ("median",),
    n: str = "n",
    min_n: int = 1,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per group: non-null count ``n``, exact quantiles and ``extra`` aggregates, for n >= ``min_n``.

    Without keys the result is one row; over no rows it is n = 0 with null statistics.
    """
    keys, extra = list(keys), list(extra)
    stats = read_quantiles(ranked_bands(df, keys, value, probs, min_n=min_n, extra=extra if keys else ()), keys, probs, names, n)
    if not keys and extra:  # a single row, which stays where there are no values
        return stats.withColumn("_x", df.where(F.col(value).isNotNull()).agg(F.struct(*extra)).scalar()).select("*", "_x.*").drop("_x")
    return stats
