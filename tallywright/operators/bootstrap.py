"""Bootstrap interval of a difference of medians, at any sample size.

A resample of n draws with replacement is a draw of n ranks, and its median needs only
the middle one or two of them. The k-th smallest of n uniform draws follows
Beta(k, n - k + 1), and given it the next one is the minimum of the n - k remaining draws,
so each resample costs two random numbers per group instead of n: the result has exactly
the distribution of the resample that draws every row. The ranks lie within a few sqrt(n)
of the middle, so only that band of the data is ordered. It is written once, some sqrt(n) rows: medians, sizes and
draws are read off it, and the data are read twice in all, for the sketch and for the band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.operators.quantiles import at_rank, ranked_bands, read_quantiles
from tallywright.session import materialize

_BLOCK = 1_000


def _draw(seed: int, block_size: int):
    """Task function; self-contained, so executors need no copy of this package."""

    def middle_ranks(rng: np.random.Generator, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """0-based ranks of the two middle draws (equal for odd n) of ``size`` resamples."""
        k = (n + 1) // 2
        u = rng.beta(k, n - k + 1, size)
        low = np.minimum((u * n).astype("int64"), n - 1)
        if n % 2:
            return low, low
        # The next draw is the smallest of the n - k draws above u.
        gap = -np.expm1(np.log1p(-rng.random(size)) / (n - k))
        return low, np.minimum(((u + (1.0 - u) * gap) * n).astype("int64"), n - 1)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                rng = np.random.default_rng([seed, int(row.block), int(row.side)])
                low, high = middle_ranks(rng, int(row.n), int(row.draws))
                first = int(row.block) * block_size
                ids = np.arange(first, first + int(row.draws))
                yield pd.DataFrame({
                    "side": int(row.side),
                    "iteration": np.concatenate([ids, ids]),
                    "rank": np.concatenate([low, high]),
                })

    return blocks


def bootstrap_differences(
    df: DataFrame, flag: str, value: str, iterations: int = fixed.BOOTSTRAP_ITERATIONS, seed: int = fixed.BOOTSTRAP_SEED
) -> tuple[DataFrame, DataFrame]:
    """(differences, medians): one difference per iteration, flagged minus unflagged median."""
    sides = df.select(F.col(flag).cast("int").alias("side"), F.col(value).cast("double").alias("v"))
    sides = sides.where(F.col("side").isNotNull() & F.col("v").isNotNull())
    # six square roots of n: twelve standard deviations of the median's rank
    bands = materialize(ranked_bands(sides, ["side"], "v", [0.5], spread=6.0), name="bands")
    medians = read_quantiles(bands, ["side"], [0.5], ["median"])
    sizes = medians.select("side", "n")

    spark = df.sparkSession
    starts = spark.range(0, -(-iterations // _BLOCK)).select(
        F.col("id").alias("block"),
        F.least(F.lit(_BLOCK), F.lit(iterations) - F.col("id") * _BLOCK).alias("draws"),
    )
    # Two sides, so two rows per block.
    plan = starts.withColumn("g", F.explode(sizes.agg(F.array_sort(F.collect_list(F.struct("side", "n")))).scalar()))
    plan = plan.select("block", "draws", "g.side", "g.n")
    draws = plan.mapInPandas(_draw(seed, _BLOCK), "side int, iteration long, rank long")

    # As-of lookup: ranks repeat across iterations, so distinct ranks are looked up once.
    wanted = draws.select("side", "rank").distinct().select(
        "side", F.col("rank").alias("at"), F.lit(1).alias("is_draw"), F.lit(None).cast("double").alias("v"),
        F.lit(None).cast("bigint").alias("stop"),
    )
    steps = bands.select(
        "side", F.col("_start").alias("at"), F.lit(0).alias("is_draw"), F.col("_v").alias("v"),
        F.when(F.col("_v").isNotNull(), F.col("_stop")).otherwise(0).alias("stop"),
    )
    order = Window.partitionBy("side").orderBy("at", "is_draw")
    looked = (
        steps.unionByName(wanted)
        .withColumn("value", F.last("v", ignorenulls=True).over(order))
        .withColumn("stop", F.last("stop", ignorenulls=True).over(order))
        .where("is_draw = 1")
    )
    outside = F.raise_error("resampled rank outside the ordered band").cast("double")
    looked = looked.select("side", F.col("at").alias("rank"), F.when(F.col("at") < F.col("stop"), F.col("value")).otherwise(outside).alias("value"))
    per_side = draws.join(looked, ["side", "rank"]).groupBy("iteration", "side").agg(F.avg("value").alias("m"))
    differences = per_side.groupBy("iteration").agg(
        (F.max(F.when(F.col("side") == 1, F.col("m"))) - F.max(F.when(F.col("side") == 0, F.col("m")))).alias("difference")
    )
    return differences, medians


def rank_bounds(df: DataFrame, flag: str, value: str, deviations: float = 6.0) -> DataFrame:
    """(low, high): the differences of the values so many standard deviations of a resampled median's rank around the
    middle of each side, between which the ends of any interval lie."""
    sides = df.select(F.col(flag).cast("int").alias("side"), F.col(value).cast("double").alias("v"))
    bands = materialize(ranked_bands(sides.where(F.col("side").isNotNull()), ["side"], "v", [0.5], spread=deviations), name="bands")
    middle, reach = (F.col("_n") - 1) / 2, deviations * F.sqrt("_n") / 2
    ends = bands.groupBy("side").agg(
        at_rank(F.greatest(F.lit(0), F.floor(middle - reach))).alias("a"), at_rank(F.least(F.col("_n") - 1, F.ceil(middle + reach))).alias("b"),
    )
    of = lambda side, end: F.max(F.when(F.col("side") == side, F.col(end)))
    return ends.agg((of(1, "a") - of(0, "b")).alias("low"), (of(1, "b") - of(0, "a")).alias("high"))


def bootstrap_diff(
    df: DataFrame, flag: str, value: str, iterations: int = fixed.BOOTSTRAP_ITERATIONS,
    seed: int = fixed.BOOTSTRAP_SEED, level: float = 0.95,
) -> DataFrame:
    """(iterations, observed_difference, ci_low, ci_high, includes_zero).

    The two percentiles are over ``iterations`` numbers, a fixed size whatever the data.
    """
    differences, medians = bootstrap_differences(df, flag, value, iterations, seed)
    tail = (1.0 - level) / 2.0
    observed = medians.agg(
        F.max(F.when(F.col("side") == 1, F.col("median"))) - F.max(F.when(F.col("side") == 0, F.col("median")))
    ).scalar()
    ends = differences.agg(
        F.count(F.lit(1)).alias("iterations"),
        F.percentile("difference", F.lit(tail)).alias("ci_low"),
        F.percentile("difference", F.lit(1.0 - tail)).alias("ci_high"),
    )
    return ends.select(
        "iterations", observed.alias("observed_difference"), "ci_low", "ci_high",
        ((F.col("ci_low") <= 0) & (F.col("ci_high") >= 0)).alias("includes_zero"),
    )
