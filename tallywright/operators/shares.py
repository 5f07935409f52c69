"""Counting, shares, ranks, top-k and fixed label lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.patterns import array_sql
from tallywright.functions.text import round_to, safe_pct


def count_by(df: DataFrame, keys: Sequence[str], n: str = "job_count", weight: str | None = None) -> DataFrame:
    """Rows per key. ``weight`` names a count column of an input that is already pre-aggregated."""
    counted = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*keys).agg(counted.cast("bigint").alias(n))


def total_of(df: DataFrame, n: str) -> Column:
    """The grand total of ``n`` as a scalar subquery: no window over all rows, no cross join."""
    return df.agg(F.sum(n)).scalar()


def row_total(df: DataFrame, condition: Column | None = None) -> Column:
    """Number of rows, or of rows that meet ``condition``, as a scalar subquery."""
    return df.agg(F.count(F.lit(1)) if condition is None else F.count_if(condition)).scalar()


def share(
    df: DataFrame, n: str, name: str = "share_pct", by: Sequence[str] = (), total: Column | None = None,
    digits: int | None = 2,
) -> DataFrame:
    """Percentage of ``n`` in a total: the given one, the one of the group, or the grand one.

    ``df`` is one row per label, so a partition of the ``by`` window holds labels, not rows.
    """
    if total is None:
        total = F.sum(n).over(Window.partitionBy(*by)) if by else total_of(df, n)
    pct = safe_pct(F.col(n), total)
    return df.withColumn(name, pct if digits is None else round_to(pct, digits))


def cumulative(df: DataFrame, x: str, order: Sequence[Column], name: str) -> DataFrame:
    """Running sum over a fixed label list (one row per label)."""
    frame = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(x).over(frame))


def demand_rank(df: DataFrame, n: str, name: str = "demand_rank", bounded: bool = False) -> DataFrame:
    """Dense rank by ``n`` descending over the whole frame.

    The rank of a row depends only on the distinct values of ``n``. Those are few even for
    very many labels (the counts of N rows take at most about sqrt(2N) values), so only they
    are ranked in one place and the rank is joined back. ``bounded`` skips the join for a
    fixed label list.
    """
    if bounded:
        return df.withColumn(name, F.dense_rank().over(Window.orderBy(F.desc(n))))
    ranks = df.select(F.col(n).alias("_n")).distinct().withColumn(
        name, F.row_number().over(Window.orderBy(F.desc("_n")))
    )
    return df.join(ranks, df[n] == ranks["_n"]).drop("_n")


def top_k(
    df: DataFrame, n: str, k: int, ties: bool = True, tie_break: Sequence[str] = (), rank: str | None = None
) -> DataFrame:
    """Top ``k`` by ``n``: with ties, all rows of the k largest values; else exactly k rows.

    Without ties the order must be total, so ``tie_break`` names the columns that settle it.
    Both forms run as distributed top-k selections.
    """
    if ties:
        best = df.select(F.col(n).alias("_n")).where(F.col("_n").isNotNull()).distinct().orderBy(F.desc("_n")).limit(k)
        best = best.withColumn(rank or "_rank", F.row_number().over(Window.orderBy(F.desc("_n"))))
        out = df.join(best, df[n] == best["_n"]).drop("_n")
        return out if rank else out.drop("_rank")
    order = [F.desc(n), *[F.asc(c) for c in tie_break]]
    out = df.orderBy(*order).limit(k)
    if rank:
        out = out.withColumn(rank, F.row_number().over(Window.orderBy(*order)))
    return out


def reindex(df: DataFrame, col: str, labels: Sequence[str], fill: Sequence[str], order: str = "label_order") -> DataFrame:
    """Exactly the labels of a fixed list, in its order, with 0 where ``df`` has no row."""
    # The list is part of the plan: one literal array laid out with its positions.
    listed = df.sparkSession.range(1).selectExpr(f"posexplode({array_sql(labels)}) AS (_i, {col})")
    fixed = listed.select(col, (F.col("_i") + 1).alias(order))
    out = fixed.join(df, col, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in fill})


def histogram(df: DataFrame, col: str, bins: int, n: str = "row_count") -> DataFrame:
    """Equal-width bins over min..max, all bins kept, top edge inclusive."""
    values = df.select(F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    ends = values.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    spread = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    span = ends.select(F.struct((F.col("lo") - spread).alias("lo"), (F.col("hi") + spread).alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    place = F.floor((F.col("_v") - lo) / (hi - lo) * bins)
    counts = values.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias(n))
    slots = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    width = (hi - lo) / bins
    return slots.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_low"),
        (lo + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n),
    )
