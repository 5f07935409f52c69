"""Weekly series, rolling means, change and slope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.text import round_to, safe_pct


def weekly_counts(jobs: DataFrame, week: str = "week_start", n: str = "weekly_jobs") -> DataFrame:
    return jobs.where("is_complete_week").groupBy(week).agg(F.count(F.lit(1)).alias(n))


def change_vs_prior(df: DataFrame, n: str, order: str) -> DataFrame:
    """Prior value, absolute and percent change along one calendar series (one row per week)."""
    prior = F.lag(n).over(Window.orderBy(order))
    out = df.withColumn("prior_week_jobs", prior)
    step = F.col(n) - F.col("prior_week_jobs")
    return out.withColumns({
        "absolute_change": step,
        "week_over_week_pct": round_to(safe_pct(step, F.col("prior_week_jobs")), 2),
    })


def weekly_tag_share(
    jobs: DataFrame, bridge: DataFrame, entity: str = "job_id", tag: str = "skill", week: str = "week_start"
) -> DataFrame:
    """Sparse series: weeks with at least one entity carrying the tag, share unrounded.

    The bridge holds distinct links, so rows per (week, tag) count entities. They are
    aggregated before the weekly totals are joined.
    """
    complete = jobs.where("is_complete_week").select(entity, week)
    tagged = bridge.join(complete, entity).groupBy(week, tag).agg(F.count(F.lit(1)).alias("skill_jobs"))
    return tagged.join(weekly_counts(jobs, week), week).withColumn(
        "skill_share_pct", safe_pct(F.col("skill_jobs"), F.col("weekly_jobs"))
    )


def dense_grid(weeks: DataFrame, bridge: DataFrame, tags: Sequence[str] | None = None, tag: str = "skill", week: str = "week_start") -> DataFrame:
    """Every week with every tag that occurs, or with those of a list that do.

    The weeks are a bounded calendar: they go to the tags as one array, so tags of any number
    stay distributed. The list is applied before tags are collected.
    """
    found = (bridge if tags is None else bridge.where(F.col(tag).isin(list(tags)))).select(tag).distinct()
    calendar = weeks.agg(F.collect_list(F.struct(*weeks.columns))).scalar()
    return found.withColumn("_week", F.explode(calendar)).select("_week.*", tag)


def dense_weekly_share(
    jobs: DataFrame, bridge: DataFrame, tags: Sequence[str] | None = fixed.TRACKED_TAGS, entity: str = "job_id",
    tag: str = "skill", week: str = "week_start",
) -> DataFrame:
    """Every complete week with every tag, 0 where no entity carries it, and the week's index.

    The index is the position of the week among complete weeks, taken from the one-row-per-week
    totals before the grid is laid out.
    """
    weeks = weekly_counts(jobs, week).withColumn("week_index", F.row_number().over(Window.orderBy(week)) - 1)
    grid = dense_grid(weeks, bridge, tags, tag, week)
    links = bridge if tags is None else bridge.where(F.col(tag).isin(list(tags)))
    complete = jobs.where("is_complete_week").select(entity, week)
    counts = links.join(complete, entity).groupBy(week, tag).agg(F.count(F.lit(1)).alias("skill_jobs"))
    return (
        grid.join(counts, [week, tag], "left")
        .withColumn("skill_jobs", F.coalesce("skill_jobs", F.lit(0)).cast("bigint"))
        .withColumn("skill_share_pct", safe_pct(F.col("skill_jobs"), F.col("weekly_jobs")))
    )


def rolling_mean(df: DataFrame, x: str, by: str, order: str, name: str, size: int = 3) -> DataFrame:
    """Mean of the current and the ``size - 1`` rows before it, per series."""
    frame = Window.partitionBy(by).orderBy(order).rowsBetween(1 - size, Window.currentRow)
    return df.withColumn(name, F.avg(x).over(frame))


def trend_slope(weekly: DataFrame, by: str, y: str, x: str = "week_index", flat: float = fixed.FLAT_SLOPE) -> DataFrame:
    """Least-squares slope per series and its direction; under two points there is none."""
    slope = F.col("percentage_point_change_per_week")
    direction = (
        F.when(slope.isNull(), "Not Available")
        .when(slope > flat, "Upward")
        .when(slope < -flat, "Downward")
        .otherwise("Approximately Flat")
    )
    return weekly.groupBy(by).agg(
        F.count(F.lit(1)).alias("complete_weeks"),
        F.regr_slope(y, x).alias("percentage_point_change_per_week"),
        F.min(y).alias("min_weekly_share_pct"),
        F.max(y).alias("max_weekly_share_pct"),
    ).withColumn("trend_direction", direction)
