"""Complete-week trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.text import round_to
from tallywright.functions import fixed
from tallywright.operators.trend import (
    change_vs_prior, dense_weekly_share, rolling_mean, trend_slope, weekly_counts, weekly_tag_share,
)


def weekly(jobs: DataFrame) -> DataFrame:
    return weekly_counts(jobs).orderBy("week_start")


def weekly_employers(jobs: DataFrame) -> DataFrame:
    """Postings and distinct employers per complete week."""
    return jobs.where("is_complete_week").groupBy("week_start").agg(
        F.count(F.lit(1)).alias("weekly_jobs"), F.count_distinct("company_key").alias("hiring_companies")
    )


def week_over_week(jobs: DataFrame) -> DataFrame:
    return change_vs_prior(weekly_counts(jobs), "weekly_jobs", "week_start").orderBy("week_start")


def weekly_tag(jobs: DataFrame, bridge: DataFrame) -> DataFrame:
    rows = weekly_tag_share(jobs, bridge)
    return rows.select(
        "week_start", "skill", "skill_jobs", "weekly_jobs", round_to("skill_share_pct", 2).alias("weekly_skill_share_pct")
    ).orderBy("skill", "week_start")


def rolling_tag(jobs: DataFrame, bridge: DataFrame, dense: bool = True, tags=fixed.TRACKED_TAGS) -> DataFrame:
    """Three-row rolling share: over all complete weeks, or only over weeks with a mention."""
    rows = dense_weekly_share(jobs, bridge, tags) if dense else weekly_tag_share(jobs, bridge)
    rolled = rolling_mean(rows, "skill_share_pct", "skill", "week_start", "rolling_3_week_share_pct")
    return rolled.select(
        "week_start", "skill", round_to("skill_share_pct", 2).alias("weekly_skill_share_pct"),
        round_to("rolling_3_week_share_pct", 2).alias("rolling_3_week_share_pct"),
    ).orderBy("skill", "week_start")


def tag_trend(jobs: DataFrame, bridge: DataFrame, tags=fixed.TRACKED_TAGS, digits: int | None = 4) -> DataFrame:
    """Slope and direction per tracked tag over the dense weekly grid."""
    slopes = trend_slope(dense_weekly_share(jobs, bridge, tags), "skill", "skill_share_pct")
    if digits is not None:
        slopes = slopes.withColumns({
            c: round_to(c, digits)
            for c in ("percentage_point_change_per_week", "min_weekly_share_pct", "max_weekly_share_pct")
        })
    return slopes.orderBy(F.desc("percentage_point_change_per_week"), "skill")
