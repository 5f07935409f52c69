"""Pay statistics of the eligible rows, with minimum-sample rules and sample audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.text import round_money, round_to, safe_pct
from tallywright.operators.quantiles import group_stats
from tallywright.operators.sets import has_tag
from tallywright.plans.demand import specific_city

VALUE = "salary_midpoint"


def eligible(jobs: DataFrame) -> DataFrame:
    return jobs.where("salary_analysis_eligible")


def _rounded(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({c: round_money(c) for c in names})


def value_distribution(jobs: DataFrame) -> DataFrame:
    """n, quartiles, mean, extremes and the number of high values, in one row."""
    stats = group_stats(
        eligible(jobs), [], VALUE, (0.25, 0.5, 0.75), ("salary_p25_inr", "median_salary_inr", "salary_p75_inr"),
        n="salary_n",
        extra=[
            F.avg(VALUE).alias("mean_salary_inr"), F.min(VALUE).alias("minimum_salary_inr"),
            F.max(VALUE).alias("maximum_salary_inr"), F.count_if(F.col(VALUE) >= fixed.HIGH_PAY).alias("jobs_at_or_above_30_lakh"),
        ],
    )
    money = [c for c in stats.columns if c.endswith("_inr")]
    return _rounded(stats, money)


def value_by(
    jobs: DataFrame, keys: Sequence[str], min_n: int, condition: Column | None = None, rounded: bool = True
) -> DataFrame:
    """n, median and mean per label for labels with at least ``min_n`` values."""
    rows = eligible(jobs) if condition is None else eligible(jobs).where(condition)
    stats = group_stats(rows, keys, VALUE, (0.5,), ("median_salary_inr",), n="salary_n", min_n=min_n,
                        extra=[F.avg(VALUE).alias("mean_salary_inr")])
    out = _rounded(stats, ["median_salary_inr", "mean_salary_inr"]) if rounded else stats
    return out.orderBy(F.desc("median_salary_inr"), F.desc("salary_n"), *keys)


def value_by_role(jobs: DataFrame, min_n: int = fixed.MIN_N_ROLE_CITY) -> DataFrame:
    return value_by(jobs, ["role_family"], min_n)


def value_by_city(jobs: DataFrame, min_n: int = fixed.MIN_N_ROLE_CITY) -> DataFrame:
    return value_by(jobs, ["city", "state"], min_n, specific_city())


def value_by_band(jobs: DataFrame, min_n: int = fixed.MIN_N_BAND) -> DataFrame:
    return value_by(jobs, ["experience_band"], min_n, F.col("experience_band") != fixed.NOT_SPECIFIED)


def quartiles_by(jobs: DataFrame, keys: Sequence[str], min_n: int = 1, condition: Column | None = None) -> DataFrame:
    """n and the three quartiles per label."""
    rows = eligible(jobs) if condition is None else eligible(jobs).where(condition)
    stats = group_stats(rows, keys, VALUE, (0.25, 0.5, 0.75), ("p25", "median", "p75"), n="salary_n", min_n=min_n)
    return _rounded(stats, ["p25", "median", "p75"])


def sample_by(jobs: DataFrame, keys: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Eligible rows per label; labels without any are kept at 0."""
    rows = jobs if condition is None else jobs.where(condition)
    counts = rows.groupBy(*keys).agg(F.count_if("salary_analysis_eligible").alias("salary_n"))
    return counts.orderBy(F.desc("salary_n"), *keys)


def tagged_values(jobs: DataFrame, bridge: DataFrame) -> DataFrame:
    return bridge.join(eligible(jobs).select("job_id", VALUE), "job_id")


def value_by_tag(jobs: DataFrame, bridge: DataFrame, min_n: int = fixed.MIN_N_TAG) -> DataFrame:
    """Median and mean per tag and the difference of the median from the overall one, in percent."""
    overall = group_stats(eligible(jobs), [], VALUE).select("median").scalar()
    stats = group_stats(tagged_values(jobs, bridge), ["skill"], VALUE, (0.5,), ("median_salary_inr",),
                        n="salary_n", min_n=min_n, extra=[F.avg(VALUE).alias("mean_salary_inr")])
    gap = safe_pct(F.col("median_salary_inr") - overall, overall)
    out = stats.withColumn("median_difference_vs_overall_pct", round_to(gap))
    return _rounded(out, ["median_salary_inr", "mean_salary_inr"]).orderBy(F.desc("median_salary_inr"), F.desc("salary_n"), "skill")


def sample_by_tag(jobs: DataFrame, bridge: DataFrame) -> DataFrame:
    """Eligible entities per tag; tags without any are kept at 0."""
    flags = jobs.select("job_id", "salary_analysis_eligible")
    return sample_by(bridge.join(flags, "job_id"), ["skill"])


def tag_flagged(jobs: DataFrame, bridge: DataFrame, tag: str = fixed.COMPARED_TAG) -> DataFrame:
    return has_tag(eligible(jobs).select("job_id", VALUE), bridge, tag)


def tag_vs_rest(jobs: DataFrame, bridge: DataFrame, tag: str = fixed.COMPARED_TAG) -> DataFrame:
    """n, median and mean of the eligible rows with and without a tag."""
    named = tag_flagged(jobs, bridge, tag).withColumn(
        "skill_group", F.when(F.col("has_tag"), tag).otherwise(f"Non-{tag}")
    )
    stats = group_stats(named, ["skill_group"], VALUE, (0.5,), ("median_salary_inr",), n="salary_n",
                        extra=[F.avg(VALUE).alias("mean_salary_inr")])
    return _rounded(stats, ["median_salary_inr", "mean_salary_inr"])


def tag_vs_rest_diff(jobs: DataFrame, bridge: DataFrame, tag: str = fixed.COMPARED_TAG) -> DataFrame:
    """Observed medians with and without a tag and their difference, in one row."""
    medians = group_stats(tag_flagged(jobs, bridge, tag), ["has_tag"], VALUE)
    wide = medians.agg(
        F.max(F.when(F.col("has_tag"), F.col("median"))).alias("tag_median_inr"),
        F.max(F.when(~F.col("has_tag"), F.col("median"))).alias("rest_median_inr"),
    )
    gap = F.col("tag_median_inr") - F.col("rest_median_inr")
    return _rounded(wide.withColumn("observed_median_difference_inr", gap), [
        "tag_median_inr", "rest_median_inr", "observed_median_difference_inr",
    ])
