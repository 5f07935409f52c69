"""Metric lists, the quality report and the set of result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.calendar import recent_flag, with_complete_week
from tallywright.functions.text import lakh_text, round_to, safe_pct
from tallywright.operators.bootstrap import bootstrap_diff
from tallywright.operators.names import ascii_key
from tallywright.operators.quality import (
    expect, expect_count, expect_foreign_key, expect_recomputed, expect_sum, expect_unique, union_reports,
)
from tallywright.operators.shares import count_by, row_total
from tallywright.plans import demand, pay, trends
from tallywright.plans.clean import clean_rules


def _metrics(one_row: DataFrame) -> DataFrame:
    """One row of numbers to (metric, value) rows."""
    numbers = one_row.select(*[F.col(c).cast("double").alias(c) for c in one_row.columns])
    return numbers.unpivot([], [F.col(c) for c in numbers.columns], "metric", "value")


def overview_metrics(jobs: DataFrame, bridge: DataFrame) -> DataFrame:
    """Counts and coverages as (metric, value)."""
    n = F.count(F.lit(1))
    flags = ["has_extracted_skill", "has_salary_source", "salary_analysis_eligible"]
    return _metrics(jobs.agg(
        n.alias("analytical_vacancies"),
        *[F.count_if(f).alias(f"{f}_jobs") for f in flags],
        *[round_to(safe_pct(F.count_if(f), n), 2).alias(f"{f}_pct") for f in flags],
        F.count("experience_min_years").alias("experience_labeled_jobs"),
        round_to(safe_pct(F.count("experience_min_years"), n), 2).alias("experience_labeled_pct"),
        F.count_if("is_recent_90d").alias("recent_90d_jobs"),
        F.count_if("is_complete_week").alias("complete_week_jobs"),
    ).select(
        "*", row_total(bridge).alias("job_skill_rows"), row_total(bridge.select("skill").distinct()).alias("unique_skills")
    ))


def run_metrics(jobs: DataFrame, bridge: DataFrame) -> DataFrame:
    """Build metrics of a clean table as (metric, value)."""
    n = F.count(F.lit(1))
    status = F.col("salary_normalization_status")

    def coverage(flag: Column) -> Column:
        return round_to(safe_pct(F.count_if(flag), n), 2)

    return _metrics(jobs.agg(
        n.alias("processed_job_rows"),
        coverage(F.col("role_family") == fixed.OTHER_ROLE).alias("role_other_share_pct"),
        coverage(F.col("has_extracted_skill")).alias("skill_job_coverage_pct"),
        coverage(F.col("experience_min_years").isNotNull()).alias("experience_extraction_coverage_pct"),
        F.count_if(F.col("experience_band") == fixed.NOT_SPECIFIED).alias("experience_not_specified_rows"),
        F.count_if(F.col("city") == fixed.CITY_NOT_SPECIFIED).alias("city_not_specified_rows"),
        F.count_if(F.col("company_name") != fixed.UNKNOWN_COMPANY).alias("known_company_rows"),
        coverage(F.col("has_salary_source")).alias("salary_source_coverage_pct"),
        coverage(F.col("salary_analysis_eligible")).alias("salary_analysis_eligible_coverage_pct"),
        F.count_if(status == fixed.STATUS_AMBIGUOUS).alias("salary_ambiguous_period_rows"),
        F.count_if(status.isin(fixed.STATUS_MONTHLY_SCALED, fixed.STATUS_ANNUAL_SCALED)).alias("salary_annualized_rows"),
        F.count_if("is_recent_90d").alias("recent_90d_rows"),
        F.count_if("is_complete_week").alias("complete_week_rows"),
    ).select(
        "*", row_total(bridge).alias("skill_bridge_rows"), row_total(bridge.select("skill").distinct()).alias("unique_skills")
    ))


def quality_report(
    jobs: DataFrame, bridge: DataFrame, end: str = fixed.WINDOW_END, expected_rows: int | None = None
) -> DataFrame:
    """The data-quality contract of clean tables as (rule, failed_rows, passed)."""
    names = jobs.where(F.col("company_name") != fixed.UNKNOWN_COMPANY).select("company_name").distinct()
    reports = [
        expect(jobs, clean_rules()),
        expect_unique(jobs, ["job_id"], "repeated_job_ids"),
        expect_unique(bridge, ["job_id", "skill"], "repeated_job_skill_pairs"),
        expect_foreign_key(bridge, jobs, "job_id", "bridge_without_job"),
        expect_unique(ascii_key(names, "company_name"), ["name_key"], "employer_spellings"),
        expect_recomputed(jobs, "is_recent_90d", recent_flag(F.col("posted_date"), end), "recent_flag"),
        expect_recomputed(with_complete_week(jobs, "posted_date", flag="_again"), "is_complete_week", F.col("_again"), "complete_week_flag"),
        expect_sum(count_by(jobs.where("role_family IS NOT NULL"), ["role_family"]), "job_count", jobs, "role_totals_difference"),
    ]
    if expected_rows is not None:
        reports.append(expect_count(jobs, expected_rows, "row_count_difference"))
    return union_reports(*reports)


def findings(jobs: DataFrame, bridge: DataFrame, tag: str = fixed.COMPARED_TAG) -> DataFrame:
    """Headline values as text: top role, tag and city, pay in lakh and the bootstrap interval."""
    top_role = demand.role_demand(jobs).limit(1).select("role_family", "job_count")
    top_tag = demand.tag_counts(bridge).orderBy(F.desc("job_count"), "skill").limit(1)
    top_city = demand.city_demand(jobs).limit(1)
    dist = pay.value_distribution(jobs)
    boot = bootstrap_diff(pay.tag_flagged(jobs, bridge, tag), "has_tag", pay.VALUE)

    def lines(df: DataFrame, values: dict[str, Column]) -> DataFrame:
        """All lines of a one-row frame at once, so that the frame is computed once."""
        pairs = [F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value")) for m, v in values.items()]
        return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")

    def headline(df: DataFrame, metric: str, label: str) -> DataFrame:
        return lines(df, {metric: F.format_string("%s (%d postings)", F.col(label), F.col("job_count"))})

    includes = F.when(F.col("includes_zero"), "Inconclusive because the interval includes zero").otherwise(
        "Interval excludes zero; descriptive association only"
    )
    pays = ["median_salary", "mean_salary", "minimum_salary", "maximum_salary"]
    ends = ["observed_difference", "ci_low", "ci_high"]
    parts = [
        headline(top_role, "top_role_family", "role_family"),
        headline(top_tag, "top_skill", "skill"),
        headline(top_city, "top_specific_city", "city"),
        lines(dist, {"salary_observations": F.col("salary_n"), **{m: lakh_text(F.col(f"{m}_inr")) for m in pays}}),
        lines(boot, {**{m: lakh_text(F.col(m)) for m in ends}, "bootstrap_conclusion": includes}),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def result_tables(jobs: DataFrame, bridge: DataFrame) -> dict[str, DataFrame]:
    """The summary tables an analysis run exports, unrounded where the originals are."""
    return {
        "role_demand_summary": demand.role_demand(jobs, digits=None),
        "city_demand_summary": demand.city_demand(jobs, digits=None).select("city", "state", "job_count"),
        "company_demand_summary": demand.employer_demand(jobs),
        "skill_demand_summary": demand.tag_demand(jobs, bridge),
        "skill_pair_summary": demand.tag_pairs(bridge, k=None),
        "skill_salary_summary": pay.value_by_tag(jobs, bridge),
        "skill_trend_summary": trends.tag_trend(jobs, bridge, digits=None),
        "recent_role_shift_summary": demand.role_shift(jobs),
        "role_scope_audit": demand.role_audit(jobs),
        "skill_coverage_report": demand.tag_coverage(jobs, bridge),
    }
