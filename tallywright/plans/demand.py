"""Counts, shares and ranks of roles, places, employers, modes, bands and tags.

``jobs`` has one row per entity, ``bridge`` one row per distinct (entity, tag). Functions
that take ``weight`` also accept an input that is already counted, so that a large fact can
be aggregated on its key before a dimension is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.calendar import period_label
from tallywright.functions.labels import label_order
from tallywright.functions.text import round_to, safe_pct, source_family, source_provider
from tallywright.operators.pairs import pair_counts
from tallywright.operators.sets import filtered_tags
from tallywright.operators.shares import (
    count_by, cumulative, demand_rank, reindex, row_total, share, top_k, total_of,
)


def known_employer(company: str = "company_name") -> Column:
    return F.coalesce(F.col(company), F.lit(fixed.UNKNOWN_COMPANY)) != fixed.UNKNOWN_COMPANY


def specific_city(scope: str = "location_scope") -> Column:
    return F.col(scope) == fixed.SCOPE_CITY


# --- overview ------------------------------------------------------------------

def overview(jobs: DataFrame) -> DataFrame:
    """One row of counts and coverages; distinct companies include the unknown label.

    Rows are counted by company, place and role first, so the distinct counts go over those
    groups and no row is copied for them.
    """
    flags = {
        "skill_tagged_jobs": F.col("has_extracted_skill"), "experience_labeled_jobs": F.col("experience_min_years").isNotNull(),
        "salary_source_jobs": F.col("has_salary_source"), "salary_analysis_jobs": F.col("salary_analysis_eligible"),
        "recent_90d_jobs": F.col("is_recent_90d"), "complete_week_jobs": F.col("is_complete_week"),
    }
    groups = jobs.groupBy("company_key", "location_key", "role_family").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(flag).alias(name) for name, flag in flags.items()]
    )
    n = F.sum("n")

    def coverage(name: str) -> Column:
        return round_to(safe_pct(F.sum(name), n), 2)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return groups.agg(
        F.coalesce(n, F.lit(0)).alias("unique_vacancies"),
        F.count_distinct("company_key").alias("unique_companies"),
        F.count_distinct("location_key").alias("unique_locations"),
        F.count_distinct("role_family").alias("role_families"),
        total("skill_tagged_jobs"), coverage("skill_tagged_jobs").alias("skill_coverage_pct"),
        total("experience_labeled_jobs"), coverage("experience_labeled_jobs").alias("experience_coverage_pct"),
        total("salary_source_jobs"), coverage("salary_source_jobs").alias("salary_source_coverage_pct"),
        total("salary_analysis_jobs"), coverage("salary_analysis_jobs").alias("salary_analysis_coverage_pct"),
        total("recent_90d_jobs"), total("complete_week_jobs"),
    )


def row_audit(jobs: DataFrame, bridge: DataFrame) -> DataFrame:
    """Row counts of the tables in one row."""
    return jobs.agg(
        F.count(F.lit(1)).alias("fact_jobs"), F.count_if("salary_analysis_eligible").alias("salary_analysis_rows")
    ).select(
        "fact_jobs",
        row_total(bridge).alias("job_skill_rows"),
        row_total(bridge.select("skill").distinct()).alias("unique_skills"),
        "salary_analysis_rows",
    )


def provenance(jobs: DataFrame) -> DataFrame:
    """Counts by source family and provider. Sources are counted raw, then labelled."""
    raw = count_by(jobs, ["source"], "n")
    labelled = raw.select(source_family(F.col("source")).alias("source_family"),
                          source_provider(F.col("source")).alias("source_provider"), "n")
    counts = count_by(labelled, ["source_family", "source_provider"], weight="n")
    return share(counts, "job_count").orderBy(F.desc("job_count"), "source_family", "source_provider")


def status_audit(jobs: DataFrame) -> DataFrame:
    status = F.coalesce("salary_normalization_status", F.lit(fixed.STATUS_FALLBACK)).alias("salary_status")
    counts = jobs.groupBy(status).agg(
        F.count(F.lit(1)).alias("job_count"), F.count_if("salary_analysis_eligible").alias("salary_analysis_jobs")
    )
    return share(counts, "job_count", total=row_total(jobs)).orderBy(F.desc("job_count"), "salary_status")


# --- roles, places, employers, modes, bands ---------------------------------------

def role_demand(jobs: DataFrame, role: str = "role_family", digits: int | None = 2) -> DataFrame:
    """Count, share, running share and dense rank. Roles are a fixed label list."""
    counts = count_by(jobs.withColumn(role, F.coalesce(role, F.lit(fixed.NOT_SPECIFIED))), [role])
    shared = share(counts, "job_count", "market_share_pct", total=row_total(jobs), digits=None)
    ran = cumulative(shared, "market_share_pct", [F.desc("job_count"), F.asc(role)], "cumulative_market_share_pct")
    if digits is not None:
        ran = ran.withColumns({c: round_to(c, digits) for c in ("market_share_pct", "cumulative_market_share_pct")})
    return demand_rank(ran, "job_count", bounded=True).orderBy(F.desc("job_count"), role)


def recent_role_mix(jobs: DataFrame, role: str = "role_family") -> DataFrame:
    recent = jobs.where("is_recent_90d")
    shared = share(count_by(recent, [role]), "job_count", "recent_market_share_pct", total=row_total(recent))
    return demand_rank(shared, "job_count", "recent_demand_rank", bounded=True).orderBy(F.desc("job_count"), role)


def role_audit(jobs: DataFrame, role: str = "role_family") -> DataFrame:
    return share(count_by(jobs, [role]), "job_count", total=row_total(jobs)).orderBy(F.desc("job_count"), role)


def label_mix(jobs: DataFrame, label: str, weight: str | None = None) -> DataFrame:
    """Counts and shares of one fixed label list (scope, mode, disclosure status)."""
    total = total_of(jobs, weight) if weight else row_total(jobs)
    return share(count_by(jobs, [label], weight=weight), "job_count", total=total).orderBy(F.desc("job_count"), label)


def city_demand(jobs: DataFrame, weight: str | None = None, digits: int | None = 2) -> DataFrame:
    """Specific cities, share among the rows with a specific city, dense rank."""
    counts = count_by(jobs.where(specific_city()), ["city", "state"], weight=weight)
    shared = share(counts, "job_count", "share_of_specific_city_jobs_pct", digits=digits)
    return demand_rank(shared, "job_count", "city_demand_rank").orderBy(F.desc("job_count"), "city")


def city_share_of_all(jobs: DataFrame, weight: str | None = None) -> DataFrame:
    """Specific cities with their share of all rows."""
    counts = count_by(jobs.where(specific_city()), ["city", "state"], weight=weight)
    total = total_of(jobs, weight) if weight else row_total(jobs)
    return share(counts, "job_count", "share_of_all_jobs_pct", total=total).orderBy(F.desc("job_count"), "city")


def employer_counts(jobs: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(jobs.where(known_employer()), ["company_name"], weight=weight)


def employer_demand(jobs: DataFrame, weight: str | None = None) -> DataFrame:
    """Every known employer, by demand."""
    return employer_counts(jobs, weight).orderBy(F.desc("job_count"), "company_name")


def employer_top(jobs: DataFrame, k: int = 25, weight: str | None = None) -> DataFrame:
    """Top ``k`` known employers with share and dense rank.

    The rank of a top row depends on higher rows only, all of which are among the k.
    """
    counts = employer_counts(jobs, weight)
    shared = share(top_k(counts, "job_count", k, ties=False, tie_break=["company_name"]), "job_count",
                   "employer_share_pct", total=total_of(counts, "job_count"))
    return demand_rank(shared, "job_count", "employer_rank", bounded=True).orderBy(F.desc("job_count"), "company_name")


def employer_concentration(
    jobs: DataFrame, k: int = 5, weight: str | None = None, denominator: str = "known"
) -> DataFrame:
    """Share of the top ``k`` employers among known employers, or among ``all`` rows."""
    counts = employer_counts(jobs, weight)
    top = top_k(counts, "job_count", k, ties=False, tie_break=["company_name"])
    if denominator == "known":
        total, name = total_of(counts, "job_count"), "known_employer_job_count"
    else:
        total, name = (total_of(jobs, weight) if weight else row_total(jobs)), "all_job_count"
    out = top.agg(F.sum("job_count").alias(f"top_{k}_job_count")).withColumn(name, total)
    return out.withColumn(f"top_{k}_employer_share_pct", round_to(safe_pct(F.col(f"top_{k}_job_count"), F.col(name)), 2))


def city_employers(jobs: DataFrame) -> DataFrame:
    """Postings and distinct employers per specific city, share among specific-city rows."""
    counts = jobs.where(specific_city()).groupBy("city", "state").agg(
        F.count(F.lit(1)).alias("job_count"), F.count_distinct("company_name").alias("hiring_companies")
    )
    return share(counts, "job_count", "share_of_specific_city_jobs_pct").orderBy(F.desc("job_count"), "city")


def employer_breadth(jobs: DataFrame) -> DataFrame:
    """Postings, distinct roles and distinct specific cities per known employer.

    Roles and cities of an employer are label lists, so both distinct counts come from one
    pre-aggregation by (employer, role, city).
    """
    cells = jobs.where(known_employer()).groupBy(
        "company_name", "role_family", F.when(specific_city(), F.col("city")).alias("city")
    ).agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy("company_name").agg(
        F.sum("n").cast("bigint").alias("job_count"),
        F.count_distinct("role_family").alias("role_families"),
        F.count_distinct("city").alias("specific_cities"),
    )


def band_mix(jobs: DataFrame) -> DataFrame:
    counts = share(count_by(jobs, ["experience_band"]), "job_count", total=row_total(jobs))
    return counts.orderBy(label_order("experience_band"))


def band_by_role(jobs: DataFrame) -> DataFrame:
    counts = count_by(jobs, ["role_family", "experience_band"])
    return share(counts, "job_count", "role_experience_share_pct", by=["role_family"]).orderBy(
        "role_family", F.desc("job_count"), "experience_band"
    )


def band_reindexed(jobs: DataFrame) -> DataFrame:
    """All bands of the fixed list with zero rows, and the share among labelled rows."""
    counts = count_by(jobs.withColumn("experience_band", F.coalesce("experience_band", F.lit(fixed.NOT_SPECIFIED))),
                      ["experience_band"])
    full = reindex(counts, "experience_band", fixed.BAND_ORDER, ["job_count"])
    labelled = F.col("experience_band") != fixed.NOT_SPECIFIED
    named = jobs.where(F.coalesce("experience_band", F.lit(fixed.NOT_SPECIFIED)) != fixed.NOT_SPECIFIED)
    return full.withColumns({
        "pct_of_all_jobs": round_to(safe_pct(F.col("job_count"), row_total(jobs)), 2),
        "pct_of_labeled_jobs": F.when(labelled, round_to(safe_pct(F.col("job_count"), row_total(named)), 2)),
    }).orderBy("label_order")


def monthly_counts(jobs: DataFrame) -> DataFrame:
    return count_by(jobs, ["posted_month"]).orderBy("posted_month")


# --- tags -----------------------------------------------------------------------

def tag_counts(bridge: DataFrame) -> DataFrame:
    """Entities per tag; links are distinct, so counting rows is counting entities."""
    return bridge.groupBy("skill", "skill_category").agg(F.count(F.lit(1)).alias("job_count"))


def tag_demand(jobs: DataFrame, bridge: DataFrame, filters: Sequence[Column] = ()) -> DataFrame:
    jobs, bridge = filtered_tags(jobs, bridge, filters)
    tagged = row_total(bridge.select("job_id").distinct())
    out = tag_counts(bridge).withColumns({
        "share_of_all_jobs_pct": round_to(safe_pct(F.col("job_count"), row_total(jobs)), 2),
        "share_of_skill_tagged_jobs_pct": round_to(safe_pct(F.col("job_count"), tagged), 2),
    })
    return demand_rank(out, "job_count", "skill_demand_rank", bounded=True).orderBy(F.desc("job_count"), "skill")


def tag_coverage(jobs: DataFrame, bridge: DataFrame, filters: Sequence[Column] = ()) -> DataFrame:
    jobs, bridge = filtered_tags(jobs, bridge, filters)
    return share(tag_counts(bridge), "job_count", total=row_total(jobs)).orderBy(F.desc("job_count"), "skill")


def tag_demand_recent(jobs: DataFrame, bridge: DataFrame) -> DataFrame:
    recent = jobs.where("is_recent_90d").select("job_id")
    counts = tag_counts(bridge.join(recent, "job_id"))
    return share(counts, "job_count", "recent_job_share_pct", total=row_total(recent)).orderBy(
        F.desc("job_count"), "skill"
    )


def tag_pairs(bridge: DataFrame, k: int | None = 50) -> DataFrame:
    """Pairs of tags by the number of entities with both; all pairs when ``k`` is None."""
    pairs = pair_counts(bridge).orderBy(F.desc("jobs_with_pair"), "skill_1", "skill_2")
    return pairs if k is None else pairs.limit(k)


def tag_pair_rate(bridge: DataFrame, k: int | None = 50) -> DataFrame:
    """Rate of the second tag among the entities that carry the first."""
    pairs = pair_counts(bridge, ordered=True, n="pair_jobs")
    singles = bridge.groupBy(F.col("skill").alias("skill_1")).agg(F.count(F.lit(1)).alias("skill_1_jobs"))
    out = pairs.join(singles, "skill_1").withColumn(
        "cooccurrence_rate_pct", round_to(safe_pct(F.col("pair_jobs"), F.col("skill_1_jobs")), 2)
    ).orderBy(F.desc("pair_jobs"), "skill_1", "skill_2")
    return out if k is None else out.limit(k)


# --- periods -----------------------------------------------------------------------

def role_period_mix(jobs: DataFrame) -> DataFrame:
    """Role shares inside the recent and the earlier period, long form."""
    counts = jobs.groupBy(period_label(F.col("is_recent_90d")).alias("market_period"), "role_family").agg(
        F.count(F.lit(1)).alias("job_count")
    )
    return share(counts, "job_count", by=["market_period"]).orderBy("role_family", "market_period")


def period_shift(df: DataFrame, label: str, n: str) -> DataFrame:
    """Share of each label in both periods and the change, absent labels counting as 0.

    One pass with two conditional sums takes the place of a full outer join of two halves.
    """
    recent = F.col("market_period") == fixed.RECENT_PERIOD
    wide = df.groupBy(label).agg(
        F.coalesce(F.sum(F.when(recent, F.col(n))), F.lit(0)).alias("_r"),
        F.coalesce(F.sum(F.when(~recent, F.col(n))), F.lit(0)).alias("_e"),
    )
    return wide.select(
        label,
        F.coalesce(safe_pct(F.col("_r"), total_of(wide, "_r")), F.lit(0.0)).alias("recent_share_pct"),
        F.coalesce(safe_pct(F.col("_e"), total_of(wide, "_e")), F.lit(0.0)).alias("pre_share_pct"),
    ).withColumn("share_change_pp", F.col("recent_share_pct") - F.col("pre_share_pct"))


def role_shift(jobs: DataFrame) -> DataFrame:
    counts = jobs.groupBy(period_label(F.col("is_recent_90d")).alias("market_period"), "role_family").agg(
        F.count(F.lit(1)).alias("n")
    )
    return period_shift(counts, "role_family", "n").orderBy(F.desc("share_change_pp"), "role_family")


def tag_period_counts(jobs: DataFrame, bridge: DataFrame) -> DataFrame:
    period = jobs.select("job_id", period_label(F.col("is_recent_90d")).alias("market_period"))
    return bridge.join(period, "job_id").groupBy("market_period", "skill").agg(F.count(F.lit(1)).alias("skill_jobs"))


def period_totals(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(period_label(F.col("is_recent_90d")).alias("market_period")).agg(
        F.count(F.lit(1)).alias("period_jobs")
    )


def tag_period_mix(jobs: DataFrame, bridge: DataFrame, digits: int | None = 2) -> DataFrame:
    """Tag shares of all entities of each period, long form."""
    joined = tag_period_counts(jobs, bridge).join(period_totals(jobs), "market_period")
    pct = safe_pct(F.col("skill_jobs"), F.col("period_jobs"))
    return joined.withColumn("skill_share_pct", pct if digits is None else round_to(pct, digits)).orderBy(
        "skill", "market_period"
    )


def period_ranges(jobs: DataFrame) -> DataFrame:
    """First and last date and number of rows per period."""
    return jobs.groupBy(period_label(F.col("is_recent_90d")).alias("market_period")).agg(
        F.min("posted_date").alias("first_date"), F.max("posted_date").alias("last_date"),
        F.count(F.lit(1)).alias("job_count"),
    )
