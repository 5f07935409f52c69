"""Measures under filters, and the ranked tables of the report pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.text import pair_label, safe_ratio, to_lakh
from tallywright.operators.pairs import pair_counts
from tallywright.operators.quantiles import group_stats
from tallywright.operators.sets import apply_filters, filtered_tags, has_tag
from tallywright.operators.shares import count_by, row_total, top_k, total_of
from tallywright.plans.demand import known_employer, period_totals, specific_city, tag_period_counts
from tallywright.session import materialize

VALUE = "salary_midpoint"
#: What the measures read of a job.
READ = [
    "job_id", "company_name", "city", "location_scope", "role_family", "week_start", "has_extracted_skill", "experience_min_years",
    "salary_analysis_eligible", "is_recent_90d", "is_complete_week", VALUE,
]


def conditions() -> dict[str, Column]:
    """The measures that count the jobs for which a condition holds."""
    return {
        "skill_tagged_jobs": F.col("has_extracted_skill"), "experience_labeled_jobs": F.col("experience_min_years").isNotNull(),
        "salary_observations": F.col("salary_analysis_eligible"), "specific_city_vacancies": specific_city(),
        "other_role_jobs": F.col("role_family") == fixed.OTHER_ROLE, "recent_90d_jobs": F.col("is_recent_90d"),
        "pre_90d_jobs": ~F.col("is_recent_90d"), "complete_week_jobs": F.col("is_complete_week"),
    }


def _scalars(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, extremes and means per group.

    Rows are counted by employer and city first, so the distinct counts go over those groups.
    """
    eligible = F.col("salary_analysis_eligible")
    value = F.when(eligible, F.col(VALUE))
    counts = conditions()
    rows = jobs.withColumns({
        "_employer": F.when(known_employer(), F.col("company_name")), "_city": F.when(specific_city(), F.col("city")),
    })
    groups = rows.groupBy(*keys, "_employer", "_city").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(x).alias(name) for name, x in counts.items()],
        F.sum(value).alias("_sum"), F.count(value).alias("_values"), F.min(value).alias("_min"), F.max(value).alias("_max"),
    )
    out = groups.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("analytical_vacancies"),
        F.count_distinct("_employer").alias("unique_companies"),
        F.count_distinct("_city").alias("unique_specific_cities"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        to_lakh(safe_ratio(F.sum("_sum"), F.sum("_values"))).alias("mean_salary_lakh"),
        to_lakh(F.min("_min")).alias("minimum_salary_lakh"),
        to_lakh(F.max("_max")).alias("maximum_salary_lakh"),
    )
    weeks = jobs.where("is_complete_week").select(*keys, "week_start").distinct().groupBy(*keys).agg(
        F.count("week_start").alias("complete_weeks")
    )
    return glue(out, weeks, keys).withColumn("complete_weeks", F.coalesce("complete_weeks", F.lit(0)))


def _top_employers(jobs: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """Rows of the k largest known employers per group.

    The rank filter is pushed below the shuffle, so each task sends k rows per group at most.
    """
    counts = count_by(jobs.where(known_employer()), [*keys, "company_name"], "n")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "company_name"))
    top = counts.withColumn("_p", place).where(F.col("_p") <= k) if keys else counts.orderBy(F.desc("n"), "company_name").limit(k)
    return top.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("top_5_employer_jobs"))


def _tag_scalars(jobs: DataFrame, bridge: DataFrame, keys: list[str]) -> DataFrame:
    rows = bridge.join(jobs.select("job_id", *keys), "job_id")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("job_skill_rows"), F.count_distinct("skill").alias("unique_skills")
    )


def glue(base: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Add the columns of a frame with one row per group, or of a one-row frame."""
    names = [c for c in other.columns if c not in keys]
    if not keys:
        return base.withColumn("_g", other.select(F.struct(*names)).scalar()).select("*", "_g.*").drop("_g")
    side = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *names)
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return base.join(side, same, "left").drop(*[f"_k_{k}" for k in keys])


def kpis(
    jobs: DataFrame, bridge: DataFrame, filters: Sequence[Column] = (), by: str | None = None,
    tag: str = fixed.COMPARED_TAG,
) -> DataFrame:
    """All scalar measures for the rows that pass ``filters``, in total or per label ``by``.

    Filters act on jobs and, through the id, on their tags. The comparison of rows with and
    without one tag ignores any tag filter, since it reads the unfiltered bridge.

    The rows that pass are written once with the short columns that measures read, and those with pay once more with
    their flag of the tag: every measure reads these, so filters, joins of dimensions and the tag join run once each.
    """
    keys = [by] if by else []
    kept = materialize(apply_filters(jobs, filters).select(*dict.fromkeys([*READ, *keys])), name="kept")
    out = _scalars(kept, keys)
    flagged = materialize(has_tag(kept.where("salary_analysis_eligible").select("job_id", VALUE, *keys), bridge, tag).drop("job_id"), name="flagged")
    quartiles = group_stats(flagged, keys, VALUE, (0.25, 0.5, 0.75), ("_p25", "_p50", "_p75"), n="_n")
    out = glue(out, quartiles.drop("_n"), keys)
    out = glue(out, _top_employers(kept, keys), keys)
    out = glue(out, _tag_scalars(kept, bridge, keys), keys)
    medians = group_stats(flagged, [*keys, "has_tag"], VALUE, (0.5,), ("_m",), n="_n")
    sides = medians.groupBy(*keys).agg(
        F.max(F.when(F.col("has_tag"), F.col("_n"))).alias("tag_salary_observations"),
        F.max(F.when(F.col("has_tag"), F.col("_m"))).alias("_with"),
        F.max(F.when(~F.col("has_tag"), F.col("_m"))).alias("_without"),
    )
    out = glue(out, sides, keys)
    return derived(out)


def derived(out: DataFrame) -> DataFrame:
    """Medians in their unit, gates, coverages and shares, from the counts and quantiles of each group."""
    n = F.col("analytical_vacancies")
    observed = F.col("salary_observations")
    zero = F.lit(0).cast("bigint")
    out = out.withColumns({
        "tag_salary_observations": F.coalesce("tag_salary_observations", zero),
        "job_skill_rows": F.coalesce("job_skill_rows", zero),
        "unique_skills": F.coalesce("unique_skills", zero),
        "median_salary_lakh": to_lakh(F.col("_p50")),
        "p25_salary_lakh": to_lakh(F.col("_p25")),
        "p75_salary_lakh": to_lakh(F.col("_p75")),
        "median_salary_n30_lakh": F.when(observed >= 30, to_lakh(F.col("_p50"))),
        "median_salary_n20_lakh": F.when(observed >= 20, to_lakh(F.col("_p50"))),
        "skill_coverage": safe_ratio(F.col("skill_tagged_jobs"), n),
        "experience_coverage": safe_ratio(F.col("experience_labeled_jobs"), n),
        "salary_coverage": safe_ratio(observed, n),
        "top_5_employer_share": safe_ratio(F.col("top_5_employer_jobs"), n),
        "other_role_share": safe_ratio(F.col("other_role_jobs"), n),
        "tag_median_lakh": to_lakh(F.col("_with")),
        "rest_median_lakh": to_lakh(F.col("_without")),
    })
    return out.withColumns({
        "rest_salary_observations": observed - F.col("tag_salary_observations"),
        "tag_median_difference_lakh": F.col("tag_median_lakh") - F.col("rest_median_lakh"),
    }).drop("_p25", "_p50", "_p75", "_with", "_without")


def top_cities(jobs: DataFrame, k: int = 10, weight: str | None = None) -> DataFrame:
    """Cities of the ``k`` highest counts, ties included."""
    counts = count_by(jobs.where(specific_city()), ["city"], weight=weight)
    return top_k(counts, "job_count", k, ties=True, rank="city_rank")


def top_companies(jobs: DataFrame, k: int = 15, weight: str | None = None) -> DataFrame:
    """Companies of the ``k`` highest counts, ties and the unknown label included."""
    counts = count_by(jobs, ["company_name"], weight=weight)
    return top_k(counts, "job_count", k, ties=True, rank="company_rank")


def tag_table(jobs: DataFrame, bridge: DataFrame, filters: Sequence[Column] = ()) -> DataFrame:
    """Entities per tag and their share of all entities, of those that pass ``filters``."""
    jobs, bridge = filtered_tags(jobs, bridge, filters)
    counts = bridge.groupBy("skill").agg(F.count(F.lit(1)).alias("skill_jobs"))
    return counts.withColumn("skill_share", safe_ratio(F.col("skill_jobs"), row_total(jobs)))


def top_tags(jobs: DataFrame, bridge: DataFrame, k: int = 15, filters: Sequence[Column] = ()) -> DataFrame:
    return top_k(tag_table(jobs, bridge, filters), "skill_jobs", k, ties=True, rank="skill_rank")


def tag_period_shares(jobs: DataFrame, bridge: DataFrame, top: int | None = None) -> DataFrame:
    """Recent and earlier share per tag and the change in points; optionally only the top tags.

    The rank is by all entities of a tag, whichever period they are from.
    """
    counts = tag_period_counts(jobs, bridge)
    totals = period_totals(jobs)
    recent = F.col("market_period") == fixed.RECENT_PERIOD
    r_total = total_of(totals.where(recent), "period_jobs")
    e_total = total_of(totals.where(~recent), "period_jobs")
    wide = counts.groupBy("skill").agg(
        F.sum("skill_jobs").cast("bigint").alias("skill_jobs"),
        F.sum(F.when(recent, F.col("skill_jobs"))).alias("_r"),
        F.sum(F.when(~recent, F.col("skill_jobs"))).alias("_e"),
    )
    if top is not None:
        wide = top_k(wide, "skill_jobs", top, ties=True)
    recent_share, earlier_share = safe_ratio(F.col("_r"), r_total), safe_ratio(F.col("_e"), e_total)
    change = (F.coalesce(recent_share, F.lit(0.0)) - F.coalesce(earlier_share, F.lit(0.0))) * 100
    return wide.select("skill", "skill_jobs", recent_share.alias("recent_share"), earlier_share.alias("earlier_share"),
                       change.alias("change_pp"))


def top_pairs(bridge: DataFrame, k: int = 10, jobs: DataFrame | None = None, filters: Sequence[Column] = ()) -> DataFrame:
    """Pairs of the ``k`` highest counts, ties included, with their share of tagged entities.

    With ``jobs``, of the tags of those that pass ``filters``.
    """
    if jobs is not None:
        _, bridge = filtered_tags(jobs, bridge, filters)
    pairs = top_k(pair_counts(bridge, n="pair_jobs"), "pair_jobs", k, ties=True, rank="pair_rank")
    tagged = row_total(bridge.select("job_id").distinct())
    return pairs.select(
        pair_label(F.col("skill_1"), F.col("skill_2")).alias("skill_pair"), "pair_jobs", "pair_rank",
        safe_ratio(F.col("pair_jobs"), tagged).alias("share_of_tagged_jobs"),
    )
