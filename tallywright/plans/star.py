"""Star schema over the clean tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.calendar import calendar
from tallywright.functions.text import clean_text, parse_bool
from tallywright.operators.quality import expect, expect_count, expect_foreign_key, expect_unique, union_reports


@dataclass(frozen=True)
class Star:
    dim_role: DataFrame
    dim_company: DataFrame
    dim_location: DataFrame
    dim_date: DataFrame
    dim_skill: DataFrame
    fact_jobs: DataFrame
    bridge_job_skill: DataFrame

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.names()}


#: Leading characters by which names are counted before they are numbered.
PREFIX = 4


def key_of(*natural: str) -> Column:
    """128 bits of the natural columns as hex, so that keys don't collide at any number of rows; a null counts as empty."""
    return F.md5(F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural]).cast("binary"))


def surrogate(df: DataFrame, natural: Sequence[str], name: str, method: str = "hash") -> DataFrame:
    """Add a surrogate key to a frame of distinct natural keys.

    ``rank``: 1, 2, ... in the order of the natural key, for dimensions bounded by a rule
    list. ``ranges``: the same numbers for any number of names, counted by prefix first, so that
    only counts of prefixes meet in one task. ``hash``: 128-bit hash, for dimensions that grow with the data; a fact computes it
    from its own columns, so no key lookup is joined. ``star_report`` checks that hash keys
    are unique.
    """
    if method == "ranges":
        # names before one's own prefix, then the place among those that share it
        df = df.withColumn("_prefix", F.substring(F.concat_ws("\x01", *natural), 1, PREFIX))
        sizes = df.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
        sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        place = F.row_number().over(Window.partitionBy("_prefix").orderBy(*natural))
        df = df.withColumn(name, place).join(sizes, "_prefix")
        return df.withColumn(name, (F.col(name) + F.col("_before")).cast("bigint")).drop("_prefix", "_n", "_before")
    if method == "rank":
        return df.withColumn(name, F.row_number().over(Window.orderBy(*natural)).cast("bigint"))
    return df.withColumn(name, key_of(*natural))


def _company(c: str = "company_name") -> Column:
    trimmed = clean_text(F.col(c))
    return F.when(trimmed == "", fixed.UNKNOWN_COMPANY).otherwise(trimmed)


_PLACE = ["city", "state", "location_name", "location_scope"]


def _place() -> dict[str, Column]:
    return {c: F.coalesce(F.col(c), F.lit(fixed.UNKNOWN)) for c in _PLACE}


FACT_COLUMNS = [
    "job_key", "job_id", "role_key", "company_key", "location_key", "date_key", "source", "source_family", "source_provider",
    "title", "description", "work_mode", "experience_min_years", "experience_max_years", "experience_band",
    "salary_min_source", "salary_max_source", "salary_min", "salary_max", "salary_midpoint", "salary_is_predicted",
    "has_salary_source", "salary_analysis_eligible", "salary_normalization_status", "salary_text_evidence", "skill_count",
    "has_extracted_skill", "is_recent_90d", "is_complete_week", "contract_type", "contract_time", "redirect_url",
]


def fact_rows(jobs: DataFrame) -> DataFrame:
    """Clean jobs with the types and filled labels of the fact, and the natural keys of its dimensions."""
    years = {c: F.col(c).cast("decimal(6,2)") for c in ("experience_min_years", "experience_max_years")}
    money = {
        c: F.col(c).cast("decimal(18,2)")
        for c in ("salary_min_source", "salary_max_source", "salary_min", "salary_max", "salary_midpoint")
    }
    return jobs.withColumns({
        **_place(),
        "company_name": _company(),
        "role_family": F.coalesce("role_family", F.lit(fixed.OTHER_ROLE)),
        "date_key": F.col("posted_date"),
        "work_mode": F.coalesce("work_mode", F.lit(fixed.NOT_SPECIFIED)),
        "experience_band": F.coalesce("experience_band", F.lit(fixed.NOT_SPECIFIED)),
        "salary_is_predicted": parse_bool(F.col("salary_is_predicted"), "null"),
        **years, **money,
    })


def build_star(jobs: DataFrame, bridge: DataFrame) -> Star:
    role = F.coalesce("role_family", F.lit(fixed.OTHER_ROLE)).alias("role_family")
    dim_role = surrogate(jobs.select(role).distinct(), ["role_family"], "role_key", "rank")
    dim_company = surrogate(jobs.select(_company().alias("company_name")).distinct(), ["company_name"], "company_key")
    dim_location = surrogate(jobs.withColumns(_place()).select(*_PLACE).distinct(), _PLACE, "location_key")
    dim_skill = surrogate(
        bridge.groupBy("skill").agg(F.min("skill_category").alias("skill_category")), ["skill"], "skill_key", "rank"
    )
    # Dates, roles and skills are bounded lists; companies, places and jobs get hash keys in place.
    keys = {"job_key": key_of("job_id"), "company_key": key_of("company_name"), "location_key": key_of(*_PLACE)}
    fact = fact_rows(jobs).withColumns(keys).join(dim_role, "role_family").select(*FACT_COLUMNS)
    links = (
        bridge.select(key_of("job_id").alias("job_key"), "skill")
        .join(dim_skill.select("skill", "skill_key"), "skill")
        .select("job_key", "skill_key")
        .dropDuplicates()
    )
    return Star(dim_role, dim_company, dim_location, calendar(jobs, "posted_date"), dim_skill, fact, links)


def key_lookup(df: DataFrame, dim: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """Replace nothing, add the surrogate ``key`` of ``dim`` by null-safe natural columns."""
    side = dim.select(*[F.col(c).alias(f"_n_{c}") for c in natural], key)
    same = [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in natural]
    return df.join(side, same, "left").drop(*[f"_n_{c}" for c in natural])


def jobs_enriched(star: Star) -> DataFrame:
    """Fact with the attributes of its four dimensions."""
    f = (
        star.fact_jobs.join(star.dim_role, "role_key")
        .join(star.dim_company, "company_key")
        .join(star.dim_location, "location_key")
        .join(star.dim_date, "date_key")
    )
    return f.withColumnRenamed("date_key", "posted_date").select(
        "job_key", "job_id", "title", "role_family", "company_name", *_PLACE, "work_mode", "experience_min_years",
        "experience_max_years", "experience_band", "salary_min_source", "salary_max_source", "salary_min",
        "salary_max", "salary_midpoint", "salary_is_predicted", "has_salary_source", "salary_analysis_eligible",
        "salary_normalization_status", "salary_text_evidence", "skill_count", "has_extracted_skill",
        "is_recent_90d", "is_complete_week", "source", "source_family", "source_provider", "posted_date",
        "calendar_year", "calendar_month", "month_name", "year_month", "week_start", "day_of_week", "day_name",
        "contract_type", "contract_time", "redirect_url",
    )


def job_tags(star: Star) -> DataFrame:
    """Bridge with the attributes of its job and its skill."""
    rows = (
        star.bridge_job_skill.join(star.fact_jobs, "job_key")
        .join(star.dim_skill, "skill_key")
        .join(star.dim_role, "role_key")
        .join(star.dim_company, "company_key")
        .join(star.dim_location, "location_key")
    )
    return rows.withColumnRenamed("date_key", "posted_date").select(
        "job_key", "job_id", "title", "role_family", "company_name", *_PLACE, "work_mode", "experience_band",
        "salary_midpoint", "salary_analysis_eligible", "is_recent_90d", "is_complete_week", "posted_date", "skill",
        "skill_category",
    )


def register_views(star: Star) -> None:
    jobs_enriched(star).createOrReplaceTempView("vw_jobs_enriched")
    job_tags(star).createOrReplaceTempView("vw_job_skills")


def star_report(star: Star, expected_rows: Mapping[str, int] = {}) -> DataFrame:
    """Constraints of the star as expectations: unique keys, parents, value checks, pinned row counts."""
    f = star.fact_jobs
    low, high, mid = F.col("salary_min"), F.col("salary_max"), F.col("salary_midpoint")
    lo, hi, eligible = F.col("experience_min_years"), F.col("experience_max_years"), F.col("salary_analysis_eligible")
    return union_reports(
        *[expect_count(getattr(star, name), n, f"rows_of_{name}") for name, n in expected_rows.items()],
        expect_unique(star.dim_role, ["role_key"], "role_key_unique"),
        expect_unique(star.dim_skill, ["skill_key"], "skill_key_unique"),
        expect_foreign_key(f, star.dim_role, "role_key", "role_parent"),
        expect_foreign_key(star.bridge_job_skill, star.dim_skill, "skill_key", "bridge_skill_parent"),
        expect_unique(star.dim_company, ["company_key"], "company_key_unique"),
        expect_unique(star.dim_location, ["location_key"], "location_key_unique"),
        expect_unique(f, ["job_key"], "job_key_unique"),
        expect_unique(f, ["job_id"], "job_id_unique"),
        expect_unique(star.bridge_job_skill, ["job_key", "skill_key"], "bridge_unique"),
        expect_foreign_key(f, star.dim_company, "company_key", "company_parent"),
        expect_foreign_key(f, star.dim_location, "location_key", "location_parent"),
        expect_foreign_key(f, star.dim_date, "date_key", "date_parent"),
        expect_foreign_key(star.bridge_job_skill, f, "job_key", "bridge_job_parent"),
        expect(f, {
            "years_negative": (lo < 0) | (hi < 0),
            "years_unordered": hi < lo,
            "pay_not_positive": (low <= 0) | (high <= 0),
            "pay_unordered": high < low,
            "eligible_pay_missing": eligible & (low.isNull() | high.isNull() | mid.isNull()),
            "skill_count_negative": F.col("skill_count") < 0,
            "title_missing": F.col("title").isNull(),
        }),
        expect(star.dim_date, {
            "month_range": ~F.col("calendar_month").between(1, 12),
            "weekday_range": ~F.col("day_of_week").between(0, 6),
        }),
    )
