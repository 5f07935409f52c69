"""Star schema built from the clean postings: dimensions, fact, bridge, views, constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.functions.calendar import calendar
from tallywright.plans import clean
from tallywright.plans.star import build_star, job_tags, jobs_enriched, star_report, surrogate
from tallywright.registry import clean_queries as cq
from tallywright.registry.base_sql import with_ctes
from tallywright.session import materialize
from tallywright.sources import bindings as b


def star(spark, root, shared=False, whole=False):
    """The star of the clean postings. ``shared``: the result reads many of its tables, so the clean
    rows (without the long text, unless ``whole``) are written once; else each table reads its few columns directly."""
    jobs = cq.jobs(spark, root)
    if whole:
        jobs = materialize(jobs)
    elif shared:
        jobs = materialize(jobs.drop("description")).withColumn("description", F.lit(None).cast("string"))
    return build_star(jobs, clean.bridge_of(jobs))


_CALENDAR = ["calendar_year", "calendar_month", "month_name", "year_month", "week_start", "day_of_week", "day_name"]


def _doubles(df):
    """Decimals as doubles, for a comparison by value."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def _fact(spark, root):
    return _doubles(star(spark, root).fact_jobs)


QUERIES = {
    "dim_role": lambda s, r: star(s, r).dim_role,
    "dim_company": lambda s, r: star(s, r).dim_company,
    "dim_location": lambda s, r: star(s, r).dim_location,
    "dim_date": lambda s, r: star(s, r).dim_date,
    "dim_skill": lambda s, r: star(s, r).dim_skill,
    "fact_jobs": _fact,
    "bridge_job_skill": lambda s, r: star(s, r).bridge_job_skill,
    "jobs_enriched": lambda s, r: _doubles(jobs_enriched(star(s, r, True))),
    "job_tags": lambda s, r: _doubles(job_tags(star(s, r, True))),
    "star_report": lambda s, r: star_report(star(s, r, True)),
    "order_calendar": lambda s, r: calendar(b.table(s, r, "orders"), "o_orderdate"),
    "part_names": lambda s, r: surrogate(
        b.table(s, r, "part").select("p_name").distinct(), ["p_name"], "name_key", "ranges"),
}


def _calendar_sql(day: str) -> str:
    return f"""CAST(year({day}) AS INTEGER) AS calendar_year, CAST(month({day}) AS INTEGER) AS calendar_month,
        monthname({day}) AS month_name, strftime({day}, '%Y-%m') AS year_month,
        CAST(date_trunc('week', {day}) AS DATE) AS week_start, CAST(isodow({day}) - 1 AS INTEGER) AS day_of_week,
        dayname({day}) AS day_name"""


_EXTRA = {
    **cq.EXTRA,
    "roles": "SELECT role_family, row_number() OVER (ORDER BY role_family) AS role_key FROM (SELECT DISTINCT role_family FROM labels1)",
    "skills": """SELECT skill, skill_category, row_number() OVER (ORDER BY skill) AS skill_key
        FROM (SELECT DISTINCT skill, skill_category FROM tg)""",
    "wide": f"""
        SELECT cj.*, kept.title, kept.source, kept.predicted, CAST(kept.job_id AS BIGINT) AS k,
               coalesce(kept.location_name, 'Unknown') AS location_name, company AS company_name, kept.description, md5(kept.job_id) AS job_key, md5(company) AS company_key,
               md5(concat_ws(chr(1), city, state, coalesce(kept.location_name, 'Unknown'), location_scope)) AS location_key,
               {_calendar_sql('posted_date')}
        FROM (SELECT * EXCLUDE (week_start) FROM cj) cj JOIN kept ON kept.job_id = cj.job_id""",
}
_CONSTRAINTS = [
    "role_key_unique", "skill_key_unique", "role_parent", "bridge_skill_parent",
    "company_key_unique", "location_key_unique", "job_key_unique", "job_id_unique", "bridge_unique", "company_parent",
    "location_parent", "date_parent", "bridge_job_parent", "years_negative", "years_unordered", "pay_not_positive",
    "pay_unordered", "eligible_pay_missing", "skill_count_negative", "title_missing", "month_range", "weekday_range",
]
_FACTS = """work_mode, experience_min_years, experience_max_years, experience_band, salary_min_source, salary_max_source,
    salary_min, salary_max, salary_midpoint, CASE WHEN k % 10 IN (3, 4, 5) THEN k % 10 <> 5 END AS salary_is_predicted, has_salary_source,
    salary_analysis_eligible, salary_normalization_status, salary_text_evidence, CAST(coalesce(skill_count, 0) AS INTEGER) AS skill_count,
    has_extracted_skill, is_recent_90d, is_complete_week, source, source_family, source_provider,
    CAST(NULL AS VARCHAR) AS contract_type, CAST(NULL AS VARCHAR) AS contract_time, CAST(NULL AS VARCHAR) AS redirect_url"""
_NAMES = "job_key, wide.job_id, title, role_family, company_name, city, state, location_name, location_scope"
_TAGGED = "work_mode, experience_band, salary_midpoint, salary_analysis_eligible, is_recent_90d, is_complete_week, posted_date, skill, skill_category"
_SQL = {
    "dim_role": "SELECT * FROM roles",
    "dim_company": "SELECT DISTINCT company_name, company_key FROM wide",
    "dim_location": "SELECT DISTINCT city, state, location_name, location_scope, location_key FROM wide",
    "dim_date": f"SELECT DISTINCT posted_date AS date_key, {_calendar_sql('posted_date')} FROM wide",
    "dim_skill": "SELECT * FROM skills",
    "fact_jobs": f"""SELECT job_key, job_id, role_key, company_key, location_key, posted_date AS date_key, title, description, {_FACTS}
        FROM wide JOIN roles USING (role_family)""",
    "bridge_job_skill": "SELECT md5(job_id) AS job_key, skill_key FROM tg JOIN skills USING (skill)",
    "jobs_enriched": f"SELECT {_NAMES}, posted_date, {', '.join(_CALENDAR)}, {_FACTS} FROM wide",
    "job_tags": f"SELECT {_NAMES}, {_TAGGED} FROM wide JOIN tg ON tg.job_id = wide.job_id",
    "star_report": "SELECT unnest([" + ", ".join(f"'{c}'" for c in _CONSTRAINTS)
    + "]) AS rule, 0::BIGINT AS failed_rows, true AS passed",
    "order_calendar": f"SELECT DISTINCT d AS date_key, {_calendar_sql('d')} FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)",
    "part_names": "SELECT p_name, row_number() OVER (ORDER BY p_name) AS name_key FROM (SELECT DISTINCT p_name FROM part)",
}
ORACLES = {name: with_ctes(sql, _EXTRA) for name, sql in _SQL.items()}
