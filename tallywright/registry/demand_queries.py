"""Demand analyses over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.functions.text import round_to
from tallywright.operators.pairs import tag_sets
from tallywright.operators.sets import difference, intersection, with_tag_flag
from tallywright.plans import demand, kpi, reports
from tallywright.registry.base_sql import CTES, pct, r2, with_ctes
from tallywright.sources import bindings as b


def _jobs(fn):
    return lambda spark, root: fn(b.jobs(spark, root))


def _both(fn):
    return lambda spark, root: fn(b.jobs(spark, root), b.bridge(spark, root))


def _bridge(fn):
    return lambda spark, root: fn(b.bridge(spark, root))


def _counted(fn):
    return lambda spark, root: fn(b.employer_totals(spark, root))


def _placed(fn):
    return lambda spark, root: fn(b.with_employer(b.jobs(spark, root), spark, root))


def full_jobs(spark, root):
    """Jobs with employer, place and tag columns."""
    return with_tag_flag(b.with_employer(b.jobs(spark, root), spark, root), b.bridge(spark, root))


def _slicers():
    """Date range and role list, as a report page would set them."""
    return [
        F.col("posted_date").between(F.lit("1996-01-01").cast("date"), F.lit("2000-06-30").cast("date")),
        F.col("role_family").isin("1-URGENT", "2-HIGH"),
    ]


QUERIES = {
    "overview": lambda s, r: demand.overview(full_jobs(s, r)),
    "overview_metrics": lambda s, r: reports.overview_metrics(full_jobs(s, r), b.bridge(s, r)),
    "row_audit": _both(demand.row_audit),
    "provenance": _jobs(demand.provenance),
    "status_audit": _jobs(demand.status_audit),
    "role_demand": _jobs(demand.role_demand),
    "recent_role_mix": _jobs(demand.recent_role_mix),
    "role_audit": _jobs(demand.role_audit),
    "scope_mix": _counted(lambda t: demand.label_mix(t, "location_scope", weight="n")),
    "city_demand": _counted(lambda t: demand.city_demand(t, weight="n")),
    "city_share_of_all": _counted(lambda t: demand.city_share_of_all(t, weight="n")),
    "employer_demand": _counted(lambda t: demand.employer_demand(t, weight="n")),
    "employer_top": _counted(lambda t: demand.employer_top(t, weight="n")),
    "employer_concentration": _counted(lambda t: demand.employer_concentration(t, weight="n")),
    "employer_concentration_all": _counted(lambda t: demand.employer_concentration(t, weight="n", denominator="all")),
    "city_employers": _placed(demand.city_employers),
    "employer_breadth": _placed(demand.employer_breadth),
    "mode_mix": _jobs(lambda j: demand.label_mix(j, "work_mode")),
    "band_mix": _jobs(demand.band_mix),
    "band_by_role": _jobs(demand.band_by_role),
    "band_reindexed": _jobs(demand.band_reindexed),
    "monthly_counts": _jobs(demand.monthly_counts),
    "tag_demand": _both(demand.tag_demand),
    "tag_coverage": _both(demand.tag_coverage),
    "tag_demand_recent": _both(demand.tag_demand_recent),
    "tag_pairs": _bridge(demand.tag_pairs),
    "tag_pairs_all": _bridge(lambda t: demand.tag_pairs(t, k=None)),
    "tag_pair_rate": _bridge(demand.tag_pair_rate),
    "tag_sets": _bridge(lambda t: tag_sets(t).select("job_id", F.concat_ws("|", "tags").alias("tags"))),
    "jobs_with_tag": _both(lambda j, t: intersection(j.select("job_id", "role_family"), t.where(F.col("skill") == b.BRAND), "job_id")),
    "jobs_without_tag": _both(lambda j, t: difference(j.select("job_id", "role_family"), t.where(F.col("skill") == b.BRAND), "job_id")),
    "role_period_mix": _jobs(demand.role_period_mix),
    "role_shift": _jobs(lambda j: demand.role_shift(j).withColumns({
        c: round_to(c, 6) for c in ("recent_share_pct", "pre_share_pct", "share_change_pp")
    })),
    "tag_period_mix": _both(demand.tag_period_mix),
    "period_ranges": _jobs(demand.period_ranges),
    "top_cities": _counted(lambda t: kpi.top_cities(t, weight="n")),
    "top_companies": _counted(lambda t: kpi.top_companies(t, weight="n")),
    "top_tags": _both(kpi.top_tags),
    "tag_period_shares": _both(kpi.tag_period_shares),
    "tag_period_shares_top": _both(lambda j, t: kpi.tag_period_shares(j, t, top=10)),
    "top_pairs": _bridge(kpi.top_pairs),
    "top_tags_filtered": _both(lambda j, t: kpi.top_tags(j, t, filters=_slicers())),
    "tag_demand_filtered": _both(lambda j, t: demand.tag_demand(j, t, _slicers())),
    "top_pairs_filtered": _both(lambda j, t: kpi.top_pairs(t, jobs=j, filters=_slicers())),
}

_ROLE = f"""
    SELECT role_family, job_count, {r2('p')} AS market_share_pct,
           {r2('sum(p) OVER (ORDER BY job_count DESC, role_family ROWS UNBOUNDED PRECEDING)')}
               AS cumulative_market_share_pct,
           CAST(dense_rank() OVER (ORDER BY job_count DESC) AS INTEGER) AS demand_rank
    FROM (SELECT role_family, count(*) AS job_count,
                 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS p FROM jobs GROUP BY 1)"""


def _mix(table: str, keys: str, share: str = "share_pct", where: str = "true", by: str = "") -> str:
    over = f"PARTITION BY {by}" if by else ""
    return f"""SELECT {keys}, count(*) AS job_count, {pct('count(*)', f'sum(count(*)) OVER ({over})')} AS {share}
               FROM {table} WHERE {where} GROUP BY {keys}"""


def _rank(sql: str, name: str, n: str = "job_count") -> str:
    return f"SELECT *, CAST(dense_rank() OVER (ORDER BY {n} DESC) AS INTEGER) AS {name} FROM ({sql})"


_KNOWN = "company_name <> 'Unknown Company'"
_CITY = "location_scope = 'Specific City'"
_EMPLOYERS = f"SELECT company_name, count(*) AS job_count FROM je WHERE {_KNOWN} GROUP BY 1"
_TAGS = "SELECT skill, skill_category, count(*) AS job_count FROM br GROUP BY 1, 2"
_TAG_N = "(SELECT count(*) FROM tagged)"
_ALL_N = "(SELECT count(*) FROM jobs)"


def _wide_period(src: str) -> str:
    return f"""
    SELECT skill, CAST(sum(n) AS BIGINT) AS skill_jobs, sum(n) FILTER (WHERE market_period LIKE 'Recent%')::DOUBLE
               / (SELECT count(*) FROM jobs WHERE is_recent_90d) AS recent_share,
           sum(n) FILTER (WHERE market_period LIKE 'Pre%')::DOUBLE
               / (SELECT count(*) FROM jobs WHERE NOT is_recent_90d) AS earlier_share
    FROM (SELECT skill, market_period, count(*) AS n FROM periods JOIN br USING (job_id) GROUP BY 1, 2)
    GROUP BY 1 {src}"""


def _change(src: str) -> str:
    return f"""SELECT *, (coalesce(recent_share, 0) - coalesce(earlier_share, 0)) * 100 AS change_pp FROM ({src})"""


_OVER = {
    "unique_vacancies": "count(*)", "unique_companies": "count(DISTINCT company_key)",
    "unique_locations": "count(DISTINCT location_key)", "role_families": "count(DISTINCT role_family)",
    "skill_tagged_jobs": "count(*) FILTER (WHERE has_extracted_skill)",
    "skill_coverage_pct": pct("count(*) FILTER (WHERE has_extracted_skill)", "count(*)"),
    "experience_labeled_jobs": "count(experience_min_years)",
    "experience_coverage_pct": pct("count(experience_min_years)", "count(*)"),
    "salary_source_jobs": "count(*) FILTER (WHERE has_salary_source)",
    "salary_source_coverage_pct": pct("count(*) FILTER (WHERE has_salary_source)", "count(*)"),
    "salary_analysis_jobs": "count(*) FILTER (WHERE salary_analysis_eligible)",
    "salary_analysis_coverage_pct": pct("count(*) FILTER (WHERE salary_analysis_eligible)", "count(*)"),
    "recent_90d_jobs": "count(*) FILTER (WHERE is_recent_90d)",
    "complete_week_jobs": "count(*) FILTER (WHERE is_complete_week)",
}
_METRICS = {
    "analytical_vacancies": _OVER["unique_vacancies"],
    "has_extracted_skill_jobs": _OVER["skill_tagged_jobs"], "has_extracted_skill_pct": _OVER["skill_coverage_pct"],
    "has_salary_source_jobs": _OVER["salary_source_jobs"], "has_salary_source_pct": _OVER["salary_source_coverage_pct"],
    "salary_analysis_eligible_jobs": _OVER["salary_analysis_jobs"],
    "salary_analysis_eligible_pct": _OVER["salary_analysis_coverage_pct"],
    "experience_labeled_jobs": _OVER["experience_labeled_jobs"], "experience_labeled_pct": _OVER["experience_coverage_pct"],
    "recent_90d_jobs": _OVER["recent_90d_jobs"], "complete_week_jobs": _OVER["complete_week_jobs"],
}

_SQL = {
    "overview": "SELECT " + ", ".join(f"{x} AS {n}" for n, x in _OVER.items()) + " FROM je2",
    "overview_metrics": " UNION ALL ".join(
        [f"SELECT '{n}' AS metric, ({x})::DOUBLE AS value FROM je2" for n, x in _METRICS.items()]
        + ["SELECT 'job_skill_rows', count(*)::DOUBLE FROM br",
           "SELECT 'unique_skills', count(DISTINCT skill)::DOUBLE FROM br"]
    ),
    "row_audit": """SELECT (SELECT count(*) FROM jobs) AS fact_jobs, (SELECT count(*) FROM br) AS job_skill_rows,
        (SELECT count(DISTINCT skill) FROM br) AS unique_skills,
        (SELECT count(*) FROM jobs WHERE salary_analysis_eligible) AS salary_analysis_rows""",
    "provenance": f"""
        SELECT source_family, source_provider, count(*) AS job_count,
               {pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct
        FROM (SELECT CASE WHEN source LIKE '%adzuna%' THEN 'Adzuna' WHEN source LIKE 'freehire%' THEN 'Freehire'
                          ELSE 'Other' END AS source_family,
                     CASE WHEN source = 'freehire/' THEN 'Unknown'
                          WHEN source LIKE '%/%' THEN CASE split_part(source, '/', 2)
                              WHEN 'urgent' THEN 'Urgent' WHEN 'high' THEN 'High' WHEN 'medium' THEN 'Medium'
                              WHEN 'not specified' THEN 'Not Specified' WHEN 'low' THEN 'Low' END
                          WHEN source LIKE '%adzuna%' THEN 'Adzuna' ELSE source END AS source_provider
              FROM jobs) GROUP BY 1, 2""",
    "status_audit": f"""
        SELECT coalesce(salary_normalization_status, 'No Salary Source') AS salary_status, count(*) AS job_count,
               count(*) FILTER (WHERE salary_analysis_eligible) AS salary_analysis_jobs,
               {pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct FROM jobs GROUP BY 1""",
    "role_demand": _ROLE,
    "recent_role_mix": _rank(_mix("jobs", "role_family", "recent_market_share_pct", "is_recent_90d"), "recent_demand_rank"),
    "role_audit": _mix("jobs", "role_family"),
    "scope_mix": _mix("je", "location_scope"),
    "city_demand": _rank(_mix("je", "city, state", "share_of_specific_city_jobs_pct", _CITY), "city_demand_rank"),
    "city_share_of_all": f"""SELECT city, state, count(*) AS job_count,
        {pct('count(*)', _ALL_N)} AS share_of_all_jobs_pct FROM je WHERE {_CITY} GROUP BY 1, 2""",
    "employer_demand": _EMPLOYERS,
    "employer_top": _rank(_mix("je", "company_name", "employer_share_pct", _KNOWN), "employer_rank")
    + " ORDER BY job_count DESC, company_name LIMIT 25",
    "employer_concentration": f"""
        SELECT sum(job_count) FILTER (WHERE p <= 5)::BIGINT AS top_5_job_count,
               sum(job_count)::BIGINT AS known_employer_job_count,
               {pct('sum(job_count) FILTER (WHERE p <= 5)', 'sum(job_count)')} AS top_5_employer_share_pct
        FROM (SELECT *, row_number() OVER (ORDER BY job_count DESC, company_name) AS p FROM ({_EMPLOYERS}))""",
    "employer_concentration_all": f"""
        SELECT sum(job_count) FILTER (WHERE p <= 5)::BIGINT AS top_5_job_count, {_ALL_N} AS all_job_count,
               {pct('sum(job_count) FILTER (WHERE p <= 5)', _ALL_N)} AS top_5_employer_share_pct
        FROM (SELECT *, row_number() OVER (ORDER BY job_count DESC, company_name) AS p FROM ({_EMPLOYERS}))""",
    "city_employers": f"""
        SELECT city, state, count(*) AS job_count, count(DISTINCT company_name) AS hiring_companies,
               {pct('count(*)', 'sum(count(*)) OVER ()')} AS share_of_specific_city_jobs_pct
        FROM je WHERE {_CITY} GROUP BY 1, 2""",
    "employer_breadth": f"""
        SELECT company_name, count(*) AS job_count, count(DISTINCT role_family) AS role_families,
               count(DISTINCT city) FILTER (WHERE {_CITY}) AS specific_cities
        FROM je WHERE {_KNOWN} GROUP BY 1""",
    "mode_mix": _mix("jobs", "work_mode"),
    "band_mix": _mix("jobs", "experience_band"),
    "band_by_role": _mix("jobs", "role_family, experience_band", "role_experience_share_pct", by="role_family"),
    "band_reindexed": f"""
        SELECT l.experience_band, CAST(l.o AS INTEGER) AS label_order, count(j.job_id) AS job_count,
               {pct('count(j.job_id)', _ALL_N)} AS pct_of_all_jobs,
               CASE WHEN l.experience_band <> 'Not Specified' THEN
                   {pct('count(j.job_id)', "(SELECT count(*) FROM jobs WHERE experience_band <> 'Not Specified')")}
               END AS pct_of_labeled_jobs
        FROM (VALUES ('0–1', 1), ('1–2', 2), ('2–3', 3), ('3–4', 4), ('4–5', 5), ('5–6', 6), ('6–7', 7), ('7–8', 8),
                     ('8–9', 9), ('9–10', 10), ('10–15', 11), ('15+', 12), ('Not Specified', 13)) l(experience_band, o)
        LEFT JOIN jobs j ON j.experience_band = l.experience_band GROUP BY 1, 2""",
    "monthly_counts": "SELECT posted_month, count(*) AS job_count FROM jobs GROUP BY 1",
    "tag_demand": f"""
        SELECT *, {pct('job_count', _ALL_N)} AS share_of_all_jobs_pct,
               {pct('job_count', _TAG_N)} AS share_of_skill_tagged_jobs_pct,
               CAST(dense_rank() OVER (ORDER BY job_count DESC) AS INTEGER) AS skill_demand_rank FROM ({_TAGS})""",
    "tag_coverage": f"SELECT *, {pct('job_count', _ALL_N)} AS share_pct FROM ({_TAGS})",
    "tag_demand_recent": f"""
        SELECT skill, skill_category, count(*) AS job_count,
               {pct('count(*)', '(SELECT count(*) FROM jobs WHERE is_recent_90d)')} AS recent_job_share_pct
        FROM br JOIN jobs USING (job_id) WHERE is_recent_90d GROUP BY 1, 2""",
    "tag_pairs": "SELECT skill_1, skill_2, n AS jobs_with_pair FROM pairs ORDER BY n DESC, skill_1, skill_2 LIMIT 50",
    "tag_pairs_all": "SELECT skill_1, skill_2, n AS jobs_with_pair FROM pairs",
    "tag_pair_rate": f"""
        SELECT a.skill AS skill_1, b.skill AS skill_2, count(*) AS pair_jobs, any_value(c.n) AS skill_1_jobs,
               {pct('count(*)', 'any_value(c.n)')} AS cooccurrence_rate_pct
        FROM br a JOIN br b ON a.job_id = b.job_id AND a.skill <> b.skill
        JOIN (SELECT skill, count(*) AS n FROM br GROUP BY 1) c ON c.skill = a.skill
        GROUP BY 1, 2 ORDER BY pair_jobs DESC, 1, 2 LIMIT 50""",
    "tag_sets": "SELECT job_id, string_agg(skill, '|' ORDER BY skill) AS tags FROM br GROUP BY 1",
    "jobs_with_tag": f"SELECT job_id, role_family FROM jobs WHERE job_id IN (SELECT job_id FROM br WHERE skill = '{b.BRAND}')",
    "jobs_without_tag": f"""SELECT job_id, role_family FROM jobs
        WHERE job_id NOT IN (SELECT job_id FROM br WHERE skill = '{b.BRAND}')""",
    "role_period_mix": _mix("periods", "market_period, role_family", by="market_period"),
    "role_shift": f"""
        SELECT role_family, {r2('r', 6)} AS recent_share_pct, {r2('e', 6)} AS pre_share_pct,
               {r2('r - e', 6)} AS share_change_pp
        FROM (SELECT coalesce(a.role_family, b.role_family) AS role_family, coalesce(a.p, 0) AS r, coalesce(b.p, 0) AS e
              FROM (SELECT role_family, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS p FROM jobs
                    WHERE is_recent_90d GROUP BY 1) a
              FULL JOIN (SELECT role_family, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS p FROM jobs
                    WHERE NOT is_recent_90d GROUP BY 1) b USING (role_family))""",
    "tag_period_mix": f"""
        SELECT market_period, skill, count(*) AS skill_jobs, any_value(period_jobs) AS period_jobs,
               {pct('count(*)', 'any_value(period_jobs)')} AS skill_share_pct
        FROM periods JOIN br USING (job_id)
        JOIN (SELECT market_period, count(*) AS period_jobs FROM periods GROUP BY 1) USING (market_period)
        GROUP BY 1, 2""",
    "period_ranges": """SELECT market_period, min(posted_date) AS first_date, max(posted_date) AS last_date,
        count(*) AS job_count FROM periods GROUP BY 1""",
    "top_cities": f"""SELECT * FROM ({_rank(f"SELECT city, count(*) AS job_count FROM je WHERE {_CITY} GROUP BY 1",
                                            'city_rank')}) WHERE city_rank <= 10""",
    "top_companies": f"""SELECT * FROM ({_rank("SELECT company_name, count(*) AS job_count FROM je GROUP BY 1",
                                               'company_rank')}) WHERE company_rank <= 15""",
    "top_tags": f"""SELECT *, skill_jobs::DOUBLE / {_ALL_N} AS skill_share FROM (
        {_rank("SELECT skill, count(*) AS skill_jobs FROM br GROUP BY 1", 'skill_rank', 'skill_jobs')})
        WHERE skill_rank <= 15""",
    "tag_period_shares": _change(_wide_period("")),
    "tag_period_shares_top": f"""SELECT * EXCLUDE (d) FROM (
        SELECT *, dense_rank() OVER (ORDER BY skill_jobs DESC) AS d FROM ({_change(_wide_period(""))})) WHERE d <= 10""",
    "top_pairs": f"""
        SELECT skill_1 || ' + ' || skill_2 AS skill_pair, n AS pair_jobs, pair_rank,
               n::DOUBLE / {_TAG_N} AS share_of_tagged_jobs
        FROM ({_rank("SELECT * FROM pairs", 'pair_rank', 'n')}) WHERE pair_rank <= 10""",
}
ORACLES = {name: with_ctes(sql) for name, sql in _SQL.items()}
_FILTERED = {
    "jobs": f"""{CTES["jobs"]} WHERE role_family IN ('1-URGENT', '2-HIGH')
        AND posted_date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'""",
    "br": f"SELECT * FROM ({CTES['br']}) WHERE job_id IN (SELECT job_id FROM jobs)",
}
ORACLES |= {f"{name}_filtered": with_ctes(_SQL[name], _FILTERED) for name in ("top_tags", "tag_demand", "top_pairs")}
