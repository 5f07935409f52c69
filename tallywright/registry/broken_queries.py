"""Data-quality reports over rows that break every rule.

The broken tables are derived from the order tables by key arithmetic, in SQL that both Spark and DuckDB read, so that
each rule counts a different number of rows and its count is compared.
"""

from __future__ import annotations

from tallywright.functions import fixed
from tallywright.plans import reports
from tallywright.plans.star import Star, star_report
from tallywright.sources import bindings as b

_JOBS = f"""
SELECT CAST(k - CASE WHEN k % 23 = 1 THEN 1 ELSE 0 END AS VARCHAR(20)) AS job_id, day AS posted_date,
    CASE WHEN k % 31 = 0 THEN 'Test' WHEN k % 31 = 1 THEN 'Acme Ltd' WHEN k % 31 = 2 THEN 'ACME-LTD' ELSE '{fixed.UNKNOWN_COMPANY}' END AS company_name,
    CASE WHEN k % 7 = 0 THEN 'x' WHEN k % 7 = 1 THEN '{fixed.BAND_ABOVE}' ELSE '{fixed.NOT_SPECIFIED}' END AS experience_band,
    CASE WHEN k % 5 = 0 THEN CAST(k % 20 - 1 AS DOUBLE) END AS experience_min_years, CASE WHEN k % 5 = 0 THEN CAST(k % 9 AS DOUBLE) END AS experience_max_years,
    CASE WHEN k % 11 = 0 THEN 'India' WHEN k % 11 = 1 THEN '{fixed.CITY_NOT_SPECIFIED}' ELSE 'Pune' END AS city,
    CASE WHEN k % 2 = 0 THEN '{fixed.SCOPE_COUNTRY}' ELSE 'Specific City' END AS location_scope,
    k % 3 > 0 AS salary_analysis_eligible, CASE WHEN k % 13 > 0 THEN CAST(k % 17 - 1 AS DOUBLE) END AS salary_min,
    CAST(k % 19 AS DOUBLE) AS salary_max, (k % 17 - 1 + k % 19) / 2.0E0 + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS salary_midpoint,
    CASE k % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'maybe' WHEN 2 THEN 'false' END AS salary_is_predicted,
    k % 29 - 1 AS skill_count, CASE WHEN k % 47 > 0 THEN role END AS role_family,
    CAST(date_trunc('week', day) AS DATE) + CAST(k % 8 - k % 7 AS INTEGER) AS week_start, k % 3 = 0 AS is_complete_week, k % 41 = 0 AS is_recent_90d
FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_orderpriority AS role FROM orders)"""
_BRIDGE = "SELECT CAST(l_orderkey + CASE WHEN l_linenumber = 5 THEN 100000000 ELSE 0 END AS VARCHAR(20)) AS job_id, CAST(l_partkey % 50 AS VARCHAR(20)) AS skill FROM lineitem"

#: Per star table, the columns that its constraints read.
_STAR = {
    "dim_role": "SELECT role_family, least(CAST(substr(role_family, 1, 1) AS BIGINT), 4) AS role_key FROM (SELECT DISTINCT o_orderpriority AS role_family FROM orders)",
    "dim_company": "SELECT c_custkey % 140 AS company_key, c_name AS company_name FROM customer",
    "dim_location": "SELECT n_nationkey % 20 AS location_key, n_name AS city FROM nation",
    "dim_date": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_key, CAST(month(o_orderdate) + CASE WHEN day(o_orderdate) = 3 THEN 12 ELSE 0 END AS INTEGER) AS calendar_month,
        CAST(day(o_orderdate) % 8 AS INTEGER) AS day_of_week FROM orders WHERE o_orderkey % 3 > 0""",
    "dim_skill": "SELECT p_brand AS skill, CAST(substr(p_brand, 7) AS BIGINT) % 20 AS skill_key FROM (SELECT DISTINCT p_brand FROM part)",
    "fact_jobs": """SELECT k % 1000000 - CASE WHEN k % 37 = 1 THEN 1 ELSE 0 END AS job_key, CAST(k - CASE WHEN k % 41 = 1 THEN 1 ELSE 0 END AS VARCHAR(20)) AS job_id,
        k % 6 AS role_key, o_custkey % 150 AS company_key, k % 25 AS location_key, CAST(o_orderdate AS DATE) AS date_key,
        CASE WHEN k % 13 > 0 THEN CAST(k % 17 - 1 AS DOUBLE) END AS salary_min, CAST(k % 19 AS DOUBLE) AS salary_max, CAST(k % 19 AS DOUBLE) AS salary_midpoint,
        CAST(k % 20 - 1 AS DOUBLE) AS experience_min_years, CAST(k % 9 AS DOUBLE) AS experience_max_years, k % 3 > 0 AS salary_analysis_eligible,
        k % 29 - 1 AS skill_count, CASE WHEN k % 43 > 0 THEN 'title' END AS title FROM (SELECT *, o_orderkey AS k FROM orders)""",
    "bridge_job_skill": "SELECT (l_orderkey + CASE WHEN l_linenumber = 5 THEN 100000000 ELSE 0 END) % 200000000 AS job_key, l_partkey % 30 AS skill_key FROM lineitem",
}


def _frame(spark, root, sql: str):
    """Spark runs ``sql`` over the tables it names, by views of its own."""
    for name in ("orders", "customer", "nation", "part", "lineitem"):
        b.table(spark, root, name).createOrReplaceTempView(f"broken_{name}")
        sql = sql.replace(f"FROM {name}", f"FROM broken_{name}")
    return spark.sql(sql)


def _quality(spark, root):
    return reports.quality_report(_frame(spark, root, _JOBS), _frame(spark, root, _BRIDGE), b.ORDERS_END, expected_rows=1000)


def _star(spark, root):
    return star_report(Star(**{name: _frame(spark, root, sql) for name, sql in _STAR.items()}), {"fact_jobs": 1000, "dim_role": 5})


QUERIES = {"quality_report_broken": _quality, "star_report_broken": _star}


def _count(bad: str, table: str) -> str:
    return f"SELECT count(*) FILTER (WHERE coalesce({bad}, false)) FROM {table}"


def _repeated(keys: str, table: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


def _orphans(child: str, parent: str, key: str) -> str:
    return f"SELECT count(*) FROM {child} WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = {child}.{key})"


_ELIGIBLE = "salary_analysis_eligible AND "
_TRUE, _FALSE = (", ".join(f"'{x}'" for x in own) for own in (fixed.TRUE_TEXTS, fixed.FALSE_TEXTS))
_MONDAY = "(SELECT min(posted_date) + CAST((8 - isodow(min(posted_date))) % 7 AS INTEGER) FROM jobs)"
_COMPLETE = f"(week_start >= {_MONDAY} AND week_start + 6 <= (SELECT max(posted_date) FROM jobs))"
_QUALITY_SQL = {
    "placeholder_names": _count("lower(company_name) = 'test'", "jobs"),
    "band_without_years": _count(f"(experience_min_years IS NULL) <> (experience_band = '{fixed.NOT_SPECIFIED}')", "jobs"),
    "top_band_too_low": _count(f"experience_band = '{fixed.BAND_ABOVE}' AND experience_min_years < 15", "jobs"),
    "city_is_country": _count("city = 'India'", "jobs"),
    "country_scope": _count(f"city = '{fixed.CITY_NOT_SPECIFIED}' AND location_scope <> '{fixed.SCOPE_COUNTRY}'", "jobs"),
    "eligible_pay_missing": _count(_ELIGIBLE + "(salary_min IS NULL OR salary_max IS NULL OR salary_midpoint IS NULL)", "jobs"),
    "eligible_pay_not_positive": _count(_ELIGIBLE + "(salary_min <= 0 OR salary_max <= 0)", "jobs"),
    "eligible_pay_unordered": _count(_ELIGIBLE + "salary_max < salary_min", "jobs"),
    "eligible_pay_midpoint": _count(_ELIGIBLE + "abs(salary_midpoint - (salary_min + salary_max) / 2) > 0.01", "jobs"),
    "eligible_but_predicted": _count(_ELIGIBLE + f"lower(salary_is_predicted) IN ({_TRUE})", "jobs"),
    "unexpected_boolean_text": _count(f"lower(salary_is_predicted) NOT IN ({_TRUE}, {_FALSE})", "jobs"),
    "week_not_monday": _count("is_complete_week AND isodow(week_start) <> 1", "jobs"),
    "years_range": _count("experience_min_years < 0 OR experience_max_years < experience_min_years", "jobs"),
    "negative_skill_count": _count("skill_count < 0", "jobs"),
    "repeated_job_ids": _repeated("job_id", "jobs"),
    "repeated_job_skill_pairs": _repeated("job_id, skill", "bridge"),
    "bridge_without_job": _orphans("bridge", "jobs", "job_id"),
    "employer_spellings": _repeated("regexp_replace(lower(company_name), '[^a-z0-9]+', '', 'g')", f"(SELECT DISTINCT company_name FROM jobs WHERE company_name <> '{fixed.UNKNOWN_COMPANY}')"),
    "recent_flag": _count("is_recent_90d <> (posted_date >= DATE '2001-08-01' - 89)", "jobs"),
    "complete_week_flag": _count(f"is_complete_week IS DISTINCT FROM {_COMPLETE}", "jobs"),
    "role_totals_difference": "SELECT abs((SELECT count(*) FROM jobs) - (SELECT sum(n) FROM (SELECT count(*) AS n FROM jobs WHERE role_family IS NOT NULL GROUP BY role_family)))",
    "row_count_difference": "SELECT abs(count(*) - 1000) FROM jobs",
}
_STAR_SQL = {
    "role_key_unique": _repeated("role_key", "dim_role"), "company_key_unique": _repeated("company_key", "dim_company"),
    "location_key_unique": _repeated("location_key", "dim_location"), "skill_key_unique": _repeated("skill_key", "dim_skill"),
    "job_key_unique": _repeated("job_key", "fact_jobs"), "job_id_unique": _repeated("job_id", "fact_jobs"),
    "bridge_unique": _repeated("job_key, skill_key", "bridge_job_skill"),
    "role_parent": _orphans("fact_jobs", "dim_role", "role_key"), "company_parent": _orphans("fact_jobs", "dim_company", "company_key"),
    "location_parent": _orphans("fact_jobs", "dim_location", "location_key"), "date_parent": _orphans("fact_jobs", "dim_date", "date_key"),
    "bridge_job_parent": _orphans("bridge_job_skill", "fact_jobs", "job_key"), "bridge_skill_parent": _orphans("bridge_job_skill", "dim_skill", "skill_key"),
    "years_negative": _count("experience_min_years < 0 OR experience_max_years < 0", "fact_jobs"),
    "years_unordered": _count("experience_max_years < experience_min_years", "fact_jobs"),
    "pay_not_positive": _count("salary_min <= 0 OR salary_max <= 0", "fact_jobs"), "pay_unordered": _count("salary_max < salary_min", "fact_jobs"),
    "eligible_pay_missing": _count(_ELIGIBLE + "(salary_min IS NULL OR salary_max IS NULL OR salary_midpoint IS NULL)", "fact_jobs"),
    "skill_count_negative": _count("skill_count < 0", "fact_jobs"), "title_missing": _count("title IS NULL", "fact_jobs"),
    "month_range": _count("calendar_month NOT BETWEEN 1 AND 12", "dim_date"), "weekday_range": _count("day_of_week NOT BETWEEN 0 AND 6", "dim_date"),
    "rows_of_fact_jobs": "SELECT abs(count(*) - 1000) FROM fact_jobs", "rows_of_dim_role": "SELECT abs(count(*) - 5) FROM dim_role",
}


def _report(tables: dict[str, str], rules: dict[str, str]) -> str:
    head = ", ".join(f"{name} AS ({sql})" for name, sql in tables.items())
    rows = " UNION ALL ".join(f"SELECT '{rule}' AS rule, CAST(({sql}) AS BIGINT) AS failed_rows" for rule, sql in rules.items())
    return f"WITH {head} SELECT rule, failed_rows, failed_rows = 0 AS passed FROM ({rows})"


ORACLES = {"quality_report_broken": _report({"jobs": _JOBS, "bridge": _BRIDGE}, _QUALITY_SQL), "star_report_broken": _report(_STAR, _STAR_SQL)}
