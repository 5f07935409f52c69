"""Common table expressions of the check SQL: the logical tables in DuckDB's dialect."""

from __future__ import annotations

import re

CTES = {
    "j0": """
        SELECT o_orderkey AS job_id, o_custkey AS company_key, o_orderpriority AS role_family,
               o_orderstatus AS work_mode, CAST(o_orderdate AS DATE) AS posted_date,
               strftime(o_orderdate, '%Y-%m') AS posted_month,
               CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
               CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - 89 AS is_recent_90d,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 25000) AS DOUBLE) END
                   AS experience_min_years,
               o_orderstatus <> 'P' AS has_salary_source, o_orderstatus = 'F' AS salary_analysis_eligible,
               o_totalprice AS salary_midpoint,
               CASE o_orderstatus WHEN 'F' THEN 'Annual Scale' WHEN 'O' THEN 'Ambiguous Salary Period' END
                   AS salary_normalization_status,
               CASE o_custkey % 4 WHEN 0 THEN 'adzuna_in'
                    WHEN 1 THEN 'freehire/' || lower(substr(o_orderpriority, 3))
                    WHEN 2 THEN 'freehire/' ELSE 'Board ' || o_orderstatus END AS source
        FROM orders""",
    "span": """
        SELECT min(posted_date) AS lo, max(posted_date) AS hi,
               min(posted_date) + CAST((8 - isodow(min(posted_date))) % 7 AS INTEGER) AS first_monday
        FROM j0""",
    "jobs": """
        SELECT j0.*, week_start >= first_monday AND week_start + 6 <= hi AS is_complete_week,
               CASE WHEN experience_min_years IS NULL THEN 'Not Specified'
                    WHEN experience_min_years < 10
                        THEN CAST(CAST(floor(experience_min_years) AS INTEGER) AS VARCHAR) || '–'
                             || CAST(CAST(floor(experience_min_years) AS INTEGER) + 1 AS VARCHAR)
                    WHEN experience_min_years < 15 THEN '10–15' ELSE '15+' END AS experience_band
        FROM j0, span""",
    "emp": """
        SELECT c_custkey AS company_key,
               CASE WHEN c_custkey % 100 = 0 THEN 'Unknown Company' ELSE c_name END AS company_name,
               n_name AS city, r_name AS state, n_nationkey AS location_key,
               CASE n_nationkey WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Remote India'
                    WHEN 2 THEN 'India - City Not Specified' ELSE 'Specific City' END AS location_scope
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "je": "SELECT * FROM jobs JOIN emp USING (company_key)",
    "br": """
        SELECT DISTINCT l_orderkey AS job_id, p_brand AS skill,
               'Category ' || CAST(CAST(substr(p_brand, 7) AS INTEGER) % 5 AS VARCHAR) AS skill_category
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "tagged": "SELECT DISTINCT job_id FROM br",
    "je2": """
        SELECT je.*, t.job_id IS NOT NULL AS has_extracted_skill FROM je LEFT JOIN tagged t USING (job_id)""",
    "wk": "SELECT week_start, count(*) AS weekly_jobs FROM jobs WHERE is_complete_week GROUP BY 1",
    "wt": """
        SELECT week_start, skill, count(*) AS skill_jobs FROM jobs JOIN br USING (job_id)
        WHERE is_complete_week GROUP BY 1, 2""",
    "pairs": """
        SELECT a.skill AS skill_1, b.skill AS skill_2, count(*) AS n
        FROM br a JOIN br b ON a.job_id = b.job_id AND a.skill < b.skill GROUP BY 1, 2""",
    "grid": """
        SELECT wk.week_start, t.skill, wk.weekly_jobs, coalesce(wt.skill_jobs, 0) AS skill_jobs,
               100.0::DOUBLE * coalesce(wt.skill_jobs, 0) / wk.weekly_jobs AS pct,
               dense_rank() OVER (ORDER BY wk.week_start) - 1 AS week_index
        FROM wk CROSS JOIN (SELECT DISTINCT skill FROM br
                            WHERE skill IN ('Brand#1', 'Brand#7', 'Brand#13', 'Brand#19', 'Brand#25')) t
        LEFT JOIN wt ON wt.week_start = wk.week_start AND wt.skill = t.skill""",
    "periods": """
        SELECT CASE WHEN is_recent_90d THEN 'Recent 90 Days' ELSE 'Pre-90-Day Period' END AS market_period, *
        FROM jobs""",
}


def r2(x: str, digits: int = 2, places: int = 10) -> str:
    """Round half away from zero on a decimal, as double."""
    return f"CAST(round(CAST({x} AS DECIMAL(30,{places})), {digits}) AS DOUBLE)"


def m2(x: str) -> str:
    """``r2`` for amounts of money."""
    return r2(x, places=6)


def pct(num: str, den: str, digits: int = 2) -> str:
    return r2(f"100.0::DOUBLE * ({num}) / nullif(({den})::DOUBLE, 0)", digits)


def _reads(text: str, name: str) -> bool:
    return re.search(rf"\b(?:FROM|JOIN)\s+(?:\w+,\s*)*{name}\b", text) is not None


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put the expressions that ``sql`` reads, and those they read, in front of it."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def place(text: str) -> None:
        for name, body in known.items():
            if name not in order and _reads(text, name):
                place(body)
                if name not in order:
                    order.append(name)

    place(sql)
    head = ",\n".join(f"{name} AS ({known[name].strip()})" for name in order)
    return f"WITH {head}\n{sql.strip()}" if head else sql.strip()
