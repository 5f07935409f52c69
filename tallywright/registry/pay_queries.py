"""Pay statistics, comparisons, histograms, bootstrap and measures over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.functions.text import disclosure_status, round_money, round_to
from tallywright.operators.bootstrap import bootstrap_diff, bootstrap_differences, rank_bounds
from tallywright.operators.shares import histogram
from tallywright.plans import cube, demand, kpi, pay, reports
from tallywright.registry.base_sql import m2, pct, r2, with_ctes
from tallywright.registry.demand_queries import _both, _jobs, _placed, full_jobs
from tallywright.sources import bindings as b

def _slicers():
    """Date range, role list and place scope, as a report page would set them."""
    return [
        F.col("posted_date").between(F.lit("1996-01-01").cast("date"), F.lit("2000-06-30").cast("date")),
        F.col("role_family").isin("1-URGENT", "2-HIGH"),
        F.col("location_scope") == "Specific City",
    ]


def _flagged(spark, root):
    return pay.tag_flagged(b.jobs(spark, root), b.bridge(spark, root), b.BRAND)


def _rounded(df):
    return df.withColumns({c: round_to(c, 6) for c, t in df.dtypes if t == "double"})


def _kpi(spark, root, filters=(), by=None):
    return _rounded(kpi.kpis(full_jobs(spark, root), b.bridge(spark, root), filters, by, b.BRAND))


SLICERS = ("role_family", "work_mode", "location_scope")


def _cube(spark, root, filters=(), sets=None):
    cells = cube.store_cells(full_jobs(spark, root), b.bridge(spark, root), SLICERS, b.BRAND)
    return _rounded(cube.measures(cells, filters, cube.all_sets(SLICERS) if sets is None else sets))


def _selection():
    """Two roles and every scope but one, as a report page would select them."""
    return [F.col("role_family").isin("1-URGENT", "2-HIGH"), F.col("location_scope") != "Unknown"]


def _bootstrap(spark, root):
    """The interval's ends are draws: what must hold of them is checked, the observed numbers are compared."""
    rows = _flagged(spark, root)
    found = bootstrap_diff(rows, "has_tag", "salary_midpoint")
    bounds = rank_bounds(rows, "has_tag", "salary_midpoint").agg(F.struct(F.max("low").alias("low"), F.max("high").alias("high"))).scalar()
    low, high = F.col("ci_low"), F.col("ci_high")
    return found.select(
        "iterations", *[round_money(x.alias(n)).alias(n) for n, x in (("observed_difference", F.col("observed_difference")), ("least_difference", bounds["low"]), ("largest_difference", bounds["high"]))],
        (low < high).alias("ends_ordered"), ((low >= bounds["low"]) & (high <= bounds["high"])).alias("ends_within"),
        (F.col("includes_zero") == ((low <= 0) & (high >= 0))).alias("zero_agrees"),
    )


def _findings(spark, root):
    """All lines; of those that depend on draws, whether they have their form."""
    lines = reports.findings(full_jobs(spark, root), b.bridge(spark, root), b.BRAND)
    value = F.col("value")
    drawn = F.when(F.col("metric").isin("ci_low", "ci_high"), value.rlike("^₹-?[0-9]+[.][0-9]{2}L$")).when(F.col("metric") == "bootstrap_conclusion", value.rlike("interval (in|ex)cludes zero|Interval excludes zero"))
    return lines.select("metric", F.when(drawn.isNotNull(), drawn.cast("string")).otherwise(value).alias("value"))


QUERIES = {
    "value_distribution": _jobs(pay.value_distribution),
    "value_by_role": _jobs(pay.value_by_role),
    "value_by_role_all": _jobs(lambda j: pay.value_by_role(j, min_n=1)),
    "value_by_city": _placed(pay.value_by_city),
    "value_by_band": _jobs(pay.value_by_band),
    "quartiles_by_role": _jobs(lambda j: pay.quartiles_by(j, ["role_family"])),
    "quartiles_by_city": _placed(lambda j: pay.quartiles_by(j, ["city"], 1, demand.specific_city())),
    "quartiles_by_band": _jobs(lambda j: pay.quartiles_by(j, ["experience_band"])),
    "quartiles_by_employer": _placed(lambda j: pay.quartiles_by(j, ["company_name"])),
    "sample_by_role": _jobs(lambda j: pay.sample_by(j, ["role_family"])),
    "sample_by_city": _placed(lambda j: pay.sample_by(j, ["city", "state"], demand.specific_city())),
    "sample_by_band": _jobs(lambda j: pay.sample_by(j, ["experience_band"])),
    "sample_by_tag": _both(pay.sample_by_tag),
    "value_by_tag": _both(pay.value_by_tag),
    "tag_vs_rest": _both(lambda j, t: pay.tag_vs_rest(j, t, b.BRAND)),
    "tag_vs_rest_diff": _both(lambda j, t: pay.tag_vs_rest_diff(j, t, b.BRAND)),
    "disclosure_mix": _jobs(lambda j: demand.label_mix(
        j.withColumn("disclosure", disclosure_status(F.col("has_salary_source"), F.col("salary_analysis_eligible"))),
        "disclosure")),
    "histogram": _jobs(lambda j: histogram(pay.eligible(j), "salary_midpoint", 18).withColumns({
        c: round_to(c, 4) for c in ("bin_low", "bin_high")})),
    "bootstrap_diff": _bootstrap,
    "bootstrap_histogram": lambda s, r: histogram(
        bootstrap_differences(_flagged(s, r), "has_tag", "salary_midpoint")[0], "difference", 40).agg(
            F.count(F.lit(1)).alias("bins"), F.sum("row_count").alias("iterations"), F.bool_and(F.expr("bin_low < bin_high")).alias("ordered")),
    "findings": _findings,
    "kpis": lambda s, r: _kpi(s, r),
    "kpis_filtered": lambda s, r: _kpi(s, r, _slicers()),
    "kpis_by_mode": lambda s, r: _kpi(s, r, (), "work_mode"),
    "kpis_cube": lambda s, r: _cube(s, r),
    "kpis_cube_filtered": lambda s, r: _cube(s, r, _selection(), [(), ("work_mode",), ("role_family", "location_scope")]),
}


def _stats(table: str, keys: str, having: str = "", where: str = "salary_analysis_eligible") -> str:
    return f"""
        SELECT {keys}, count(*) AS salary_n, {m2('quantile_cont(salary_midpoint, 0.5)')} AS median_salary_inr,
               {m2('avg(salary_midpoint)')} AS mean_salary_inr
        FROM {table} WHERE {where} GROUP BY {keys} {having}"""


def _quartiles(table: str, key: str, where: str = "salary_analysis_eligible") -> str:
    return f"""SELECT {key}, count(*) AS salary_n, {m2('quantile_cont(salary_midpoint, 0.25)')} AS p25,
        {m2('quantile_cont(salary_midpoint, 0.5)')} AS median, {m2('quantile_cont(salary_midpoint, 0.75)')} AS p75
        FROM {table} WHERE {where} GROUP BY 1"""


def _sample(table: str, keys: str, where: str = "true") -> str:
    return f"""SELECT {keys}, count(*) FILTER (WHERE salary_analysis_eligible) AS salary_n
        FROM {table} WHERE {where} GROUP BY {keys}"""


_CITY = "location_scope = 'Specific City'"
_EXTRA = {
    "flagged": f"""
        SELECT j.*, EXISTS (SELECT 1 FROM br WHERE br.job_id = j.job_id AND br.skill = '{b.BRAND}') AS has_tag
        FROM jobs j WHERE salary_analysis_eligible""",
    "kj": f"""
        SELECT je2.*, EXISTS (SELECT 1 FROM br WHERE br.job_id = je2.job_id AND br.skill = '{b.BRAND}') AS has_tag
        FROM je2""",
}


def _kpi_sql(where: str = "true", by: str = "") -> str:
    keys = f"{by}," if by else ""
    same = " ".join(f"AND {c} IS NOT DISTINCT FROM g.{c}" for c in by.split(", ")) if by else ""
    elig = "salary_analysis_eligible"
    q = lambda p, cond="true": f"quantile_cont(salary_midpoint, {p}) FILTER (WHERE {elig} AND {cond}) / 100000"
    n = "count(*)"
    top = f"""(SELECT sum(c) FROM (SELECT company_name, count(*) AS c FROM kj WHERE {where}
               AND company_name <> 'Unknown Company' {same} GROUP BY 1 ORDER BY c DESC, company_name LIMIT 5))"""
    tags = f"FROM br JOIN kj USING (job_id) WHERE {where} {same}"
    ratio = lambda x: r2(f"({x})::DOUBLE / {n}", 6)
    e_n = f"count(*) FILTER (WHERE {elig})"
    t_n = f"count(*) FILTER (WHERE {elig} AND has_tag)"
    cols = {
        "analytical_vacancies": n,
        "unique_companies": "count(DISTINCT company_name) FILTER (WHERE company_name <> 'Unknown Company')",
        "unique_specific_cities": f"count(DISTINCT city) FILTER (WHERE {_CITY})",
        "skill_tagged_jobs": "count(*) FILTER (WHERE has_extracted_skill)",
        "experience_labeled_jobs": "count(experience_min_years)",
        "salary_observations": e_n,
        "specific_city_vacancies": f"count(*) FILTER (WHERE {_CITY})",
        "mean_salary_lakh": r2(f"avg(salary_midpoint) FILTER (WHERE {elig}) / 100000", 6),
        "minimum_salary_lakh": r2(f"min(salary_midpoint) FILTER (WHERE {elig}) / 100000", 6),
        "maximum_salary_lakh": r2(f"max(salary_midpoint) FILTER (WHERE {elig}) / 100000", 6),
        "other_role_jobs": "count(*) FILTER (WHERE role_family = 'Other Analyst')",
        "recent_90d_jobs": "count(*) FILTER (WHERE is_recent_90d)",
        "pre_90d_jobs": "count(*) FILTER (WHERE NOT is_recent_90d)",
        "complete_week_jobs": "count(*) FILTER (WHERE is_complete_week)",
        "complete_weeks": "count(DISTINCT week_start) FILTER (WHERE is_complete_week)",
        "top_5_employer_jobs": f"CAST({top} AS BIGINT)",
        "job_skill_rows": f"(SELECT count(*) {tags})",
        "unique_skills": f"(SELECT count(DISTINCT skill) {tags})",
        "tag_salary_observations": t_n,
        "rest_salary_observations": f"{e_n} - {t_n}",
        "median_salary_lakh": r2(q(0.5), 6), "p25_salary_lakh": r2(q(0.25), 6), "p75_salary_lakh": r2(q(0.75), 6),
        "median_salary_n30_lakh": f"CASE WHEN {e_n} >= 30 THEN {r2(q(0.5), 6)} END",
        "median_salary_n20_lakh": f"CASE WHEN {e_n} >= 20 THEN {r2(q(0.5), 6)} END",
        "skill_coverage": ratio("count(*) FILTER (WHERE has_extracted_skill)"),
        "experience_coverage": ratio("count(experience_min_years)"),
        "salary_coverage": ratio(e_n),
        "top_5_employer_share": ratio(top),
        "other_role_share": ratio("count(*) FILTER (WHERE role_family = 'Other Analyst')"),
        "tag_median_lakh": r2(q(0.5, "has_tag"), 6), "rest_median_lakh": r2(q(0.5, "NOT has_tag"), 6),
        "tag_median_difference_lakh": r2(f"({q(0.5, 'has_tag')}) - ({q(0.5, 'NOT has_tag')})", 6),
    }
    group = f"GROUP BY {by}" if by else ""
    return f"SELECT {keys} {', '.join(f'{x} AS {c}' for c, x in cols.items())} FROM kj g WHERE {where} {group}"


def _cube_sql(sets, where: str = "true") -> str:
    """One grouping after another, the slicers outside of it null."""
    parts = []
    for kept in sets:
        level = sum((c not in kept) << (len(SLICERS) - 1 - i) for i, c in enumerate(SLICERS))
        labels = ", ".join(f"{c if c in kept else 'NULL::VARCHAR'} AS {c}" for c in SLICERS)
        rest = f"EXCLUDE ({', '.join(kept)})" if kept else ""
        parts.append(f"SELECT {level}::BIGINT AS rolled_up, {labels}, * {rest} FROM ({_kpi_sql(where, ', '.join(kept))})")
    return " UNION ALL BY NAME ".join(parts)


_SQL = {
    "value_distribution": f"""
        SELECT count(*) AS salary_n, {m2('quantile_cont(salary_midpoint, 0.25)')} AS salary_p25_inr,
               {m2('quantile_cont(salary_midpoint, 0.5)')} AS median_salary_inr,
               {m2('avg(salary_midpoint)')} AS mean_salary_inr,
               {m2('quantile_cont(salary_midpoint, 0.75)')} AS salary_p75_inr,
               {m2('min(salary_midpoint)')} AS minimum_salary_inr, {m2('max(salary_midpoint)')} AS maximum_salary_inr,
               count(*) FILTER (WHERE salary_midpoint >= 3000000) AS jobs_at_or_above_30_lakh
        FROM jobs WHERE salary_analysis_eligible""",
    "value_by_role": _stats("jobs", "role_family", "HAVING count(*) >= 30"),
    "value_by_role_all": _stats("jobs", "role_family"),
    "value_by_city": _stats("je", "city, state", "HAVING count(*) >= 30", f"salary_analysis_eligible AND {_CITY}"),
    "value_by_band": _stats("jobs", "experience_band", "HAVING count(*) >= 20",
                            "salary_analysis_eligible AND experience_band <> 'Not Specified'"),
    "quartiles_by_role": _quartiles("jobs", "role_family"),
    "quartiles_by_city": _quartiles("je", "city", f"salary_analysis_eligible AND {_CITY}"),
    "quartiles_by_band": _quartiles("jobs", "experience_band"),
    "quartiles_by_employer": _quartiles("je", "company_name"),
    "sample_by_role": _sample("jobs", "role_family"),
    "sample_by_city": _sample("je", "city, state", _CITY),
    "sample_by_band": _sample("jobs", "experience_band"),
    "sample_by_tag": _sample("br JOIN jobs USING (job_id)", "skill"),
    "value_by_tag": f"""
        WITH t AS (SELECT skill, count(*) AS salary_n, quantile_cont(salary_midpoint, 0.5) AS m, avg(salary_midpoint) AS a
                   FROM br JOIN jobs USING (job_id) WHERE salary_analysis_eligible GROUP BY 1 HAVING count(*) >= 10),
             o AS (SELECT quantile_cont(salary_midpoint, 0.5) AS m FROM jobs WHERE salary_analysis_eligible)
        SELECT skill, salary_n, {m2('t.m')} AS median_salary_inr, {m2('t.a')} AS mean_salary_inr,
               {pct('t.m - o.m', 'o.m')} AS median_difference_vs_overall_pct FROM t, o""",
    "tag_vs_rest": f"""
        SELECT CASE WHEN has_tag THEN '{b.BRAND}' ELSE 'Non-{b.BRAND}' END AS skill_group, count(*) AS salary_n,
               {m2('quantile_cont(salary_midpoint, 0.5)')} AS median_salary_inr,
               {m2('avg(salary_midpoint)')} AS mean_salary_inr FROM flagged GROUP BY 1""",
    "tag_vs_rest_diff": f"""
        SELECT {m2('a')} AS tag_median_inr, {m2('b')} AS rest_median_inr, {m2('a - b')} AS observed_median_difference_inr
        FROM (SELECT quantile_cont(salary_midpoint, 0.5) FILTER (WHERE has_tag) AS a,
                     quantile_cont(salary_midpoint, 0.5) FILTER (WHERE NOT has_tag) AS b FROM flagged)""",
    "disclosure_mix": f"""
        SELECT CASE WHEN NOT has_salary_source THEN 'No Source Salary' WHEN salary_analysis_eligible THEN 'Analysis Eligible'
                    ELSE 'Source Salary - Excluded' END AS disclosure, count(*) AS job_count,
               {pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct FROM jobs GROUP BY 1""",
    "histogram": f"""
        WITH v AS (SELECT salary_midpoint AS x FROM jobs WHERE salary_analysis_eligible),
             s AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
             c AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * 18) AS BIGINT), 17) AS bin, count(*) AS n FROM v, s GROUP BY 1)
        SELECT CAST(i AS BIGINT) AS bin, {r2('lo + i * ((hi - lo) / 18)', 4)} AS bin_low,
               {r2('lo + (i + 1) * ((hi - lo) / 18)', 4)} AS bin_high, coalesce(c.n, 0) AS row_count
        FROM range(18) r(i) CROSS JOIN s LEFT JOIN c ON c.bin = r.i""",
    "kpis": _kpi_sql(),
    "kpis_filtered": _kpi_sql("""posted_date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'
        AND role_family IN ('1-URGENT', '2-HIGH') AND location_scope = 'Specific City'"""),
    "kpis_by_mode": _kpi_sql(by="work_mode"),
    "kpis_cube": _cube_sql(cube.all_sets(SLICERS)),
    "kpis_cube_filtered": _cube_sql(
        [(), ("work_mode",), ("role_family", "location_scope")],
        "role_family IN ('1-URGENT', '2-HIGH') AND location_scope <> 'Unknown'"),
}


def _merge(sql: str) -> str:
    """Join a query's own leading WITH to the common expressions."""
    text = with_ctes(sql, _EXTRA)
    head, found, tail = text.partition("\nWITH ")
    return f"{head},\n{tail}" if found else text


_RANK = lambda side, sign: (
    f"(SELECT v[1 + CAST(CASE WHEN {sign} < 0 THEN greatest(0, floor((len(v) - 1) / 2 - 3 * sqrt(len(v)))) ELSE least(len(v) - 1, ceil((len(v) - 1) / 2 + 3 * sqrt(len(v)))) END AS BIGINT)]"
    f" FROM (SELECT list(salary_midpoint ORDER BY salary_midpoint) AS v FROM flagged WHERE {side}))")
_GAP = "(SELECT quantile_cont(salary_midpoint, 0.5) FILTER (WHERE has_tag) - quantile_cont(salary_midpoint, 0.5) FILTER (WHERE NOT has_tag) FROM flagged)"
_LAKH = lambda x: f"printf('₹%.2fL', ({x}) / 100000.0)"
_OF = lambda x: f"(SELECT {m2(x)} FROM jobs WHERE salary_analysis_eligible)"
_TOP = lambda label, table, where="true": (
    f"(SELECT {label} || ' (' || n || ' postings)' FROM (SELECT {label}, count(*) AS n FROM {table} WHERE {where} GROUP BY {label} ORDER BY n DESC, {label} LIMIT 1))")
_FINDINGS = {
    "top_role_family": _TOP("role_family", "jobs"), "top_skill": _TOP("skill", "br"), "top_specific_city": _TOP("city", "je", _CITY),
    "salary_observations": "(SELECT CAST(count(*) AS VARCHAR) FROM jobs WHERE salary_analysis_eligible)",
    "median_salary": _LAKH(_OF("quantile_cont(salary_midpoint, 0.5)")), "mean_salary": _LAKH(_OF("avg(salary_midpoint)")),
    "minimum_salary": _LAKH(_OF("min(salary_midpoint)")), "maximum_salary": _LAKH(_OF("max(salary_midpoint)")),
    "observed_difference": _LAKH(_GAP), "ci_low": "'true'", "ci_high": "'true'", "bootstrap_conclusion": "'true'",
}
_SQL |= {
    "bootstrap_diff": f"""
        SELECT 50000::BIGINT AS iterations, {m2(_GAP)} AS observed_difference, {m2(f"{_RANK('has_tag', -1)} - {_RANK('NOT has_tag', 1)}")} AS least_difference,
            {m2(f"{_RANK('has_tag', 1)} - {_RANK('NOT has_tag', -1)}")} AS largest_difference, true AS ends_ordered, true AS ends_within, true AS zero_agrees""",
    "bootstrap_histogram": "SELECT 40::BIGINT AS bins, 50000::BIGINT AS iterations, true AS ordered",
    "findings": " UNION ALL ".join(f"SELECT '{k}' AS metric, {v} AS value" for k, v in _FINDINGS.items()),
}
ORACLES = {name: _merge(sql.strip()) for name, sql in _SQL.items()}
