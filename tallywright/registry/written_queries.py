"""Tables written to the shared folder, read back and aggregated."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.plans import reports
from tallywright.plans.star import Star
from tallywright.registry import clean_queries as cq
from tallywright.registry import demand_queries as dq
from tallywright.registry import star_queries as sq
from tallywright.registry.base_sql import with_ctes
from tallywright.session import shared_folder
from tallywright.sources import bindings as b
from tallywright.sources import postings


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"


def _postings(spark, root):
    """Raw rows as CSV files, with quoted cells that span lines."""
    path = _folder(spark)
    postings.write_table(b.raw_postings(spark, root), path, fmt="csv")
    rows = postings.read_postings(spark, path)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.length("description")).alias("description_chars"), F.count("location_name").alias("places"),
        F.max("created").cast("date").alias("last_day"),
    )


def _clean(spark, root):
    """The clean table by month, and the bridge that is read from it."""
    path = _folder(spark)
    postings.write_clean(cq.jobs(spark, root), path)
    jobs, bridge = postings.read_clean(spark, path)
    tags = bridge.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"))
    return jobs.join(tags, "job_id", "left").groupBy("role_family").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("salary_analysis_eligible").alias("eligible"), F.coalesce(F.sum("n"), F.lit(0)).alias("links"),
        F.count_distinct("posted_month").alias("months"),
    )


def _results(spark, root):
    """Result tables as CSV."""
    path = _folder(spark)
    tables = reports.result_tables(dq.full_jobs(spark, root), b.bridge(spark, root))
    names = ["role_demand_summary", "skill_coverage_report"]
    postings.write_results({n: tables[n] for n in names}, path)
    frames = [spark.read.csv(f"{path}/{n}", header=True, inferSchema=True).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("row_count"), F.sum("job_count").alias("jobs")) for n in names]
    return frames[0].union(frames[1])


def _star(spark, root):
    """All star tables, the fact with its long text."""
    path = _folder(spark)
    postings.write_star(sq.star(spark, root, shared=True, whole=True), path)
    star = postings.read_star(spark, path)
    counts = [getattr(star, n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("row_count")) for n in Star.names()]
    out = counts[0]
    for one in counts[1:]:
        out = out.union(one)
    return out


QUERIES = {"written_postings": _postings, "written_clean": _clean, "written_results": _results, "written_star": _star}

_STAR_COUNTS = {
    "dim_role": "(SELECT DISTINCT role_family FROM labels1)", "dim_company": "(SELECT DISTINCT company FROM cj)",
    "dim_location": "(SELECT DISTINCT city, state, location_name, location_scope FROM wide)", "dim_date": "(SELECT DISTINCT posted_date FROM wide)",
    "dim_skill": "(SELECT DISTINCT skill FROM tg)", "fact_jobs": "wide", "bridge_job_skill": "tg",
}
ORACLES = {
    "written_postings": with_ctes(f"""
        SELECT source, count(*) AS row_count, sum(length(description))::BIGINT AS description_chars,
            count(location_name) FILTER (location_name NOT IN ({", ".join(f"'{x}'" for x in fixed.NULL_TOKENS)})) AS places, max(created) AS last_day
        FROM raw GROUP BY source""", cq.EXTRA),
    "written_clean": with_ctes("""
        SELECT role_family, count(*) AS row_count, count(*) FILTER (WHERE salary_analysis_eligible) AS eligible,
            coalesce(sum(skill_count), 0)::BIGINT AS links, count(DISTINCT posted_month) AS months
        FROM cj GROUP BY role_family""", cq.EXTRA),
    "written_results": with_ctes("""
        SELECT 'role_demand_summary' AS name, count(DISTINCT role_family) AS row_count, count(*) AS jobs FROM jobs
        UNION ALL SELECT 'skill_coverage_report', count(DISTINCT skill), count(*) FROM br"""),
    "written_star": with_ctes(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS row_count FROM {sql}" for n, sql in _STAR_COUNTS.items()), sq._EXTRA),
}
