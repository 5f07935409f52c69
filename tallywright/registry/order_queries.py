"""Order of rows, inclusion of keys, and unrounded shares."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.labels import label_order
from tallywright.operators.order import write_sorted
from tallywright.operators.sets import is_subset
from tallywright.plans import demand
from tallywright.registry.base_sql import r2, with_ctes
from tallywright.session import shared_folder
from tallywright.sources import bindings as b


def _sorted(spark, root):
    """Employers and the positions of a sort by several keys, read from the written table."""
    rows = demand.employer_demand(b.employer_totals(spark, root), weight="n")
    path = f"{shared_folder(spark)}/sorted-{uuid.uuid4().hex}"
    return write_sorted(rows, path, [F.desc("job_count"), F.asc("company_name")]).select("position", "company_name", "job_count")


def _bands(spark, root):
    """Jobs in the order of their bands, not of the bands' names."""
    path = f"{shared_folder(spark)}/sorted-{uuid.uuid4().hex}"
    rows = b.jobs(spark, root).select("job_id", "experience_band", label_order("experience_band").alias("band_order"))
    return write_sorted(rows, path, [F.asc("band_order"), F.asc("job_id")]).select("position", "job_id", "experience_band")


def _inclusion(spark, root):
    jobs, bridge = b.jobs(spark, root).select("job_id"), b.bridge(spark, root).select("job_id")
    found = [("tagged jobs in jobs", is_subset(bridge, jobs, "job_id")), ("jobs in tagged jobs", is_subset(jobs, bridge, "job_id"))]
    return spark.createDataFrame(found, "inclusion string, holds boolean")


QUERIES = {
    "written_sorted": _sorted, "written_by_band": _bands, "key_inclusion": _inclusion,
    "role_demand_exact": lambda s, r: demand.role_demand(b.jobs(s, r), digits=9),
}
_ORDER = "CASE experience_band " + " ".join(f"WHEN '{x}' THEN {k}" for k, x in enumerate(fixed.BAND_ORDER)) + " END"
_SQL = {
    "written_sorted": """SELECT row_number() OVER (ORDER BY job_count DESC, company_name) AS position, * FROM (
        SELECT company_name, count(*) AS job_count FROM je WHERE company_name <> 'Unknown Company' GROUP BY 1)""",
    "written_by_band": f"SELECT row_number() OVER (ORDER BY {_ORDER}, job_id) AS position, job_id, experience_band FROM jobs",
    "key_inclusion": """SELECT 'tagged jobs in jobs' AS inclusion, (SELECT count(*) FROM br WHERE job_id NOT IN (SELECT job_id FROM jobs)) = 0 AS holds
        UNION ALL SELECT 'jobs in tagged jobs', (SELECT count(*) FROM jobs WHERE job_id NOT IN (SELECT job_id FROM br)) = 0""",
    "role_demand_exact": f"""
        SELECT role_family, job_count, {r2('p', 9)} AS market_share_pct,
            {r2('sum(p) OVER (ORDER BY job_count DESC, role_family ROWS UNBOUNDED PRECEDING)', 9)} AS cumulative_market_share_pct,
            CAST(dense_rank() OVER (ORDER BY job_count DESC) AS INTEGER) AS demand_rank
        FROM (SELECT role_family, count(*) AS job_count, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS p FROM jobs GROUP BY 1)""",
}
ORACLES = {name: with_ctes(sql) for name, sql in _SQL.items()}
