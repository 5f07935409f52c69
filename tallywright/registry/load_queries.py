"""A star built by several loads that overlap, and what is stored of it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallywright.operators.keys import DIGITS
from tallywright.plans import clean
from tallywright.registry import clean_queries as cq
from tallywright.registry import star_queries as sq
from tallywright.registry.base_sql import with_ctes
from tallywright.session import materialize, shared_folder
from tallywright.sources import loads

#: Which jobs each load brings, by number; the third one brings the second's again.
PARTS = ("k % 3 <> 0", "k % 2 = 0", "k % 2 = 0")


def _loaded(spark, root, parts=PARTS[:2]):
    path = f"{shared_folder(spark)}/loaded-{uuid.uuid4().hex}"
    jobs = materialize(cq.jobs(spark, root).drop("description")).withColumn("description", F.lit(None).cast("string"))
    reports = []
    for part in parts:
        own = jobs.where(part.replace("k", "cast(job_id AS bigint)"))
        reports.append(loads.load_star(own, clean.bridge_of(own), path))
    return path, reports


def _twice(spark, root):
    """Keys of every job after the loads."""
    path, _ = _loaded(spark, root)
    return loads.read_loaded(spark, path).fact_jobs.select("job_id", "job_key", "role_key", "company_key", "location_key", "date_key")


def _links(spark, root):
    path, _ = _loaded(spark, root)
    return loads.read_loaded(spark, path).bridge_job_skill


def _report(spark, root):
    """Rows of every table after each load."""
    _, reports = _loaded(spark, root, PARTS)
    out = [r.select(F.lit(k).alias("load"), "table", "rows_before", "rows_after") for k, r in enumerate(reports, 1)]
    return out[0].union(out[1]).union(out[2])


def _days(spark, root):
    """A range of days of the loaded fact; only the folders of its months are read."""
    path, _ = _loaded(spark, root)
    rows = loads.read_loaded(spark, path, "2000-03-10", "2000-05-20").fact_jobs
    return rows.groupBy("date_key").agg(F.count(F.lit(1)).alias("jobs"), F.sum("salary_midpoint").cast("double").alias("pay"))


def _bridge(spark, root):
    """The bridge as a table of its own, written and read."""
    path = f"{shared_folder(spark)}/bridge-{uuid.uuid4().hex}"
    loads.write_bridge(clean.bridge_of(cq.jobs(spark, root)), path)
    return loads.read_bridge(spark, path)


QUERIES = {"star_loaded_twice": _twice, "links_loaded_twice": _links, "load_report": _report, "loaded_days": _days, "written_bridge": _bridge}


def _keys_sql(name: str, source: str, natural: str, key: str) -> dict[str, str]:
    """Keys given by the first load, then by the second to the names that it brings."""
    text = f"concat_ws(chr(1), {natural})"
    by = f"row_number() OVER (ORDER BY left(md5({text}), {DIGITS}), {natural})"
    return {
        f"{name}_1": f"SELECT *, {by} AS {key} FROM (SELECT DISTINCT {natural} FROM {source} WHERE {PARTS[0]})",
        f"{name}_2": f"""SELECT *, (SELECT count(*) FROM {name}_1) + {by} AS {key} FROM (
            SELECT DISTINCT {natural} FROM {source} WHERE {PARTS[1]} EXCEPT SELECT {natural} FROM {name}_1)""",
        f"{name}_all": f"SELECT * FROM {name}_1 UNION ALL SELECT * FROM {name}_2",
    }


_EXTRA = {
    **sq._EXTRA,
    "linked": "SELECT skill, tg.job_id, CAST(tg.job_id AS BIGINT) AS k FROM tg",
    **_keys_sql("role_keys", "wide", "role_family", "role_key"),
    **_keys_sql("company_keys", "wide", "company_name", "company_key"),
    **_keys_sql("place_keys", "wide", "city, state, location_name, location_scope", "location_key"),
    **_keys_sql("job_keys", "wide", "job_id", "job_key"),
    **_keys_sql("skill_keys", "linked", "skill", "skill_key"),
}
_LINKS = "SELECT DISTINCT job_key, skill_key FROM linked JOIN job_keys_all USING (job_id) JOIN skill_keys_all USING (skill)"
_SIZES = {
    "dim_role": "role_keys", "dim_company": "company_keys", "dim_location": "place_keys", "dim_skill": "skill_keys", "fact_jobs": "job_keys",
}
_AFTER = {
    **{name: (f"(SELECT count(*) FROM {own}_1)", f"(SELECT count(*) FROM {own}_all)") for name, own in _SIZES.items()},
    "dim_date": (f"(SELECT count(DISTINCT posted_date) FROM wide WHERE {PARTS[0]})", f"(SELECT count(DISTINCT posted_date) FROM wide WHERE {PARTS[0]} OR {PARTS[1]})"),
    "bridge_job_skill": (f"(SELECT count(*) FROM linked WHERE {PARTS[0]})", "(SELECT count(*) FROM linked JOIN job_keys_all USING (job_id))"),
}
ORACLES = {
    "star_loaded_twice": with_ctes("""
        SELECT w.job_id, j.job_key, r.role_key, c.company_key, p.location_key, posted_date AS date_key
        FROM wide w JOIN job_keys_all j USING (job_id) JOIN role_keys_all r USING (role_family) JOIN company_keys_all c USING (company_name)
        JOIN place_keys_all p USING (city, state, location_name, location_scope)""", _EXTRA),
    "links_loaded_twice": with_ctes(_LINKS, _EXTRA),
    "load_report": with_ctes(" UNION ALL ".join(
        f"SELECT CAST({load} AS INTEGER) AS load, '{name}' AS table, {before} AS rows_before, {after} AS rows_after"
        for name, (one, two) in _AFTER.items() for load, before, after in ((1, "0::BIGINT", one), (2, one, two), (3, two, two))), _EXTRA),
    "loaded_days": with_ctes("""
        SELECT posted_date AS date_key, count(*) AS jobs, sum(CAST(salary_midpoint AS DECIMAL(18,2)))::DOUBLE AS pay
        FROM wide JOIN job_keys_all USING (job_id) WHERE posted_date BETWEEN DATE '2000-03-10' AND DATE '2000-05-20' GROUP BY 1""", _EXTRA),
    "written_bridge": with_ctes("SELECT job_id, skill, skill_category FROM tg", cq.EXTRA),
}
