"""Complete-week trends over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.functions.calendar import week_start, with_complete_week
from tallywright.functions.text import round_to, safe_pct
from tallywright.operators.trend import dense_weekly_share, rolling_mean, weekly_counts
from tallywright.plans import trends
from tallywright.registry.base_sql import pct, r2, with_ctes
from tallywright.registry.demand_queries import _both, _jobs
from tallywright.sources import bindings as b


def _event_weeks(spark, root):
    """Weekly share of each event type over the complete weeks of the event table."""
    day = F.col("ts").cast("date")
    events = b.table(spark, root, "events").select(
        F.col("event_id").alias("job_id"), F.col("event_type").alias("skill"), day.alias("day"), week_start(day).alias("week_start"))
    jobs = with_complete_week(events, "day")
    # An event has one type, so the series needs no join back to the events.
    weeks = weekly_counts(jobs)
    typed = jobs.where("is_complete_week").groupBy("week_start", "skill").agg(F.count(F.lit(1)).alias("skill_jobs"))
    share = typed.join(weeks, "week_start").withColumn("p", safe_pct(F.col("skill_jobs"), F.col("weekly_jobs")))
    rolled = rolling_mean(share, "p", "skill", "week_start", "rolling")
    return rolled.select("week_start", "skill", "skill_jobs", "weekly_jobs", round_to("p").alias("share_pct"),
                         round_to("rolling").alias("rolling_share_pct"))


QUERIES = {
    "event_weekly_share": _event_weeks,
    "weekly_counts": _jobs(trends.weekly),
    "weekly_employers": _jobs(trends.weekly_employers),
    "week_over_week": _jobs(trends.week_over_week),
    "weekly_tag_share": _both(trends.weekly_tag),
    "rolling_tag_share_sparse": _both(lambda j, t: trends.rolling_tag(j, t, dense=False)),
    "rolling_tag_share_dense": _both(lambda j, t: trends.rolling_tag(j, t, dense=True, tags=b.BRANDS)),
    "dense_weekly_share_all": _both(lambda j, t: dense_weekly_share(j, t, None).select(
        "week_start", "skill", "skill_jobs", "weekly_jobs", "week_index", round_to("skill_share_pct", 2).alias("share_pct"))),
    "tag_trend_slope": _both(lambda j, t: trends.tag_trend(j, t, b.BRANDS)),
}

_SQL = {
    "event_weekly_share": f"""
        WITH e AS (SELECT CAST(ts AS DATE) AS d, CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type AS skill FROM events),
             c AS (SELECT * FROM e WHERE week_start + 6 <= (SELECT max(d) FROM e)
                   AND week_start >= (SELECT min(d) + CAST((8 - isodow(min(d))) % 7 AS INTEGER) FROM e)),
             w AS (SELECT week_start, count(*) AS weekly_jobs FROM c GROUP BY 1),
             t AS (SELECT week_start, skill, count(*) AS skill_jobs FROM c GROUP BY 1, 2),
             p AS (SELECT *, 100.0::DOUBLE * skill_jobs / weekly_jobs AS p FROM t JOIN w USING (week_start))
        SELECT week_start, skill, skill_jobs, weekly_jobs, {r2('p')} AS share_pct,
               {r2('avg(p) OVER (PARTITION BY skill ORDER BY week_start ROWS 2 PRECEDING)')} AS rolling_share_pct FROM p""",
    "weekly_counts": "SELECT week_start, weekly_jobs FROM wk",
    "weekly_employers": """SELECT week_start, count(*) AS weekly_jobs, count(DISTINCT company_key) AS hiring_companies
        FROM jobs WHERE is_complete_week GROUP BY 1""",
    "week_over_week": f"""
        SELECT *, weekly_jobs - prior_week_jobs AS absolute_change,
               {pct('weekly_jobs - prior_week_jobs', 'prior_week_jobs')} AS week_over_week_pct
        FROM (SELECT *, lag(weekly_jobs) OVER (ORDER BY week_start) AS prior_week_jobs FROM wk)""",
    "weekly_tag_share": f"""
        SELECT week_start, skill, skill_jobs, weekly_jobs, {pct('skill_jobs', 'weekly_jobs')} AS weekly_skill_share_pct
        FROM wt JOIN wk USING (week_start)""",
    "rolling_tag_share_sparse": f"""
        SELECT week_start, skill, {r2('p')} AS weekly_skill_share_pct, {r2('''avg(p) OVER (PARTITION BY skill
               ORDER BY week_start ROWS 2 PRECEDING)''')} AS rolling_3_week_share_pct
        FROM (SELECT week_start, skill, 100.0::DOUBLE * skill_jobs / weekly_jobs AS p FROM wt JOIN wk USING (week_start))""",
    "rolling_tag_share_dense": f"""
        SELECT week_start, skill, {r2('pct')} AS weekly_skill_share_pct, {r2('''avg(pct) OVER (PARTITION BY skill
               ORDER BY week_start ROWS 2 PRECEDING)''')} AS rolling_3_week_share_pct FROM grid""",
    "dense_weekly_share_all": f"""
        SELECT wk.week_start, t.skill, coalesce(wt.skill_jobs, 0) AS skill_jobs, wk.weekly_jobs,
               CAST(dense_rank() OVER (ORDER BY wk.week_start) - 1 AS INTEGER) AS week_index,
               {pct('coalesce(wt.skill_jobs, 0)', 'wk.weekly_jobs')} AS share_pct
        FROM wk CROSS JOIN (SELECT DISTINCT skill FROM br) t
        LEFT JOIN wt ON wt.week_start = wk.week_start AND wt.skill = t.skill""",
    "tag_trend_slope": f"""
        SELECT skill, count(*) AS complete_weeks, {r2('regr_slope(pct, week_index)', 4)} AS percentage_point_change_per_week,
               {r2('min(pct)', 4)} AS min_weekly_share_pct, {r2('max(pct)', 4)} AS max_weekly_share_pct,
               CASE WHEN regr_slope(pct, week_index) IS NULL THEN 'Not Available'
                    WHEN regr_slope(pct, week_index) > 0.05 THEN 'Upward'
                    WHEN regr_slope(pct, week_index) < -0.05 THEN 'Downward' ELSE 'Approximately Flat' END AS trend_direction
        FROM grid GROUP BY 1""",
}
ORACLES = {name: with_ctes(sql) for name, sql in _SQL.items()}
