"""Bitmaps that roll up, and measures from stored cells against the measures read off the rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallywright.operators.bitmaps import bitmaps, distinct
from tallywright.plans import cube, kpi

SLICERS = ("role_family", "work_mode")


def test_bitmaps_roll_up(spark):
    """More names than a bitmap holds, in groups that overlap, with repeated rows and nulls."""
    rows = spark.range(200_000).select(
        (F.col("id") % 3).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("b"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("n"), (F.col("id") % 70_001).cast("string"))).alias("name"),
    )
    rows = rows.unionByName(rows.limit(1000))
    stored = bitmaps(rows, ["a", "b"], ["name"]).cache()
    assert stored.select("bucket").distinct().count() > 1
    for keys in ([], ["a"], ["b"], ["a", "b"]):
        want = {tuple(r) for r in rows.groupBy(*keys).agg(F.count_distinct("name").alias("n")).collect()}
        assert {tuple(r) for r in distinct(stored, keys).collect()} == want
    some = rows.where("b in (1, 2)").agg(F.count_distinct("name")).first()[0]
    assert distinct(stored.where("b in (1, 2)"), []).first()[0] == some
    assert distinct(bitmaps(rows.where("false"), ["a"], ["name"]), ["a"]).collect() == []


@pytest.fixture(scope="module")
def facts(spark):
    day = datetime.date(2024, 1, 1)
    rows = [
        (i, [None, "Unknown Company", "A", "B", "C", "D", "E", "F", "G"][i % 9], ["Pune", "Thane", None][i % 3], ["Specific City", "Unknown", None][i % 5 % 3],
         ["x", "y", None][i % 4 % 3], ["on", "off"][i % 7 % 2], day + datetime.timedelta(7 * (i % 6)), i % 4 > 0, float(i) if i % 3 else None, i % 5 != 2, i % 2 > 0, i % 6 > 1,
         float(1000 * (i * 37 % 101)) if i % 8 else None)
        for i in range(400)
    ]
    names = "job_id long, company_name string, city string, location_scope string, role_family string, work_mode string, week_start date, has_extracted_skill boolean, experience_min_years double, salary_analysis_eligible boolean, is_recent_90d boolean, is_complete_week boolean, salary_midpoint double"
    links = [(i, f"t{k}") for i in range(400) for k in range(i % 4)]
    return spark.createDataFrame(rows, names), spark.createDataFrame(links, "job_id long, skill string")


@pytest.fixture(scope="module")
def cells(facts):
    return cube.store_cells(*facts, SLICERS, "t1")


def rounded(df):
    return sorted(tuple(sorted((c, repr(round(v, 9) if isinstance(v, float) else v)) for c, v in r.asDict().items())) for r in df.collect())


@pytest.mark.parametrize("by, filters", [
    (None, ["work_mode in ('on', 'off')", "role_family = 'x'"]), ("role_family", ["role_family is null or role_family = 'y'"]), ("work_mode", []),
])
def test_cells_answer_as_the_rows_do(facts, cells, by, filters):
    want = kpi.kpis(*facts, filters, by, "t1")
    got = cube.measures(cells, filters, [(by,) if by else ()])
    assert rounded(got.drop(cube.LEVEL, *[s for s in SLICERS if s != by])) == rounded(want)


def test_selections_read_stored_cells_only(cells):
    """A selection scans the cells' files, filtered at the scan, and neither the facts nor the links."""
    text = cube.measures(cells, [F.col("work_mode") == "on"], [("role_family",)])._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in text and "kept-" not in text and "CartesianProduct" not in text
    assert "PushedFilters: [IsNotNull(work_mode), EqualTo(work_mode,on)]" in text


def test_no_jobs_no_rows(facts):
    jobs, links = facts
    cells = cube.store_cells(jobs.where("false"), links, SLICERS)
    assert cube.measures(cells, sets=cube.all_sets(SLICERS)).collect() == []
