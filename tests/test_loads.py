"""Loads into a stored star: nothing is rewritten, keys stay, ranges of days read their months only."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywright.operators import keys
from tallywright.plans import clean
from tallywright.plans.star import Star
from tallywright.registry import clean_queries as cq
from tallywright.sources import loads


def _tables(spark, path):
    return {n: sorted(map(str, spark.read.parquet(f"{path}/{n}").collect())) for n in Star.names()}


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_load_again_and_more(spark, small, tmp_path):
    path = str(tmp_path / "star")
    jobs = cq.jobs(spark, small)
    months = sorted(r["posted_month"] for r in jobs.select("posted_month").distinct().collect())
    first, later = jobs.where(F.col("posted_month") < months[-2]), jobs.where(F.col("posted_month") >= months[-3])
    report = {r["table"]: r for r in loads.load_star(first, clean.bridge_of(first), path).collect()}
    assert report["fact_jobs"]["rows_before"] == 0 and report["fact_jobs"]["rows_after"] == first.count()
    before, files = _tables(spark, path), _files(path)

    loads.load_star(first, clean.bridge_of(first), path, fixed_dates=True)
    assert _tables(spark, path) == before

    loads.load_star(later, clean.bridge_of(later), path)
    assert files <= _files(path)  # nothing stored was rewritten
    assert all(f"year_month={m}" in f for f in _files(f"{path}/fact_jobs") - files for m in [f.split("year_month=")[1][:7]] if m >= months[-3])
    after = _tables(spark, path)
    assert all(set(before[n]) <= set(after[n]) for n in before)  # keys of the first load stay
    star = loads.read_loaded(spark, path)
    for name, (key, natural) in loads.KEYS.items():
        found = getattr(star, name).select(key, *natural).collect()
        assert sorted(r[key] for r in found) == list(range(1, len(found) + 1)) and len({tuple(r[c] for c in natural) for r in found}) == len(found)
    assert sorted(r["job_key"] for r in star.fact_jobs.select("job_key").collect()) == list(range(1, jobs.count() + 1))
    assert star.bridge_job_skill.count() == clean.bridge_of(jobs).select("job_id", "skill").distinct().count()

    ranged = loads.read_loaded(spark, path, f"{months[2]}-05", f"{months[4]}-20").fact_jobs
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan and months[2] in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert ranged.count() == jobs.where(F.col("posted_date").between(f"{months[2]}-05", f"{months[4]}-20")).count()


def test_registered(spark):
    known = spark.createDataFrame([("a", None, 1), (None, "x", 2)], "p string, q string, key long")
    names = spark.createDataFrame([("a", None, "z"), ("b", "1", "y"), ("b", "1", "x"), (None, None, "w"), (None, "x", "v")], "p string, q string, note string")
    found = {(r["p"], r["q"]): (r["key"], r["note"]) for r in keys.registered(names, known, ["p", "q"], "key").collect()}
    assert set(found) == {("b", "1"), (None, None)} and found["b", "1"][1] == "x" and sorted(k for k, _ in found.values()) == [3, 4]
    assert keys.registered(names.where("false"), known, ["p", "q"], "key").count() == 0
    assert [r["key"] for r in keys.numbered(names.select("note").where("note = 'w'"), ["note"], "key", 9).collect()] == [10]


def test_rows_are_dealt_once_to_be_chosen_and_numbered(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "job_id string, d int")
    dealt = rows.withColumn("_part", keys.part_of(["job_id"])).repartition("_part")
    turn = F.row_number().over(Window.partitionBy("_part", "job_id").orderBy("d"))
    found = keys.numbered(dealt.withColumn("_turn", turn).where("_turn = 1"), ["job_id"], "key")
    assert sorted((r["d"], r["key"]) for r in found.collect()) in ([(1, 1), (3, 2)], [(1, 2), (3, 1)])
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    main = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "REPARTITION" not in x]
    assert len(main) <= 1  # the counts of parts are moved, the rows are not
