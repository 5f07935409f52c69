"""Sources, the clean flow, the star and the reports on a small hand-made set of postings."""

import pytest
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.patterns import found_sql, search_text
from tallywright.functions.text import is_placeholder, parse_bool, to_number
from tallywright.plans import clean, demand, kpi, reports, star
from tallywright.registry import written_queries
from tallywright.session import build_session, materialize
from tallywright.sources import bindings
from tallywright.sources import postings as src

HEADER = "job_id,source,title,company_name,location_name,description,created,salary_min,salary_max,salary_is_predicted"
LINES = [
    '1,adzuna_in,Data Analyst,acme,Pune,"SQL, Python.\nLine two with ""quotes"". 2-4 years",2026-06-01T10:00:00Z,900000,1100000,0',
    "2,freehire/lever,Business Analyst,ACME,Remote - India,Excel and SQL hybrid,2026-05-18T23:59:59Z,NA,,",
    '3,freehire/greenhouse,Analyst,Test,Delhi,none,2026-06-02T00:00:00Z,1,2,1',
    '4,other,BI Analyst,,"India, India",Power BI 20+ years,2026-01-01T00:00:00Z,25000,25000,',
    "5,adzuna_in,Data Analyst,ACME,Pune,budget Rs 30000 per month; SQL and Tableau,2026-08-16T23:00:00Z,30000,32000,false",
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    (path / "a.csv").write_text("﻿" + "\n".join([HEADER, *LINES[:3]]) + "\n", encoding="utf-8")
    (path / "b.csv").write_text("﻿" + "\n".join([HEADER, *LINES[3:]]) + "\n", encoding="utf-8")
    return src.read_postings(spark, str(path))


@pytest.fixture(scope="module")
def tables(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clean"))
    src.write_clean(clean.clean_jobs(raw), root)
    return src.read_clean(spark, root)


def test_read_postings(raw):
    rows = {r["job_id"]: r for r in raw.collect()}
    assert len(rows) == 5 and raw.columns == [f.name for f in src.POSTING_SCHEMA.fields]
    assert rows["1"]["description"] == 'SQL, Python.\nLine two with "quotes". 2-4 years'
    assert rows["2"]["salary_min"] is None and rows["2"]["contract_type"] is None


def test_clean_table(tables):
    jobs, _ = tables
    assert jobs.columns == fixed.CLEAN_COLUMNS
    rows = {r["job_id"]: r for r in jobs.collect()}
    assert sorted(rows) == ["1", "2", "4", "5"]
    assert [rows[i]["company_name"] for i in "1245"] == ["ACME", "ACME", "Unknown Company", "ACME"]
    assert [rows[i]["is_recent_90d"] for i in "1245"] == [True, False, False, True]
    assert [rows[i]["work_mode"] for i in "1245"] == ["Not Specified", "Hybrid", "Not Specified", "Not Specified"]
    assert (rows["1"]["experience_min_years"], rows["4"]["experience_band"]) == (2.0, "15+")
    assert rows["5"]["salary_normalization_status"] == fixed.STATUS_MONTHLY_SCALED and rows["5"]["salary_min"] == 360000.0
    assert rows["1"]["salary_normalization_status"] == fixed.STATUS_SCALE
    assert [str(rows["1"][c]) for c in ("posted_date", "posted_month", "week_start")] == ["2026-06-01", "2026-06", "2026-06-01"]
    assert rows["4"]["is_complete_week"] is False and rows["1"]["is_complete_week"] is True
    assert rows["5"]["is_complete_week"] is True


def test_bridge_and_csv_round_trip(spark, tables, tmp_path):
    jobs, bridge = tables
    got = sorted((r["job_id"], r["skill"], r["skill_category"]) for r in bridge.collect())
    assert got == [("1", "Python", "Programming"), ("1", "SQL", "Database / Query"), ("2", "Excel", "Spreadsheet"),
                   ("2", "SQL", "Database / Query"), ("4", "Power BI", "BI / Visualization"),
                   ("5", "SQL", "Database / Query"), ("5", "Tableau", "BI / Visualization")]
    src.write_results({"jobs": jobs, "bridge": bridge}, str(tmp_path))
    again, links = src.read_clean_csv(spark, f"{tmp_path}/jobs", f"{tmp_path}/bridge")
    assert again.orderBy("job_id").select("posted_date", "salary_min", "is_recent_90d", "skill_count", "week_start").collect() == \
        jobs.orderBy("job_id").select("posted_date", "salary_min", "is_recent_90d", "skill_count", "week_start").collect()
    assert links.count() == 7


def test_gates_and_contract(raw, tables):
    got = {r["rule"]: r["failed_rows"] for r in clean.raw_report(raw, 6).collect()}
    assert got == {"repeated_job_ids": 0, "outside_date_window": 0, "row_count_difference": 1}
    jobs, bridge = tables
    report = reports.quality_report(jobs, bridge, expected_rows=4).collect()
    assert len(report) == 22 and all(r["passed"] for r in report)
    broken = jobs.withColumn("city", F.lit("India")).withColumn("is_recent_90d", F.lit(False))
    bad = {r["rule"]: r["failed_rows"] for r in reports.quality_report(broken, bridge).collect() if not r["passed"]}
    assert bad == {"city_is_country": 4, "recent_flag": 2}


def test_star(spark, tables, tmp_path):
    jobs, bridge = tables
    built = star.build_star(jobs, bridge)
    assert all(r["passed"] for r in star.star_report(built).collect())
    assert [(r["skill_key"], r["skill"]) for r in built.dim_skill.orderBy("skill_key").collect()] == [
        (1, "Excel"), (2, "Power BI"), (3, "Python"), (4, "SQL"), (5, "Tableau")]
    src.write_star(built, str(tmp_path))
    back = src.read_star(spark, str(tmp_path))
    view = star.jobs_enriched(back)
    assert len(view.columns) == 41 and view.count() == 4
    assert star.job_tags(back).count() == 7 and len(star.job_tags(back).columns) == 18
    looked = star.key_lookup(jobs.select("job_id", "role_family"), built.dim_role, ["role_family"], "role_key")
    assert looked.where("role_key is null").count() == 0
    star.register_views(back)
    assert spark.sql("SELECT count(*) FROM vw_job_skills WHERE skill = 'SQL'").collect()[0][0] == 3


def test_reports(tables, tmp_path):
    jobs, bridge = tables
    metrics = {r["metric"]: r["value"] for r in reports.run_metrics(jobs, bridge).collect()}
    assert metrics["processed_job_rows"] == 4 and metrics["skill_bridge_rows"] == 7 and metrics["salary_annualized_rows"] == 1
    found = {r["metric"]: r["value"] for r in reports.findings(jobs, bridge).collect()}
    assert found["top_skill"] == "SQL (3 postings)" and found["median_salary"] == "₹6.86L"
    results = reports.result_tables(jobs, bridge)
    src.write_results({k: results[k] for k in ("role_demand_summary", "skill_pair_summary")}, str(tmp_path))
    assert results["role_demand_summary"].collect()[-1]["cumulative_market_share_pct"] == pytest.approx(100.0)


def test_kpis_follow_filters(tables):
    jobs, bridge = tables
    every = kpi.kpis(jobs, bridge).collect()[0]
    assert every["analytical_vacancies"] == 4 and every["unique_companies"] == 1 and every["job_skill_rows"] == 7
    assert every["tag_salary_observations"] == 2 and every["rest_median_lakh"] is None
    assert every["median_salary_n20_lakh"] is None and every["top_5_employer_jobs"] == 3
    some = kpi.kpis(jobs, bridge, [F.col("city") == "Pune"]).collect()[0]
    assert some["analytical_vacancies"] == 2 and some["job_skill_rows"] == 4
    none = kpi.kpis(jobs, bridge, [F.col("city") == "Nowhere"]).collect()[0]
    assert none["analytical_vacancies"] == 0 and none["skill_coverage"] is None and none["unique_skills"] == 0
    by = {r["role_family"]: r["analytical_vacancies"] for r in kpi.kpis(jobs, bridge, by="role_family").collect()}
    assert by == {"Data Analyst": 2, "Business Analyst": 1, "BI Analyst": 1}


def test_shared_tables(spark, tmp_path):
    df = spark.range(10)
    assert materialize(df, str(tmp_path)).count() == 10
    assert materialize(df).count() == 10  # no folder is named: a local session has its own
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


def test_filters_act_on_tags(tables):
    jobs, bridge = tables
    pune = [F.col("city") == "Pune"]
    ids = {r["job_id"] for r in jobs.where(pune[0]).collect()}
    some = bridge.where(F.col("job_id").isin(list(ids)))
    wanted = {r["skill"]: r["count"] for r in some.groupBy("skill").count().collect()}
    found = {r["skill"]: r for r in kpi.tag_table(jobs, bridge, pune).collect()}
    assert {k: r["skill_jobs"] for k, r in found.items()} == wanted and all(r["skill_share"] <= 1 for r in found.values())
    assert {r["skill"]: r["job_count"] for r in demand.tag_demand(jobs, bridge, pune).collect()} == wanted
    assert {r["skill"]: r["job_count"] for r in demand.tag_coverage(jobs.where(pune[0]), bridge).collect()} == wanted
    assert all(r["share_of_tagged_jobs"] <= 1 for r in kpi.top_pairs(bridge, jobs=jobs, filters=pune).collect())


def _csv(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_csv_headers_are_checked(spark, tmp_path):
    columns = src.REQUIRED_POSTING
    row = ",".join(f"v{k}" for k in range(len(columns)))
    same, other, short = tmp_path / "same", tmp_path / "other", tmp_path / "short"
    for folder in (same, other, short):
        folder.mkdir()
    header = ",".join(columns)
    assert src.read_postings(spark, _csv(same, a=f"{header}\n{row}\n", b=f"{header}\n{row}\n")).count() == 2
    swapped = ",".join([columns[1], columns[0], *columns[2:]])
    with pytest.raises(Exception, match="(?i)header"):
        src.read_postings(spark, _csv(other, a=f"{header}\n{row}\n", b=f"{swapped}\n{row}\n")).collect()
    with pytest.raises(ValueError, match="description"):
        src.read_postings(spark, _csv(short, a=header.replace("description,", "") + "\n"))
    with pytest.raises(ValueError, match="posted_date"):
        src.read_clean_csv(spark, _csv(short, a=header.replace("description,", "") + "\n"), str(short))


def test_white_space_and_number_texts(spark):
    df = spark.createDataFrame([("Test\t", "10d", "true\n"), ("test\u2003", "5f", "\tYES"), ("Best", "0x1p3", None), ("x", " -1.5e3 ", "no")], "name string, n string, b string")
    rows = df.select(is_placeholder(F.col("name"), ["test"]).alias("p"), to_number(F.col("n")).alias("n"), parse_bool(F.col("b"), "null").alias("b")).collect()
    assert [tuple(r) for r in rows] == [(True, None, True), (True, None, True), (False, None, None), (False, -1500.0, False)]


def test_rules_in_capitals(spark):
    df = spark.createDataFrame([("We use sql daily",), ("nothing",)], "t string").select(search_text(F.col("t")).alias("t"))
    assert [r[0] for r in df.select(F.expr(found_sql("t", [r"\bSQL\b"]))).collect()] == [True, False]


def test_written_star_has_whole_texts(spark, tmp_path, monkeypatch):
    """The stored fact holds the description of every posting."""
    root = str(tmp_path)
    orders = [(k, 1 + k % 2, 1000.0 * k, "2001-05-0%d" % k, "1-URGENT", "F") for k in (1, 2, 3, 4)]
    columns = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string, o_orderpriority string, o_orderstatus string"
    spark.createDataFrame(orders, columns).withColumn("o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(1, "Customer#1", 0), (2, "Customer#2", 0)], "c_custkey long, c_name string, c_nationkey long").write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(0, "NATION_0")], "n_nationkey long, n_name string").write.parquet(f"{root}/nation.parquet")
    monkeypatch.setattr(written_queries, "_folder", lambda spark: f"{root}/star")
    counts = {r["name"]: r["row_count"] for r in written_queries.QUERIES["written_star"](spark, root).collect()}
    want = {r["job_id"]: r["description"] for r in bindings.raw_postings(spark, root).collect()}
    assert len(want) == counts["fact_jobs"] == 4 and all(want.values())
    assert {r["job_id"]: r["description"] for r in spark.read.parquet(f"{root}/star/fact_jobs").collect()} == want
