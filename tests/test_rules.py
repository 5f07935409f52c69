"""Rule semantics on hand-made rows."""

import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywright.functions import calendar as cal
from tallywright.functions import extract, fixed, labels, pay, text
from tallywright.functions.patterns import found_sql, index_words, labels_by_word, needed_texts, search_text, words_sql


def one(spark, values, column, kind="string"):
    """Results of one expression over the texts, in order; ``x`` is the text, ``s`` its search text."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    if kind == "string":
        rows = rows.withColumn("s", search_text(F.col("x"))).withColumn("c", text.clean_text(F.col("x")))
    out = column(F.col("x")) if callable(column) else column
    return [r[0] for r in rows.select(out.alias("r"), "i").orderBy("i").select("r").collect()]


def test_clean_and_normalized_text(spark):
    values = [" a \t b\n", None, "R&D  Team", "\x1cA\x1fB"]
    assert one(spark, values, text.clean_text) == ["a b", "", "R&D Team", "A B"]
    assert one(spark, values, text.normalized_text) == ["a b", "", "r and d team", "a b"]


def test_sources(spark):
    values = ["adzuna_in", "freehire/jp-morgan chase", "freehire/", "freehire/ ", "x/adzuna", "Board", None, "a/b/o'neil 3com"]
    assert one(spark, values, text.source_family) == [
        "Adzuna", "Freehire", "Freehire", "Freehire", "Adzuna", "Other", "Other", "Other"]
    assert one(spark, values, text.source_provider) == [
        "Adzuna", "Jp-Morgan Chase", "Unknown", "Unknown", "Adzuna", "Board", "Unknown", "B/O'Neil 3Com"]


def test_booleans(spark):
    values = ["1", "1.0", "TRUE", " y ", "no", "", None, "maybe"]
    assert one(spark, values, text.parse_bool) == [True, True, True, True, False, False, False, False]
    assert one(spark, values, lambda c: text.parse_bool(c, "null"))[6] is None
    assert one(spark, values[:7], lambda c: text.parse_bool(c, "error")) == [True, True, True, True, False, False, False]
    with pytest.raises(PySparkException):
        one(spark, values, lambda c: text.parse_bool(c, "error"))
    assert one(spark, [1.0, 0.0, None], text.parse_bool, "double") == [True, False, False]
    with pytest.raises(ValueError):
        text.parse_bool(F.col("x"), "other")


def test_numbers_and_labels(spark):
    assert one(spark, ["12", "1,200", "x", None, "NaN"], text.to_number) == [12.0, None, None, None, None]
    assert one(spark, ["1,200.5"], lambda c: text.to_number(c, True)) == [1200.5]
    assert one(spark, [950000.0, None], text.lakh_text, "double") == ["₹9.50L", "NA"]
    assert one(spark, ["a", None], text.fill_label) == ["a", "Not Specified"]
    assert one(spark, [" TEST ", "Testing", None], text.is_placeholder) == [True, False, False]
    assert one(spark, [263611.83499999996, 12.345, -1.005], text.round_money, "double") == [263611.84, 12.35, -1.01]


def test_roles(spark):
    values = ["Business Data Analyst", "Risk Analytics Analyst", "R&D Business Analyst", "Cook", None,
              "DATA  Analyst", "Data Analysts", "Data Quality & Governance", "Analytics Associate"]
    assert one(spark, values, labels.classify("s")) == [
        "Data Analyst", "Risk / Quantitative Analytics", "Business Analyst", "Other Analyst", "Other Analyst",
        "Data Analyst", "Other Analyst", "Data Quality / Governance", "Analytics Analyst"]


def test_folded_letters_still_match(spark):
    assert one(spark, ["buſineſſ analyst", "busıness analyst"], labels.classify("s")) == ["Business Analyst"] * 2


def test_places(spark):
    values = ["Navi Mumbai", "India, India", "Remote, India", "remote", "Remote - Karnataka, India", "Mohali, Punjab",
              "", "New Delhi", None, "Remote Hub, US", " ,x", "India; Gujarat", "Punelli", "INDIA"]
    places = one(spark, values, labels.normalize_place("s", "c"))
    assert places == ["Mumbai", "City Not Specified", "Remote - India", "Remote - India", "Remote - India", "Mohali",
                      "Unknown", "Delhi", "Unknown", "Remote Hub", "Unknown", "City Not Specified", "Punelli",
                      "City Not Specified"]
    rows = spark.createDataFrame(list(zip(places, [v or "" for v in values])), "p string, x string")
    got = rows.withColumn("s", search_text(F.col("x"))).select(labels.normalize_region("p", "s"), labels.place_scope("p")).collect()
    assert [r[0] for r in got] == ["Maharashtra", "India", "Remote - India", "Remote - India", "Karnataka", "Punjab",
                                   "Unknown", "Delhi", "Unknown", "Unknown", "Unknown", "India", "Unknown", "India"]
    assert [r[1] for r in got][:7] == ["Specific City", "India - City Not Specified", "Remote India", "Remote India",
                                       "Remote India", "Specific City", "Unknown"]


def test_work_modes(spark):
    values = ["hybrid or remote", "on site", "on-site", "in-office", "onsite", "WFH", "nothing", "remotely"]
    assert one(spark, values, labels.work_mode("s")) == [
        "Hybrid", "On-site", "On-site", "On-site", "On-site", "Remote", "Not Specified", "Not Specified"]


def test_ranges(spark):
    values = ["2-5 years of experience", "3+ years", "Minimum of 4 yrs", "at least 3 years and 1-2 years", "45 years",
              "5-2 years", "2–4 YEARS", "none", None, "6 years experience", "31-40 yrs, 7+ yrs"]
    got = one(spark, values, extract.extract_range("s"))
    assert [(r["min"], r["max"]) for r in got] == [
        (2, 5), (3, 3), (4, 4), (1, 2), (None, None), (None, None), (2, 4), (None, None), (None, None), (6, 6), (7, 7)]


def test_bands(spark):
    values = [0.0, 1.0, 9.99, 10.0, 14.99, 15.0, None, float("nan"), -1.0]
    assert one(spark, values, labels.band("x"), "double") == [
        "0–1", "1–2", "9–10", "10–15", "10–15", "15+", "Not Specified", "Not Specified", "15+"]
    assert one(spark, ["15+", "0–1", "other"], labels.label_order("x")) == [12, 1, 14]


def test_tags(spark):
    values = ["PowerBI and A/B testing", "AB testing", "R programming", "SQL Server", "ELT belt", "belt", None,
              "r language, xr programming", "excel excel", "ML model, pyspark", "error programming"]
    assert one(spark, values, extract.extract_tags("s")) == [
        ["A/B Testing", "Power BI"], ["A/B Testing"], ["R"], ["SQL", "SQL Server"], ["ELT"], [], [], ["R"], ["Excel"],
        ["Machine Learning", "Spark"], []]


def test_tags_by_words_equal_tags_by_patterns(spark):
    """The lookup of words finds what every pattern finds when it is searched by itself."""
    texts = ["sql", "SQL.", "sql_x", "ésql", "sqlé sql", "nosql", "x–sql–y", "sql\u0301", "a\u200dsql", "ms excel", "MS  Excel", "ms-excel", "ms excels",
             "data_warehouse data warehouse", "data warehouses", "machine\u00a0learning", "a/b testing", "ml models", "powerbi", "Power  BI", "r language²",
             "ſql ſas", "GIT github gitlab", "git·hub", "", " ", None, "google cloud platform", "google cloud", "statiſtical analysis", "ssis, sap; sas/spss"]
    rules = [*fixed.TAG_RULES, ("Capital", [r"\bSQL\b"]), ("Either", [r"\b(git|jira)\b", r"\bms\b"])]
    plain = ", ".join(f"CASE WHEN {found_sql('s', patterns)} THEN '{tag}' END" for tag, patterns in rules)
    expected = one(spark, texts, F.expr(f"sort_array(array_compact(array({plain})))"))
    assert one(spark, texts, extract.extract_tags("s", rules)) == expected and sum(map(bool, expected)) > 15
    assert one(spark, texts[:3], extract.extract_tags("s", [("Number", [r"\d"])])) == [[], [], []]
    assert index_words([r"\bms excel\b", r"\bsql\b", r"\bml models?\b"]) == ["excel", "sql"]


def test_needed_texts_are_part_of_each_pattern():
    assert needed_texts(r"\bpower\s*bi\b") == ["power"]
    assert needed_texts(r"\bml models?\b") == ["ml model"]
    assert needed_texts(r"\b(on[- ]?site|wfh)\b") == ["site", "wfh"]
    assert needed_texts(r"a|b") == []


PAY_ROWS = [
    # low, high, predicted, text, status, min, max
    (None, 5.0, None, "12 LPA", fixed.STATUS_NOT_ELIGIBLE, None, None),
    (10.0, 5.0, None, "", fixed.STATUS_NOT_ELIGIBLE, None, None),
    (0.0, 5.0, None, "", fixed.STATUS_NOT_ELIGIBLE, None, None),
    (400000.0, 500000.0, "yes", "", fixed.STATUS_NOT_ELIGIBLE, None, None),
    (290000.0, 310000.0, None, "Salary Rs 25,000 per month", fixed.STATUS_MONTHLY_AS_IS, 290000.0, 310000.0),
    (24000.0, 26000.0, None, "Salary Rs 25,000 per month", fixed.STATUS_MONTHLY_SCALED, 288000.0, 312000.0),
    (90000.0, 90000.0, None, "₹ 25,000/month", fixed.STATUS_AMBIGUOUS, None, None),
    (1000000.0, 1200000.0, None, "10-12.5 LPA", fixed.STATUS_ANNUAL_AS_IS, 1000000.0, 1200000.0),
    (100000.0, 100000.0, None, "12 lakhs per annum", fixed.STATUS_ANNUAL_SCALED, 1200000.0, 1200000.0),
    (5000000.0, 5000000.0, None, "budget 900,000 per annum", fixed.STATUS_AMBIGUOUS, None, None),
    (300000.0, 300000.0, None, "none", fixed.STATUS_SCALE, 300000.0, 300000.0),
    (299999.0, 299999.0, None, None, fixed.STATUS_AMBIGUOUS, None, None),
    (135.0, 135.0, None, "salary 100 yearly", fixed.STATUS_ANNUAL_AS_IS, 135.0, 135.0),
    (136.0, 136.0, None, "salary 100 yearly", fixed.STATUS_AMBIGUOUS, None, None),
    (400000.0, 400000.0, None, "salary , per month", fixed.STATUS_SCALE, 400000.0, 400000.0),
]


def test_pay_decision_table(spark):
    rows = [(i, *r[:4]) for i, r in enumerate(PAY_ROWS)]
    df = spark.createDataFrame(rows, "i int, salary_min_source double, salary_max_source double, "
                                     "salary_is_predicted string, d string")
    df = df.withColumn("clean_description", text.clean_text(F.col("d"))).withColumn(
        "search_description", search_text(F.col("d")))
    got = pay.normalize_amounts(df).orderBy("i").collect()
    assert [(r["salary_normalization_status"], r["salary_min"], r["salary_max"]) for r in got] == [
        tuple(r[4:]) for r in PAY_ROWS]
    assert got[0]["has_salary_source"] and got[0]["salary_text_evidence"] == fixed.PAY_NO_RANGE
    assert got[7]["salary_text_evidence"] == "10-12.5 LPA"
    assert got[11]["salary_text_evidence"] == fixed.PAY_NO_EVIDENCE
    assert [r["salary_analysis_eligible"] for r in got] == [r[5] is not None for r in PAY_ROWS]


def test_tolerance(spark):
    df = spark.createDataFrame([(135.0, 100.0), (136.0, 100.0), (1.0, 0.0), (None, 1.0)], "x double, t double")
    assert [r[0] for r in df.select(pay.within_tolerance(F.col("x"), F.col("t"))).collect()] == [True, False, False, False]


def test_calendar(spark):
    stamps = ["2026-01-04 23:00:00", "2026-01-05 00:00:00", None]
    rows = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.to_timestamp_ntz("s").alias("t"))
    got = rows.select(cal.week_start(F.col("t")), cal.month_key(F.col("t"))).collect()
    assert [str(r[0]) for r in got] == ["2025-12-29", "2026-01-05", "None"]
    days = spark.createDataFrame([("2026-05-18",), ("2026-05-19",), ("2026-08-17",), (None,)], "s string").select(
        F.to_date("s").alias("d"))
    assert [r[0] for r in days.select(cal.recent_flag(F.col("d"))).collect()] == [False, True, True, None]
    assert [r[0] for r in days.select(cal.in_window(F.col("d"))).collect()] == [True, True, False, False]
    table = cal.calendar(days, "d").orderBy("date_key").collect()
    assert len(table) == 3 and table[0]["day_of_week"] == 0 and table[0]["day_name"] == "Monday"


def test_complete_weeks(spark):
    days = ["2026-01-07", "2026-01-12", "2026-01-18", "2026-01-19", "2026-01-22"]
    df = spark.createDataFrame([(d,) for d in days], "s string").select(F.to_date("s").alias("d"))
    df = cal.with_complete_week(df.withColumn("week_start", cal.week_start(F.col("d"))), "d")
    assert [r["is_complete_week"] for r in df.orderBy("d").collect()] == [False, True, True, False, False]


def test_words_are_split_at_one_plain_character(spark):
    sql = words_sql("s")
    assert re.findall(r"split\(.*, '(.*?)'\)", sql) == [" "]  # any other pattern is compiled for every row
    texts = ["sql, python/r_2; (c++)", " a\tb ", "", "Größe–größe 11–12 naïve", "a.b"]
    df = spark.createDataFrame([(i, x.lower()) for i, x in enumerate(texts)], "i int, s string")
    got = [set(r[0]) - {""} for r in df.orderBy("i").selectExpr(sql).collect()]
    assert got == [set(re.findall(r"\w+", x.lower())) for x in texts]


def test_rules_run_before_names_are_joined(spark):
    from tallywright.plans.clean import clean_jobs
    from tallywright.sources.postings import POSTING_SCHEMA

    plan = clean_jobs(spark.createDataFrame([], POSTING_SCHEMA)).select("company_name", "tags")
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(lines) if "Join LeftOuter" in x)
    assert join < next(i for i, x in enumerate(lines) if "sort_array(" in x)


def test_clean_rules_have_short_methods(spark, capsys):
    """The JVM interprets a method of over 8,000 bytes; the rules fused with the other steps made one of 16,000."""
    from tallywright.plans.clean import clean_jobs
    from tallywright.sources.postings import POSTING_SCHEMA

    rows = [("1", "adzuna_in", "Data Analyst", "A", "Pune", "3-5 years, sql", "2026-02-01T00:00:00Z", "1", "2", "0", None, None, None)]
    raw = spark.createDataFrame(rows, POSTING_SCHEMA)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the code is made stage by stage, when it runs
    try:
        clean_jobs(raw).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_amounts_not_found_are_null(spark):
    """Texts without a number, or with commas only, have no amount; the first pattern that has one wins."""
    texts = ["salary , per month", "nothing per month", "rs 25,000 per month", "salary 9 per month, 3 lpa", "3 lpa"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = pay.with_evidence(df, "t", "t", F.lit(True)).orderBy("i").select("_unit", "_amount").collect()
    assert [tuple(r) for r in got] == [
        ("UNKNOWN", None), ("UNKNOWN", None), ("MONTHLY", 25000.0), ("MONTHLY", 9.0), ("ANNUAL", 300000.0),
    ]


def test_words_that_settle_their_labels_are_looked_up(spark):
    """A CASE over all words tests one after the other; only words of longer phrases still need one."""
    rules = [("A", [r"\balpha\b"]), ("B", [r"\bbeta\b", r"\bold beta\b"]), ("C", [r"\bgamma ray\b"]), ("D", [r"\bgamma\b"])]
    assert "CASE" not in labels_by_word("s", "w", rules[:2])
    df = spark.createDataFrame([(w, f"old {w} rays") for w in ("alpha", "beta", "gamma", "none")], "w string, s string")
    assert [r[0] for r in df.select(F.expr(labels_by_word("s", "w", rules))).collect()] == [["A"], ["B"], [None, "D"], None]


def test_amounts_without_their_optional_beginning():
    full = fixed.PAY_PATTERNS[2][3]
    assert pay.amount_part(full) != full and all(pay.amount_part(p[3]) == p[3] for p in (*fixed.PAY_PATTERNS[:2], fixed.PAY_PATTERNS[3]))
    texts = ["Salary. Then 12 LPA", "ctc 3.5 4 lakhs per annum, 9 lpa", "x" * 300 + "7lpa", "salary" * 30 + "8 lpa 9 lpa", "1.2.3 lpa", "lpa 5", "4 lpax 6 lpa"]
    for t in texts:
        one, other = (re.search(p, t, re.I) for p in (full, pay.amount_part(full)))
        assert (one and one.group(1)) == (other and other.group(1)), t
    assert pay.first_words(full) == [] and pay.first_words(fixed.PAY_PATTERNS[0][3]) == ["salary", "budget", "ctc"]


def test_calendar_labels_need_no_formatter(spark):
    days = ["2026-01-05", "2026-01-11", "0999-12-31", "1000-01-01", None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, s string").selectExpr("i", "to_date(s) AS d")
    df = df.union(spark.sql("SELECT 5, date_add(DATE '9999-12-31', 1)")).orderBy("i")
    got = df.select(cal.month_key(F.col("d")), F.date_format("d", "yyyy-MM"), cal.week_start(F.col("d")).cast("string"), F.date_trunc("week", "d").cast("date").cast("string")).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got) and got[0][0] == "2026-01" and got[1][2] == "2026-01-05"
    assert "date_trunc" not in df.select(cal.week_start(F.col("d")))._jdf.queryExecution().optimizedPlan().toString().lower()


def test_python_sees_only_names_to_fold(spark):
    from tallywright.operators.names import display_names

    names = [("Acme",), ("ACME",), ("Acmé",), ("Ácme",), ("Ácme",), (None,), (" ",)]
    plan = display_names(spark.createDataFrame(names, "n string"), "n")
    assert sorted(tuple(r) for r in plan.collect()) == [("ACME", "Ácme"), ("Acme", "Ácme"), ("Acmé", "Ácme")]
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    udfs = [i for i, x in enumerate(lines) if "ArrowEvalPython" in x]
    assert udfs and any("Union" in x for x in lines), plan._jdf.queryExecution().optimizedPlan().toString()
    assert all(any("Filter" in x for x in lines[i + 1:i + 5]) for i in udfs)
