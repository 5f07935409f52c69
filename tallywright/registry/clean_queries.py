"""Cleaning, extraction and names: over raw postings derived from the order tables, and over texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.extract import extract_range, extract_tags
from tallywright.functions.labels import classify
from tallywright.functions.patterns import search_text
from tallywright.functions.text import clean_text, normalized_text
from tallywright.operators.names import display_names
from tallywright.operators.quality import (
    expect, expect_count, expect_foreign_key, expect_recomputed, expect_unique, union_reports,
)
from tallywright.plans import clean, reports
from tallywright.registry.base_sql import pct, with_ctes
from tallywright.session import materialize
from tallywright.sources import bindings as b


def raw(spark, root):
    """Raw postings, dealt to as many tasks as there are cores."""
    return b.raw_postings(spark, root, spark.sparkContext.defaultParallelism)


def docs(spark, root, *columns):
    """Columns of the documents, dealt to as many tasks as there are cores."""
    return b.texts(spark, root, "documents", [*columns, "text"], spark.sparkContext.defaultParallelism)


def jobs(spark, root):
    return clean.clean_jobs(raw(spark, root), end=b.ORDERS_END)


def _columns(*names):
    return lambda spark, root: jobs(spark, root).select(*names)


def _with_bridge(fn):
    """Results that read the clean rows several times share one written table of them."""
    def run(spark, root):
        table = materialize(jobs(spark, root).drop("description"))
        return fn(table, clean.bridge_of(table))
    return run


_WORDS = [
    ("THE", [r"\bthe\b"]), ("OF THE", [r"\bof the\b", r"\bof that\b"]), ("AND", [r"\band\b"]),
    ("QUE", [r"\bque\b"]), ("LE/LA", [r"\bl[ea]\b"]), ("DER", [r"\bder\b", r"\bdie\b", r"\bdas\b"]),
    ("PARA", [r"\bpara\b"]), ("WORD-NUMBER", [r"\b[a-z]+ \d+\b"]),
]
_WORD_LANGS = {"THE": "Germanic", "OF THE": "Germanic", "AND": "Germanic", "DER": "Germanic", "QUE": "Romance",
               "LE/LA": "Romance", "PARA": "Romance"}
_TALK_RULES = [
    ("German", [r"\bund\b", r"\bdie\b"]), ("English", [r"\bthe\b", r"\band\b"]), ("French", [r"\ble\b", r"\bdes\b"]),
    ("Romance", [r"\bque\b", r"\bla\b"]),
]
_DOC_RANGES = [(r"(\d{1,2})\s*[-–]\s*(\d{1,2})", True, []), (r"(\d{1,2})%", False, ["%"])]


def _document_tags(spark, root):
    texts = docs(spark, root, "doc_id", "lang").select(F.struct("doc_id", "lang").alias("doc"), search_text(F.col("text")).alias("_t"))
    tagged = texts.select("doc", extract_tags("_t", _WORDS).alias("tags"))
    rows = clean.explode_tags(tagged, "doc", "tags", _WORD_LANGS)
    return rows.groupBy("doc.lang", "skill", "skill_category").agg(F.count(F.lit(1)).alias("documents"))


def _table_expectations(spark, root):
    """Expectations that the given tables do break, so that the counts are not zero."""
    lines, orders = b.table(spark, root, "lineitem"), b.table(spark, root, "orders")
    finished = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return union_reports(
        expect(lines, {
            "untaxed": F.col("l_tax") == 0,
            "high_discount": F.col("l_discount") > 0.08,
            "small_but_dear": (F.col("l_quantity") < 5) & (F.col("l_extendedprice") > 50000),
            "negative_quantity": F.col("l_quantity") < 0,
        }),
        expect_unique(lines, ["l_orderkey", "l_partkey"], "repeated_order_part"),
        expect_foreign_key(lines, finished, "l_orderkey", "line_of_open_order"),
        expect_count(lines, 1000, "difference_from_1000"),
        expect_recomputed(orders.withColumn("big", F.col("o_totalprice") > 250000), "big",
                          F.floor(F.col("o_totalprice") / 100000) >= 3, "big_flag"),
    )


QUERIES = {
    "raw_report": lambda s, r: clean.raw_report(raw(s, r), None, "1995-01-01", "2001-07-31"),
    "clean_labels": _columns("job_id", "source_family", "source_provider", "role_family", "city", "state",
                             "location_scope", "work_mode"),
    "clean_companies": _columns("job_id", "company_name"),
    "canonical_names": lambda s, r: display_names(clean.drop_placeholders(raw(s, r)), "company_name"),
    "clean_experience": _columns("job_id", "experience_min_years", "experience_max_years", "experience_band"),
    "clean_pay": _columns("job_id", "salary_min_source", "salary_max_source", "salary_min", "salary_max",
                          "salary_midpoint", "has_salary_source", "salary_analysis_eligible",
                          "salary_normalization_status", "salary_text_evidence"),
    "clean_calendar": _columns("job_id", "posted_date", "posted_month", "week_start", "is_recent_90d",
                               "is_complete_week"),
    "clean_tags": lambda s, r: clean.bridge_of(jobs(s, r)),
    "clean_tag_counts": _columns("job_id", "skill_count", "has_extracted_skill"),
    "run_metrics": _with_bridge(reports.run_metrics),
    "quality_report": _with_bridge(lambda j, t: reports.quality_report(j, t, b.ORDERS_END)),
    "table_expectations": _table_expectations,
    "document_text": lambda s, r: docs(s, r, "doc_id").select(
        "doc_id", F.md5(clean_text(F.col("text"))).alias("clean_md5"),
        F.md5(normalized_text(F.col("text"))).alias("normalized_md5"),
        F.length(clean_text(F.col("text"))).alias("clean_chars")),
    "document_tags": _document_tags,
    "document_ranges": lambda s, r: docs(s, r, "doc_id").select(
        "doc_id", search_text(F.col("text")).alias("_t")).select(
        "doc_id", extract_range("_t", _DOC_RANGES, 0, 99).alias("x")).select("doc_id", "x.*"),
    "classify_text": lambda s, r: b.table(s, r, "conversations").select(
        "conv_id", "turn", search_text(F.col("text")).alias("_t")).select(
        "conv_id", "turn", classify("_t", _TALK_RULES, "Other").alias("label")),
}

# --- SQL side ---------------------------------------------------------------------

_CLEAN = r"trim(regexp_replace(coalesce({0}, ''), '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g'))"


def _clean(x: str) -> str:
    return _CLEAN.format(x)


def _norm(x: str) -> str:
    return f"trim(regexp_replace(replace(lower({_clean(x)}), '&', ' and '), ' +', ' ', 'g'))"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(texts) -> str:
    return "[" + ", ".join(_q(t) for t in texts) + "]"


def _pick(texts, by: str) -> str:
    return f"list_extract({_list(texts)}, CAST(({by}) % {len(texts)} + 1 AS BIGINT))"


def _any(x: str, patterns) -> str:
    """RE2 has no look-around; the tag that uses it is bounded by classes instead."""
    parts = [p.replace("(?<![a-z0-9])", "(?:^|[^a-z0-9])").replace("(?![a-z0-9])", "(?:$|[^a-z0-9])") for p in patterns]
    return f"regexp_matches({x}, {_q('(?i)' + '|'.join(f'(?:{p})' for p in parts))})"


def _wide(pattern: str) -> str:
    """A word boundary that counts accented letters as letters, as RE2's own does not."""
    inner = pattern[2:-2]
    return rf"(?:^|[^\p{{L}}\p{{M}}\p{{N}}_]){inner}(?:$|[^\p{{L}}\p{{M}}\p{{N}}_])"


def _any_wide(x: str, patterns) -> str:
    return f"regexp_matches({x}, {_q('|'.join(_wide(p) for p in patterns))})"


def _case(x: str, rules, default: str, test=_any) -> str:
    return "CASE " + " ".join(f"WHEN {test(x, ps)} THEN {_q(name)}" for name, ps in rules) + f" ELSE {_q(default)} END"


_YEARS = "CAST(c % 18 AS VARCHAR)"
_LOW = """CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN 0 WHEN k % 3 = 0 THEN price
          WHEN k % 3 = 1 THEN CAST(floor(price / 10.0) AS BIGINT) ELSE price * 4 END"""
_GAP = "'.' || chr(10) || '  '"
_RAW = f"""
    SELECT CAST(k AS VARCHAR) AS job_id,
           CASE c % 4 WHEN 0 THEN 'adzuna_in' WHEN 1 THEN 'freehire/' || lower(substr(o_orderpriority, 3))
                WHEN 2 THEN 'freehire/' ELSE 'Board ' || o_orderstatus END AS source,
           {_pick(b._TITLES, 'k')} AS title,
           CASE WHEN k % 97 = 0 THEN ' Test ' WHEN c % 50 = 0 THEN '  ' WHEN k % 5 = 0 THEN lower(c_name)
                WHEN k % 5 = 1 THEN upper(c_name) WHEN k % 5 = 2 THEN c_name || ', '
                WHEN k % 5 = 3 THEN replace(c_name, 'o', 'ó') ELSE c_name END AS company_name,
           CASE WHEN k % 19 = 0 THEN n_name || ' | Kerala' WHEN k % 23 <> 0 THEN {_pick(b._PLACES, 'c')} END AS location_name,
           CASE k % 8 WHEN 0 THEN {_YEARS} || '-' || CAST(c % 18 + 3 AS VARCHAR) || ' years of experience'
                WHEN 1 THEN {_YEARS} || '+ years' WHEN 2 THEN 'Minimum of ' || {_YEARS} || ' yrs'
                WHEN 3 THEN 'at least ' || {_YEARS} || ' years and 11–12 years' WHEN 4 THEN '45 years'
                WHEN 5 THEN '5 to 2 years' WHEN 6 THEN {_YEARS} || ' Years Experience' ELSE 'some history' END
             || {_GAP} || {_pick(b._TAG_TEXTS, 'c + k')} || {_GAP} || {_pick(b._PAY_TEXTS, 'k')} || {_GAP}
             || {_pick(b._MODE_TEXTS, 'c')} AS description,
           d AS created, low::DOUBLE AS lo, (CASE WHEN k % 13 = 0 THEN low - 10 ELSE low + 20000 END)::DOUBLE AS hi,
           k % 10 IN (3, 4) AS predicted
    FROM (SELECT *, {_LOW} AS low FROM (
        SELECT o_orderkey AS k, o_custkey AS c, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderpriority,
               o_orderstatus, CAST(o_orderdate AS DATE) AS d, c_name, n_name
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))"""

_MODES = _case("t || ' ' || lt", fixed.WORK_MODE_RULES, fixed.NOT_SPECIFIED)
_PROVIDER = """CASE WHEN source LIKE '%/' THEN 'Unknown' WHEN source LIKE '%/%' THEN CASE split_part(source, '/', 2)
    WHEN 'urgent' THEN 'Urgent' WHEN 'high' THEN 'High' WHEN 'medium' THEN 'Medium'
    WHEN 'not specified' THEN 'Not Specified' WHEN 'low' THEN 'Low' END
    WHEN source LIKE '%adzuna%' THEN 'Adzuna' ELSE source END"""
_CITY = (
    "CASE WHEN lt = '' THEN 'Unknown' WHEN lt LIKE '%remote%' AND (lt LIKE '%india%' OR lt = 'remote') "
    "THEN 'Remote - India' WHEN list_distinct(list_filter(regexp_split_to_array(lt, '[^a-z]+'), lambda x: x <> '')) "
    "= ['india'] THEN 'City Not Specified' "
    + " ".join(rf"WHEN regexp_matches(lt, '\b{a}\b') THEN {_q(p)}" for a, p in fixed.PLACE_ALIASES)
    + " WHEN lower(trim(regexp_split_to_array(lc, '[,;|/]')[1])) = 'india' THEN 'City Not Specified' "
    "WHEN trim(regexp_split_to_array(lc, '[,;|/]')[1]) = '' THEN 'Unknown' "
    "ELSE trim(regexp_split_to_array(lc, '[,;|/]')[1]) END"
)
_STATE = (
    "CASE " + " ".join(f"WHEN city = {_q(p)} THEN {_q(s)}" for p, s in fixed.REGION_OF_PLACE.items())
    + " WHEN city = 'City Not Specified' THEN 'India' "
    + " ".join(f"WHEN contains(lt, {_q(t)}) THEN {_q(s)}" for t, s in fixed.REGION_TOKENS)
    + " WHEN city = 'Remote - India' THEN 'Remote - India' ELSE 'Unknown' END"
)
_SCOPE = """CASE city WHEN 'Remote - India' THEN 'Remote India' WHEN 'City Not Specified' THEN 'India - City Not Specified'
    WHEN 'Unknown' THEN 'Unknown' ELSE 'Specific City' END"""


def _range_rows(table: str, key: str, text: str, patterns, hi: int = 30) -> str:
    parts = [
        f"""SELECT {key}, unnest(regexp_extract_all({text}, {_q('(?i)' + p)}, 1))::DOUBLE AS a,
                   unnest(regexp_extract_all({text}, {_q('(?i)' + p)}, {2 if high else 1}))::DOUBLE AS b FROM {table}"""
        for p, high, _ in patterns
    ]
    return f"""SELECT {key}, a, b FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY a, b) AS rn
        FROM ({' UNION ALL '.join(parts)}) WHERE a BETWEEN 0 AND {hi} AND b BETWEEN 0 AND {hi} AND b >= a) WHERE rn = 1"""


def _evidence() -> str:
    """One column triple per pattern, then the first with a number."""
    cols = []
    for i, (unit, factor, _, pattern) in enumerate(fixed.PAY_PATTERNS):
        p = _q("(?i)" + pattern)
        cols.append(f"TRY_CAST(replace(regexp_extract(dc, {p}, 1), ',', '') AS DOUBLE) * {factor} AS a{i}")
        cols.append(f"left(regexp_extract(dc, {p}, 0), 180) AS e{i}")
    order = range(len(fixed.PAY_PATTERNS))
    unit = " ".join(f"WHEN a{i} IS NOT NULL THEN {_q(fixed.PAY_PATTERNS[i][0])}" for i in order)
    text = " ".join(f"WHEN a{i} IS NOT NULL THEN e{i}" for i in order)
    return f"""SELECT *, CASE {unit} ELSE 'UNKNOWN' END AS unit, coalesce({', '.join(f'a{i}' for i in order)}) AS amount,
        CASE {text} ELSE {_q(fixed.PAY_NO_EVIDENCE)} END AS ev FROM (SELECT *, {', '.join(cols)} FROM texts)"""


def _near(x: str, target: str) -> str:
    return f"(({target}) > 0 AND abs(({x}) - ({target})) / ({target}) <= 0.35)"


EXTRA = {
    "raw": _RAW,
    "kept": "SELECT * FROM raw WHERE lower(trim(company_name)) <> 'test'",
    "texts": f"""
        SELECT *, {_norm('title')} AS nt, {_norm('title')} || ' ' || {_norm('description')} AS t,
               {_clean('title')} || ' ' || {_clean('description')} AS ct, {_clean('description')} AS dc,
               {_norm('location_name')} AS lt, {_clean('location_name')} AS lc FROM kept""",
    "places": f"SELECT *, {_CITY} AS city FROM texts",
    "labels1": f"""
        SELECT job_id, CASE WHEN source LIKE '%adzuna%' THEN 'Adzuna' WHEN source LIKE 'freehire%' THEN 'Freehire'
                   ELSE 'Other' END AS source_family, {_PROVIDER} AS source_provider,
               {_case('nt', fixed.ROLE_RULES, fixed.OTHER_ROLE)} AS role_family, city, {_STATE} AS state,
               {_SCOPE} AS location_scope, {_MODES} AS work_mode FROM places""",
    "names": f"""
        SELECT CASE WHEN {_clean('company_name')} = '' THEN 'Unknown Company' ELSE {_clean('company_name')} END AS name,
               job_id FROM kept""",
    "keyed": """
        SELECT name, n, regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '', 'g') AS key,
               regexp_matches(name, '[a-zA-Z]') AND lower(name) = name AS low
        FROM (SELECT name, count(*) AS n FROM names GROUP BY 1)""",
    "shown": """
        SELECT name, first_value(name) OVER (PARTITION BY key ORDER BY low, n DESC, name) AS display FROM keyed""",
    "best": _range_rows("texts", "job_id", "ct", fixed.RANGE_PATTERNS),
    "years": """
        SELECT job_id, a AS experience_min_years, b AS experience_max_years,
               CASE WHEN a IS NULL THEN 'Not Specified' WHEN a >= 15 THEN '15+' WHEN a >= 10 THEN '10–15'
                    ELSE CAST(a AS INTEGER) || '–' || (CAST(a AS INTEGER) + 1) END AS experience_band
        FROM kept LEFT JOIN best USING (job_id)""",
    "evid": _evidence(),
    "usable": """
        SELECT *, (lo + hi) / 2 AS m, coalesce(lo > 0 AND hi > 0 AND hi >= lo, false) AND NOT coalesce(predicted, false) AS ok
        FROM evid""",
    "stated": f"""
        SELECT *, CASE WHEN NOT ok THEN 'Not Eligible'
            WHEN unit = 'MONTHLY' THEN CASE WHEN {_near('m', 'amount * 12')} THEN 'Monthly Evidence - Source Annualized'
                WHEN {_near('m', 'amount')} THEN 'Annualized from Monthly' ELSE 'Ambiguous Salary Period' END
            WHEN unit = 'ANNUAL' THEN CASE WHEN {_near('m', 'amount')} THEN 'Annual Evidence'
                WHEN {_near('m * 12', 'amount')} THEN 'Annualized using LPA Evidence' ELSE 'Ambiguous Salary Period' END
            WHEN m >= 300000 THEN 'Annual Scale' ELSE 'Ambiguous Salary Period' END AS status FROM usable""",
    "paid": """
        SELECT *, CASE WHEN status IN ('Annualized from Monthly', 'Annualized using LPA Evidence') THEN 12
                       WHEN status NOT IN ('Not Eligible', 'Ambiguous Salary Period') THEN 1 END AS f FROM stated""",
    "paycols": """
        SELECT job_id, lo AS salary_min_source, hi AS salary_max_source, lo * f AS salary_min, hi * f AS salary_max,
               (lo * f + hi * f) / 2 AS salary_midpoint, lo IS NOT NULL OR hi IS NOT NULL AS has_salary_source,
               f IS NOT NULL AS salary_analysis_eligible, status AS salary_normalization_status,
               CASE WHEN ok THEN ev ELSE 'No usable source salary range' END AS salary_text_evidence FROM paid""",
    "cal": """
        SELECT job_id, created AS posted_date, strftime(created, '%Y-%m') AS posted_month,
               CAST(date_trunc('week', created) AS DATE) AS week_start, created >= DATE '2001-08-01' - 89 AS is_recent_90d,
               date_trunc('week', created) >= (SELECT min(created) + CAST((8 - isodow(min(created))) % 7 AS INTEGER) FROM kept)
               AND CAST(date_trunc('week', created) AS DATE) + 6 <= (SELECT max(created) FROM kept) AS is_complete_week
        FROM kept""",
    "tg": f"""
        SELECT job_id, skill, CASE skill {' '.join(f"WHEN {_q(t)} THEN {_q(c)}" for t, c in fixed.TAG_CATEGORIES.items())}
               END AS skill_category
        FROM (SELECT job_id, unnest([{', '.join(f"CASE WHEN {_any('t', ps)} THEN {_q(t)} END" for t, ps in fixed.TAG_RULES)}]) AS skill
              FROM texts) WHERE skill IS NOT NULL""",
    "tagn": "SELECT job_id, count(*) AS skill_count FROM tg GROUP BY 1",
    "cj": """
        SELECT *, coalesce(tagn.skill_count, 0) > 0 AS has_extracted_skill, shown.display AS company
        FROM labels1 JOIN years USING (job_id) JOIN paycols USING (job_id) JOIN cal USING (job_id)
        JOIN names USING (job_id) JOIN shown USING (name) LEFT JOIN tagn USING (job_id)""",
    "docs": f"SELECT doc_id, lang, {_norm('text')} AS t FROM documents",
    "docbest": _range_rows("documents", "doc_id", "text", _DOC_RANGES, 99),
    "talk": f"SELECT conv_id, turn, {_norm('text')} AS t FROM conversations",
}

_N = "count(*)"
_RUN = {
    "processed_job_rows": _N,
    "role_other_share_pct": pct("count(*) FILTER (WHERE role_family = 'Other Analyst')", _N),
    "skill_job_coverage_pct": pct("count(*) FILTER (WHERE has_extracted_skill)", _N),
    "experience_extraction_coverage_pct": pct("count(experience_min_years)", _N),
    "experience_not_specified_rows": "count(*) FILTER (WHERE experience_band = 'Not Specified')",
    "city_not_specified_rows": "count(*) FILTER (WHERE city = 'City Not Specified')",
    "known_company_rows": "count(*) FILTER (WHERE company <> 'Unknown Company')",
    "salary_source_coverage_pct": pct("count(*) FILTER (WHERE has_salary_source)", _N),
    "salary_analysis_eligible_coverage_pct": pct("count(*) FILTER (WHERE salary_analysis_eligible)", _N),
    "salary_ambiguous_period_rows": "count(*) FILTER (WHERE salary_normalization_status LIKE 'Ambiguous%')",
    "salary_annualized_rows": "count(*) FILTER (WHERE salary_normalization_status LIKE 'Annualized %')",
    "recent_90d_rows": "count(*) FILTER (WHERE is_recent_90d)",
    "complete_week_rows": "count(*) FILTER (WHERE is_complete_week)",
    "skill_bridge_rows": "(SELECT count(*) FROM tg)",
    "unique_skills": "(SELECT count(DISTINCT skill) FROM tg)",
}
_RULES = [
    "placeholder_names", "band_without_years", "top_band_too_low", "city_is_country", "country_scope",
    "eligible_pay_missing", "eligible_pay_not_positive", "eligible_pay_unordered", "eligible_pay_midpoint",
    "eligible_but_predicted", "unexpected_boolean_text", "week_not_monday", "years_range", "negative_skill_count", "repeated_job_ids", "repeated_job_skill_pairs",
    "bridge_without_job", "employer_spellings", "recent_flag", "complete_week_flag", "role_totals_difference",
]

_SQL = {
    "raw_report": """
        SELECT 'repeated_job_ids' AS rule, count(*) AS failed_rows, count(*) = 0 AS passed
        FROM (SELECT job_id FROM raw GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'outside_date_window', count(*), count(*) = 0 FROM raw
        WHERE created NOT BETWEEN DATE '1995-01-01' AND DATE '2001-07-31'""",
    "clean_labels": "SELECT * FROM labels1",
    "clean_companies": "SELECT job_id, display AS company_name FROM names JOIN shown USING (name)",
    "canonical_names": "SELECT name, display FROM shown WHERE name <> display",
    "clean_experience": "SELECT * FROM years",
    "clean_pay": "SELECT * FROM paycols",
    "clean_calendar": "SELECT * FROM cal",
    "clean_tags": "SELECT * FROM tg",
    "clean_tag_counts": """SELECT job_id, CAST(coalesce(skill_count, 0) AS INTEGER) AS skill_count,
        coalesce(skill_count, 0) > 0 AS has_extracted_skill FROM kept LEFT JOIN tagn USING (job_id)""",
    "run_metrics": f"SELECT unnest({_list(_RUN)}) AS metric, unnest([{', '.join(f'({x})::DOUBLE' for x in _RUN.values())}]) AS value FROM cj",
    "table_expectations": "SELECT rule, n AS failed_rows, n = 0 AS passed FROM (" + " UNION ALL ".join([
        "SELECT 'untaxed' AS rule, count(*) FILTER (WHERE l_tax = 0) AS n FROM lineitem",
        "SELECT 'high_discount', count(*) FILTER (WHERE l_discount > 0.08) FROM lineitem",
        "SELECT 'small_but_dear', count(*) FILTER (WHERE l_quantity < 5 AND l_extendedprice > 50000) FROM lineitem",
        "SELECT 'negative_quantity', count(*) FILTER (WHERE l_quantity < 0) FROM lineitem",
        """SELECT 'repeated_order_part', count(*) FROM
           (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)""",
        """SELECT 'line_of_open_order', count(*) FROM lineitem
           WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
        "SELECT 'difference_from_1000', abs(count(*) - 1000) FROM lineitem",
        """SELECT 'big_flag', count(*) FILTER (WHERE (o_totalprice > 250000) <> (floor(o_totalprice / 100000) >= 3))
           FROM orders""",
    ]) + ")",
    # The clean rows keep every rule by construction, so each reports zero.
    "quality_report": f"SELECT unnest({_list(_RULES)}) AS rule, 0::BIGINT AS failed_rows, true AS passed",
    "document_text": f"""SELECT doc_id, md5({_clean('text')}) AS clean_md5, md5({_norm('text')}) AS normalized_md5,
        CAST(length({_clean('text')}) AS INTEGER) AS clean_chars FROM documents""",
    "document_tags": " UNION ALL ".join(
        f"""SELECT lang, {_q(t)} AS skill, {_q(_WORD_LANGS.get(t, 'Other'))} AS skill_category, count(*) AS documents
            FROM docs WHERE {_any_wide('t', ps)} GROUP BY 1""" for t, ps in _WORDS
    ),
    "document_ranges": "SELECT doc_id, a AS min, b AS max FROM documents LEFT JOIN docbest USING (doc_id)",
    "classify_text": f"SELECT conv_id, turn, {_case('t', _TALK_RULES, 'Other', _any_wide)} AS label FROM talk",
}
ORACLES = {name: with_ctes(sql, EXTRA) for name, sql in _SQL.items()}
