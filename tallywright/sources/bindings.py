"""Logical tables (jobs, bridge, raw postings) bound to a folder of order tables.

``orders`` play the postings, ``customer`` the employers, ``nation`` and ``region`` the
places, and the parts of an order's lines its tags. Frames are lazy and pruned: a plan reads
only the columns of the analysis on top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.calendar import month_key, recent_flag, week_start, with_complete_week
from tallywright.functions.labels import band
from tallywright.functions.patterns import array_sql, quoted

ORDERS_END = "2001-08-01"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def texts(spark: SparkSession, root: str, name: str, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Some columns of a table of long texts; ``partitions``: dealt to so many tasks first (see ``raw_postings``)."""
    df = table(spark, root, name).select(*columns)
    return df.repartition(partitions) if partitions else df


def source_text() -> Column:
    """Four forms of a source: a board, provider paths with and without a name, and other text."""
    k = F.col("o_custkey") % 4
    return (
        F.when(k == 0, "adzuna_in")
        .when(k == 1, F.concat(F.lit("freehire/"), F.lower(F.substr("o_orderpriority", F.lit(3)))))
        .when(k == 2, "freehire/")
        .otherwise(F.concat(F.lit("Board "), F.col("o_orderstatus")))
    )


def jobs(spark: SparkSession, root: str) -> DataFrame:
    """One row per order, without employer and place names (see ``with_employer``)."""
    day = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    years = F.when(status != "P", F.floor(F.col("o_totalprice") / 25000).cast("double"))
    df = table(spark, root, "orders").withColumn("years", years).select(
        F.col("o_orderkey").alias("job_id"),
        F.col("o_custkey").alias("company_key"),
        F.col("o_orderpriority").alias("role_family"),
        status.alias("work_mode"),
        source_text().alias("source"),
        day.alias("posted_date"),
        month_key(day).alias("posted_month"),
        week_start(day).alias("week_start"),
        recent_flag(day, ORDERS_END).alias("is_recent_90d"),
        F.col("years").alias("experience_min_years"),
        band("years").alias("experience_band"),
        (status != "P").alias("has_salary_source"),
        (status == "F").alias("salary_analysis_eligible"),
        F.col("o_totalprice").alias("salary_midpoint"),
        F.when(status == "F", fixed.STATUS_SCALE).when(status == "O", fixed.STATUS_AMBIGUOUS).alias(
            "salary_normalization_status"
        ),
    )
    return with_complete_week(df, "posted_date")


def employers(spark: SparkSession, root: str) -> DataFrame:
    """(company_key, company_name, city, state, location_key, location_scope) per customer."""
    place = F.col("n_nationkey")
    scope = (
        F.when(place == 0, fixed.UNKNOWN).when(place == 1, fixed.SCOPE_REMOTE)
        .when(place == 2, fixed.SCOPE_COUNTRY).otherwise(fixed.SCOPE_CITY)
    )
    name = F.when(F.col("c_custkey") % 100 == 0, fixed.UNKNOWN_COMPANY).otherwise(F.col("c_name"))
    places = table(spark, root, "nation").join(
        table(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, root, "customer").join(places, F.col("c_nationkey") == place).select(
        F.col("c_custkey").alias("company_key"), name.alias("company_name"), F.col("n_name").alias("city"),
        F.col("r_name").alias("state"), place.alias("location_key"), scope.alias("location_scope"),
    )


def with_employer(df: DataFrame, spark: SparkSession, root: str) -> DataFrame:
    """Jobs with employer and place columns."""
    return df.join(employers(spark, root), "company_key")


def employer_totals(spark: SparkSession, root: str) -> DataFrame:
    """Orders counted per customer before the customer table is joined: a customer with a third
    of all orders is one row by then."""
    counts = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("company_key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.join(employers(spark, root), "company_key")


def bridge(spark: SparkSession, root: str) -> DataFrame:
    """Distinct (order, brand) with a category per brand.

    Repeated links collapse before the shuffle, so one order with very many lines sends at most
    one row per brand and task.
    """
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_partkey")
    brands = table(spark, root, "part").select("p_partkey", "p_brand")
    links = lines.join(brands, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("job_id"), F.col("p_brand").alias("skill")
    ).dropDuplicates()
    group = F.substr("skill", F.lit(7)).cast("int") % 5
    return links.withColumn("skill_category", F.concat(F.lit("Category "), group.cast("string")))


BRANDS = ["Brand#1", "Brand#7", "Brand#13", "Brand#19", "Brand#25"]
BRAND = "Brand#7"

_TITLES = [
    "Senior Data Analyst", "Business Data Analyst", "Business  Analyst", "BI Analyst II", "MIS Analyst",
    "Product Analytics Lead", "Customer Insights Analyst", "Marketing Analyst", "Data Quality & Governance",
    "Operations Analyst", "Risk Analytics Analyst", "Pricing Analyst", "Strategy Analyst", "Analytics Associate",
    "R&D Business Analyst", "Analyst", "Data\tAnalyst",
]
_TAG_TEXTS = [
    "SQL and Python", "MS Excel, PowerBI", "Power BI; Tableau", "R programming", "SQL Server on Azure",
    "ELT, not belts", "belts", "A/B testing", "ETL with Apache Spark & AWS", "data modelling", "ml models, Git",
]
_PAY_TEXTS = [
    "Salary up to Rs 25,000 per month", "12 LPA", "CTC of 6.5 lakhs per annum", "Budget 900,000 per annum",
    "10-12.5 LPA", "Rs. 30,000/month", "no figure",
]
_MODE_TEXTS = ["Hybrid role", "Work from home", "onsite", "remote and hybrid", "in-office", "-"]
_PLACES = [
    "Navi Mumbai, Maharashtra", "India, India", "Remote, India", "remote", "Remote - Karnataka, India",
    "Mohali, Punjab", "", "New Delhi", "Bangalore", "Pune / Thane", "Trivandrum", "india; Gujarat",
]


def _pick(texts: list[str], by: str) -> str:
    return f"element_at({array_sql(texts)}, cast(({by}) % {len(texts)} + 1 AS int))"


_YEARS = "years"
_EXPERIENCE = f"""CASE k % 8
    WHEN 0 THEN concat({_YEARS}, '-', cast(c % 18 + 3 AS string), ' years of experience')
    WHEN 1 THEN concat({_YEARS}, '+ years')
    WHEN 2 THEN concat('Minimum of ', {_YEARS}, ' yrs')
    WHEN 3 THEN concat('at least ', {_YEARS}, ' years and 11–12 years')
    WHEN 4 THEN '45 years' WHEN 5 THEN '5 to 2 years' WHEN 6 THEN concat({_YEARS}, ' Years Experience')
    ELSE 'some history' END"""
_COMPANY = """CASE WHEN k % 97 = 0 THEN ' Test ' WHEN c % 50 = 0 THEN '  '
    WHEN k % 5 = 0 THEN lower(c_name) WHEN k % 5 = 1 THEN upper(c_name) WHEN k % 5 = 2 THEN concat(c_name, ', ')
    WHEN k % 5 = 3 THEN replace(c_name, 'o', 'ó') ELSE c_name END"""
_LOW = """CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN 0 WHEN k % 3 = 0 THEN price
    WHEN k % 3 = 1 THEN floor(price / 10) ELSE price * 4 END"""


def raw_postings(spark: SparkSession, root: str, partitions: int | None = None) -> DataFrame:
    """A raw posting per order: messy text composed from its columns, growing with ``orders``.

    ``partitions``: the few short columns that a posting is composed from are dealt to so many tasks first. The order
    table may be one row group, which is one task however few bytes it has, and the text rules are what costs time.
    """
    df = table(spark, root, "orders").join(
        table(spark, root, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    if partitions:
        df = df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus", "c_name", "n_name").repartition(partitions)
    named = df.withColumn("source", source_text()).selectExpr(
        "*", "o_orderkey AS k", "o_custkey AS c", "floor(o_totalprice) AS price", "cast(o_custkey % 18 AS string) AS years"
    ).selectExpr("*", f"{_LOW} AS low")
    gap = quoted(".\n  ")
    return named.selectExpr(
        "cast(k AS string) AS job_id",
        "source",
        f"{_pick(_TITLES, 'k')} AS title",
        f"{_COMPANY} AS company_name",
        f"CASE WHEN k % 19 = 0 THEN concat(n_name, ' | Kerala') WHEN k % 23 <> 0 THEN {_pick(_PLACES, 'c')} END AS location_name",
        f"concat({_EXPERIENCE}, {gap}, {_pick(_TAG_TEXTS, 'c + k')}, {gap}, {_pick(_PAY_TEXTS, 'k')}, {gap}, "
        f"{_pick(_MODE_TEXTS, 'c')}) AS description",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS created",
        "cast(low AS string) AS salary_min",
        "cast(CASE WHEN k % 13 = 0 THEN low - 10 ELSE low + 20000 END AS string) AS salary_max",
        "CASE k % 10 WHEN 3 THEN '1' WHEN 4 THEN ' Yes' WHEN 5 THEN 'False' END AS salary_is_predicted",
        *[f"cast(NULL AS string) AS {c}" for c in ("contract_type", "contract_time", "redirect_url")],
    )
