"""Raw postings in, clean tables and result tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions import fixed
from tallywright.functions.text import parse_bool, to_number
from tallywright.operators.sets import require_columns

POSTING_SCHEMA = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "job_id", "source", "title", "company_name", "location_name", "description", "created",
        "salary_min", "salary_max", "salary_is_predicted", "contract_type", "contract_time", "redirect_url",
    )
])
REQUIRED_POSTING = ["job_id", "source", "title", "company_name", "location_name", "description", "created"]
REQUIRED_CLEAN = [
    "job_id", "posted_date", "week_start", "role_family", "company_name", "city", "location_scope",
    "experience_min_years", "experience_band", "has_extracted_skill", "has_salary_source",
    "salary_analysis_eligible", "salary_is_predicted", "salary_min", "salary_max", "salary_midpoint",
    "is_recent_90d", "is_complete_week",
]
REQUIRED_BRIDGE = ["job_id", "skill", "skill_category"]
_NUMBERS = [
    "experience_min_years", "experience_max_years", "salary_min_source", "salary_max_source", "salary_min",
    "salary_max", "salary_midpoint",
]
_FLAGS = [
    "has_salary_source", "salary_analysis_eligible", "has_extracted_skill", "is_recent_90d", "is_complete_week",
]


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = fixed.NULL_TOKENS) -> DataFrame:
    """Text cells that spell a missing value become null."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(list(tokens)), F.col(c)) for c in texts})


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """Declared schema matched to the header by name; optional columns absent from the files are null.

    A file whose header has not the columns of the first one in the same order fails the
    query, and so does a missing ``required`` column, before any job. A quoted cell may span
    lines, so one file is one task: give many files, not one large one.
    """
    options = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}
    header = spark.read.options(**options).csv(path).columns
    text = spark.read.options(**options, enforceSchema=False).schema(
        T.StructType([T.StructField(c, T.StringType()) for c in header])
    ).csv(path).toDF(*[c.lstrip("﻿") for c in header])
    names = require_columns(text, required).columns
    wanted = [F.col(f.name) if f.name in names else F.lit(None).cast("string").alias(f.name) for f in schema.fields]
    return null_tokens_to_null(text.select(*wanted))


def read_postings(spark: SparkSession, path: str, schema: T.StructType = POSTING_SCHEMA, fmt: str = "csv") -> DataFrame:
    """Raw postings; every column is text, so ids keep their form and bad numbers stay visible."""
    if fmt == "csv":
        return _read_csv(spark, path, schema, REQUIRED_POSTING)
    df = require_columns(spark.read.format(fmt).load(path), REQUIRED_POSTING)
    names = df.columns
    return df.select(*[
        F.col(f.name).cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet"
) -> None:
    """Write a table. Rows are rebalanced by partition value first: AQE splits large values
    over many files and merges small ones, so a hot month is neither one task nor many crumbs.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_clean(jobs: DataFrame, root: str) -> None:
    """The clean table (fixed columns in order, then ``tags``), partitioned by month."""
    write_table(jobs.select(*fixed.CLEAN_COLUMNS, "tags"), f"{root}/jobs", ["posted_month"])


def read_clean(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(jobs, bridge) of a written clean table; the bridge reads only the id and tag columns."""
    from tallywright.plans.clean import bridge_of

    table = spark.read.parquet(f"{root}/jobs")
    return table.select(*fixed.CLEAN_COLUMNS), bridge_of(table)


def read_clean_csv(spark: SparkSession, jobs_path: str, bridge_path: str) -> tuple[DataFrame, DataFrame]:
    """(jobs, bridge) from delimited exports: dates, numbers and flags parsed, bad cells null."""
    jobs = _read_csv(spark, jobs_path, T.StructType([T.StructField(c, T.StringType()) for c in fixed.CLEAN_COLUMNS]), REQUIRED_CLEAN)
    jobs = jobs.withColumns({
        "created_at": F.try_to_timestamp("created_at"),
        "posted_date": F.col("posted_date").try_cast("date"),
        "week_start": F.coalesce(
            F.col("week_start").try_cast("date"),
            F.date_trunc("week", F.col("posted_date").try_cast("date")).cast("date"),
        ),
        "skill_count": F.col("skill_count").try_cast("int"),
        **{c: to_number(F.col(c)) for c in _NUMBERS},
        **{c: parse_bool(F.col(c)) for c in _FLAGS},
    })
    bridge = _read_csv(spark, bridge_path, T.StructType([T.StructField(c, T.StringType()) for c in REQUIRED_BRIDGE]), REQUIRED_BRIDGE)
    return jobs, bridge


def write_results(results: dict[str, DataFrame], root: str, fmt: str = "csv") -> None:
    """One folder per result table."""
    for name, df in results.items():
        write_table(df, f"{root}/{name}", fmt=fmt)


def write_star(star, root: str) -> None:
    """All star tables, overwritten; the fact is partitioned by month, see ``read_star``. For adding to one: ``loads``."""
    for name, df in star.tables().items():
        if name == "fact_jobs":
            df = df.withColumn("year_month", F.date_format("date_key", "yyyy-MM"))
            write_table(df, f"{root}/{name}", ["year_month"])
        else:
            write_table(df, f"{root}/{name}")


def within(fact: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Rows of a stored fact from day ``first`` to day ``last`` (ISO dates, both included; None: open).

    The months are filtered too, so only the folders of these months are listed and read; the month column then goes.
    """
    for day, keep in ((first, lambda c, x: c >= x), (last, lambda c, x: c <= x)):
        if day is not None:
            fact = fact.where(keep(F.col("year_month"), F.lit(day[:7])) & keep(F.col("date_key"), F.lit(day).cast("date")))
    return fact.drop("year_month")


def read_star(spark: SparkSession, root: str, first: str | None = None, last: str | None = None):
    """The stored star, of the days from ``first`` to ``last``: other months of the fact are not read."""
    from tallywright.plans.star import Star

    tables = {name: spark.read.parquet(f"{root}/{name}") for name in Star.names()}
    tables["fact_jobs"] = within(tables["fact_jobs"], first, last)
    return Star(**tables)


def write_star_jdbc(star, url: str, properties: dict[str, str], schema: str, mode: str = "overwrite") -> None:
    """Optional export of the star to an external database, written in parallel by partition."""
    for name, df in star.tables().items():
        df.write.jdbc(url, f"{schema}.{name}", mode=mode, properties=properties)
