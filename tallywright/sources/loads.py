"""Loads that add to a stored star.

A load inserts what is not there yet and leaves the rest alone: names keep the keys of the load that brought them, jobs
that are stored (by job_id) are skipped, and so are links. It can be run again, also after it broke off halfway. Nothing
that is stored is rewritten: new rows become new files, those of the fact in the folders of their months.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions.calendar import calendar
from tallywright.operators.keys import numbered, part_of, registered, unknown
from tallywright.plans.star import FACT_COLUMNS, Star, _PLACE, fact_rows, key_lookup
from tallywright.session import materialize
from tallywright.sources.postings import within, write_table

#: Dimension -> its key and its natural columns.
KEYS = {
    "dim_role": ("role_key", ["role_family"]),
    "dim_company": ("company_key", ["company_name"]),
    "dim_location": ("location_key", _PLACE),
    "dim_skill": ("skill_key", ["skill"]),
}


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` as it is now, or an empty one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _nullable(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])


def _add(rows: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Append ``rows`` and read the whole table."""
    schema = _nullable(rows)
    write_table(rows, path, partition_by, mode="append")
    return rows.sparkSession.read.schema(schema).parquet(path)


def load_dimension(names: DataFrame, path: str, natural: list[str], key: str) -> DataFrame:
    """Add the names that the dimension at ``path`` lacks; the whole dimension."""
    schema = T.StructType([*_nullable(names).fields, T.StructField(key, T.LongType())])
    known = stored_table(names.sparkSession, path, schema)
    return _add(registered(names, known, natural, key).select(*schema.names), path)


def load_star(jobs: DataFrame, bridge: DataFrame, root: str, fixed_dates: bool = False) -> DataFrame:
    """Insert clean ``jobs`` and their ``bridge`` into the star at ``root``; how many rows each table had before and has now.

    Of rows of one job_id in ``jobs`` the earliest is taken. Jobs are looked up among all stored job_ids, one column of
    the fact; with ``fixed_dates``, the caller's word that a job never changes its date, only among those of the months
    of ``jobs``. Links are added to jobs of this load and to stored ones; links to jobs that are nowhere are left out.
    One load runs at a time. Returns (table, rows_before, rows_after) and adds the same to the table ``loads``.
    """
    spark = jobs.sparkSession
    rows = materialize(fact_rows(jobs).withColumn("year_month", F.date_format("date_key", "yyyy-MM")), name="load")
    names = {
        "dim_role": rows.select("role_family"),
        "dim_company": rows.select("company_name"),
        "dim_location": rows.select(*_PLACE),
        "dim_skill": bridge.select("skill", "skill_category"),
    }
    counts = {name: [_size(spark, f"{root}/{name}")] for name in Star.names()}
    dims = {name: load_dimension(own, f"{root}/{name}", KEYS[name][1], KEYS[name][0]) for name, own in names.items()}

    days = calendar(rows, "date_key")
    known_days = stored_table(spark, f"{root}/dim_date", _nullable(days))
    _add(unknown(days, known_days, ["date_key"]), f"{root}/dim_date")

    # the fact: one row for each new job, keys looked up in the dimensions as they are now
    schema = T.StructType([*[_fact_field(rows, dims, c) for c in FACT_COLUMNS], T.StructField("year_month", T.StringType())])
    known = stored_table(spark, f"{root}/fact_jobs", schema)
    seen = known
    if fixed_dates:
        seen = known.where(F.col("year_month").isin([r["year_month"] for r in rows.select("year_month").distinct().collect()]))
    # dealt by the parts of their numbers once, rows are chosen and numbered in one order; the keys of dimensions come after
    fresh = unknown(rows, seen, ["job_id"]).withColumn("_part", part_of(["job_id"])).repartition("_part")
    order = Window.partitionBy("_part", "job_id").orderBy("date_key", "title", "company_name")
    fresh = fresh.withColumn("_turn", F.row_number().over(order)).where("_turn = 1").drop("_turn")
    largest = known.agg(F.coalesce(F.max("job_key"), F.lit(0)).alias("largest"))
    fresh = numbered(fresh, ["job_id"], "job_key", largest.scalar())
    for name in ("dim_role", "dim_company", "dim_location"):
        key, natural = KEYS[name]
        fresh = key_lookup(fresh, dims[name], natural, key)
    fresh = fresh.select(*schema.names)
    fact = _add(fresh, f"{root}/fact_jobs", ("year_month",))

    links = bridge.select("job_id", "skill").join(fact.select("job_id", "job_key"), "job_id")
    links = key_lookup(links, dims["dim_skill"], ["skill"], "skill_key").select("job_key", "skill_key").distinct()
    known_links = stored_table(spark, f"{root}/bridge_job_skill", _nullable(links))
    _add(unknown(links, known_links, ["job_key", "skill_key"]), f"{root}/bridge_job_skill")

    report = spark.createDataFrame([(name, *before, _size(spark, f"{root}/{name}")) for name, before in counts.items()], "table string, rows_before long, rows_after long")
    report.coalesce(1).withColumn("loaded_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/loads")
    return report


def _size(spark: SparkSession, path: str) -> int:
    """Rows of a stored table, from the footers of its files."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0


def _fact_field(rows: DataFrame, dims: dict[str, DataFrame], name: str) -> T.StructField:
    keys = {"job_key", *[key for key, _ in KEYS.values()]}
    return T.StructField(name, T.LongType() if name in keys else rows.schema[name].dataType)


def read_loaded(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> Star:
    """The star that loads have built, of the days from ``first`` to ``last``: other months of the fact are not read."""
    tables = {name: spark.read.parquet(f"{root}/{name}") for name in Star.names()}
    return Star(**{**tables, "fact_jobs": within(tables["fact_jobs"], first, last)})


def write_bridge(bridge: DataFrame, path: str) -> None:
    """The entity-tag bridge as a table of its own: job_id, skill, skill_category, once each."""
    write_table(bridge.select("job_id", "skill", "skill_category").distinct(), path)


def read_bridge(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("job_id", "skill", "skill_category")
