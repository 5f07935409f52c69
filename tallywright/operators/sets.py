"""Membership of entities in other tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import fixed


def require_columns(df: DataFrame, names) -> DataFrame:
    """Fail before any job when a column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError("missing required columns: " + ", ".join(missing))
    return df


def apply_filters(df: DataFrame, filters: Sequence[Column]) -> DataFrame:
    for condition in filters:
        df = df.where(condition)
    return df


def filtered_tags(jobs: DataFrame, bridge: DataFrame, filters: Sequence[Column] = (), entity: str = "job_id") -> tuple[DataFrame, DataFrame]:
    """The jobs that pass ``filters``, and their tags: filters act on tags through the id."""
    jobs = apply_filters(jobs, filters)
    return jobs, bridge.join(jobs.select(entity), entity, "left_semi")


def has_tag(
    df: DataFrame, bridge: DataFrame, value: str = fixed.COMPARED_TAG, entity: str = "job_id", tag: str = "skill",
    flag: str = "has_tag",
) -> DataFrame:
    """Flag the entities that carry a tag (EXISTS as a column)."""
    ids = bridge.where(F.col(tag) == value).select(entity).distinct().withColumn(flag, F.lit(True))
    return df.join(ids, entity, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def with_tag_flag(df: DataFrame, bridge: DataFrame, entity: str = "job_id") -> DataFrame:
    """Add ``has_extracted_skill`` and ``skill_count`` from a bridge of distinct links."""
    sizes = bridge.groupBy(entity).agg(F.count(F.lit(1)).cast("int").alias("skill_count"))
    out = df.join(sizes, entity, "left").withColumn("skill_count", F.coalesce("skill_count", F.lit(0)))
    return out.withColumn("has_extracted_skill", F.col("skill_count") > 0)


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(key).distinct(), key, "left_anti")


def intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key is in ``b``."""
    return a.join(b.select(key), key, "left_semi")


def is_subset(a: DataFrame, b: DataFrame, key: str) -> bool:
    """True when every key of ``a`` is in ``b``."""
    return a.join(b.select(key), key, "left_anti").isEmpty()
