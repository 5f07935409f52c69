"""Data-quality expectations: each rule reports how many rows break it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _report(counts: DataFrame) -> DataFrame:
    names = counts.columns
    rows = counts.unpivot([], [F.col(f"`{x}`") for x in names], "rule", "failed_rows")
    return rows.select("rule", F.col("failed_rows").cast("bigint").alias("failed_rows"),
                       (F.col("failed_rows") == 0).alias("passed"))


def expect(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, failed_rows, passed). A rule is the condition a *bad* row meets; all run in one pass."""
    return _report(df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in rules.items()]))


def expect_unique(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
    return _report(repeated.agg(F.count(F.lit(1)).alias(rule)))


def expect_foreign_key(child: DataFrame, parent: DataFrame, key: str, rule: str) -> DataFrame:
    """Number of child rows without a parent."""
    orphans = child.join(parent.select(key), key, "left_anti")
    return _report(orphans.agg(F.count(F.lit(1)).alias(rule)))


def expect_count(df: DataFrame, expected: int, rule: str) -> DataFrame:
    """Difference between the number of rows and a pinned number."""
    return _report(df.agg(F.abs(F.count(F.lit(1)) - F.lit(expected)).alias(rule)))


def expect_sum(parts: DataFrame, n: str, df: DataFrame, rule: str) -> DataFrame:
    """Difference between the sum of counts and the number of rows they count."""
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _report(parts.agg(F.abs(F.coalesce(F.sum(n), F.lit(0)) - rows).alias(rule)))


def expect_recomputed(df: DataFrame, flag: str, again: Column, rule: str) -> DataFrame:
    """Rows whose stored flag differs from its recomputation."""
    return expect(df, {rule: ~F.col(flag).eqNullSafe(again)})


def union_reports(*reports: DataFrame) -> DataFrame:
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out
