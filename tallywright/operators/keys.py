"""Whole-number keys that stay the same from load to load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names are dealt to 16 ** DIGITS parts by hash; only the counts of parts meet in one task.
DIGITS = 3


def part_of(natural: Sequence[str]) -> Column:
    """The part of a name of one or more columns: the first digits of its MD5."""
    return F.substring(F.md5(F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural]).cast("binary")), 1, DIGITS)


def numbered(names: DataFrame, natural: Sequence[str], key: str, after: Column | int = 0) -> DataFrame:
    """Distinct ``names`` with ``key``: ``after`` + 1, + 2, ... by part and then by name, without gaps.

    A name's number is the count of the parts before its own plus its place there, so it depends on the names only, and
    no task sorts more than a part. ``names`` may have their ``_part`` already, by which they then are best dealt, too.
    """
    if "_part" not in names.columns:
        names = names.withColumn("_part", part_of(natural))
    sizes = names.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*natural))
    after = after if isinstance(after, Column) else F.lit(after)
    out = names.withColumn("_place", place).join(sizes, "_part")
    return out.withColumn(key, (after + F.col("_before") + F.col("_place")).cast("bigint")).drop("_part", "_before", "_place")


def unknown(names: DataFrame, known: DataFrame, natural: Sequence[str]) -> DataFrame:
    """Rows of ``names`` whose natural key isn't in ``known``; nulls are equal to nulls."""
    side = known.select(*[F.col(c).alias(f"_k_{c}") for c in natural])
    return names.join(side, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in natural], "left_anti")


def registered(names: DataFrame, known: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """The rows of ``names`` to add to ``known``: names that it lacks, once each, numbered after its largest ``key``.

    Of rows that share a name the least in its other columns is taken. Names that are known keep their keys.
    """
    others = [c for c in names.columns if c not in natural]
    least = F.min(F.struct(*others)).alias("_o") if others else F.count(F.lit(1)).alias("_o")
    once = names.groupBy(*natural).agg(least)
    once = once.select(*natural, *[F.col(f"_o.{c}").alias(c) for c in others])
    largest = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("largest"))
    return numbered(unknown(once, known, natural), natural, key, largest.scalar())
