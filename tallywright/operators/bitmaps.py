"""Exact distinct counts that roll up: bitmaps over dense numbers in place of the names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.operators.keys import numbered


def bitmaps(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, bucket, bits): per group, which of the distinct ``names`` it has, 32,768 of them to a bitmap of 4 KB.

    Names are numbered without gaps by parts of a hash, and rows meet their numbers by a join on the name, so a task of
    the last aggregation sees runs of numbers, that is few buckets. A name with a null is not counted. Repeated rows of
    a group collapse before anything else is done with them. Bitmaps of a group can be merged in any order, so the
    result is the one to store: ``distinct`` counts for any coarser grouping of it.
    """
    rows = rows.select(*keys, *names).dropna(subset=list(names)).distinct()
    known = numbered(rows.select(*names).distinct(), names, "_number").select(*[F.col(c).alias(f"_k_{c}") for c in names], "_number")
    found = rows.join(known, [F.col(c) == F.col(f"_k_{c}") for c in names])
    return found.groupBy(*keys, F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits")
    )


def merged() -> Column:
    """Aggregate of the bitmaps of one bucket: how many names are in any of them."""
    return F.bitmap_count(F.bitmap_or_agg("bits"))


def distinct(stored: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct names per group of ``keys``, which may be any of the columns that the bitmaps were made by."""
    buckets = stored.groupBy(*keys, "bucket").agg(merged().alias("_n"))
    return buckets.groupBy(*keys).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))
