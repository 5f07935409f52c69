"""Tables written in order, with the position of each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.session import materialize


def write_sorted(df: DataFrame, path: str, order: list[Column]) -> DataFrame:
    """Write ``df`` in ``order``, its files too, with ``position`` from 1, and read it.

    Rows are dealt to ranges of the order and sorted within; a row's position is its place there plus the rows of the
    ranges before, so only one count for each range meets. Rows that tie keep no order among themselves: end ``order`` with
    a column that tells all rows apart.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = materialize(ranged, name="ranges")
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("_part", (F.col("_first") - before - 1).alias("_shift"))
    placed = ranged.join(shifts, part == F.col("_part")).withColumn("position", F.col("_at") - F.col("_shift")).drop("_at", "_part", "_shift")
    placed.repartitionByRange("position").sortWithinPartitions("position").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
