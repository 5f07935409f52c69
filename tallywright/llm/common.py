"""Reading the tables, cutting lineage in the shared folder, and ranks that need no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywright.session import materialize


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the folder of ``spark.checkpoint.dir`` and read from there."""
    return materialize(df, name=name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, carry: str | None = None) -> DataFrame:
    """doc_id, carried (the column ``carry`` as text, or null) and whole text, null texts as empty ones; all other columns go."""
    carried = F.col(carry) if carry else F.lit(None)
    return docs.select(F.col("doc_id").cast("long"), carried.cast("string").alias("carried"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def hex_draw(*parts: Column | str | int) -> Column:
    """A whole number below 2**52 drawn from MD5 of the parts joined by ``:``; nulls count as empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts).cast("binary")), 1, 13), 16, 10).cast("long")


def gapless(df: DataFrame, groups: list[str], order: list[Column], name: str, salt: Column, salts: int = 256) -> DataFrame:
    """Adds ``name``, 0, 1, 2, ... within each group, with no group in a single task.

    The rows of a group are dealt to ``salts`` parts by ``salt``; parts are counted map-side, and a row's number is
    the count of the parts before its own plus its place there.
    """
    df = df.withColumn("_part", F.pmod(salt, F.lit(salts)).cast("int"))
    sizes = df.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*groups, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*groups, "_part").orderBy(*order)).cast("long") - 1
    return df.withColumn(name, place).join(sizes, [*groups, "_part"]).withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")
