"""One display name per employer, whatever its spelling."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.text import clean_text


def _fold_ascii():
    """NFKD without the non-ASCII part; Spark has no built-in for it."""

    def fold(names: pd.Series) -> pd.Series:
        return names.map(
            lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode("ascii"), na_action="ignore"
        )

    return F.pandas_udf(fold, "string")


def ascii_key(df: DataFrame, col: str, key: str = "name_key") -> DataFrame:
    """Add the folded key ``[a-z0-9]*`` of a name. Call it on distinct names.

    Python sees only the names that have a non-ASCII character.
    """
    name = clean_text(F.col(col))
    plain = F.octet_length(name) == F.length(name)
    return _keyed(df.where(plain), key, name).unionByName(_keyed(df.where(~plain), key, _fold_ascii()(name)))


def _keyed(df: DataFrame, key: str, text: Column) -> DataFrame:
    return df.withColumn(key, F.regexp_replace(F.lower(text), "[^a-z0-9]+", ""))


def display_names(df: DataFrame, col: str, default: str = fixed.UNKNOWN_COMPANY) -> DataFrame:
    """(name, display) for the spellings that are replaced by another spelling.

    Names are counted first, so everything after the first shuffle works on distinct
    names. The winner of a key is found by a mergeable minimum, not by a window over
    the group: not all-lower-case first, then the most frequent, then by name.
    """
    name = F.when(clean_text(F.col(col)) == "", default).otherwise(clean_text(F.col(col)))
    # asked for their count, both sides of the join below are the same shuffle, and rows are read and counted once
    counts = df.select(name.alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    # tied to the count, the name's conditions stay above the shuffle too
    counts = counts.withColumn("name", F.when(F.col("n") > 0, F.col("name")))
    keyed = ascii_key(counts, "name")
    lowered = F.col("name").rlike(r"\p{L}") & ~F.col("name").rlike(r"[\p{L}&&[^\p{IsLowercase}]]")
    choice = F.struct(lowered.alias("lowered"), (-F.col("n")).alias("less"), F.col("name").alias("display"))
    winners = keyed.groupBy("name_key").agg(F.min(choice).alias("best")).select("name_key", "best.display")
    found = keyed.join(winners, "name_key").where(F.col("name") != F.col("display"))
    return found.groupBy("name").agg(F.min("display").alias("display"))  # one row each already; so a join that needs no display goes


def canonicalize(df: DataFrame, col: str, default: str = fixed.UNKNOWN_COMPANY, counted: DataFrame | None = None) -> DataFrame:
    """Replace every spelling in ``col`` by the display name of its group.

    Only spellings that change are joined, which are few next to the names. ``counted``: the same rows of ``col`` before
    other columns were added.
    """
    renames = display_names(df if counted is None else counted, col, default).withColumnRenamed("name", "_name")
    name = F.when(clean_text(F.col(col)) == "", default).otherwise(clean_text(F.col(col)))
    named = df.withColumn(col, name)
    joined = named.join(renames, named[col] == renames["_name"], "left")
    return joined.withColumn(col, F.coalesce("display", col)).drop("_name", "display")
