"""Co-occurrence of tags on the same entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_sets(bridge: DataFrame, entity: str = "job_id", tag: str = "skill") -> DataFrame:
    """One row per entity with its sorted distinct tags; the set is bounded by the vocabulary."""
    return bridge.groupBy(entity).agg(F.array_sort(F.collect_set(tag)).alias("tags"))


def pair_counts(
    bridge: DataFrame, entity: str = "job_id", tag: str = "skill", ordered: bool = False, n: str = "jobs_with_pair"
) -> DataFrame:
    """Entities per tag pair: ``skill_1 < skill_2`` by name, or both directions if ``ordered``.

    Entities with the same tag set are counted first, so pairs are laid out once per
    distinct set, weighted by its count, and there is no self-join of the bridge.
    """
    sets = tag_sets(bridge, entity, tag).groupBy("tags").agg(F.count(F.lit(1)).alias("_w"))
    first = sets.select("_w", "tags", F.posexplode("tags").alias("_i", "skill_1"))
    later = F.slice("tags", F.col("_i") + 2, F.size("tags"))
    pairs = first.select("_w", "skill_1", F.explode(later).alias("skill_2"))
    counts = pairs.groupBy("skill_1", "skill_2").agg(F.sum("_w").alias(n))
    if not ordered:
        return counts
    both = F.array(
        F.struct(F.col("skill_1").alias("a"), F.col("skill_2").alias("b")),
        F.struct(F.col("skill_2").alias("a"), F.col("skill_1").alias("b")),
    )
    return counts.select(F.explode(both).alias("_p"), n).select(
        F.col("_p.a").alias("skill_1"), F.col("_p.b").alias("skill_2"), n
    )
