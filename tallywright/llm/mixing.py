"""Mixing sources to target weights: budgets down a domain-language-source tree, prefixes of seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import stored

LEVELS = ("domain", "lang", "source")


def n_tokens(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``; null: none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fill(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Shares each parent's ``budget`` among its children by ``weight``, none above its ``cap``.

    What a child can't take goes to its siblings by their weights; as the caller's caps are those of whole subtrees,
    it leaves the parent only when all of them are full. Closed form: children ordered by cap / weight are full up to
    some place, and from there on get ``weight * (budget - caps before) / (weights from there)``.
    """
    ratio = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), *[c for c in LEVELS if c in nodes.columns])
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    nodes = nodes.withColumn("level", left / F.sum("weight").over(after))
    full = F.col("cap") / F.col("weight") <= F.col("level")
    # one level holds for all that aren't full: that of the first of them
    first = F.min(F.when(~full, F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("level").alias("v")))).over(Window.partitionBy(*parent))["v"]
    return nodes.withColumn("share", F.when(full, F.col("cap").cast("double")).otherwise(F.col("weight") * first)).drop("level")


def budgets(leaves: DataFrame, weights: dict[str, int], budget: Column, max_epochs: int) -> DataFrame:
    """``budget`` tokens for each leaf of ``leaves`` (domain, lang, source, tokens).

    ``weights`` gives whole-number weights among siblings by node name, ``domain/lang/source`` cut at its level; other
    nodes weigh 1. A leaf holds max_epochs times its tokens, a node what its leaves hold, and the root at most all.
    """
    def weighed(df: DataFrame, path: list[str]) -> DataFrame:
        named = {k: w for k, w in weights.items() if k.count("/") == len(path) - 1}
        name = F.concat_ws("/", *path)
        return df.withColumn("weight", F.coalesce(*[F.when(name == k, F.lit(w)) for k, w in named.items()], F.lit(1)).cast("double"))

    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    nodes = leaves.groupBy("domain").agg(F.sum("cap").alias("cap"))
    total = leaves.agg(F.least(F.sum("cap"), F.sum("tokens") * budget).cast("double").alias("budget"))
    out = fill(weighed(nodes.withColumn("budget", total.scalar()), ["domain"]), [])
    for depth in (2, 3):
        path = list(LEVELS[:depth])
        down = out.select(*path[:-1], F.col("share").alias("budget"))
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"))
        out = fill(weighed(nodes.join(down, path[:-1]), path), path[:-1])
    return out.select(*LEVELS, F.floor("share").cast("long").alias("budget"))


def mix(docs: DataFrame, weights: dict[str, int], budget: float = 1.0, max_epochs: int = 2, seed: int = 0, carry: str | None = None) -> DataFrame:
    """Which documents of ``docs`` (doc_id, text, domain, lang, source) to take, and how often.

    The token budget is ``budget`` times all tokens. A leaf with budget b and t tokens gives floor(b / t) whole epochs
    and, of the next one, the documents that begin within the rest. An epoch orders a leaf's documents by MD5 of
    seed, epoch and doc_id; ties go by n_tokens. Returns doc_id, domain, lang, source, n_tokens, epochs (times the
    document is taken whole), cut (tokens of it taken once more: all of them but for the last document) for the
    documents taken. Labels that are null count as empty ones, null texts as no tokens; a document without tokens is
    taken with whole epochs or where the prefix hasn't ended before it. A null doc_id is ordered like an empty one,
    repeated rows count singly, an empty table gives no rows. Other columns go but
    ``carry``, if named.
    """
    carried = [F.col(carry).cast("string").alias("carried")] if carry else []
    rows = stored(docs.select(
        F.col("doc_id").cast("long"), *carried, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in LEVELS], n_tokens(F.col("text")).alias("n_tokens"),
    ), "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = leaves.join(budgets(leaves, weights, F.lit(float(budget)), max_epochs), list(LEVELS)).select(
        *LEVELS, F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(max_epochs).alias("epochs"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest"),
    )
    leaves = stored(leaves, "budgets")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = rows.join(leaves, list(LEVELS)).withColumn("key", key).withColumn("part", F.substring("key", 1, 3))
    # where each of a leaf's 4,096 parts begins; then places within a part
    parts = rows.groupBy(*LEVELS, "part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select(*LEVELS, "part", F.coalesce(F.sum("n").over(
        Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    inside = F.sum("n_tokens").over(Window.partitionBy(*LEVELS, "part").orderBy("key", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    rows = rows.withColumn("inside", inside).join(parts, [*LEVELS, "part"])
    start = F.col("part_start") + F.col("inside")
    rows = rows.withColumn("cut", F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest") - start)).cast("long"))
    taken = (F.col("epochs") > 0) | (start < F.col("rest"))
    carried = [F.col("carried").alias(carry)] if carry else []
    return rows.where(taken).select("doc_id", *carried, *LEVELS, "n_tokens", F.col("epochs").cast("long"), "cut")
