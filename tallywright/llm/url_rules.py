"""URL filters: fixed host and path rules, and association rules mined from the pages those rules judge."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import stored

#: Fixed values: (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A combination of tokens is mined if this share of the labelled pages has it, and makes a rule if this share of those has its verdict.
LEAST_SUPPORT, LEAST_CONFIDENCE = 0.01, 0.9
DEFAULT = "allow"
#: Marks the label among the tokens; no token begins with it.
LABEL = "="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of ``url``; both empty if it is null or has no ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits: its host or a subdomain of it, and a path that begins with its own."""
    rules = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in rules]
    return F.coalesce(*[F.when(fit, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for fit, (v, h, p) in zip(fits, rules, strict=True)])


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The different tokens of a URL, sorted: scheme, words of the host and of the path, names of the query, a fragment.
    Numbers say nothing and are left out."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    words = lambda text, pattern, mark: F.transform(F.filter(F.split(text, pattern), lambda x: (x != "") & ~x.rlike(r"^[0-9]+$")), lambda x: F.concat(F.lit(mark), x))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return F.array_sort(F.array_distinct(F.flatten(F.array(
        F.array(F.concat(F.lit("scheme:"), F.regexp_extract(url, r"^([^:/?#]*)://", 1))),
        words(F.translate(host, "-", "."), r"\.", "host:"), words(path, r"[/._-]+", "path:"),
        words(F.regexp_replace(query, r"=[^&]*", ""), "&", "query:"), F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    ))))


def frequent_together(labelled: DataFrame, least: int) -> DataFrame:
    """(token, item): tokens that ``least`` labelled pages have; those that occur on exactly the same pages are one item.

    The pages of a token are told by their number and by sums of two hashes over them, so no list of pages is gathered.
    """
    met = labelled.groupBy("tokens").agg(F.sum("n").alias("n")).select(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit("b"), "tokens").alias("b"), "n", F.explode("tokens").alias("token"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    counted = met.groupBy("token").agg(F.sum("n").alias("n"), total("a"), total("b")).where(F.col("n") >= least)
    names = counted.groupBy("n", "a", "b").agg(F.min("token").alias("item"))
    return counted.join(names, ["n", "a", "b"]).select("token", "item")


def mine(labelled: DataFrame, least_support: float, least_confidence: float) -> DataFrame:
    """(token, item, rule, n_items, verdict, confidence, support) from ``labelled`` (tokens, verdict), by FP-growth: the
    rules, listed under each token that stands for one of their items.

    Only tokens that are frequent enough are mined, and tokens that always occur together are one item, so that a URL
    of many words that repeats costs one item and not all combinations of its words. Any of an item's tokens stands for
    it: combinations that differ in them have the same pages. A label is an item among the tokens; rules that conclude
    something else than a label are dropped.
    """
    sets = stored(labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n")), "sets")
    pages = sets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    items = stored(frequent_together(sets, max(1, math.ceil(least_support * pages - 1e-9))), "items")
    named = sets.select("tokens", "verdict", F.explode("tokens").alias("token")).join(items, "token")
    named = named.groupBy("tokens", "verdict").agg(F.collect_set("item").alias("items"))
    baskets = sets.join(named, ["tokens", "verdict"], "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    baskets = baskets.groupBy(F.array_sort("items").alias("items"), "verdict").agg(F.sum("n").alias("n"))
    # one row for each page again, laid out a million at a time
    rows = baskets.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(1_000_000).cast("long"))))
    rows = rows.withColumn("_", F.explode(F.array_repeat(F.lit(1), F.least(F.col("n") - F.col("from"), F.lit(1_000_000)).cast("int"))))
    rows = rows.select(F.concat("items", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least_support, minConfidence=least_confidence).fit(rows)
    rules = model.associationRules.where(F.get("consequent", F.lit(0)).startswith(LABEL) & ~F.exists("antecedent", lambda x: x.startswith(LABEL)))
    rules = rules.select(
        F.concat_ws("\n", F.array_sort("antecedent")).alias("rule"), F.size("antecedent").alias("n_items"),
        F.substring(F.get("consequent", F.lit(0)), 2, 100).alias("verdict"), "confidence", "support", F.explode("antecedent").alias("item"),
    )
    return rules.join(items, "item").select("token", "item", "rule", "n_items", "verdict", "confidence", "support")


def matched(sets: DataFrame, index: DataFrame) -> DataFrame:
    """(tokens, mined): the verdict of the strongest rule all of whose items are among a set's tokens.

    Inverted index: a set meets the rules listed under its tokens and has matched those of which it met as many items
    as they have. Strongest: confidence, then support, then more tokens, then their names.
    """
    met = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    met = met.groupBy("tokens", "rule", "n_items", "verdict", "confidence", "support").agg(
        F.size(F.collect_set("item")).alias("n"), F.count(F.lit(1)).alias("n_tokens"), F.concat_ws("\n", F.array_sort(F.collect_set("token"))).alias("name"))
    met = met.where("n = n_items")
    return met.groupBy("tokens").agg(F.max_by("verdict", F.struct("confidence", "support", "n_tokens", "name")).alias("mined"))


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, least_support: float = LEAST_SUPPORT, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """Host, path and verdict of every page's URL.

    A fitting fixed rule decides, the longest one first. The pages that one decides are the labels from which
    combinations of URL tokens are mined; the strongest mined rule decides for the others, and ``allow`` where none
    matches. Pages are matched once for each different set of tokens. Returns page_id, host, path, rule, verdict for
    each row. A null URL or one without ``://`` has empty host and path and only an empty scheme as tokens. Null ids
    and repeated rows are judged like others; an empty table gives no rows. Other columns go.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"found": longest_rule(F.col("host"), F.col("path"), rules), "tokens": tokens(F.col("url"), F.col("host"), F.col("path"))})
    rows = stored(rows.select("page_id", "host", "path", "found.rule", "found.verdict", "tokens"), "urls")
    labelled = rows.where("verdict is not null").select("tokens", "verdict")
    mined = matched(rows.where("verdict is null").select("tokens").distinct(), stored(mine(labelled, least_support, least_confidence), "rules"))
    rows = rows.join(mined, "tokens", "left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", "mined", F.lit(DEFAULT)).alias("verdict"))
