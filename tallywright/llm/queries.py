"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import fingerprints, mixing, more_queries, packing, quality_classifier, quality_rules, sharding, simhash, substring_dedup, suffix_dedup, url_rules
from tallywright.llm.common import table

#: Weights of the mixing query, whole numbers among siblings; nodes not named weigh 1.
MIX_WEIGHTS = {"d0": 3, "d1": 2, "d0/en": 2, "d1/de": 2, "d2/fr": 3, "d0/en/src0": 2}


def domain(source: Column) -> Column:
    """The tables name no domains: sources are grouped by the last character of their name."""
    return F.concat(F.lit("d"), (F.coalesce(F.ascii(F.substring(source, -1, 1)), F.lit(0)) % 4).cast("string"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(table(spark, sf_dir, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("domain", domain(F.col("source")))
    return mixing.mix(docs, MIX_WEIGHTS, budget=1.0, max_epochs=2, seed=7)


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048, added=packing.added_tokens())


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("class_distance", "common_distance")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), seed=8)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(table(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _fill_sql(name: str, nodes: str, parent: str, path: str) -> str:
    by = f"PARTITION BY {parent} " if parent else ""
    return f"""
{name}_order AS (
    SELECT *, budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
        sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM ({nodes}) WINDOW o AS ({by}ORDER BY cap / weight, {path})),
{name}_level AS (SELECT *, min(CASE WHEN cap / weight > remaining / weights THEN {{'r': cap / weight, 'v': remaining / weights}} END)
    OVER ({by}) AS first_open FROM {name}_order),
{name} AS (SELECT {path}, CASE WHEN cap / weight <= remaining / weights THEN cap ELSE weight * first_open.v END AS share FROM {name}_level)"""


def _weight_sql(depth: int) -> str:
    name = " || '/' || ".join(mixing.LEVELS[:depth])
    cases = "".join(f" WHEN '{k}' THEN {w}" for k, w in MIX_WEIGHTS.items() if k.count("/") == depth - 1)
    return f"CAST(CASE {name}{cases} ELSE 1 END AS DOUBLE)"


_MIX_SQL = f"""
WITH docs AS (
    SELECT doc_id, 'd' || coalesce(ascii(right(source, 1)) % 4, 0) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM docs GROUP BY ALL),
{_fill_sql("a", f'''SELECT domain, sum(2 * tokens) AS cap, {_weight_sql(1)} AS weight,
    (SELECT least(sum(2 * tokens), sum(tokens)) FROM leaves) AS budget FROM leaves GROUP BY domain''', "", "domain")},
{_fill_sql("b", f'''SELECT domain, lang, sum(2 * tokens) AS cap, {_weight_sql(2)} AS weight, any_value(share) AS budget
    FROM leaves JOIN a USING (domain) GROUP BY domain, lang''', "domain", "domain, lang")},
{_fill_sql("c", f'''SELECT domain, lang, source, 2 * tokens AS cap, {_weight_sql(3)} AS weight, share AS budget
    FROM leaves JOIN b USING (domain, lang)''', "domain, lang", "domain, lang, source")},
plan AS (SELECT domain, lang, source,
    CASE WHEN tokens > 0 THEN CAST(floor(share) AS BIGINT) // CAST(tokens AS BIGINT) ELSE 2 END AS epochs,
    CASE WHEN tokens > 0 THEN CAST(floor(share) AS BIGINT) % CAST(tokens AS BIGINT) ELSE 0 END AS rest
    FROM c JOIN leaves USING (domain, lang, source)),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('7:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS start
    FROM docs JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs AS BIGINT) AS epochs,
    CAST(greatest(0, least(n_tokens, rest - start)) AS BIGINT) AS cut
FROM placed WHERE epochs > 0 OR start < rest
"""

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_pack": op3_pack,
    "op4_fingerprints": op4_fingerprints,
    "op5_quality_rules": op5_quality_rules,
    "op6_url_rules": op6_url_rules,
    "op7_simhash": op7_simhash,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_sharding": op9_sharding,
    "op10_substring_dedup": op10_substring_dedup,
    **more_queries.QUERIES,
}


def _distance_sql(counts: str, reference: str) -> str:
    """Jensen-Shannon distance of two lists of counts; null if one is null or sums to nothing."""
    shares = [f"list_transform({x}, lambda n: n / nullif(list_sum({x}), 0))" for x in (counts, reference)]
    half = "coalesce(CASE WHEN z[{0}] > 0 THEN z[{0}] * log2(z[{0}] / ((z[1] + z[2]) / 2)) END, 0)"
    return f"""CASE WHEN list_sum({counts}) > 0 AND list_sum({reference}) > 0 THEN
        sqrt(greatest(0, list_sum(list_transform(list_zip({shares[0]}, {shares[1]}), lambda z: ({half.format(1)} + {half.format(2)}) / 2)))) END"""


_COMMON_SQL = "CASE lang " + " ".join(f"WHEN '{k}' THEN {list(v)}" for k, v in quality_rules.COMMON.items()) + " END"
_CLASS_SQL = [f"length(regexp_replace(t, '{p}', '', 'g'))" for p in quality_rules.CLASSES.values()]
_SUMS_SQL = {name: "[" + ", ".join(f"sum({name}[{k + 1}])" for k in range(n)) + "]" for name, n in (("classes", len(_CLASS_SQL) + 1), ("common", quality_rules.N_COMMON + 1))}

_QUALITY_SQL = f"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, {_COMMON_SQL} AS frequent
    FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM docs),
grams AS (SELECT doc_id, place, lead(word, 4) OVER o IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS again FROM (
    SELECT doc_id, place, word, [{", ".join(["word", *[f"lead(word, {k}) OVER o" for k in range(1, 5)]])}] AS gram FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY place))
    WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
repeats AS (SELECT doc_id, count(*) FILTER (covered) AS n_repeat_words FROM (
    SELECT doc_id, max(again) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM grams) GROUP BY doc_id),
counted AS (
    SELECT doc_id, lang, len(w) AS n_words, length(t) - {_CLASS_SQL[2]} AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        [{", ".join(_CLASS_SQL)}, length(t) - {" - ".join(_CLASS_SQL)}] AS classes,
        list_transform(frequent, lambda c: len(list_filter(w, lambda x: x = c OR x = upper(c[1]) || c[2:]))) AS hits
    FROM docs LEFT JOIN repeats USING (doc_id)),
rows AS (SELECT *, CASE WHEN hits IS NOT NULL THEN list_append(hits, n_words - list_sum(hits)::BIGINT) END AS common,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
known AS (SELECT lang, {_SUMS_SQL["classes"]} AS all_classes, {_SUMS_SQL["common"]} AS all_common FROM rows WHERE NOT base_failed GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed
    AND coalesce(CASE WHEN n_words >= {quality_rules.LEAST_WORDS_CLASSES} THEN {_distance_sql("classes", "all_classes")} END, 0) <= {quality_rules.MOST_CLASSES}
    AND coalesce(CASE WHEN n_words >= {quality_rules.LEAST_WORDS_COMMON} THEN {_distance_sql("common", "all_common")} END, 0) <= {quality_rules.MOST_COMMON} AS kept
FROM rows LEFT JOIN known USING (lang)
"""

_WINDOW_SQL = " || ' ' || ".join(["word", *[f"lead(word, {k}) OVER o" for k in range(1, 13)]])

_SUBSTRING_SQL = f"""
WITH words AS (
    SELECT doc_id, unnest(found) AS word, generate_subscripts(found, 1) AS place
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS found FROM documents)),
whole AS (SELECT doc_id, place, hash({_WINDOW_SQL}) AS window_hash, {_WINDOW_SQL} AS window_words FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
judged AS (SELECT doc_id, place, window_words IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY window_hash, window_words) AS again FROM whole),
marked AS (SELECT doc_id, place, max(again) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM judged),
kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS rest
    FROM marked JOIN words USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

_FITS = sorted(url_rules.RULES, key=lambda r: -len(r[1] + r[2]))
_FIT_SQL = {
    what: "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{found(v, h, p)}'" for v, h, p in _FITS) + " END"
    for what, found in (("rule", lambda v, h, p: h + p), ("verdict", lambda v, h, p: v))
}


def _words_sql(text: str, pattern: str, mark: str) -> str:
    return f"list_transform(list_filter(regexp_split_to_array({text}, '{pattern}'), lambda x: x <> '' AND NOT regexp_matches(x, '^[0-9]+$')), lambda x: '{mark}' || x)"


# FP-growth by listing every combination of tokens of the labelled pages: for small tables only.
_URL_SQL = f"""
WITH parts AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
urls AS (SELECT page_id, host, path, {_FIT_SQL["rule"]} AS rule, {_FIT_SQL["verdict"]} AS verdict, list_sort(list_distinct(flatten([
    ['scheme:' || regexp_extract(url, '^([^:/?#]*)://', 1)], {_words_sql("host", "[.-]", "host:")}, {_words_sql("path", "[/._-]+", "path:")},
    {_words_sql("regexp_replace(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '=[^&]*', '', 'g')", "&", "query:")},
    CASE WHEN contains(url, '#') THEN ['fragment'] ELSE [] END]))) AS tokens FROM split),
listed AS (SELECT list_filter(tokens, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items, verdict FROM (
    SELECT tokens, verdict, unnest(range(1, 1 << len(tokens))) AS m FROM urls WHERE verdict IS NOT NULL)),
alone AS (SELECT items, count(*) AS n FROM listed GROUP BY items),
rules AS (SELECT items, verdict, b.n / a.n AS confidence, b.n AS support FROM (SELECT items, verdict, count(*) AS n FROM listed GROUP BY items, verdict) b JOIN alone a USING (items)
    WHERE b.n >= ceil({url_rules.LEAST_SUPPORT} * (SELECT count(*) FROM urls WHERE verdict IS NOT NULL)) AND b.n / a.n >= {url_rules.LEAST_CONFIDENCE}),
mined AS (SELECT tokens, rules.verdict AS mined FROM (SELECT DISTINCT tokens FROM urls WHERE verdict IS NULL) JOIN rules ON list_has_all(tokens, items)
    QUALIFY row_number() OVER (PARTITION BY tokens ORDER BY confidence DESC, support DESC, len(items) DESC, array_to_string(items, chr(10)) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, mined, '{url_rules.DEFAULT}') AS verdict FROM urls LEFT JOIN mined USING (tokens)
"""

#: Sharding has no SQL: DuckDB has no CRC-32.
ORACLES = {
    "op2_mix_sources": _MIX_SQL,
    "op5_quality_rules": _QUALITY_SQL,
    "op6_url_rules": _URL_SQL,
    "op10_substring_dedup": _SUBSTRING_SQL,
    **more_queries.ORACLES,
}
