"""Registered queries of the manifest, the n-gram join and the spelling variants, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import manifest, ngram_join, spelling
from tallywright.llm.common import table

#: Every how many-th document, by the CRC-32 of its id, is tampered with to see the manifest fail.
TAMPERED = 7


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*manifest.FIELDS)
    fields = [F.col(c) for c in manifest.FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    changed = [F.when(hit, F.col(c) + 1).otherwise(F.col(c)) if c == "n_chars" else F.col(c) for c in manifest.FIELDS]
    rows = docs.select("doc_id", "lang", manifest.leaf(fields).alias("leaf"), F.when(hit, manifest.leaf(changed)).alias("tampered"))
    # the manifest hands each row's carried text through: its id, and the leaf of the tampered row if there is one
    rows = rows.withColumn("note", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("tampered", "leaf")))
    out = manifest.manifest(rows, "lang", carry="note")
    doc_id, found = F.nullif(F.substring_index("carried", ":", 1), F.lit("")).cast("long"), F.substring_index("carried", ":", -1)
    out = out.select(doc_id.alias("doc_id"), "leaf", "subroot", "root", manifest.proof(F.col("witness")).alias("proof_sha256"), manifest.fold(found, F.col("witness")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), words=5, similarity=0.8)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), least_letters=7, least_n=2, times=10)


def crc32_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, as an unsigned number: eight shifts for each byte."""
    shifts = "list_reduce(list_prepend(xor({0}, {1}), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda u, v: xor(u >> 1, 3988292384::UBIGINT * (u & 1)))"
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {shifts.format('c', 'b')}), 4294967295::UBIGINT)"


def _leaf_sql(n_chars: str) -> str:
    fields = [n_chars if c == "n_chars" else c for c in manifest.FIELDS]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in fields) + ")"


_MANIFEST_SQL = f"""
WITH RECURSIVE docs AS (SELECT *, coalesce({crc32_sql("CAST(doc_id AS VARCHAR)")} % {TAMPERED} = 0, false) AS hit FROM documents),
leaves AS (SELECT doc_id, lang, leaf, found, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM (
    SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("CASE WHEN hit THEN n_chars + 1 ELSE n_chars END")} AS found FROM docs)),
up(lang, level, pos, n, h) AS (
    SELECT lang, 0, pos, n, leaf FROM leaves UNION ALL
    SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY lang, level, pos // 2, n),
tops AS (SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
over(level, pos, n, h) AS (
    SELECT 0, pos, n, subroot FROM tops UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM over WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
    SELECT a.lang, a.level, a.pos, CASE WHEN a.pos % 2 = 1 THEN b.h ELSE '' END AS before, CASE WHEN a.pos % 2 = 0 THEN coalesce(b.h, '') ELSE '' END AS after
    FROM up a LEFT JOIN up b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND xor(a.pos, 1) = b.pos WHERE a.n > 1),
over_steps AS (
    SELECT a.level, a.pos, CASE WHEN a.pos % 2 = 1 THEN b.h ELSE '' END AS before, CASE WHEN a.pos % 2 = 0 THEN coalesce(b.h, '') ELSE '' END AS after
    FROM over a LEFT JOIN over b ON a.level = b.level AND xor(a.pos, 1) = b.pos WHERE a.n > 1),
fold(doc_id, lang, leaf, place, pos, level, h, proof) AS (
    SELECT doc_id, lang, leaf, pos, pos, 0, found, '' FROM leaves UNION ALL
    SELECT f.doc_id, f.lang, f.leaf, f.place, f.pos // 2, f.level + 1, sha256(s.before || f.h || s.after), f.proof || s.before || s.after
    FROM fold f JOIN steps s ON f.lang IS NOT DISTINCT FROM s.lang AND f.level = s.level AND f.pos = s.pos),
folded(doc_id, leaf, subroot, pos, level, h, proof) AS (
    SELECT f.doc_id, f.leaf, t.subroot, t.pos, 0, f.h, f.proof FROM fold f JOIN tops t ON f.lang IS NOT DISTINCT FROM t.lang AND f.level = t.height UNION ALL
    SELECT f.doc_id, f.leaf, f.subroot, f.pos // 2, f.level + 1, sha256(s.before || f.h || s.after), f.proof || s.before || s.after
    FROM folded f JOIN over_steps s ON f.level = s.level AND f.pos = s.pos),
whole AS (SELECT level AS height, h AS root FROM over WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified FROM folded JOIN whole ON level = height
"""

_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# all pairs that share an n-gram, counted: for small tables only
_JOIN_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER_SQL}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS grams FROM docs),
grams AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (SELECT x, y FROM links UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, coalesce(least(doc_id, least_other), doc_id) AS component_id
FROM sets LEFT JOIN (SELECT doc_id, min(other) AS least_other FROM reach GROUP BY doc_id) USING (doc_id)
"""

# near words share what is left when a letter is left out or blotted out
_SPELLING_SQL = f"""
WITH RECURSIVE runs AS (SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER_SQL}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs),
slipped AS (SELECT n, CASE WHEN h % {spelling.SLIPS} = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
blots AS (SELECT word, n, left(word, k - 1) || '*' || substr(word, k + 1) AS rest FROM places),
gaps AS (SELECT DISTINCT word, n, left(word, k - 1) || substr(word, k + 1) AS rest FROM places),
near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM blots a JOIN blots b USING (rest) WHERE a.word <> b.word UNION
    SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
formed AS (SELECT word, CASE WHEN near_n >= 10 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
led(word, root) AS (SELECT word, word FROM formed UNION ALL SELECT l.word, f.form FROM led l JOIN formed f ON l.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n FROM formed f
JOIN (SELECT l.word, l.root FROM led l JOIN formed g ON l.root = g.word WHERE g.form IS NULL) l USING (word)
"""

QUERIES = {"op11_manifest": op11_manifest, "op12_ngram_join": op12_ngram_join, "op13_spelling": op13_spelling}
ORACLES = {"op11_manifest": _MANIFEST_SQL, "op12_ngram_join": _JOIN_SQL, "op13_spelling": _SPELLING_SQL}
