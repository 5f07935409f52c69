"""Quality rules by divergence from language references, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import stored

#: Frequent short words of each language.
COMMON = {
    "de": ["der", "die", "und", "den", "von", "das", "zu", "in", "mit", "dem", "ein", "ist"],
    "en": ["the", "of", "and", "to", "in", "that", "is", "was", "it", "for", "on", "with"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "que", "une", "dans", "pour"],
}
N_COMMON = 12
#: Character classes: upper-case letters, digits, white space, other marks, and the rest (lower-case letters mostly).
CLASSES = {"upper": r"[^\p{Lu}]+", "digits": r"[^\p{Nd}]+", "spaces": r"[^\x20\x09-\x0D]+", "marks": r"[\p{L}\p{M}\p{N}\x20\x09-\x0D]+"}
#: A text is judged by its classes or words from so many words on; fewer say too little.
LEAST_WORDS_CLASSES, LEAST_WORDS_COMMON = 30, 150
#: Largest Jensen-Shannon distances (0 to 1) to the reference of the text's language.
MOST_CLASSES, MOST_COMMON = 0.25, 0.26
WINDOW = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: it is bound as the variable of a lambda."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def left_of(text: Column, pattern: str) -> Column:
    """Code points that removing ``pattern`` leaves."""
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")


def repeated_words(words: Column) -> Column:
    """Words in windows of WINDOW words that occur twice or more in the text.

    Windows are told by 64-bit hashes; those that sort next to an equal one are repeated, and the words they cover are
    WINDOW for each, less what the next one covers too.
    """
    def covered(places: Column) -> Column:
        own = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(own, F.lit(0), lambda a, b: a + b)

    def places(pairs: Column) -> Column:
        again = F.transform(pairs, lambda x, k: F.when((x["h"] == F.get(pairs, k - 1)["h"]) | (x["h"] == F.get(pairs, k + 1)["h"]), x["k"]))
        return F.array_sort(F.filter(again, lambda k: k.isNotNull()))

    def judged(hashes: Column) -> Column:
        sort = F.array_sort(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(let(sort, places), covered))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda k: F.xxhash64(*[F.get(words, k + j) for j in range(WINDOW)]))
    return F.when(F.size(words) > WINDOW, let(hashes, judged)).otherwise(F.lit(0)).cast("long")


def word_features(words: Column, lang: Column) -> Column:
    """n_words, n_repeat_words and the counts of the language's common words, from the array of words."""
    lists = F.create_map(*[x for name, own in COMMON.items() for x in (F.lit(name), F.array(*map(F.lit, own)))])
    either = sorted({form for own in COMMON.values() for word in own for form in (word, word.capitalize())})

    def counts(hits: Column) -> Column:
        return F.transform(F.element_at(lists, lang), lambda c: F.size(F.filter(hits, lambda x: x == c)).cast("long"))

    hits = F.transform(F.filter(words, lambda w: w.isin(either)), F.lower)
    return F.struct(
        F.size(words).cast("long").alias("n_words"), repeated_words(words).alias("n_repeat_words"), let(hits, counts).alias("common"),
    )


def features(docs: DataFrame) -> DataFrame:
    """The base counts of each document, its counts of character classes and of common words."""
    docs = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    text = F.col("text")
    words = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = docs.select(
        "doc_id", "lang", let(words, lambda w: word_features(w, F.col("lang"))).alias("w"),
        F.char_length(text).cast("long").alias("n_chars"), left_of(text, r"[^#*$%&|<>]+").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        *[left_of(text, pattern).alias(name) for name, pattern in CLASSES.items()],
    )
    return found.select(
        "doc_id", "lang", "w.n_words", (F.col("n_chars") - F.col("spaces")).alias("word_chars"), "n_symbols", "n_dup_lines", "w.n_repeat_words",
        F.array(*CLASSES, F.col("n_chars") - sum(map(F.col, CLASSES))).alias("classes"),
        # the words that are none of the common ones come last; an unknown language has no histogram
        F.concat(F.col("w.common"), F.array(F.col("w.n_words") - F.aggregate("w.common", F.lit(0).cast("long"), lambda a, b: a + b))).alias("common"),
    )


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms; null if one of them is null or empty."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)
    shares = lambda x: F.when(total(x) > 0, F.transform(x, lambda n: n / total(x)))
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def divergence(p: Column, q: Column) -> Column:
        both = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda a, b: a + b)))

    return let(shares(counts), lambda p: let(shares(reference), lambda q: F.when(p.isNotNull() & q.isNotNull(), divergence(p, q))))


def judge(docs: DataFrame) -> DataFrame:
    """Base counts of each document, and whether it is like its language.

    A language's reference is the sum of the histograms of all its documents that pass the base rules. Returns doc_id,
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (under 10 words, or over 20 % of them in
    repeated windows), kept (not base_failed, and no distance above its limit), class_distance, common_distance. A
    distance that says too little (short text, unknown language) is no ground for rejection. A null text has no words
    and fails; a null lang is a language of its own; null doc_ids and repeated rows are judged like others; a table
    without rows gives none. Other columns go.
    """
    rows = stored(features(docs), "features").withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    sums = lambda name, size: F.array(*[F.sum(F.get(F.col(name), F.lit(k))) for k in range(size)])
    known = rows.where("not base_failed").groupBy("lang").agg(sums("classes", len(CLASSES) + 1).alias("all_classes"), sums("common", N_COMMON + 1).alias("all_common"))
    rows = rows.join(known, "lang", "left")
    rows = rows.withColumn("class_distance", F.when(F.col("n_words") >= LEAST_WORDS_CLASSES, distance(F.col("classes"), F.col("all_classes"))))
    common = F.when(F.get("all_common", F.lit(0)).isNotNull(), distance(F.col("common"), F.col("all_common")))
    rows = rows.withColumn("common_distance", F.when(F.col("n_words") >= LEAST_WORDS_COMMON, common))
    unlike = (F.coalesce("class_distance", F.lit(0.0)) > MOST_CLASSES) | (F.coalesce("common_distance", F.lit(0.0)) > MOST_COMMON)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~unlike).alias("kept"),
        "class_distance", "common_distance",
    )
