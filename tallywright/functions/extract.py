"""Tags and number ranges found in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.patterns import Rules, first_seen, found_sql, index_words, labels_by_word, phrase_words, quoted, words_sql


def extract_tags(text: str, rules: Rules = fixed.TAG_RULES) -> Column:
    """Sorted distinct tags whose patterns occur in ``text``, the name of a ``search_text`` column.

    The text is split into words once. Its words that rules ask for name their rules; only patterns that are no phrases
    of plain words are searched in every text.
    """
    wanted = index_words(p for _, patterns in rules for p in patterns)
    others = [(tag, [p for p in patterns if not phrase_words(p)]) for tag, patterns in rules]
    hits = [f"CASE WHEN {found_sql(text, patterns)} THEN {quoted(tag)} END" for tag, patterns in others if patterns]
    parts = [f"array({', '.join(hits) or 'cast(NULL AS string)'})"]
    if wanted:
        known = f"filter({words_sql(text)}, w -> w IN ({', '.join(map(quoted, wanted))}))"
        parts.append(f"coalesce(flatten(transform({known}, w -> {labels_by_word(text, 'w', rules)})), array())")
    return F.expr(f"sort_array(array_except(concat({', '.join(parts)}), array(cast(NULL AS string))))")


def tag_count(tags: Column) -> Column:
    return F.size(tags)


def extract_range(
    text: str, patterns=fixed.RANGE_PATTERNS, lo: int = fixed.RANGE_LOW, hi: int = fixed.RANGE_HIGH
) -> Column:
    """Smallest valid (min, max) among all matches of all patterns, or a struct of nulls.

    ``text`` names a ``search_text`` column. A pattern runs only on texts that contain one of
    its needed texts, and reads the second number only where it has found a first.
    """
    found = []
    for pattern, has_high, needed in patterns:
        regex = quoted("(?U)" + first_seen(pattern))
        lows = f"regexp_extract_all({text}, {regex}, 1)"
        highs = f"CASE WHEN size(x) > 0 THEN regexp_extract_all({text}, {regex}, 2) ELSE x END" if has_high else "x"
        # transform over one element names the lows, so that they are searched once
        pairs = (
            f"transform(array({lows}), x -> zip_with(x, {highs}, (a, b) -> "
            "named_struct('min', try_cast(a AS double), 'max', try_cast(b AS double))))[0]"
        )
        if needed:  # else nothing of this is evaluated
            worth = " OR ".join(f"contains({text}, {quoted(w)})" for w in needed)
            pairs = f"CASE WHEN {worth} THEN {pairs} ELSE cast(array() AS array<struct<min: double, max: double>>) END"
        found.append(pairs)
    valid = f"r -> r.min BETWEEN {lo} AND {hi} AND r.max BETWEEN {lo} AND {hi} AND r.max >= r.min"
    none = "named_struct('min', cast(NULL AS double), 'max', cast(NULL AS double))"
    return F.expr(f"coalesce(array_min(filter(concat({', '.join(found)}), {valid})), {none})")
