"""Rule lists compiled to one SQL expression each, with a cheap substring test per pattern.

Rule lists are long, so the functions here take the *name* of a text column (or any SQL
expression for one) and hand Spark one expression text: a few calls into the JVM where
composing Column objects would take thousands.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywright.functions.text import normalized_clean, normalized_text

Rules = Sequence[tuple[str, Sequence[str]]]
_WORD_CHARACTERS = "abcdefghijklmnopqrstuvwxyz0123456789_"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def array_sql(texts: Iterable[str]) -> str:
    return f"array({', '.join(quoted(t) for t in texts)})"


def map_sql(pairs: Mapping[str, str]) -> str:
    return f"map({', '.join(f'{quoted(k)}, {quoted(v)}' for k, v in pairs.items())})"


def search_text(c: Column, cleaned: bool = False) -> Column:
    """Normalized text with the two letters that ``lower`` keeps although they equal ``s`` and
    ``i`` when case is ignored, so that patterns need not ignore case. ``cleaned``: the column is a ``clean_text``."""
    text = normalized_clean(c) if cleaned else normalized_text(c)
    return F.replace(F.replace(text, F.lit("ſ"), F.lit("s")), F.lit("ı"), F.lit("i"))


def needed_texts(pattern: str) -> list[str]:
    """Plain texts of which every match of ``pattern`` contains at least one; [] if none is known.

    Word boundaries, look-arounds, classes and optional letters are taken out, and the longest
    run of plain characters that is left is part of every match. One bracketed list of
    alternatives between word boundaries is read alternative by alternative.
    """
    listed = re.fullmatch(r"\\b\(([^()]*)\)\\b", pattern)
    texts = []
    for part in listed.group(1).split("|") if listed else [pattern]:
        plain = re.sub(r"\(\?<?[!=][^()]*\)|\[[^\]]*\][?*+]?|\\[a-z][?*+]?|.[?*]", "\0", part)
        if re.search(r"[^a-z0-9 /\0]", plain):
            return []
        longest = max(plain.split("\0"), key=len)
        if len(longest) < 2:
            return []
        texts.append(longest)
    return texts


def _literal_first(pattern: str) -> str:
    """``\\bphrase\\b`` with the phrase in front and the boundaries tested where it occurs,
    instead of a boundary test at every character of the text."""
    found = re.fullmatch(r"\\b([a-z0-9][a-z0-9 ]*[a-z0-9])\\b", pattern)
    return f"{found.group(1)}(?!\\w)(?<!\\w{found.group(1)})" if found else pattern


def first_seen(pattern: str) -> str:
    """``pattern`` with a look at its first character before the boundary that it begins with.

    A boundary asks for the kinds of two characters, at every place of a text; few places have a digit, or the first
    letter of one of the listed words.
    """
    if pattern.startswith((r"\b(\d", r"\b\d")):
        return r"(?=\d)" + pattern
    listed = re.match(r"\\b\((?:\?:)?((?:[a-z0-9][^()|\\]*(?:\\\.\??)?\|?)+)\)", pattern)
    words = listed.group(1).split("|") if listed else []
    if words and all(re.match(r"[a-z0-9](?![?*{])", w) for w in words):
        return f"(?=[{''.join(sorted({w[0] for w in words}))}])" + pattern
    return pattern


def found_sql(text: str, patterns: Sequence[str]) -> str:
    """Condition: any pattern occurs in ``text``, the name of a ``search_text`` column.

    A byte search decides most rows; the regular expression runs only where it can match.
    """
    # the text is in lower case: rules written in capitals are matched without regard to case
    flags = "(?iU)" if any(re.search(r"(?<!\\)[A-Z]", p) for p in patterns) else "(?U)"
    regex = f"rlike({text}, {quoted(flags + '|'.join(f'(?:{first_seen(_literal_first(p))})' for p in patterns))})"
    needed = [needed_texts(p) for p in patterns]
    if not all(needed):
        return regex
    flat = list(dict.fromkeys(t for texts in needed for t in texts))
    shortest = [t for t in flat if not any(o != t and o in t for o in flat)]
    return f"(({' OR '.join(f'contains({text}, {quoted(t)})' for t in shortest)}) AND {regex})"


def phrase_words(pattern: str) -> list[str]:
    """The words of a pattern that is a phrase of plain words between boundaries, else []."""
    found = re.fullmatch(r"\\b([a-z0-9]+(?: [a-z0-9]+)*)\\b", pattern)
    return found.group(1).split(" ") if found else []


def words_sql(text: str) -> str:
    """The words of a ``search_text`` column: runs of what word boundaries lie around.

    ``split`` compiles its pattern anew for every row unless that is one plain character, so what lies between words is
    made a blank first. The characters of words are listed one by one: ranges are tested one after the other.
    """
    plain = f"regexp_replace({text}, '[^{_WORD_CHARACTERS}]+', ' ')"
    other = f"regexp_replace({text}, {quoted(r'(?U)[^\w]+')}, ' ')"
    return f"split(CASE WHEN octet_length({text}) = length({text}) THEN {plain} ELSE {other} END, ' ')"


def index_words(patterns: Iterable[str]) -> list[str]:
    """Per phrase the word to look for: the phrase itself or its longest word."""
    return sorted({max(words, key=len) for words in map(phrase_words, patterns) if words})


def labels_by_word(text: str, word: str, rules: Rules) -> str:
    """The labels of the rules that ``word``, one of the ``index_words`` of ``text``, settles, as an array.

    A pattern of one word is settled by it, and a longer phrase is searched only at its longest word. Words that settle
    all their labels are looked up in one constant map; a CASE over all words would test one after the other.
    """
    by_word: dict[str, dict[str, list[str]]] = {}
    for label, patterns in rules:
        for pattern in patterns:
            own = phrase_words(pattern)
            if own:
                by_word.setdefault(max(own, key=len), {}).setdefault(label, []).append(pattern)
    settled, cases = {}, {}
    for key, labels in by_word.items():
        alone = [any(len(phrase_words(p)) == 1 for p in patterns) for patterns in labels.values()]
        if all(alone):
            settled[key] = array_sql(labels)
            continue
        found = [
            quoted(label) if own else f"CASE WHEN {found_sql(text, patterns)} THEN {quoted(label)} END"
            for own, (label, patterns) in zip(alone, labels.items(), strict=True)
        ]
        cases[key] = f"WHEN {quoted(key)} THEN array({', '.join(found)})"
    known = f"try_element_at(map({', '.join(f'{quoted(k)}, {v}' for k, v in settled.items())}), {word})"
    if not cases:
        return known
    searched = f"CASE {word} {' '.join(cases.values())} END"
    if not settled:
        return searched
    return f"CASE WHEN {word} IN ({', '.join(map(quoted, cases))}) THEN {searched} ELSE {known} END"


def first_label(text: str, rules: Rules, default: str) -> Column:
    """Label of the first rule in list order with a pattern in ``text``."""
    cases = " ".join(f"WHEN {found_sql(text, patterns)} THEN {quoted(label)}" for label, patterns in rules)
    return F.expr(f"CASE {cases} ELSE {quoted(default)} END")
