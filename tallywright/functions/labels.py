"""Role, place, work-mode and band labels.

Texts are given by column name; see ``patterns``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.patterns import Rules, array_sql, first_label, found_sql, map_sql, quoted


def classify(text: str, rules: Rules = fixed.ROLE_RULES, default: str = fixed.OTHER_ROLE) -> Column:
    """Label of a ``search_text`` column by ordered rules."""
    return first_label(text, rules, default)


def work_mode(*texts: str, rules: Rules = fixed.WORK_MODE_RULES) -> Column:
    """Mode found in any of several ``search_text`` columns."""
    text = texts[0] if len(texts) == 1 else f"concat_ws(' ', {', '.join(texts)})"
    return first_label(text, rules, fixed.NOT_SPECIFIED)


def normalize_place(text: str, cleaned: str, aliases=fixed.PLACE_ALIASES) -> Column:
    """Canonical place from a location's ``search_text`` and ``clean_text``.

    In order: empty, remote, country only, first alias of the list found on word
    boundaries, else the text before the first of ``, ; | /``.
    """
    piece = f"trim(regexp_extract({cleaned}, '^([^,;|/]*)', 1))"
    known = " ".join(rf"WHEN {found_sql(text, [rf'\b{a}\b'])} THEN {quoted(place)}" for a, place in aliases)
    return F.expr(f"""CASE
        WHEN {text} = '' THEN {quoted(fixed.UNKNOWN)}
        WHEN contains({text}, 'remote') AND (contains({text}, 'india') OR {text} = 'remote') THEN {quoted(fixed.REMOTE_PLACE)}
        WHEN rlike({text}, '^[^a-z]*india(?:[^a-z]+india)*[^a-z]*$') THEN {quoted(fixed.CITY_NOT_SPECIFIED)}
        {known}
        WHEN lower({piece}) = 'india' THEN {quoted(fixed.CITY_NOT_SPECIFIED)}
        WHEN {piece} = '' THEN {quoted(fixed.UNKNOWN)}
        ELSE {piece} END""")


def normalize_region(place: str, text: str, lookup=fixed.REGION_OF_PLACE, tokens=fixed.REGION_TOKENS) -> Column:
    """Region by place; else by a region name inside the text; else Remote or Unknown."""
    named = " ".join(f"WHEN contains({text}, {quoted(t)}) THEN {quoted(region)}" for t, region in tokens)
    return F.expr(f"""CASE
        WHEN array_contains({array_sql(lookup)}, {place}) THEN try_element_at({map_sql(lookup)}, {place})
        WHEN {place} = {quoted(fixed.CITY_NOT_SPECIFIED)} THEN 'India'
        {named}
        WHEN {place} = {quoted(fixed.REMOTE_PLACE)} THEN {quoted(fixed.REMOTE_PLACE)}
        ELSE {quoted(fixed.UNKNOWN)} END""")


def place_scope(place: str) -> Column:
    return F.expr(f"""CASE {place}
        WHEN {quoted(fixed.REMOTE_PLACE)} THEN {quoted(fixed.SCOPE_REMOTE)}
        WHEN {quoted(fixed.CITY_NOT_SPECIFIED)} THEN {quoted(fixed.SCOPE_COUNTRY)}
        WHEN {quoted(fixed.UNKNOWN)} THEN {quoted(fixed.UNKNOWN)}
        ELSE {quoted(fixed.SCOPE_CITY)} END""")


def band(value: str, edges=fixed.BAND_EDGES, above: str = fixed.BAND_ABOVE, missing: str = fixed.NOT_SPECIFIED) -> Column:
    """Half-open bands ``[low, high)``; values in no band get ``above``."""
    cases = " ".join(f"WHEN {value} >= {low} AND {value} < {high} THEN {quoted(name)}" for low, high, name in edges)
    return F.expr(f"CASE WHEN {value} IS NULL OR isnan({value}) THEN {quoted(missing)} {cases} ELSE {quoted(above)} END")


def label_order(label: str, labels: list[str] = fixed.BAND_ORDER) -> Column:
    """Position of a label in a fixed list, for sorting; labels outside come last."""
    return F.expr(f"coalesce(nullif(array_position({array_sql(labels)}, {label}), 0), {len(labels) + 1})")
