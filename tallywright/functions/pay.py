"""Pay-period evidence and the normalization of source amounts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import fixed
from tallywright.functions.patterns import quoted
from tallywright.functions.text import parse_bool


def amount_part(pattern: str) -> str:
    """``pattern`` without an optional beginning (words, then a bounded run) that decides only where its match begins.

    The amount is the first in the text with or without that beginning, which would be tried at every character.
    """
    found = re.fullmatch(r"\(\?:[a-z|]+\)\?\[\^\.\\n\]\{0,\d+\}\?(\(\[\\d\].*)", pattern, re.S)
    return found.group(1) if found else pattern


def first_words(pattern: str) -> list[str]:
    """The plain words of which one begins every match, else []. A word with an ``i`` is none: a capital İ equals it in a
    pattern, but not in lower case."""
    found = re.match(r"\(\?:([a-z]+(?:\|[a-z]+)*)\)(?![?*{])", pattern)
    words = found.group(1).split("|") if found else []
    return [] if any("i" in w for w in words) else words


def _amount_sql(text: str, search: str, needed: Sequence[str], pattern: str, factor: float) -> str:
    worth = " AND ".join(
        f"({' OR '.join(f'contains({search}, {quoted(w)})' for w in words)})" for words in (needed, first_words(pattern)) if words
    )
    found = f"replace(regexp_extract({text}, {quoted('(?iU)' + amount_part(pattern))}, 1), ',', '')"
    # a cast that fails costs an exception, so "not found" is not cast; transform over one element names what is found
    number = f"transform(array({found}), x -> CASE WHEN x <> '' THEN try_cast(x AS double) END)[0]"
    return f"CASE WHEN {worth} THEN {number} * {factor}D END"


def amounts_in_text(text: str, search: str, condition: Column, patterns=fixed.PAY_PATTERNS) -> dict[str, Column]:
    """``_a0``, ``_a1``, ...: the amount that each pattern yields, or null.

    ``text`` names a ``clean_text`` column and ``search`` its ``search_text``. The amounts are
    columns of their own, so every pattern is searched once. Rows outside ``condition`` are not searched.
    """
    return {
        f"_a{i}": F.when(condition, F.expr(_amount_sql(text, search, needed, pattern, factor)))
        for i, (_, factor, needed, pattern) in enumerate(patterns)
    }


def evidence(text: str, patterns=fixed.PAY_PATTERNS) -> dict[str, Column]:
    """``_unit``, ``_amount`` and ``_evidence`` of the first pattern with an amount in ``amounts_in_text``.

    The text of the match is cut out for the winning pattern only.
    """
    rows = list(enumerate(patterns))
    unit = " ".join(f"WHEN _a{i} IS NOT NULL THEN {quoted(p[0])}" for i, p in rows)
    cut = " ".join(
        f"WHEN _a{i} IS NOT NULL THEN left(regexp_extract({text}, {quoted('(?iU)' + p[3])}, 0), {fixed.PAY_EVIDENCE_CHARS})"
        for i, p in rows
    )
    return {
        "_unit": F.expr(f"CASE {unit} ELSE 'UNKNOWN' END"),
        "_amount": F.coalesce(*[f"_a{i}" for i, _ in rows]),
        "_evidence": F.expr(f"CASE {cut} ELSE {quoted(fixed.PAY_NO_EVIDENCE)} END"),
    }


def with_evidence(df: DataFrame, text: str, search: str, condition: Column, patterns=fixed.PAY_PATTERNS) -> DataFrame:
    """Add ``_unit``, ``_amount`` and ``_evidence`` of the first pattern that yields a number."""
    amounts = amounts_in_text(text, search, condition, patterns)
    return df.withColumns(amounts).withColumns(evidence(text, patterns)).drop(*amounts)


def within_tolerance(x: Column, target: Column, tol: float = fixed.PAY_TOLERANCE) -> Column:
    """True when ``x`` lies within ``tol`` of a positive ``target``, relative to it."""
    return F.coalesce((target > 0) & (F.abs(x - target) / F.when(target > 0, target) <= tol), F.lit(False))


def salary_flags(low: Column, high: Column, predicted: Column) -> tuple[Column, Column]:
    """(any amount present, both present, positive, ordered and not predicted)."""
    has_any = low.isNotNull() | high.isNotNull()
    usable = F.coalesce((low > 0) & (high > 0) & (high >= low), F.lit(False))
    return has_any, usable & ~parse_bool(predicted)


def normalize_amounts(
    df: DataFrame,
    low: str = "salary_min_source",
    high: str = "salary_max_source",
    predicted: str = "salary_is_predicted",
    text: str = "clean_description",
    search: str = "search_description",
) -> DataFrame:
    """Add the normalized pay columns.

    Built in steps so that each pattern search appears once in the plan. The text is
    searched only for rows whose source range is usable.
    """
    df = df.withColumn("_usable", salary_flags(F.col(low), F.col(high), F.col(predicted))[1])
    return normalize_found(with_evidence(df, text, search, F.col("_usable")), low, high)


def normalize_found(df: DataFrame, low: str = "salary_min_source", high: str = "salary_max_source") -> DataFrame:
    """Add the normalized pay columns to a frame with ``_usable`` and the columns of ``evidence``."""
    df = df.withColumns({
        "has_salary_source": F.col(low).isNotNull() | F.col(high).isNotNull(),
        "_mid": (F.col(low) + F.col(high)) / 2,
    })
    mid, unit, amount = F.col("_mid"), F.col("_unit"), F.col("_amount")
    monthly, annual = unit == "MONTHLY", unit == "ANNUAL"
    status = (
        F.when(~F.col("_usable"), fixed.STATUS_NOT_ELIGIBLE)
        .when(monthly & within_tolerance(mid, amount * 12), fixed.STATUS_MONTHLY_AS_IS)
        .when(monthly & within_tolerance(mid, amount), fixed.STATUS_MONTHLY_SCALED)
        .when(annual & within_tolerance(mid, amount), fixed.STATUS_ANNUAL_AS_IS)
        .when(annual & within_tolerance(mid * 12, amount), fixed.STATUS_ANNUAL_SCALED)
        .when(~monthly & ~annual & (mid >= fixed.PAY_ANNUAL_SCALE), fixed.STATUS_SCALE)
        .otherwise(fixed.STATUS_AMBIGUOUS)
    )
    df = df.withColumn("salary_normalization_status", status)
    status = F.col("salary_normalization_status")
    scale = (
        F.when(status.isin(fixed.STATUS_MONTHLY_SCALED, fixed.STATUS_ANNUAL_SCALED), F.lit(12.0))
        .when(~status.isin(fixed.STATUS_NOT_ELIGIBLE, fixed.STATUS_AMBIGUOUS), F.lit(1.0))
    )
    return df.withColumns({
        "salary_min": F.col(low) * scale,
        "salary_max": F.col(high) * scale,
        "salary_midpoint": (F.col(low) * scale + F.col(high) * scale) / 2,
        "salary_analysis_eligible": scale.isNotNull(),
        "salary_text_evidence": F.when(F.col("_usable"), F.col("_evidence")).otherwise(fixed.PAY_NO_RANGE),
    }).drop("_usable", "_unit", "_amount", "_evidence", "_mid")
