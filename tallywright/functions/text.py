"""Text, boolean, number and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywright.functions import fixed

# (?U) makes \s, \b and \d follow Unicode on every JDK.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_MARK = "\u0001 "
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clean_text(c: Column) -> Column:
    """Null becomes ``""``; runs of white space become one space; ends are stripped."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), _SPACE, " "))


def normalized_text(c: Column) -> Column:
    """``clean_text`` in lower case, with ``&`` spelled out as ``and``.

    The sign is spelled out first, so white space is collapsed only once.
    """
    return F.lower(clean_text(F.replace(c.cast("string"), F.lit("&"), F.lit(" and "))))


def normalized_clean(c: Column) -> Column:
    """``normalized_text`` of a ``clean_text`` column: only a text with the sign is collapsed again."""
    return F.lower(F.when(c.contains("&"), clean_text(F.replace(c, F.lit("&"), F.lit(" and ")))).otherwise(c))


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` alone only looks at blanks, so a marker blank is put before each
    letter that starts a run and taken out again.
    """
    marked = F.regexp_replace(F.lower(c), f"(?<=[^{_CASED}])(?=[{_CASED}])", _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def source_family(c: Column, cleaned: bool = False) -> Column:
    """``cleaned``: the column is a ``clean_text`` already, here and in ``source_provider``."""
    text = F.lower(c if cleaned else clean_text(c))
    return (
        F.when(text.contains("adzuna"), "Adzuna")
        .when(text.startswith("freehire"), "Freehire")
        .otherwise("Other")
    )


def source_provider(c: Column, cleaned: bool = False) -> Column:
    """The part after the first ``/`` in title case; else the known board; else the text."""
    text = c if cleaned else clean_text(c)
    after = F.trim(F.regexp_extract(text, r"^[^/]*/(.*)$", 1))
    return (
        F.when(text == "", fixed.UNKNOWN)
        .when(text.contains("/") & (after == ""), fixed.UNKNOWN)
        .when(text.contains("/"), title_case(after))
        .when(F.lower(text).contains("adzuna"), "Adzuna")
        .otherwise(text)
    )


def parse_bool(c: Column, on_unknown: str = "false") -> Column:
    """Read a boolean from text or numbers.

    ``false``: null and unknown text are false. ``null``: null stays null.
    ``error``: text outside both fixed lists fails the query.
    """
    text = F.when(c.isNotNull(), F.lower(clean_text(c)))
    truth = F.coalesce(text.isin(fixed.TRUE_TEXTS), F.lit(False))
    if on_unknown == "false":
        return truth
    if on_unknown == "null":
        return F.when(text.isNotNull(), truth)
    if on_unknown == "error":
        failure = F.raise_error(F.concat(F.lit("unexpected boolean value: "), text)).cast("boolean")
        return F.when(odd_bool(c), failure).otherwise(truth)
    raise ValueError(f"on_unknown must be false, null or error, not {on_unknown!r}")


def odd_bool(c: Column) -> Column:
    """Text outside both fixed lists of booleans."""
    return c.isNotNull() & ~F.lower(clean_text(c)).isin(fixed.TRUE_TEXTS + fixed.FALSE_TEXTS)


def to_number(c: Column, thousands: bool = False) -> Column:
    """Double, or null for text that is no number; ``thousands`` drops commas first."""
    text = c.cast("string")
    if thousands:
        text = F.replace(text, F.lit(","), F.lit(""))
    text = clean_text(text)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def fill_label(c: Column, label: str = fixed.NOT_SPECIFIED) -> Column:
    return F.coalesce(c, F.lit(label))


def is_placeholder(c: Column, names: list[str] = fixed.PLACEHOLDER_NAMES) -> Column:
    return F.lower(clean_text(c)).isin(names)


def to_lakh(c: Column) -> Column:
    return c / F.lit(100_000.0)


def lakh_text(c: Column) -> Column:
    """``₹9.50L``, or ``NA`` for null."""
    amount = F.concat(F.lit("₹"), F.format_string("%.2f", to_lakh(c.cast("double"))), F.lit("L"))
    return F.when(c.isNull(), "NA").otherwise(amount)


def pair_label(a: Column, b: Column) -> Column:
    return F.concat_ws(" + ", a, b)


def disclosure_status(has_source: Column, eligible: Column) -> Column:
    return (
        F.when(~has_source, fixed.DISCLOSURE_NONE)
        .when(eligible, fixed.DISCLOSURE_ELIGIBLE)
        .otherwise(fixed.DISCLOSURE_EXCLUDED)
    )


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double; null when ``den`` is 0 or null."""
    den = den.cast("double")
    return num.cast("double") / F.when(den != 0, den)


def safe_pct(num: Column, den: Column) -> Column:
    return F.lit(100.0) * num.cast("double") / F.when(den.cast("double") != 0, den.cast("double"))


def round_to(c: Column | str, digits: int = 2, places: int = 10) -> Column:
    """Round half away from zero, as on decimals.

    The value is first read as a decimal with ``places`` places, so a double that stands
    for x.xx5 but lies a bit below it rounds up. Percentages keep ten places; amounts of
    money, whose doubles are coarser, use ``round_money``.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast(f"decimal(30,{places})"), digits).cast("double")


def round_money(c: Column | str, digits: int = 2) -> Column:
    return round_to(c, digits, places=6)
