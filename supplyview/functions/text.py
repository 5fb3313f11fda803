"""Text and number-parsing expressions. All are built-in Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The strings a spreadsheet or usage-CSV reader turns into null.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# What a lenient numeric parse accepts, after stripping.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITY_PATTERN = r"(?i)^[+-]?inf(inity)?$"

# A header cell is shorter than this in the strict rule.
MAX_HEADER_LENGTH = 50


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only the blanks SQL ``trim`` removes."""
    return F.trim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def na_normalize(text: Column) -> Column:
    """Null for the readers' NA strings (exact, unstripped); other text unchanged.

    For sheet and usage text only: in the category dimension ``N/A`` is a value.
    """
    return F.when(~text.isin(*NA_STRINGS), text)


def all_digits(text: Column, ignoring: str = "") -> Column:
    """True when ``text`` without the ``ignoring`` characters is one or more digits."""
    kept = F.translate(text, ignoring, "") if ignoring else text
    return kept.rlike("^[0-9]+$")


def is_header_text_strict(cell: Column) -> Column:
    """G1: short text that is no number and has no digit in its first 3 characters."""
    s = strip(cell)
    return F.coalesce(
        (s != "")
        & (F.length(s) < MAX_HEADER_LENGTH)
        & ~all_digits(s, ".-")
        & ~all_digits(s, ".,")
        & ~F.substring(s, 1, 3).rlike("[0-9]"),
        F.lit(False),
    )


def is_header_text_lenient(cell: Column) -> Column:
    """G2 and the last step of G5: non-blank and not a plain number."""
    s = strip(cell)
    return F.coalesce((s != "") & ~all_digits(s, ".-,"), F.lit(False))


def is_label_text(cell: Column) -> Column:
    """Non-blank and not digits once ``.`` and ``-`` are gone."""
    s = strip(cell)
    return F.coalesce((s != "") & ~all_digits(s, ".-"), F.lit(False))


def lenient_double(text: Column) -> Column:
    """P5: text to double; anything that is no number (or is NaN) becomes null."""
    s = strip(text.cast("string"))
    return F.when(
        s.rlike(NUMBER_PATTERN) | s.rlike(INFINITY_PATTERN), s.try_cast("double")
    )
