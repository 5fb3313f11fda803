"""Display forms of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_number_text(number: Column) -> Column:
    """A double as text without exponent and without a trailing ``.0``; null stays null."""
    short = F.regexp_replace(number.cast("string"), r"\.0$", "")
    wide = F.regexp_replace(
        F.regexp_replace(number.cast("decimal(38,12)").cast("string"), r"(\.[0-9]*?)0+$", "$1"),
        r"\.$",
        "",
    )
    has_exponent = short.contains("E") & (F.abs(number) < 1e25)
    return F.when(has_exponent, wide).otherwise(short)


def format_quantity(number: Column, decimals: int, plain_negatives: bool = False) -> Column:
    """X11: zero shows as ``-``; other values get thousands commas.

    Plain status columns leave negative numbers unformatted (``plain_negatives``).
    """
    shown = F.format_number(number, decimals)
    if plain_negatives:
        shown = F.when(number < 0, plain_number_text(number)).otherwise(shown)
    return F.when(number == 0, F.lit("-")).otherwise(shown)
