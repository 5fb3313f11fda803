"""Column expressions shared by every operator."""

from supplyview.functions.display import format_quantity, plain_number_text
from supplyview.functions.text import (
    all_digits,
    is_blank,
    is_header_text_lenient,
    is_header_text_strict,
    is_label_text,
    lenient_double,
    na_normalize,
    strip,
)

__all__ = [
    "all_digits",
    "format_quantity",
    "is_blank",
    "is_header_text_lenient",
    "is_header_text_strict",
    "is_label_text",
    "lenient_double",
    "na_normalize",
    "plain_number_text",
    "strip",
]
