"""Text, number and display expressions."""

import math

import pytest
from pyspark.sql import functions as F

from supplyview import functions as X


def evaluate(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = rows.select("i", build(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(got, key=lambda r: r["i"])]


def test_strip_removes_what_str_strip_removes(spark):
    values = [" a ", "\t\na b\r\x0b\x0c", "\xa0x ", "　", "", "a\xa0b", "\x1cq\x1f", None]
    assert evaluate(spark, values, X.strip) == [v.strip() if v is not None else None for v in values]


def test_na_strings_become_null_but_padded_ones_stay(spark):
    values = ["N/A", "", "nan", "None", " N/A ", "n.a.", "x", None]
    assert evaluate(spark, values, X.na_normalize) == [None] * 4 + [" N/A ", "n.a.", "x", None]


@pytest.mark.parametrize(
    "text, strict, lenient, label",
    [
        ("PRODUCT", True, True, True),
        ("-", True, True, True),
        ("2024 QTY", False, True, True),
        ("QTY 2024", True, True, True),
        ("AB1", False, True, True),
        ("12.5", False, False, False),
        ("1,234", False, False, True),
        ("1-2", False, False, False),
        ("x" * 49, True, True, True),
        ("x" * 50, False, True, True),
        ("   ", False, False, False),
        ("", False, False, False),
        (None, False, False, False),
    ],
)
def test_header_text_rules(spark, text, strict, lenient, label):
    got = [
        evaluate(spark, [text], rule)[0]
        for rule in (X.is_header_text_strict, X.is_header_text_lenient, X.is_label_text)
    ]
    assert got == [strict, lenient, label]


def test_lenient_double(spark):
    values = [" 12 ", "1,234", "1e3", "inf", "-Infinity", "nan", "", "1d", "2f", "0x10", "-",
              ".5", "5.", "+5", "1_000", None, "\xa07\xa0", "1e", "--1"]
    want = [12.0, None, 1000.0, math.inf, -math.inf, None, None, None, None, None, None,
            0.5, 5.0, 5.0, None, None, 7.0, None, None]
    assert evaluate(spark, values, X.lenient_double) == want


def test_plain_number_text(spark):
    numbers = ["1.05", "10", "100.0", "12345678.5", "0.00001", "1e22", "-3.0", None]
    got = evaluate(spark, numbers, lambda v: X.plain_number_text(v.cast("double")))
    assert got == ["1.05", "10", "100", "12345678.5", "0.00001", "1" + "0" * 22, "-3", None]


def test_display_values(spark):
    values = ["0", "1234.5", "1234567.891", "-1234.5", None]
    two = evaluate(spark, values, lambda v: X.format_quantity(v.cast("double"), 2))
    assert two == ["-", "1,234.50", "1,234,567.89", "-1,234.50", None]
    plain = evaluate(spark, values, lambda v: X.format_quantity(v.cast("double"), 0, True))
    assert plain == ["-", "1,234", "1,234,568", "-1234.5", None]
