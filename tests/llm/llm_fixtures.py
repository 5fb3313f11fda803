"""Small tables with everything that may go wrong in a column."""

import os

import pytest

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, slot string, "
    "_text string, lang_pred int, position long, fp long, node long"
)


def row(doc_id, text, lang="en", source="a", score=None):
    return (doc_id, text, lang, source, len(text or ""), score, "x", "y", 1, 2, 3, 4)


def awkward_rows():
    """Nulls, empty and very long texts, ties, repeated rows, clashing names."""
    long_text = " ".join(f"word{i % 997} the house, and" for i in range(20_000))
    return [
        row(1, "the cat and the dog live in the house"),
        row(2, "the cat and the dog live in the house"),
        row(2, "the cat and the dog live in the house"),
        row(3, None), row(4, ""), row(5, "  \n\t "), row(6, "12 34 !!"),
        row(7, long_text), row(8, "le chat et le chien dans la maison", "fr", None),
        row(9, "le chat et le chien sont dans la maison bleue", "fr", "b"),
        row(None, "a text without an id in the house"), row(10, "x", None, "b"),
        row(11, "Released under the MIT License.\n\nother  words\r\nhere", "en", "c"),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
