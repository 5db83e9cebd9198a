"""Rows that every operator has to take: nulls, empty and very long texts, ties, repeats, clashing extra columns."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = "lorem ipsum dolor sit amet " * 4000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag string, hash long, score double, doc string, spans string, id long"


@pytest.fixture
def odd_docs(spark):
    texts = [
        (1, "a b c d e f g h i j k l m n o"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (5, LONG), (6, "a b c d e f g h i j k l m n o"),
        (None, "a b c d e f g h i j k l m n o"), (None, None), (7, "x"), (8, "é" * 50), (9, "a b c d e f g h i j k l m n\u00a0o"), (10, "A B c d e f g h i j k l m n o"),
    ]
    rows = [(i, t, None if i == 3 else "en", None if i in (2, 7) else f"s{(i or 0) % 3}", None, "t", 5, 0.5, "d", "s", 9) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

