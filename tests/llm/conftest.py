from __future__ import annotations

import os

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    if not os.path.isdir(FOLDER):
        pytest.skip("needs the test tables")
    return FOLDER


ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "x" * 70_000,
    "one two three four five six seven eight nine ten " * 3_000,
    "Ünï cödé ñandú 漢字 😀 İstanbul ΑΣ ΑΣ. don't we'll ''s",
    "same text here, same text here",
    "same text here, same text here",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else f"src{i % 2}", i, 1.5, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (None, "no id here at all", "en", "src0", 1, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, size string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
