"""Tables with odd rows, and the small documents, for the tests beside this file."""

from __future__ import annotations

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " uid long, row string, key string, fp long, size double, _text string, _key int"
)
LONG = "Long words, long text: " + "ein zwei drei vier fünf. " * 60_000


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    texts = [
        None,
        "",
        "   \n\t ",
        "one",
        "One two\tthree",
        "the quick brown fox jumps over the lazy dog again and again",
        "the  quick brown fox\njumps over the lazy dog again and again",
        "the quick brown fox jumps over the lazy dog again and again",
        "Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: MIT OR (GPL-2.0 WITH x)",
        "naïve Σίσυφος İstanbul 日本語 <|endoftext|> 'tis it's   spaced    out now ",
        LONG,
        LONG,
    ]
    sources = [None, "b", "a", None, "c", "a", "a", "b", "é", "a", "b", "b"]
    rows = [
        (i, t, None, s, None, 7, "r", None, None, None, "x", None)
        for i, (t, s) in enumerate(zip(texts, sources, strict=True))
    ]
    rows += [rows[5]] * 40 + [rows[1]] * 3 + [rows[10]]
    rows += [(None, "no key here", "en", "a", 3, None, None, "k", 1, 2.0, None, 1)]
    rows += [(None, None, None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):  # noqa: F811
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [tuple(r) for r in documents.select("doc_id", "text").collect()]
