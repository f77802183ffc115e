"""Fixtures that the tests of this folder import."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamwin.llm.text import importable  # noqa: E402

TESTDATA = "/root/testdata"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    importable(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(llm):
    """A table of documents from texts, or from ``(id, text, source)``."""

    def make(*rows):
        full = [row if isinstance(row, tuple) else (at, row, "s") for at, row in enumerate(rows)]
        values = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in full]
        return llm.createDataFrame(values, SCHEMA)

    return make


def words(count: int, start: int = 0) -> str:
    return " ".join(f"w{k}" for k in range(start, start + count))


@pytest.fixture(scope="session")
def awkward(make_docs):
    """Nulls, empty and blank texts, repeated rows and ids, a long word and a long text."""
    long = words(3000)
    return make_docs(
        (1, None, None),
        (2, "", "a"),
        (3, " \t\n ", "a"),
        (4, long, "b"),
        (4, long, "b"),
        (5, long + " end", "b"),
        (6, "x" * 3000, "a"),
        (None, long, "a"),
        (7, "é☃ 日本語 😀 tail", None),
        (7, "other text", "b"),
    )


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], SCHEMA)
