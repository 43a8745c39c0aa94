from __future__ import annotations

import os
import sys

import pytest
HERE = os.path.dirname(os.path.abspath(__file__))
for p in (HERE, os.path.dirname(HERE), os.path.dirname(os.path.dirname(HERE))):
    if p not in sys.path:
        sys.path.insert(0, p)

from llm_helpers import CLASHING, DOCS, LONG  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank, wordless and very long texts, repeated rows, clashing names."""
    same = "The quick brown fox jumps over the lazy dog near the river bank today."
    rows = [
        (1, same, "en", "a", 10), (2, same, "en", "a", 10), (3, same + " Indeed.", "en", None, None), (1, same, "en", "a", 10),
        (4, None, None, None, None), (5, "", "en", "b", 0), (6, " \t\n ", None, "b", 4), (None, "no id here at all", "de", "c", 1),
        (None, None, None, None, None), (7, LONG, "fr", "c", len(LONG)), (8, "12345 !!! ???", "en", "a", 3), (9, "x", None, None, 1),
        (10, "<|endoftext|> İstanbul ﬁne Ünïcode — 数字 ΣΟΣ don't", "xx", "b", 9), (10, "other text, same id", "en", "b", 9),
    ]
    return spark.createDataFrame([(*r, *([None] * len(CLASHING))) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
