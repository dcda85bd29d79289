from __future__ import annotations

import pytest
from pyspark.sql import Row

from moodtide.llm.common import table

LONG = "longish words go on and " * 20_000


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return table(spark, sf_dir, "labels")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows, a shared
    id, and columns whose names clash with those the operators use inside."""
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, "b"), (None, "a few words with no id at all", "en", None),
        (4, LONG, "en", "a"), (5, "one two three four five", "en", "a"), (5, "one two three four five", "en", "a"),
        (6, "the same id " * 30, "de", "b"), (6, "another text " * 30, "de", "b"), (None, None, None, None),
        (7, "mail joe@example.com or +1 (606) 555-8093 from 10.0.0.1", "en", "a"),
    ]
    return spark.createDataFrame(
        [Row(doc_id=i, text=t, lang=g, source=s, n_chars=len(t or ""), _row=9, _words="x", fp=1, key="k", size=3, n=1, kept=True)
         for i, t, g, s in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, _words string, fp bigint, key string, "
        "size int, n int, kept boolean",
    )


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
