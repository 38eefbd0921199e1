from __future__ import annotations

import pytest

from tripmill.llm import common

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def cleared(spark):
    yield
    common.clear(spark)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source), with a column that clashes with added ones."""

    def build(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return build
