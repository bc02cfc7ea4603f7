"""Helpers of the training-data tests. The session comes from tests/conftest.py."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture
def docs(spark):
    """Make documents from texts or (doc_id, text) pairs, in two partitions."""

    def make(rows, extra=None):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        schema = DOCS + (", " + ", ".join(f"{c} string" for c in extra) if extra else "")
        full = [(i, t, "en", "s", None if t is None else len(t), *(["x"] * len(extra or []))) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(2) if full else spark.createDataFrame([], schema)

    return make
