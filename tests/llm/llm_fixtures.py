"""Fixtures of these tests (imported by name; a second conftest would hide the first from other tests)."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """documents of the smallest scale factor."""
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def as_docs(spark):
    """Python rows (doc_id, text[, source]) as a frame with clashing extra columns."""
    def make(rows):
        full = [(i, t, "en", s, "x", 1) for i, t, s in ((r[0], r[1], r[2] if len(r) > 2 else "s") for r in rows)]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, size string, id int")
    return make
