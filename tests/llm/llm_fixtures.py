"""Fixtures of these tests (not a conftest: the name would hide that of the folder above)."""

import pytest


@pytest.fixture
def docs(spark):
    def make(rows):
        """Rows (doc_id, text), with columns whose names clash with the operators' own."""
        return spark.createDataFrame([(*r, "x", 7, None) for r in rows],
                                     "doc_id long, text string, id string, h int, pos string")
    return make
