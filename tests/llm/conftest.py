"""Small document tables with the awkward cases every operator has to take."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cases import AWKWARD  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, columns with clashing names."""
    rows = [(i, t, f"k{i}", i, None, "d") for i, t in AWKWARD]
    schema = "doc_id bigint, text string, key string, n_tokens bigint, `a.b` string, digest string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
