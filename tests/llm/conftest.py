import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import DDL, ROWS  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [(*r, "id?", "text?", "k", "s", "c", "l", "f", "r", "h", "i") for r in ROWS]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DDL)
