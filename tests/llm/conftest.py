import pytest

from tests.llm.rows import DOCS, documents


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns whose names operators might use."""
    return documents(spark, DOCS)
