import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from llm_helpers import LONG, SCHEMA, make  # noqa: E402


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, white space, no letters, one very long text, repeated rows, a null id."""
    texts = [None, "", " \n\t ", "...!? 12", LONG, "the same text twice over here", "the same text twice over here", "é ß 日本 \x00 x", "a"]
    docs = make(spark, texts)
    again = docs.where("doc_id = 5")
    null_id = docs.where("doc_id = 8").selectExpr("cast(null as long) doc_id", *docs.columns[1:])
    return docs.union(again).union(null_id).coalesce(3)


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
