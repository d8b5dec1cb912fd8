import duckdb
import pytest

DOC = "doc_id bigint, text string"


@pytest.fixture(scope="session")
def llm(spark):
    from granary.llm.common import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def documents():
    """The driver's smallest documents, as (doc_id, text)."""
    return duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture
def docs(llm):
    return lambda rows, ddl=DOC: llm.createDataFrame(rows, ddl)


@pytest.fixture
def odd_rows():
    """Nulls, empty texts, ties and repeated rows, and a long text."""
    return [(1, None), (2, ""), (3, " \t\n"), (4, "same text here"), (4, "same text here"), (None, "same text here"),
            (5, "same  text here"), (6, "word " * 5000), (7, "é漢\U0001f600 <|endoftext|>")]
