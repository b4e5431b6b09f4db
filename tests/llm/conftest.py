import pytest

from filmgraph.llm import common

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    """The test session with the settings of the operators."""
    return common.configure(spark)


@pytest.fixture(scope="session")
def make_docs(llm):
    def make(rows, schema=DOCS):
        """Documents from (doc_id, text[, source]) tuples."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return llm.createDataFrame(full, schema)

    return make
