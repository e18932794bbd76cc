import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text, source) rows."""
    def make(rows, extra=""):
        return spark.createDataFrame([(i, t, "en", s, len(t or "")) + (("x",) if extra else ()) for i, t, s in rows],
                                     DOCS + (f", {extra} string" if extra else ""))
    return make
