import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __id long, label string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source), with extra columns whose
    names clash with those the operators use inside."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 1, "x") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
