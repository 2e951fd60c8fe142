import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table out of texts or (id, text) pairs."""

    def make(texts, lang="en", source="s"):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"
