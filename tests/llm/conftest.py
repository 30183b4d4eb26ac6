import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A frame of documents from texts, or from (id, text) pairs; with an extra column of a clashing name."""
    def make(texts, extra="digest"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), "x") for i, t in rows], f"{DOCS}, {extra} string").repartition(3)
    return make


@pytest.fixture
def by_id():
    def get(df, key="doc_id"):
        return {r[key]: r.asDict() for r in df.collect()}
    return get
