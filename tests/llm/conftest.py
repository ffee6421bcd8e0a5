import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (id, text, lang, source) rows, with columns whose names operators use themselves."""

    def make(rows):
        full = [(i, t, lang, source, None if t is None else len(t), "x", 1, 2.0) for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", spans string, row int, score double")

    return make


@pytest.fixture
def texts(documents):
    """Documents from texts alone, numbered from 0."""
    return lambda *found: documents([(i, t, "en", f"s{i % 2}") for i, t in enumerate(found)])
