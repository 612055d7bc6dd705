import pytest


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, lang, source) tuples."""

    def make(rows):
        full = [(*row, None, None)[:4] for row in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string")

    return make
