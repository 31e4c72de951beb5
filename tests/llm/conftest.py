import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts; ids from 0."""

    def build(texts, first=0):
        rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts, first)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return build
