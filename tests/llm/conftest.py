import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    def frame(rows):
        return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t, lang, source in rows], DOCS)
    return frame
